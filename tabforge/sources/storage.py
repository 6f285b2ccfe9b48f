"""Files of a run by URI, wherever Spark can reach them: configurations and
metadata read through Spark, outputs moved through its file systems."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tabforge.sources.layout import OutputLayout


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _path(spark, uri)
    return fs.exists(path)


def delete(spark: SparkSession, uri: str) -> None:
    fs, path = _path(spark, uri)
    fs.delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, path = _path(spark, source)
    to = _path(spark, target)[1]
    if to.getParent() is not None:
        fs.mkdirs(to.getParent())
    if not fs.rename(path, to):
        raise OSError(f"cannot move {source} to {target}")


def parent(uri: str) -> str:
    """The folder of a file; ``.`` (of the default file system) without one."""
    head, slash, _ = uri.rstrip("/").rpartition("/")
    return head or ("/" if slash else ".")


def read_text(spark: SparkSession, uri: str) -> str:
    """The whole (small) file at a URI."""
    try:
        rows = spark.read.option("wholetext", True).text(uri).collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition()):
            raise FileNotFoundError(f"no file at {uri}") from e
        raise
    if len(rows) != 1:
        raise ValueError(f"{uri} is not one file")
    return rows[0][0]


class Run:
    """The outputs of one run, all or nothing.

    They are written under a staging folder beside the run's; ``publish`` writes
    the manifest last and moves everything to its place, the run's folder at the
    end. A run that fails before removes its staging, so that nothing of it can
    be read; one that is cut off leaves it under ``_staging``, without a manifest.
    A run of the same id gives way only when the new one is complete."""

    def __init__(self, spark: SparkSession, final: OutputLayout):
        self.spark, self.final = spark, final
        self.key = uuid.uuid4().hex[:12]
        self.layout = OutputLayout(f"{final.base}/_staging", f"{final.run_id}-{self.key}")
        self.others: list[tuple[str, str]] = []

    def __enter__(self) -> "Run":
        return self

    def __exit__(self, *error) -> None:
        for path in [self.layout.root, *[p for p, _ in self.others]]:
            delete(self.spark, path)

    def beside(self, uri: str) -> str:
        """Where to write an output that goes outside the run's folder."""
        staged = f"{parent(uri)}/_staging/{uri.rstrip('/').rpartition('/')[2]}-{self.key}"
        self.others.append((staged, uri))
        return staged

    def publish(self, manifest: DataFrame, name: str = "training_config") -> str:
        manifest.write.json(f"{self.layout.root}/{name}")
        # others inside the run's folder move with it
        inside = [(a, b) for a, b in self.others if b.startswith(self.final.root + "/")]
        for staged, uri in inside:
            move(self.spark, staged, self.layout.root + uri[len(self.final.root):])
        for staged, uri in [x for x in self.others if x not in inside] + [(self.layout.root, self.final.root)]:
            old = f"{staged}-old"
            if exists(self.spark, uri):
                move(self.spark, uri, old)
            move(self.spark, staged, uri)
            delete(self.spark, old)
        return self.final.root


def committed(spark: SparkSession, root: str, name: str = "training_config") -> bool:
    """Has the run at ``root`` been published?"""
    return exists(spark, f"{root.rstrip('/')}/{name}/_SUCCESS")
