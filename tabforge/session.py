"""Session helpers: a configured local session for tests / bench and the
shared work directory used for lineage cuts and model hand-off.

On a cluster the work directory is the one the cluster names in
``spark.checkpoint.dir``; a local one is only created when that setting is
unset (tests, bench on one machine).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tabforge", driver_memory: str = "8g") -> SparkSession:
    master = master or os.environ.get("TABFORGE_MASTER", "local[8]")
    if shuffle_partitions is None:
        shuffle_partitions = int(os.environ.get("TABFORGE_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared directory for checkpoints and intermediate tables.

    Uses the session's checkpoint directory (``spark.checkpoint.dir`` on a
    cluster). Only when none is configured, a local one is created -- that is
    the single-machine test case.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: point it at a folder every executor "
                             "can reach (a machine-local temp folder would not survive on a cluster)")
        configured = tempfile.mkdtemp(prefix="tabforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared work directory."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_path`` named, wherever it is stored."""
    root = work_dir(spark).rstrip("/") + "/"
    if not path.startswith(root):
        raise ValueError(f"{path} is not a scratch folder of this session")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once to a scratch folder and read back, with the folder.
    The shuffle files of the write go with its end, not when the driver happens
    to collect its garbage: they are a multiple of the stored table."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path), path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared work directory (survives executor loss)."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)
