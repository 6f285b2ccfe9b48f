"""Helpers shared by the pipeline operators: tables, hand-off through the
shared folder, two-phase ranks and prefix sums, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.session import scratch_path

#: rows that one (key, bucket) cell of a two-phase rank holds on average
RANK_ROWS = 50_000
MIN_BUCKETS = 64


#: rows and bytes of one Arrow batch: whole texts are large rows
BATCH_ROWS = 2_000
BATCH_BYTES = 2 << 20


def text_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches to ``BATCH_ROWS`` and ``BATCH_BYTES``;
    smaller settings stay."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(key).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def under_plain_names(needed: set[str], change, docs: DataFrame) -> DataFrame:
    """``change(docs)`` with all other columns renamed for its time, so that no
    column of the caller can clash with one of the operator's; it returns the
    columns of ``docs``, in their order."""
    names = docs.columns
    return change(docs.toDF(*[c if c in needed else f"column{i}" for i, c in enumerate(names)])).toDF(*names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def handed_off(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the folder all executors share and read back:
    cuts the lineage, survives the loss of an executor."""
    text_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets_for(rows: int) -> int:
    return max(MIN_BUCKETS, -(-int(rows) // RANK_ROWS))


def running_total(df: DataFrame, keys: list[str], order: list[Column], weight: Column,
                  out: str, buckets: int) -> DataFrame:
    """Exclusive running total of ``weight`` (a long) within ``keys`` by
    ``order``, whose first column is a uniform 64-bit hash.

    Two phases: sums per (key, hash bucket), offsets over at most ``buckets``
    rows a key, then a window inside (key, bucket). A key that holds most
    rows is spread over all buckets.
    """
    shift = max(0, 63 - (buckets - 1).bit_length())
    cell = F.shiftrightunsigned(F.shiftleft(order[0], 1), 1 + shift)
    df = df.withColumn("_cell", cell).withColumn("_w", weight.cast("long"))
    sums = df.groupBy(*keys, "_cell").agg(F.sum("_w").alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, "_cell"])]
    sums = sums.select(*named, F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([*keys, "_cell"])]
    joined = df.join(sums, on, "left").select(*df.columns, "_off")
    inside = (Window.partitionBy(*keys, "_cell").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    total = F.col("_off") + F.coalesce(F.sum("_w").over(inside), F.lit(0))
    return joined.withColumn(out, total).drop("_cell", "_w", "_off")


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, comp) of every node in ``edges(a, b)``: comp is the smallest node
    reachable. Each round hooks every node to the smallest label around it and
    then jumps pointers; rounds end when no label changes. The rounds grow with
    the logarithm of a component's diameter.

    Labels are combined before the shuffle (``min`` is partial), so a hub is
    one row a task.
    """
    both = handed_off(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                      .distinct(), f"{name}-edges")
    state = handed_off(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp"))
                       .select(F.col("a").alias("node"), "comp"), f"{name}-comp")
    for _ in range(max_rounds):
        around = (both.join(state.select(F.col("node").alias("b"), "comp"), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("seen")))
        near = state.join(around, "node").select("node", "comp", F.least("comp", "seen").alias("seen"))
        # the root a node pointed to also learns the smaller label
        told = near.groupBy(F.col("comp").alias("node")).agg(F.min("seen").alias("root_seen"))
        hooked = handed_off(near.join(told, "node", "left")
                            .select("node", F.col("comp").alias("old"),
                                    F.least("seen", F.coalesce("root_seen", "seen")).alias("comp")),
                            f"{name}-hook")
        up = hooked.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        nxt = handed_off(hooked.join(up, "comp", "left")
                         .select("node", "old", F.least("comp", F.coalesce("up", "comp")).alias("comp")),
                         f"{name}-comp")
        moved = nxt.filter(F.col("old") != F.col("comp")).limit(1).count()
        state = nxt.select("node", "comp")
        if not moved:
            return state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
