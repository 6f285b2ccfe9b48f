"""A8 / A9 at any size: category vocabularies as a distributed dictionary.

``fit_dictionary`` counts (feature, value) once and gives every value a dense
position 0..k-1 within its feature by the two-phase rank of ``ranking`` (order
of the values' md5). The dictionary is a stored table; only one row a feature
(size, null count, fill) reaches the driver.

``encode`` looks up one feature after the other in a join with its part of the
dictionary, and stores the rows after each. Values that hold a large share of the
rows are looked up in a broadcast part of the dictionary (at most ``HOT_SHARE`` times the
shuffle partitions rows a feature, since counts add up to the rows) and spread
over all partitions, so no task holds a hot value. Neither the plan nor a column's
metadata grows with the categories: a position becomes a sparse vector of a stated length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import quoted
from tabforge.operators.ranking import hash_rank, md5_key
from tabforge.session import drop_scratch, stored

#: a value is hot when it holds more than 1 / (HOT_SHARE * shuffle partitions) of the rows
HOT_SHARE = 8
#: parts over which the rows of hot values are spread
SPREAD = 1 << 10


@dataclass
class Dictionary:
    """``table``: (feature, pos, category, n); per feature its size, the rows
    without a value and the value that fills them."""

    table: DataFrame
    sizes: dict[str, int]
    nulls: dict[str, int]
    fills: dict[str, str]
    rows: int

    def width(self, feature: str) -> int:
        """Length of the feature's vectors (1 for a dictionary without values)."""
        return max(1, self.sizes[feature])


def fit_dictionary(df: DataFrame, values: dict[str, Column], most_frequent: set[str], unknown: str = "unknown") -> Dictionary:
    """Dictionary of the features ``values`` (category expressions by name).
    Rows without a value get the feature's fill (its most frequent value, ties
    to the smallest, or ``unknown``), which then is a category too."""
    entry = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), v.cast("string").alias("value")) for f, v in values.items()]))
    counts, counted = stored(df.select(entry.alias("e")).groupBy("e.feature", "e.value").agg(F.count(F.lit(1)).alias("n")), "category-counts")
    some = F.col("value").isNotNull()
    facts = {r["feature"]: r for r in counts.groupBy("feature").agg(        # one row a feature
        F.sum("n").alias("rows"), F.sum(F.when(~some, F.col("n")).otherwise(0)).alias("nulls"),
        F.min(F.when(some, F.struct((-F.col("n")).alias("n"), "value"))).alias("most")).collect()}
    fills = {f: (facts[f]["most"]["value"] if f in most_frequent and f in facts and facts[f]["most"] else unknown) for f in values}
    nulls = {f: int(facts[f]["nulls"]) if f in facts else 0 for f in values}
    filled = F.coalesce(*[F.when(F.col("feature") == f, F.lit(v)) for f, v in fills.items()])
    # counts has a row a value: rows without one only add to their fill's, or are its row
    beside = {r["feature"] for r in counts.filter(F.col("value") == filled).select("feature").collect()}     # one row a feature
    added = F.coalesce(*[F.when((F.col("feature") == f) & (F.col("value") == fills[f]), F.lit(nulls[f])) for f in fills], F.lit(0))
    seen = counts.filter(some | ~F.col("feature").isin(*beside)).select(
        "feature", F.coalesce("value", filled).alias("category"), (F.col("n") + added).cast("long").alias("n"))
    ranked = hash_rank(seen, md5_key(["category"], 0), group_cols=["feature"], tiebreak=["category"], rank_col="pos",
                       n_groups_bound=len(values))
    table, _ = stored(ranked.select("feature", (F.col("pos") - 1).alias("pos"), "category", "n"), "dictionary")
    drop_scratch(df.sparkSession, counted)
    sizes = {r["feature"]: int(r["n"]) for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = max((int(r["rows"]) for r in facts.values()), default=0)
    return Dictionary(table, {f: sizes.get(f, 0) for f in values}, nulls, fills, rows)


def positions(df: DataFrame, columns: dict[str, str], words: Dictionary) -> DataFrame:
    """``df`` with each string column of ``columns`` (column -> feature)
    replaced by its position (long); null for a value that is not in the dictionary.
    A column at a time, and the rows stored after each: only one look-up's shuffle is
    on disk at once."""
    spark = df.sparkSession
    least = max(1, words.rows // (HOT_SHARE * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    out, last = df.toDF(*[f"c{i}" for i in range(len(df.columns))]), None
    for column, feature in columns.items():
        place = f"c{df.columns.index(column)}"
        known = words.table.filter(F.col("feature") == feature).select(F.col("category").alias("_v"), "pos", "n")
        hot = F.broadcast(known.filter(F.col("n") > least).select("_v", F.col("pos").alias("_hot")))
        cold = known.filter(F.col("n") <= least).select("_v", F.lit(0).alias("_s"), F.col("pos").alias("_cold"))
        found = out.withColumnRenamed(place, "_v").join(hot, "_v", "left")
        # rows that are done go anywhere: not all of them to the partition of one key
        done = F.col("_hot").isNotNull() | F.col("_v").isNull()
        found = found.withColumn("_s", F.when(done, 1 + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD)).cast("int"))
                                 .otherwise(0)).join(cold, ["_v", "_s"], "left")
        out, path = stored(found.select(*[F.coalesce("_hot", "_cold").alias(c) if c == place else c for c in out.columns]), "positions")
        if last:
            drop_scratch(spark, last)
        last = path
    return out.toDF(*df.columns)


def one_hot(place: Column, size: int) -> Column:
    """The sparse vector of ``size`` with a one at ``place``; all zeros without a
    place. The column carries the vector's length only: an encoder would name
    an attribute for every category in the plan, on the driver."""
    head = f'{{"v":{{"type":0,"size":{size},"indices":['
    text = F.when(place.isNull(), F.lit(f'{head}],"values":[]}}}}')) \
        .otherwise(F.concat(F.lit(head), place.cast("string"), F.lit('],"values":[1.0]}}')))
    return F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]))["v"]


def encode(df: DataFrame, columns: dict[str, str], words: Dictionary) -> DataFrame:
    """``df`` with each string column replaced by its sparse one-hot vector of
    the dictionary's size; a value that is not in it has all zeros."""
    out = positions(df, columns, words)
    vectors = {c: one_hot(quoted(c), words.width(f)).alias(c, metadata={"ml_attr": {"num_attrs": words.width(f)}})
               for c, f in columns.items()}
    return out.select(*[vectors.get(x, quoted(x)) for x in out.columns])
