"""Catalogue entries for folds / samples (K1-K3), class weights (M8),
CV summary (M9) and metrics (E1-E9, S10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.metrics import (auc_frame, classification_metrics, metrics_long,
                                        regression_metrics)
from tabforge.operators.model import cv_summary_frame
from tabforge.operators.split import assign_folds, class_weight_frame, sample_exact
from tabforge.plans.catalogue import query, r6, rounded, table

# Rank buckets used by the catalogue: more than one, so that the scalable
# two-phase path (bucket offsets + per-bucket ranks) is what gets checked at
# test scale; the library default sizes buckets from the row count.
TEST_BUCKETS = 16

_FOLD_SQL = """(row_number() OVER (PARTITION BY {part} ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'),
                o_orderkey) - 1) % 5"""


@query("stratified_kfold", f"""
SELECT o_orderkey, o_orderstatus,
       CAST({_FOLD_SQL.format(part="o_orderstatus")} AS INTEGER) AS fold
FROM orders
""")
def stratified_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: 5 stratified folds by o_orderstatus, shuffled by md5(id:42)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return assign_folds(o, k=5, seed=42, label="o_orderstatus", id_cols=["o_orderkey"],
                        n_buckets=TEST_BUCKETS)


_NULL_STATUS = "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END"


@query("stratified_kfold_ranges", f"""
SELECT o_orderkey, o_orderstatus,
       CAST(((row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(concat(o_orderkey, ':42')), o_orderkey) - 1) * 5)
            // count(*) OVER (PARTITION BY o_orderstatus) AS INTEGER) AS fold
FROM (SELECT o_orderkey, {_NULL_STATUS} AS o_orderstatus FROM orders) t
""")
def stratified_kfold_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 without moving rows: 5 stratified folds as ranges of the order by
    md5(id:42), a seventh of the labels null."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_NULL_STATUS).alias("o_orderstatus"))
    return assign_folds(o, k=5, seed=42, label="o_orderstatus", id_cols=["o_orderkey"], dealt="ranges")


@query("stratified_kfold_null_label", f"""
SELECT o_orderkey, o_orderstatus,
       CAST({_FOLD_SQL.format(part="o_orderstatus")} AS INTEGER) AS fold
FROM (SELECT o_orderkey, {_NULL_STATUS} AS o_orderstatus FROM orders) t
""")
def stratified_kfold_null_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 where a seventh of the labels is null: they are a class of their own."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_NULL_STATUS).alias("o_orderstatus"))
    return assign_folds(o, k=5, seed=42, label="o_orderstatus", id_cols=["o_orderkey"],
                        n_buckets=TEST_BUCKETS)


@query("kfold", f"""
SELECT o_orderkey, CAST({_FOLD_SQL.replace("PARTITION BY {part} ", "")} AS INTEGER) AS fold
FROM orders
""")
def kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: 5 plain folds."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return assign_folds(o, k=5, seed=42, id_cols=["o_orderkey"], n_buckets=TEST_BUCKETS)


@query("sample_exact", """
SELECT o_orderkey, o_orderstatus FROM (
  SELECT o_orderkey, o_orderstatus,
         row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey) AS rn,
         count(*) OVER () AS n
  FROM orders) t
WHERE rn <= greatest(CAST(floor(n * 0.1) AS BIGINT), 1)
""")
def sample_exact_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: exactly max(int(n * 0.1), 1) rows, the first ones in md5(id:42) order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sample_exact(o, 0.1, seed=42, id_cols=["o_orderkey"], n_buckets=TEST_BUCKETS)


@query("class_weights", f"""
SELECT quality, count(*) AS n,
       {r6("(SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*))")} AS weight
FROM labels GROUP BY quality
""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: balanced class weights n / (n_classes * n_c)."""
    return rounded(class_weight_frame(table(spark, sf_dir, "labels"), "quality"))


# ---------------------------------------------------------------------------
# metrics over deterministic scores
# ---------------------------------------------------------------------------

def _auc_sql(src: str, label: str, score: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    grp = f"{by}, " if by else ""
    return f"""
ps AS (SELECT {grp}{score} AS s, sum(CASE WHEN {label} THEN 1 ELSE 0 END) AS p,
              sum(CASE WHEN {label} THEN 0 ELSE 1 END) AS n FROM {src} GROUP BY {grp}{score}),
cum AS (SELECT {grp}p, n, coalesce(sum(n) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING
                                                 AND 1 PRECEDING), 0) AS below FROM ps),
auc AS (SELECT {grp}sum(p * (below + n / 2.0)) / (sum(p) * sum(n)) AS auc FROM cum
        {"GROUP BY " + by if by else ""})"""


@query("roc_auc", f"""
WITH {_auc_sql("lineitem", "l_returnflag = 'R'", "l_discount")}
SELECT {r6("auc")} AS auc FROM auc
""")
def roc_auc_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC AUC with ties (label l_returnflag = 'R', score l_discount)."""
    li = table(spark, sf_dir, "lineitem")
    return rounded(auc_frame(li, F.col("l_returnflag") == "R", "l_discount", n_buckets=8))


_CLS_SQL = """
WITH c AS (SELECT count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp,
                  count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE NOT y AND NOT p) AS tn
           FROM (SELECT l_returnflag = 'R' AS y, l_discount * 10 > 0.5 AS p FROM lineitem) t)
"""


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN ({a}) / CAST(({b}) AS DOUBLE) ELSE 0.0 END"


@query("classification_metrics", _CLS_SQL + f"""
SELECT {r6(_ratio("tp + tn", "tp + fp + fn + tn"))} AS accuracy,
       {r6(_ratio("2 * tp", "2 * tp + fp + fn"))} AS f1,
       {r6(_ratio("tp", "tp + fp"))} AS precision,
       {r6(_ratio("tp", "tp + fn"))} AS recall
FROM c
""")
def classification_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4-E7 at threshold 0.5 (strict), score = 10 * l_discount."""
    li = table(spark, sf_dir, "lineitem")
    return rounded(classification_metrics(li, F.col("l_returnflag") == "R", F.col("l_discount") * 10))


@query("regression_metrics", f"""
WITH t AS (SELECT l_extendedprice / 1000.0 AS y, l_quantity * 2.0 AS p FROM lineitem)
SELECT {r6("avg((y - p) * (y - p))")} AS mse, {r6("sqrt(avg((y - p) * (y - p)))")} AS rmse,
       {r6("1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y))")} AS r2
FROM t
""")
def regression_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mse, rmse, r2 of price/1000 against 2 * quantity."""
    li = table(spark, sf_dir, "lineitem")
    return rounded(regression_metrics(li, F.col("l_extendedprice") / 1000.0, F.col("l_quantity") * 2.0))


@query("metrics_long", f"""
WITH {_auc_sql("lineitem", "l_returnflag = 'R'", "l_discount * 10")},
c AS (SELECT count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp,
             count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE NOT y AND NOT p) AS tn
      FROM (SELECT l_returnflag = 'R' AS y, l_discount * 10 > 0.5 AS p FROM lineitem) t)
SELECT 'test_roc_auc' AS metric, {r6("auc")} AS value FROM auc
UNION ALL SELECT 'test_accuracy', {r6(_ratio("tp + tn", "tp + fp + fn + tn"))} FROM c
UNION ALL SELECT 'test_f1', {r6(_ratio("2 * tp", "2 * tp + fp + fn"))} FROM c
UNION ALL SELECT 'test_precision', {r6(_ratio("tp", "tp + fp"))} FROM c
UNION ALL SELECT 'test_recall', {r6(_ratio("tp", "tp + fn"))} FROM c
""")
def metrics_long_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out classification metrics as (metric, value) rows."""
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_discount") * 10).alias("p"))
    return rounded(metrics_long(spark, li, "classification", "y", "p"))


@query("cv_summary", f"""
WITH f AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_totalprice AS s,
                  {_FOLD_SQL.format(part="CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END")} AS fold
           FROM orders),
sets AS (SELECT k.fold AS fold, CASE WHEN f.fold = k.fold THEN 'val' ELSE 'train' END AS part,
                f.y = 1 AS yy, f.s AS s
         FROM f JOIN (SELECT DISTINCT fold FROM f) k ON TRUE),
ps AS (SELECT fold, part, s, sum(CASE WHEN yy THEN 1 ELSE 0 END) AS p, sum(CASE WHEN yy THEN 0 ELSE 1 END) AS n
       FROM sets GROUP BY fold, part, s),
cum AS (SELECT fold, part, p, n, coalesce(sum(n) OVER (PARTITION BY fold, part ORDER BY s
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM ps),
auc AS (SELECT fold, part, sum(p * (below + n / 2.0)) / (sum(p) * sum(n)) AS auc FROM cum GROUP BY fold, part)
SELECT {r6("avg(auc) FILTER (WHERE part = 'train')")} AS cv_mean_train_score,
       {r6("avg(auc) FILTER (WHERE part = 'val')")} AS cv_mean_val_score,
       {r6("stddev_pop(auc) FILTER (WHERE part = 'val')")} AS cv_std_val_score
FROM auc
""")
def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 over K1 folds: per-fold train / validation AUC of a fixed score
    (o_totalprice for o_orderstatus = 'F'), then mean and population std."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"), F.col("o_totalprice").alias("s"))
    folded = assign_folds(o, k=5, seed=42, label="y", id_cols=["o_orderkey"], n_buckets=TEST_BUCKETS)
    # each row is a validation row of its own fold and a training row of the others
    sets = folded.select("y", "s", F.col("fold").alias("own"),
                         F.explode(F.sequence(F.lit(0), F.lit(4))).alias("fold"))
    sets = sets.withColumn("part", F.when(F.col("own") == F.col("fold"), "val").otherwise("train"))
    per_fold = auc_frame(sets, "y", "s", by=["fold", "part"])
    scores = (per_fold.groupBy("fold")
              .agg(F.max(F.when(F.col("part") == "train", F.col("auc"))).alias("train_score"),
                   F.max(F.when(F.col("part") == "val", F.col("auc"))).alias("val_score")))
    return rounded(cv_summary_frame(scores))
