"""Evaluation metrics as aggregates over a scored DataFrame.

* ROC AUC with ties (E1): positives / negatives per distinct score (partial
  aggregation map-side), then ``sum(P * (N_below + N_equal / 2)) / (P * N)``.
  The running ``N_below`` is computed per order-preserving score range
  bucket plus a tiny per-bucket offset table, so no window runs over all
  scores in one task. Grouped form (``by=[fold]``) gives per-fold AUCs in one job.
* Classification metrics at a threshold (E4-E7) and regression metrics (E2,
  E3) are single aggregates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabforge.functions.columns import range_bucket

AUC_MAX_BUCKETS = 16384


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def auc_frame(df: DataFrame, label: str | Column, score: str | Column, by: list[str] | None = None,
              n_buckets: int | None = None) -> DataFrame:
    """ROC AUC per group of ``by`` (one row per group; ``auc`` is null when a
    group lacks positives or negatives). ``label`` is 1 for positives.

    Scores are counted once per (group, score), partially aggregated. A score
    sketch cuts the range into ``n_buckets`` buckets (default: the session's
    shuffle partitions); the negatives before a bucket come from a joined
    offset table of groups x buckets rows, and the running count inside it from
    a window per (group, bucket), so no task sees all scores."""
    by = list(by or [])
    y = (_c(label).cast("double") == 1.0)
    s = _c(score).cast("double")
    base = df.select(*[F.col(b) for b in by], s.alias("_s"), y.alias("_y"))
    if n_buckets is None:
        n_buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = int(min(AUC_MAX_BUCKETS, max(2, n_buckets)))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    q = base.agg(F.percentile_approx("_s", probs, 10 * n_buckets).alias("q")).collect()[0]["q"] or []
    bounds = sorted({float(v) for v in q if v == v})
    per_score = base.groupBy(*by, "_s").agg(F.count_if("_y").alias("_p"), F.count_if(~F.col("_y")).alias("_n"))
    if len(bounds) <= 64:
        ranked = per_score.withColumn("_b", range_bucket(F.col("_s"), bounds))
    else:
        from pyspark.ml.feature import Bucketizer
        ranked = (Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="_s", outputCol="_bd",
                             handleInvalid="keep").transform(per_score)
                  .withColumn("_b", F.col("_bd").cast("int")).drop("_bd"))
    keys = [*by, "_b"]
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranked.groupBy(*keys).agg(F.sum("_n").alias("_nb"))
    offsets = totals.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)],
                            F.coalesce(F.sum("_nb").over(before), F.lit(0)).alias("_off"))
    ranked = ranked.join(offsets, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)])
    w = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_off") + F.coalesce(F.sum("_n").over(w), F.lit(0))
    contrib = ranked.select(*by, "_p", "_n", (F.col("_p") * (below + F.col("_n") / 2.0)).alias("_u"))
    agg = contrib.groupBy(*by).agg(F.sum("_u").alias("_u"), F.sum("_p").alias("_P"), F.sum("_n").alias("_N"))
    return agg.select(*by, F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                                  F.col("_u") / (F.col("_P") * F.col("_N"))).alias("auc"))


def roc_auc(df: DataFrame, label: str | Column, score: str | Column, **kw) -> float | None:
    r = auc_frame(df, label, score, **kw).collect()
    return None if not r or r[0]["auc"] is None else float(r[0]["auc"])


def classification_exprs(label: str | Column, prob: str | Column, threshold: float = 0.5) -> list[Column]:
    y = _c(label).cast("double") == 1.0
    p = _c(prob) > F.lit(threshold)
    tp, fp = F.count_if(y & p), F.count_if(~y & p)
    fn, tn = F.count_if(y & ~p), F.count_if(~y & ~p)
    n = tp + fp + fn + tn

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return [ratio(tp + tn, n).alias("accuracy"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
            ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall")]


def classification_metrics(df: DataFrame, label: str | Column, prob: str | Column,
                           threshold: float = 0.5, by: list[str] | None = None) -> DataFrame:
    """E4-E7 in one aggregate: accuracy, f1, precision, recall (0 when undefined)."""
    by = list(by or [])
    exprs = classification_exprs(label, prob, threshold)
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def regression_metrics(df: DataFrame, label: str | Column, pred: str | Column,
                       by: list[str] | None = None) -> DataFrame:
    """E2, E3 in one aggregate: mse, rmse, r2 (r2 = 1 if perfect constant fit, else 0, when y is constant)."""
    by = list(by or [])
    y, p = _c(label).cast("double"), _c(pred).cast("double")
    sse = F.sum((y - p) * (y - p))
    sst = F.var_pop(y) * F.count(y)
    exprs = [F.avg((y - p) * (y - p)).alias("mse"), F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
             F.when(sst > 0, F.lit(1.0) - sse / sst)
             .when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("r2")]
    return df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)


def metrics_long(spark: SparkSession, df: DataFrame, problem_type: str, label: str, pred: str,
                 threshold: float = 0.5, prefix: str = "test_") -> DataFrame:
    """Held-out metrics as ``(metric, value)`` rows."""
    def long(wide: DataFrame, names: list[str]) -> DataFrame:
        stack = ", ".join(f"'{prefix}{n}', CAST(`{n}` AS DOUBLE)" for n in names)
        return wide.selectExpr(f"stack({len(names)}, {stack}) AS (metric, value)")

    if problem_type == "classification":
        auc = auc_frame(df, label, pred).select(F.col("auc").alias("roc_auc"))
        cls = classification_metrics(df, label, pred, threshold)
        return long(auc, ["roc_auc"]).unionByName(long(cls, ["accuracy", "f1", "precision", "recall"]))
    return long(regression_metrics(df, label, pred), ["rmse", "r2"])


def metric_value(df: DataFrame, metric: str, label: str, pred: str, threshold: float = 0.5) -> float:
    """One metric by name (E8): rocauc / auc, accuracy, f1, mse, rmse, r2."""
    if metric in ("rocauc", "auc"):
        v = roc_auc(df, label, pred)
        return float("nan") if v is None else v
    if metric in ("accuracy", "f1"):
        return float(classification_metrics(df, label, pred, threshold).collect()[0][metric])
    if metric in ("mse", "rmse", "r2"):
        return float(regression_metrics(df, label, pred).collect()[0][metric])
    raise ValueError(f"Unsupported evaluation metric: {metric}")
