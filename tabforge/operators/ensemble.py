"""Boosted ensembles as sequences of rounds (M3, M5, E1 binned).

* ``first_trees`` -- the model of an ensemble's first k trees, without a fit.
* ``round_scores`` -- the metric of every round of several models on several
  parts of a frame (train / validation, folds), in one scan: the models' leaf
  columns give each row's leaf per tree, running sums of the leaves' values the
  margin after each round. Tasks add up mergeable statistics per (model, part,
  round): squared errors, or positives and negatives per probability bin.
* ``kept_rounds`` -- early stopping on such a sequence.

The binned AUC counts pairs inside one bin as ties. It differs from the exact
one by at most half the share of (positive, negative) pairs that fall into one
bin, which ``round_scores`` returns beside it (``bound``).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.columns import quoted

#: bins of the probability of class 1
AUC_BINS = 4096
# boosting rounds without a better validation score before training stops
PATIENCE = 10


def first_trees(model, k: int):
    """The model of the first ``k`` trees of a fitted Spark GBT model."""
    if not 1 <= k <= model.getNumTrees:
        raise ValueError(f"cannot keep {k} of {model.getNumTrees} trees")
    if k == model.getNumTrees:
        return model
    from pyspark import SparkContext
    sc, java = SparkContext._active_spark_context, model._java_obj
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, k)
    weights = sc._gateway.new_array(sc._jvm.double, k)
    for i, (tree, weight) in enumerate(zip(list(java.trees())[:k], list(java.treeWeights())[:k])):
        trees[i], weights[i] = tree, weight
    make = getattr(getattr(sc._jvm.org.apache.spark.ml, java.getClass().getPackageName().split(".")[-1]),
                   java.getClass().getSimpleName())
    sizes = [java.numFeatures()] + ([java.numClasses()] if hasattr(model, "numClasses") else [])
    out = type(model)(make(java.uid(), trees, weights, *sizes))
    model._copyValues(out)._transfer_params_to_java()
    return out


@dataclass
class Leaves:
    """Values of the leaves, left to right, of each tree, times its weight."""

    values: np.ndarray      # of all trees, one after the other
    first: np.ndarray       # where a tree's leaves begin

    @property
    def trees(self) -> int:
        return len(self.first)

    def margins(self, leaf: np.ndarray) -> np.ndarray:
        """(rows x rounds): the margin after each round, from the rows' leaves."""
        return np.cumsum(self.values[leaf.astype(np.int64) + self.first], axis=1)


def leaves_of(model) -> Leaves:
    """Read from the model's public description (one call for all trees)."""
    values, first = [], []
    for tree in re.split(r"\n\s+Tree \d+ \(weight ", model.toDebugString)[1:]:
        weight = float(tree[:tree.index(")")])
        first.append(len(values))
        values += [weight * float(x) for x in re.findall(r"Predict: (\S+)", tree)]
    return Leaves(np.array(values), np.array(first, np.int64))


def kept_rounds(scores: list[float], patience: int = PATIENCE, sign: float = -1.0) -> int:
    """Trees to keep, from the validation score after each one: training stops
    once ``patience`` rounds in a row brought no better score, and the rounds up
    to the best one before that stay (at least one). ``sign``: 1 if larger is
    better, -1 if smaller is. A score that is not a number never is better."""
    best, at = -math.inf, 0
    for i, score in enumerate(scores):
        if sign * score > best:
            best, at = sign * score, i
        elif i - at >= patience:
            break
    return at + 1


def with_leaves(df: DataFrame, models: list, features_col: str, label: Column, part: Column) -> DataFrame:
    """_part, _y and a leaf array per model: a narrow projection."""
    from pyspark.ml.functions import vector_to_array
    out = df.select(F.col(features_col).alias("_features"), label.cast("double").alias("_y"), part.cast("int").alias("_part"))
    names = []
    for k, model in enumerate(models):
        m = model.copy()
        m.setFeaturesCol("_features").setLeafCol(f"_leaf{k}").setPredictionCol("_p")
        drop = ["_p"]
        if hasattr(m, "setProbabilityCol"):
            m.setProbabilityCol("_pr").setRawPredictionCol("_r")
            drop += ["_pr", "_r"]
        out = m.transform(out).drop(*drop)
        names.append(f"_leaf{k}")
    return out.select("_part", "_y", *[vector_to_array(n).alias(n) for n in names])


def _statistics(leaves: list[Leaves], problem: str):
    """Per task, (model, part, round, bin, a, b, c, d): counts of positives and
    negatives in a bin, or (bin 0) the squared errors, the rows, and the sums of
    the labels and of their squares."""
    def run(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            y, part = batch.column("_y").to_numpy(zero_copy_only=False), batch.column("_part").to_numpy(zero_copy_only=False)
            labelled = ~np.isnan(y)
            for k, lv in enumerate(leaves):
                column = batch.column(f"_leaf{k}")
                margin = lv.margins(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, lv.trees))
                for p in np.unique(part).tolist():
                    rows = (part == p) & labelled
                    m, t = margin[rows], y[rows]
                    if problem == "regression":
                        found = np.empty((lv.trees, 1, 4))
                        found[:, 0, 0] = ((m - t[:, None]) ** 2).sum(axis=0)
                        found[:, 0, 1:] = len(t), t.sum(), (t * t).sum()
                    else:
                        prob = 1.0 / (1.0 + np.exp(np.clip(-2.0 * m, -700, 700)))
                        # a bin ends with its upper bound: 0.5 is below the threshold 0.5
                        at = np.clip(np.ceil(prob * AUC_BINS).astype(np.int64) - 1, 0, AUC_BINS - 1)
                        at += AUC_BINS * np.arange(lv.trees)
                        size = AUC_BINS * lv.trees
                        found = np.empty((lv.trees, AUC_BINS, 2))
                        for i, side in enumerate((t == 1.0, t != 1.0)):
                            found[:, :, i] = np.bincount(at[side].reshape(-1), minlength=size).reshape(lv.trees, AUC_BINS)
                    held[k, p] = held[k, p] + found if (k, p) in held else found
        for (k, p), found in held.items():
            r, b = np.nonzero(found.any(axis=2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(r), k), pa.int32()), pa.array(np.full(len(r), p), pa.int32()), pa.array(r, pa.int32()),
                 pa.array(b, pa.int32()), *[pa.array(found[r, b, i] if i < found.shape[2] else np.zeros(len(r))) for i in range(4)]],
                names=["model", "part", "round", "bin", "a", "b", "c", "d"])
    return run


def round_scores(df: DataFrame, models: list, problem: str, label_col: str, features_col: str = "features",
                 part: Column | None = None) -> DataFrame:
    """Metrics of every round of the models on the parts of ``df``: (model,
    part, round) with ``rocauc`` (binned), ``bound`` (how far from the exact one
    it can be), ``accuracy`` and ``f1`` (at 0.5), or with ``rmse``, ``mse`` and
    ``r2``. Null where a part lacks a class. One scan; what is shuffled is
    models x parts x rounds x bins counts a task."""
    part = F.lit(0) if part is None else part
    found = with_leaves(df, models, features_col, quoted(label_col), part).mapInArrow(
        _statistics([leaves_of(m) for m in models], problem),
        "model int, part int, round int, bin int, a double, b double, c double, d double")
    keys = ["model", "part", "round"]
    a, b, c, d = [F.sum(x).alias(x) for x in "abcd"]
    sums = found.groupBy(*keys, "bin").agg(a, b, c, d)
    if problem == "regression":
        sst = F.col("d") - F.col("c") * F.col("c") / F.col("b")
        perfect = F.when(F.col("a") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
        return sums.filter("b > 0").select(
            *keys, F.sqrt(F.col("a") / F.col("b")).alias("rmse"), (F.col("a") / F.col("b")).alias("mse"),
            F.when(sst > 0, 1 - F.col("a") / sst).otherwise(perfect).alias("r2"))
    # at most AUC_BINS rows a round: a window over them is bounded
    below = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    above = F.col("bin") >= AUC_BINS // 2
    pairs = sums.withColumn("before", F.coalesce(F.sum("b").over(below), F.lit(0.0))).groupBy(*keys).agg(
        F.sum(F.col("a") * (F.col("before") + F.col("b") / 2)).alias("u"), F.sum(F.col("a") * F.col("b") / 2).alias("tied"),
        a, b, F.sum(F.when(above, F.col("a")).otherwise(0.0)).alias("tp"),
        F.sum(F.when(above, F.col("b")).otherwise(0.0)).alias("fp"))
    whole = F.nullif(F.col("a") * F.col("b"), F.lit(0.0))
    hits = F.col("tp") + F.col("b") - F.col("fp")
    return pairs.select(*keys, (F.col("u") / whole).alias("rocauc"), (F.col("tied") / whole).alias("bound"),
                        (hits / (F.col("a") + F.col("b"))).alias("accuracy"),
                        F.coalesce(2 * F.col("tp") / F.nullif(F.col("tp") + F.col("fp") + F.col("a"), F.lit(0.0)),
                                   F.lit(0.0)).alias("f1"))


def scores_by_round(frame: DataFrame, columns: list[str]) -> dict[tuple[int, int], dict[str, list[float]]]:
    """{(model, part): {metric: scores by round}}: models x parts x rounds rows."""
    out: dict[tuple[int, int], dict[str, list[float]]] = {}
    columns = list(dict.fromkeys(columns))
    for r in sorted(frame.collect(), key=lambda r: r["round"]):
        held = out.setdefault((r["model"], r["part"]), {c: [] for c in columns})
        for c in columns:
            held[c].append(math.nan if r[c] is None else float(r[c]))
    return out


def watched(problem: str) -> tuple[str, float]:
    """The metric that early stopping watches, and its direction."""
    return ("rocauc", 1.0) if problem == "classification" else ("rmse", -1.0)


def stopped_early(df: DataFrame, models: list, problem: str, label_col: str, metric: str, features_col: str = "features",
                  patience: int = PATIENCE) -> list[tuple[int, float]]:
    """(trees to keep, score by ``metric`` after them) of each model on the rows
    of ``df``, all from one scan. Without a defined score all trees stay."""
    watch, sign = watched(problem)
    metric = "rocauc" if metric == "auc" else metric
    found = scores_by_round(round_scores(df, models, problem, label_col, features_col), [watch, metric])
    out = []
    for k, model in enumerate(models):
        scores = found.get((k, 0), {})
        seen = scores.get(watch, [])
        keep = kept_rounds(seen, patience, sign) if any(s == s for s in seen) else model.getNumTrees
        out.append((keep, scores[metric][keep - 1] if scores else math.nan))
    return out


