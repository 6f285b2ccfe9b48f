"""Feature importance and per-row attribution for a fitted Spark GBT.

* The forest is read as a Spark table: the model is written with its own
  ML writer into the shared work directory and its ``data`` parquet (one row
  per node: tree, id, prediction, cover, children, split) is scanned. Where tasks
  need node arrays (X3), they get them in blocks of trees of at most
  ``MAX_FOREST_NODES`` nodes; the blocks' sums add up, for a forest of any size.
* X1 native importance = number of splits per feature: a ``groupBy`` over the
  node table.
* X2 path contributions: on each split, the change of the node value is
  credited to the split feature (bias = root values). The node table is walked
  level by level into a sparse (tree, leaf, feature, value) table; the model's
  ``leafCol`` gives every row's leaf per tree, and the joined entries are summed
  per row.
* X3 SHAP values have no Spark equivalent: ``mapInPandas`` over Arrow batches,
  a block of trees shipped once per task in the closure. No shuffle: the rows
  keep their partitioning.
  - SHAP (path-dependent TreeSHAP): per tree, every leaf is a product game
    over the distinct features on its path (``p`` = cover fraction, ``z`` =
    the row satisfies that feature's conditions). Its exact Shapley values are
    ``v * (z_i - p_i) * sum_k w(k) * e_k``, with ``e_k`` the coefficients of
    ``prod_{j != i} (p_j + z_j t)``. Paths are padded to one length with
    null players (p = z = 1), so all leaves of a tree and all rows of a batch
    are processed as arrays. The values depend on a row only through its pattern
    of satisfied features, so for all but deep trees the patterns are computed
    once and rows look theirs up.
* X4-X6: mean |contribution|, sign of covariance(feature, contribution) and
  the signed importance, all from one aggregate; ranked by absolute value.

Contributions are on the model's margin scale (sum of weighted tree outputs;
for classification ``P(1) = 1 / (1 + exp(-2 * margin))``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import quoted
from tabforge.session import scratch_path

# nodes of a block of trees that goes to the tasks in one piece, and blocks chained in one plan
MAX_FOREST_NODES = 500_000
CHAINED_BLOCKS = 4
# bytes of leaf contributions that a join may broadcast
BROADCAST_LEAF_BYTES = 64 << 20


# ---------------------------------------------------------------------------
# forest as a table / arrays
# ---------------------------------------------------------------------------

def forest_table(spark: SparkSession, model, model_path: str | None = None) -> DataFrame:
    """Node table of a GBT model: ``(tree, id, value, cover, left, right,
    feature, threshold)``; leaves have ``left = right = -1``."""
    path = model_path
    if path is None:
        path = scratch_path(spark, "forest")
        model.write().overwrite().save(path)
    d = spark.read.parquet(f"{path.rstrip('/')}/data")
    n = d.select("nodeData.*", "treeID")
    return n.select(F.col("treeID").alias("tree"), F.col("id"), F.col("prediction").alias("value"),
                    F.col("impurityStats").getItem(0).alias("cover"),
                    F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
                    F.col("split.featureIndex").alias("feature"),
                    F.try_element_at(F.col("split.leftCategoriesOrThreshold"), F.lit(1)).alias("threshold"),
                    (F.coalesce(F.col("split.numCategories"), F.lit(-1)) >= 0).alias("by_category"))


@dataclass
class Forest:
    """Per-tree node arrays (node ids are positions; root is 0)."""
    weights: np.ndarray
    left: list[np.ndarray]
    right: list[np.ndarray]
    feature: list[np.ndarray]
    threshold: list[np.ndarray]
    value: list[np.ndarray]
    cover: list[np.ndarray]
    n_features: int

    @property
    def bias(self) -> float:
        return float(sum(w * v[0] for w, v in zip(self.weights, self.value)))

    @property
    def max_depth(self) -> int:
        best = 0
        for left, right in zip(self.left, self.right):
            depth = np.zeros(len(left), dtype=int)
            for i in range(len(left)):           # ids are pre-order: parents first
                if left[i] >= 0:
                    depth[left[i]] = depth[i] + 1
                    depth[right[i]] = depth[i] + 1
            best = max(best, int(depth.max()))
        return best


def tree_blocks(nodes: DataFrame, block_nodes: int) -> list[tuple[int, int]]:
    """Ranges [first, past) of consecutive trees of at most ``block_nodes``
    nodes together (one tree at least), from a count per tree."""
    out: list[list[int]] = []
    held = 0
    for r in sorted(nodes.groupBy("tree").count().collect()):
        if not out or held + r["count"] > block_nodes:
            out.append([r["tree"], r["tree"]])
            held = 0
        out[-1][1] = r["tree"] + 1
        held += r["count"]
    return [(a, b) for a, b in out]


def load_forest(spark: SparkSession, model, model_path: str | None = None, trees: tuple[int, int] | None = None) -> Forest:
    """Node arrays of the trees [first, past) (all of them by default): one
    block, of at most ``MAX_FOREST_NODES`` nodes."""
    nodes = forest_table(spark, model, model_path)
    first, past = trees or (0, model.getNumTrees)
    if trees:
        nodes = nodes.filter((F.col("tree") >= first) & (F.col("tree") < past))
    n = nodes.count()
    if n > MAX_FOREST_NODES and past - first > 1:
        raise ValueError(f"{n} nodes (> {MAX_FOREST_NODES}) in one block of trees: split it with tree_blocks")
    pdf = nodes.toPandas().sort_values(["tree", "id"])
    if (pdf["by_category"] & (pdf["left"] >= 0)).any():
        raise ValueError("the forest splits by category sets; train on features without nominal attributes")
    weights = np.asarray(model.treeWeights, dtype=float)[first:past]
    out = {k: [] for k in ("left", "right", "feature", "threshold", "value", "cover")}
    for t in range(first, past):
        g = pdf[pdf["tree"] == t]
        size = int(g["id"].max()) + 1
        for k in out:
            arr = np.full(size, -1 if k in ("left", "right", "feature") else 0.0,
                          dtype=int if k in ("left", "right", "feature") else float)
            arr[g["id"].to_numpy()] = g[k].fillna(-1 if k in ("left", "right", "feature") else 0.0).to_numpy()
            out[k].append(arr)
    return Forest(weights=weights, n_features=int(model.numFeatures), **out)


# ---------------------------------------------------------------------------
# X1 native importance
# ---------------------------------------------------------------------------

def native_importance(spark: SparkSession, model, feature_names: list[str],
                      model_path: str | None = None, importance_type: str = "split") -> DataFrame:
    """Split count per feature (features never split on get 0);
    ``importance_type="gain"`` gives Spark's normalised gain importance."""
    if importance_type == "gain":
        gains = model.featureImportances.toArray()
        return spark.createDataFrame([(n, float(gains[i])) for i, n in enumerate(feature_names)],
                                     "feature string, importance double")
    if importance_type != "split":
        raise ValueError(f"unknown importance_type: {importance_type}")
    nodes = forest_table(spark, model, model_path)
    counts = nodes.where(F.col("left") >= 0).groupBy("feature").agg(F.count(F.lit(1)).alias("splits"))
    names = spark.createDataFrame(list(enumerate(feature_names)), "feature int, name string")
    return (names.join(counts, "feature", "left")
            .select(F.col("name").alias("feature"),
                    F.coalesce(F.col("splits"), F.lit(0)).cast("double").alias("importance")))


# ---------------------------------------------------------------------------
# per-row kernels (numpy, one Arrow batch at a time)
# ---------------------------------------------------------------------------

def _tree_leaf_paths(left, right, feat, thr, cover, n_slots: int):
    """Leaves of one tree with their merged path players, padded to n_slots:
    (leaf_ids, feat[L,D], lo[L,D], hi[L,D], p[L,D])."""
    leaves = []
    stack = [(0, {})]          # node, {feature: [lo, hi, p]}
    while stack:
        node, players = stack.pop()
        if left[node] < 0:
            leaves.append((node, players))
            continue
        f, t, c = int(feat[node]), float(thr[node]), float(cover[node])
        for child, go_left in ((left[node], True), (right[node], False)):
            pl = {k: list(v) for k, v in players.items()}
            lo, hi, p = pl.get(f, [-math.inf, math.inf, 1.0])
            if go_left:
                hi = min(hi, t)
            else:
                lo = max(lo, t)
            frac = float(cover[child]) / c if c > 0 else 0.0
            pl[f] = [lo, hi, p * frac]
            stack.append((child, pl))
    L = len(leaves)
    ids = np.array([lf for lf, _ in leaves], dtype=int)
    F_ = np.zeros((L, n_slots), dtype=int)
    LO = np.full((L, n_slots), -math.inf)
    HI = np.full((L, n_slots), math.inf)
    P = np.ones((L, n_slots))
    for i, (_, players) in enumerate(leaves):
        for j, (f, (lo, hi, p)) in enumerate(sorted(players.items())):
            F_[i, j], LO[i, j], HI[i, j], P[i, j] = f, lo, hi, p
    return ids, F_, LO, HI, P


def prepare_shap(forest: Forest) -> list:
    """Per-tree padded leaf tables (computed once, shipped with the closure)."""
    D = max(1, forest.max_depth)
    return [(w, val) + _tree_leaf_paths(left, right, feat, thr, cov, D)
            for w, left, right, feat, thr, val, cov in zip(
                forest.weights, forest.left, forest.right, forest.feature,
                forest.threshold, forest.value, forest.cover)], D


# doubles one SHAP working array may hold (rows x leaves x path slots), ~64 MB
SHAP_WORK_ELEMS = 8_000_000
# doubles of one tree's pattern table; larger trees are evaluated row by row
PATTERN_ELEMS = 1 << 20


def shap_np(prepared, D: int, n_features: int, X: np.ndarray) -> np.ndarray:
    """Exact path-dependent TreeSHAP values, (rows, features). Rows are
    processed in chunks sized so each tree's working arrays stay bounded."""
    R = X.shape[0]
    out = np.zeros((R, n_features))
    for tree in prepared:
        L = len(tree[2])
        table = pattern_table(tree, D) if L * D << D <= min(PATTERN_ELEMS, L * D * max(R, 1)) else None
        step = max(1, SHAP_WORK_ELEMS // max(1, L * (D + 1)))
        for i in range(0, R, step):
            out[i:i + step] += _shap_tree(tree, D, n_features, X[i:i + step], table)
    return out


def _slot_values(v: np.ndarray, P: np.ndarray, Z: np.ndarray, D: int) -> np.ndarray:
    """Shapley values (rows, leaves, slots) of the leaves' product games, from
    which slots are satisfied, Z (rows, leaves, slots)."""
    # Shapley weights for a game of D players: k! (D-1-k)! / D!
    wk = np.array([math.factorial(k) * math.factorial(D - 1 - k) / math.factorial(D) for k in range(D)])
    # coefficients of prod_j (p_j + z_j t): C[..., k]
    C = np.zeros((*Z.shape[:2], D + 1))
    C[..., 0] = 1.0
    for j in range(D):
        nxt = C * P[:, j][None, :, None]
        nxt[..., 1:] += C[..., :-1] * Z[..., j][..., None]
        C = nxt
    out = np.empty(Z.shape)
    for i in range(D):
        pi, zi = P[:, i], Z[..., i]                    # (L,), (R, L)
        # divide out (p_i + z_i t): z_i = 1 -> synthetic division by (t + p_i); z_i = 0 -> by p_i
        Q1 = np.zeros((*Z.shape[:2], D))
        Q1[..., D - 1] = C[..., D]
        for k in range(D - 1, 0, -1):
            Q1[..., k - 1] = C[..., k] - pi[None, :] * Q1[..., k]
        Q0 = C[..., :D] / np.where(pi > 0, pi, 1.0)[None, :, None]
        Q = np.where(zi[..., None] > 0, Q1, Q0)
        out[..., i] = v[None, :] * (zi - pi[None, :]) * (Q @ wk)
    return out


def pattern_table(tree, D: int) -> np.ndarray:
    """(pattern, leaf, slot): a leaf's values depend on a row only by which of
    the leaf's slots it satisfies, so all 2^D patterns are computed once."""
    w, val, ids, _, _, _, P = tree
    patterns = (np.arange(1 << D)[:, None] >> np.arange(D)[None] & 1).astype(float)
    return _slot_values(w * val[ids], P, np.repeat(patterns[:, None, :], len(ids), axis=1), D)


def _shap_tree(tree, D: int, n_features: int, X: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    w, val, ids, Fm, LO, HI, P = tree
    xv = X[:, Fm]                                      # (R, L, D)
    Z = (xv > LO) & (xv <= HI)                         # pads: lo=-inf, hi=inf -> satisfied
    if table is None:
        phi = _slot_values(w * val[ids], P, Z.astype(float), D)
    else:
        phi = table[(Z << np.arange(D)).sum(axis=2), np.arange(len(ids))[None, :]]
    out = np.zeros((X.shape[0], n_features))
    for i in range(D):
        # scatter per feature of slot i
        onehot = np.zeros((len(ids), n_features))
        onehot[np.arange(len(ids)), Fm[:, i]] = 1.0
        out += phi[..., i] @ onehot
    return out


def shap_base_value(forest: Forest) -> float:
    """Expected margin under the training cover distribution."""
    total = 0.0
    for w, left, val, cov in zip(forest.weights, forest.left, forest.value, forest.cover):
        leaves = left < 0
        total += w * float((val[leaves] * cov[leaves]).sum() / cov[0])
    return total


# ---------------------------------------------------------------------------
# distributed attribution
# ---------------------------------------------------------------------------

def attribution(df: DataFrame, model, features_col: str = "features", keep: list[str] | None = None,
                method: str = "path", forest: Forest | None = None,
                model_path: str | None = None) -> DataFrame:
    """Per-row contributions: ``keep`` columns + ``bias`` + ``contributions``
    (array<double>, one entry per model feature) + ``x`` (the feature values).

    ``method``: ``"path"`` (X2, leafCol joined with the leaf table) or ``"shap"`` (X3)."""
    from pyspark.ml.functions import vector_to_array
    spark = df.sparkSession
    keep = list(keep or [])
    if method == "path":
        return path_contributions(df, model, features_col, keep, model_path)
    if method != "shap":
        raise ValueError(f"unknown attribution method: {method}")
    whole = df.select(*[quoted(c) for c in keep], vector_to_array(F.col(features_col)).alias("x"))
    if forest is None and model_path is None:
        model_path = scratch_path(spark, "forest")
        model.write().overwrite().save(model_path)
    blocks = [None] if forest else tree_blocks(forest_table(spark, model, model_path), MAX_FOREST_NODES)
    out = whole.withColumns({"bias": F.lit(0.0), "contributions": F.array_repeat(F.lit(0.0), int(model.numFeatures))})
    for i, trees in enumerate(blocks):
        if i and i % CHAINED_BLOCKS == 0:       # a task holds few blocks at a time
            path = scratch_path(spark, "partial-shap")
            out.write.parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
        out = out.mapInPandas(_adding(forest or load_forest(spark, model, model_path, trees)), out.schema)
    return out


def _adding(forest: Forest):
    """Adds a block of trees to the bias and the contributions of rows."""
    prepared, D = prepare_shap(forest)
    bias, nf, chunk = shap_base_value(forest), forest.n_features, 4096

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.vstack(pdf["x"].to_numpy()).astype(float)
            C = np.vstack([shap_np(prepared, D, nf, X[i:i + chunk]) for i in range(0, len(X), chunk)])
            out = pdf.copy()
            out["bias"] = pdf["bias"] + bias
            out["contributions"] = list(np.vstack(pdf["contributions"].to_numpy()) + C)
            yield out
    return run


def leaf_contributions(spark: SparkSession, model, model_path: str | None = None) -> tuple[DataFrame, float]:
    """X2's model side: ``(tree, leaf, feature, value)``, for every leaf the
    weighted sums of the node-value changes along its path, per feature that is
    split on there, and the bias (the roots' weighted values).

    The node table is walked from the roots level by level, a join a level;
    leaves are numbered left to right (the order of Spark's ``leafCol``), which
    is that of their pre-order ids. Nothing of the forest's size is collected."""
    nodes = forest_table(spark, model, model_path)
    weights = spark.createDataFrame(list(enumerate(float(w) for w in model.treeWeights)), "tree int, weight double")
    path = scratch_path(spark, "nodes")
    nodes.join(F.broadcast(weights), "tree").select(
        "tree", "id", (F.col("weight") * F.col("value")).alias("value"), "left", "right", "feature").write.parquet(path)
    nodes = spark.read.parquet(path)
    bias = float(nodes.filter("id = 0").agg(F.sum("value")).first()[0])
    child = nodes.select("tree", F.col("id").alias("child"), F.col("value").alias("to"), F.col("left").alias("l"),
                         F.col("right").alias("r"), F.col("feature").alias("f"))
    level = nodes.filter("id = 0").withColumn("steps", F.array().cast("array<struct<feature:int,value:double>>"))
    done = []
    levels = int(model.getMaxDepth())
    for depth in range(levels):
        done.append(level.filter("left < 0").select("tree", "id", "steps"))
        below = level.filter("left >= 0").select("tree", "feature", "value", "steps", F.explode(F.array("left", "right")).alias("child"))
        below = below.join(child, ["tree", "child"]).select(
            "tree", F.col("child").alias("id"), F.col("to").alias("value"), F.col("l").alias("left"), F.col("r").alias("right"),
            F.col("f").alias("feature"), F.concat("steps", F.array(F.struct(
                F.col("feature").cast("int").alias("feature"), (F.col("to") - F.col("value")).alias("value")))).alias("steps"))
        level = below
        if depth + 1 == levels:
            break
        if depth % 8 == 7:      # cut the plan of deep trees
            path = scratch_path(spark, f"level{depth}")
            below.write.parquet(path)
            level = spark.read.schema(below.schema).parquet(path)
    done.append(level.select("tree", "id", "steps"))
    leaves = done[0]
    for more in done[1:]:
        leaves = leaves.union(more)
    place = F.row_number().over(Window.partitionBy("tree").orderBy("id"))
    # feature -1 stands for the leaf itself, so that a tree without a split has a row
    step = F.explode(F.concat(F.array(F.struct(F.lit(-1).alias("feature"), F.lit(0.0).alias("value"))), F.col("steps")))
    table = leaves.withColumn("leaf", place - 1).select("tree", "leaf", step.alias("s")).groupBy("tree", "leaf", "s.feature") \
        .agg(F.sum("s.value").alias("value"))
    return table, bias


def path_contributions(df: DataFrame, model, features_col: str = "features", keep: list[str] | None = None,
                       model_path: str | None = None) -> DataFrame:
    """X2 as a Spark composition: the model's ``leafCol`` gives each row's leaf
    per tree; ``posexplode`` and a join with the sparse leaf table (broadcast only
    while it is under ``BROADCAST_LEAF_BYTES``) give (row, feature, value), which
    are summed per row and feature and put together per row. The plan does not
    grow with the features. One entry of a row carries its columns along."""
    from pyspark.ml.functions import vector_to_array
    spark = df.sparkSession
    keep = list(keep or [])
    leaves, bias = leaf_contributions(spark, model, model_path)
    path = scratch_path(spark, "leaf-contributions")
    leaves.groupBy("tree", "leaf").agg(F.collect_list(F.struct("feature", "value")).alias("c"), F.count(F.lit(1)).alias("n")) \
        .write.parquet(path)
    leaves = spark.read.parquet(path)
    if 16 * (leaves.agg(F.sum("n")).first()[0] or 0) <= BROADCAST_LEAF_BYTES:
        leaves = F.broadcast(leaves)
    m = model.copy()
    m.setLeafCol("_leaves").setPredictionCol("_p")
    if hasattr(m, "setProbabilityCol"):
        m.setProbabilityCol("_pr").setRawPredictionCol("_r")
    scored = m.transform(df).select(
        F.monotonically_increasing_id().alias("_row"), vector_to_array("_leaves").alias("_lv"),
        F.struct(*[quoted(c) for c in keep], vector_to_array(F.col(features_col)).alias("x")).alias("_of"))
    one = scored.select("_row", "_of", F.posexplode("_lv").alias("tree", "leaf"))
    one = one.select("_row", "tree", F.col("leaf").cast("int").alias("leaf"), F.when(F.col("tree") == 0, F.col("_of")).alias("_of"))
    each = one.join(leaves.select("tree", "leaf", "c"), ["tree", "leaf"]).select("_row", "_of", F.explode("c").alias("c")).select(
        "_row", F.col("c.feature").alias("feature"), F.col("c.value").alias("value"), F.when(F.col("c.feature") == -1, F.col("_of")).alias("_of"))
    sums = each.groupBy("_row", "feature").agg(F.sum("value").alias("value"), F.first("_of", ignorenulls=True).alias("_of"))
    rows = sums.groupBy("_row").agg(F.first("_of", ignorenulls=True).alias("_of"),
                                    F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("_m"))
    nf = int(model.numFeatures)
    whole = F.transform(F.sequence(F.lit(0), F.lit(nf - 1)), lambda i: F.coalesce(F.col("_m")[i], F.lit(0.0)))
    return rows.select(*[F.col("_of").getField(c).alias(c) for c in keep], F.col("_of.x").alias("x"),
                       F.lit(bias).alias("bias"), whole.alias("contributions"))


def contributions_wide(contrib: DataFrame, feature_names: list[str], keep: list[str] | None = None) -> DataFrame:
    """One column per feature (plus ``keep`` columns and ``bias``)."""
    keep = list(keep or [])
    taken = {c.lower() for c in [*keep, "bias"]}
    names = [f"{n}__contribution" if n.lower() in taken else n for n in feature_names]
    return contrib.select(*[quoted(c) for c in keep], "bias",
                          *[F.col("contributions").getItem(i).alias(n) for i, n in enumerate(names)])


# ---------------------------------------------------------------------------
# Importance from contributions (one aggregate)
# ---------------------------------------------------------------------------

def importance_frame(spark: SparkSession, df: DataFrame, names: list[str],
                     x_cols: list[Column], c_cols: list[Column]) -> DataFrame:
    """``(feature, mean_abs, sign, importance, rank_abs)``: mean |c_i|, the
    sign of covar_pop(x_i, c_i) (+1 when x_i or c_i is constant), their
    product, and the rank by |importance| (1 = largest).

    Long form: each row is exploded into (feature index, x, c) and one
    ``groupBy(feature)`` with six aggregates runs, partially aggregated
    map-side -- the plan's size does not grow with the feature count."""
    arr = df.select(F.array(*[x.cast("double") for x in x_cols]).alias("_x"),
                    F.array(*[c.cast("double") for c in c_cols]).alias("_c"))
    return _importance_long(spark, arr, names)


def _importance_long(spark: SparkSession, arr: DataFrame, names: list[str]) -> DataFrame:
    long = arr.select(F.posexplode(F.arrays_zip(F.col("_x").alias("x"), F.col("_c").alias("c"))).alias("i", "p"))
    x, c = F.col("p.x"), F.col("p.c")
    stats = (long.groupBy("i")
             .agg(F.avg(F.abs(c)).alias("ma"), F.covar_pop(x, c).alias("cv"),
                  F.min(x).alias("xa"), F.max(x).alias("xb"), F.min(c).alias("ca"), F.max(c).alias("cb"))
             .collect())                      # one row per feature
    by_i = {r["i"]: r for r in stats}
    rows = []
    for i, n in enumerate(names):
        r = by_i.get(i)
        ma = float(r["ma"] or 0.0) if r else 0.0
        varies = bool(r) and (r["xa"] is not None and r["xa"] < r["xb"]
                              and r["ca"] is not None and r["ca"] < r["cb"])
        cv = float(r["cv"] or 0.0) if r else 0.0
        sign = float(np.sign(cv)) if varies else 1.0
        rows.append((n, ma, sign, ma * sign))
    order = sorted(range(len(rows)), key=lambda j: (-abs(rows[j][3]), rows[j][0]))
    rank = {j: k + 1 for k, j in enumerate(order)}
    return spark.createDataFrame([(*row, rank[j]) for j, row in enumerate(rows)],
                                 "feature string, mean_abs double, sign double, importance double, rank_abs int")


def importance_from_contributions(contrib: DataFrame, feature_names: list[str]) -> DataFrame:
    """X4-X6 over the output of ``attribution``."""
    return _importance_long(contrib.sparkSession,
                            contrib.select(F.col("x").alias("_x"), F.col("contributions").alias("_c")),
                            feature_names)
