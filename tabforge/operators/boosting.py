"""M2 / M3 at any size: boosted regression trees over blocks of binned rows.

Spark ML's fit keeps every row as objects, which a large table turns into
serialised files that each of its trees x levels passes reads again. Here the
rows are binned once: a block holds ``BLOCK_ROWS`` rows, one byte a feature and
the label. A pass over the blocks adds up count, sum and sum of squares per
(node, feature, bin) in numpy; the driver gets these sums only, and chooses the
splits by the rules of ``GBTRegressor`` (squared error, variance, midpoints of a
sample's values as candidates, least instances, minimal gain, pruning of equal
leaves). The result is a ``GBTRegressionModel`` like any other.

Several features with few bins are counted under one joint code, and the joint
counts summed up to each feature's. Rows are walked through the trees since the
last refresh; every ``REFRESH`` trees the blocks are written anew with the
residuals, so a pass does not grow with the trees.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import quoted

#: a fit of more rows goes by blocks (up to here Spark ML looks at all rows for its split candidates)
LEAST_ROWS = 65_025
BLOCK_ROWS = 1 << 15
#: blocks of one task at most: some 80 MB of ten features
TASK_BLOCKS = 128
#: trees after which the blocks get residuals
REFRESH = 8
#: joint codes of a group of features
JOINT = 4096
#: deepest trees, most bins and features, and most bytes of sums that a pass may send to the driver
MOST_DEPTH, MOST_BINS, MOST_FEATURES, MOST_SUMS = 8, 256, 256, 128 << 20

_BLOCKS = "held boolean, n int, codes binary, y binary"


@dataclass
class Bins:
    """Per feature that has a split: its slot and thresholds (x <= threshold goes left)."""

    slots: list[int]
    thresholds: list[np.ndarray]
    groups: list[list[int]] = field(default_factory=list)

    def __post_init__(self):
        size = 0
        for i, t in enumerate(self.thresholds):
            n = len(t) + 1
            if not self.groups or size * n > JOINT:
                self.groups.append([])
                size = 1
            self.groups[-1].append(i)
            size *= n

    def sizes(self, group: list[int]) -> list[int]:
        return [len(self.thresholds[i]) + 1 for i in group]

    @property
    def total(self) -> int:
        return sum(len(t) + 1 for t in self.thresholds)


@dataclass
class Tree:
    """Nodes in the order they were made; the right child follows the left."""

    feature: list[int] = field(default_factory=lambda: [-1])      # place in Bins, -1: none (yet)
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    stats: list[np.ndarray] = field(default_factory=lambda: [np.zeros(3)])
    weight: float = 1.0
    values: np.ndarray | None = None

    def split(self, node: int, feature: int, at: int, gain: float, left: np.ndarray, right: np.ndarray) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.gain[node], self.left[node] = feature, at, gain, len(self.feature)
        for stats in (left, right):
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(-1)
            self.gain.append(0.0)
            self.stats.append(stats)
        return self.left[node], self.left[node] + 1

    def value(self, node: int) -> float:
        n, s, _ = self.stats[node]
        return float(s / n) if n else 0.0

    def done(self, weight: float) -> Tree:
        """With its weight and the weighted values of its nodes."""
        self.weight = weight
        self.values = weight * np.array([self.value(i) for i in range(len(self.feature))])
        return self

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The node that each row of ``codes`` (features x rows) ends in."""
        kind = np.uint8 if len(self.feature) < 256 else np.uint16
        at = np.zeros(codes.shape[1], kind)
        for node, f in enumerate(self.feature):        # parents come before their children
            if f >= 0:
                to = (codes[f] > self.bin[node]).astype(kind)
                to += kind(self.left[node] - node)
                to *= at == node
                at += to
        return at


def impurity(stats: np.ndarray) -> np.ndarray:
    """Variance of (count, sum, sum of squares) along the last axis."""
    n, s, q = stats[..., 0], stats[..., 1], stats[..., 2]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, (q - s * s / n) / n, 0.0)


def candidates(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds of a sample: midpoints of all neighbouring
    values, or of those nearest to equal counts."""
    seen, n = np.unique(values, return_counts=True)
    if len(seen) - 1 <= most:
        return (seen[:-1] + seen[1:]) / 2.0
    stride = len(values) / (most + 1)
    out, target = [], stride
    sums = np.cumsum(n)
    for i in range(1, len(seen)):
        if abs(sums[i - 1] - target) < abs(sums[i] - target):
            out.append((seen[i - 1] + seen[i]) / 2.0)
            target += stride
    return np.array(out)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _raw(batches):
    """Sampled rows as bytes, one row a batch."""
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int32()), pa.array([_matrix(batch).tobytes()], pa.binary())],
                                             names=["n", "x"])


def _binned(bins: Bins):
    def run(batches):
        held: dict[bool, list] = {False: [], True: []}

        def block(kind: bool):
            codes, y = np.concatenate([c for c, _ in held[kind]], axis=1), np.concatenate([v for _, v in held[kind]])
            held[kind] = []
            for lo in range(0, len(y), BLOCK_ROWS):
                part = slice(lo, lo + BLOCK_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind]), pa.array([len(y[part])], pa.int32()), pa.array([codes[:, part].tobytes()], pa.binary()),
                     pa.array([y[part].tobytes()], pa.binary())], names=["held", "n", "codes", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch), batch.column("y").to_numpy(zero_copy_only=False).astype(float)
            out = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            if not np.isfinite(y[~out]).all():
                raise ValueError("labels must not be null, NaN or infinite")
            if not np.isfinite(x[~out]).all():
                raise ValueError("features must not be NaN or infinite")
            codes = np.empty((max(1, len(bins.slots)), len(y)), np.uint8)
            codes[:1] = 0
            for i, (slot, t) in enumerate(zip(bins.slots, bins.thresholds)):
                codes[i] = np.searchsorted(t, x[:, slot], "left")
            for kind in (False, True):
                rows = out == kind
                if rows.any():
                    held[kind].append((codes[:, rows], y[rows]))
                if sum(len(v) for _, v in held[kind]) >= BLOCK_ROWS:
                    yield from block(kind)
        for kind in (False, True):
            if held[kind]:
                yield from block(kind)
    return run


def _blocks(batches):
    """(held, codes as features x rows, labels) of every block."""
    for batch in batches:
        for held, n, codes, y in zip(*[batch.column(c) for c in ("held", "n", "codes", "y")]):
            yield held.as_py(), np.frombuffer(codes.as_buffer(), np.uint8).reshape(-1, n.as_py()), np.frombuffer(y.as_buffer(), float)


def _residuals(trees: list[Tree], first: bool, codes: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What the next tree is fitted to: the labels, then the negative gradient."""
    y = y.copy()
    for tree in trees:
        y -= tree.values[tree.nodes(codes)]
    return y if first else 2.0 * y


def _sums(bins: Bins, trees: list[Tree], first: bool, tree: Tree, open_nodes: list[int]):
    """One row a task: (nodes x all bins x 3) count, sum and sum of squares."""
    slot = np.full(len(tree.feature), -1, np.int64)
    slot[open_nodes] = np.arange(len(open_nodes))

    def run(batches):
        n = len(open_nodes)
        joint = [np.zeros((3, n * int(np.prod(bins.sizes(g))))) for g in bins.groups] or [np.zeros((3, n))]
        for held, codes, y in _blocks(batches):
            if held:
                continue
            r, at = _residuals(trees, first, codes, y), slot[tree.nodes(codes)]
            if (at < 0).any():
                rows = at >= 0
                codes, r, at = codes[:, rows], r[rows], at[rows]
            square = r * r
            for g, total in zip(bins.groups or [[]], joint):
                key = at.copy()
                for i, size in zip(g, bins.sizes(g)):
                    key *= size
                    key += codes[i]
                for k, w in enumerate((None, r, square)):
                    total[k] += np.bincount(key, w, minlength=total.shape[1])
        out = []
        for g, total in zip(bins.groups or [[]], joint):
            shaped = total.reshape(3, n, *bins.sizes(g))
            for axis in range(len(g)):
                out.append(shaped.sum(axis=tuple(a + 2 for a in range(len(g)) if a != axis)))
            if not g:
                out.append(shaped[:, :, None])
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(out, axis=2).tobytes()], pa.binary())], names=["sums"])
    return run


def _refreshed(trees: list[Tree]):
    def run(batches):
        for batch in batches:
            y = [_residuals(trees, True, codes, v).tobytes() for _, codes, v in _blocks([batch])]
            yield pa.RecordBatch.from_arrays([batch.column("held"), batch.column("n"), batch.column("codes"), pa.array(y, pa.binary())],
                                             names=["held", "n", "codes", "y"])
    return run


def _errors(trees: list[Tree]):
    """One row a task: the held rows and their squared error after each round."""
    def run(batches):
        total = np.zeros(len(trees) + 1)
        for held, codes, y in _blocks(batches):
            if not held:
                continue
            known = ~np.isnan(y)
            left, codes = y[known], codes[:, known]
            total[-1] += len(left)
            for i, tree in enumerate(trees):
                left = left - tree.values[tree.nodes(codes)]
                total[i] += (left * left).sum()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])
    return run


def fit_tasks(rows: int, cores: int) -> int:
    """Tasks of a pass: two a core, none over ``TASK_BLOCKS`` blocks."""
    return max(1, -(-rows // (BLOCK_ROWS * TASK_BLOCKS)), min(2 * cores, -(-rows // BLOCK_ROWS)))


def _even(blocks: DataFrame, tasks: int) -> DataFrame:
    """Persisted blocks in ``tasks`` parts. The source's parts follow its files:
    where one holds over twice a task's share, the blocks are dealt out anew."""
    held = [r["n"] for r in blocks.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("n").alias("n")).collect()]
    if max(held, default=0) <= 2 * -(-sum(held) // tasks):
        return blocks
    even = blocks.repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    even.count()
    blocks.unpersist()
    return even


def _added(blocks: DataFrame, tasks: int, task) -> np.ndarray:
    return sum(np.frombuffer(r["sums"]) for r in blocks.coalesce(tasks).mapInArrow(task, "sums binary").collect())


def _best(bins: Bins, sums: np.ndarray, least: int, gain: float):
    """(gain, feature, bin, left, right) of a node's best split from its (all bins x 3) sums, None without one."""
    best, lo = None, 0
    for f, t in enumerate(bins.thresholds):
        whole = np.cumsum(sums[lo:lo + len(t) + 1], axis=0)
        lo += len(t) + 1
        left, all_ = whole[:-1], whole[-1]
        right = all_ - left
        n = all_[0]
        got = impurity(all_) - left[:, 0] / n * impurity(left) - right[:, 0] / n * impurity(right)
        got = np.where((left[:, 0] < least) | (right[:, 0] < least) | (got < gain), -np.inf, got)
        at = int(np.argmax(got))
        if best is None or got[at] > best[0]:
            best = (float(got[at]), f, at, left[at], right[at])
    return best if best and best[0] > 0 else None


def _grown(blocks: DataFrame, tasks: int, bins: Bins, trees: list[Tree], first: bool, est: GBTRegressor) -> Tree:
    tree, open_nodes = Tree(), [0]
    depth, least, gain = est.getMaxDepth(), max(1, est.getMinInstancesPerNode()), est.getMinInfoGain()
    for level in range(depth):
        found = _added(blocks, tasks, _sums(bins, trees, first, tree, open_nodes)).reshape(3, len(open_nodes), -1).transpose(1, 2, 0)
        if not level:
            tree.stats[0] = found[0, :(len(bins.thresholds[0]) + 1 if bins.slots else 1)].sum(axis=0)
        after = []
        for node, sums in zip(open_nodes, found):
            split = _best(bins, sums, least, gain)
            if split:
                after += tree.split(node, *split[1:3], split[0], *split[3:])
        open_nodes = [x for x in after if abs(impurity(tree.stats[x])) >= np.finfo(float).eps]
        if not open_nodes:
            break
    return tree


def _java(tree: Tree, bins: Bins, jvm, array):
    """The JVM's node of the tree; two leaves of one prediction are one."""
    def stats(node):
        calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
        return calculator(array(jvm.double, [float(x) for x in tree.stats[node]]), int(tree.stats[node][0]))

    def made(node):
        value, spread = tree.value(node), float(impurity(tree.stats[node]))
        if tree.feature[node] >= 0:
            (left, a), (right, b) = made(tree.left[node]), made(tree.left[node] + 1)
            if a is None or a != b:
                f = tree.feature[node]
                cut = jvm.org.apache.spark.ml.tree.ContinuousSplit(bins.slots[f], float(bins.thresholds[f][tree.bin[node]]))
                return jvm.org.apache.spark.ml.tree.InternalNode(value, spread, tree.gain[node], left, right, cut, stats(node)), None
            value = a
        return jvm.org.apache.spark.ml.tree.LeafNode(value, spread, stats(node)), value
    return made(0)[0]


def as_model(trees: list[Tree], bins: Bins, n_features: int, est: GBTRegressor) -> GBTRegressionModel:
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    jvm = sc._jvm

    def array(kind, items):
        out = sc._gateway.new_array(kind, len(items))
        for i, x in enumerate(items):
            out[i] = x
        return out

    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    made = array(kind, [kind(_java(t, bins, jvm, array), n_features) for t in trees])
    java = jvm.org.apache.spark.ml.regression.GBTRegressionModel(est.uid, made, array(jvm.double, [t.weight for t in trees]), n_features)
    model = est._copyValues(GBTRegressionModel(java))
    model._transfer_params_to_java()
    return model


def applies(est, schema, features_col: str) -> bool:
    """Whether a fit of ``est`` is one that the blocks can do."""
    attributes = str(schema[features_col].metadata.get("ml_attr", {}).get("attrs", {}))
    return (isinstance(est, GBTRegressor) and est.getMaxDepth() <= MOST_DEPTH and est.getMaxBins() <= MOST_BINS
            and est.getLossType() == "squared" and est.getSubsamplingRate() == 1.0 and est.getFeatureSubsetStrategy() in ("all", "auto")
            and est.getMinWeightFractionPerNode() == 0.0 and not est.isDefined(est.weightCol)
            and "nominal" not in attributes and "binary" not in attributes)


def fit_blocks(df: DataFrame, rows: int, est: GBTRegressor, label_col: str, features_col: str, held: Column,
               ) -> tuple[GBTRegressionModel, list[float]] | None:
    """(model, RMSE of the ``held`` rows after each round) of the rows of ``df``
    that are not held; None for one that needs too large sums."""
    from pyspark.ml.functions import vector_to_array
    x = vector_to_array(F.col(features_col)).alias("x")
    spark = df.sparkSession
    wanted = max(est.getMaxBins() ** 2, 10_000)
    # drawn before the filter and the vectors' entries: only what is drawn is computed
    sample = df.select(features_col, held.alias("held")).sample(min(1.0, 2 * wanted / max(1, rows)), est.getSeed()).where("not held").select(x)
    parts = [np.frombuffer(r["x"]).reshape(r["n"], -1) for r in sample.mapInArrow(_raw, "n int, x binary").collect()]
    if not parts or parts[0].shape[1] > MOST_FEATURES:
        return None
    seen = np.concatenate(parts)
    found = [candidates(seen[:, i], est.getMaxBins() - 1) for i in range(seen.shape[1])]
    slots = [i for i, t in enumerate(found) if len(t)]
    bins = Bins(slots, [found[i] for i in slots])
    tasks = fit_tasks(rows, spark.sparkContext.defaultParallelism)
    if tasks * 2 ** (est.getMaxDepth() - 1) * max(1, bins.total) * 24 > MOST_SUMS:
        return None
    source = df.select(x, quoted(label_col).cast("double").alias("y"), held.alias("held"))
    blocks = _even(source.mapInArrow(_binned(bins), _BLOCKS).persist(StorageLevel.MEMORY_AND_DISK), tasks)
    trees: list[Tree] = []
    since, kept = 0, blocks        # trees whose residuals the blocks hold
    try:
        for i in range(est.getMaxIter()):
            if i - since == REFRESH:
                fresh = kept.where("not held").mapInArrow(_refreshed(trees[since:]), _BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
                fresh.count()
                if kept is not blocks:
                    kept.unpersist()
                kept, since = fresh, i
            trees.append(_grown(kept, tasks, bins, trees[since:], i == 0, est).done(est.getStepSize() if i else 1.0))
        totals = _added(blocks, tasks, _errors(trees))
        errors = [float(np.sqrt(e / totals[-1])) if totals[-1] else float("nan") for e in totals[:-1]]
    finally:
        blocks.unpersist()
        if kept is not blocks:
            kept.unpersist()
    return as_model(trees, bins, seen.shape[1], est), errors
