"""Hard negatives of anchors by exact search in a multiway hyperplane tree.

A row's score is its integer inner product with the anchor. The tree is fitted
on a bounded sample: a node has up to ``BRANCH`` split points far from each
other, and every row of the table belongs to the child whose split point is
nearest. Over all rows, each split point stores the range of its distances to
every sibling subtree, each subtree the range of its squared norms.

A score window [lo, hi] of an anchor is an annulus of distances around it,
since distance^2 = |anchor|^2 + |row|^2 - 2 * score. A subtree is left out if
for some split point the triangle inequality keeps its whole range off the
annulus. What is left is searched exactly: anchors visit the leaves that remain
to them, in cells of (leaf, block of rows, chunk of anchors), so that a leaf of
any size, or one vector held by a third of all rows, is many tasks. The sample
gives each window its first bound (the k-th best of a part is a bound of the
whole), which narrows the annuli before any leaf is read.

Two such searches: the best rows of the anchor's label (its positives), then
for each positive the best rows of other labels in the window that its score
gives.

Defined cases: rows without an id, a label or a vector, or with a null or
non-finite component, take no part; repeated rows (same id, label and
vector) are one row; rows with the anchor's own id are never its partners; a
shorter vector is filled up with zeros; ties go to the smaller id; a positive
whose window is empty (a negative score) gives no rows; an empty table gives
none. Other columns are not read. Scores are exact: in floating point while
2^53 is out of reach, in Python integers beyond; one that passes 64 bits is an
error.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm import text as T
from tabforge.llm.common import handed_off

#: split points of a node
BRANCH = 8
#: rows that the tree is fitted on (a bounded sample, by hash of the id)
SAMPLE = 4096
#: rows that a leaf holds on average; deeper trees for larger tables
LEAF_ROWS = 32_768
MAX_DEPTH = 3
#: rows and anchors of one cell, and of one tile of scores in it
CELL_ROWS, CELL_ANCHORS = 65_536, 16_384
TILE_ROWS, TILE_ANCHORS = 8_192, 256
EXACT = 1 << 53


# ---------------------------------------------------------------------------
# the tree
# ---------------------------------------------------------------------------

@dataclass
class Node:
    """An inner node: split points, and per child a node or a leaf number."""

    points: np.ndarray
    children: list
    # squared distances of split point i to the rows of child j; squared norms of child j
    low: np.ndarray = field(default=None)
    high: np.ndarray = field(default=None)
    norm_low: np.ndarray = field(default=None)
    norm_high: np.ndarray = field(default=None)


def squared(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances (rows x points)."""
    return (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None] - 2 * (x @ points.T)


def split_points(x: np.ndarray, count: int = BRANCH) -> np.ndarray:
    """Up to ``count`` rows far from each other: each the one farthest from those before."""
    chosen = [0]
    near = squared(x, x[:1])[:, 0]
    while len(chosen) < count and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def fitted(x: np.ndarray, depth: int) -> tuple[Node | int, list[Node], int]:
    """(root, inner nodes, number of leaves) of a tree of ``depth`` levels."""
    nodes: list[Node] = []
    leaves = 0

    def grow(part: np.ndarray, levels: int):
        nonlocal leaves
        points = split_points(part) if levels and len(part) > 1 else part[:1]
        if len(points) < 2:
            leaves += 1
            return leaves - 1
        node = Node(points, [])
        nodes.append(node)
        side = squared(part, points).argmin(axis=1)
        node.children = [grow(part[side == j], levels - 1) for j in range(len(points))]
        return node

    return grow(x, depth), nodes, leaves


def leaf_of(root: Node | int, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)

    def down(node, at):
        if not isinstance(node, Node):
            out[at] = node
            return
        side = squared(x[at], node.points).argmin(axis=1)
        for j, child in enumerate(node.children):
            if (side == j).any():
                down(child, at[side == j])

    down(root, np.arange(len(x)))
    return out


def ranges(root: Node | int, nodes: list[Node], x: np.ndarray) -> Iterator[tuple]:
    """(node, split point, child, least and most squared distance, least and
    most squared norm) over the rows of ``x``."""
    number = {id(n): k for k, n in enumerate(nodes)}

    def down(node, part):
        if not isinstance(node, Node):
            return
        d = squared(part, node.points)
        side = d.argmin(axis=1)
        norm = (part * part).sum(axis=1)
        for j, child in enumerate(node.children):
            here = side == j
            if here.any():
                for i in range(len(node.points)):
                    yield (number[id(node)], i, j, float(d[here, i].min()), float(d[here, i].max()),
                           float(norm[here].min()), float(norm[here].max()))
                yield from down(child, part[here])

    yield from down(root, x)


def with_ranges(nodes: list[Node], rows: list) -> None:
    """Store the collected ranges; a child without rows keeps empty ranges."""
    for n in nodes:
        c = len(n.points)
        n.low, n.high = np.full((c, c), np.inf), np.full((c, c), -np.inf)
        n.norm_low, n.norm_high = np.full(c, np.inf), np.full(c, -np.inf)
    for k, i, j, lo, hi, a, b in rows:
        n = nodes[k]
        n.low[i, j], n.high[i, j], n.norm_low[j], n.norm_high[j] = lo, hi, a, b


def surviving(root: Node | int, leaves: int, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(anchors x leaves): may the leaf hold a row whose score with the anchor
    is in one of its windows lo[anchor, w]..hi[anchor, w]?"""
    out = np.zeros((len(x), leaves), bool)
    norm = (x * x).sum(axis=1)

    def down(node, alive):
        if not isinstance(node, Node):
            out[:, node] = alive.any(axis=1)
            return
        to = np.sqrt(squared(x, node.points))
        for j, child in enumerate(node.children):
            if node.norm_low[j] > node.norm_high[j]:
                continue                                    # no rows
            # the annulus of each window, a little widened against rounding
            far = norm[:, None] + node.norm_high[j] - 2 * lo
            near = norm[:, None] + node.norm_low[j] - 2 * hi
            keep = alive & (far >= 0) & (lo <= hi)
            far = np.sqrt(np.maximum(far, 0)) * (1 + 1e-9) + 1e-6
            near = np.sqrt(np.maximum(near, 0)) * (1 - 1e-9) - 1e-6
            for i in range(len(node.points)):
                inner, outer = math.sqrt(node.low[i, j]), math.sqrt(node.high[i, j])
                d = to[:, i]
                least = np.maximum(np.maximum(d - outer, inner - d), 0)[:, None]
                keep &= (least <= far) & ((d + outer)[:, None] >= near)
            if keep.any():
                down(child, keep)

    down(root, np.ones(lo.shape, bool))
    return out


# ---------------------------------------------------------------------------
# exact search of blocks
# ---------------------------------------------------------------------------

def matrix(column, exact: bool = False) -> np.ndarray:
    """Vectors of one length as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))
    return out.astype(object) if exact else out.astype(np.float64)


def best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of each anchor's first ``k`` allowed rows by score, ties by id."""
    if scores.dtype == object:                              # Python integers
        first = [(a, r) for a in range(len(scores)) for r in heapq.nsmallest(
            k, np.flatnonzero(allowed[a]).tolist(), key=lambda r: (-scores[a, r], ids[r]))]
        return np.array([a for a, _ in first], np.int64), np.array([r for _, r in first], np.int64)
    masked = np.where(allowed, scores, -np.inf)
    if masked.shape[1] > k:
        least = np.partition(masked, masked.shape[1] - k, axis=1)[:, -k]
        allowed = allowed & (masked >= least[:, None])
    a, r = np.nonzero(allowed)
    order = np.lexsort((ids[r], -scores[a, r], a))
    a, r = a[order], r[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    return a[place < k], r[place < k]


def _windows(rows, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """lo and hi (anchors x windows) of equally many windows an anchor; missing ones are empty."""
    lo, hi = [rows.column(c).to_pylist() for c in ("lo", "hi")]
    width = max(map(len, lo), default=0)
    kind = object if exact else np.float64
    out = np.full((len(lo), width), 1, kind), np.full((len(lo), width), 0, kind)
    for k, (a, b) in enumerate(zip(lo, hi)):
        out[0][k, :len(a)], out[1][k, :len(b)] = a, b
    return out


_FOUND = "akey long, anchor_id long, w int, id long, score long"


def _cell(k: int, same: bool, exact: bool):
    def run(key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        parts = []
        if anchors.num_rows and rows.num_rows:
            x, y = matrix(anchors.column("vec"), exact), matrix(rows.column("vec"), exact)
            lo, hi = _windows(anchors, exact)
            ids, label = rows.column("id").to_numpy(), rows.column("label").to_numpy()
            own, own_label, akey = [anchors.column(c).to_numpy() for c in ("id", "label", "akey")]
            for a in range(0, len(x), TILE_ANCHORS):
                aa = slice(a, a + TILE_ANCHORS)
                for r in range(0, len(y), TILE_ROWS):
                    rr = slice(r, r + TILE_ROWS)
                    scores = x[aa] @ y[rr].T
                    if exact and max(scores.max(), -scores.min()) >= 1 << 63:
                        raise OverflowError("a score passes 64 bits")
                    fit = (own_label[aa, None] == label[None, rr]) == same
                    fit &= own[aa, None] != ids[None, rr]
                    for w in range(lo.shape[1]):
                        i, j = best(scores, ids[rr], fit & (scores >= lo[aa, w, None]) & (scores <= hi[aa, w, None]), k)
                        if len(i):
                            parts.append((i + a, np.full(len(i), w), ids[rr][j], scores[i, j].astype(np.int64)))
        if not parts:
            return pa.table({"akey": pa.array([], pa.int64()), "anchor_id": pa.array([], pa.int64()),
                             "w": pa.array([], pa.int32()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        i, w, found, score = map(np.concatenate, zip(*parts))
        order = np.lexsort((found, -score, w, i))           # the tiles' best, cut to k
        group = i[order] * (lo.shape[1] + 1) + w[order]
        order = order[np.arange(len(order)) - np.searchsorted(group, group) < k]
        return pa.table({"akey": akey[i[order]], "anchor_id": own[i[order]], "w": pa.array(w[order], pa.int32()),
                         "id": found[order], "score": score[order]})
    return run


@dataclass
class Index:
    """Rows(id, label, vec, akey, leaf) with the tree over them."""

    rows: DataFrame
    root: object
    leaves: int
    sizes: dict[int, int]
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]   # vectors, ids, labels
    exact: bool                                         # scores may pass 2^53


def build(rows: DataFrame, branch_depth: int | None = None) -> Index:
    """Fit the tree on a sample, then index every row of rows(id, label, vec, anchor)."""
    rows = rows.groupBy("id", "label", "vec").agg(F.max("anchor").alias("anchor"))
    rows = handed_off(rows.withColumn("akey", F.xxhash64("id", "label", "vec")), "negatives-rows")
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim"), F.min(F.size("vec")).alias("least"),
                     F.max(F.array_max(F.transform("vec", lambda v: F.abs(v.cast("double"))))).alias("most")).first()
    n, dim, most = facts["n"], facts["dim"] or 0, facts["most"] or 0
    if n and facts["least"] != dim:
        rows = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("vec"))))
    if most < 1 << 31:
        rows = rows.withColumn("vec", F.col("vec").cast("array<int>"))
    exact = 4 * dim * most * most >= EXACT
    picked = rows.select("id", "label", "vec").orderBy(F.xxhash64("id"), "id", "label").limit(SAMPLE).toArrow()
    x = matrix(picked.column("vec"))
    depth = branch_depth or min(MAX_DEPTH, max(1, math.ceil(math.log(max(2, n / LEAF_ROWS), BRANCH))))
    # beyond exact floating point one leaf takes all rows: distances could mislead
    root, nodes, leaves = fitted(x, depth) if len(x) and dim and not exact else (0, [], 1)

    def assigned(batches):
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column("vec"))
                leaf = leaf_of(root, v) if nodes else np.zeros(batch.num_rows, np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    def measured(batches):
        for batch in batches:
            found = list(ranges(root, nodes, matrix(batch.column("vec")))) if batch.num_rows else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)],
                                                 names=["node", "i", "j", "lo", "hi", "a", "b"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    indexed = handed_off(rows.mapInArrow(T.tidied(assigned), f"{schema}, leaf long"), "negatives-leaves")
    if nodes:
        # at most BRANCH^2 ranges a node of the bounded tree
        with_ranges(nodes, [tuple(r) for r in indexed.mapInArrow(
            T.tidied(measured), "node long, i long, j long, lo double, hi double, a double, b double")
            .groupBy("node", "i", "j").agg(F.min("lo"), F.max("hi"), F.min("a"), F.max("b")).collect()])
    sizes = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}
    return Index(indexed, root, leaves, sizes, (x, picked.column("id").to_numpy(), picked.column("label").to_numpy()), exact)


def _visits(index: Index, k: int, same: bool):
    """A row per anchor and leaf that may hold one of its partners."""
    root, leaves, exact = index.root, index.leaves, index.exact
    sample, sample_ids, sample_label = index.sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TILE_ANCHORS):
                batch = whole.slice(at, TILE_ANCHORS)
                x = matrix(batch.column("vec"))
                lo, hi = _windows(batch)
                if not exact and len(sample):
                    scores = x @ sample.T
                    fit = (batch.column("label").to_numpy()[:, None] == sample_label[None]) == same
                    fit &= batch.column("id").to_numpy()[:, None] != sample_ids[None]
                    for w in range(lo.shape[1]):
                        inside = np.where(fit & (scores >= lo[:, w, None]) & (scores <= hi[:, w, None]), scores, -np.inf)
                        if inside.shape[1] >= k:
                            lo[:, w] = np.maximum(lo[:, w], np.partition(inside, -k, axis=1)[:, -k])
                    alive = surviving(root, leaves, x, lo, hi)
                else:
                    alive = np.ones((len(x), leaves), bool)
                row, leaf = np.nonzero(alive)
                part = batch.take(pa.array(row))
                bound = part.column("lo") if exact else pa.array(
                    [[int(v) for v in lo[r, :len(h)]] for r, h in zip(row, part.column("hi").to_pylist())], pa.list_(pa.int64()))
                columns = {c: part.column(c) for c in ("akey", "id", "label", "vec")}
                yield pa.RecordBatch.from_arrays([*columns.values(), bound, part.column("hi"), pa.array(leaf)],
                                                 names=[*columns, "lo", "hi", "leaf"])
    return run


def search(index: Index, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """(akey, anchor_id, w, id, score, rank): for anchors(akey, id, label, vec,
    lo, hi) and each of their windows the first ``k`` rows of the same (or
    another) label with a score in it."""
    vec = index.rows.schema["vec"].dataType.simpleString()
    visits = handed_off(anchors.select("akey", "id", "label", "vec", "lo", "hi").mapInArrow(
        T.tidied(_visits(index, k, same)),
        f"akey long, id long, label long, vec {vec}, lo array<long>, hi array<long>, leaf long"), "negatives-visits")
    coming = {r["leaf"]: r["count"] for r in visits.groupBy("leaf").count().collect()}
    # blocks of rows and chunks of anchors of every leaf: at most the number of leaves
    facts = [(leaf, -(-index.sizes[leaf] // CELL_ROWS), -(-c // CELL_ANCHORS))
             for leaf, c in sorted(coming.items()) if leaf in index.sizes]
    cells = F.broadcast(visits.sparkSession.createDataFrame(facts, "leaf long, blocks int, chunks int"))
    left = visits.join(cells, "leaf").withColumn("chunk", F.pmod(F.xxhash64("akey", F.lit(1)), "chunks").cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = index.rows.select("leaf", "id", "label", "vec").join(cells, "leaf") \
        .withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), "blocks").cast("int")) \
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    keys = ["leaf", "block", "chunk"]
    found = left.select(*keys, "akey", "id", "label", "vec", "lo", "hi").groupBy(*keys).cogroup(
        right.select(*keys, "id", "label", "vec").groupBy(*keys)).applyInArrow(_cell(k, same, index.exact), _FOUND)
    order = Window.partitionBy("akey", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         depth: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score, from rows(id, label, vec array<long>, anchor boolean)."""
    index = build(rows.select("id", "label", "vec", "anchor"), depth)
    anchors = index.rows.filter("anchor")
    near = handed_off(search(index, anchors.withColumns({"lo": F.array(F.lit(-(1 << 63) + 1)), "hi": F.array(F.lit((1 << 63) - 1))}),
                             positives, True).select("akey", "id", "score", "rank"), "negatives-positives")
    # the positives of one anchor are at most ``positives``
    lists = near.groupBy("akey").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))

    def percent(score: Column, of: int) -> Column:
        return score.cast("decimal(19,0)") * of / 100

    asked = anchors.join(lists, "akey").withColumns({
        "lo": F.transform("p.score", lambda s: F.ceil(percent(s, low)).cast("long")),
        "hi": F.transform("p.score", lambda s: F.floor(percent(s, high)).cast("long"))})
    found = search(index, asked, negatives, False).withColumn("place", F.col("w") + 1)
    return found.join(near.select("akey", F.col("rank").alias("place"), F.col("id").alias("positive_id"),
                                  F.col("score").alias("positive_score")), ["akey", "place"]) \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"))


def scaled(vectors: DataFrame, anchor: Column, label: Column | None = None, scale: int = 256) -> DataFrame:
    """rows(id, label, vec, anchor) of ``mine`` from (vec_id, embedding, label):
    components become floor(scale * x); rows that take no part are left out."""
    label = F.col("label") if label is None else label
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True))) \
        .select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"),
                F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))).alias("vec"),
                F.coalesce(anchor, F.lit(False)).alias("anchor"))
