"""Near duplicates by MinHash: inverted join over signature coordinates.

A document's set is its distinct 4-word shingles; equal sets are one class.
A class has ``COORDINATES`` minima under independent hashes, and two classes
agree in a coordinate with the probability of their Jaccard similarity. Pairs
that agree in ``MATCHES`` coordinates or more are retained and confirmed on
their full sets; a pair at the bound of 0.8 agrees in fewer with probability
8e-9, a closer one with less.

* prefix: (coordinate, value) pairs are put in one global order, rare ones
  first. Two classes that agree in MATCHES of COORDINATES values share one of
  their first COORDINATES - MATCHES + 1, so only those are posted, and of them
  only values that some other class has too. Passages that many documents share
  are frequent values, which come last.
* clusters: each list has a pivot, the member whose values most others have too
  (of edited copies, the original), and a class belongs to the pivot that it
  collides with most. Members are confirmed against their pivot first.
* skip merging: what a cluster still holds in different components meets in
  blocks, dealt as a grid over tasks; collisions are counted coordinate by
  coordinate, and a pair is skipped as soon as the coordinates left cannot reach
  MATCHES. Blocks carry the texts, so that links are confirmed in place and only
  those that join components leave the task: no group is expanded into its
  pairs. Then the same for the lists, for members of different clusters, where
  a pair counts in the first list that it shares.

Texts are read again for retained pairs only. Filters are sized by their keys;
beyond ``filters.MOST_BITS`` joins take their place, with the same links.

Defined cases: null or wordless text has an empty set, links with nothing and
is its own component; fewer than four words are one shingle; repeated rows
belong to one class; a null id is never the smallest unless its component has
none (component null, not kept); rows that repeat an id are kept or not
together; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm import text as T
from tabforge.llm.common import components, handed_off
from tabforge.llm.filters import filter_of

SIZE = 4
COORDINATES = 64
#: equal coordinates of a retained pair
MATCHES = 28
PREFIX = COORDINATES - MATCHES + 1
#: frequent values that the order puts last: how often, and how many at most
MIN_FREQUENT = 16
FREQUENT = 1 << 16
#: members of a block of the grid and shingles of its members, pairs and coordinates counted at a time
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
PAIRS, STEP = 1 << 19, 8
#: rows of a table that is broadcast
BROADCAST_ROWS = 1_000_000
#: rows of small blocks that one task call takes together
GROUPED, GROUPED_SHINGLES = 20_000, 1 << 21

_A = T.mix(np.arange(1, COORDINATES + 1, dtype=T.U64) * T.U64(0x9E3779B97F4A7C15)) | T.U64(1)
_B = T.mix(np.arange(1, COORDINATES + 1, dtype=T.U64) * T.U64(0xD1B54A32D192ED03))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles, by row; ``texts`` in lower case."""
    w = T.words(texts)
    at, h = T.windows(w, SIZE)
    row = w.row[at]
    first = w.first()
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < SIZE))
    if len(short):
        row = np.concatenate([row, short])
        h = np.concatenate([h, np.array([T.sequence_hash(w.hash[first[r]:first[r + 1]]) for r in short], T.U64)])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def parts(texts: list[bytes], budget: int = T.BLOCK_BYTES) -> Iterator[list[bytes]]:
    """Consecutive texts of about ``budget`` bytes together; a longer one is a part of its own."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > budget:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def sets_of(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingles of each text, a part at a time."""
    out: list[np.ndarray] = []
    for part in parts(texts):
        row, h = shingles([t.lower() for t in part])
        bound = np.searchsorted(row, np.arange(len(part) + 1))
        out += [h[a:b] for a, b in zip(bound[:-1], bound[1:])]
    return out


def places_of(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The sets as places in their common universe."""
    place = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    bound = np.cumsum([0, *map(len, sets)])
    return [place[a:b] for a, b in zip(bound[:-1], bound[1:])]


def signatures(h: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(sets x COORDINATES) minima of the sets that begin at ``start`` in ``h``."""
    out = np.empty((len(start), COORDINATES), np.int32)
    for i in range(COORDINATES):
        x = (h ^ _B[i]) * _A[i]
        x ^= x >> T.U64(29)
        x *= T.U64(0xBF58476D1CE4E5B9)
        out[:, i] = (np.minimum.reduceat(x, start) >> T.U64(32)).astype(np.uint32).view(np.int32)
    return out


def lowered(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    for lo, texts in T.blocks(column):
        yield lo, [t.lower() for t in texts]    # bytes.lower() changes A-Z only


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, texts in lowered(batch.column("text")):
            row, h = shingles(texts)
            n = np.bincount(row, minlength=len(texts))
            some = np.flatnonzero(n)
            start = np.searchsorted(row, some)
            key = np.zeros(len(texts), np.int64)
            sig: list = [None] * len(texts)
            if len(some):
                total = np.add.reduceat(T.mix(h), start)
                key[some] = T.mix(total * T.U64(0x9E3779B97F4A7C15) + n[some].astype(T.U64)).view(np.int64)
                for r, s in zip(some.tolist(), signatures(h, start)):
                    sig[r] = s
            head = [batch.column(c).slice(lo, len(texts)) for c in ("doc_id", "rep")]
            yield pa.RecordBatch.from_arrays([*head, pa.array(key), pa.array(n), pa.array(sig, pa.list_(pa.int32()))],
                                             names=["doc_id", "rep", "class", "n", "sig"])


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDINATES)


def values(sig: np.ndarray) -> np.ndarray:
    """64-bit keys of the (coordinate, value) pairs."""
    at = np.arange(COORDINATES, dtype=T.U64) << T.U64(32)
    return T.mix(sig.view(np.uint32).astype(T.U64) | at).view(np.int64)


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        v, n = np.unique(values(_matrix(batch.column("sig"))), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(n)], names=["v", "k"])


class Order:
    """The global order of values: infrequent ones by key, then the frequent."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """Frequent keys, the most frequent last, with their counts."""
        self.place = np.argsort(keys)
        self.keys, self.counts = keys[self.place], counts[self.place]

    def rank(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, 0 for infrequent; count, 0 for infrequent) of values."""
        if not len(self.keys):
            return np.zeros(v.shape, np.int64), np.zeros(v.shape, np.int64)
        at = np.minimum(np.searchsorted(self.keys, v), len(self.keys) - 1)
        known = self.keys[at] == v
        return np.where(known, self.place[at] + 1, 0), np.where(known, self.counts[at], 0)


def _postings(order: Order, shared):
    """(v, c, n, w) of the first PREFIX values of each class, of them those in
    the filter; w: how many classes have its values, summed over the values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = values(_matrix(batch.column("sig")))
            rank, count = order.rank(v)
            held = np.ones(v.shape, bool) if shared is None else shared.value.holds(v.reshape(-1)).reshape(v.shape)
            first = np.lexsort((v, rank))[:, :PREFIX]
            posted, keep = np.take_along_axis(v, first, 1), np.take_along_axis(held, first, 1)
            row = np.nonzero(keep)[0]
            weight = np.maximum(count, held).sum(axis=1)
            c, n = batch.column("class").to_numpy(), batch.column("n").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(posted[keep]), pa.array(c[row]), pa.array(n[row]), pa.array(weight[row])],
                                             names=["v", "c", "n", "w"])
    return run


def cells(cell: np.ndarray, is_left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(left, right) places of the pairs of each cell, ``PAIRS`` at a time at
    least; rows of a cell are consecutive, its left ones first."""
    edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]])) if len(cell) else np.zeros(1, np.int64)
    lefts = np.add.reduceat(is_left.astype(np.int64), edge[:-1]) if len(cell) else np.empty(0, np.int64)
    rights = np.diff(edge) - lefts
    size = lefts * rights
    upto = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
        n = size[at:to]
        group = np.repeat(np.arange(at, to), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield edge[group] + k // rights[group], edge[group] + lefts[group] + k % rights[group]
        at = to


def comparable(rows: dict, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i left, j right) are of different components and can
    be similar by their sizes. Left members are outside the cell's main
    component; a pair of two such is looked at from its smaller class."""
    n, c, comp = rows["n"], rows["c"], rows["comp"]
    fits = (comp[i] != comp[j]) & (rows["main"][j] | (c[i] < c[j]))
    return fits & (5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j]))


def colliding(rows: dict, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of the comparable pairs that agree in MATCHES coordinates or more,
    with the coordinates that are equal; of different clusters, where given."""
    fits = comparable(rows, i, j)
    if "cluster" in rows:
        fits &= rows["cluster"][i] != rows["cluster"][j]
    i, j = i[fits], j[fits]
    count = np.zeros(len(i), np.int16)
    for at in range(0, COORDINATES, STEP):
        part = slice(at, at + STEP)
        count += (rows["sig"][i, part] == rows["sig"][j, part]).sum(axis=1, dtype=np.int16)
        alive = count + (COORDINATES - at - STEP) >= MATCHES
        i, j, count = i[alive], j[alive], count[alive]
    return i, j, rows["sig"][i] == rows["sig"][j]


_PAIRS = "a long, b long"


def cell_rows(table: pa.Table, *columns: str) -> tuple[np.ndarray, np.ndarray, dict, np.ndarray]:
    """(cell number, is left, columns, order) of rows sorted by cell, left first."""
    key = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
    is_left = table.column("is_left").to_numpy(zero_copy_only=False)
    order = np.lexsort((~is_left, *key))
    key = key[:, order]
    cell = np.cumsum(np.concatenate([[0], (key[:, 1:] != key[:, :-1]).any(axis=0)])) if len(order) else np.empty(0, np.int64)
    rows = {c: table.column(c).to_numpy(zero_copy_only=False)[order] for c in ("c", "n", "comp", "main", *columns)}
    if "sig" in table.column_names:
        rows["sig"] = _matrix(table.column("sig"))[order]
    return cell, is_left[order], rows, order


def _list_cells(order: Order):
    """Pairs of the cells of lists; each in the first list that it shares."""
    def run(table: pa.Table) -> pa.Table:
        cell, is_left, rows, at = cell_rows(table, "cluster")
        key = table.column("key").to_numpy()[at]
        out = [np.empty((2, 0), np.int64)]
        for i, j in cells(cell, is_left):
            i, j, same = colliding(rows, i, j)
            if not len(i):
                continue
            v = values(rows["sig"][i])
            rank = np.where(same, order.rank(v)[0], np.iinfo(np.int64).max)
            least = rank.min(axis=1, keepdims=True)
            first = np.where(rank == least, v, np.iinfo(np.int64).max).min(axis=1) == key[i]
            a, b = rows["c"][i[first]], rows["c"][j[first]]
            out.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
        a, b = np.concatenate(out, axis=1)
        return pa.table({"a": a, "b": b})
    return run


def joining(i: np.ndarray, j: np.ndarray, sets: list[np.ndarray], comp: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links among the pairs (i, j) that join components; ``sets`` hold places
    in one universe. A left member is compared with all of its partners at once."""
    comp, n = comp.copy(), np.array(list(map(len, sets)))
    held = np.zeros(max((int(s.max()) + 1 for s in sets if len(s)), default=0), bool)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    edge = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1], [True]])) if len(i) else np.zeros(1, np.int64)
    for lo, hi in zip(edge[:-1], edge[1:]):
        x, y = int(i[lo]), j[lo:hi]
        y = y[comp[y] != comp[x]]
        if not len(y):
            continue
        held[sets[x]] = True
        start = np.cumsum(n[y]) - n[y]
        inter = np.add.reduceat(held[np.concatenate([sets[k] for k in y])], start, dtype=np.int64)
        held[sets[x]] = False
        y = y[100 * inter >= 80 * (n[x] + n[y] - inter)]
        for k in y[np.unique(comp[y], return_index=True)[1]]:
            yield x, int(k)
            comp[comp == comp[k]] = comp[x]


def _cluster_cells(table: pa.Table) -> pa.Table:
    """Links that join components, of the cells of clusters."""
    cell, is_left, rows, at = cell_rows(table)
    raw = table.column("text").combine_chunks().take(pa.array(at)).cast(pa.binary()).to_pylist()
    out: list[tuple[int, int]] = []
    for i, j in cells(cell, is_left):
        i, j, _ = colliding(rows, i, j)
        if len(i):
            need = np.unique(np.concatenate([i, j]))
            sets = places_of(sets_of([raw[k] for k in need]))
            found = joining(np.searchsorted(need, i), np.searchsorted(need, j), sets, rows["comp"][need])
            out += [(int(rows["c"][need[x]]), int(rows["c"][need[y]])) for x, y in found]
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets have a similarity of 0.8 or more."""
    for batch in batches:
        keep = []
        x, y = [batch.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b")]
        for lo in range(0, len(x), 64):
            for s, t in zip(sets_of(x[lo:lo + 64]), sets_of(y[lo:lo + 64])):
                inter = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * inter >= 80 * (len(s) + len(t) - inter))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def texts_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """(class, text) of the wanted(class) ones; each document is looked at once."""
    wanted = handed_off(wanted.distinct().join(classes.select("class", "rep"), "class"), f"minhash-{name}-wanted")
    hold = filter_of(wanted, "rep")

    def some(batches):
        for batch in batches:
            yield batch.filter(pa.array(hold.value.holds(batch.column("rep").to_numpy())))

    read = docs if hold is None else docs.mapInArrow(T.tidied(some), "rep long, text string")
    return handed_off(read.join(wanted, "rep").dropDuplicates(["class"]).select("class", "text"), f"minhash-{name}-texts")


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The retained pairs(a, b) that link."""
    texts = texts_of(docs, classes, pairs.select(F.explode(F.array("a", "b")).alias("class")), name)
    # a pivot's text meets its pairs first, then the pairs go to the members: no key holds many texts
    both = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a") \
        .join(texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
    return handed_off(both.select("a", "b", "text_a", "text_b").mapInArrow(T.tidied(_linked), _PAIRS),
                      f"minhash-{name}-links")


def _retained(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that can be similar and agree in MATCHES coordinates or more."""
    x, y = [classes.select(F.col("class").alias(c), F.col("n").alias(f"n{c}"), F.col("sig").alias(f"s{c}")) for c in "ab"]
    same = F.size(F.filter(F.zip_with("sa", "sb", lambda s, t: s == t), lambda v: v))
    return pairs.join(x, "a").join(y, "b").filter("5 * least(na, nb) >= 4 * greatest(na, nb)").filter(same >= MATCHES) \
        .select("a", "b")


def _clusters(lists: DataFrame) -> DataFrame:
    """(c, cluster): the pivot that each listed class collides with most."""
    pivot = lists.groupBy("v").agg(F.max(F.struct("w", "c")).alias("p"), F.count(F.lit(1)).alias("k")) \
        .filter("k > 1").select("v", F.col("p.c").alias("pivot"))
    return lists.select("v", "c").join(pivot, "v").groupBy("c", "pivot").agg(F.count(F.lit(1)).alias("k")) \
        .groupBy("c").agg(F.max_by("pivot", F.struct("k", "pivot")).alias("cluster"))


def in_blocks(rows: DataFrame, comp: DataFrame, name: str) -> DataFrame:
    """rows(key, c, n) of the keys whose members are in several components,
    each with its component, and the blocks of its key: left ones of members
    outside the main component, right ones of all."""
    placed = rows.join(comp, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    sizes = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("m"))
    mixed = sizes.groupBy("key").agg(F.max_by("comp", F.struct("k", "comp")).alias("most"), F.count(F.lit(1)).alias("comps"),
                                     F.sum("k").alias("k"), F.sum("m").alias("m"), F.max(F.struct("k", "comp", "m")).alias("main")) \
        .filter("comps > 1")

    def blocks(k, m):
        return F.greatest(F.ceil(k / BLOCK), F.ceil(m / BLOCK_SHINGLES)).cast("int")

    mixed = mixed.select("key", "most", blocks(F.col("k"), F.col("m")).alias("blocks"),
                         blocks(F.col("k") - F.col("main.k"), F.col("m") - F.col("main.m")).alias("left_blocks"))
    mixed = handed_off(mixed, f"minhash-{name}-mixed")
    if mixed.count() <= BROADCAST_ROWS:     # else a shuffle by key, whose skew AQE splits
        mixed = F.broadcast(mixed)
    return handed_off(placed.join(mixed, "key").withColumn("main", F.col("comp") == F.col("most")).drop("most"), f"minhash-{name}")


def met(blocks: DataFrame, with_columns: DataFrame, columns: list[str], grouped: int, task) -> DataFrame:
    """The grid of the blocks' cells, small cells together, through ``task``."""
    own = F.xxhash64("c", F.lit(3))

    def upto(c):
        return F.explode(F.sequence(F.lit(0), F.col(c) - 1))

    rows = blocks.join(with_columns, "c")
    left = rows.filter("not main").withColumn("i", F.pmod(own, "left_blocks").cast("int")).withColumn("j", upto("blocks"))
    right = rows.withColumn("j", F.pmod(own, "blocks").cast("int")).withColumn("i", upto("left_blocks"))
    columns = ["key", "i", "j", "c", "n", "comp", "main", *columns]
    both = left.select(*columns, F.lit(True).alias("is_left")).union(right.select(*columns, F.lit(False).alias("is_left")))
    group = F.pmod(F.xxhash64("key", "i", "j"), F.lit(grouped))
    return both.withColumn("cells", group).groupBy("cells").applyInArrow(task, _PAIRS)


def groups(blocks: DataFrame) -> int:
    facts = blocks.agg(F.sum(F.greatest("blocks", "left_blocks")).alias("k"), F.sum(F.col("n") * F.col("blocks")).alias("m")).first()
    return max(1, (facts["k"] or 0) // GROUPED, (facts["m"] or 0) // GROUPED_SHINGLES)


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, rep (hash of id and text), class, n_shingles, component_id and
    kept (is the row its component's smallest id?) of every row."""
    text = F.col("text").cast("string")
    docs = docs.select("doc_id", F.xxhash64("doc_id", F.xxhash64(text)).alias("rep"), text.alias("text"))
    sets = handed_off(docs.mapInArrow(T.tidied(_sets), "doc_id long, rep long, class long, n long, sig array<int>"),
                      "minhash-sets")
    classes = handed_off(sets.filter("n > 0").groupBy("class").agg(
        F.first("n").alias("n"), F.first("sig").alias("sig"), F.min("doc_id").alias("least"), F.min("rep").alias("rep")),
        "minhash-classes")
    texts = docs.select("rep", "text")
    several = handed_off(classes.select("sig").mapInArrow(T.tidied(_values), "v long, k long").groupBy("v")
                         .agg(F.sum("k").alias("k")).filter("k > 1"), "minhash-values")
    often = several.filter(F.col("k") >= MIN_FREQUENT).orderBy(F.desc("k"), "v").limit(FREQUENT).toPandas()
    order = Order(*[often[c].to_numpy(np.int64)[::-1].copy() for c in ("v", "k")])
    shared = filter_of(several, "v")
    lists = classes.select("class", "n", "sig").mapInArrow(
        T.tidied(_postings(order, shared)), "v long, c long, n long, w long")
    if shared is None:
        lists = lists.join(several.select("v"), "v", "left_semi")
    lists = handed_off(lists, "minhash-lists")
    clusters = handed_off(_clusters(lists), "minhash-clusters")
    pairs = handed_off(_retained(classes, clusters.filter("c <> cluster").select(F.col("cluster").alias("a"), F.col("c").alias("b"))),
                       "minhash-pairs")
    links = _confirmed(texts, classes, pairs, "pivots")
    comp = components(links, "minhash-pivots").select(F.col("node").alias("c"), "comp")
    sizes, sigs = [classes.select(F.col("class").alias("c"), x) for x in ("n", "sig")]
    blocks = in_blocks(clusters.join(sizes, "c").withColumnRenamed("cluster", "key"), comp, "cluster-blocks")
    raw = texts_of(texts, classes, blocks.select(F.col("c").alias("class")), "clusters").withColumnRenamed("class", "c")
    links = links.union(handed_off(met(blocks, sigs.join(raw, "c"), ["sig", "text"], groups(blocks), _cluster_cells), "minhash-clustered"))
    comp = components(links, "minhash-clusters").select(F.col("node").alias("c"), "comp")
    blocks = in_blocks(lists.select(F.col("v").alias("key"), "c", "n").join(clusters, "c"), comp, "list-blocks")
    rest = handed_off(met(blocks, sigs, ["sig", "cluster"], groups(blocks), _list_cells(order)), "minhash-rest")
    links = links.union(_confirmed(texts, classes, rest, "rest"))
    comp = components(links, "minhash").select(F.col("node").alias("class"), "comp")
    named = handed_off(classes.select("class", "least").join(comp, "class", "left")
                       .withColumn("comp", F.coalesce("comp", "class")), "minhash-named")
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of = named.select("class", "comp").join(least, "comp").select("class", "component_id")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")
    whole = sets.filter("n > 0").join(of, "class")
    empty = sets.filter("n = 0").withColumn("class", F.lit(None).cast("long")).withColumn("component_id", F.col("doc_id"))
    return whole.select("doc_id", "rep", "class", F.col("n").alias("n_shingles"), "component_id", kept).union(
        empty.select("doc_id", "rep", "class", F.col("n").alias("n_shingles"), "component_id", kept))
