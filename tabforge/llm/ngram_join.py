"""Jaccard join of documents' word-shingle sets: size-aware heavy-light join.

Sets of at most x shingles are light, others heavy; x is chosen by cost.

* light with light: for every partner size m that the similarity allows, a set
  of size n enumerates its subsets of exactly the overlap c(n, m) it would need.
  Two sets link if and only if they share such a subset.
* heavy with any: the heavy sets scan inverted lists. In one global order (rare
  shingles first, the frequent ones last) only the first n - c_min + 1
  shingles of a set are posted; linked sets share a posted shingle.

Copies are one class (equal sets). Lists are never expanded into all pairs:
first every class is verified against the one list pivot it shares most
postings with, then against the members of that pivot's cluster that are in other
components (in blocks, which give only links that join components); then
members of one list, of different clusters and components, meet in blocks that
give only pairs which can be similar. Verified pairs are the links, and
components over the classes give each document the smallest id reachable.

Two bounds keep impossible pairs out of lists and blocks; neither loses a link:

* At least 8/9 of the smaller set of a link is in the overlap, so one of its first
  n/9 + 1 shingles is posted by both: only those of some set have lists.
* The marks of a set hold the parity of its shingles by hash, at least one bit a
  shingle. Bits that differ between two sets are at most the shingles that do.

Shingles posted once and classes without copies are told apart by filters of
fixed size (``FILTER_BITS``), so that they need no shuffle; what a filter lets
through in error is sorted out by the exact steps after it.

The order of shingles comes from a mergeable frequency summary over all
documents (at most ``FREQUENT`` shingles, broadcast); any order gives the same
links. Overlaps are exact on 64-bit shingle hashes.

Defined cases: null or wordless text has an empty set, links with nothing and
is its own component; a text of fewer than five words is one shingle; repeated
rows belong to one class; a null id is never the smallest unless its whole
component has none (component null); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm import minhash as M
from tabforge.llm import text as T
from tabforge.llm.common import under_plain_names, components, handed_off

SIZE = 5
#: largest set that may be light
LIGHT_LIMIT = 16
#: shingles of the frequency summary, in a task and in all
FREQUENT = 1 << 16
#: fewest occurrences of a shingle that the order puts last
MIN_FREQUENT = 16
HELD = 1_500_000
#: sets of a list whose pairs are joined; longer lists meet in blocks
SHORT = 32
#: tasks' groups of cells for one of minhash's: a group, with its texts, is held whole
GROUPS = 8
#: bytes of marks compared at a time
MARKED = 1 << 22
#: bits of the broadcast filters
FILTER_BITS = 1 << 26


def needed(n: int, m: int) -> int:
    """Least overlap of sets of n and m for 100 * intersection >= 80 * union."""
    return -(-4 * (n + m) // 9)


def partners(n: int) -> range:
    """Sizes a set of n can link with."""
    return range(-(-4 * n // 5), 5 * n // 4 + 1)


def posted(n: int) -> int:
    """Postings of a set: linked sets share one of these first shingles."""
    return n - -(-4 * n // 5) + 1


def marks_of(s: np.ndarray) -> bytes:
    """Parities of a set's hashes, in as many bits as the power of two from its size on."""
    bits = max(128, 1 << (len(s) - 1).bit_length())
    return np.packbits(np.bincount((T.mix(s) & T.U64(bits - 1)).astype(np.int64), minlength=bits) & 1 == 1, bitorder="little").tobytes()


def close(marks: pa.Array, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) of sets that are similar in size can link by
    their marks; wider marks are folded to the narrower ones of a pair."""
    start = np.frombuffer(marks.buffers()[1] or b"", np.int32)[marks.offset:marks.offset + len(marks) + 1].astype(np.int64)
    raw, width = np.frombuffer(marks.buffers()[2] or b"", np.uint8), np.diff(start)
    narrow, out = np.minimum(width[i], width[j]), np.zeros(len(i), bool)
    for w in np.unique(narrow).tolist():
        pair = np.flatnonzero(narrow == w)
        row, at = np.unique(np.concatenate([i[pair], j[pair]]), return_inverse=True)
        table = raw[start[row][:, None] + np.arange(w)]
        wide = width[row] > w
        table[wide] ^= raw[start[row[wide]][:, None] + w + np.arange(w)]
        table, (a, b) = table.view(T.U64), at.reshape(2, -1)
        step = max(1, MARKED // w)
        for lo in range(0, len(pair), step):
            differ = np.bitwise_count(table[a[lo:lo + step]] ^ table[b[lo:lo + step]]).sum(axis=1, dtype=np.int64)
            both = n[i[pair[lo:lo + step]]] + n[j[pair[lo:lo + step]]]
            out[pair[lo:lo + step]] = differ <= both - 2 * -(-4 * both // 9)
    return out


def shingle_sets(texts: list[bytes], size: int = SIZE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = T.words(texts)
    at, h = T.windows(w, size)
    first = w.first()
    bound = np.searchsorted(w.row[at], np.arange(w.rows + 1))
    for r in range(w.rows):
        if bound[r] < bound[r + 1]:
            s = np.sort(h[bound[r]:bound[r + 1]])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif first[r] < first[r + 1]:
            yield np.array([T.sequence_hash(w.hash[first[r]:first[r + 1]])], T.U64)
        else:
            yield np.empty(0, T.U64)


def lowered(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    for lo, texts in T.blocks(column):
        yield lo, [t.lower() for t in texts]    # bytes.lower() changes A-Z only


def class_of(s: np.ndarray) -> int:
    """Signed 64-bit id of a set; equal sets have equal ids."""
    sums = np.array([T.mix(s).sum(dtype=T.U64), len(s)], T.U64)
    return int(T.mix(sums * T._SEEDS[5:7] + T._SEEDS[7]).sum(dtype=T.U64).view(np.int64))


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def pruned(least: int, most: int):
        h = np.concatenate([x for x, _ in held])
        n = np.concatenate([x for _, x in held])
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        h, n = h[first], np.add.reduceat(n, first)
        keep = n >= least
        h, n = h[keep], n[keep]
        if len(h) > most:
            top = np.argpartition(-n, most)[:most]
            h, n = h[top], n[top]
        return h, n

    for batch in batches:
        for _, texts in lowered(batch.column("text")):
            _, h = T.windows(T.words(texts), SIZE)
            if len(h):
                held.append(np.unique(h, return_counts=True))
            if sum(len(x) for x, _ in held) > HELD:
                held = [pruned(2, HELD // 4)]
    if held:
        h, n = pruned(2, FREQUENT)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["shingle", "n"])


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """At most ``FREQUENT`` shingle hashes, the most frequent last."""
    rows = docs.select("text").mapInArrow(T.tidied(_frequent), "shingle long, n long").groupBy("shingle") \
        .agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_FREQUENT).orderBy(F.desc("n"), "shingle").limit(FREQUENT) \
        .select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    return rows[::-1].copy().view(T.U64)


def _sets(frequent: np.ndarray):
    place = np.argsort(frequent)
    known = frequent[place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in lowered(batch.column("text")):
                ids, sizes, posts, marks = [], [], [], []
                for s in shingle_sets(texts):
                    n = len(s)
                    ids.append(class_of(s) if n else 0)
                    sizes.append(n)
                    marks.append(marks_of(s) if n else b"")
                    if len(known):
                        at = np.searchsorted(known, s)
                        at[at == len(known)] = 0
                        hot = known[at] == s
                        if hot.any():
                            s = np.concatenate([s[~hot], frequent[np.sort(place[at[hot]])]])
                    posts.append((s if n <= LIGHT_LIMIT else s[:posted(n)]).view(np.int64))
                head = [batch.column(k).slice(lo, len(texts)) for k in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays(
                    [*head, pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(posts, pa.list_(pa.int64())),
                     pa.array(marks, pa.binary())], names=["doc_id", "text_hash", "class", "n", "posts", "marks"])
    return run


@cache
def _subsets(n: int, m: int) -> np.ndarray:
    return np.array(list(combinations(range(n), needed(n, m))), np.int64)


def _light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_size: dict[int, list] = {}
        for c, s in zip(batch.column("class").to_pylist(), batch.column("posts").to_pylist()):
            by_size.setdefault(len(s), []).append((c, s))
        for n, rows in by_size.items():
            for at in range(0, len(rows), 512):
                ids = np.array([c for c, _ in rows[at:at + 512]], np.int64)
                sets = T.mix(np.array([s for _, s in rows[at:at + 512]], np.int64).view(T.U64))
                for m in partners(n):
                    pick = _subsets(n, m)
                    salt = T.U64((min(n, m) << 20 | max(n, m)) << 8)
                    key = T.mix(sets[:, pick].sum(axis=2, dtype=T.U64) + salt)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(ids, len(pick))),
                         pa.array(np.full(key.size, n)), pa.array(np.full(key.size, m))],
                        names=["subset", "class", "n", "m"])


def light_limit(small: DataFrame) -> int:
    """The boundary with the least cost: subsets enumerated below it, postings
    scanned above it. ``small`` has the classes up to ``LIGHT_LIMIT``."""
    count = {r.n: r["count"] for r in small.groupBy("n").count().collect()}
    lists = small.select(F.explode("posts").alias("t")).groupBy("t").count().agg(
        (F.sum(F.col("count") * F.col("count")) / F.sum("count")).alias("scan")).first().scan or 1.0

    def cost(x: int) -> float:
        enumerated = sum(k * sum(comb(n, needed(n, m)) for m in partners(n)) for n, k in count.items() if n <= x)
        indexed = sum(k * posted(n) for n, k in count.items() if x >= n >= partners(x + 1).start)
        return enumerated + indexed + sum(k * posted(n) * (1 + lists) for n, k in count.items() if n > x)

    return min(range(LIGHT_LIMIT + 1), key=lambda x: (cost(x), x))


def _light_links(light: DataFrame) -> DataFrame:
    """Edges (a, b) that join every pair of linked light classes into one
    component: the members of a subset's list are linked across (or within,
    for equal) sizes, so all of them with the smallest."""
    lists = light.select("class", "posts").mapInArrow(T.tidied(_light), "subset long, class long, n long, m long")
    heads = lists.groupBy("subset").agg(F.min("class").alias("head"), F.max("class").alias("last"),
                                        F.min("n").alias("low"), F.max("n").alias("high"), F.min("m").alias("least_m")) \
        .filter("head < last and (low < high or low = least_m)")
    return lists.select("subset", "class").join(heads.select("subset", "head"), "subset") \
        .filter("class <> head").select(F.col("head").alias("a"), F.col("class").alias("b")).distinct()


def _bits(rows: DataFrame, column: str) -> bytes:
    """Packed filter over the values of a long column, built by bitmap aggregates."""
    bit = F.col(column).bitwiseAND(F.lit(FILTER_BITS - 1)) + 1    # bitmap functions count from 1
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows.groupBy(F.bitmap_bucket_number(bit).alias("k")) \
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect():
        out[(r.k - 1) * 4096:r.k * 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    T.give_back()
    return out.tobytes()


def _in(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & (FILTER_BITS - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _rows_in(bits, column: str, wanted: bool):
    """Rows whose value is (or is not) in the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            hit = _in(table, batch.column(column).to_numpy())
            yield batch.filter(pa.array(hit == wanted))
    return run


def _postings(shared=None, wanted=None, copies=None, early=False):
    """(shingle, c, n, alone, hidden) of the first ``posted(n)`` shingles; with
    filters, of those in ``shared`` and ``wanted``; with ``copies``, of the classes not
    in it; ``early``: only those that a class needs as the smaller set of a link.
    alone, hidden: how many of the set's postings are not in ``shared``, and in it
    but not in ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, often, skip = [None if x is None else np.frombuffer(x.value, np.uint8) for x in (shared, wanted, copies)]
        for batch in batches:
            if skip is not None:
                batch = batch.filter(pa.array(~_in(skip, batch.column("class").to_numpy())))
            n = batch.column("n").to_numpy()
            posts = batch.column("posts")
            at = posts.offsets.to_numpy().astype(np.int64)
            take = np.minimum(n - -(-4 * n // 5) + 1, np.diff(at))
            past = np.cumsum(take)
            nth = np.arange(take.sum()) - np.repeat(past - take, take)
            shingle = posts.values.to_numpy()[np.repeat(at[:-1], take) + nth]

            def held(hit):
                upto = np.concatenate([[0], np.cumsum(hit)])
                return upto[past] - upto[past - take]

            hit = np.ones(len(shingle), bool) if some is None else _in(some, shingle)
            alone = take - held(hit)
            if often is not None:
                hit &= _in(often, shingle)
            hidden = take - alone - held(hit)
            if early:
                most = n - -(-8 * n // 9)       # of a smaller set's shingles, outside of the overlap
                hit &= nth <= np.repeat(most, take)
            columns = [shingle, *[np.repeat(x, take) for x in (batch.column("class").to_numpy(), n, alone, hidden)]]
            columns = [x[hit] for x in columns]
            for lo in range(0, len(columns[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + 100_000]) for x in columns],
                                                 names=["shingle", "c", "n", "alone", "hidden"])
    return run


def sets_of(texts: list[bytes]) -> list[np.ndarray]:
    """The sets of texts, a part at a time."""
    return [s for part in M.parts([t.lower() for t in texts]) for s in shingle_sets(part)]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose whole sets link."""
    for batch in batches:
        keep = []
        for lo in range(0, batch.num_rows, 64):
            x, y = [sets_of(batch.column(c).slice(lo, 64).cast(pa.binary()).to_pylist()) for c in ("text_a", "text_b")]
            keep += [9 * len(np.intersect1d(s, t, assume_unique=True)) >= 4 * (len(s) + len(t)) for s, t in zip(x, y)]
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The pairs(a, b) whose sets, read again from the texts, link."""
    pairs = handed_off(pairs, f"join-{name}-pairs")
    texts = M.texts_of(docs, classes, pairs.select(F.explode(F.array("a", "b")).alias("class")), f"join-{name}")
    both = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a") \
        .join(texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
    return handed_off(both.select("a", "b", "text_a", "text_b").mapInArrow(T.tidied(_linked), "a long, b long"), f"join-{name}-links")


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose marks allow a link."""
    for batch in batches:
        k = np.arange(batch.num_rows)
        marks = pa.concat_arrays([batch.column(c) for c in ("marks_a", "marks_b")])
        n = np.concatenate([batch.column(c).to_numpy() for c in ("n1", "n2")])     # only their sum counts
        yield batch.filter(pa.array(close(marks, n, k, k + batch.num_rows))).select(["a", "b"])


def _with_close_marks(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Of pairs(a, b, n1, n2), n1 and n2 being sizes of the two, those whose marks allow a link."""
    for side in "ab":
        pairs = pairs.join(marks.select(F.col("c").alias(side), F.col("marks").alias(f"marks_{side}")), side)
    return pairs.select("a", "b", "n1", "n2", "marks_a", "marks_b").mapInArrow(T.tidied(_close), "a long, b long")


#: an upper bound of the overlap of sets of n1 and n2 with ``shared`` common postings reaches the need: the set whose
#: last posting comes first in the order has all other common shingles behind its postings, and none that is alone
_FACTS = ("n", "alone", "hidden")
_SIZES = ("5 * least(n1, n2) >= 4 * greatest(n1, n2)"
          " and greatest(n1 - alone1, n2 - alone2) >= ceil(4 * (n1 + n2) / 9)")
_POSSIBLE = f"shared + greatest(ceil(4 * n1 / 5), ceil(4 * n2 / 5)) - 1 >= ceil(4 * (n1 + n2) / 9) and {_SIZES}"


def _marks(table: pa.Table, at: np.ndarray) -> pa.Array:
    return table.column("marks").combine_chunks().take(pa.array(at))


def _cluster_cells(table: pa.Table) -> pa.Table:
    """Links that join components, of the cells of clusters."""
    cell, is_left, rows, at = M.cell_rows(table)
    marks, raw = _marks(table, at), table.column("text")
    out: list[tuple[int, int]] = []
    for i, j in M.cells(cell, is_left):
        fits = M.comparable(rows, i, j)
        i, j = i[fits], j[fits]
        fits = close(marks, rows["n"], i, j)
        i, j = i[fits], j[fits]
        if len(i):
            need = np.unique(np.concatenate([i, j]))
            sets = M.places_of(sets_of(raw.take(pa.array(at[need])).cast(pa.binary()).to_pylist()))
            found = M.joining(np.searchsorted(need, i), np.searchsorted(need, j), sets, rows["comp"][need])
            out += [(int(rows["c"][need[x]]), int(rows["c"][need[y]])) for x, y in found]
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _list_cells(limit: int):
    """Pairs of the cells of lists, of different clusters, that can link."""
    def run(table: pa.Table) -> pa.Table:
        cell, is_left, rows, at = M.cell_rows(table, "cluster", "alone")
        marks, n = _marks(table, at), rows["n"]
        listed = n - rows["alone"]
        out = np.empty((2, 0), np.int64)
        for i, j in M.cells(cell, is_left):
            fits = M.comparable(rows, i, j) & (rows["cluster"][i] != rows["cluster"][j]) & (np.maximum(n[i], n[j]) > limit)
            fits &= np.maximum(listed[i], listed[j]) >= -(-4 * (n[i] + n[j]) // 9)
            i, j = i[fits], j[fits]
            fits = close(marks, n, i, j)
            a, b = rows["c"][i[fits]], rows["c"][j[fits]]
            # a pair shares many lists
            out = np.unique(np.concatenate([out, np.stack([np.minimum(a, b), np.maximum(a, b)])], axis=1), axis=1)
        return pa.table({"a": out[0], "b": out[1]})
    return run


def _short_pairs(placed: DataFrame, long: DataFrame, marks: DataFrame, limit: int) -> DataFrame:
    """Pairs of the short lists, of different clusters and components, that can link."""
    many = placed.join(long, "key", "left_semi").groupBy("c").agg(F.count(F.lit(1)).alias("many"))
    short = placed.join(long, "key", "left_anti").join(many, "c", "left") \
        .withColumn("hidden", F.col("hidden") + F.coalesce("many", F.lit(0)))
    x, y = [short.select("key", *[F.col(c).alias(f"{c}{k}") for c in ("c", *_FACTS, "cluster", "comp")]) for k in "12"]
    met = x.join(y, "key").filter(
        f"c1 < c2 and comp1 <> comp2 and cluster1 <> cluster2 and greatest(n1, n2) > {limit} and {_SIZES}")
    # a pair may share all that both have in long lists or in none
    found = met.groupBy("c1", "c2", *[f"{x}{k}" for k in "12" for x in _FACTS]).agg(F.count(F.lit(1)).alias("listed")) \
        .withColumn("shared", F.col("listed") + F.least("hidden1", "hidden2")).filter(_POSSIBLE) \
        .select(F.col("c1").alias("a"), F.col("c2").alias("b"), "n1", "n2")
    return _with_close_marks(found, marks)


def _heavy_links(docs: DataFrame, classes: DataFrame, sets: DataFrame, limit: int) -> list[DataFrame]:
    """Links of heavy classes by scanning inverted lists."""
    spark = docs.sparkSession
    indexed = sets.filter(F.col("n") >= partners(limit + 1).start).select("class", "n", "posts")
    # each class once: only sets of classes with copies are shuffled for it
    copies = spark.sparkContext.broadcast(_bits(classes.filter("copies > 1").select("class"), "class"))
    copied = handed_off(indexed.mapInArrow(T.tidied(_rows_in(copies, "class", True)), indexed.schema).dropDuplicates(["class"]),
                        "join-copied")

    def postings(*filters, early: bool = False) -> DataFrame:
        schema = "shingle long, c long, n long, alone long, hidden long"
        return indexed.mapInArrow(T.tidied(_postings(*filters, copies=copies, early=early)), schema) \
            .union(copied.mapInArrow(T.tidied(_postings(*filters, early=early)), schema))

    several = postings().groupBy("shingle").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    shared = spark.sparkContext.broadcast(_bits(several.select("shingle"), "shingle"))
    # linked sets share one of the first shingles of the smaller, whose overlap is 8/9 of it at least
    wanted = spark.sparkContext.broadcast(_bits(postings(shared, early=True), "shingle"))
    lists = handed_off(postings(shared, wanted), "join-lists")
    # one verification a class: against the pivot (of about its size) that it shares most lists with. A list's
    # pivot is the set that shares most of its postings: of edited copies, the original
    near = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.12))).alias("near")
    share = F.expr("1 - alone / (n - ceil(4 * n / 5) + 1)").alias("w")
    pivot = lists.groupBy("shingle", near).agg(F.max(F.struct(share, "c", "n", "alone", "hidden")).alias("p"), F.count(F.lit(1)).alias("k")) \
        .filter("k > 1").select("shingle", "near", F.col("p.c").alias("pivot"), *[F.col(f"p.{x}").alias(f"{x}2") for x in _FACTS])
    collide = handed_off(lists.select("shingle", "c", *[F.col(x).alias(f"{x}1") for x in _FACTS], near)
                         .join(pivot, ["shingle", "near"]).groupBy("c", "pivot", *[f"{x}{k}" for k in "12" for x in _FACTS])
                         .agg(F.count(F.lit(1)).alias("listed")).withColumn("shared", F.col("listed") + F.least("hidden1", "hidden2"))
                         .filter(f"c = pivot or {_POSSIBLE}"), "join-collide")
    marks = handed_off(sets.join(lists.select(F.col("c").alias("class")).distinct(), "class", "left_semi")
                       .select(F.col("class").alias("c"), "marks").dropDuplicates(["c"]), "join-marks")
    best = collide.filter(f"c <> pivot and greatest(n1, n2) > {limit}").groupBy("c") \
        .agg(F.max_by(F.struct("pivot", "n1", "n2"), F.struct("shared", "pivot")).alias("p")) \
        .select(F.col("p.pivot").alias("a"), F.col("c").alias("b"), "p.n1", "p.n2")
    read = docs.select(F.xxhash64("doc_id", F.xxhash64("text")).alias("rep"), "text")
    first = _verified(read, classes, _with_close_marks(best, marks), "first")
    comp = components(first, "join-first").select(F.col("node").alias("c"), "comp")
    # a class's cluster is the pivot that it shares most lists with, of those it can be similar to; what a cluster still holds in different
    # components meets in blocks that carry the texts
    clusters = handed_off(collide.groupBy("c").agg(F.max_by("pivot", F.struct("shared", "pivot")).alias("cluster"),
                                                   F.first("n1").alias("n")), "join-clusters")
    blocks = M.in_blocks(clusters.withColumnRenamed("cluster", "key"), comp, "join-blocks").join(marks, "c")
    texts = M.texts_of(read, classes, blocks.select(F.col("c").alias("class")), "join").withColumnRenamed("class", "c")
    inside = handed_off(M.met(blocks, texts, ["text", "marks"], GROUPS * M.groups(blocks), T.tidied_group(_cluster_cells)), "join-clustered")
    first = first.union(inside)
    comp = components(first, "join-clusters").select(F.col("node").alias("c"), "comp")
    # what one list still holds in different components, but for pairs of one cluster (a class without one is never a pivot)
    placed = handed_off(lists.withColumnRenamed("shingle", "key").join(clusters.select("c", "cluster"), "c", "left").join(comp, "c", "left")
                        .select("key", "c", *_FACTS, F.coalesce("cluster", "c").alias("cluster"), F.coalesce("comp", "c").alias("comp")),
                        "join-placed")
    long = handed_off(placed.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > SHORT).select("key"), "join-long")
    blocks = M.in_blocks(placed.drop("comp").join(long, "key"), comp, "join-lists-blocks")
    rest = M.met(blocks, marks, ["cluster", "alone", "marks"], GROUPS * M.groups(blocks), T.tidied_group(_list_cells(limit)))
    rest = rest.union(_short_pairs(placed, long, marks, limit)).distinct()
    return [first, _verified(read, classes, rest, "rest")]


def join(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), n_shingles, class, comp (of
    classes) and component_id of every row."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sets = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        T.tidied(_sets(frequent_shingles(docs))), "doc_id long, text_hash long, class long, n long, posts array<long>, marks binary")
    sets = handed_off(sets, "join-sets")
    classes = handed_off(sets.filter("n > 0").groupBy("class").agg(
        F.min("doc_id").alias("least"), F.min(F.xxhash64("doc_id", "text_hash")).alias("rep"),
        F.count(F.lit(1)).alias("copies")), "join-classes")
    small = handed_off(sets.filter(f"n between 1 and {LIGHT_LIMIT}").select("class", "n", "posts")
                       .dropDuplicates(["class"]), "join-small")
    limit = light_limit(small)
    edges = _light_links(small.filter(f"n <= {limit}"))
    for more in _heavy_links(docs, classes, sets, limit):
        edges = edges.union(more)
    comp = components(edges, "join").select(F.col("node").alias("class"), "comp")
    named = handed_off(classes.select("class", "least").join(comp, "class", "left")
                       .withColumn("comp", F.coalesce("comp", "class")), "join-named")
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of = named.select("class", "comp").join(least, "comp")
    whole = sets.filter("n > 0").select("doc_id", "text_hash", "n", "class").join(of, "class").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "class", "comp", "component_id")
    return whole.unionByName(sets.filter("n = 0").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("class"),
        F.lit(None).cast("long").alias("comp"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps one: the row
    with the smallest id (rows without id last); wordless rows all stay."""
    return under_plain_names({"doc_id", "text"}, _one_of_each, docs)


def _one_of_each(docs: DataFrame) -> DataFrame:
    found = handed_off(join(docs).filter("n_shingles > 0").select("doc_id", "text_hash", "comp"), "join-found")
    keep = found.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
                                     .alias("k")).select(F.col("k.doc_id").alias("__id"), F.col("k.text_hash").alias("__hash"))
    times = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("__times"))
    keep = keep.join(times, keep["__id"].eqNullSafe(times.doc_id) & (keep["__hash"] == times.text_hash)) \
        .select("__id", "__hash", "__times")
    text = F.col("text").cast("string")
    wordless = F.coalesce(~text.rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    kept = docs.filter(~wordless).join(keep, docs.doc_id.eqNullSafe(keep["__id"]) & (F.xxhash64(text) == keep["__hash"]))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = kept.filter("__times = 1").select(*columns)
    several = kept.filter("__times > 1").dropDuplicates(["__id", "__hash"]).select(*columns)
    return docs.filter(wordless).union(once).union(several)
