"""Benchmark decontamination with an FM-index per training shard.

A shard is a block of whole documents inside a task (bounded bytes). Its words
become symbols: words that occur in no benchmark window separate the text, as
no window can cover them. Over the symbols the task builds a suffix array
(prefix doubling, refining only unsettled groups), the Burrows-Wheeler
transform and a wavelet matrix. All windows are backward-searched at once
through wavelet ranks, occurrences are located by walking to sampled suffix
positions, and the located windows merge into removal spans.

The benchmark is read in blocks of ``ITEM_BLOCK`` items; each block is one pass
over the documents without a shuffle, and passes add to the same spans.

Defined cases: null text or item text has no words; an item whose id is null
hits like any other, and only the ids reported lack it; repeated rows and
repeated items count once each where ids are reported; an empty benchmark leaves every document clean; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm import text as T
from tabforge.llm.common import under_plain_names, text_batches

WINDOW = 10
ITEM_BLOCK = 20_000
SAMPLE = 16
SHARD_BYTES = 1 << 20

SPANS = "array<struct<first:int,past:int>>"


@dataclass
class Phrases:
    """Windows of one block of benchmark items, as word symbols 1.. of ``vocabulary``."""

    vocabulary: np.ndarray        # sorted word hashes; symbol = place + 1
    symbols: np.ndarray           # distinct windows x WINDOW, padded with 0 on the right
    length: np.ndarray
    owner_start: np.ndarray       # of each window, into owner
    owner: np.ndarray             # item numbers
    items: list[str]


def phrases(rows: list[tuple[str | None, str | None]], window: int = WINDOW) -> Phrases:
    """Windows of (item id, text) rows; a shorter item is one window. A null id
    owns none of its windows."""
    names = sorted({i for i, _ in rows if i is not None})
    number = {n: k for k, n in enumerate(names)}
    w = T.words([(t or "").encode() for _, t in rows], T.NOT_ALNUM, lower=True)
    first = w.first()
    found: dict[bytes, set[int]] = {}
    vocabulary = np.unique(w.hash)
    symbol = (np.searchsorted(vocabulary, w.hash) + 1).astype(np.int32)
    for k, (item, _) in enumerate(rows):
        s = symbol[first[k]:first[k + 1]]
        for at in range(max(1, len(s) - window + 1) if len(s) else 0):
            owners = found.setdefault(s[at:at + window].tobytes(), set())
            if item is not None:
                owners.add(number[item])
    keys = sorted(found)
    symbols = np.zeros((len(keys), window), np.int32)
    length = np.zeros(len(keys), np.int64)
    for k, key in enumerate(keys):
        s = np.frombuffer(key, np.int32)
        symbols[k, :len(s)], length[k] = s, len(s)
    owners = [sorted(found[k]) for k in keys]
    start = np.concatenate([[0], np.cumsum([len(o) for o in owners])]).astype(np.int64)
    return Phrases(vocabulary, symbols, length, start, np.asarray([x for o in owners for x in o], np.int64), names)


def suffix_array(sym: np.ndarray) -> np.ndarray:
    """Suffix array of symbols where every 0 is a separator of its own
    (smaller than all words, ordered by position); sym ends with 0."""
    n = len(sym)
    order = np.argsort(sym, kind="stable")
    s = sym[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    new[s == 0] = True
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    size = np.bincount(rank, minlength=n)
    open_ = np.flatnonzero(size[rank] > 1)
    h = 1
    while len(open_):
        key = rank[open_] * n + rank[open_ + h]
        o = np.argsort(key)
        k, at = key[o], open_[o]
        i = np.arange(len(k))
        old = rank[at]
        old_first = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), i, 0))
        cut = np.concatenate([[True], k[1:] != k[:-1]])
        new_first = np.maximum.accumulate(np.where(cut, i, 0))
        rank[at] = old + new_first - old_first
        single = cut & np.concatenate([cut[1:], [True]])
        open_ = at[~single]
        h *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    return sa


class FmIndex:
    """FM-index of a symbol text whose zeros are separators."""

    def __init__(self, sym: np.ndarray, sigma: int):
        n = len(sym)
        sa = suffix_array(sym)
        self.bwt = sym[sa - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sym, minlength=sigma + 1))]).astype(np.int64)
        # wavelet matrix: per bit the running number of ones, stably partitioned downwards
        self.bits = max(1, int(sigma).bit_length())
        self.ones, self.zeros = [], []
        cur = self.bwt
        for b in range(self.bits - 1, -1, -1):
            one = (cur >> b) & 1 == 1
            run = np.zeros(n + 1, np.int32)
            np.cumsum(one, out=run[1:])
            self.ones.append(run)
            self.zeros.append(n - int(run[-1]))
            cur = np.concatenate([cur[~one], cur[one]])
        # sampled suffix positions; a run's first word is sampled too, so walks never cross a separator
        self.sampled = (sa % SAMPLE == 0) | (self.bwt == 0)
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.sample = sa[self.sampled]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of c in bwt[:i]."""
        i, start = i.copy(), np.zeros_like(i)
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            one = (c >> b) & 1 == 1
            ones, zeros = self.ones[level], self.zeros[level]
            oi, os = ones[i], ones[start]
            i = np.where(one, zeros + oi, i - oi)
            start = np.where(one, zeros + os, start - os)
        return i - start

    def search(self, symbols: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array intervals of all patterns, by backward search."""
        lo = np.zeros(len(length), np.int64)
        hi = np.full(len(length), len(self.bwt), np.int64)
        for k in range(symbols.shape[1] - 1, -1, -1):
            on = np.flatnonzero((length > k) & (lo < hi))
            if len(on):
                c = symbols[on, k]
                lo[on] = self.first[c] + self.rank(c, lo[on])
                hi[on] = self.first[c] + self.rank(c, hi[on])
        return lo, np.maximum(lo, hi)

    def locate(self, i: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array places."""
        i, steps = i.copy(), np.zeros(len(i), np.int64)
        todo = np.flatnonzero(~self.sampled[i])
        while len(todo):
            c = self.bwt[i[todo]]
            i[todo] = self.first[c] + self.rank(c, i[todo])
            steps[todo] += 1
            todo = todo[~self.sampled[i[todo]]]
        return self.sample[self.sample_rank[i]] + steps


def find(w: T.Words, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, past word, window number) of every occurrence in a shard."""
    none = np.empty(0, np.int64)
    if not len(p.length) or not len(w.hash):
        return none, none, none
    at = np.searchsorted(p.vocabulary, w.hash)
    at[at == len(p.vocabulary)] = 0
    known = p.vocabulary[at] == w.hash
    place = np.flatnonzero(known)
    if not len(place):
        return none, none, none
    # runs of known words, one separator between two and at both ends
    apart = np.ones(len(place), bool)
    apart[1:] = (np.diff(place) > 1) | (w.row[place[1:]] != w.row[place[:-1]])
    to = np.arange(len(place)) + np.cumsum(apart)
    sym = np.zeros(to[-1] + 2, np.int32)
    sym[to] = at[place] + 1
    word = np.zeros(len(sym), np.int64)
    word[to] = place
    index = FmIndex(sym, len(p.vocabulary))
    lo, hi = index.search(p.symbols, p.length)
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    if not len(which):
        return none, none, none
    inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    first = word[index.locate(lo[which] + inside)]
    return first, first + p.length[which], which


def _cut(raw: bytes, spans: list[dict]) -> str:
    """The text without the words of the spans; other bytes stay."""
    w = T.words([raw], T.NOT_ALNUM, lower=True)
    out, at = [], 0
    for x in sorted(spans, key=lambda x: x["first"]):
        lo, hi = int(w.start[x["first"]]), int(w.end[x["past"] - 1])
        out.append(raw[at:max(at, lo)])
        at = max(at, hi)
    return b"".join([*out, raw[at:]]).decode()


def _pass(p: Phrases, cut: bool = False):
    """One block of items: add occurrences to ``spans`` and ``items``;
    ``cut``: take the words of all spans out of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for lo, texts in T.blocks(batch.column("text"), SHARD_BYTES):
                w = T.words(texts, T.NOT_ALNUM, lower=True)
                part = batch.slice(lo, len(texts))
                first, past, which = find(w, p)
                spans, items = part.column("__spans").to_pylist(), part.column("__items").to_pylist()
                if len(first):
                    base, row = w.first(), w.row[first]
                    order = np.lexsort((first, row))
                    for k in order.tolist():
                        r = int(row[k])
                        a, b = int(first[k] - base[r]), int(past[k] - base[r])
                        have = spans[r]
                        if have and have[-1]["first"] <= a <= have[-1]["past"]:
                            have[-1]["past"] = max(b, have[-1]["past"])
                        else:
                            have.append({"first": a, "past": b})
                    grown = p.owner_start[which + 1] - p.owner_start[which]
                    at = np.repeat(p.owner_start[which], grown) + np.arange(grown.sum()) - np.repeat(
                        np.cumsum(grown) - grown, grown)
                    for r, k in set(zip(np.repeat(row, grown).tolist(), p.owner[at].tolist())):
                        items[r].append(p.items[k])
                columns = {"__spans": pa.array(spans, part.schema.field("__spans").type),
                           "__items": pa.array(items, part.schema.field("__items").type),
                           "__n_words": pa.array(np.diff(w.first()))}
                if cut and any(spans):
                    columns["text"] = pa.array([_cut(t, s) if s else old for t, s, old in
                                                zip(texts, spans, part.column("text").to_pylist())], pa.string())
                yield pa.RecordBatch.from_arrays([columns[c] if c in columns else part.column(k) for k, c in enumerate(names)],
                                                 schema=batch.schema)
    return run


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                item_block: int = ITEM_BLOCK, cut: bool = False) -> DataFrame:
    """``docs`` (with ``cut``: without the words that are hit) with __n_words,
    __spans (word intervals, merged within a pass) and __items. Items without an
    id are searched like all others; only the list of ids lacks them. Columns of
    ``docs`` of these names give way (``remove`` keeps them)."""
    text_batches(docs.sparkSession)
    docs = docs.drop("__n_words", "__spans", "__items")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string")).distinct()
    block_count = max(1, -(-items.count() // item_block))
    out = docs.select("*", F.lit(0).cast("long").alias("__n_words"), F.array().cast(SPANS).alias("__spans"),
                      F.array().cast("array<string>").alias("__items"))
    for k in range(block_count):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(block_count)) == k
        rows = [(r.item_id, r.text) for r in items.filter(mine).collect()]
        out = out.mapInArrow(T.tidied(_pass(phrases(rows, window), cut and k == block_count - 1)), out.schema)
        del rows
        T.give_back()
    return out


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    merged = F.aggregate(
        F.array_sort("__spans"),
        F.struct(F.lit(0).alias("past"), F.lit(0).cast("long").alias("hit")),
        lambda s, x: F.struct(F.greatest(s["past"], x["past"]).alias("past"),
                              (s["hit"] + F.greatest(F.lit(0), x["past"] - F.greatest(s["past"], x["first"])))
                              .alias("hit")),
        lambda s: s["hit"])
    ids = F.array_sort(F.array_distinct("__items"))
    return found.select("doc_id", F.col("__n_words").alias("n_words"), merged.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256")) \
        .withColumn("contaminated", F.col("n_hit") > 0)


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the words of any benchmark window; clean rows unchanged."""
    return under_plain_names({"text", "n_chars"}, lambda d: _removed(d, benchmark), docs)


def _removed(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    hit = F.size("__spans") > 0
    return occurrences(docs, benchmark, cut=True).select(*[F.when(hit, F.length("text")).otherwise(F.col(c)).cast(t).alias(c) if c == "n_chars"
                        else F.col(f"`{c}`") for c, t in docs.dtypes])
