"""Best-fit packing of token pieces with swap-based local search.

Pieces are dealt to groups of about ``GROUP_PIECES`` rows whatever their keys;
inside a group best fit by decreasing length opens the bins, and a local
search then moves pieces between underfull bins (move, one for one, two for
one), each step raising the sum of squared fills, until bins empty.

Defined cases: null text is empty; an empty text is one piece that holds only
the end id; repeated rows are packed once each; an empty table gives no rows;
further input columns are ignored (ties between equal lengths are broken by
their order in the group).
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm import text as T
from tabforge.llm.common import handed_off

CAPACITY = 4096
END_ID = 1
#: pieces of one packing group: bounds a task's memory, and wastes at most about one sequence a group
GROUP_PIECES = 20_000
#: words the table of one task holds (about 40 bytes each)
CACHE_WORDS = 800_000
#: bytes of text that are encoded at a time; a longer text is encoded alone
ENCODED_BYTES = 1 << 18
#: new words of a string, and strings, that the tokenizer gets at a time
STRING_WORDS, STRINGS = 128, 4
SEARCH_ROUNDS = 2_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


_BLANK = np.zeros(256, bool)
_BLANK[list(b" \n\t\r")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?")] = True


class WordEncoder:
    """Token ids of whole texts, from a table of the words seen before.

    The tokenizer lower-cases and its splits never cross white space, so a
    text's ids are its blank-separated words' ids in a row (a mark after a
    letter, at a word's end, is a piece of its own). New words are encoded
    many to a string: a word of letters alone is one piece of the splitter, and
    only the last id of a piece carries the word-end mark.
    """

    WORD_END = "</w>"

    def __init__(self, path: str):
        # a task has one core; else every worker starts a thread, with a heap of its own, for each core of the machine
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        resize = getattr(self.tokenizer.model, "_resize_cache", None)
        if resize:      # the tokenizer's own table of words outlives it, in every thread; here a word is encoded once
            resize(0)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith(self.WORD_END)]] = True
        self.forget()

    def forget(self) -> None:
        self.hash = np.empty(0, T.U64)                    # sorted
        self.at = self.length = np.empty(0, np.int64)     # place in the pool of ids
        self.pool = np.empty(0, "<u4")

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _one_by_one(self, words: list[str]) -> list[np.ndarray]:
        size = STRING_WORDS * STRINGS
        return [x for k in range(0, len(words), size) for x in self._encoded(words[k:k + size])]

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids in a row)."""
        lists = [words[i:i + STRING_WORDS] for i in range(0, len(words), STRING_WORDS)]
        found = []
        for at in range(0, len(lists), STRINGS):      # the tokenizer's results are large: few at a time
            found += self._encoded([" ".join(x) for x in lists[at:at + STRINGS]])
        ids = np.concatenate(found) if found else np.empty(0, "<u4")
        past = np.flatnonzero(self.ends[ids]) + 1
        if [int(self.ends[x].sum()) for x in found] == [len(x) for x in lists]:
            return np.diff(past, prepend=0), ids
        found = self._one_by_one(words)
        return np.fromiter(map(len, found), np.int64, len(found)), np.concatenate(found)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        plain = np.fromiter(map(str.isalpha, words), bool, len(words))
        length = np.zeros(len(words), np.int64)
        parts = [self.pool]
        length[plain], ids = self._ids([w for w in words if w.isalpha()])
        parts.append(ids)
        rest = [w for w in words if not w.isalpha()]
        others = self._one_by_one(rest)
        length[~plain] = list(map(len, others))
        at = np.empty(len(words), np.int64)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        at[order] = len(self.pool) + np.cumsum(length[order]) - length[order]
        self.pool = np.concatenate([*parts, *others])
        where = np.searchsorted(self.hash, hashes)
        self.hash = np.insert(self.hash, where, hashes)
        self.at, self.length = np.insert(self.at, where, at), np.insert(self.length, where, length)

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        special = any(b"<|" in t for t in texts)    # lower-casing must not make a special token
        w = T.words(texts, _BLANK, lower=not special, marks=_MARKS)
        known, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
        if len(self.hash) > CACHE_WORDS:
            self.forget()
        place = np.searchsorted(self.hash, known)
        here = np.flatnonzero(place < len(self.hash))
        unseen = np.ones(len(known), bool)
        unseen[here] = self.hash[place[here]] != known[here]
        new = np.flatnonzero(unseen)
        if len(new):
            raw = w.data.tobytes()
            self._learn(known[new], [raw[a:b].decode() for a, b in
                                     zip(w.start[first[new]].tolist(), w.end[first[new]].tolist())])
        place = np.searchsorted(self.hash, known)[which]
        length = self.length[place]
        past = np.cumsum(length)
        ids = self.pool[np.repeat(self.at[place] - past + length, length) + np.arange(past[-1] if len(past) else 0)]
        return np.split(ids, np.cumsum(w.per_row(length))[:-1])


def _token_pieces(path: str, capacity: int):
    end = np.asarray([END_ID], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(path)      # of this task: the worker process serves other stages after it
        for batch in batches:
            doc_ids, rows = batch.column(0).to_pylist(), []
            for first, texts in T.blocks(batch.column(1), ENCODED_BYTES):
                for doc, ids in zip(doc_ids[first:first + len(texts)], encode(texts)):
                    ids = np.concatenate([ids, end])
                    for piece, lo in enumerate(range(0, len(ids), capacity)):
                        part = ids[lo:lo + capacity]
                        rows.append((doc, piece, lo, len(part), zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit by decreasing size: bins of item indices."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []   # (free, bin), sorted
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        k = bisect_left(room, (s, -1))
        if k < len(room):
            free, b = room.pop(k)
            bins[b].append(i)
        else:
            free, b = capacity, len(bins)
            bins.append([i])
        if free > s:
            insort(room, (free - s, b))
    return bins


def local_search(bins: list[list[int]], sizes: np.ndarray, capacity: int,
                 rounds: int = SEARCH_ROUNDS) -> list[list[int]]:
    """Empty the emptiest underfull bins by moves and swaps with fuller ones.

    A step is taken only if the fuller of two bins gets fuller still, which
    raises the sum of squared fills; a bin that no step helps any more is set
    aside. ``rounds`` bounds the number of donor bins that are tried.
    """
    size = sizes.tolist()
    fill = [sum(size[i] for i in b) for b in bins]
    open_bins = [b for b in range(len(bins)) if fill[b] < capacity]
    done: set[int] = set()
    for _ in range(rounds):
        left = [b for b in open_bins if bins[b] and b not in done and fill[b] < capacity]
        if len(left) < 2:
            break
        donor = min(left, key=lambda b: (fill[b], b))
        others = sorted((b for b in open_bins if bins[b] and b != donor and capacity > fill[b] >= fill[donor]),
                        key=lambda b: (capacity - fill[b], b))
        stepped = True
        while stepped and bins[donor] and others:
            stepped = False
            for b in others:
                if _step(bins, fill, size, donor, b, capacity):
                    stepped = True
                    break
            others = [b for b in others if fill[b] < capacity]
        done.add(donor)
    return [b for b in bins if b]


def _step(bins, fill, size, donor: int, b: int, capacity: int) -> bool:
    """One move, one-for-one or two-for-one exchange that makes bin b fuller."""
    gap, have = capacity - fill[b], sorted(bins[donor], key=lambda i: -size[i])
    for i in have:                                     # move
        if size[i] <= gap:
            _shift(bins, fill, size, donor, b, [i], [])
            return True
    inside = sorted(bins[b], key=lambda i: size[i])
    values = [size[i] for i in inside]
    for i in have:                                     # one for one: the smallest it can replace
        k = bisect_left(values, size[i] - gap)
        if k < len(inside) and values[k] < size[i]:
            _shift(bins, fill, size, donor, b, [i], [inside[k]])
            return True
    for x, i in enumerate(have[:32]):                  # two for one
        for j in have[x + 1:x + 33]:
            both = size[i] + size[j]
            k = bisect_left(values, both - gap)
            if k < len(inside) and values[k] < both:
                _shift(bins, fill, size, donor, b, [i, j], [inside[k]])
                return True
    return False


def _shift(bins, fill, size, donor, b, give, take) -> None:
    for i in give:
        bins[donor].remove(i)
        bins[b].append(i)
    for i in take:
        bins[b].remove(i)
        bins[donor].append(i)
    d = sum(size[i] for i in give) - sum(size[i] for i in take)
    fill[b] += d
    fill[donor] -= d


def _pack_group(capacity: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32", "length")])     # null ids last
        sizes, group = rows.column("length").to_numpy(), rows.column("_group")[0].as_py()
        bins = local_search(best_fit(sizes, capacity), sizes, capacity)
        sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        for n, b in enumerate(bins):
            sequence[b] = (group << 32) + n
            offset[b] = np.cumsum(sizes[b]) - sizes[b]
        return rows.drop_columns("_group").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every whole text."""
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(T.tidied(_token_pieces(tokenizer_path, capacity)), PIECES)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece with its sequence and the place in it."""
    pieces = handed_off(token_pieces(docs, tokenizer_path, capacity), "pack-pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int"))
    return dealt.groupBy("_group").applyInArrow(T.tidied_group(_pack_group(capacity)), PACKED)
