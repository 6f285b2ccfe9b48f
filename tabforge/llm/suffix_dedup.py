"""Removal of repeated byte strings with suffix arrays by induced sorting.

A byte goes if a ``LENGTH``-byte string over it also starts earlier (smaller
document id, or the same document and an earlier start).

Shards. Equal strings must meet in one shard. In every string the ``GRAM``
bytes with the smallest hash (leftmost) are its anchor; equal strings have
equal anchors at equal offsets. Neighbouring strings with one anchor form a
segment, and segments are dealt to shards by the anchor's hash. Anchors that
occur once in all documents hold no repeats and are left out (a filter of
fixed size, built from exact counts); equal segments are combined before the
shuffle, so a hot copy is one segment.

In a shard. The different segments of an anchor are joined to one text; its
suffix array is built by induced sorting: suffixes are classified, leftmost-S
substrings are sorted by inducing and named, the string of names is sorted
recursively, and both passes induce the rest, bucket by bucket in vectorised
waves. Strings of names over a large alphabet are sorted by prefix doubling.
Permuted common prefixes come from the irreducible ones; suffixes that share
``LENGTH`` bytes stand together, and all but the earliest are repeats.

An anchor with more than ``HOT_SEGMENTS`` different segments is dealt string
by string instead, grouped by the strings' hashes, so no task holds it whole.

Defined cases: null text is empty; a null id comes after all others; repeated
rows are one document and get equal results; rows of one id with different
texts are documents of their own, in the order of a hash of id and text; texts under ``LENGTH`` bytes are never cut; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm import text as T
from tabforge.llm.common import handed_off
from tabforge.llm.decontam import suffix_array as doubling_array

LENGTH = 100
GRAM = 32
#: text of one shard
SHARD_BYTES = 1 << 20
HOT_SEGMENTS = 20_000
#: bits of the broadcast filters
FILTER_BITS = 1 << 27
#: strings whose anchors are found at once; places inside take the low PLACE_BITS of a hash
CHUNK = 1 << 22
PLACE_BITS = 24
#: largest alphabet that is induced bucket by bucket
BUCKETS = 512
LAST = (1 << 63) - 1


# ---------------------------------------------------------------- suffix array

def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S-type)."""
    n = len(t)
    step = np.sign(np.diff(t.astype(np.int64), append=-1))
    at = np.where(step != 0, np.arange(n), n)
    right = np.minimum.accumulate(at[::-1])[::-1]
    s = step[np.minimum(right, n - 1)] > 0
    s[-1] = True
    return s


def _put(sa, place, pred, chars, step):
    """Append ``pred`` to the buckets of its characters, in order."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    first = np.concatenate([[True], c[1:] != c[:-1]])
    begin = np.flatnonzero(first)
    inside = np.arange(len(c)) - np.repeat(begin, np.diff(np.append(begin, len(c))))
    sa[place[c] + step * inside] = pred[order]
    place[c[begin]] += step * np.diff(np.append(begin, len(c)))


def _induce(t: np.ndarray, s_type: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """Suffix array slots induced from the sorted (or merely bucketed) ``lms``."""
    n = len(t)
    count = np.bincount(t, minlength=k)
    head = np.cumsum(count) - count
    tail = head + count - 1
    sa = np.full(n, -1, np.int64)
    used = np.flatnonzero(count)
    order = np.argsort(t[lms], kind="stable")
    mine = lms[order]                                     # leftmost-S suffixes by bucket
    bound = np.searchsorted(t[mine], np.arange(k + 1))
    place = head.copy()
    for c in used.tolist():                               # larger types, left to right
        wave, at = None, int(head[c])
        while True:
            if int(place[c]) > at:
                wave, at = sa[at:int(place[c])], int(place[c])
                last = False
            else:
                wave, last = mine[bound[c]:bound[c + 1]], True
            pred = wave[wave > 0] - 1
            pred = pred[~s_type[pred]]
            if len(pred):
                _put(sa, place, pred, t[pred], 1)
            if last:
                break
    place = tail.copy()
    larger_end = np.zeros(k, np.int64)
    np.add.at(larger_end, t[~s_type], 1)
    larger_end += head                                    # past the larger types of each bucket
    for c in used[::-1].tolist():                         # smaller types, right to left
        at = int(tail[c])
        while int(place[c]) < at:
            wave, at = sa[int(place[c]) + 1:at + 1][::-1], int(place[c])
            pred = wave[wave > 0] - 1
            pred = pred[s_type[pred]]
            if len(pred):
                _put(sa, place, pred, t[pred], -1)
        wave = sa[head[c]:larger_end[c]][::-1]
        pred = wave[wave > 0] - 1
        pred = pred[s_type[pred]]
        if len(pred):
            _put(sa, place, pred, t[pred], -1)
    sa[0] = n - 1                                         # the sentinel is smallest
    return sa


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of symbols 0..k-1; t ends with its only 0."""
    n = len(t)
    if n <= 2:
        return np.arange(n - 1, -1, -1)
    if k > BUCKETS:
        return doubling_array(t)
    s_type = _types(t)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    if len(lms) <= 1:
        return _induce(t, s_type, lms, k)
    rough = _induce(t, s_type, lms, k)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by_substring = rough[is_lms[rough]]
    # names: equal substrings (up to the next leftmost-S place, included) get equal names
    past = np.append(lms[1:] + 1, n)
    wide = t.astype(np.uint8) if k <= 256 else np.ascontiguousarray(t, "<u2").view(np.uint8)
    width = 1 if k <= 256 else 2
    key = T.span_hash(T.prefix_hash(wide), lms * width, past * width)
    index = np.empty(n, np.int64)
    index[lms] = np.arange(len(lms))
    sorted_key = key[index[by_substring]]
    name = np.empty(len(lms), np.int64)
    name[index[by_substring]] = np.cumsum(np.concatenate([[False], sorted_key[1:] != sorted_key[:-1]]))
    names = int(name.max()) + 1
    order = np.argsort(name) if names == len(lms) else suffix_array(name, names)
    return _induce(t, s_type, lms[order], k)


def common_prefixes(t: np.ndarray, sa: np.ndarray, most: int, begin: np.ndarray | None = None) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``sa``, at most
    ``most``, through permuted common prefixes.

    A prefix is reducible if its neighbour's begins one place earlier: it is
    then one shorter. The irreducible ones are measured by binary search over
    equal hashes. ``begin`` (starts of the texts in ``t``) bounds the search:
    prefixes are followed anew from each start, to the end of the text and no
    further, which is exact for prefixes inside a text."""
    n = len(t)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = n - 1                       # compares unequal: the sentinel alone
    begin = np.zeros(1, np.int64) if begin is None else begin
    longest = int(np.diff(np.append(begin, n)).max())
    irreducible = np.ones(n, bool)
    irreducible[1:] = (t[:-1] != t[before[1:] - 1]) | (before[1:] == 0)
    irreducible[sa[0]] = irreducible[begin] = True
    if sa[0] + 1 < n:
        irreducible[sa[0] + 1] = True
    at = np.flatnonzero(irreducible)
    width = 1 if t.max() < 256 else 2
    sums = T.prefix_hash(t.astype(np.uint8) if width == 1 else np.ascontiguousarray(t, "<u2").view(np.uint8))
    low = np.zeros(len(at), np.int64)
    a, b = at, before[at]
    room = n - np.maximum(a, b)
    step = 1 << max(min(int(room.max()), longest).bit_length() - 1, 0)
    while step:
        ok = np.flatnonzero(low + step <= room)
        x, y, m = a[ok] + low[ok], b[ok] + low[ok], step * width
        same = (T.raw_span(sums, x * width, x * width + m) == T.raw_span(sums, y * width, y * width + m))
        low[ok[same]] += step
        step >>= 1
    low[at == sa[0]] = 0
    i = np.arange(n)
    anchor = np.maximum.accumulate(np.where(irreducible, i, 0))
    place = np.zeros(n, np.int64)
    place[at] = low
    permuted = np.maximum(place[anchor] - (i - anchor), 0)
    permuted[sa[0]] = 0
    return np.minimum(permuted[sa], most)


def repeats(texts: list[bytes], doc: np.ndarray, start: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(text number, offset) of every string in ``texts`` that has an earlier
    equal; text k stands at byte start[k] of document doc[k]."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size + 1) - size - 1
    body = np.frombuffer(b"\0".join(texts) + b"\0\0", np.uint8).astype(np.int64) + 2
    body[begin + size] = 1                      # between texts
    body[-1] = 0
    sa = suffix_array(body, 258)
    lcp = common_prefixes(body, sa, length, begin)
    text = np.repeat(np.arange(len(texts)), np.diff(np.append(begin, len(body))))
    whole = sa - begin[text[sa]] + length <= size[text[sa]]
    follows = (lcp >= length) & whole
    meets = follows.copy()                      # members of runs of two or more
    meets[:-1] |= follows[1:]
    run = np.cumsum(~follows)[meets]
    at = sa[meets]
    number = text[at]
    offset = at - begin[number]
    d, s = doc[number], start[number] + offset
    order = np.lexsort((s, d, run))
    run, d, s, number, offset = run[order], d[order], s[order], number[order], offset[order]
    first = np.concatenate([[True], run[1:] != run[:-1]]) if len(run) else np.empty(0, bool)
    lead = np.maximum.accumulate(np.where(first, np.arange(len(run)), 0)) if len(run) else np.empty(0, np.int64)
    later = (d > d[lead]) | ((d == d[lead]) & (s > s[lead]))
    return number[later], offset[later]


# ---------------------------------------------------------------- segments

_MIX = T._SEEDS[16:16 + GRAM // 8]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at every place, from its 8-byte words."""
    n = len(data) - GRAM + 1
    word = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    total = word[:n] * _MIX[0]
    for k in range(1, GRAM // 8):
        total += word[8 * k:8 * k + n] * _MIX[k]
    return T.mix(total)


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(place of the anchor of every string, gram hashes of the text).

    A hash gives its low bits to the place, so the minimum of a string's
    hashes is its leftmost smallest one."""
    h = gram_hashes(data)
    size, low = length - GRAM + 1, T.U64((1 << PLACE_BITS) - 1)
    out = []
    for at in range(0, len(h) - size + 1, CHUNK):
        part = h[at:at + CHUNK + size - 1]
        best = (part & ~low) | np.arange(len(part), dtype=T.U64)
        span = 1
        while span < size:
            step = min(span, size - span)
            best = np.minimum(best[:-step], best[step:])
            span += step
        out.append((best & low).astype(np.int64) + at)
    return np.concatenate(out), h


def segments(raw: bytes, length: int = LENGTH, contents: bool = True) -> tuple[np.ndarray, ...]:
    """(anchor hash, content hash, first string, number of strings) of a text."""
    data = np.frombuffer(raw, np.uint8)
    n = len(data) - length + 1
    if n <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, none
    anchor, h = anchors(data, length)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.append(first, n))
    key = h[anchor[first]].view(np.int64)
    if not contents:
        return key, key, first, count
    return key, T.span_hash(T.prefix_hash(data), first, first + count + length - 1).view(np.int64), first, count


def _each(batch: pa.RecordBatch, contents: bool = True):
    """(row, text, anchor, content, first, count) of the rows with segments."""
    for lo, texts in T.blocks(batch.column("text")):
        for r, raw in enumerate(texts, lo):
            if len(raw) >= LENGTH:
                yield (r, raw, *segments(raw, contents=contents))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [a for _, _, a, *_ in _each(batch, False)]
        if found:
            a, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(n)], names=["anchor", "n"])


def _in(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & (FILTER_BITS - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _bits(rows: DataFrame, column: str) -> bytes:
    """Packed filter over the values of a long column, built by bitmap aggregates."""
    bit = F.col(column).bitwiseAND(F.lit(FILTER_BITS - 1)) + 1        # bitmap functions count from 1
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows.groupBy(F.bitmap_bucket_number(bit).alias("k")) \
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).toLocalIterator():
        out[(r.k - 1) * 4096:r.k * 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    return out.tobytes()


_ROWS = "anchor long, content long, rid long, doc long, start long, n long"


def _occurrences(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            rid, doc = batch.column("rid").to_numpy(), batch.column("doc").to_numpy()
            parts = []
            for r, _, a, c, first, count in _each(batch):
                keep = _in(wanted, a)
                k = int(keep.sum())
                if k:
                    parts.append((a[keep], c[keep], np.full(k, rid[r]), np.full(k, doc[r]), first[keep], count[keep]))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)],
                                                 names=["anchor", "content", "rid", "doc", "start", "n"])
    return run


def _contents(rows, bits):
    """The bytes of the wanted segments of the wanted rows, once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = np.frombuffer(bits.value, np.uint8), set()
        wanted_rows = np.frombuffer(rows.value, np.uint8)
        for batch in batches:
            batch = batch.filter(pa.array(_in(wanted_rows, batch.column("rid").to_numpy())))
            keys, texts = [], []
            for _, raw, _, c, first, count in _each(batch):
                for k in np.flatnonzero(_in(wanted, c)).tolist():
                    key = int(c[k])
                    if key not in seen:
                        seen.add(key)
                        keys.append(key)
                        texts.append(raw[int(first[k]):int(first[k] + count[k]) + LENGTH - 1])
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.binary())],
                                                 names=["content", "bytes"])
    return run


_SPANS = "rid long, start long, past long"


def _shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    texts, start = list(rows["bytes"]), rows["start"].to_numpy()
    document = pd.MultiIndex.from_frame(rows[["doc", "rid"]]).factorize(sort=True)[0]
    number, offset = repeats(texts, document, start)
    return pd.DataFrame(_joined(rows["rid"].to_numpy()[number], start[number] + offset), columns=["rid", "start", "past"])


def _joined(rid: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Spans (rid, start, past) over repeated strings that start at ``at``."""
    order = np.lexsort((at, rid))
    rid, at = rid[order], at[order]
    if not len(rid):
        return np.empty((0, 3), np.int64)
    new = np.concatenate([[True], (rid[1:] != rid[:-1]) | (at[1:] > at[:-1] + LENGTH)])
    first = np.flatnonzero(new)
    return np.stack([rid[first], at[first], at[np.append(first[1:], len(at)) - 1] + LENGTH], axis=1)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per string of the hot anchors' segments."""
    for batch in batches:
        for raw, rid, doc, start in zip(*[batch.column(c).to_pylist() for c in ("bytes", "rid", "doc", "start")]):
            data = np.frombuffer(raw, np.uint8)
            at = np.arange(len(data) - LENGTH + 1)
            h = T.span_hash(T.prefix_hash(data), at, at + LENGTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(np.full(len(at), rid)), pa.array(np.full(len(at), doc)),
                 pa.array(at + start)], names=["string", "rid", "doc", "start"])


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(rid, start, past) of repeated bytes, from texts(rid, doc, text)."""
    spark = texts.sparkSession
    counted = texts.select("text").mapInArrow(T.tidied(_anchors), "anchor long, n long").groupBy("anchor") \
        .agg(F.sum("n").alias("n")).filter("n > 1")
    bits = spark.sparkContext.broadcast(_bits(counted, "anchor"))
    found = handed_off(texts.mapInArrow(T.tidied(_occurrences(bits)), _ROWS), "dedup-segments")
    firsts = found.groupBy("content").agg(
        F.min(F.struct("doc", "rid", "start", "n", "anchor")).alias("f")).select("content", "f.*")
    firsts = handed_off(firsts, "dedup-firsts")
    lead = firsts.select("content", F.struct("doc", "rid", "start").alias("lead"))
    copies = found.join(lead, "content").filter("struct(doc, rid, start) > lead") \
        .select("rid", "start", (F.col("start") + F.col("n") + LENGTH - 1).alias("past"))
    # segments that differ but share an anchor
    several = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    mixed = handed_off(firsts.join(several, "anchor"), "dedup-mixed")
    want = spark.sparkContext.broadcast(_bits(mixed, "content"))
    holders = spark.sparkContext.broadcast(_bits(mixed, "rid"))
    content = texts.select("rid", "text").mapInArrow(T.tidied(_contents(holders, want)), "content long, bytes binary") \
        .dropDuplicates(["content"])
    mixed = handed_off(mixed.join(content, "content"), "dedup-texts")
    total = mixed.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    cool = mixed.filter(F.col("kinds") <= HOT_SEGMENTS).withColumn("shard", F.pmod("anchor", F.lit(shards)))
    by_array = cool.select("shard", "bytes", "rid", "doc", "start").groupBy("shard").applyInPandas(_shard, _SPANS)
    strings = mixed.filter(F.col("kinds") > HOT_SEGMENTS).select("bytes", "rid", "doc", "start").mapInArrow(
        T.tidied(_strings), "string long, rid long, doc long, start long")
    least = strings.groupBy("string").agg(F.min(F.struct("doc", "rid", "start")).alias("lead"))
    by_string = strings.join(least, "string").filter("struct(doc, rid, start) > lead") \
        .select("rid", "start", (F.col("start") + LENGTH).alias("past"))
    return copies.union(by_array).union(by_string)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``raw`` without merged spans."""
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def _plain(bits):
    """Rows without repeats get their result; the text of others goes on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            rid = batch.column("rid")
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            cut = _in(wanted, rid.to_numpy()).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), rid, pa.array(list(map(len, texts)), pa.int64()),
                 pa.array([None if c else hashlib.sha256(t).hexdigest() for t, c in zip(texts, cut)], pa.string()),
                 pa.array([t if c else None for t, c in zip(texts, cut)], pa.binary())],
                names=["doc_id", "rid", "n_bytes", "kept_sha256", "raw"])
    return run


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, n, sha, raw, spans in zip(*[batch.column(c).to_pylist() for c in
                                             ("doc_id", "n_bytes", "kept_sha256", "raw", "spans")]):
            cut = merged([(s["start"], s["past"]) for s in spans or ()])
            if raw is not None:
                sha = hashlib.sha256(kept_bytes(raw, cut)).hexdigest()
            rows.append((doc, n, sum(b - a for a, b in cut), len(cut), sha))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [*[pa.int64()] * 4, pa.string()])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    text = F.col("text").cast("string")
    texts = docs.select("doc_id", F.xxhash64("doc_id", text).alias("rid"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), text.alias("text"))
    spans = repeated_spans(texts.select("rid", "doc", "text")).groupBy("rid").agg(
        F.collect_set(F.struct("start", "past")).alias("spans"))
    spans = handed_off(spans, "dedup-spans")
    bits = docs.sparkSession.sparkContext.broadcast(_bits(spans, "rid"))
    plain = texts.select("doc_id", "rid", "text").mapInArrow(
        T.tidied(_plain(bits)), "doc_id long, rid long, n_bytes long, kept_sha256 string, raw binary")
    return plain.join(spans, "rid", "left").select("doc_id", "n_bytes", "kept_sha256", "raw", "spans") \
        .mapInArrow(T.tidied(_finish), _OUT)
