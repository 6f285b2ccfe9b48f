import hashlib
import random

import numpy as np
import pytest

from llm_helpers import by_id, collected
from tabforge.llm import suffix_dedup as S


def brute(rows, length=S.LENGTH):
    """By the definition: first place of every string, then covered bytes."""
    rows = [((S.LAST if d is None else d, h), d, (t or "").encode()) for d, h, t in rows]
    first = {}
    for key, _, t in rows:
        for i in range(len(t) - length + 1):
            w = t[i:i + length]
            first[w] = min(first.get(w, (key, i)), (key, i))
    out = []
    for key, doc, t in rows:
        cut = S.merged([(i, i + length) for i in range(len(t) - length + 1) if first[t[i:i + length]] < (key, i)])
        out.append((doc, len(t), sum(b - a for a, b in cut), len(cut), hashlib.sha256(S.kept_bytes(t, cut)).hexdigest()))
    return by_id(out)


def texts_of(docs):
    return collected(docs.selectExpr("doc_id", "xxhash64(doc_id, text) h", "text"), "doc_id", "h", "text")


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("hot", [20_000, 1])
def test_against_brute_force(awkward, small, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT_SEGMENTS", hot)
    for docs in (awkward, small):
        assert by_id(collected(S.deduplicate(docs), *COLUMNS)) == brute(texts_of(docs))


def test_many_small_shards(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_BYTES", 3000)
    r = random.Random(4)
    parts = ["".join(r.choice("abc é") for _ in range(r.randrange(60, 200))) for _ in range(12)]
    rows = [(r.randrange(50), "".join(r.choice(parts) for _ in range(r.randrange(1, 6)))) for _ in range(60)]
    rows += [(60, "ab" * 400), (61, "x" * 99), (62, "x" * 100), (63, "x" * 250), (64, "\0" * 150), (65, "\0" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert by_id(collected(S.deduplicate(docs), *COLUMNS)) == brute(texts_of(docs))


def test_empty(nothing):
    assert S.deduplicate(nothing).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_prefixes(seed):
    r = random.Random(seed)
    for sigma, n in ((1, 1), (1, 30), (2, 60), (3, 200), (26, 400), (200, 300), (400, 300)):
        t = np.array([r.randrange(1, sigma + 1) for _ in range(n)] * r.choice([1, 2]) + [0])
        raw = t.tolist()
        sa = S.suffix_array(t, sigma + 1)
        assert sa.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        want = [0]
        for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()):
            k = 0
            while raw[a + k] == raw[b + k]:
                k += 1
            want.append(min(k, 20))
        assert S.common_prefixes(t, sa, 20).tolist() == want


def test_segments_cover_every_string_once():
    raw = ("some text that goes on " * 9 + "x" * 300 + "end of it").encode()
    a, c, first, count = S.segments(raw)
    assert first[0] == 0 and (first[1:] == (first + count)[:-1]).all() and count.sum() == len(raw) - 99
    moved = S.segments(b"0123456789" + raw)
    strings = {raw[i:i + 100]: int(a[np.searchsorted(first, i, side="right") - 1]) for i in range(len(raw) - 99)}
    other = b"0123456789" + raw
    for i in range(len(other) - 99):
        if other[i:i + 100] in strings:
            assert strings[other[i:i + 100]] == moved[0][np.searchsorted(moved[2], i, side="right") - 1]
