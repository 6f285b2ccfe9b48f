import math
from collections import Counter

import numpy as np
import pytest

from llm_helpers import by_id, collected
from tabforge.llm import kn_quality as K


def brute_model(train: list[bytes], order: int):
    """p(gram) by the definition, over plain dictionaries."""
    c = {order: Counter()}
    for t in train:
        s = K._PAD * (order - 1) + t
        c[order].update(s[i - order + 1:i + 1] for i in range(order - 1, len(s)))
    for k in range(order - 1, 0, -1):
        c[k] = Counter(g[1:] for g in c[k + 1])
    d = {k: K._discounts([sum(v == i for v in c[k].values()) for i in range(1, 5)]) for k in c}
    total, saved = Counter(), Counter()
    for k in c:
        for g, n in c[k].items():
            total[k, g[:-1]] += n
            saved[k, g[:-1]] += d[k][min(n, 3) - 1]

    def p(g):
        k = len(g)
        low = p(g[1:]) if k > 1 else 1 / 256
        n, t = c[k][g], total[k, g[:-1]]
        return (n - (d[k][min(n, 3) - 1] if n else 0) + saved[k, g[:-1]] * low) / t if t else low
    return p


@pytest.mark.parametrize("order", [2, 5])
def test_probabilities(spark, awkward, order):
    rows = [(r.text, bool(r.doc_id and r.doc_id % 3)) for r in awkward.collect() if len(r.text or "") < 9000]
    texts = spark.createDataFrame(rows, "text string, trains boolean")
    p = brute_model([t.encode() for t, x in rows if t and x], order)
    got = K.probabilities(K.gram_counts(texts, order), order).collect()
    asked = {(K._PAD * (order - 1) + t.encode())[i:i + order] for t, _ in rows if t for i in range(len(t.encode()))}
    assert {r.gram.to_bytes(order, "big") for r in got} == asked
    assert all(math.isclose(r.p, p(r.gram.to_bytes(order, "big")), rel_tol=1e-9) for r in got)


@pytest.mark.parametrize("shard", [2_000_000, 300])
def test_perplexity_and_thresholds(spark, small, shard):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    out = K.classify(small, labels, shard_grams=shard).collect()
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    import zlib
    kept_out = {i for i in trusted if zlib.crc32(str(i).encode()) % 4 == 3}
    text = {r.doc_id: (r.text or "").encode() for r in small.collect()}
    p = brute_model([text[i] for i in trusted - kept_out if i in text], K.ORDER)
    assert len(out) == len(text)
    for r in out[:25]:
        s = K._PAD * (K.ORDER - 1) + text[r.doc_id]
        ll = sum(math.log(p(s[i:i + K.ORDER])) for i in range(len(text[r.doc_id])))
        assert math.isclose(r.perplexity, math.exp(-ll / len(text[r.doc_id])), rel_tol=1e-4)
    for lang in {r.lang for r in out}:
        held = sorted(r.perplexity for r in out if r.lang == lang and r.doc_id in kept_out)
        if held:
            cut = held[max(0, math.ceil(K.QUANTILE * len(held)) - 1)]
            assert all(math.isclose(r.threshold, cut) for r in out if r.lang == lang)
    assert all(r.kept == (r.perplexity <= r.threshold) for r in out)


def test_cases(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (100, 1, 0), (101, 1, 1), (None, 1, 0), (300, 1, None)],
                                   "doc_id long, quality int, toxic int")
    out = K.classify(awkward, labels)
    assert out.count() == awkward.count()
    assert all(not r.kept and r.perplexity is None for r in out.collect() if r.n_bytes == 0)
    none = K.classify(awkward, labels.limit(0)).collect()
    assert all(r.kept == (r.n_bytes > 0) for r in none)
    assert K.classify(nothing, labels).count() == 0


def test_probabilities_sum_to_one(spark):
    train = [b"the cat sat on the mat", b"the dog sat"] * 2
    p = brute_model(train, 3)
    for ctx in (b"th", b"zz", b"at"):
        assert math.isclose(sum(p(ctx + bytes([x])) for x in range(256)), 1, rel_tol=1e-9)


def test_codes_do_not_cross_rows():
    row, code = K.gram_codes([b"ab", b"", b"c"], 3)
    assert row.tolist() == [0, 0, 2]
    assert [int(c).to_bytes(3, "big") for c in code] == [b"\x02\x02a", b"\x02ab", b"\x02\x02c"]
