import random

import numpy as np
import pytest

from llm_helpers import by_id, collected
from tabforge.llm import filters
from tabforge.llm import minhash as M
from test_ngram_join import brute as brute_join


def brute(rows, monkeypatch=None):
    """The brute force of the 5-word join, with 4-word shingles."""
    import test_ngram_join as J

    def shingles(t):
        w = J.words(t)
        if not w:
            return frozenset()
        return frozenset(tuple(w[i:i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)])

    before, J.shingles = J.shingles, shingles
    try:
        return brute_join(rows)
    finally:
        J.shingles = before


def check(docs):
    got = collected(M.deduplicate(docs), "doc_id", "n_shingles", "component_id", "kept")
    assert by_id([r[:3] for r in got]) == brute(collected(docs, "doc_id", "text"))
    assert all(k == (d is not None and d == c) for d, _, c, k in got)


def test_awkward(awkward):
    check(awkward)


def test_empty(nothing):
    assert M.deduplicate(nothing).count() == 0


def edited(seed):
    """Chains and stars of edits around the bound, a hot original, a passage
    that many documents share, a group of far copies around no original."""
    r = random.Random(seed)
    rows = []
    for size in (1, 3, 4, 5, 7, 9, 13, 20, 33, 70):
        w = [f"a{r.randrange(500)}" for _ in range(size)]
        for _ in range(10):
            rows.append(" ".join(w))
            w = list(w)
            for _ in range(r.randrange(3)):
                k = r.randrange(len(w) + 1)
                if r.random() < 0.5:
                    w.insert(k, f"b{r.randrange(50)}")
                else:
                    w[min(k, len(w) - 1)] = f"c{r.randrange(50)}"
    original = [f"o{i}" for i in range(80)]
    for i in range(60):
        w = list(original)
        for _ in range(1 + i % 4):
            w[r.randrange(80)] = f"e{i}x{r.randrange(9)}"
        rows.append(" ".join(w))
    passage = [f"p{i}" for i in range(40)]
    rows += [" ".join(passage + [f"q{i}x{k}" for k in range(6 + i % 20)]) for i in range(40)]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("change", [{}, {"pivots": 0, "BLOCK": 7, "PAIRS": 9, "GROUPED": 30},
                                    {"clusters": 0, "BLOCK": 16, "BLOCK_SHINGLES": 500},
                                    {"MIN_FREQUENT": 2, "FREQUENT": 50, "BLOCK": 16}])
def test_near_copies(spark, monkeypatch, change):
    """Whichever way pairs are found: by pivots, in clusters, in lists, in any order of values."""
    for k, v in change.items():
        if k == "pivots":
            monkeypatch.setattr(M, "_retained", lambda classes, pairs: pairs.limit(0))
        elif k == "clusters":
            monkeypatch.setattr(M, "_clusters", lambda lists: lists.selectExpr("c", "c as cluster").distinct())
        else:
            monkeypatch.setattr(M, k, v)
    check(spark.createDataFrame(edited(3), "doc_id long, text string").repartition(4))


def test_joins_where_filters_would_be_too_large(spark, monkeypatch):
    monkeypatch.setattr(filters, "MOST_BITS", 1)
    check(spark.createDataFrame(edited(4)[:150], "doc_id long, text string").repartition(3))


def test_agreement_follows_similarity():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 62, 3000).astype(M.T.U64)
    for same in (1000, 2500, 2667):
        other = np.concatenate([base[:same], r.integers(0, 1 << 62, 3000 - same).astype(M.T.U64)])
        sig = M.signatures(np.concatenate([base, other]), np.array([0, 3000]))
        assert abs((sig[0] == sig[1]).mean() - same / (6000 - same)) < 0.2
    x = M.values(sig)
    assert len(np.unique(x[0])) == M.COORDINATES and ((x[0] == x[1]) == (sig[0] == sig[1])).all()


def test_cells_hold_all_pairs(monkeypatch):
    monkeypatch.setattr(M, "PAIRS", 10)
    cell = np.repeat([0, 1, 2, 3, 4], [3, 8, 1, 2, 6])
    left = np.array([k < 2 for n in (3, 8, 1, 2, 6) for k in range(n)])
    got = [p for i, j in M.cells(cell, left) for p in zip(i.tolist(), j.tolist())]
    assert sorted(got) == [(i, j) for i in range(20) for j in range(20) if cell[i] == cell[j] and left[i] and not left[j]]
    assert list(M.cells(np.empty(0, np.int64), np.empty(0, bool))) == []


def test_blocks_count_whole_signatures():
    r = np.random.default_rng(2)
    n, comp, sig = r.integers(8, 14, 40), np.arange(40) // 3, r.integers(0, 2, (40, M.COORDINATES)).astype(np.int32)
    rows = {"c": np.arange(40), "n": n, "comp": comp, "main": np.zeros(40, bool), "sig": sig}
    x, y = map(np.ravel, np.meshgrid(np.arange(40), np.arange(40)))
    i, j, same = M.colliding(rows, x, y)
    want = {(a, b) for a in range(40) for b in range(a) if 0 <= a and (sig[a] == sig[b]).sum() >= M.MATCHES
            and comp[a] != comp[b] and 5 * min(n[a], n[b]) >= 4 * max(n[a], n[b])}
    assert {(b, a) for a, b in zip(i.tolist(), j.tolist())} == want and want
    assert (same == (sig[i] == sig[j])).all()


def test_links_that_join_components():
    r = np.random.default_rng(5)
    sets = [np.unique(np.concatenate([np.arange(30), r.integers(30, 60, r.integers(0, 7))])) for _ in range(30)]
    i, j = map(np.ravel, np.meshgrid(np.arange(30), np.arange(30)))
    comp = np.arange(30) // 2
    links = list(M.joining(i, j, sets, comp))

    def similar(a, b):
        k = len(np.intersect1d(sets[a], sets[b]))
        return 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k)

    def groups(pairs):
        label = comp.copy()
        for a, b in pairs:
            label[label == label[b]] = label[a]
        return {tuple(np.flatnonzero(label == x)) for x in set(label.tolist())}

    assert all(similar(a, b) for a, b in links) and len(links) < 15
    assert groups(links) == groups([(a, b) for a in range(30) for b in range(30) if similar(a, b)])
