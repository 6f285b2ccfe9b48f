import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.llm import hard_negatives as H

VECTORS = "vec_id long, embedding array<float>, label int, hash string, leaf int"


def brute(rows, positives=5, negatives=10, low=30, high=90):
    """rows(vec_id, embedding, label), anchors: ids divisible by 10."""
    seen = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(v is None or not math.isfinite(v) for v in e):
            continue
        seen[(i, label, tuple(math.floor(256 * float(np.float32(v))) for v in e))] = None
    out = []
    for a, la, va in seen:
        if a % 10:
            continue
        scores = [(-sum(x * y for x, y in zip(va, v)), i, lab == la) for i, lab, v in seen if i != a]
        for s, p, _ in sorted(x for x in scores if x[2])[:positives]:
            fit = sorted(x for x in scores if not x[2] and low * -s <= 100 * -x[0] <= high * -s)
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fit[:negatives])]
    return sorted(out)


def mined(spark, rows, depth=None):
    df = spark.createDataFrame([(*r, "h", 1) for r in rows], VECTORS).repartition(4)
    return sorted(map(tuple, H.mine(H.scaled(df, F.col("vec_id") % 10 == 0), depth=depth).collect()))


def vectors(seed, n=240, dim=6):
    """Clusters by label, a vector held by a third of all rows, repeated rows,
    rows that take no part and ragged lengths."""
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.3) for _ in range(dim)] for _ in range(4)]
    rows = [(i, [c + r.gauss(0, 0.2) for c in centres[i % 4]], r.choice([i % 4, r.randrange(4)])) for i in range(n)]
    rows += [(1000 + i, [0.25] * dim, i % 3) for i in range(n // 2)]
    rows += [(2000, [0.5] * (dim - 2), 1), (2001, [], 1), (2010, [0.1, None, 0.3], 1), (2011, [0.1, float("nan")], 1),
             (2012, [float("inf")] * dim, 2), (2013, None, 2), (2014, [0.3] * dim, None), (None, [0.3] * dim, 1)]
    return rows + rows[:6] + [(10, [0.9] * dim, 2)]


@pytest.mark.parametrize("depth, cells", [(1, 65_536), (3, 16)])
def test_against_brute_force(spark, monkeypatch, depth, cells):
    monkeypatch.setattr(H, "CELL_ROWS", cells)
    monkeypatch.setattr(H, "CELL_ANCHORS", max(4, cells // 4))
    monkeypatch.setattr(H, "TILE_ROWS", 50)
    monkeypatch.setattr(H, "SAMPLE", 60)
    rows = vectors(depth)
    assert mined(spark, rows, depth) == brute(rows)


def test_large_components_are_exact(spark):
    r = random.Random(9)
    rows = [(i, [r.choice([-1, 1]) * r.randrange(1 << 18) * 16.0 for _ in range(3)], i % 3) for i in range(60)]
    got = mined(spark, rows)
    assert got == brute(rows) and max(x[4] for x in got) > H.EXACT


def test_empty(spark):
    assert mined(spark, []) == [] and mined(spark, [(10, None, 1)]) == []
    assert mined(spark, [(10, [0.5], 1)]) == []


def test_siblings_are_eliminated_only_without_partners():
    """Every row in a window lies in a leaf that survives, and some leaves do not."""
    r = np.random.default_rng(4)
    centres = r.normal(0, 60, (12, 8))
    x = np.floor(centres[r.integers(0, 12, 4000)] + r.normal(0, 8, (4000, 8)))
    root, nodes, leaves = H.fitted(x[:500], 2)
    H.with_ranges(nodes, list(H.ranges(root, nodes, x)))
    leaf = H.leaf_of(root, x)
    assert leaves > 20 and len(set(leaf.tolist())) > 20
    anchors = x[:200]
    scores = anchors @ x.T
    top = np.sort(scores, axis=1)[:, -40]
    lo, hi = np.stack([top, 0.3 * top], 1), np.stack([scores.max(axis=1), 0.9 * top], 1)
    alive = H.surviving(root, leaves, anchors, lo, hi)
    for w in range(2):
        a, row = np.nonzero((scores >= lo[:, w, None]) & (scores <= hi[:, w, None]))
        assert alive[a, leaf[row]].all()
    only_near = H.surviving(root, leaves, anchors, lo[:, :1], hi[:, :1])
    assert only_near.mean() < 0.6


def test_one_vector_for_all(spark):
    rows = [(i, [0.5, 0.5], i % 2) for i in range(50)]
    assert mined(spark, rows) == brute(rows)
