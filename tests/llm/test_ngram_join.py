import random
import re

import numpy as np
import pytest

from llm_helpers import by_id, collected
from tabforge.llm import ngram_join as J


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def shingles(t):
    w = words(t)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    """(doc_id, n, component) of rows(doc_id, text) by all pairs of distinct sets."""
    sets = [shingles(t) for _, t in rows]
    kinds = sorted(set(sets) - {frozenset()}, key=lambda s: (len(s), sorted(s)))
    index = {s: i for i, s in enumerate(kinds)}
    parent = list(range(len(kinds)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(kinds):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(kinds):
        seen = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        for j, k in seen.items():
            if 100 * k >= 80 * (len(s) + len(kinds[j]) - k):
                parent[root(i)] = root(j)
    least = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            r = root(index[s])
            least[r] = min(least.get(r, doc), doc)
    return by_id([(doc, len(s), least.get(root(index[s])) if s else doc) for (doc, _), s in zip(rows, sets)])


def check(docs):
    got = J.join(docs)
    assert by_id(collected(got, "doc_id", "n_shingles", "component_id")) == brute(collected(docs, "doc_id", "text"))


def test_given_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_awkward(awkward):
    check(awkward)


@pytest.mark.parametrize("seed", [1])
def test_near_copies_of_all_sizes(spark, seed, monkeypatch):
    """Chains and stars of edits around the similarity bound, small to large,
    under every kind of boundary and with frequent shingles put last."""
    monkeypatch.setattr(J, "MIN_FREQUENT", 3)
    r = random.Random(seed)
    rows = []
    for size in (1, 2, 4, 5, 6, 8, 9, 11, 14, 17, 20, 22, 25, 40, 90):
        w = [f"a{r.randrange(400)}" for _ in range(size)]
        for _ in range(14):
            rows.append((len(rows), " ".join(w)))
            w = list(w)
            for _ in range(r.randrange(3)):
                k = r.randrange(len(w) + 1)
                if r.random() < 0.4:
                    w.insert(k, f"b{r.randrange(50)}")
                elif r.random() < 0.5 and len(w) > 1:
                    del w[min(k, len(w) - 1)]
                else:
                    w[min(k, len(w) - 1)] = f"c{r.randrange(50)}"
    passage = [f"p{i}" for i in range(30)]
    rows += [(5000 + i, " ".join(passage + [f"q{i}x{k}" for k in range(8 + i % 5)])) for i in range(30)]
    r.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


@pytest.mark.parametrize("limit", [0, 16])
def test_any_boundary_gives_the_same_links(awkward, monkeypatch, limit):
    monkeypatch.setattr(J, "light_limit", lambda small: limit)
    check(awkward)


def test_empty(nothing):
    assert J.join(nothing).count() == 0 and J.one_of_each(nothing).count() == 0


def test_one_of_each(awkward):
    out = J.one_of_each(awkward)
    assert out.columns == awkward.columns
    rows = collected(awkward, "doc_id", "text")
    want = by_id([(d,) for d in {c for _, n, c in brute(rows) if n and c is not None}]
                 + [(d,) for d, t in rows if not words(t)])
    got = [r for r in collected(out, "doc_id") if r[0] is not None]
    assert by_id(got) == [w for w in want if w[0] is not None]
    assert len({shingles(r.text) for r in out.collect() if words(r.text)}) == len(
        [r for r in out.collect() if words(r.text)])


def test_overlap_bounds():
    for n in range(1, 40):
        for m in range(1, 60):
            ok = [k for k in range(min(n, m) + 1) if 100 * k >= 80 * (n + m - k)]
            assert (m in J.partners(n)) == bool(ok)
            if ok:
                assert J.needed(n, m) == ok[0] and n - ok[0] + 1 <= J.posted(n)


def test_bytes_and_classes():
    a, b = J.shingle_sets([b"a b c d e f", b"a b c d e f a b c d e"])
    assert len(a) == 2 and len(b) == 6 and set(a.tolist()) < set(b.tolist())
    assert J.class_of(a) != J.class_of(b) and J.class_of(np.sort(a)[::-1].copy()) == J.class_of(a)


def test_supersets_at_the_bound_are_linked(spark):
    """A set of 4/5 of another's size inside it: shingles posted by the one may stand behind the other's postings."""
    rows = []
    for k in range(80):
        w = [f"s{k}x{i}" for i in range(24 + k % 9 * 4)]        # 20, 24, ... shingles
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(w + [f"t{k}x{i}" for i in range((len(w) - 4) // 4)]))]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


def test_marks_never_part_sets_that_link():
    rng = np.random.default_rng(5)
    sets = [np.sort(rng.integers(0, 1 << 63, n).astype(J.T.U64)) for n in (1, 5, 40, 63, 64, 65, 130, 500)]
    sets += [np.sort(np.concatenate([s[:len(s) - cut], rng.integers(0, 1 << 63, more).astype(J.T.U64)]))
             for s in sets for cut, more in ((0, len(s) // 4), (len(s) // 10, len(s) // 10), (len(s) // 5, 0))]
    n = np.array(list(map(len, sets)))
    i, j = np.nonzero(5 * np.minimum(n[:, None], n) >= 4 * np.maximum(n[:, None], n))
    link = np.array([9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (n[a] + n[b]) for a, b in zip(i, j)])
    found = J.close(J.pa.array([b"?", *map(J.marks_of, sets)], J.pa.binary()).slice(1), n, i, j)
    assert link.sum() > len(sets) and found[link].all() and not found[~link].all()


def test_many_edited_copies_of_different_clusters(spark, monkeypatch):
    """Long lists meet in blocks, short ones are joined; both give only pairs that can link."""
    r, rows, handed = random.Random(3), [], {}
    passage = [f"p{i}" for i in range(60)]
    for k in range(90):
        w = passage[:20 + 4 * (k % 10)] + [f"q{k}x{i}" for i in range(r.randrange(0, 40, 3))]
        rows += [(3 * k, " ".join(w)), (3 * k + 1, " ".join(w[:-2] + ["z"])), (3 * k + 2, " ".join(w + [f"y{k}"]))]
    keep = J.handed_off
    monkeypatch.setattr(J, "MIN_FREQUENT", 1 << 30)     # the passage comes first in no set, nor last in all
    monkeypatch.setattr(J, "handed_off", lambda df, name: handed.setdefault(name, keep(df, name)))
    monkeypatch.setattr(J, "SHORT", 8)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(docs)
    sets = {J.class_of(s): s for s in J.sets_of([t.encode() for _, t in rows])}
    pairs = handed["join-rest-pairs"].collect()
    assert handed["join-long"].count()
    near = [len(np.intersect1d(sets[a], sets[b])) >= 0.7 * max(len(sets[a]), len(sets[b])) for a, b in pairs]
    assert sum(near) >= 0.9 * len(near) > 0     # marks may agree by chance
