import zlib

import numpy as np

from llm_helpers import by_id, collected
from tabforge.llm import langid as L


def out_of(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").filter("held_out").collect()
    assert len(got) > 150
    assert np.mean([r.lang_pred == r.lang for r in got if r.lang_pred != "und"]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_cases(awkward):
    docs = awkward.select("doc_id", "text", "lang").collect()
    got = by_id(collected(L.identify(awkward), "doc_id", "held_out", "lang_pred"))
    assert [r[:2] for r in got] == by_id([(r.doc_id, out_of(r.doc_id)) for r in docs])
    letter = by_id([(r.doc_id, any(map(str.isalpha, r.text or ""))) for r in docs])
    assert [r[2] != "und" for r in got] == [x for _, x in letter]
    assert {r[2] for r in got} <= {"en", "de", "fr", "es", "und"}


def test_prediction_needs_only_the_text(spark, small):
    model = L.fit(small)
    hidden = small.selectExpr("doc_id * 7 as doc_id", "text", "cast(null as string) lang", "'x' source")
    a = by_id(collected(L.predict(small, model), "text", "__lang_pred", "__lang_score"))
    assert a == by_id(collected(L.predict(hidden, model), "text", "__lang_pred", "__lang_score"))


def test_no_and_one_language(spark, nothing):
    assert L.identify(nothing).count() == 0
    rows = [(i, f"some words {i}", None) for i in range(20)]
    none = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in L.identify(none).collect()} == {"und"}
    one = spark.createDataFrame([(i, t, "xx") for i, t, _ in rows] + [(50, "123", "xx")],
                                "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in L.identify(one).collect()} == {("xx", 1.0), ("und", 0.0)}


def test_families_are_average_linkage():
    r = np.random.default_rng(3)
    for n in (3, 5, 12):
        c = r.random((n, 6))
        unit = c / np.linalg.norm(c, axis=1, keepdims=True)
        alike = unit @ unit.T
        cut = alike[np.triu_indices(n, 1)].mean()
        groups = [[i] for i in range(n)]
        while len(groups) > 1:
            pairs = [(i, j) for i in range(len(groups)) for j in range(i + 1, len(groups))]
            a, b = max(pairs, key=lambda x: alike[np.ix_(groups[x[0]], groups[x[1]])].mean())
            if alike[np.ix_(groups[a], groups[b])].mean() <= cut:
                break
            groups[a] += groups.pop(b)
        names = [f"{i:02}" for i in range(n)]
        assert L.families_of(names, c) == [[names[i] for i in sorted(g)] for g in sorted(groups)]


def test_every_language_is_learned(spark, monkeypatch):
    """More languages than the 64 most frequent; the rare ones are the last.
    Families of one, as hundreds of pair machines take minutes."""
    monkeypatch.setattr(L, "families_of", lambda languages, centroids: [[x] for x in languages])
    monkeypatch.setattr(L, "ITERATIONS", 10)

    def text(k, i):
        return " ".join(chr(0x4E00 + 90 * k + (7 * i + j) % 20) * 2 for j in range(25))

    rows = [(1000 * k + i, text(k, i), f"l{k:02}") for k in range(70) for i in range(12 if k < 64 else 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs)
    assert sorted(x for f in model.families for x in f) == [f"l{k:02}" for k in range(70)]
    got = [r["lang"] == r["__lang_pred"] for r in L.predict(docs, model).collect() if r.lang >= "l64"]
    assert np.mean(got) > 0.9


def test_families_join_close_languages():
    c = np.array([[1, 0.1, 0], [1, 0.2, 0], [0, 0.1, 1], [0, 0.2, 1.0]])
    assert L.families_of(list("abcd"), c) == [["a", "b"], ["c", "d"]]


def test_features_ignore_block_neighbours():
    texts = ["abc", "", "été abc", "x"]
    both = L.features(texts)
    assert all(np.allclose(both[i], L.features([t])[0]) for i, t in enumerate(texts))


def test_accepted_keeps_columns(awkward):
    out = L.accepted(awkward)
    assert out.columns == awkward.columns
    assert out.count() == awkward.filter("text rlike '\\\\p{L}'").count()
