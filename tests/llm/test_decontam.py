import hashlib
import random
import re

import numpy as np
import pytest

from llm_helpers import PASSAGE, SF, by_id, collected
from tabforge.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, size=10):
    phrases = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            phrases.setdefault(tuple(w[i:i + size]), set()).update([] if item is None else [str(item)])
    lengths = {len(p) for p in phrases}
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for i in range(len(w)):
            for n in lengths:
                p = tuple(w[i:i + n])
                if len(p) == n and p in phrases:
                    hit.update(range(i, i + n))
                    ids |= phrases[p]
        joined = ",".join(sorted(ids))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return by_id(out)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_given_tables(spark, small):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = D.digest(D.occurrences(small, bench))
    want = brute(collected(small, "doc_id", "text"), collected(bench, "item_id", "text"))
    assert by_id(collected(got, *COLUMNS)) == want
    assert any(r[-1] for r in want)


@pytest.mark.parametrize("block", [20_000, 2])
def test_awkward(spark, awkward, block):
    items = [("a", PASSAGE), ("b", PASSAGE.upper()), ("c", "one two"), ("d", "W3"), ("e", None), ("f", " ... "),
             (None, "w1 w2"), ("c", "one two"), ("g", "été w1 w1 w2"), ("h", " ".join(["w1"] * 30)), ("i", "a b a")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = D.digest(D.occurrences(awkward, bench, item_block=block))
    assert by_id(collected(got, *COLUMNS)) == brute(collected(awkward, "doc_id", "text"), items)


def test_empty(spark, nothing, awkward):
    none = spark.createDataFrame([], "item_id string, text string")
    assert D.digest(D.occurrences(nothing, none)).count() == 0
    assert D.digest(D.occurrences(awkward, none)).filter("contaminated").count() == 0


def test_suffix_array_and_ranks():
    r = random.Random(1)
    for sigma, n in ((1, 50), (2, 200), (30, 500), (3, 1)):
        sym = np.asarray([0] + [r.randrange(sigma + 1) for _ in range(n)] + [0], np.int32)
        zeros = np.cumsum(sym == 0)
        key = [tuple((0, int(zeros[j])) if sym[j] == 0 else (1, int(sym[j])) for j in range(i, len(sym)))
               for i in range(len(sym))]
        sa = D.suffix_array(sym)
        assert sa.tolist() == sorted(range(len(sym)), key=key.__getitem__)
        f = D.FmIndex(sym, sigma)
        for c in range(sigma + 1):
            i = np.arange(len(sym) + 1)
            assert f.rank(np.full(len(i), c), i).tolist() == [0, *np.cumsum(f.bwt == c).tolist()]
        words_at = np.flatnonzero(sym[sa] != 0)
        assert f.locate(words_at).tolist() == sa[words_at].tolist()


def test_remove_keeps_columns_and_clean_rows(spark, awkward):
    bench = spark.createDataFrame([("a", PASSAGE)], "item_id string, text string")
    out = D.remove(awkward, bench)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    assert D.digest(D.occurrences(out, bench)).filter("contaminated").count() == 0
    before = {r.row: r for r in awkward.collect()}
    for r in out.collect():
        old = before[r.row]
        if old.text is None or "shared0 passage0" not in old.text:
            assert r == old
        else:
            assert r.text == old.text.replace(PASSAGE, "") and r.n_chars == len(r.text)


def test_remove_cuts_items_without_an_id(spark, awkward):
    bench = spark.createDataFrame([(None, PASSAGE), ("a", "nowhere at all")], "item_id string, text string")
    out = D.remove(awkward, bench)
    named = bench.fillna({"item_id": "b"})
    assert D.digest(D.occurrences(awkward, named)).filter("contaminated").count() > 0
    assert D.digest(D.occurrences(out, named)).filter("contaminated").count() == 0


def test_items_without_an_id_hit(spark, awkward):
    """Their windows count as hits; only the list of ids lacks them."""
    bench = spark.createDataFrame([(None, PASSAGE), ("a", PASSAGE[:120])], "item_id string, text string")
    got = collected(D.digest(D.occurrences(awkward, bench)), *COLUMNS)
    assert by_id(got) == brute(collected(awkward, "doc_id", "text"), collected(bench, "item_id", "text"))
    only = collected(D.digest(D.occurrences(awkward, bench.filter("item_id is null"))), *COLUMNS)
    assert sum(r[5] for r in only) == 12 and all(r[3] == 0 for r in only)
