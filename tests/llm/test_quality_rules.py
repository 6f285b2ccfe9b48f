import re
from collections import Counter

from llm_helpers import by_id, collected
from tabforge.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            hit.update(range(i, i + 5))
    n = len(words)
    failed = n < 10 or 100 * len(hit) > 20 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed)


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_against_brute_force(awkward, small):
    for docs in (awkward, small):
        want = by_id([(r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect()])
        got = Q.judge(docs)
        assert by_id(collected(got, *COLUMNS)) == want
        rows = got.collect()
        assert all(not r.kept for r in rows if r.base_failed)
        assert all(r.kept == (not r.failed_rules) for r in rows)


def test_empty(nothing):
    assert Q.judge(nothing).count() == 0


def test_fences_adapt_to_the_group(spark):
    prose = "the quick brown fox jumps over lazy dogs and runs far away from here today"
    def row(i, source, symbols):
        return i, f"{prose} w{i} " + " ".join(f"c{k}|" for k in range(symbols)), "en", source, 1

    rows = [row(i, "plain", i % 3) for i in range(200)] + [row(1000 + i, "tables", 20 + i % 3) for i in range(200)]
    rows.append(row(5000, "plain", 25))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in Q.judge(docs).collect()}
    assert not out[5000].kept and "symbols" in out[5000].failed_rules
    assert all(r.kept for i, r in out.items() if i != 5000)   # symbols are normal where the source is tables
