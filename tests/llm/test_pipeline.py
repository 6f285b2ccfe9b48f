import re

from llm_helpers import SF, collected
import corpus_pipeline as C
from tabforge.llm import decontam as D
from tabforge.llm import ngram_join as J
from tabforge.llm.common import handed_off
from tabforge.llm.queries import queries, tokenizer_path
from test_ngram_join import brute, words
from test_pii import EMAIL


def test_stages_on_awkward_rows(spark, awkward, nothing):
    docs = awkward
    for name, stage in C.STAGES[:-1]:
        out = handed_off(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert 0 < out.count() <= docs.count()
        assert stage(spark, nothing, SF).count() == 0
        docs = out
    packed = C.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_run_against_brute_force_parts(spark):
    """Kept ids follow from the brute-force links of the documents with
    letters; texts hold no benchmark window and no e-mail address."""
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(d, t) for d, t in collected(docs, "doc_id", "text") if any(map(str.isalpha, t or ""))]
    want = {c for (_, n, c) in brute(rows) if n}
    stages = [docs]
    for name, stage in C.STAGES[:-1]:
        stages.append(handed_off(stage(spark, stages[-1], SF), f"test-{name}"))
    assert {r.doc_id for r in stages[1].collect()} == {d for d, _ in rows}
    assert {r.doc_id for r in stages[2].collect()} == want
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert D.digest(D.occurrences(stages[3].select("doc_id", "text"), bench)).filter("contaminated").count() == 0
    final = collected(stages[4], "doc_id", "text")
    assert not any(EMAIL.search(t or "") for _, t in final)
    tok = Tokenizer.from_file(tokenizer_path())
    packed = C.run(spark, SF).collect()
    length: dict[int, int] = {}
    for r in packed:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
    assert length == {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in final}


def test_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names and set(queries()) <= names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries()) == list(range(1, 14))
    assert [n for n, _ in C.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "pii",
                                        "best_fit_packing"]
