"""One query per pipeline operator, over the whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: vocabulary file of the packing operator; a parameter of ``packing.pack``
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_label_propagation_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import sharding
    return sharding.assign(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import ngram_join
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import suffix_dedup
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op4_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import kn_quality
    return kn_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import quality_rules
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import langid
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import packing
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import decontam
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.digest(decontam.occurrences(docs, table(spark, sf_dir, "benchmark")))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import pii
    return pii.detect(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import url_filter
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import collocations
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: every hundredth id. Every seventh row gets the next label."""
    from tabforge.llm import hard_negatives
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.scaled(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, flipped))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabforge.llm import minhash
    found = minhash.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OPERATORS = (op1_label_propagation_sharding, op2_ngram_jaccard_join, op3_suffix_array_dedup,
             op4_kneser_ney_quality, op5_quality_rules, op6_language_id, op7_best_fit_packing,
             op8_benchmark_decontamination, op9_pii, op10_url_filter, op11_collocation_mining,
             op12_hard_negative_mining, op13_minhash_near_dedup)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in OPERATORS}


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS g FROM (
    SELECT rid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0) t),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y
      WHERE 100 * k >= 80 * (nx.n + ny.n - k)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x),
c AS (SELECT r.a AS rid, min(d.doc_id) AS component_id FROM r JOIN d ON d.rid = r.b GROUP BY r.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d JOIN c ON c.rid = d.rid LEFT JOIN n ON n.rid = d.rid
"""

OP8_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
    SELECT item, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
    FROM b WHERE len(w) > 0) t),
dw AS (
  SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
    SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM iw) q) t),
o AS (SELECT rid, i, dw.k, item FROM dw JOIN iw ON dw.k = iw.k AND dw.g = iw.g),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM o) t GROUP BY rid),
x AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha
      FROM (SELECT DISTINCT rid, item FROM o WHERE item IS NOT NULL) t GROUP BY rid)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(x.n_items, 0) AS n_items,
       coalesce(x.sha, sha256('')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h ON h.rid = d.rid LEFT JOIN x ON x.rid = d.rid
"""


OP11_SQL = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) q) x),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k AS len, string_split(phrase, ' ') AS w, phrase, f AS a FROM f WHERE k > 1),
x AS (SELECT *, unnest(range(1, len)) AS k FROM c),
s AS (
  SELECT x.lang, x.phrase, x.a, x.k, l.f AS l, r.f AS r, t.n, (1000 * x.a * t.n) // (l.f * r.f) AS score
  FROM x JOIN t ON t.lang = x.lang
  JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1:x.k], ' ')
  JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[x.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT o.lang, o.phrase FROM (
    SELECT lang, a, len, array_to_string(w[i:i + j - 1], ' ') AS part FROM (
      SELECT lang, w, a, len, j, unnest(range(1, len - j + 2)) AS i FROM (
        SELECT lang, w, a, len, unnest(range(2, len)) AS j FROM c) y) z) q
  JOIN c o ON o.lang = q.lang AND o.phrase = q.part WHERE 100 * q.a >= 100 * o.a),
kept AS (SELECT b.* FROM b ANTI JOIN inside USING (lang, phrase)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

OP12_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and([coalesce(isfinite(x), false) FOR x IN embedding]), true)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

#: the 5-word join's SQL with 4-word shingles; the smallest id of a component stays
OP13_SQL = OP2_SQL.replace("w[i:i + 4]", "w[i:i + 3]").replace("greatest(len(w) - 4, 1)", "greatest(len(w) - 3, 1)") \
    .replace("c.component_id\nFROM d", "c.component_id, d.doc_id = c.component_id AS kept\nFROM d")


def oracle_sql() -> dict[str, str]:
    return {"op2_ngram_jaccard_join": OP2_SQL, "op8_benchmark_decontamination": OP8_SQL,
            "op11_collocation_mining": OP11_SQL, "op12_hard_negative_mining": OP12_SQL,
            "op13_minhash_near_dedup": OP13_SQL}
