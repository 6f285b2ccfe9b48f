"""Catalogue entries for feature preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.operators.prepare import FeaturePrep, FeaturePrepModel, select_features
from tabforge.plans.catalogue import query, r6, rounded, table
from tabforge.session import scratch_path
from tabforge.spec import FeatureSpec

# ---------------------------------------------------------------------------
# documents + labels: the flagship fixture
# ---------------------------------------------------------------------------

DOC_SPEC = FeatureSpec.from_columns({
    "doc_id": ["category", 0, "unknown", None, "1_id"],
    "n_chars": ["float", 1, "mean", None, "3_features"],
    "lang": ["category", 1, "unknown", "one-hot", "3_features"],
    "source": ["category", 1, "most_frequent", "one-hot", "3_features"],
    "toxic_flag": ["bool", 1, "unknown", None, "3_features"],
    "quality": ["bool", 1, "unknown", None, "2_DEPENDENT"],
})

# Category values present in the documents table (data facts used to spell
# out the oracle's wide columns).
LANGS = ["de", "en", "es", "fr"]
SOURCES = sorted(f"src{i}" for i in range(20))


def docs_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    j = docs.join(labels, "doc_id")
    k = F.col("doc_id")
    return j.select(
        "doc_id",
        F.when(k % 7 != 0, F.col("n_chars").cast("double")).alias("n_chars"),
        F.when(k % 11 != 0, F.col("lang")).alias("lang"),
        F.when(k % 13 != 0, F.col("source")).alias("source"),
        F.when(k % 5 != 0, F.col("toxic") == 1).alias("toxic_flag"),
        "quality")


DOCS_BASE_SQL = """
SELECT d.doc_id,
       CASE WHEN d.doc_id % 7 <> 0 THEN CAST(d.n_chars AS DOUBLE) END AS n_chars,
       CASE WHEN d.doc_id % 11 <> 0 THEN d.lang END AS lang,
       CASE WHEN d.doc_id % 13 <> 0 THEN d.source END AS source,
       CASE WHEN d.doc_id % 5 <> 0 THEN l.toxic = 1 END AS toxic_flag,
       l.quality
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def _onehot_sql(col: str, values: list[str]) -> str:
    return ",\n       ".join(
        f"CASE WHEN {col}_i = '{v}' THEN 1.0 ELSE 0.0 END AS \"{col}_{v}\"" for v in values)


def feature_matrix_sql(with_raw_z: bool = False) -> str:
    z = "(n_imp - m2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END"
    return f"""
WITH base AS ({DOCS_BASE_SQL}),
src_mode AS (SELECT source AS v FROM base WHERE source IS NOT NULL
             GROUP BY source ORDER BY count(*) DESC, source LIMIT 1),
imp AS (SELECT b.*,
               coalesce(b.n_chars, (SELECT avg(n_chars) FROM base)) AS n_imp,
               coalesce(b.lang, 'unknown') AS lang_i,
               coalesce(b.source, (SELECT v FROM src_mode)) AS source_i
        FROM base b),
sc AS (SELECT avg(n_imp) AS m2, stddev_pop(n_imp) AS s2 FROM imp)
SELECT doc_id, quality,
       CASE WHEN n_chars IS NULL THEN 1.0 ELSE 0.0 END AS n_chars_missing,
       {r6(z)} AS n_chars,{f" {z} AS _z," if with_raw_z else ""}
       {_onehot_sql("lang", LANGS + ["unknown"])},
       CASE WHEN lang IS NULL THEN 1.0 ELSE 0.0 END AS lang_missing,
       {_onehot_sql("source", SOURCES)},
       CASE WHEN source IS NULL THEN 1.0 ELSE 0.0 END AS source_missing,
       CASE WHEN toxic_flag THEN 1.0 ELSE 0.0 END AS toxic_flag,
       CASE WHEN toxic_flag IS NULL THEN 1.0 ELSE 0.0 END AS toxic_flag_missing
FROM imp, sc
"""


FEATURE_MATRIX_SQL = feature_matrix_sql()


def fit_docs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FeaturePrepModel]:
    df = docs_labeled(spark, sf_dir)
    model = FeaturePrep(DOC_SPEC, target="quality", passthrough=["doc_id"]).fit(df)
    return df, model


@query("feature_matrix", FEATURE_MATRIX_SQL)
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 (with A1, A4, A5, A6, A7, A9, A10, A11): fit + transform."""
    df, model = fit_docs(spark, sf_dir)
    return rounded(model.transform(df))


@query("processor_reload", FEATURE_MATRIX_SQL)
def processor_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persist the fitted preparation, reload it, transform with the copy."""
    df, model = fit_docs(spark, sf_dir)
    path = scratch_path(spark, "prep")
    model.save(spark, path)
    return rounded(FeaturePrepModel.load(spark, path).transform(df))


@query("select_features", """
SELECT d.lang, d.source, d.n_chars, l.quality
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""")
def select_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2: used features in data column order, then the target."""
    docs = table(spark, sf_dir, "documents")
    df = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    return select_features(df, DOC_SPEC, target="quality", training=True)


# ---------------------------------------------------------------------------
# lineitem: numeric imputation, scaling, indicators
# ---------------------------------------------------------------------------

def lineitem_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_orderkey") % 9 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.col("l_discount"),
        F.when(F.col("l_orderkey") % 10 != 0, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_orderkey") % 4 != 0, F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_orderkey") % 6 != 0, F.col("l_linestatus") == "F").alias("l_is_filled"))


LINEITEM_BASE_SQL = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END AS l_quantity,
       CASE WHEN l_orderkey % 9 <> 0 THEN l_extendedprice END AS l_extendedprice,
       l_discount,
       CASE WHEN l_orderkey % 10 <> 0 THEN l_tax END AS l_tax,
       CASE WHEN l_orderkey % 4 <> 0 THEN l_returnflag END AS l_returnflag,
       CASE WHEN l_orderkey % 6 <> 0 THEN l_linestatus = 'F' END AS l_is_filled
FROM lineitem
"""


def _impute_query(method: str):
    spec = FeatureSpec.from_columns({"l_quantity": ["float", 1, method, None, "f"]})

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = lineitem_nulls(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity")
        model = FeaturePrep(spec, passthrough=["l_orderkey", "l_linenumber"]).fit(df)
        return rounded(model.impute(df))
    return run


_FILL_SQL = {"mean": "(SELECT avg(l_quantity) FROM base)",
             "median": "(SELECT median(l_quantity) FROM base)",
             "0": "0.0"}

for _name, _method in (("impute_mean", "mean"), ("impute_median", "median"), ("impute_zero", "0")):
    query(_name, f"""
WITH base AS ({LINEITEM_BASE_SQL})
SELECT l_orderkey, l_linenumber, {r6(f"coalesce(l_quantity, {_FILL_SQL[_method]})")} AS l_quantity
FROM base
""")(_impute_query(_method))


STANDARD_SCALE_SPEC = FeatureSpec.from_columns({
    "l_quantity": ["float", 1, "mean", None, "f"],
    "l_extendedprice": ["float", 1, "median", None, "f"],
    "l_discount": ["float", 1, "mean", None, "f"],
    "l_tax": ["float", 1, "0", None, "f"],
})


def _scaled_sql(col: str, fill: str) -> str:
    return (f"{r6(f'(coalesce({col}, {fill}) - (SELECT avg(coalesce({col}, {fill})) FROM base)) / '
                  f'(SELECT CASE WHEN stddev_pop(coalesce({col}, {fill})) = 0 THEN 1 '
                  f'ELSE stddev_pop(coalesce({col}, {fill})) END FROM base)')} AS {col}")


@query("standard_scale", f"""
WITH base AS ({LINEITEM_BASE_SQL})
SELECT l_orderkey, l_linenumber,
       {_scaled_sql("l_quantity", "(SELECT avg(l_quantity) FROM base)")},
       {_scaled_sql("l_extendedprice", "(SELECT median(l_extendedprice) FROM base)")},
       {_scaled_sql("l_discount", "(SELECT avg(l_discount) FROM base)")},
       {_scaled_sql("l_tax", "0.0")}
FROM base
""")
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 after A1 / A2 / A3: (x - mean) / population std of the imputed column."""
    df = lineitem_nulls(spark, sf_dir)
    model = FeaturePrep(STANDARD_SCALE_SPEC, passthrough=["l_orderkey", "l_linenumber"],
                        missing_indicators=False).fit(df)
    return rounded(model.transform(df))


MISSING_SPEC = FeatureSpec.from_columns({
    "l_quantity": ["float", 1, "mean", None, "f"],
    "l_tax": ["float", 1, "mean", None, "f"],
    "l_returnflag": ["category", 1, "unknown", "one-hot", "f"],
    "l_is_filled": ["bool", 1, None, None, "f"],
})


@query("missing_indicator", f"""
WITH base AS ({LINEITEM_BASE_SQL})
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity IS NULL THEN 1.0 ELSE 0.0 END AS l_quantity_missing,
       CASE WHEN l_tax IS NULL THEN 1.0 ELSE 0.0 END AS l_tax_missing,
       CASE WHEN l_returnflag IS NULL THEN 1.0 ELSE 0.0 END AS l_returnflag_missing,
       CASE WHEN l_is_filled IS NULL THEN 1.0 ELSE 0.0 END AS l_is_filled_missing
FROM base
""")
def missing_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: 0/1 indicator per float / category / bool feature, taken before imputation."""
    df = lineitem_nulls(spark, sf_dir)
    model = FeaturePrep(MISSING_SPEC, passthrough=["l_orderkey", "l_linenumber"]).fit(df)
    out = model.transform(df)
    return out.select("l_orderkey", "l_linenumber",
                      *[c for c in out.columns if c.endswith("_missing")])


# ---------------------------------------------------------------------------
# orders / part: categorical and boolean imputation, vocabulary, one-hot
# ---------------------------------------------------------------------------

ORDERS_BASE_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderkey % 6 <> 0 THEN o_orderstatus = 'F' END AS o_is_filled
FROM orders
"""


def orders_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
                    F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderstatus") == "F").alias("o_is_filled"))


@query("impute_unknown", f"""
WITH base AS ({ORDERS_BASE_SQL})
SELECT o_orderkey, coalesce(o_orderpriority, 'unknown') AS o_orderpriority FROM base
""")
def impute_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: category nulls -> 'unknown'."""
    df = orders_nulls(spark, sf_dir).select("o_orderkey", "o_orderpriority")
    spec = FeatureSpec.from_columns({"o_orderpriority": ["category", 1, "unknown", "one-hot", "f"]})
    return FeaturePrep(spec, passthrough=["o_orderkey"]).fit(df).impute(df)


@query("impute_bool", f"""
WITH base AS ({ORDERS_BASE_SQL})
SELECT o_orderkey, CASE WHEN o_is_filled THEN 1.0 ELSE 0.0 END AS o_is_filled FROM base
""")
def impute_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boolean nulls -> 0."""
    df = orders_nulls(spark, sf_dir).select("o_orderkey", "o_is_filled")
    spec = FeatureSpec.from_columns({"o_is_filled": ["bool", 1, None, None, "f"]})
    return FeaturePrep(spec, passthrough=["o_orderkey"]).fit(df).impute(df)


PART_BASE_SQL = """
SELECT p_partkey,
       CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS p_type,
       CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS p_brand
FROM part
"""


def part_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey",
                    F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).alias("p_type"),
                    F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).alias("p_brand"))


PART_SPEC = FeatureSpec.from_columns({
    "p_type": ["category", 1, "unknown", "one-hot", "f"],
    "p_brand": ["category", 1, "most_frequent", "one-hot", "f"],
})


@query("impute_mode", f"""
WITH base AS ({PART_BASE_SQL}),
m AS (SELECT p_brand AS v FROM base WHERE p_brand IS NOT NULL
      GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 1)
SELECT p_partkey, coalesce(p_brand, (SELECT v FROM m)) AS p_brand FROM base
""")
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: category nulls -> most frequent value (ties -> smallest value)."""
    df = part_nulls(spark, sf_dir).select("p_partkey", "p_brand")
    spec = FeatureSpec.from_columns({"p_brand": ["category", 1, "most_frequent", "one-hot", "f"]})
    return FeaturePrep(spec, passthrough=["p_partkey"]).fit(df).impute(df)


@query("category_vocab", f"""
WITH base AS ({PART_BASE_SQL}),
m AS (SELECT p_brand AS v FROM base WHERE p_brand IS NOT NULL
      GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 1),
vals AS (SELECT DISTINCT 'p_type' AS feature, coalesce(p_type, 'unknown') AS category FROM base
         UNION
         SELECT DISTINCT 'p_brand' AS feature, coalesce(p_brand, (SELECT v FROM m)) AS category FROM base)
SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY category) - 1 AS BIGINT) AS pos,
       category
FROM vals
""")
def category_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted categories after imputation, per feature."""
    df = part_nulls(spark, sf_dir)
    model = FeaturePrep(PART_SPEC, passthrough=["p_partkey"]).fit(df)
    return model.vocabulary_frame(spark)


# p_type categories of the part table (spelled out for the oracle).
P_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("one_hot", "SELECT p_partkey, " + ", ".join(
    f"CASE WHEN p_type = '{v}' THEN 1.0 ELSE 0.0 END AS \"p_type_{v}\"" for v in P_TYPES) + " FROM part")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per category, none dropped."""
    df = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    spec = FeatureSpec.from_columns({"p_type": ["category", 1, "unknown", "one-hot", "f"]})
    model = FeaturePrep(spec, passthrough=["p_partkey"], missing_indicators=False).fit(df)
    return model.transform(df)


# Category texts that are awkward as column names, by p_partkey % 8.
ODD_VALUES = ["3.5", "St. Louis", "A", "a", "back`tick", "missing", "x,y z", "é"]
_ODD_SQL = "CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(ODD_VALUES)) + " END"
_ODD_SLOTS = sorted(ODD_VALUES)


@query("one_hot_odd_values", "SELECT p_partkey, " + ", ".join(
    f"CASE WHEN v = '{v}' THEN 1.0 ELSE 0.0 END AS f{i}" for i, v in enumerate(_ODD_SLOTS))
    + f", 0.0 AS f{len(_ODD_SLOTS)} FROM (SELECT p_partkey, {_ODD_SQL} AS v FROM part) t")
def one_hot_odd_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9, A11, A12 with values that hold dots, blanks, commas and backticks,
    differ by case only, or equal a suffix: the assembled vector's slots."""
    from pyspark.ml.functions import vector_to_array
    df = table(spark, sf_dir, "part").select("p_partkey", F.expr(_ODD_SQL).alias("c"))
    spec = FeatureSpec.from_columns({"c": ["category", 1, "unknown", "one-hot", "f"]})
    model = FeaturePrep(spec, passthrough=["p_partkey"]).fit(df)
    x = vector_to_array("features")
    return model.transform(df, assemble=True).select(
        "p_partkey", *[x[i].alias(f"f{i}") for i in range(len(_ODD_SLOTS) + 1)])


@query("one_hot_unseen", "SELECT p_partkey, " + ", ".join(
    f"CASE WHEN p_type = '{v}' THEN 1.0 ELSE 0.0 END AS \"p_type_{v}\"" for v in P_TYPES if v != "PROMO")
    + " FROM part")
def one_hot_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9, unseen value: fitted without PROMO parts, applied to all parts ->
    PROMO rows encode as all zeros."""
    df = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    spec = FeatureSpec.from_columns({"p_type": ["category", 1, "unknown", "one-hot", "f"]})
    model = FeaturePrep(spec, passthrough=["p_partkey"], missing_indicators=False).fit(
        df.where(F.col("p_type") != "PROMO"))
    return model.transform(df)


@query("dictionary_vocabulary", """
SELECT feature, count(*) AS n_categories, min(pos) AS first_pos, max(pos) AS last_pos, CAST(sum(n) AS BIGINT) AS n_rows
FROM (
  SELECT feature, category, count(*) AS n, row_number() OVER (PARTITION BY feature ORDER BY category) - 1 AS pos
  FROM (
    SELECT 'line' AS feature, concat(l_orderkey, '-', l_linenumber) AS category FROM lineitem
    UNION ALL
    SELECT 'supply', CASE WHEN l_linenumber % 3 <> 0 THEN concat(l_partkey, '/', l_suppkey, '/', l_orderkey) ELSE 'unknown' END
    FROM lineitem) v
  GROUP BY feature, category) c
GROUP BY feature
""")
def dictionary_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 at any size: dense positions of a category a line and one a supply,
    a third of the latter null (over 100,000 categories together at sf 0.1)."""
    _, prep = _line_dictionary(spark, sf_dir)
    return prep.words.table.groupBy("feature").agg(
        F.count_distinct("category").alias("n_categories"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"),
        F.sum("n").alias("n_rows"))


def _line_dictionary(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"),
        F.when(F.col("l_linenumber") % 3 != 0, F.concat_ws("/", "l_partkey", "l_suppkey", "l_orderkey")).alias("supply"))
    spec = FeatureSpec.from_columns({"line": ["category", 1, "unknown", "one-hot", "f"],
                                     "supply": ["category", 1, "unknown", "one-hot", "f"]})
    return li, FeaturePrep(spec, passthrough=["l_orderkey", "l_linenumber"], encoding="dictionary").fit(li)


@query("dictionary_one_hot", """
SELECT count(*) AS n_rows, count(DISTINCT concat(l_orderkey, '-', l_linenumber)) AS line_places,
       count(DISTINCT CASE WHEN l_linenumber % 3 <> 0 THEN concat(l_partkey, '/', l_suppkey, '/', l_orderkey) ELSE 'unknown' END)
       AS supply_places,
       CAST(0 AS BIGINT) AS not_one_hot, CAST(0 AS BIGINT) AS wrong_place, count(*) FILTER (WHERE l_linenumber % 3 = 0) AS supply_missing
FROM lineitem
""")
def dictionary_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 at any size: every row's sparse vectors have their one at the place
    that the dictionary gives the row's value."""
    from tabforge.operators.dictionary import positions
    li, prep = _line_dictionary(spark, sf_dir)
    out = prep.transform(li, keep=["line", "supply"])

    def ones(c):
        """Places of the ones of a vector column: its printed form has no dense copy."""
        return F.from_json(F.regexp_extract(F.col(c).cast("string"), r"^\(\d+,(\[[^\]]*\])", 1), "array<long>")

    seen = out.select("line", F.coalesce("supply", F.lit("unknown")).alias("supply"), "supply_missing",
                      ones("line_onehot").alias("a"), ones("supply_onehot").alias("b"))
    both = positions(seen, {"line": "line", "supply": "supply"}, prep.words)
    a, b = F.col("a")[0], F.col("b")[0]
    # one row each; distinct places of both in one aggregate would shuffle every row twice
    return both.agg(F.count(F.lit(1)).alias("n_rows")) \
        .crossJoin(both.agg(F.count_distinct(a).alias("line_places"))) \
        .crossJoin(both.agg(F.count_distinct(b).alias("supply_places"))) \
        .crossJoin(both.agg(
            F.count_if((F.size("a") != 1) | (F.size("b") != 1)).alias("not_one_hot"),
            F.count_if((a != F.col("line")) | (b != F.col("supply"))).alias("wrong_place"),
            F.sum("supply_missing").cast("long").alias("supply_missing")))


# Fixed: columns whose medians are taken together, each null on its own rows.
MEDIAN_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey", "l_suppkey")


@query("medians_together", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {r6(f'median(CAST({c} AS DOUBLE))')} AS median FROM lineitem WHERE l_linenumber % {i + 2} <> 0"
    for i, c in enumerate(MEDIAN_COLUMNS)))
def medians_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: exact medians of six columns by brackets of at most 500 values,
    narrowed together by one aggregate a round."""
    from tabforge.operators.ranking import exact_medians
    li = table(spark, sf_dir, "lineitem").select(
        *[F.when(F.col("l_linenumber") % (i + 2) != 0, F.col(c).cast("double")).alias(c) for i, c in enumerate(MEDIAN_COLUMNS)])
    found = exact_medians(li, list(MEDIAN_COLUMNS), bracket_rows=500)
    return rounded(spark.createDataFrame(list(found.items()), "feature string, median double"))
