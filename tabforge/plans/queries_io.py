"""Catalogue entries for sources / sinks (S1, S2, S4-S7), P5 and validation (V2-V6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.columns import sigmoid, threshold_class
from tabforge.operators.ranking import with_row_index
from tabforge.operators.validate import validate, validation_report
from tabforge.plans.catalogue import query, r6, rounded, table
from tabforge.plans.queries_prepare import DOCS_BASE_SQL, feature_matrix_sql, fit_docs
from tabforge.session import scratch_path
from tabforge.sources.readers import apply_types, normalize_nulls, read_source
from tabforge.sources.sinks import prediction_table as prediction_table_sink
from tabforge.sources.sinks import scored_original as scored_original_sink
from tabforge.sources.sinks import scored_transformed as scored_transformed_sink
from tabforge.sources.sinks import write_table
from tabforge.spec import FeatureSpec

# ---------------------------------------------------------------------------
# S1 / S2
# ---------------------------------------------------------------------------

LINEITEM_CSV_SPEC = FeatureSpec.from_columns({
    "l_quantity": ["float", 1, "mean", None, "f"],
    "l_extendedprice": ["float", 1, "mean", None, "f"],
    "l_discount": ["float", 1, "mean", None, "f"],
    "l_tax": ["float", 1, "mean", None, "f"],
    "l_returnflag": ["category", 1, "unknown", "one-hot", "f"],
    "l_linestatus": ["category", 1, "unknown", "one-hot", "f"],
})


@query("scan_csv_roundtrip", f"""
SELECT l_orderkey, l_linenumber, {r6("l_quantity")} AS l_quantity, {r6("l_extendedprice")} AS l_extendedprice,
       {r6("l_discount")} AS l_discount, {r6("l_tax")} AS l_tax, l_returnflag, l_linestatus
FROM lineitem
""")
def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write lineitem as header CSV, read it back with every column as
    STRING, then type it by the metadata (try_cast, no inference pass)."""
    li = table(spark, sf_dir, "lineitem").drop("l_partkey", "l_suppkey", "l_shipdate")
    path = write_table(li, scratch_path(spark, "csv"), fmt="csv")
    raw = read_source(spark, path, "CSV")
    typed = apply_types(raw, LINEITEM_CSV_SPEC)
    return rounded(typed.select(F.col("l_orderkey").try_cast("bigint").alias("l_orderkey"),
                                F.col("l_linenumber").try_cast("int").alias("l_linenumber"),
                                "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                "l_returnflag", "l_linestatus"))


_QUOTED = ("c_name || CASE c_custkey % 4 WHEN 0 THEN ' \"Inc\", Ltd' WHEN 1 THEN ', a \"\"b\"' "
           "WHEN 2 THEN '{br}next \"line\"' ELSE '' END")


@query("scan_csv_quoted", "SELECT c_custkey, " + _QUOTED.replace("'{br}", "chr(10) || '") + " AS c_name FROM customer")
def scan_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, commas and line breaks inside cells survive a CSV round trip."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.expr(
        _QUOTED.replace("'{br}", "chr(10) || '")).alias("c_name"))
    path = write_table(c, scratch_path(spark, "csv-quoted"), fmt="csv")
    raw = read_source(spark, path, "CSV", multi_line=True)
    return raw.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name")


@query("normalize_nulls", f"""
SELECT c_custkey,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS c_name,
       CASE WHEN c_custkey % 13 = 0 OR c_custkey % 23 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE {r6("c_acctbal")} END AS c_acctbal
FROM customer
""")
def normalize_nulls_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NA tokens ('NA', 'nan', blanks) and NaN become null."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    dirty = c.select(
        "c_custkey",
        F.when(k % 17 == 0, F.lit("  ")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(k % 13 == 0, F.lit("NA")).when(k % 23 == 0, F.lit("nan"))
         .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(k % 19 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    return rounded(normalize_nulls(dirty))


# ---------------------------------------------------------------------------
# P5, S4-S7 over a deterministic score of the prepared documents
# ---------------------------------------------------------------------------

@query("threshold_class", f"""
SELECT event_id, {r6("value / (value + 10)")} AS prediction_proba,
       CAST(value / (value + 10) > 0.5 AS INTEGER) AS prediction_class
FROM events
""")
def threshold_class_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: class = probability > 0.5 (strict)."""
    e = table(spark, sf_dir, "events")
    p = F.col("value") / (F.col("value") + F.lit(10.0))
    return rounded(e.select("event_id", p.alias("prediction_proba"),
                            threshold_class(p).alias("prediction_class")))


def scored_docs(spark: SparkSession, sf_dir: str):
    """Prepared documents with a fixed logistic score of the scaled length
    (stands in for a model so SQL can reproduce it)."""
    raw, model = fit_docs(spark, sf_dir)
    mat = model.transform(raw)
    p = sigmoid(F.col("n_chars"))
    scored = mat.withColumn("prediction_proba", p).withColumn("prediction_class", threshold_class(p))
    return raw, model, scored


_SCORED_SQL = f"""
WITH m AS ({feature_matrix_sql(with_raw_z=True)}),
s AS (SELECT m.* EXCLUDE (_z), 1.0 / (1.0 + exp(-m._z)) AS p FROM m)
"""


@query("prediction_table", _SCORED_SQL + f"""
SELECT doc_id, {r6("p")} AS prediction_proba, CAST(p > 0.5 AS INTEGER) AS prediction_class, quality FROM s
""")
def prediction_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id + probability + class + target."""
    _, _, scored = scored_docs(spark, sf_dir)
    return rounded(prediction_table_sink(scored, "classification", "doc_id", "quality"))


@query("scored_original", f"""
WITH base AS ({DOCS_BASE_SQL}),
""" + _SCORED_SQL.strip()[len("WITH "):] + f"""
SELECT b.doc_id, {r6("b.n_chars")} AS n_chars, b.lang, b.source, b.toxic_flag, b.quality,
       {r6("s.p")} AS prediction_proba, CAST(s.p > 0.5 AS INTEGER) AS prediction_class
FROM base b JOIN s ON b.doc_id = s.doc_id
""")
def scored_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Original columns + target + predictions, rows carried through
    the same DataFrame (no positional join)."""
    raw, model = fit_docs(spark, sf_dir)
    z = model.feature_columns(raw)["n_chars"]     # the scaled value, as an expression
    p = sigmoid(z)
    both = raw.withColumn("prediction_proba", p).withColumn("prediction_class", threshold_class(p))
    return rounded(scored_original_sink(both, raw.columns, "classification", "quality"))


@query("scored_transformed", _SCORED_SQL + f"""
SELECT * EXCLUDE (p, doc_id), {r6("p")} AS prediction_proba, CAST(p > 0.5 AS INTEGER) AS prediction_class
FROM s
""")
def scored_transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transformed features + target + predictions."""
    _, model, scored = scored_docs(spark, sf_dir)
    return rounded(scored_transformed_sink(scored, model.output_columns, "classification", "quality"))


# ---------------------------------------------------------------------------
# V2-V6
# ---------------------------------------------------------------------------

def validation_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with a target that has nulls, text and bool columns as a CSV
    source would deliver them."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(k % 8 != 0, (F.col("l_returnflag") == "R").cast("int")).alias("target"),
        F.when(k % 50 == 0, F.concat(F.lit("n/a-"), F.col("l_returnflag")))
         .otherwise(F.col("l_quantity").cast("string")).alias("qty_txt"),
        F.col("l_discount"),
        F.col("l_linestatus").alias("status_bool"),
        F.when(F.col("l_returnflag") == "R", F.lit("1")).otherwise(F.lit("0")).alias("is_r_txt"),
        F.col("l_linenumber").alias("linenumber_bool"))


VALIDATION_SPEC = FeatureSpec.from_columns({
    "l_orderkey": ["category", 0, "unknown", None, "id"],
    "target": ["bool", 1, None, None, "target"],
    "qty_txt": ["float", 1, "mean", None, "f"],
    "l_discount": ["float", 1, "mean", None, "f"],
    "status_bool": ["bool", 1, None, None, "f"],
    "is_r_txt": ["bool", 1, None, None, "f"],
    "linenumber_bool": ["bool", 1, None, None, "f"],
    "l_comment": ["category", 1, "unknown", "one-hot", "f"],
})

_VAL_BASE_SQL = """
WITH v AS (SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_orderkey % 8 <> 0 THEN CAST(l_returnflag = 'R' AS INTEGER) END AS target,
                  CASE WHEN l_orderkey % 50 = 0 THEN 'n/a-' || l_returnflag ELSE CAST(l_quantity AS VARCHAR) END
                      AS qty_txt,
                  l_linestatus AS status_bool, l_linenumber AS linenumber_bool
           FROM lineitem)
"""

_V_TARGET = ("SELECT 'error' AS severity, 'target' AS \"column\", 'target_nulls' AS \"check\", "
             "count(*) FILTER (WHERE target IS NULL) AS bad_rows, "
             "'the target column ''target'' is empty in ' || CAST(count(*) FILTER (WHERE target IS NULL) AS VARCHAR) "
             "|| ' rows' AS message FROM v")
_V_NUMERIC = ("SELECT 'warning' AS severity, 'qty_txt' AS \"column\", 'not_numeric' AS \"check\", "
              "count(*) FILTER (WHERE qty_txt IS NOT NULL AND try_cast(qty_txt AS DOUBLE) IS NULL) AS bad_rows, "
              "'''qty_txt'' is declared float, yet some values are no numbers' AS message FROM v")
_V_BOOL = ("SELECT 'warning' AS severity, 'status_bool' AS \"column\", 'not_boolean' AS \"check\", "
           "count(*) FILTER (WHERE status_bool IS NOT NULL AND lower(trim(status_bool)) NOT IN "
           "('true', '1', '1.0', 'false', '0', '0.0')) AS bad_rows, "
           "'''status_bool'' is declared bool, yet some values are neither true nor false' AS message FROM v "
           "UNION ALL SELECT 'warning', 'linenumber_bool', 'not_boolean', "
           "count(*) FILTER (WHERE CAST(linenumber_bool AS DOUBLE) NOT IN (0.0, 1.0)), "
           "'''linenumber_bool'' is declared bool, yet some values are neither true nor false' FROM v")


def _report_rows(spark: SparkSession, sf_dir: str, checks: tuple[str, ...] | None) -> DataFrame:
    res = validate(validation_frame(spark, sf_dir), VALIDATION_SPEC, target="target", training=True)
    rep = validation_report(spark, res)
    return rep if checks is None else rep.where(F.col("check").isin(*checks))


@query("validate_target_nulls", _VAL_BASE_SQL + _V_TARGET)
def validate_target_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: nulls in the target -> error with the count."""
    return _report_rows(spark, sf_dir, ("target_nulls",))


@query("validate_numeric", _VAL_BASE_SQL + _V_NUMERIC)
def validate_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: float feature with text that is not a number -> warning."""
    return _report_rows(spark, sf_dir, ("not_numeric",))


@query("validate_bool_domain", _VAL_BASE_SQL + _V_BOOL)
def validate_bool_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: bool feature with values outside {0, 1, true, false} -> warning."""
    return _report_rows(spark, sf_dir, ("not_boolean",))


@query("validation_report", _VAL_BASE_SQL + " UNION ALL ".join([
    _V_TARGET, _V_NUMERIC, _V_BOOL,
    "SELECT 'error', 'l_comment', 'missing_feature', count(*), "
    "'the data lacks the used feature ''l_comment''' FROM v"]))
def validation_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6 (with V1, V5): every failed check in one table; one aggregate job."""
    return _report_rows(spark, sf_dir, None)


@query("scored_original_predict", f"""
WITH base AS ({DOCS_BASE_SQL}),
""" + _SCORED_SQL.strip()[len("WITH "):] + f"""
SELECT b.doc_id, {r6("b.n_chars")} AS n_chars, b.lang, b.source, b.toxic_flag,
       {r6("s.p")} AS prediction_proba, CAST(s.p > 0.5 AS INTEGER) AS prediction_class, b.quality
FROM base b JOIN s ON b.doc_id = s.doc_id
""")
def scored_original_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring-mode layout -- original columns, predictions, target last."""
    raw, model = fit_docs(spark, sf_dir)
    p = sigmoid(model.feature_columns(raw)["n_chars"])
    both = raw.withColumn("prediction_proba", p).withColumn("prediction_class", threshold_class(p))
    return rounded(scored_original_sink(both, raw.columns, "classification", "quality", target_last=True))


@query("prediction_table_index", _SCORED_SQL + f"""
SELECT {r6("p")} AS prediction_proba, CAST(p > 0.5 AS INTEGER) AS prediction_class, quality FROM s
""")
def prediction_table_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 fallback: without an id column the table carries a row index;
    compared here without that index (``row_index`` compares the index)."""
    _, _, scored = scored_docs(spark, sf_dir)
    t = prediction_table_sink(scored, "classification", "no_such_id", "quality")
    assert t.columns[0] == "index"
    return rounded(t.drop("index"))


@query("row_index", """
SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS "index" FROM customer
""")
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generated index is 0..n-1 in the order of the stored rows."""
    return with_row_index(table(spark, sf_dir, "customer").select("c_custkey"))


@query("scan_parquet_typed", f"""
SELECT o_orderkey, {r6("o_totalprice")} AS o_totalprice, o_orderpriority,
       CASE WHEN o_orderstatus = 'F' THEN TRUE WHEN o_orderstatus = 'O' THEN FALSE END AS is_filled
FROM orders
""")
def scan_parquet_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 (parquet source): scan, normalise, type by the metadata; a text
    column declared bool keeps only values in the boolean domain."""
    raw = read_source(spark, f"{sf_dir.rstrip('/')}/orders.parquet", "parquet")
    src = raw.select("o_orderkey", "o_totalprice", "o_orderpriority",
                     F.when(F.col("o_orderstatus") == "F", F.lit("1"))
                      .when(F.col("o_orderstatus") == "O", F.lit("0"))
                      .otherwise(F.col("o_orderstatus")).alias("is_filled"))
    spec = FeatureSpec.from_columns({"o_totalprice": ["float", 1, "mean", None, "f"],
                                     "o_orderpriority": ["category", 1, "unknown", "one-hot", "f"],
                                     "is_filled": ["bool", 1, None, None, "f"]})
    return rounded(apply_types(src, spec))
