"""Table scans and the null normalisation every read needs.

CSV is read with every column as STRING (no inference pass, no typed schema):
a typed CSV schema would silently turn malformed numbers and boolean cells
such as ``0`` into null, which hides validation problems. Typing happens
afterwards in one projection with ``try_cast`` / an explicit boolean map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import quoted
from tabforge.spec import FeatureSpec

# The tokens a CSV reader of the reference's generation treats as
# missing (pandas 1.5 default ``na_values``), plus the empty cell.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

# Text accepted as a boolean cell (case-insensitive).
TRUE_TOKENS = ("true", "1", "1.0")
FALSE_TOKENS = ("false", "0", "0.0")

SUPPORTED_SOURCES = ("CSV", "PARQUET")


def read_csv_strings(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Header CSV, every column STRING (only the header line is read up front).

    A quote inside a quoted cell is doubled. A row with more or fewer cells
    than the header fails the query (every cell is parsed, so pruning columns
    cannot hide it). ``multi_line``: cells may hold line breaks; such files are
    read whole, one task a file."""
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("mode", "FAILFAST").option("columnPruning", False).option("nullValue", None)
            .option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path))


def read_source(spark: SparkSession, path: str | None, source: str | None, multi_line: bool = False) -> DataFrame:
    """A missing path or an unknown kind of source is an error."""
    if not path:
        raise ValueError("the data configuration names no file_path")
    kind = (source or "").upper()
    if kind not in SUPPORTED_SOURCES:
        raise ValueError(f"input_data_source {source!r} is not one of {', '.join(SUPPORTED_SOURCES)}")
    if kind == "CSV":
        df = read_csv_strings(spark, path, multi_line)
    else:
        df = spark.read.parquet(path)
    return normalize_nulls(df)


def _null_if_token(c: Column) -> Column:
    return F.when(F.trim(c).isin(*NA_TOKENS), F.lit(None)).otherwise(c)


def normalize_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One projection mapping NaN (doubles / floats) and NA tokens (strings)
    to null, leaving every other column untouched."""
    cols = set(columns) if columns is not None else None
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if cols is not None and f.name not in cols:
            exprs.append(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            exprs.append(_null_if_token(c).alias(f.name))
        else:
            exprs.append(c)
    return df.select(*exprs)


def to_double(c: Column, dtype: T.DataType) -> Column:
    """Numeric view of a column of any source type; text that is not a number
    becomes null (``try_cast``; ANSI casts would raise)."""
    if isinstance(dtype, T.StringType):
        return c.try_cast("double")
    if isinstance(dtype, T.BooleanType):
        return c.cast("double")
    if isinstance(dtype, T.NumericType):
        v = c.cast("double")
        return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)
    return c.cast("string").try_cast("double")


def to_bool_double(c: Column, dtype: T.DataType) -> Column:
    """0/1 double view of a boolean column; other values -> null."""
    if isinstance(dtype, T.BooleanType):
        return c.cast("double")
    if isinstance(dtype, T.NumericType):
        v = c.cast("double")
        return F.when(v.isin(0.0, 1.0), v)
    s = F.lower(F.trim(c.cast("string")))
    return (F.when(s.isin(*TRUE_TOKENS), F.lit(1.0))
            .when(s.isin(*FALSE_TOKENS), F.lit(0.0)))


def to_category(c: Column, dtype: T.DataType) -> Column:
    """String view of a category column (numbers rendered without a trailing
    ``.0`` so that 1 and 1.0 name the same category)."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def apply_types(df: DataFrame, spec: FeatureSpec, target: str | None = None,
                label_kind: str | None = None) -> DataFrame:
    """Give each metadata-described column its Spark type in one projection:
    float -> DOUBLE, bool -> BOOLEAN, category -> STRING; the target -> DOUBLE
    (``label_kind='bool'`` maps true/false text). Other columns are kept."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for name in df.columns:
        c = quoted(name)
        field = spec.get(name)
        if name == target:
            if label_kind == "bool" or (field is not None and field.type == "bool"):
                v = to_bool_double(c, dtypes[name])
                v = F.coalesce(v, to_double(c, dtypes[name]))
            else:
                v = to_double(c, dtypes[name])
            exprs.append(v.alias(name))
        elif field is None:
            exprs.append(c)
        elif field.type == "float":
            exprs.append(to_double(c, dtypes[name]).alias(name))
        elif field.type == "bool":
            exprs.append(to_bool_double(c, dtypes[name]).cast("boolean").alias(name))
        elif field.type == "category":
            exprs.append(to_category(c, dtypes[name]).alias(name))
        else:
            exprs.append(c)
    return df.select(*exprs)
