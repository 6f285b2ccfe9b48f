"""Query catalogue: one Spark query per operator of the inventory, and where
SQL can express the answer, the equivalent DuckDB SQL (the oracle).

Every query reads the given tables (``<sf_dir>/<table>.parquet``) in full.
The test tables hold no nulls, so null-handling queries inject them with the
same deterministic rule on both sides (``CASE WHEN key % k <> 0 THEN col END``).
Double outputs are rounded to 6 decimals (+0.0 folds -0.0) on both sides so
that value hashes compare engines, not last-bit float noise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (and fold -0.0) for engine-neutral hashing."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append((F.round(c.cast("double"), digits) + F.lit(0.0)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def r6(expr: str) -> str:
    """SQL twin of ``rounded`` for one expression."""
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


# Import the query modules so their @query registrations run.
def _load_all() -> None:
    from tabforge.plans import queries_prepare  # noqa: F401
    from tabforge.plans import queries_io  # noqa: F401
    from tabforge.plans import queries_split_metrics  # noqa: F401
    from tabforge.plans import queries_model  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
