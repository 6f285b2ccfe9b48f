"""Column expressions shared by operators and jobs (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its exact name, which may hold dots and backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def threshold_class(p: Column | str, threshold: float = 0.5) -> Column:
    """P5: class 1 when the probability is strictly above ``threshold``."""
    p = F.col(p) if isinstance(p, str) else p
    return (p > F.lit(threshold)).cast("int")


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def positive_probability(prob_vector_col: str = "probability") -> Column:
    """P(class 1) from a Spark ML probability vector column."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(prob_vector_col)).getItem(1)


def range_bucket(c: Column, bounds: list[float]) -> Column:
    """Index of the half-open range ``[bounds[i-1], bounds[i])`` that holds
    ``c`` (0 .. len(bounds)), as a balanced binary-search CASE tree: about
    log2(len(bounds)) comparisons per row."""
    bounds = sorted(set(float(b) for b in bounds))

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(c < F.lit(bounds[mid - 1]), build(lo, mid - 1)).otherwise(build(mid, hi))

    return build(0, len(bounds))
