"""Result tables and the run's output layout.

Every sink is a DataFrame writer (parallel part files, directories created by
Spark); there is no single-file coalesce by default.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.columns import quoted
from tabforge.operators.ranking import with_row_index
from tabforge.sources.layout import OutputLayout  # noqa: F401


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    elif fmt == "json":
        w.json(path)
    else:
        raise ValueError(f"unsupported sink format: {fmt}")
    return path


def prediction_columns(scored: DataFrame, problem_type: str, prob_col: str = "prediction_proba",
                       threshold: float = 0.5) -> list:
    """Column list of the prediction part of S4-S7."""
    if problem_type == "classification":
        return [F.col(prob_col), F.col("prediction_class")]
    return [F.col("prediction")]


def prediction_table(scored: DataFrame, problem_type: str, uid: str | None,
                     target: str | None, index_col: str | None = None) -> DataFrame:
    """Id (or a row index 0..n-1) + predictions + target when known.

    ``index_col``: the row index the rows already carry; it is shared with the
    run's other tables. Without it one is made here."""
    cols = []
    if uid and uid in scored.columns:
        cols.append(quoted(uid))
    elif index_col:
        cols.append(F.col(index_col).alias("index"))
    else:
        scored = with_row_index(scored, "__index")
        cols.append(F.col("__index").alias("index"))
    cols += prediction_columns(scored, problem_type)
    if target and target in scored.columns:
        cols.append(quoted(target))
    return scored.select(*cols)


def scored_original(scored: DataFrame, original_cols: list[str], problem_type: str,
                    target: str | None, target_last: bool = False) -> DataFrame:
    """Original columns, target, predictions (target last in scoring mode)."""
    base = [quoted(c) for c in original_cols if c != target]
    tgt = [quoted(target)] if target and target in scored.columns else []
    preds = prediction_columns(scored, problem_type)
    return scored.select(*(base + preds + tgt if target_last else base + tgt + preds))


def scored_transformed(scored: DataFrame, feature_cols: list[str], problem_type: str,
                       target: str | None, target_last: bool = False,
                       names: list[str] | None = None) -> DataFrame:
    """Transformed feature columns (shown as ``names``), target, predictions.
    A vector column is written as its JSON text, which every format can hold."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT

    def plain(c: str):
        is_vector = isinstance(scored.schema[c].dataType, VectorUDT)
        return F.to_json(vector_to_array(quoted(c))) if is_vector else quoted(c)

    base = [plain(c).alias(n) for c, n in zip(feature_cols, names or feature_cols)]
    tgt = [quoted(target)] if target and target in scored.columns else []
    preds = prediction_columns(scored, problem_type)
    return scored.select(*(base + preds + tgt if target_last else base + tgt + preds))


def importance_sink(importance: DataFrame) -> DataFrame:
    """``feature, importance`` ordered by signed value, descending."""
    return importance.select("feature", "importance").orderBy(F.desc("importance"), "feature")


def manifest_frame(spark: SparkSession, model_cfg: dict, data_cfg: dict,
                   results: dict) -> DataFrame:
    """One-row manifest of both configs and the training results."""
    return spark.createDataFrame(
        [(json.dumps(model_cfg, default=str), json.dumps(data_cfg, default=str),
          json.dumps(results, default=str))],
        "modeling_config string, data_config string, training_results string")
