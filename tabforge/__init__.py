"""tabforge: tabular feature preparation, gradient-boosted-tree training and
attribution expressed as Spark DataFrame jobs.

Sub-packages
------------
sources    readers (CSV / parquet), null normalisation, sinks, output layout
functions  column expressions and evaluation metrics (pure aggregates)
operators  validation, feature preparation, folds / sampling, model, attribution
plans      composed jobs (train / score / prepare) and the query catalogue
streaming  stateless scoring of a streaming DataFrame
"""

from tabforge.spec import DataConfig, FeatureField, FeatureSpec, ModelConfig

__all__ = ["DataConfig", "FeatureField", "FeatureSpec", "ModelConfig"]
