"""Column expressions and evaluation metrics (JVM-side built-ins)."""

from tabforge.functions.columns import positive_probability, range_bucket, sigmoid, threshold_class
from tabforge.functions.metrics import (auc_frame, classification_metrics, metric_value, metrics_long,
                                        regression_metrics, roc_auc)

__all__ = ["positive_probability", "range_bucket", "sigmoid", "threshold_class", "auc_frame",
           "classification_metrics", "metric_value", "metrics_long", "regression_metrics", "roc_auc"]
