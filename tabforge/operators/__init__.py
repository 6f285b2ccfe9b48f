"""Operators: validation, feature preparation, exact ranks, folds / samples,
model training and scoring, attribution."""

from tabforge.operators.explain import (attribution, contributions_wide, importance_frame,
                                        importance_from_contributions, load_forest, native_importance)
from tabforge.operators.model import fit_single, load_model, save_model, score, train_cv
from tabforge.operators.prepare import FeaturePrep, FeaturePrepModel, select_features
from tabforge.operators.ranking import exact_medians, hash_rank, hash_sample
from tabforge.operators.split import assign_folds, class_weight_frame, sample_exact, with_class_weights
from tabforge.operators.validate import validate, validation_report

__all__ = [
    "attribution", "contributions_wide", "importance_frame", "importance_from_contributions",
    "load_forest", "native_importance", "fit_single", "load_model", "save_model", "score", "train_cv",
    "FeaturePrep", "FeaturePrepModel", "select_features", "exact_medians", "hash_rank", "hash_sample",
    "assign_folds", "class_weight_frame", "sample_exact", "with_class_weights", "validate",
    "validation_report",
]
