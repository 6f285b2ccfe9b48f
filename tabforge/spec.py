"""Feature metadata, configuration objects and the declarative search space.

These are small driver-side objects: one entry per feature or per
hyper-parameter. Nothing here touches data.
"""

from __future__ import annotations

import ast
import json
import math
import os
from dataclasses import asdict, dataclass, field
from typing import Any

import numpy as np

FEATURE_TYPES = ("float", "category", "bool")
NUMERIC_IMPUTE = ("mean", "median", "0")
CATEGORY_IMPUTE = ("unknown", "most_frequent")
CATEGORY_TRANSFORMS = ("one-hot",)
# cells that mean "not given" in a metadata table (the transposed JSON / sheet form)
_BLANK = {None, "", "nan", "none", "null"}


def _json_at(path: str, what: str, spark=None, suffix: str = ""):
    """The JSON value of a local file, or with a session of a URI."""
    if spark is not None:
        from tabforge.sources.storage import read_text
        try:
            text = read_text(spark, path) if path.endswith(suffix) else ""
        except FileNotFoundError as e:
            raise FileNotFoundError(f"no {what} at {path}") from e
    else:
        if not os.path.exists(path):
            raise FileNotFoundError(f"no {what} at {path}")
        with open(path) as fh:
            text = fh.read()
    if not path.endswith(suffix):
        raise ValueError(f"{what} must be a {suffix} file, got {path}")
    return json.loads(text)


def _blank(v: Any) -> bool:
    if v is None:
        return True
    if isinstance(v, float) and math.isnan(v):
        return True
    return isinstance(v, str) and v.strip().lower() in _BLANK


@dataclass(frozen=True)
class FeatureField:
    name: str
    type: str
    use: int = 1
    impute: str | None = None
    transform: str | None = None
    grp: str | None = None

    @property
    def impute_method(self) -> str:
        """Imputation with defaults applied (blank -> mean / unknown; bool -> 0)."""
        if self.type == "float":
            v = None if _blank(self.impute) else str(self.impute).strip()
            if v in ("0", "0.0"):
                return "0"
            return v if v in NUMERIC_IMPUTE else "mean"
        if self.type == "category":
            v = None if _blank(self.impute) else str(self.impute).strip()
            return v if v in CATEGORY_IMPUTE else "unknown"
        return "0"

    @property
    def transform_method(self) -> str | None:
        if self.type != "category":
            return None
        return "one-hot" if _blank(self.transform) else str(self.transform).strip()


@dataclass(frozen=True)
class FeatureSpec:
    fields: tuple[FeatureField, ...]

    # -- construction -------------------------------------------------
    @staticmethod
    def from_columns(mapping: dict[str, list | tuple]) -> "FeatureSpec":
        """The metadata table in its transposed form: feature -> [type, use,
        impute, transform, group] (rows addressed by position)."""
        out = []
        for name, vals in mapping.items():
            vals = list(vals) + [None] * (5 - len(vals))
            use = vals[1]
            use = 0 if _blank(use) else int(float(use))
            out.append(FeatureField(name=name, type=str(vals[0]).strip(), use=use,
                                    impute=None if _blank(vals[2]) else str(vals[2]),
                                    transform=None if _blank(vals[3]) else str(vals[3]),
                                    grp=None if _blank(vals[4]) else str(vals[4])))
        return FeatureSpec(tuple(out))

    @staticmethod
    def from_records(records: list[dict]) -> "FeatureSpec":
        return FeatureSpec(tuple(
            FeatureField(name=r["name"], type=str(r["type"]).strip(),
                         use=0 if _blank(r.get("use")) else int(float(r.get("use"))),
                         impute=None if _blank(r.get("impute")) else str(r.get("impute")),
                         transform=None if _blank(r.get("transform")) else str(r.get("transform")),
                         grp=None if _blank(r.get("grp")) else str(r.get("grp")))
            for r in records))

    @staticmethod
    def from_json_file(path: str, spark=None) -> "FeatureSpec":
        """From a local file, or with a session from any URI that Spark reads."""
        if not path:
            raise ValueError("the data configuration names no metadata_file_path")
        obj = _json_at(path, "feature metadata", spark, ".json")
        if isinstance(obj, list):
            return FeatureSpec.from_records(obj)
        return FeatureSpec.from_columns(obj)

    def to_records(self) -> list[dict]:
        return [asdict(f) for f in self.fields]

    def to_json(self) -> str:
        return json.dumps(self.to_records())

    @staticmethod
    def from_json(text: str) -> "FeatureSpec":
        return FeatureSpec.from_records(json.loads(text))

    # -- queries --------------------------------------------------------
    def get(self, name: str) -> FeatureField | None:
        for f in self.fields:
            if f.name == name:
                return f
        return None

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def used(self, columns: list[str], exclude: tuple[str, ...] = ()) -> list[FeatureField]:
        """Fields with use == 1 that are present in ``columns``, in data column order."""
        by_name = {f.name: f for f in self.fields}
        return [by_name[c] for c in columns
                if c in by_name and by_name[c].use == 1 and c not in exclude]

    def problems(self) -> list[str]:
        """Metadata errors (unknown types / transforms)."""
        errs = []
        for f in self.fields:
            if f.use != 1:
                continue
            if f.type not in FEATURE_TYPES:
                errs.append(f"Feature '{f.name}' has unsupported type '{f.type}'")
            if f.type == "category" and f.transform_method not in CATEGORY_TRANSFORMS:
                errs.append(f"Feature '{f.name}' has unsupported transform '{f.transform}'")
        return errs


# ---------------------------------------------------------------------------
# configuration objects
# ---------------------------------------------------------------------------

METRIC_SIGN = {"rocauc": 1.0, "auc": 1.0, "r2": 1.0, "accuracy": 1.0, "f1": 1.0,
               "mse": -1.0, "rmse": -1.0}


@dataclass
class ModelConfig:
    target_variable: str = "target"
    problem_type: str = "classification"
    evaluation_metric: str = "rocauc"
    better_performance: str = "gt"
    models: list = field(default_factory=lambda: ["lgbm"])
    use_custom_splits: bool = False
    retrain_with_whole_dataset: bool = True
    sample_for_contribution: float = 1.0
    importance_extraction_method: str = "shap"
    num_hp_searches: int = 10
    hyperparameter_space: dict = field(default_factory=dict)
    n_folds: int = 5
    seed: int = 42
    param_selection: str = "best_mean"      # or "first_fold" (parity)
    sampler: str = "tpe"                    # Parzen estimators, or "random" trials
    study: str = "shared"                   # one study on the folds' mean score, or one "per_fold"
    search_batch: int = 5                   # trials proposed together
    fit_scope: str = "all"                  # preparation fitted on all rows, or per fold ("fold")
    parallelism: int = 4
    category_encoding: str = "columns"      # one column a category, or one sparse "vector" a feature
    exact_folds: bool = True                # False: folds by hash, without a shuffle

    @staticmethod
    def from_dict(d: dict) -> "ModelConfig":
        known = {k: v for k, v in d.items() if k in ModelConfig.__dataclass_fields__}
        cfg = ModelConfig(**known)
        cfg.check()
        return cfg

    @staticmethod
    def from_json_file(path: str, spark=None) -> "ModelConfig":
        """From a local file, or with a session from any URI that Spark reads."""
        return ModelConfig.from_dict(_json_at(path, "model configuration", spark))

    def check(self) -> None:
        if self.problem_type not in ("classification", "regression"):
            raise ValueError(f"Unsupported problem type: {self.problem_type}")
        if self.evaluation_metric not in METRIC_SIGN:
            raise ValueError(f"Unsupported evaluation metric: {self.evaluation_metric}")
        sign = METRIC_SIGN[self.evaluation_metric]
        expected = "gt" if sign > 0 else "lt"
        if self.better_performance not in ("gt", "lt"):
            raise ValueError(f"better_performance must be 'gt' or 'lt', got {self.better_performance}")
        if self.better_performance != expected:
            raise ValueError(f"metric '{self.evaluation_metric}' is better when "
                             f"'{expected}', config says '{self.better_performance}'")
        if self.importance_extraction_method not in ("shap", "treeinterpreter"):
            raise ValueError(f"Unsupported importance method: {self.importance_extraction_method}")
        if self.category_encoding not in ("columns", "vector", "dictionary"):
            raise ValueError(f"category_encoding must be 'columns', 'vector' or 'dictionary', got {self.category_encoding}")
        if self.sampler not in ("tpe", "random"):
            raise ValueError(f"sampler must be 'tpe' or 'random', got {self.sampler}")
        if self.study not in ("shared", "per_fold"):
            raise ValueError(f"study must be 'shared' or 'per_fold', got {self.study}")
        if int(self.search_batch) < 1:
            raise ValueError("search_batch must be 1 or more")
        if self.fit_scope not in ("all", "fold"):
            raise ValueError(f"fit_scope must be 'all' or 'fold', got {self.fit_scope}")
        if not 0 < float(self.sample_for_contribution) <= 1:
            raise ValueError("sample_for_contribution must be in (0, 1]")

    @property
    def metric_sign(self) -> float:
        return METRIC_SIGN[self.evaluation_metric]

    def to_dict(self) -> dict:
        return asdict(self)


@dataclass
class DataConfig:
    training: bool = False
    metadata_file_path: str | None = None
    input_data_source: str = "CSV"
    file_path: str | None = None
    data_processor_file_path: str | None = None
    model_file_path: str | None = None
    uid_column_name: str | None = None
    predictions_output_path: str | None = None
    calculate_importance: bool = False
    row_contributions: bool = True   # with the importance, write every row's contributions
    output_base: str | None = None
    run_id: str | None = None
    csv_multi_line: bool = False     # cells with line breaks (such files cannot be split)
    test_file_path: str | None = None    # training: a held-out table for the final model's metrics

    @staticmethod
    def from_dict(d: dict) -> "DataConfig":
        return DataConfig(**{k: v for k, v in d.items() if k in DataConfig.__dataclass_fields__})

    @staticmethod
    def from_json_file(path: str, spark=None) -> "DataConfig":
        """From a local file, or with a session from any URI that Spark reads."""
        return DataConfig.from_dict(_json_at(path, "data configuration", spark))

    def to_dict(self) -> dict:
        return asdict(self)


# ---------------------------------------------------------------------------
# hyper-parameter space: declarative parse of "trial.suggest_*(...)" strings
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class ParamDist:
    name: str            # key in the space
    kind: str            # categorical | uniform | loguniform | discrete_uniform | int
    args: tuple
    cast: str | None = None   # "int" / "float" wrapper

    def draw(self, rng: np.random.Generator):
        if self.kind == "categorical":
            choices = list(self.args[0])
            v = choices[int(rng.integers(len(choices)))]
        elif self.kind == "uniform":
            lo, hi = self.args
            v = float(rng.uniform(lo, hi))
        elif self.kind == "loguniform":
            lo, hi = self.args
            v = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
        elif self.kind == "discrete_uniform":
            lo, hi, q = self.args
            steps = int(math.floor((hi - lo) / q + 1e-9))
            v = float(lo + q * int(rng.integers(steps + 1)))
            v = round(v, 12)      # 30 + 3 * 0.1 stays 30.3, and int() of a whole step stays that step
        elif self.kind == "int":
            lo, hi, step, log = self.args
            if log:
                v = int(min(hi, max(lo, round(math.exp(rng.uniform(math.log(lo), math.log(hi)))))))
            else:
                v = int(lo) + int(step) * int(rng.integers((int(hi) - int(lo)) // int(step) + 1))
        else:  # pragma: no cover - rejected at parse time
            raise ValueError(self.kind)
        if self.cast == "int" and v is not None:
            v = int(v)
        elif self.cast == "float" and v is not None:
            v = float(v)
        return v


_SUGGEST = {
    "suggest_categorical": "categorical",
    "suggest_uniform": "uniform",
    "suggest_loguniform": "loguniform",
    "suggest_discrete_uniform": "discrete_uniform",
    "suggest_int": "int",
    "suggest_float": "uniform",
}


# Parameter names of the search calls, in their public order.
_PARAMETERS = {
    "suggest_categorical": ("name", "choices"),
    "suggest_uniform": ("name", "low", "high"),
    "suggest_loguniform": ("name", "low", "high"),
    "suggest_discrete_uniform": ("name", "low", "high", "q"),
    "suggest_int": ("name", "low", "high", "step", "log"),
    "suggest_float": ("name", "low", "high", "step", "log"),
}


def _literal(node: ast.AST):
    return ast.literal_eval(node)


def parse_param(key: str, text: str) -> ParamDist:
    """Parse one search-space entry such as
    ``int(trial.suggest_discrete_uniform('num_leaves', 30, 150, 1))``.
    Only ``trial.suggest_*`` calls with literal arguments, optionally wrapped
    in ``int(...)`` / ``float(...)``, are accepted."""
    try:
        tree = ast.parse(text.strip(), mode="eval").body
    except SyntaxError as e:
        raise ValueError(f"hyper-parameter '{key}': cannot parse {text!r}") from e
    cast = None
    if (isinstance(tree, ast.Call) and isinstance(tree.func, ast.Name)
            and tree.func.id in ("int", "float") and len(tree.args) == 1):
        cast = tree.func.id
        tree = tree.args[0]
    if not (isinstance(tree, ast.Call) and isinstance(tree.func, ast.Attribute)
            and isinstance(tree.func.value, ast.Name) and tree.func.value.id == "trial"
            and tree.func.attr in _SUGGEST):
        raise ValueError(f"hyper-parameter '{key}': unsupported expression {text!r}")
    args = [_literal(a) for a in tree.args]
    kwargs = {k.arg: _literal(k.value) for k in tree.keywords}
    kind = _SUGGEST[tree.func.attr]
    order = _PARAMETERS[tree.func.attr]
    if len(args) > len(order) or set(kwargs) - set(order) or set(order[:len(args)]) & set(kwargs):
        raise ValueError(f"hyper-parameter '{key}': wrong arguments in {text!r}")
    given = dict(zip(order, args)) | kwargs
    if kind == "categorical":
        choices = tuple(given.get("choices") or ())
        if not choices:
            raise ValueError(f"hyper-parameter '{key}': no choices in {text!r}")
        return ParamDist(name=key, kind=kind, args=(choices,), cast=cast)
    if "low" not in given or "high" not in given or given["low"] > given["high"]:
        raise ValueError(f"hyper-parameter '{key}': needs low <= high in {text!r}")
    low, high, step, log = given["low"], given["high"], given.get("step", given.get("q")), bool(given.get("log"))
    if (log or kind == "loguniform") and low <= 0 or step is not None and step <= 0 or log and step not in (None, 1):
        raise ValueError(f"hyper-parameter '{key}': bad bounds or step in {text!r}")
    if kind == "int":
        return ParamDist(name=key, kind=kind, args=(low, high, step or 1, log), cast=cast)
    if log:
        kind = "loguniform"
    elif step is not None:
        kind = "discrete_uniform"
    elif kind == "discrete_uniform":
        raise ValueError(f"hyper-parameter '{key}': needs a step in {text!r}")
    vals = (low, high, step) if kind == "discrete_uniform" else (low, high)
    return ParamDist(name=key, kind=kind, args=vals, cast=cast)


def parse_space(space: dict[str, str]) -> list[ParamDist]:
    return [parse_param(k, v) for k, v in space.items()]


def draw_trials(space: list[ParamDist], n_trials: int, seed: int) -> list[dict]:
    """Deterministic random-search trial table."""
    rng = np.random.default_rng(seed)
    return [{p.name: p.draw(rng) for p in space} for _ in range(n_trials)]
