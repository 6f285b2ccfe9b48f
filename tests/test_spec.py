"""Metadata and configuration parsing."""

import json
import math

import pytest

from tabforge.spec import FeatureSpec, ModelConfig, draw_trials, parse_param, parse_space

PARCELS = {
    "ticket": ["category", 0, "unknown", float("nan"), "keys"],
    "late": ["bool", 1, "unknown", float("nan"), "label"],
    "weight": ["float", 1, "median", float("nan"), "x"],
    "carrier": ["category", 1, "unknown", "one-hot", "x"],
    "fragile": ["bool", 1, "unknown", float("nan"), "x"],
}


def test_metadata_rows_parsed(tmp_path):
    p = tmp_path / "meta.json"
    p.write_text(json.dumps({k: [None if isinstance(x, float) else x for x in v] for k, v in PARCELS.items()}))
    spec = FeatureSpec.from_json_file(str(p))
    assert spec.get("weight").type == "float"
    assert spec.get("weight").use == 1
    assert spec.get("ticket").use == 0
    assert spec.get("weight").impute_method == "median"
    assert spec.get("carrier").transform_method == "one-hot"


def test_blank_cells_take_defaults():
    spec = FeatureSpec.from_columns({"c": ["category", 1, float("nan"), "NaN", "g"],
                                     "x": ["float", 1, "", None, None],
                                     "z": ["float", 1, 0, None, None]})
    assert spec.get("c").transform_method == "one-hot"
    assert spec.get("c").impute_method == "unknown"
    assert spec.get("x").impute_method == "mean"
    assert spec.get("z").impute_method == "0"      # numeric 0 accepted (not only the string)


def test_usage_filter_keeps_data_order():
    spec = FeatureSpec.from_columns(PARCELS)
    used = [f.name for f in spec.used(["fragile", "ticket", "weight", "late"], exclude=("late",))]
    assert used == ["fragile", "weight"]


def test_metadata_errors(tmp_path):
    with pytest.raises(FileNotFoundError):
        FeatureSpec.from_json_file(str(tmp_path / "missing.json"))
    bad = tmp_path / "m.txt"
    bad.write_text("{}")
    with pytest.raises(ValueError):
        FeatureSpec.from_json_file(str(bad))
    spec = FeatureSpec.from_columns({"a": ["text", 1, None, None, None],
                                     "b": ["category", 1, None, "hashing", None]})
    assert len(spec.problems()) == 2


def test_search_space_parse_and_draw():
    space = parse_space({
        "objective": "trial.suggest_categorical('objective', ['binary'])",
        "bagging_fraction": "trial.suggest_loguniform('bagging_fraction', 0.25, 0.95)",
        "max_depth": "int(trial.suggest_discrete_uniform('max_depth', 3, 12, 3))",
        "min_gain": "trial.suggest_uniform('min_gain', -0.5, 0.5)",
        "weighting": "trial.suggest_categorical('weighting', ['none', None, 'sqrt'])",
        "max_bin": "int(trial.suggest_discrete_uniform('max_bin', 16, 240, 32))",
    })
    a, b = draw_trials(space, 9, 7), draw_trials(space, 9, 7)
    assert a == b and len({str(t) for t in a}) > 1
    for t in a:
        assert t["objective"] == "binary" and t["weighting"] in ("none", None, "sqrt")
        assert 0.25 <= t["bagging_fraction"] <= 0.95 and -0.5 <= t["min_gain"] <= 0.5
        assert type(t["max_depth"]) is int and t["max_depth"] in (3, 6, 9, 12)
        assert (t["max_bin"] - 16) % 32 == 0


def test_search_space_rejects_code():
    with pytest.raises(ValueError):
        parse_param("x", "__import__('os').system('true')")
    with pytest.raises(ValueError):
        parse_param("x", "trial.suggest_uniform('x', 0, 1) + 1")


def test_metric_direction_is_checked():
    ModelConfig.from_dict({"evaluation_metric": "rmse", "better_performance": "lt", "problem_type": "regression"})
    with pytest.raises(ValueError):
        ModelConfig.from_dict({"evaluation_metric": "mse", "better_performance": "gt"})
    with pytest.raises(ValueError):
        ModelConfig.from_dict({"evaluation_metric": "logloss"})
    assert ModelConfig.from_dict({}).metric_sign == 1.0
    assert math.isclose(ModelConfig.from_dict({"evaluation_metric": "rmse", "better_performance": "lt"}).metric_sign, -1)


def test_config_files_and_defaults(tmp_path):
    from tabforge.spec import DataConfig
    p = tmp_path / "data.json"
    p.write_text(json.dumps({"training": True, "metadata_file_path": "/m.json", "input_data_source": "CSV",
                             "file_path": "/d.csv", "unknown_key": 1}))
    cfg = DataConfig.from_json_file(str(p))
    assert cfg.training and cfg.input_data_source == "CSV" and cfg.file_path == "/d.csv"
    with pytest.raises(FileNotFoundError):
        DataConfig.from_json_file(str(tmp_path / "nope.json"))
    m = ModelConfig.from_dict({})
    assert (m.problem_type, m.evaluation_metric, m.better_performance) == ("classification", "rocauc", "gt")
    assert m.num_hp_searches == 10 and m.retrain_with_whole_dataset and m.sample_for_contribution == 1.0
    assert m.importance_extraction_method == "shap" and m.n_folds == 5 and m.seed == 42


def test_search_grammar():
    import numpy as np
    draws = [parse_param("n", "trial.suggest_int('n', 10, 100, step=10)").draw(np.random.default_rng(i)) for i in range(200)]
    assert set(draws) == set(range(10, 101, 10))
    low = parse_param("u", "trial.suggest_uniform('u', low=0.2, high=0.4)")
    assert all(0.2 <= low.draw(np.random.default_rng(i)) <= 0.4 for i in range(50))
    cut = parse_param("c", "int(trial.suggest_uniform('c', 1, 3))")
    assert {cut.draw(np.random.default_rng(i)) for i in range(100)} == {1, 2}
    log = [parse_param("g", "trial.suggest_float('g', 1e-4, 1.0, log=True)").draw(np.random.default_rng(i)) for i in range(300)]
    assert 0.35 < sum(x < 1e-2 for x in log) / 300 < 0.65
    for bad in ("trial.suggest_int('n', 10)", "trial.suggest_int('n', 5, 1)", "trial.suggest_float('f', 0, 1, log=True)",
                "trial.suggest_int('n', 1, 9, width=2)", "trial.suggest_categorical('c', [])"):
        with pytest.raises(ValueError):
            parse_param("p", bad)
