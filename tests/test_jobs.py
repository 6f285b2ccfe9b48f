"""End-to-end train and score jobs."""

import json
import os

import numpy as np
import pytest

from tabforge.plans import jobs
from tabforge.spec import DataConfig, FeatureSpec, ModelConfig


@pytest.fixture(scope="module")
def workspace(tmp_path_factory):
    """Orders of a shop: repeat customers pay little and buy in season."""
    d = tmp_path_factory.mktemp("pipe")
    rng = np.random.default_rng(7)
    n = 110
    price, age = rng.gamma(2.0, 20.0, n), rng.integers(18, 80, n)
    season = rng.choice(["spring", "summer", "winter"], n)
    member = rng.random(n) < 0.4
    label = ((price < 35) & ((season != "winter") | member)).astype(int)
    lines = ["order_no,price,age,season,member,repeat"]
    lines += [f"{1000 + i},{price[i]:.3f},{age[i]},{season[i]},{member[i]},{label[i]}" for i in range(n)]
    held = set(range(0, n, 5))
    for name, rows in (("train", [i for i in range(n) if i not in held]), ("test", sorted(held))):
        (d / f"{name}.csv").write_text("\n".join([lines[0], *[lines[i + 1] for i in rows]]) + "\n")
    meta = {"order_no": ["category", 0, "unknown", None, "key"], "repeat": ["bool", 1, "unknown", None, "label"],
            "price": ["float", 1, "median", None, "x"], "age": ["float", 1, "mean", None, "x"],
            "season": ["category", 1, "most_frequent", "one-hot", "x"], "member": ["bool", 1, "unknown", None, "x"]}
    (d / "meta.json").write_text(json.dumps(meta))
    return d


MODEL_CFG = {
    "target_variable": "repeat", "problem_type": "classification", "evaluation_metric": "rocauc",
    "better_performance": "gt", "models": ["lgbm"], "retrain_with_whole_dataset": True,
    "importance_extraction_method": "shap", "sample_for_contribution": 0.25, "num_hp_searches": 2, "n_folds": 3,
    "hyperparameter_space": {"lgbm": {
        "learning_rate": "trial.suggest_float('learning_rate', 0.1, 0.4, log=True)",
        "num_leaves": "trial.suggest_int('num_leaves', 4, 8, step=4)",
        "n_estimators": "trial.suggest_int('n_estimators', 5, 12)"}},
}


def test_train_then_predict(spark, workspace):
    d = workspace
    mcfg = ModelConfig.from_dict(MODEL_CFG)
    tcfg = DataConfig(training=True, metadata_file_path=str(d / "meta.json"), input_data_source="CSV",
                      file_path=str(d / "train.csv"), uid_column_name="order_no", run_id="run1",
                      test_file_path=str(d / "test.csv"))
    res = jobs.train(spark, mcfg, tcfg)
    root = res.output_dir
    assert res.success and os.path.isdir(f"{root}/model/repeat_classification_lgbm/spark_model")
    assert os.path.isdir(f"{root}/model/metrics")
    for sub in ("predictions/original_data_with_predictions", "predictions/transformed_data_with_predictions",
                "deep_insights_input/native_feature_importance", "deep_insights_input/shap_feature_importance",
                "deep_insights_input/shap_values", "training_config"):
        assert os.path.isdir(f"{root}/{sub}"), sub
    assert res.details["training_results"]["cv_mean_val_score"] >= 0.0
    assert set(res.details["training_results"]) >= {"test_roc_auc", "test_recall"}
    orig = spark.read.option("header", True).csv(f"{root}/predictions/original_data_with_predictions")
    assert orig.count() == 88 and {"prediction_proba", "prediction_class", "repeat"} <= set(orig.columns)
    shap_rows = spark.read.option("header", True).csv(f"{root}/deep_insights_input/shap_values").count()
    assert shap_rows == 22                                      # K3: int(88 * 0.25)

    pcfg = DataConfig(training=False, metadata_file_path=str(d / "meta.json"), input_data_source="CSV",
                      file_path=str(d / "test.csv"), uid_column_name="order_no",
                      model_file_path=f"{root}/model/repeat_classification_lgbm",
                      data_processor_file_path=f"{root}/deep_insights_input/repeat_classification_lgbm_data_processor",
                      predictions_output_path=f"{root}/scored", run_id="run2", calculate_importance=True)
    out = jobs.predict(spark, mcfg, pcfg)
    assert out.details["num_predictions"] == 22
    assert out.details["importance"] == pytest.approx(res.details["importance"])      # stored with the model
    pred = spark.read.option("header", True).csv(f"{root}/scored").toPandas()
    assert list(pred.columns) == ["order_no", "prediction_proba", "prediction_class", "repeat"]
    p = pred["prediction_proba"].astype(float)
    assert ((p >= 0) & (p <= 1)).all() and set(pred["prediction_class"].astype(int)) <= {0, 1}


def test_predict_without_target(spark, workspace, tmp_path):
    d = workspace
    lines = (d / "test.csv").read_text().splitlines()
    (tmp_path / "nt.csv").write_text("\n".join(",".join(l.split(",")[:-1]) for l in lines) + "\n")
    mcfg = ModelConfig.from_dict(MODEL_CFG)
    root = f"{d}/run1"
    if not os.path.isdir(root):
        pytest.skip("training run missing")
    pcfg = DataConfig(training=False, metadata_file_path=str(d / "meta.json"), input_data_source="CSV",
                      file_path=str(tmp_path / "nt.csv"), uid_column_name="order_no",
                      model_file_path=f"{root}/model/repeat_classification_lgbm",
                      data_processor_file_path=f"{root}/deep_insights_input/repeat_classification_lgbm_data_processor",
                      run_id="run3")
    out = jobs.predict(spark, mcfg, pcfg)
    assert out.details["num_predictions"] == 22
    pred = spark.read.option("header", True).csv(out.details["output_path"])
    assert pred.columns == ["order_no", "prediction_proba", "prediction_class"]


def test_training_requires_target(spark, workspace, tmp_path):
    d = workspace
    lines = (d / "train.csv").read_text().splitlines()
    (tmp_path / "nt.csv").write_text("\n".join(",".join(l.split(",")[:-1]) for l in lines) + "\n")
    cfg = DataConfig(training=True, metadata_file_path=str(d / "meta.json"), input_data_source="CSV",
                     file_path=str(tmp_path / "nt.csv"))
    with pytest.raises(ValueError):
        jobs.train(spark, ModelConfig.from_dict(MODEL_CFG), cfg)


def test_regression_job(spark, workspace, tmp_path):
    d = workspace
    meta = json.loads((d / "meta.json").read_text())
    meta["age"] = ["float", 1, "mean", None, "label"]                # regression target
    (tmp_path / "meta.json").write_text(json.dumps(meta))
    cfg = dict(MODEL_CFG, target_variable="age", problem_type="regression", evaluation_metric="rmse",
               better_performance="lt", num_hp_searches=1, importance_extraction_method="treeinterpreter",
               sample_for_contribution=1.0, retrain_with_whole_dataset=False)
    tcfg = DataConfig(training=True, metadata_file_path=str(tmp_path / "meta.json"), input_data_source="CSV",
                      file_path=str(d / "train.csv"), uid_column_name="order_no", run_id="reg",
                      output_base=str(tmp_path))
    res = jobs.train(spark, ModelConfig.from_dict(cfg), tcfg)
    root = res.output_dir
    assert res.details["training_results"]["cv_mean_val_score"] >= 0
    pred = spark.read.option("header", True).csv(f"{root}/predictions/original_data_with_predictions")
    assert pred.count() == 88 and "prediction" in pred.columns
    contrib = spark.read.option("header", True).csv(f"{root}/deep_insights_input/treeinterpreter_contributions")
    assert contrib.count() == 88 and "order_no" in contrib.columns


def test_single_class_label_rejected(spark, workspace, tmp_path):
    d = workspace
    lines = (d / "train.csv").read_text().splitlines()
    one = [lines[0]] + [",".join(l.split(",")[:-1] + ["1"]) for l in lines[1:]]
    (tmp_path / "one.csv").write_text("\n".join(one) + "\n")
    cfg = DataConfig(training=True, metadata_file_path=str(d / "meta.json"), input_data_source="CSV",
                     file_path=str(tmp_path / "one.csv"))
    with pytest.raises(ValueError, match="single class"):
        jobs.train(spark, ModelConfig.from_dict(MODEL_CFG), cfg)


def test_fold_scoped_preparation(spark, workspace, tmp_path):
    d = workspace
    cfg = dict(MODEL_CFG, fit_scope="fold", num_hp_searches=1, sample_for_contribution=0.25)
    tcfg = DataConfig(training=True, metadata_file_path=str(d / "meta.json"), input_data_source="CSV",
                      file_path=str(d / "train.csv"), uid_column_name="order_no", run_id="foldscope",
                      output_base=str(tmp_path))
    res = jobs.train(spark, ModelConfig.from_dict(cfg), tcfg)
    tr = res.details["training_results"]
    assert 0.0 <= tr["cv_mean_val_score"] <= 1.0 and tr["cv_mean_train_score"] > 0.5


def test_rows_without_id_share_one_index(spark, workspace, tmp_path):
    """Predictions and contributions join on index 0..n-1 without a loss; the
    scored labels give metrics."""
    d = workspace
    root = f"{d}/run1"
    if not os.path.isdir(root):
        pytest.skip("training run missing")
    pcfg = DataConfig(training=False, metadata_file_path=str(d / "meta.json"), input_data_source="CSV",
                      file_path=str(d / "test.csv"), model_file_path=f"{root}/model/repeat_classification_lgbm",
                      data_processor_file_path=f"{root}/deep_insights_input/repeat_classification_lgbm_data_processor",
                      output_base=str(tmp_path), run_id="noid", calculate_importance=True)
    cfg = ModelConfig.from_dict(dict(MODEL_CFG, sample_for_contribution=1.0))
    out = jobs.predict(spark, cfg, pcfg)
    pred = spark.read.option("header", True).csv(out.details["output_path"])
    shap = spark.read.option("header", True).csv(f"{out.output_dir}/deep_insights_input/shap_values")
    assert sorted(int(r["index"]) for r in pred.collect()) == list(range(22))
    assert pred.join(shap, "index").count() == 22
    assert set(out.details["metrics"]) >= {"test_roc_auc", "test_f1"}


@pytest.mark.parametrize("encoding", ["columns", "vector"])
def test_many_and_odd_categories_write_every_sink(spark, tmp_path, encoding):
    n = 1300 if encoding == "columns" else 2600
    odd = ["3.5", "St. Louis", "A", "a", "back`tick", "missing", 'say ""hi""', "x, y"]
    lines = ["k,town,size,ok"] + [
        f'{i},"{odd[i // 2 % 8] if i % 2 else f"town {i % 1200}"}",{i % 17},{int(i % 17 > 8 or i % 5 == 0)}' for i in range(n)]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    spec = FeatureSpec.from_columns({"k": ["category", 0, None, None, None], "town": ["category", 1, None, None, None],
                                     "size": ["float", 1, None, None, None], "ok": ["bool", 1, None, None, None]})
    cfg = ModelConfig.from_dict(dict(
        MODEL_CFG, target_variable="ok", num_hp_searches=1, n_folds=2, category_encoding=encoding,
        sample_for_contribution=0.02, hyperparameter_space={"lgbm": {"n_estimators": "trial.suggest_int('n', 2, 2)",
                                                                     "num_leaves": "trial.suggest_int('l', 4, 4)"}}))
    res = jobs.train(spark, cfg, DataConfig(training=True, file_path=str(tmp_path / "t.csv"), run_id="many",
                                            output_base=str(tmp_path)), spec=spec)
    for name in ("predictions/original_data_with_predictions", "predictions/transformed_data_with_predictions",
                 "deep_insights_input/shap_values", "deep_insights_input/native_feature_importance",
                 "model/fold_scores", "model/fold_importance"):
        assert os.path.isdir(f"{res.output_dir}/{name}"), name
    towns = spark.read.option("header", True).option("escape", '"').csv(
        f"{res.output_dir}/predictions/original_data_with_predictions")
    assert towns.count() == n and {r.town for r in towns.select("town").distinct().collect()} >= {
        "3.5", "St. Louis", "A", "a", "back`tick", "x, y", 'say "hi"'}


def test_custom_folds_are_used(spark, workspace, tmp_path):
    d = workspace
    lines = (d / "train.csv").read_text().splitlines()
    (tmp_path / "f.csv").write_text("\n".join([lines[0] + ",fold"] + [f"{x},{i % 3}" for i, x in enumerate(lines[1:])]) + "\n")
    cfg = ModelConfig.from_dict(dict(MODEL_CFG, use_custom_splits=True, num_hp_searches=1))
    tcfg = DataConfig(training=True, metadata_file_path=str(d / "meta.json"), file_path=str(tmp_path / "f.csv"),
                      uid_column_name="order_no", output_base=str(tmp_path), run_id="custom")
    res = jobs.train(spark, cfg, tcfg)
    orig = spark.read.option("header", True).csv(f"{res.output_dir}/predictions/original_data_with_predictions")
    assert {r.fold for r in orig.select("fold").distinct().collect()} == {"0", "1", "2"}
    with pytest.raises(ValueError, match="fold"):
        jobs.train(spark, cfg, DataConfig(training=True, metadata_file_path=str(d / "meta.json"),
                                          file_path=str(d / "train.csv"), output_base=str(tmp_path)))


def test_label_that_is_not_a_number_is_an_error(spark, workspace, tmp_path):
    d = workspace
    lines = (d / "train.csv").read_text().splitlines()
    lines[3] = ",".join(lines[3].split(",")[:-1] + ["x"])
    (tmp_path / "bad.csv").write_text("\n".join(lines) + "\n")
    cfg = DataConfig(training=True, metadata_file_path=str(d / "meta.json"), file_path=str(tmp_path / "bad.csv"))
    with pytest.raises(ValueError, match="not numbers"):
        jobs.train(spark, ModelConfig.from_dict(MODEL_CFG), cfg)


def _uri_workspace(workspace, base):
    return {"metadata_file_path": (workspace / "meta.json").as_uri(), "input_data_source": "CSV",
            "uid_column_name": "order_no", "output_base": base.as_uri()}


def test_jobs_by_uri_and_stored_importance(spark, workspace, tmp_path, monkeypatch):
    """Metadata, configurations, data and outputs named by file: URIs; scoring
    compares the metadata, and takes the stored importance without an attribution."""
    from tabforge.sources.storage import committed
    base = _uri_workspace(workspace, tmp_path)
    (tmp_path / "model.json").write_text(json.dumps(MODEL_CFG))
    (tmp_path / "data.json").write_text(json.dumps(dict(base, training=True, run_id="r1", file_path=(workspace / "train.csv").as_uri())))
    mcfg = ModelConfig.from_json_file((tmp_path / "model.json").as_uri(), spark)
    res = jobs.train(spark, mcfg, DataConfig.from_json_file((tmp_path / "data.json").as_uri(), spark))
    assert res.output_dir == f"{tmp_path.as_uri()}/r1" and committed(spark, res.output_dir)
    assert sorted(p.name for p in (tmp_path / "r1").iterdir()) == ["deep_insights_input", "model", "predictions", "training_config"]
    changed = json.loads((workspace / "meta.json").read_text())
    changed = {k: v for k, v in changed.items() if k != list(changed)[-1]}
    (tmp_path / "meta2.json").write_text(json.dumps(changed))
    pcfg = DataConfig(**dict(base, metadata_file_path=(tmp_path / "meta2.json").as_uri()), file_path=(workspace / "test.csv").as_uri(),
                      model_file_path=f"{res.output_dir}/model/repeat_classification_lgbm",
                      data_processor_file_path=f"{res.output_dir}/deep_insights_input/repeat_classification_lgbm_data_processor",
                      run_id="r2", calculate_importance=True, row_contributions=False)

    def no_attribution(*a, **k):
        raise AssertionError("the stored importance serves")

    monkeypatch.setattr(jobs, "_attribution_outputs", no_attribution)
    with pytest.warns(UserWarning, match="metadata file differs"):
        out = jobs.predict(spark, mcfg, pcfg)
    assert out.details["importance"] == pytest.approx(res.details["importance"])
    assert spark.read.option("header", True).csv(f"{out.output_dir}/deep_insights_input/shap_feature_importance").count() == len(
        res.details["importance"])
    assert committed(spark, out.output_dir, "prediction_config")
    assert spark.read.option("header", True).csv(out.details["output_path"]).count() == 22
    with pytest.raises(FileNotFoundError):
        ModelConfig.from_json_file((tmp_path / "none.json").as_uri(), spark)


@pytest.mark.parametrize("broken", [1, 4])
def test_a_failed_run_leaves_nothing(spark, workspace, tmp_path, monkeypatch, broken):
    """A sink that breaks midway: no output can be read, and an earlier run of
    the same id stays as it was."""
    from tabforge.sources.storage import committed
    old = tmp_path / "run" / "model"
    old.mkdir(parents=True)
    (old / "kept").write_text("x")
    written = []

    def write(df, path, fmt="csv", *a, **k):
        written.append(path)
        if len(written) == broken:
            raise OSError("disk full")
        return real(df, path, fmt, *a, **k)

    real = jobs.write_table
    monkeypatch.setattr(jobs, "write_table", write)
    cfg = DataConfig(training=True, run_id="run", file_path=(workspace / "train.csv").as_uri(), **_uri_workspace(workspace, tmp_path))
    with pytest.raises(OSError, match="disk full"):
        jobs.train(spark, ModelConfig.from_dict(MODEL_CFG), cfg)
    assert len(written) == broken and [p.name for p in old.iterdir()] == ["kept"]
    assert not committed(spark, f"{tmp_path.as_uri()}/run")
    assert not list((tmp_path / "_staging").glob("*"))
