"""Model training, scoring, persistence and attribution."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.operators import explain
from tabforge.operators.ensemble import round_scores
from tabforge.operators.model import (fit_single, kept_rounds, load_model, rank_score, save_model, score,
                                      spark_params, train_cv)
from tabforge.spec import ModelConfig

FEATS = [f"feature_{i}" for i in range(1, 6)]
SPACE = {
    "learning_rate": "trial.suggest_float('learning_rate', 0.1, 0.3, log=True)",
    "num_leaves": "trial.suggest_int('num_leaves', 4, 8, step=4)",
    "feature_fraction": "trial.suggest_uniform('feature_fraction', low=0.7, high=1.0)",
    "n_estimators": "trial.suggest_int('n_estimators', 6, 14)",
    "min_data_in_leaf": "trial.suggest_categorical('min_data_in_leaf', [2, 3])",
}


@pytest.fixture(scope="module")
def f4(spark):
    """A ring: the label is the distance from the origin in two of five features."""
    rng = np.random.default_rng(11)
    X = rng.uniform(-1, 1, (100, 5))
    y = (X[:, 0] ** 2 + X[:, 2] ** 2 < 0.6).astype(float)
    df = spark.createDataFrame([(i, *map(float, X[i]), float(y[i])) for i in range(100)],
                               "rid long, " + ", ".join(f"{c} double" for c in FEATS) + ", target double")
    return VectorAssembler(inputCols=FEATS, outputCol="features").transform(df).cache()


@pytest.fixture(scope="module")
def trained(spark, f4):
    cfg = ModelConfig.from_dict({"target_variable": "target", "num_hp_searches": 2,
                                 "hyperparameter_space": {"lgbm": SPACE}})
    return train_cv(f4, cfg, "target", id_cols=["rid"])


def test_cv_quality_floor(trained):
    s = trained.summary
    assert s["cv_mean_val_score"] > 0.5
    assert len(trained.trials) == 10 and len(trained.fold_scores) == 5
    assert set(trained.best_params) >= {"learning_rate", "num_leaves"}


def test_scores_in_unit_interval(trained, f4):
    out = score(trained.model, f4.limit(10), "classification").collect()
    assert len(out) == 10
    assert all(0.0 <= r["prediction_proba"] <= 1.0 for r in out)
    assert all(r["prediction_class"] == int(r["prediction_proba"] > 0.5) for r in out)


def test_native_importance_every_feature(spark, trained):
    imp = explain.native_importance(spark, trained.model, FEATS).collect()
    assert {r["feature"] for r in imp} == set(FEATS)
    assert sum(r["importance"] for r in imp) > 0


def test_reload_identical(spark, trained, f4, tmp_path):
    save_model(spark, trained.model, str(tmp_path / "m"), {"problem_type": "classification"})
    copy, meta = load_model(spark, str(tmp_path / "m"))
    a = score(trained.model, f4, "classification").select("rid", "prediction_proba").orderBy("rid").toPandas()
    b = score(copy, f4, "classification").select("rid", "prediction_proba").orderBy("rid").toPandas()
    assert a.equals(b) and meta["problem_type"] == "classification"


def _margin(model, df):
    m = model.copy().setPredictionCol("_p").setProbabilityCol("_pr").setRawPredictionCol("_r")
    return {r["rid"]: r["m"] for r in m.transform(df).select("rid", vector_to_array("_r")[1].alias("m")).collect()}


@pytest.mark.parametrize("method", ["path", "shap"])
def test_additivity(spark, trained, f4, method):
    contrib = explain.attribution(f4, trained.model, keep=["rid"], method=method).collect()
    margin = _margin(trained.model, f4)
    for r in contrib:
        assert abs(r["bias"] + sum(r["contributions"]) - margin[r["rid"]]) < 1e-9


def _expvalue(forest, t, node, x, S):
    left, right = forest.left[t], forest.right[t]
    if left[node] < 0:
        return forest.value[t][node]
    f = forest.feature[t][node]
    if f in S:
        nxt = left[node] if x[f] <= forest.threshold[t][node] else right[node]
        return _expvalue(forest, t, nxt, x, S)
    c = forest.cover[t]
    return (c[left[node]] * _expvalue(forest, t, left[node], x, S)
            + c[right[node]] * _expvalue(forest, t, right[node], x, S)) / c[node]


def test_shap_matches_brute_force_shapley(spark, f4):
    model = fit_single(f4, "classification", {"num_leaves": 8, "n_estimators": 4, "min_data_in_leaf": 3,
                                              "learning_rate": 0.3}, "target")
    forest = explain.load_forest(spark, model)
    X = np.array([r["x"] for r in f4.select(vector_to_array("features").alias("x")).limit(12).collect()])
    prepared, D = explain.prepare_shap(forest)
    fast = explain.shap_np(prepared, D, 5, X)
    M = 5
    for row in range(len(X)):
        def v(S):
            return sum(w * _expvalue(forest, t, 0, X[row], S) for t, w in enumerate(forest.weights))
        for i in range(M):
            others = [j for j in range(M) if j != i]
            phi = 0.0
            for k in range(M):
                for S in itertools.combinations(others, k):
                    wgt = math.factorial(k) * math.factorial(M - k - 1) / math.factorial(M)
                    phi += wgt * (v(set(S) | {i}) - v(set(S)))
            assert abs(phi - fast[row, i]) < 1e-9


def test_param_mapping():
    sp, w = spark_params({"learning_rate": 0.05, "num_leaves": 31, "n_estimators": 150,
                          "feature_fraction": 0.7, "min_data_in_leaf": 20, "class_weight": "balanced",
                          "boosting_type": "gbdt"})
    assert sp["stepSize"] == 0.05 and sp["maxDepth"] == 5 and sp["maxIter"] == 150
    assert sp["featureSubsetStrategy"] == "0.7" and sp["minInstancesPerNode"] == 20 and w == "balanced"
    with pytest.raises(ValueError):
        spark_params({"boosting_type": "dart"})


def test_importance_sign_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, 0.0), (2.0, 4.0, 5.0, 0.0), (3.0, 6.0, 5.0, 0.0)],
                               "x double, c double, k double, z double")
    imp = {r["feature"]: r for r in explain.importance_frame(
        spark, df, ["pos", "neg", "const"], [F.col("x"), F.col("x"), F.col("k")],
        [F.col("c"), -F.col("c"), F.col("z")]).collect()}
    assert imp["pos"]["sign"] == 1.0 and imp["neg"]["sign"] == -1.0 and imp["const"]["sign"] == 1.0
    assert imp["neg"]["importance"] == -imp["pos"]["importance"]
    assert imp["const"]["rank_abs"] == 3


def test_balanced_class_weights_fit(spark, f4):
    from tabforge.operators.split import with_class_weights
    w = {r["target"]: r["w"] for r in with_class_weights(f4, "target", "w").select("target", "w").distinct().collect()}
    n1 = f4.where("target = 1").count()
    assert abs(w[1.0] - 100 / (2 * n1)) < 1e-12
    m = fit_single(f4, "classification", {"n_estimators": 3, "class_weight": "balanced", "num_leaves": 4}, "target")
    assert m.getNumTrees == 3


def test_regression_cv_best_fold(spark, f4):
    """Regression path: RMSE scores, best fold by the lowest RMSE (no refit)."""
    df = f4.withColumn("y", F.col("feature_1") * 2.0 + F.col("feature_3"))
    cfg = ModelConfig.from_dict({"target_variable": "y", "problem_type": "regression",
                                 "evaluation_metric": "rmse", "better_performance": "lt",
                                 "retrain_with_whole_dataset": False, "num_hp_searches": 1,
                                 "hyperparameter_space": {"lgbm": {
                                     "n_estimators": "int(trial.suggest_discrete_uniform('n_estimators', 10, 10, 1))",
                                     "num_leaves": "int(trial.suggest_discrete_uniform('num_leaves', 8, 8, 1))"}}})
    res = train_cv(df, cfg, "y", id_cols=["rid"])
    vals = [v for _, _, v in res.fold_scores]
    assert all(v >= 0 for v in vals)
    assert abs(res.summary["cv_mean_val_score"] - sum(vals) / 5) < 1e-12
    out = score(res.model, df, "regression").select("prediction").collect()
    assert len(out) == 100


def test_custom_splits_need_fold_column(spark, f4):
    cfg = ModelConfig.from_dict({"use_custom_splits": True, "num_hp_searches": 1})
    with pytest.raises(ValueError):
        train_cv(f4, cfg, "target")


def test_gain_importance(spark, trained):
    imp = {r["feature"]: r["importance"] for r in
           explain.native_importance(spark, trained.model, FEATS, importance_type="gain").collect()}
    assert set(imp) == set(FEATS) and abs(sum(imp.values()) - 1.0) < 1e-9


def test_path_contributions_walk_the_trees(spark, trained, f4):
    """The leaf join credits each split's change of value to its feature."""
    forest = explain.load_forest(spark, trained.model)
    got = {r["rid"]: r for r in explain.attribution(f4, trained.model, keep=["rid"], method="path").collect()}
    assert len(got) == 100
    for r in got.values():
        want = np.zeros(5)
        for t, w in enumerate(forest.weights):
            node = 0
            while forest.left[t][node] >= 0:
                f = forest.feature[t][node]
                nxt = (forest.left if r["x"][f] <= forest.threshold[t][node] else forest.right)[t][node]
                want[f] += w * (forest.value[t][nxt] - forest.value[t][node])
                node = nxt
        assert np.abs(want - r["contributions"]).max() < 1e-9 and abs(r["bias"] - forest.bias) < 1e-12


def test_patience_rule():
    assert kept_rounds([5, 4, 3, 2, 1]) == 5
    assert kept_rounds([3.0, 2.0] + [2.5] * 9 + [1.0], patience=10) == 12
    assert kept_rounds([3.0, 2.0] + [2.5] * 10 + [1.0], patience=10) == 2
    assert kept_rounds([1.0, 2.0, 3.0]) == 1 and kept_rounds([]) == 1
    assert kept_rounds([1.0, 1.0, 0.5, 0.6], patience=2) == 3


def test_early_stopped_model_is_the_long_ones_beginning(spark, f4):
    """The watched metric of a classifier is the AUC (binned), as of the first trees of one fit."""
    mat = f4.withColumn("_v", F.col("rid") % 4 == 0)
    long = fit_single(mat.where(~F.col("_v")), "classification", {"n_estimators": 30, "num_leaves": 4}, "target")
    short = fit_single(mat, "classification", {"n_estimators": 30, "num_leaves": 4}, "target", validation_col="_v")
    losses = long.evaluateEachIteration(mat.where("_v"))
    aucs = [r["rocauc"] for r in round_scores(mat.where("_v"), [long], "classification", "target").orderBy("round").collect()]
    n = short.getNumTrees
    assert n == kept_rounds(aucs, sign=1.0)
    assert abs(short.evaluateEachIteration(mat.where("_v"))[-1] - losses[n - 1]) < 1e-12


def test_nan_scores_rank_last():
    for sign in (1.0, -1.0):
        assert max([0.3, float("nan"), 0.5], key=lambda v: rank_score(sign, v)) == (0.5 if sign > 0 else 0.3)


def test_search_with_lineage_cut(spark, f4):
    cfg = ModelConfig.from_dict({"target_variable": "target", "num_hp_searches": 1,
                                 "hyperparameter_space": {"lgbm": {
                                     "n_estimators": "int(trial.suggest_discrete_uniform('n_estimators', 5, 5, 1))"}}})
    res = train_cv(f4, cfg, "target", id_cols=["rid"], lineage_cut=True)
    assert len(res.fold_scores) == 5 and res.summary["cv_mean_val_score"] > 0.5


def test_start_scoring_stream(spark, tmp_path):
    from tabforge.plans import queries_model as qm
    from tabforge.plans.queries_prepare import docs_labeled
    from tabforge.streaming import start_scoring
    sf = "/root/testdata/sf0.001"
    _, prep, _, model, _ = qm.doc_model(spark, sf)
    src = tmp_path / "in"
    docs_labeled(spark, sf).write.parquet(str(src))
    stream = spark.readStream.schema(docs_labeled(spark, sf).schema).parquet(str(src))
    q = start_scoring(stream, prep, model, "classification", str(tmp_path / "out"), str(tmp_path / "ckpt"),
                      keep=["doc_id"], trigger_once=True)
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == docs_labeled(spark, sf).count()
    assert out.columns == ["doc_id", "prediction_proba", "prediction_class"]


def _by_row(df):
    return {r["rid"]: (r["bias"], r["contributions"]) for r in df.collect()}


@pytest.mark.parametrize("nodes, chained", [(1, 4), (40, 1)])
def test_shap_of_a_forest_in_blocks(trained, f4, monkeypatch, nodes, chained):
    """A forest far above the limit of one block gives the same values."""
    whole = _by_row(explain.attribution(f4, trained.model, keep=["rid"], method="shap"))
    monkeypatch.setattr(explain, "MAX_FOREST_NODES", nodes)
    monkeypatch.setattr(explain, "CHAINED_BLOCKS", chained)
    spark = f4.sparkSession
    blocks = explain.tree_blocks(explain.forest_table(spark, trained.model), nodes)
    assert len(blocks) > 1 and blocks[0][0] == 0 and blocks[-1][1] == trained.model.getNumTrees
    assert all(a[1] == b[0] for a, b in zip(blocks, blocks[1:]))
    parts = _by_row(explain.attribution(f4, trained.model, keep=["rid"], method="shap"))
    for k, (bias, values) in whole.items():
        assert abs(parts[k][0] - bias) < 1e-9 and np.allclose(parts[k][1], values, atol=1e-9)
    with pytest.raises(ValueError, match="split it"):
        explain.load_forest(spark, trained.model)


def test_patterns_give_the_values_of_the_kernel(spark, f4, monkeypatch):
    model = fit_single(f4, "classification", {"num_leaves": 16, "n_estimators": 5, "min_data_in_leaf": 2}, "target")
    prepared, D = explain.prepare_shap(explain.load_forest(spark, model))
    X = np.random.default_rng(1).uniform(-1.2, 1.2, (300, 5))
    by_pattern = explain.shap_np(prepared, D, 5, X)
    monkeypatch.setattr(explain, "PATTERN_ELEMS", 0)
    assert np.allclose(by_pattern, explain.shap_np(prepared, D, 5, X), atol=1e-12)


def test_plan_of_path_contributions_does_not_grow_with_features(spark, f4):
    def size(n):
        wide = f4.select("rid", "target", *[F.col(FEATS[i % 5]).alias(f"w{i}") for i in range(n)])
        wide = VectorAssembler(inputCols=[f"w{i}" for i in range(n)], outputCol="features").transform(wide).select("rid", "target", "features").cache()
        wide.count()
        model = fit_single(wide, "classification", {"num_leaves": 4, "n_estimators": 3}, "target")
        out = explain.attribution(wide, model, keep=["rid"], method="path")
        assert all(len(r["contributions"]) == n for r in out.collect())
        return out._jdf.queryExecution().analyzed().toString().count("sum(")

    assert size(5) == size(60)
