"""Ensembles by rounds, early stopping from one fit, and the learning search."""

import math
import statistics

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.functions.metrics import auc_frame, classification_metrics, regression_metrics
from tabforge.operators import ensemble, model
from tabforge.operators.ensemble import first_trees, kept_rounds, leaves_of, round_scores, stopped_early
from tabforge.operators.search import Study, at, random_trials
from tabforge.spec import ModelConfig, parse_space


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    x = r.uniform(-1, 1, (400, 4))
    y = (x[:, 0] * x[:, 1] + 0.3 * r.normal(size=400) > 0).astype(float)
    df = spark.createDataFrame([(i, *map(float, x[i]), float(y[i]), float(3 * x[i, 0] + x[i, 2])) for i in range(400)],
                               "rid long, a double, b double, c double, d double, target double, price double")
    return VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df).cache()


@pytest.fixture(scope="module")
def models(rows):
    return [model.fit_single(rows, "classification", {"n_estimators": n, "num_leaves": k}, "target")
            for n, k in ((12, 4), (7, 16))]


def raw(m, df):
    out = m.copy().setPredictionCol("_p").setProbabilityCol("_pr").setRawPredictionCol("_r").transform(df)
    return {r["rid"]: r["m"] for r in out.select("rid", vector_to_array("_r")[1].alias("m")).collect()}


def test_first_trees_are_the_beginning(rows, models):
    m = models[0]
    lv = leaves_of(m)
    leaf = m.copy().setLeafCol("leaf").transform(rows).select("rid", vector_to_array("leaf").alias("l")).collect()
    margins = dict(zip([r["rid"] for r in leaf], lv.margins(np.array([r["l"] for r in leaf]))))
    for k in (1, 5, 12):
        part = first_trees(m, k)
        assert part.getNumTrees == k and part.numFeatures == 4 and part.getMaxDepth() == m.getMaxDepth()
        got = raw(part, rows)
        assert all(abs(got[i] - margins[i][k - 1]) < 1e-12 for i in margins)
    assert first_trees(m, 12) is m and len(first_trees(m, 5).featureImportances) == 4
    for k in (0, 13):
        with pytest.raises(ValueError, match="cannot keep"):
            first_trees(m, k)


def test_sliced_models_are_saved_and_reloaded(spark, rows, models, tmp_path):
    part = first_trees(models[0], 3)
    model.save_model(spark, part, str(tmp_path / "m"), {"problem_type": "classification"})
    assert raw(model.load_model(spark, str(tmp_path / "m"))[0], rows) == raw(part, rows)


def test_regressor_slices(rows):
    m = model.fit_single(rows, "regression", {"n_estimators": 6, "num_leaves": 8}, "price")
    part = first_trees(m, 2)
    assert part.getNumTrees == 2 and part.numFeatures == 4
    scores = {r["round"]: r for r in round_scores(rows, [m], "regression", "price").collect()}
    for k in (2, 6):
        want = regression_metrics(model.score(first_trees(m, k), rows, "regression"), "price", "prediction").first()
        assert all(abs(scores[k - 1][c] - want[c]) < 1e-9 for c in ("rmse", "mse", "r2"))


def test_all_models_and_parts_in_one_scan(rows, models):
    part = F.col("rid") % 3
    got = {(r["model"], r["part"], r["round"]): r for r in round_scores(rows, models, "classification", "target", part=part).collect()}
    assert len(got) == 3 * (12 + 7)
    for k, m in enumerate(models):
        for n in (1, m.getNumTrees):
            scored = model.score(first_trees(m, n), rows, "classification").withColumn("part", part)
            exact = {r["part"]: r["auc"] for r in auc_frame(scored, "target", "prediction_proba", by=["part"]).collect()}
            others = {r["part"]: r for r in classification_metrics(scored, "target", "prediction_proba", by=["part"]).collect()}
            for p in range(3):
                r = got[k, p, n - 1]
                assert abs(r["rocauc"] - exact[p]) <= r["bound"] + 1e-12
                assert abs(r["accuracy"] - others[p]["accuracy"]) < 1e-12 and abs(r["f1"] - others[p]["f1"]) < 1e-12


def jobs_of(spark, what, group):
    spark.sparkContext.setJobGroup(group, group)
    what()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_the_models(spark, rows, models):
    one, many = [jobs_of(spark, lambda: stopped_early(rows, ms, "classification", "target", "rocauc"), g)
                 for ms, g in ((models[:1], "one-model"), (models * 3, "six-models"))]
    assert one == many


def test_one_class_or_no_rows_keeps_all_trees(rows, models):
    for part in (rows.where("target = 1"), rows.where("rid < 0")):
        (keep, score), _ = stopped_early(part, models, "classification", "target", "rocauc")
        assert keep == 12 and math.isnan(score)


def test_kept_rounds_by_direction():
    assert kept_rounds([0.5, 0.7, 0.7, 0.6, 0.8], 2, 1.0) == 2 and kept_rounds([0.5, 0.7, 0.6, 0.8], 2, 1.0) == 4
    assert kept_rounds([3.0, 2.0, 2.5, 2.4], 10) == 2 and kept_rounds([math.nan, 0.4, math.nan], 10, 1.0) == 2


SPACE = {"learning_rate": "trial.suggest_float('learning_rate', 0.05, 0.4, log=True)",
         "num_leaves": "trial.suggest_int('num_leaves', 4, 16, step=4)",
         "n_estimators": "trial.suggest_int('n_estimators', 4, 9)"}


@pytest.mark.parametrize("study", ["shared", "per_fold"])
def test_a_trial_is_fitted_once(rows, monkeypatch, study):
    made = []
    real = model.make_estimator
    monkeypatch.setattr(model, "make_estimator", lambda *a: made.append(a[1]) or real(*a))
    cfg = ModelConfig.from_dict({"target_variable": "target", "num_hp_searches": 3, "n_folds": 2, "study": study,
                                 "search_batch": 2, "hyperparameter_space": {"lgbm": SPACE}})
    res = model.train_cv(rows, cfg, "target", id_cols=["rid"])
    assert len(made) == 3 * 2 + 1 and len(res.trials) == 6
    assert all(1 <= t.n_trees <= t.params["n_estimators"] and 0.5 < t.val_score <= 1 for t in res.trials)
    by_fold = [[t.params for t in res.trials if t.fold == f] for f in range(2)]
    assert (by_fold[0] == by_fold[1]) == (study == "shared")
    best = {f: max(t.val_score for t in res.trials if t.fold == f) for f in range(2)}
    # the exact validation AUC of the best trial of each fold is near its binned one
    assert all(abs(best[f] - val) < 0.01 for f, _, val in res.fold_scores)
    if study == "shared":
        means = {n: statistics.fmean(t.val_score for t in res.trials if t.trial == n) for n in range(3)}
        assert res.best_params == next(t.params for t in res.trials if t.trial == max(means, key=means.get))


def test_search_results_do_not_depend_on_parallelism(rows):
    def run(parallelism):
        cfg = ModelConfig.from_dict({"target_variable": "price", "problem_type": "regression", "evaluation_metric": "rmse",
                                     "better_performance": "lt", "num_hp_searches": 3, "n_folds": 2, "search_batch": 2,
                                     "parallelism": parallelism, "hyperparameter_space": {"lgbm": SPACE}})
        res = model.train_cv(rows, cfg, "price", id_cols=["rid"])
        return [(t.fold, t.trial, t.params, t.n_trees) for t in res.trials], res.best_params

    assert run(1) == run(4)


SURFACE = parse_space({
    "lr": "trial.suggest_float('lr', 0.001, 1.0, log=True)", "leaves": "trial.suggest_int('leaves', 8, 128, step=4)",
    "part": "trial.suggest_uniform('part', 0.2, 1.0)", "mode": "trial.suggest_categorical('mode', ['a', 'b', 'c'])"})


def surface(p):
    return ((math.log10(p["lr"]) + 1.5) ** 2 + ((p["leaves"] - 40) / 40) ** 2 + 3 * (p["part"] - 0.7) ** 2
            + 0.5 * (p["mode"] != "b"))


def searched(study, n, batch=4):
    while len(study.places) < n:
        for number, p in study.ask(min(batch, n - len(study.places))):
            study.tell(number, surface(p))
    return study


def test_learning_search_beats_random_trials():
    learnt = [surface(s.params(s.best())) for s in (searched(Study(SURFACE, k, -1.0), 50) for k in range(12))]
    drawn = [surface(s.params(s.best())) for s in (searched(_negative(random_trials(SURFACE, 50, k)), 50) for k in range(12))]
    assert statistics.fmean(learnt) < statistics.fmean(drawn) and sum(a <= b for a, b in zip(learnt, drawn)) >= 8


def _negative(study):
    study.sign = -1.0
    return study


def test_search_is_repeatable_and_stays_in_its_space():
    a, b = searched(Study(SURFACE, 7, -1.0), 40), searched(Study(SURFACE, 7, -1.0), 40)
    assert a.places == b.places and a.places != searched(Study(SURFACE, 8, -1.0), 40).places
    for number in range(40):
        p = a.params(number)
        assert 0.001 <= p["lr"] <= 1 and p["leaves"] in range(8, 129, 4) and 0.2 <= p["part"] <= 1 and p["mode"] in "abc"


def test_nan_scores_are_worst():
    study = Study(SURFACE, 1)
    for number, _ in study.ask(3):
        study.tell(number, [0.2, math.nan, 0.4][number])
    assert study.best() == 2


def test_places_cover_all_values():
    space = parse_space({"a": "trial.suggest_int('a', 10, 30, step=10)", "b": "int(trial.suggest_uniform('b', 1, 3))",
                         "c": "trial.suggest_discrete_uniform('c', 0, 1, q=0.25)", "d": "trial.suggest_int('d', 1, 8, log=True)",
                         "e": "trial.suggest_categorical('e', ['x', None])"})
    a, b, c, d, e = space
    us = [k / 1000 for k in range(1000)]
    assert {at(a, u) for u in us} == {10, 20, 30} and {at(b, u) for u in us} == {1, 2}
    assert {at(c, u) for u in us} == {0, 0.25, 0.5, 0.75, 1.0} and {at(d, u) for u in us} == set(range(1, 9))
    assert [at(e, 0.0), at(e, 1.0)] == ["x", None]
