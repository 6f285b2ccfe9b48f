"""Gradient-boosted trees on Spark ML, cross-validated search,
refit, scoring and persistence.

Training uses ``pyspark.ml`` ``GBTClassifier`` / ``GBTRegressor`` (distributed
histogram split finding). The assembled, projected training frame is
persisted once and every fold / trial reads it; folds are a column
(``assign_folds``), so a trial's training and validation rows are filters of
the one cached frame.

A trial is fitted once. The validation rows of a fold are scanned once for all
its trials of a batch, which gives every trial's score after every round
(``ensemble.round_scores``); early stopping (AUC or RMSE, ``PATIENCE`` rounds
without a gain) keeps the first trees of the fitted model. A single fit of a large
regression goes by blocks of binned rows (``boosting``) instead of Spark ML's objects.

Model selection: a search (``sampler``: Parzen estimators or random) proposes
batches of trials. One ``shared`` study is told a trial's mean score over the
folds, and the best trial is refit on all rows (``param_selection="first_fold"``
takes the best trial of fold 0); with ``study="per_fold"`` each fold has a study
of its own. Fits run concurrently from a driver thread pool (``parallelism``) --
each fit is itself a distributed Spark job.
"""

from __future__ import annotations

import json
import math
import statistics
import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.columns import positive_probability, threshold_class
from tabforge.functions.metrics import auc_frame, metric_value, regression_metrics
from tabforge.operators import boosting
from tabforge.operators.ensemble import PATIENCE, first_trees, kept_rounds, stopped_early
from tabforge.operators.search import Study, random_trials
from tabforge.operators.split import assign_folds, with_class_weights
from tabforge.session import cut_lineage, work_dir
from tabforge.spec import ModelConfig, parse_space

DEFAULT_MAX_BINS = 255
# trees when the search space names no number (the common default of boosting libraries)
DEFAULT_TREES = 100
MAX_DEPTH_LIMIT = 30
# rows of one task of a fit: the many small jobs of a fit on little data take few tasks
ROWS_PER_TASK = 50_000
# and at most, however large the data: what a task reads and holds does not grow with the input
MAX_ROWS_PER_TASK = 250_000
# trees as deep keep each row's node between levels; others are walked again, which is cheaper than a stored table
DEEP = 10


# ---------------------------------------------------------------------------
# parameter mapping (LightGBM-style names -> Spark GBT params)
# ---------------------------------------------------------------------------

def spark_params(params: dict) -> tuple[dict, str | None]:
    """Map a trial's parameters onto Spark GBT params; returns (params,
    class_weight mode)."""
    out: dict = {"maxBins": DEFAULT_MAX_BINS, "maxIter": DEFAULT_TREES}
    weight = None
    for k, v in params.items():
        if k == "learning_rate":
            out["stepSize"] = float(v)
        elif k == "num_leaves":
            out["maxDepth"] = int(min(MAX_DEPTH_LIMIT, max(1, math.ceil(math.log2(max(2, int(v)))))))
        elif k == "max_depth":
            out["maxDepth"] = int(min(MAX_DEPTH_LIMIT, max(1, int(v))))
        elif k in ("n_estimators", "num_iterations", "num_boost_round"):
            out["maxIter"] = int(v)
        elif k in ("feature_fraction", "colsample_bytree"):
            f = float(v)
            out["featureSubsetStrategy"] = "all" if f >= 1.0 else repr(f)
        elif k in ("min_data_in_leaf", "min_child_samples"):
            out["minInstancesPerNode"] = max(1, int(v))
        elif k in ("bagging_fraction", "subsample"):
            out["subsamplingRate"] = float(v)
        elif k in ("max_bin",):
            out["maxBins"] = int(v)
        elif k == "class_weight":
            weight = v
        elif k == "boosting_type":
            if v not in ("gbdt",):
                raise ValueError(f"unsupported boosting_type: {v}")
        elif k in ("reg_lambda", "lambda_l2", "reg_alpha", "lambda_l1"):
            if v:
                warnings.warn(f"'{k}' has no Spark GBT equivalent and is ignored")
        elif k in ("objective", "metric", "verbose", "seed"):
            pass
        else:
            warnings.warn(f"unknown hyper-parameter '{k}' ignored")
    return out, weight


def make_estimator(problem_type: str, params: dict, label_col: str, features_col: str,
                   weight_col: str | None, seed: int):
    est_cls = GBTClassifier if problem_type == "classification" else GBTRegressor
    kw = dict(labelCol=label_col, featuresCol=features_col, seed=seed,
              predictionCol="_pred", cacheNodeIds=params.get("maxDepth", 5) > DEEP, checkpointInterval=10)
    if weight_col:
        kw["weightCol"] = weight_col
    kw.update(params)
    return est_cls(**kw)


def fit_tasks(rows: int, cores: int, per_task: int = ROWS_PER_TASK) -> int:
    """Tasks of a stage: ``per_task`` rows each until every core has two, more
    rows then, and never over ``MAX_ROWS_PER_TASK``."""
    return max(1, -(-rows // MAX_ROWS_PER_TASK), min(-(-rows // per_task), 2 * cores))


def spread(data: DataFrame, per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, int]:
    """A persisted frame for many passes or much work a row, and its number of tasks.
    The source's parts follow its files, not its rows: where one holds over twice
    a task's share, the rows are dealt out evenly."""
    # one number a part of the source; the job also fills the cache
    held = [r["n"] for r in data.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    tasks = fit_tasks(sum(held), data.sparkSession.sparkContext.defaultParallelism, per_task)
    if max(held, default=0) <= 2 * -(-sum(held) // tasks):
        return data, tasks
    even = data.repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    even.count()
    data.unpersist()
    return even, tasks


def fit_early_stopped(train: DataFrame, valid: DataFrame, problem_type: str, params: dict, label_col: str,
                      features_col: str, weight_col: str | None, seed: int, patience: int = PATIENCE):
    """M3: fit on ``train`` once and keep the first trees that early stopping on
    ``valid`` allows (AUC or RMSE after every round, from one scan)."""
    model = make_estimator(problem_type, params, label_col, features_col, weight_col, seed).fit(train)
    metric = "rocauc" if problem_type == "classification" else "rmse"
    keep, _ = stopped_early(valid, [model], problem_type, label_col, metric, features_col, patience)[0]
    return first_trees(model, keep)


# ---------------------------------------------------------------------------
# scoring (M7)
# ---------------------------------------------------------------------------

def score(model, df: DataFrame, problem_type: str, threshold: float = 0.5,
          prob_col: str = "prediction_proba") -> DataFrame:
    """Append ``prediction_proba`` + ``prediction_class`` (classification) or
    ``prediction`` (regression). A narrow, shuffle-free projection."""
    m = model.copy()
    m.setPredictionCol("_pred")
    if problem_type == "classification":
        m.setProbabilityCol("_prob").setRawPredictionCol("_raw")
        out = m.transform(df)
        out = out.withColumn(prob_col, positive_probability("_prob"))
        out = out.withColumn("prediction_class", threshold_class(prob_col, threshold))
        return out.drop("_pred", "_prob", "_raw")
    out = m.transform(df)
    return out.withColumn("prediction", F.col("_pred")).drop("_pred")


def evaluate(scored: DataFrame, problem_type: str, metric: str, label_col: str,
             threshold: float = 0.5) -> float:
    """One metric by name on a scored frame."""
    pred = "prediction_proba" if problem_type == "classification" else "prediction"
    return metric_value(scored, metric, label_col, pred, threshold)


# ---------------------------------------------------------------------------
# cross-validated search (M4, M5, M6, M9)
# ---------------------------------------------------------------------------

@dataclass
class TrialResult:
    fold: int
    trial: int
    params: dict
    val_score: float
    n_trees: int
    model: object = field(default=None, repr=False)


@dataclass
class TrainResult:
    model: object
    problem_type: str
    feature_names: list[str]
    label_col: str
    best_params: dict
    trials: list[TrialResult]
    fold_scores: list[tuple[int, float, float]]   # (fold, train_score, val_score)
    summary: dict
    fold_importance: list[tuple[int, int, float]] = field(default_factory=list)   # (fold, slot, gain)

    def cv_results_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(t.fold, t.trial, json.dumps(t.params, default=str), float(t.val_score), int(t.n_trees))
             for t in self.trials],
            "fold int, trial int, params string, val_score double, n_trees int")

    def fold_importance_frame(self, spark: SparkSession, names: list[str]) -> DataFrame:
        """Gain importance of every feature in each fold's best model."""
        return spark.createDataFrame([(f, names[i], g) for f, i, g in self.fold_importance],
                                     "fold int, feature string, importance double")

    def fold_scores_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(f, float(a), float(b)) for f, a, b in self.fold_scores],
                                     "fold int, train_score double, val_score double")


def _scores_by_part(scored: DataFrame, problem: str, label_col: str) -> dict:
    """AUC (classification) or RMSE (regression) per value of ``_part``."""
    if problem == "classification":
        rows = auc_frame(scored, label_col, "prediction_proba", by=["_part"]).collect()
        return {r["_part"]: (float("nan") if r["auc"] is None else float(r["auc"])) for r in rows}
    rows = regression_metrics(scored, label_col, "prediction", by=["_part"]).collect()
    return {r["_part"]: float(r["rmse"]) for r in rows}


def cv_summary_frame(scores: DataFrame) -> DataFrame:
    """M9: mean train score, mean and population std of the validation score."""
    return scores.agg(F.avg("train_score").alias("cv_mean_train_score"),
                      F.avg("val_score").alias("cv_mean_val_score"),
                      F.stddev_pop("val_score").alias("cv_std_val_score"))


def rank_score(sign: float, value: float) -> tuple[bool, float]:
    """Order of scores where larger is better; a score that is not a number is worst."""
    return (False, 0.0) if math.isnan(value) else (True, sign * value)


def _space(cfg: ModelConfig) -> list:
    spaces = cfg.hyperparameter_space or {}
    key = cfg.models[0] if cfg.models and cfg.models[0] in spaces else (next(iter(spaces), None))
    return parse_space(spaces.get(key, {})) if key else []


def _study(cfg: ModelConfig, space: list, n_trials: int, seed: int, sign: float) -> Study:
    study = random_trials(space, n_trials, seed) if cfg.sampler == "random" else Study(space, seed)
    study.sign = sign
    return study


def train_cv(df: DataFrame, cfg: ModelConfig, label_col: str, features_col: str = "features",
             id_cols: list[str] | None = None, fold_col: str = "fold",
             lineage_cut: bool = False,
             fold_frames: dict[int, DataFrame] | None = None) -> TrainResult:
    """M4-M6, M9 on an assembled frame (``features_col`` vector + label).

    The training frame feeds every fit of the search and is persisted.
    ``lineage_cut=True`` checkpoints it into the shared checkpoint directory
    first, so a lost executor costs a re-read, not a re-run of the preparation
    and fold ranking."""
    spark = df.sparkSession
    work_dir(spark)   # checkpointInterval needs the shared directory
    problem = cfg.problem_type
    k, seed = cfg.n_folds, cfg.seed
    sign = cfg.metric_sign

    space, n_trials = _space(cfg), max(1, int(cfg.num_hp_searches))
    balanced = any(p.name == "class_weight" for p in space)
    base = df
    if fold_col not in base.columns:
        if cfg.use_custom_splits:
            raise ValueError(f"use_custom_splits is set but the data has no '{fold_col}' column")
        base = assign_folds(base, k=k, seed=seed,
                            label=label_col if problem == "classification" else None,
                            id_cols=id_cols, fold_col=fold_col, dealt="ranges")
    if problem == "classification" and balanced:
        base = with_class_weights(base, label_col, "_w_balanced", "balanced")
    cols = [label_col, features_col, fold_col] + (["_w_balanced"] if "_w_balanced" in base.columns else [])
    data = base.select(*cols)
    if lineage_cut:
        data = cut_lineage(data)              # reliable checkpoint, shared storage
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    # fold-scoped preparation: fold f's trials and scores read its own frame
    # (features prepared from the other folds' rows); the refit reads ``data``
    per_fold = {}
    for f, frame in (fold_frames or {}).items():
        per_fold[f] = frame.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)

    def rows_of(fold: int) -> DataFrame:
        return per_fold.get(fold, data)
    try:
        # materialise once: concurrent trials must not each recompute the
        # lineage (preparation, fold ranking) while the cache is still empty
        data, tasks = spread(data)
        for f, frame in per_fold.items():
            per_fold[f] = spread(frame)[0]

        def fit(job) -> object:
            fold, _, params = job
            sp, wmode = spark_params(params)
            train = rows_of(fold).where(F.col(fold_col) != fold).coalesce(tasks)
            est = make_estimator(problem, sp, label_col, features_col, "_w_balanced" if wmode == "balanced" else None, seed)
            return est.fit(train)

        def judge(batch: list) -> list[TrialResult]:
            """Trials of one fold: one scan of its validation rows for all."""
            fold = batch[0][0][0]
            valid = rows_of(fold).where(F.col(fold_col) == fold).coalesce(tasks)
            kept = stopped_early(valid, [m for _, m in batch], problem, label_col, cfg.evaluation_metric, features_col)
            return [TrialResult(fold, number, params, value, keep, first_trees(model, keep))
                    for ((_, number, params), model), (keep, value) in zip(batch, kept)]

        results: list[TrialResult] = []
        studies = ({f: _study(cfg, space, n_trials, seed + 1000 * f, sign) for f in range(k)} if cfg.study == "per_fold"
                   else {None: _study(cfg, space, n_trials, seed, sign)})
        size = n_trials if cfg.sampler == "random" else max(1, int(cfg.search_batch))
        with ThreadPoolExecutor(max_workers=max(1, cfg.parallelism)) as pool:
            for first in range(0, n_trials, size):
                asked = {s: study.ask(min(size, n_trials - first)) for s, study in studies.items()}
                todo = [(f, number, params) for f in range(k) for number, params in asked[f if f in asked else None]]
                fitted = list(zip(todo, pool.map(fit, todo)))
                found = [r for rs in pool.map(judge, [[x for x in fitted if x[0][0] == f] for f in range(k)]) for r in rs]
                results += found
                for s, study in studies.items():
                    for number, _ in asked[s]:
                        study.tell(number, statistics.fmean(
                            r.val_score for r in found if r.trial == number and s in (None, r.fold)))

        # per fold: best trial -> fold scores (train / validation, metric of the problem type)
        fold_metric = "rocauc" if problem == "classification" else "rmse"
        fold_importance = []
        best_by_fold = {}
        for f in range(k):
            rs = [r for r in results if r.fold == f]
            best = max(rs, key=lambda r: rank_score(sign, r.val_score))
            best_by_fold[f] = best
            fold_importance += [(f, i, float(g)) for i, g in enumerate(best.model.featureImportances.toArray())]

        def fold_score(f: int) -> tuple[int, float, float]:
            """Train and validation score of the fold's best model in one grouped job."""
            scored = score(best_by_fold[f].model, rows_of(f), problem).withColumn("_part", F.col(fold_col) == f)
            both = _scores_by_part(scored, problem, label_col)
            return f, both.get(False, float("nan")), both.get(True, float("nan"))

        with ThreadPoolExecutor(max_workers=max(1, cfg.parallelism)) as pool:
            fold_scores = list(pool.map(fold_score, range(k)))

        if cfg.param_selection == "first_fold":
            chosen = best_by_fold[0]
        elif cfg.study == "per_fold":
            chosen = max(best_by_fold.values(), key=lambda r: rank_score(sign, r.val_score))
        else:
            number = studies[None].best()
            chosen = next(r for r in results if r.trial == number)
        best_params = dict(chosen.params)
        if cfg.retrain_with_whole_dataset:
            sp, wmode = spark_params(best_params)
            n_trees = [r.n_trees for r in results if r.trial == chosen.trial and (cfg.study == "shared" or r.fold == chosen.fold)]
            sp["maxIter"] = max(1, int(statistics.median(n_trees)))
            est = make_estimator(problem, sp, label_col, features_col,
                                 "_w_balanced" if wmode == "balanced" else None, seed)
            final = est.fit(data.coalesce(tasks))
        else:
            better = 1.0 if fold_metric == "rocauc" else -1.0
            pick = max(fold_scores, key=lambda x: rank_score(better, x[2]))
            final = best_by_fold[pick[0]].model
    finally:
        data.unpersist()
        for frame in per_fold.values():
            frame.unpersist()

    for r in results:
        r.model = None   # fold models are not kept
    result = TrainResult(final, problem, [], label_col, best_params, results, fold_scores, {}, fold_importance)
    result.summary = {**cv_summary_frame(result.fold_scores_frame(spark)).first().asDict(), "best_params": best_params}
    return result


def _fit_by_blocks(df: DataFrame, params: dict, label_col: str, features_col: str, seed: int, validation_col: str | None):
    """A large regression's model (with early stopping if there are validation
    rows), None where Spark ML fits it."""
    est = make_estimator("regression", params, label_col, features_col, None, seed)
    if not boosting.applies(est, df.schema, features_col):
        return None
    rows = df.count()
    if rows <= boosting.LEAST_ROWS:
        return None
    held = F.coalesce(F.col(validation_col), F.lit(False)) if validation_col else F.lit(False)
    found = boosting.fit_blocks(df, rows, est, label_col, features_col, held)
    if found is None:
        return None
    model, errors = found
    keep = kept_rounds(errors) if any(e == e for e in errors) else model.getNumTrees
    return first_trees(model, keep)


def fit_single(df: DataFrame, problem_type: str, params: dict, label_col: str,
               features_col: str = "features", seed: int = 42,
               validation_col: str | None = None):
    """M1 / M2 (+M3 when ``validation_col`` marks early-stopping rows)."""
    work_dir(df.sparkSession)
    sp, wmode = spark_params(params)
    src = df
    wcol = None
    if problem_type == "classification" and wmode == "balanced":
        src = with_class_weights(df, label_col, "_w_balanced", "balanced")
        wcol = "_w_balanced"
    if problem_type == "regression":
        model = _fit_by_blocks(df, sp, label_col, features_col, seed, validation_col)
        if model is not None:
            return model
    # the fit makes several passes (split finding, tree levels, errors): read
    # the projected input once
    cols = [label_col, features_col] + [c for c in (wcol, validation_col) if c]
    kept = src.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        kept, tasks = spread(kept)
        data = kept.coalesce(tasks)
        if validation_col:
            held = F.coalesce(F.col(validation_col), F.lit(False))
            return fit_early_stopped(data.where(~held), data.where(held), problem_type, sp, label_col, features_col,
                                     wcol, seed)
        return make_estimator(problem_type, sp, label_col, features_col, wcol, seed).fit(data)
    finally:
        kept.unpersist()


# ---------------------------------------------------------------------------
# persistence
# ---------------------------------------------------------------------------

def save_model(spark: SparkSession, model, path: str, meta: dict) -> str:
    model.write().overwrite().save(f"{path}/spark_model")
    spark.createDataFrame([(json.dumps(meta, default=str),)], "meta string") \
        .write.mode("overwrite").json(f"{path}/meta")
    return path


def load_model(spark: SparkSession, path: str):
    meta = json.loads(spark.read.json(f"{path}/meta").collect()[0]["meta"])
    cls = GBTClassificationModel if meta.get("problem_type") == "classification" else GBTRegressionModel
    return cls.load(f"{path}/spark_model"), meta
