"""The jobs a user runs -- train, score, prepare.

Each job is a short driver program over DataFrames: read -> validate (one
aggregate) -> fit preparation (two aggregates) -> project -> Spark ML. The
typed rows are stored once, with the run's row key, and so are the scored rows;
all statistics, folds and sinks read these. Every output is a DataFrame writer
into the run's layout ``<base>/<run_id>/{model, predictions,
deep_insights_input}``, staged and published together at the end. Predictions are attached to rows inside one projection
(original columns, generated features by place, the model's output), never by
position.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.columns import quoted
from tabforge.functions.metrics import metrics_long
from tabforge.operators import explain
from tabforge.operators.model import load_model, save_model, score, spread, train_cv
from tabforge.operators.prepare import FeaturePrep, FeaturePrepModel
from tabforge.operators.ranking import with_row_index
from tabforge.operators.split import assign_folds, sample_exact
from tabforge.operators.validate import validate
from tabforge.sources.readers import apply_types, read_source
from tabforge.session import drop_scratch, scratch_path
from tabforge.sources.sinks import (OutputLayout, importance_sink, manifest_frame, prediction_table,
                                    scored_original, scored_transformed, write_table)
from tabforge.sources.storage import Run, exists, parent
from tabforge.spec import DataConfig, FeatureSpec, ModelConfig

# generated features sit next to the original columns under these names
FEATURE = "__f"
ROW = "__row"
# rows of one task that attributes them: a row passes every leaf of the model
SHAP_ROWS = 5_000
FOLD = "__fold"


@dataclass
class JobResult:
    success: bool
    output_dir: str
    details: dict


def _layout(data_cfg: DataConfig) -> OutputLayout:
    return OutputLayout.create(data_cfg.output_base or parent(data_cfg.file_path), data_cfg.run_id)


def _label_kind(spec: FeatureSpec, target: str) -> str | None:
    f = spec.get(target)
    return "bool" if f is not None and f.type == "bool" else None


def load_inputs(spark: SparkSession, data_cfg: DataConfig, model_cfg: ModelConfig,
                spec: FeatureSpec | None = None, training: bool | None = None):
    """S1-S3 + V1-V6: typed DataFrame and the spec; raises if validation fails."""
    training = data_cfg.training if training is None else training
    spec = spec or FeatureSpec.from_json_file(data_cfg.metadata_file_path, spark)
    raw = read_source(spark, data_cfg.file_path, data_cfg.input_data_source, data_cfg.csv_multi_line)
    target = model_cfg.target_variable
    report = validate(raw, spec, target, training=training)
    for w in report.warnings:
        warnings.warn(w)
    report.raise_if_failed()
    typed = apply_types(raw, spec, target=target, label_kind=_label_kind(spec, target))
    return typed, spec, report


def _check_label(df: DataFrame, target: str, problem: str) -> None:
    """The typed label is complete; for classification it is 0/1 with both classes."""
    y = quoted(target)
    r = df.agg(F.count_if(y.isNull()).alias("null"), F.count_if(~y.isin(0.0, 1.0)).alias("bad"),
               F.count_if(y == 1.0).alias("pos"), F.count_if(y == 0.0).alias("neg")).collect()[0]
    if r["null"]:
        raise ValueError(f"target '{target}' has {r['null']} values that are not numbers")
    if problem != "classification":
        return
    if r["bad"]:
        raise ValueError(f"classification target '{target}' has {r['bad']} values outside {{0, 1}}")
    if not r["pos"] or not r["neg"]:
        raise ValueError(f"classification target '{target}' has a single class")


class _Stage:
    """Tables a job writes once to the shared folder and reads back: everything
    after reads the stored rows instead of running what came before again. They
    go when the job has written its outputs."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> "_Stage":
        return self

    def __exit__(self, *error) -> None:
        for path in self.paths:
            drop_scratch(self.spark, path)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, name))
        df.write.parquet(self.paths[-1])
        return self.spark.read.parquet(self.paths[-1])

    def rows(self, typed: DataFrame, uid: str | None) -> tuple[DataFrame, str]:
        """The typed rows and the run's row key: the id, or an index 0..n-1
        that all tables of the run share."""
        stored = self.table(typed, "typed")
        return (stored, uid) if uid else (with_row_index(stored, ROW), ROW)

    def scored(self, prep: FeaturePrepModel, model, rows: DataFrame, problem: str) -> DataFrame:
        """Rows + features by place + the assembled vector + predictions."""
        features = prep.transform(rows, keep=rows.columns, assemble=True, positional=FEATURE)
        return self.table(score(model, features, problem), "scored")


def _held_metrics(spark: SparkSession, scored: DataFrame, problem: str, target: str) -> dict:
    """Metrics of the rows whose label is known."""
    pred = "prediction_proba" if problem == "classification" else "prediction"
    label = scored.select(quoted(target).alias("y"), F.col(pred).alias("p")).filter("y is not null")
    return {r["metric"]: r["value"] for r in metrics_long(spark, label, problem, "y", "p").collect()}


def _transformed(scored: DataFrame, prep: FeaturePrepModel, problem: str, target: str | None, last: bool) -> DataFrame:
    names = prep.output_columns
    return scored_transformed(scored, [f"{FEATURE}{i}" for i in range(len(names))], problem, target, last, names)


def _attribution_outputs(spark, layout, model, prep, frame, method, key, fmt, sample, seed,
                         model_path=None):
    """X2/X3 + X4-X6 + S8/S9 on (a K3 sample of) ``frame``. The per-row
    contributions feed two sinks, so they are computed once and persisted."""
    rows = (sample_exact(frame, sample, seed=seed, id_cols=[key], ids_unique=False,
                         row_cols=[c for c in frame.columns if not c.startswith(FEATURE)])
            if sample < 1 else frame)
    shown = "index" if key == ROW else key
    rows = spread(rows.select(quoted(key).alias(shown), "features").persist(StorageLevel.MEMORY_AND_DISK), SHAP_ROWS)[0]
    name = "treeinterpreter" if method == "path" else "shap"
    contrib = explain.attribution(rows, model, keep=[shown], method=method, model_path=model_path)
    contrib = contrib.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        imp = explain.importance_from_contributions(contrib, prep.feature_names)   # small, driver-built
        write_table(importance_sink(imp), layout.insights(f"{name}_feature_importance"), fmt)
        write_table(explain.contributions_wide(contrib, prep.feature_names, [shown]),
                    layout.insights(f"{name}_contributions" if method == "path" else "shap_values"), fmt)
        return {r["feature"]: r["importance"] for r in imp.collect()}
    finally:
        contrib.unpersist()
        rows.unpersist()


def train(spark: SparkSession, model_cfg: ModelConfig, data_cfg: DataConfig,
          spec: FeatureSpec | None = None, fmt: str = "csv") -> JobResult:
    """Validate, prepare, cross-validated search, refit, score, attribute, write."""
    with _Stage(spark) as stage, Run(spark, _layout(data_cfg)) as run:
        return _train(spark, stage, run, model_cfg, data_cfg, spec, fmt)


def _train(spark, stage: _Stage, run: Run, model_cfg: ModelConfig, data_cfg: DataConfig, spec, fmt: str) -> JobResult:
    typed, spec, report = load_inputs(spark, data_cfg, model_cfg, spec, training=True)
    target, problem = model_cfg.target_variable, model_cfg.problem_type
    uid = data_cfg.uid_column_name if data_cfg.uid_column_name in typed.columns else None
    rows, key = stage.rows(typed, uid)
    _check_label(rows, target, problem)

    def preparation() -> FeaturePrep:
        return FeaturePrep(spec, target=target, passthrough=[uid] if uid else [], encoding=model_cfg.category_encoding)

    prep = preparation().fit(rows)
    # folds on the typed rows, before features make them wide: ids may repeat,
    # the whole row breaks ties
    if model_cfg.use_custom_splits:
        if "fold" not in typed.columns:
            raise ValueError("use_custom_splits is set but the data has no 'fold' column")
        folded = rows.withColumn(FOLD, F.col("fold").cast("int"))
    else:
        folded = assign_folds(rows, k=model_cfg.n_folds, seed=model_cfg.seed,
                              label=target if problem == "classification" else None,
                              id_cols=[key], ids_unique=False, row_cols=typed.columns, fold_col=FOLD,
                              exact=model_cfg.exact_folds, dealt="ranges")
    if model_cfg.fit_scope == "fold":
        folded = stage.table(folded, "folded")
    fold_frames = None
    if model_cfg.fit_scope == "fold":
        # preparation statistics from each fold's training rows only (no
        # validation rows leak into imputation / scaling / vocabularies)
        fold_frames = {f: preparation().fit(folded.where(F.col(FOLD) != f)).transform(
            folded, keep=[target, FOLD], assemble=True, positional=FEATURE) for f in range(model_cfg.n_folds)}
    frame = prep.transform(folded, keep=[target, FOLD], assemble=True, positional=FEATURE)
    result = train_cv(frame.select(quoted(target), "features", FOLD), model_cfg, target, fold_col=FOLD,
                      fold_frames=fold_frames)
    model, layout = result.model, run.layout
    stem = f"{target}_{problem}_{(model_cfg.models or ['gbt'])[0]}"
    save_model(spark, model, layout.model(stem), {"problem_type": problem, "target": target,
                                                  "feature_names": prep.feature_names,
                                                  "best_params": result.best_params})
    spark_model_path = f"{layout.model(stem)}/spark_model"      # node table for X1-X3
    prep.save(spark, layout.insights(f"{stem}_data_processor"))

    scored = stage.scored(prep, model, rows, problem)
    write_table(scored_original(scored, typed.columns, problem, target),
                layout.predictions("original_data_with_predictions"), fmt)
    write_table(_transformed(scored, prep, problem, target, False),
                layout.predictions("transformed_data_with_predictions"), fmt)

    native = explain.native_importance(spark, model, prep.feature_names, spark_model_path)
    write_table(importance_sink(native), layout.insights("native_feature_importance"), fmt)
    method = "path" if model_cfg.importance_extraction_method == "treeinterpreter" else "shap"
    importance = _attribution_outputs(spark, layout, model, prep, scored, method, key, fmt,
                                      float(model_cfg.sample_for_contribution), model_cfg.seed,
                                      spark_model_path)
    write_table(spark.createDataFrame(list(importance.items()), "feature string, importance double"),
                f"{layout.model(stem)}/importance_{method}", "parquet")
    results = dict(result.summary)
    if data_cfg.test_file_path:
        held, _, _ = load_inputs(spark, replace(data_cfg, file_path=data_cfg.test_file_path), model_cfg, spec, False)
        features = prep.transform(held, keep=[target], assemble=True, positional=FEATURE)
        results |= _held_metrics(spark, score(model, features, problem), problem, target)
    write_table(result.cv_results_frame(spark), layout.model("cv_results"), fmt)
    write_table(result.fold_scores_frame(spark), layout.model("fold_scores"), fmt)
    write_table(result.fold_importance_frame(spark, prep.feature_names), layout.model("fold_importance"), fmt)
    write_table(spark.createDataFrame([(run.final.run_id, k, float(v)) for k, v in results.items()
                                       if isinstance(v, (int, float))],
                                      "run_id string, metric string, value double"),
                layout.model("metrics"), fmt)
    root = run.publish(manifest_frame(spark, model_cfg.to_dict(), data_cfg.to_dict(), results))
    return JobResult(True, root, {"training_results": results, "importance": importance,
                                         "warnings": report.warnings})


def predict(spark: SparkSession, model_cfg: ModelConfig, data_cfg: DataConfig,
            fmt: str = "csv") -> JobResult:
    """Reload preparation + model, validate against the persisted spec,
    score, write the prediction tables (and attributions if asked)."""
    with _Stage(spark) as stage, Run(spark, _layout(data_cfg)) as run:
        return _predict(spark, stage, run, model_cfg, data_cfg, fmt)


def _stored_importance(spark: SparkSession, model_path: str, method: str) -> dict | None:
    """The importance stored with the model by its training, if any."""
    from pyspark.errors import AnalysisException
    try:
        rows = spark.read.parquet(f"{model_path.rstrip('/')}/importance_{method}").collect()   # one row a feature
    except AnalysisException:
        return None
    return {r["feature"]: r["importance"] for r in rows}


def _predict(spark, stage: _Stage, run: Run, model_cfg: ModelConfig, data_cfg: DataConfig, fmt: str) -> JobResult:
    if not data_cfg.model_file_path:
        raise ValueError("scoring needs model_file_path in the data configuration")
    if not data_cfg.data_processor_file_path:
        raise ValueError("scoring needs data_processor_file_path in the data configuration")
    prep = FeaturePrepModel.load(spark, data_cfg.data_processor_file_path)
    model, meta = load_model(spark, data_cfg.model_file_path)
    spec = prep.spec
    if data_cfg.metadata_file_path and exists(spark, data_cfg.metadata_file_path):
        current = FeatureSpec.from_json_file(data_cfg.metadata_file_path, spark)
        if current != spec:
            warnings.warn("metadata file differs from the one the processor was fitted with; "
                          "using the fitted one")
    typed, _, _ = load_inputs(spark, data_cfg, model_cfg, spec, training=False)
    target, problem = model_cfg.target_variable, model_cfg.problem_type
    uid = data_cfg.uid_column_name if data_cfg.uid_column_name in typed.columns else None
    known = target if target in typed.columns else None
    layout = run.layout
    rows, key = stage.rows(typed, uid)
    scored = stage.scored(prep, model, rows, problem)
    out_path = data_cfg.predictions_output_path or run.final.predictions("predictions")
    write_table(prediction_table(scored, problem, uid, known, None if uid else ROW), run.beside(out_path), fmt)
    write_table(scored_original(scored, typed.columns, problem, known, True),
                layout.predictions("original_data_with_predictions"), fmt)
    write_table(_transformed(scored, prep, problem, known, True),
                layout.predictions("transformed_data_with_predictions"), fmt)
    details = {"output_path": out_path, "num_predictions": scored.count()}
    if data_cfg.calculate_importance:
        method = "path" if model_cfg.importance_extraction_method == "treeinterpreter" else "shap"
        # the model's own importance, from its training, goes before that of the rows scored now
        stored = _stored_importance(spark, data_cfg.model_file_path, method)
        if stored is None or data_cfg.row_contributions:
            fresh = _attribution_outputs(spark, layout, model, prep, scored, method, key, fmt,
                                         float(model_cfg.sample_for_contribution), model_cfg.seed,
                                         f"{data_cfg.model_file_path.rstrip('/')}/spark_model")
        else:
            fresh = stored
            name = "treeinterpreter" if method == "path" else "shap"
            write_table(importance_sink(spark.createDataFrame(list(stored.items()), "feature string, importance double")),
                        layout.insights(f"{name}_feature_importance"), fmt)
        details["importance"] = stored or fresh
    if known:
        details["metrics"] = _held_metrics(spark, scored, problem, target)
    root = run.publish(manifest_frame(spark, model_cfg.to_dict(), data_cfg.to_dict(), details.get("metrics", {})), "prediction_config")
    return JobResult(True, root, details)


def prepare(spark: SparkSession, model_cfg: ModelConfig, data_cfg: DataConfig,
            spec: FeatureSpec | None = None) -> tuple[FeaturePrepModel, DataFrame]:
    """Load, validate, fit the preparation and transform."""
    typed, spec, _ = load_inputs(spark, data_cfg, model_cfg, spec)
    uid = data_cfg.uid_column_name if data_cfg.uid_column_name in typed.columns else None
    prep = FeaturePrep(spec, target=model_cfg.target_variable, passthrough=[uid] if uid else [],
                       encoding=model_cfg.category_encoding).fit(typed)
    return prep, prep.transform(typed)
