"""Catalogue entries for training, search, scoring, persistence (M1-M9,
S12) and attribution (X1-X7, S8, S9).

Model outputs cannot be reproduced by SQL, so most entries here have no
oracle (rows-only check); their invariants (additivity, reload identity,
probability range, AUC floor) are asserted in ``tests/``. The importance
aggregation X4-X6 is also run over a linear attribution that SQL can
reproduce, with an oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.operators import explain
from tabforge.operators.model import (fit_single, load_model, save_model, score, train_cv)
from tabforge.operators.prepare import FeaturePrep
from tabforge.plans.catalogue import query, r6, rounded, table
from tabforge.plans.queries_prepare import fit_docs
from tabforge.session import scratch_path
from tabforge.spec import FeatureSpec, ModelConfig, parse_space

# Fixed training parameters of the catalogue's single fits.
CLASSIFIER_PARAMS = {"learning_rate": 0.1, "num_leaves": 8, "n_estimators": 20, "min_data_in_leaf": 5}
REGRESSOR_PARAMS = {"learning_rate": 0.1, "num_leaves": 16, "n_estimators": 15, "min_data_in_leaf": 20}

# Search of the catalogue's training job: 2 trials per fold.
SEARCH_CONFIG = {
    "target_variable": "quality", "problem_type": "classification", "evaluation_metric": "rocauc",
    "better_performance": "gt", "models": ["lgbm"], "retrain_with_whole_dataset": True,
    "importance_extraction_method": "shap", "sample_for_contribution": 1.0, "num_hp_searches": 2, "parallelism": 8,
    "hyperparameter_space": {"lgbm": {
        "boosting_type": "trial.suggest_categorical('boosting_type', ['gbdt'])",
        "learning_rate": "trial.suggest_float('learning_rate', 0.08, 0.3, log=True)",
        "num_leaves": "trial.suggest_int('num_leaves', 24, 48, step=8)",
        "feature_fraction": "trial.suggest_uniform('feature_fraction', low=0.6, high=1.0)",
        "n_estimators": "int(trial.suggest_discrete_uniform('n_estimators', 40, 80, 40))"}},
}

_CACHE: dict = {}


def _key(spark: SparkSession, sf_dir: str, what: str):
    return (spark.sparkContext.applicationId, sf_dir, what)


def doc_model(spark: SparkSession, sf_dir: str):
    """Prepared documents (assembled) + a fitted classifier + its forest."""
    k = _key(spark, sf_dir, "docs")
    if k not in _CACHE:
        raw, prep = fit_docs(spark, sf_dir)
        mat = prep.transform(raw, assemble=True)
        model = fit_single(mat, "classification", CLASSIFIER_PARAMS, "quality")
        path = scratch_path(spark, "doc-model")
        model.write().overwrite().save(path)
        _CACHE[k] = (raw, prep, mat, model, path)
    return _CACHE[k]


def doc_search(spark: SparkSession, sf_dir: str):
    k = _key(spark, sf_dir, "search")
    if k not in _CACHE:
        _, _, mat, _, _ = doc_model(spark, sf_dir)
        _CACHE[k] = train_cv(mat, ModelConfig.from_dict(SEARCH_CONFIG), "quality", id_cols=["doc_id"])
    return _CACHE[k]


def _tree_summary(spark: SparkSession, model, path: str) -> DataFrame:
    nodes = explain.forest_table(spark, model, path)
    weights = spark.createDataFrame(list(enumerate(float(w) for w in model.treeWeights)),
                                    "tree int, weight double")
    per_tree = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("nodes"),
                                         F.count_if(F.col("left") < 0).alias("leaves"))
    return per_tree.join(weights, "tree")


@query("train_classifier")
def train_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 (+M6 fit): GBT classifier on the prepared documents; one row per tree."""
    _, _, _, model, path = doc_model(spark, sf_dir)
    return _tree_summary(spark, model, path)


LINEITEM_REG_SPEC = FeatureSpec.from_columns({
    "l_quantity": ["float", 1, "mean", None, "f"],
    "l_discount": ["float", 1, "mean", None, "f"],
    "l_tax": ["float", 1, "mean", None, "f"],
    "l_returnflag": ["category", 1, "unknown", "one-hot", "f"],
    "l_linestatus": ["category", 1, "unknown", "one-hot", "f"],
})


#: a label that the features decide
CHARGE = ("l_quantity * (1 - l_discount) * (1 + l_tax) + CASE WHEN l_returnflag = 'R' THEN 5 ELSE 0 END")


def lineitem_regression(spark: SparkSession, sf_dir: str):
    k = _key(spark, sf_dir, "reg")
    if k not in _CACHE:
        li = table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus", "l_extendedprice", F.expr(CHARGE).alias("charge"))
        prep = FeaturePrep(LINEITEM_REG_SPEC, target="charge",
                           passthrough=["l_orderkey", "l_linenumber", "l_extendedprice"]).fit(li)
        mat = prep.transform(li, assemble=True)
        # early stopping (M3): an md5-chosen fifth of the rows is the validation
        # set; a hold-out needs no exact balance, so the shuffle-free hash folds
        from tabforge.operators.split import assign_folds
        mat = assign_folds(mat, k=5, seed=42, id_cols=["l_orderkey", "l_linenumber"], exact=False)
        mat = mat.withColumn("_is_val", F.col("fold") == 0)
        model = fit_single(mat, "regression", REGRESSOR_PARAMS, "charge", validation_col="_is_val")
        path = scratch_path(spark, "reg-model")
        model.write().overwrite().save(path)
        _CACHE[k] = (prep, mat, model, path)
    return _CACHE[k]


@query("train_regressor")
def train_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M3: GBT regressor of a line's charge with early stopping; one row per tree."""
    _, _, model, path = lineitem_regression(spark, sf_dir)
    return _tree_summary(spark, model, path)


@query("early_stopping_contract", """
SELECT count(*) FILTER (WHERE l_extendedprice IS NOT NULL) AS n_rows, TRUE AS trees_in_range, TRUE AS beats_one_tree
FROM lineitem
""")
def early_stopping_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: on a label that the features decide (the price does not follow them,
    and one tree is all that its validation loss allows), the kept trees number
    1 to n_estimators and beat the model of the first tree alone on the
    validation rows."""
    from pyspark.ml.functions import vector_to_array
    from tabforge.functions.metrics import regression_metrics
    _, mat, _, _ = lineitem_regression(spark, sf_dir)
    x = vector_to_array("features")
    mat = mat.withColumn("y", x[1] + x[3] * x[5])
    model = fit_single(mat, "regression", REGRESSOR_PARAMS, "y", validation_col="_is_val")
    one = fit_single(mat.where(~F.col("_is_val")), "regression", {**REGRESSOR_PARAMS, "n_estimators": 1}, "y")
    valid = mat.where(F.col("_is_val"))

    def rmse(m):
        return regression_metrics(score(m, valid, "regression"), "y", "prediction").first()["rmse"]

    in_range = 1 <= model.getNumTrees <= REGRESSOR_PARAMS["n_estimators"]
    return mat.agg(F.count("l_extendedprice").alias("n_rows")).select(
        "n_rows", F.lit(in_range).alias("trees_in_range"), F.lit(rmse(model) < rmse(one)).alias("beats_one_tree"))


@query("search_space_domain", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS outside FROM orders")
def search_space_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: for every order one draw of a space with steps, logarithms, keyword
    bounds and truncation, seeded by its key; how many fall outside."""
    space = parse_space({
        "a": "trial.suggest_int('a', 10, 100, step=10)", "b": "trial.suggest_uniform('b', low=-1, high=2)",
        "c": "int(trial.suggest_uniform('c', 1, 3))", "d": "trial.suggest_float('d', 0.01, 1.0, log=True)",
        "e": "trial.suggest_discrete_uniform('e', 0, 1, q=0.25)", "f": "trial.suggest_categorical('f', ['x', 'y'])",
        "g": "trial.suggest_int('g', 1, 64, log=True)", "h": "trial.suggest_float('h', 0.5, 2.0, step=0.5)"})

    def outside(batches):
        import numpy as np
        import pandas as pd
        for pdf in batches:
            bad = []
            for key in pdf["o_orderkey"]:
                rng = np.random.default_rng(int(key))
                v = {p.name: p.draw(rng) for p in space}
                fine = (v["a"] in range(10, 101, 10) and -1 <= v["b"] <= 2 and v["c"] in (1, 2)
                        and 0.01 <= v["d"] <= 1.0 and v["e"] in (0, 0.25, 0.5, 0.75, 1.0) and v["f"] in ("x", "y")
                        and isinstance(v["g"], int) and 1 <= v["g"] <= 64 and v["h"] in (0.5, 1.0, 1.5, 2.0))
                bad.append(not fine)
            yield pd.DataFrame({"bad": bad})

    drawn = table(spark, sf_dir, "orders").select("o_orderkey").mapInPandas(outside, "bad boolean")
    return drawn.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("bad").alias("outside"))


@query("regression_score")
def regression_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 (regression) + E2/E3 on the early-stopping rows."""
    from tabforge.functions.metrics import regression_metrics
    _, mat, model, _ = lineitem_regression(spark, sf_dir)
    scored = score(model, mat.where(F.col("_is_val")), "regression")
    return regression_metrics(scored, "charge", "prediction")


@query("hp_search")
def hp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: random-search trials on every fold (fold, trial, params, val AUC, trees)."""
    return doc_search(spark, sf_dir).cv_results_frame(spark)


@query("cv_results")
def cv_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 / M9: per-fold train and validation AUC of the best trial."""
    return doc_search(spark, sf_dir).fold_scores_frame(spark)


@query("batch_score")
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: probability + class per document (a shuffle-free projection)."""
    _, _, mat, model, _ = doc_model(spark, sf_dir)
    return score(model, mat, "classification").select("doc_id", "prediction_proba", "prediction_class", "quality")


@query("model_reload")
def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save, reload, score with the copy."""
    _, _, mat, model, _ = doc_model(spark, sf_dir)
    path = scratch_path(spark, "model")
    save_model(spark, model, path, {"problem_type": "classification"})
    copy, _ = load_model(spark, path)
    return score(copy, mat, "classification").select("doc_id", "prediction_proba", "prediction_class")


@query("native_importance")
def native_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split count per feature."""
    _, prep, _, model, path = doc_model(spark, sf_dir)
    return explain.native_importance(spark, model, prep.feature_names, path)


def _contrib(spark: SparkSession, sf_dir: str, method: str):
    k = _key(spark, sf_dir, f"contrib-{method}")
    if k not in _CACHE:
        _, prep, mat, model, path = doc_model(spark, sf_dir)
        _CACHE[k] = (prep, mat, model, path)
    prep, mat, model, path = _CACHE[k]
    return prep, mat, model, explain.attribution(mat, model, keep=["doc_id"], method=method, model_path=path)


@query("path_contributions")
def path_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 + S9: per-document path contributions, one column per feature."""
    prep, _, _, contrib = _contrib(spark, sf_dir, "path")
    return explain.contributions_wide(contrib, prep.feature_names, keep=["doc_id"])


@query("shap_values")
def shap_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 + S9: per-document SHAP values, one column per feature."""
    prep, _, _, contrib = _contrib(spark, sf_dir, "shap")
    return explain.contributions_wide(contrib, prep.feature_names, keep=["doc_id"])


def _additivity(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    _, mat, model, contrib = _contrib(spark, sf_dir, method)
    return _additivity_error(mat, model, contrib)


def _additivity_error(mat: DataFrame, model, contrib: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    raw = (model.copy().setPredictionCol("_p").setProbabilityCol("_pr").setRawPredictionCol("_raw")
           .transform(mat).select("doc_id", vector_to_array("_raw").getItem(1).alias("margin")))
    total = contrib.select("doc_id", (F.col("bias") + F.aggregate("contributions", F.lit(0.0),
                                                                    lambda a, b: a + b)).alias("total"))
    err = raw.join(total, "doc_id").select(F.abs(F.col("margin") - F.col("total")).alias("e"))
    return rounded(err.agg(F.count(F.lit(1)).alias("n_rows"), F.max("e").alias("max_abs_error")))


_ADDITIVITY_SQL = """
SELECT count(*) AS n_rows, 0.0 AS max_abs_error
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


@query("contribution_additivity", _ADDITIVITY_SQL)
def contribution_additivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 invariant: bias + sum(contributions) equals the model margin for every row."""
    return _additivity(spark, sf_dir, "path")


@query("shap_additivity", _ADDITIVITY_SQL)
def shap_additivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 invariant (local accuracy): base value + sum(SHAP) equals the margin."""
    return _additivity(spark, sf_dir, "shap")


@query("importance_path")
def importance_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4-X6 (+X7 method 'treeinterpreter') over the model's path contributions."""
    prep, _, _, contrib = _contrib(spark, sf_dir, "path")
    return explain.importance_from_contributions(contrib, prep.feature_names)


@query("importance_shap")
def importance_shap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4-X6 (+X7 method 'shap') over the model's SHAP values."""
    prep, _, _, contrib = _contrib(spark, sf_dir, "shap")
    return explain.importance_from_contributions(contrib, prep.feature_names)


# ---------------------------------------------------------------------------
# X4-X6, S8, S9 over a linear attribution SQL can reproduce:
# c_i = w_i * (x_i - avg(x_i)); one negative weight, one constant feature
# ---------------------------------------------------------------------------

# The linear attribution's weights per lineitem column.
LINEAR_WEIGHTS = {"l_quantity": 0.5, "l_discount": -2.0, "l_tax": 3.0, "one": 1.0}


def linear_contributions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                  "l_discount", "l_tax", F.lit(1.0).alias("one"))
    names = list(LINEAR_WEIGHTS)
    means = li.agg(*[F.avg(n).alias(n) for n in names]).collect()[0]
    out = li.select("l_orderkey", "l_linenumber", *names,
                    *[(F.lit(w) * (F.col(n) - F.lit(means[n]))).alias(f"c_{n}")
                      for n, w in LINEAR_WEIGHTS.items()])
    return out, names


_LIN_SQL = "WITH m AS (SELECT avg(l_quantity) AS q, avg(l_discount) AS d, avg(l_tax) AS t FROM lineitem),\n" \
    "c AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, 1.0 AS one,\n" \
    "  0.5 * (l_quantity - m.q) AS c_l_quantity, -2.0 * (l_discount - m.d) AS c_l_discount,\n" \
    "  3.0 * (l_tax - m.t) AS c_l_tax, 0.0 AS c_one FROM lineitem, m),\n"


def _stats_sql() -> str:
    parts = []
    for n in LINEAR_WEIGHTS:
        parts.append(
            f"SELECT '{n}' AS feature, avg(abs(c_{n})) AS mean_abs, "
            f"CASE WHEN min({n}) < max({n}) AND min(c_{n}) < max(c_{n}) "
            f"THEN CAST(sign(covar_pop({n}, c_{n})) AS DOUBLE) ELSE 1.0 END AS sign FROM c")
    return "s AS (" + " UNION ALL ".join(parts) + ")\n"


@query("mean_abs_contribution", _LIN_SQL + _stats_sql() + f"SELECT feature, {r6('mean_abs')} AS mean_abs FROM s")
def mean_abs_contribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute contribution per feature."""
    c, names = linear_contributions(spark, sf_dir)
    imp = explain.importance_frame(spark, c, names, [F.col(n) for n in names], [F.col(f"c_{n}") for n in names])
    return rounded(imp.select("feature", "mean_abs"))


@query("contribution_sign", _LIN_SQL + _stats_sql() + "SELECT feature, sign FROM s")
def contribution_sign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign of the feature / contribution covariance (+1 for a constant)."""
    c, names = linear_contributions(spark, sf_dir)
    imp = explain.importance_frame(spark, c, names, [F.col(n) for n in names], [F.col(f"c_{n}") for n in names])
    return rounded(imp.select("feature", "sign"))


@query("importance_signed", _LIN_SQL + _stats_sql() + f"""
SELECT feature, {r6('mean_abs * sign')} AS importance,
       CAST(row_number() OVER (ORDER BY abs(mean_abs * sign) DESC, feature) AS INTEGER) AS rank_abs
FROM s
""")
def importance_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 + S8: signed importance and its rank by absolute value."""
    c, names = linear_contributions(spark, sf_dir)
    imp = explain.importance_frame(spark, c, names, [F.col(n) for n in names], [F.col(f"c_{n}") for n in names])
    return rounded(imp.select("feature", "importance", "rank_abs"))


@query("contribution_wide", _LIN_SQL.rstrip().rstrip(",") + f"""
SELECT l_orderkey, l_linenumber, {r6('c_l_quantity')} AS l_quantity, {r6('c_l_discount')} AS l_discount,
       {r6('c_l_tax')} AS l_tax, {r6('c_one')} AS one
FROM c
""")
def contribution_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-row contributions, one column per feature, keyed by the row id,
    through the sink that the jobs use."""
    c, names = linear_contributions(spark, sf_dir)
    contrib = c.select("l_orderkey", "l_linenumber", F.lit(0.0).alias("bias"), F.array(*[f"c_{n}" for n in names]).alias("contributions"))
    return rounded(explain.contributions_wide(contrib, names, ["l_orderkey", "l_linenumber"]).drop("bias"))


def sparse_model(spark: SparkSession, sf_dir: str):
    """A classifier over sparse one-hot vectors: the document's words count is
    left out, its source and a 41-value bucket of its length are categories."""
    k = _key(spark, sf_dir, "sparse")
    if k not in _CACHE:
        raw, _ = fit_docs(spark, sf_dir)
        raw = raw.select("doc_id", "source", F.concat(F.lit("b"), (F.col("n_chars").cast("long") % 41).cast("string"))
                         .alias("bucket"), "n_chars", "quality")
        spec = FeatureSpec.from_columns({"source": ["category", 1, "unknown", "one-hot", "f"],
                                         "bucket": ["category", 1, "unknown", "one-hot", "f"],
                                         "n_chars": ["float", 1, "mean", None, "f"]})
        prep = FeaturePrep(spec, target="quality", passthrough=["doc_id"], encoding="vector").fit(raw)
        mat = prep.transform(raw, assemble=True)
        model = fit_single(mat, "classification", CLASSIFIER_PARAMS, "quality")
        path = scratch_path(spark, "sparse-model")
        model.write().overwrite().save(path)
        _CACHE[k] = (raw, prep, mat, model, path)
    return _CACHE[k]


def _sparse_additivity(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    _, _, mat, model, path = sparse_model(spark, sf_dir)
    contrib = explain.attribution(mat, model, keep=["doc_id"], method=method, model_path=path)
    return _additivity_error(mat, model, contrib)


@query("sparse_path_additivity", _ADDITIVITY_SQL)
def sparse_path_additivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 invariant on the sparse encoding."""
    return _sparse_additivity(spark, sf_dir, "path")


@query("sparse_shap_additivity", _ADDITIVITY_SQL)
def sparse_shap_additivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 invariant on the sparse encoding."""
    return _sparse_additivity(spark, sf_dir, "shap")


#: files of a micro-batch: each batch reads the static labels once
STREAM_FILES = 256


@query("stream_score")
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming scoring: the documents table read as a file stream, joined to
    the static labels, prepared and scored by the fitted preparation + model,
    written by an ``availableNow`` query with a checkpoint; the sink is read back."""
    from tabforge.plans.queries_prepare import docs_labeled
    from tabforge.streaming.scoring import score_stream
    _, prep, _, model, _ = doc_model(spark, sf_dir)
    docs_schema = table(spark, sf_dir, "documents").schema
    # a pattern: the table is one file or a folder of part files
    stream = (spark.readStream.schema(docs_schema).option("maxFilesPerTrigger", STREAM_FILES)
              .parquet(f"{sf_dir.rstrip('/')}/documents.parque[t]"))
    labels = table(spark, sf_dir, "labels")
    k = F.col("doc_id")
    rows = stream.join(labels, "doc_id").select(
        "doc_id",
        F.when(k % 7 != 0, F.col("n_chars").cast("double")).alias("n_chars"),
        F.when(k % 11 != 0, F.col("lang")).alias("lang"),
        F.when(k % 13 != 0, F.col("source")).alias("source"),
        F.when(k % 5 != 0, F.col("toxic") == 1).alias("toxic_flag"),
        "quality")
    out_path = scratch_path(spark, "stream-out")
    q = (score_stream(rows, prep, model, "classification", keep=["doc_id", "quality"], typed=True)
         .writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt"))
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)


# ---------------------------------------------------------------------------
# The full jobs over a CSV export of the prepared documents
# ---------------------------------------------------------------------------

def _job_inputs(spark: SparkSession, sf_dir: str):
    k = _key(spark, sf_dir, "job")
    if k not in _CACHE:
        from tabforge.plans import jobs
        from tabforge.plans.queries_prepare import DOC_SPEC, docs_labeled
        from tabforge.sources.sinks import write_table
        from tabforge.spec import DataConfig
        csv = write_table(docs_labeled(spark, sf_dir), scratch_path(spark, "job-input"), "csv")
        base = scratch_path(spark, "job-out")
        mcfg = ModelConfig.from_dict(SEARCH_CONFIG)
        tcfg = DataConfig(training=True, input_data_source="CSV", file_path=csv, uid_column_name="doc_id",
                          output_base=base, run_id="train")
        res = jobs.train(spark, mcfg, tcfg, spec=DOC_SPEC)
        _CACHE[k] = (csv, base, mcfg, res)
    return _CACHE[k]


@query("train_job")
def train_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read CSV -> validate -> prepare -> CV search -> refit -> score ->
    attribute -> write; returns the written original-data-with-predictions table."""
    _, _, _, res = _job_inputs(spark, sf_dir)
    return spark.read.option("header", True).csv(f"{res.output_dir}/predictions/original_data_with_predictions")


@query("predict_job")
def predict_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reload preparation + model from J1's output, score the CSV, write
    the prediction table (id, probability, class, target) and SHAP outputs."""
    from tabforge.plans import jobs
    from tabforge.spec import DataConfig
    csv, base, mcfg, res = _job_inputs(spark, sf_dir)
    stem = "quality_classification_lgbm"
    pcfg = DataConfig(training=False, input_data_source="CSV", file_path=csv, uid_column_name="doc_id",
                      model_file_path=f"{res.output_dir}/model/{stem}",
                      data_processor_file_path=f"{res.output_dir}/deep_insights_input/{stem}_data_processor",
                      output_base=base, run_id="predict", calculate_importance=True)
    out = jobs.predict(spark, mcfg, pcfg)
    return spark.read.option("header", True).csv(out.details["output_path"])


# ---------------------------------------------------------------------------
# invariants as queries: their expected values follow from the tables alone
# ---------------------------------------------------------------------------

_DOC_COUNT_SQL = "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"


def _max_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    j = a.select("doc_id", F.col("prediction_proba").alias("pa")).join(
        b.select("doc_id", F.col("prediction_proba").alias("pb")), "doc_id", "full_outer")
    return rounded(j.agg(F.count(F.lit(1)).alias("n_rows"),
                         F.max(F.coalesce(F.abs(F.col("pa") - F.col("pb")), F.lit(1.0))).alias("max_abs_diff")))


@query("model_reload_identity", f"SELECT count(*) AS n_rows, 0.0 AS max_abs_diff {_DOC_COUNT_SQL}")
def model_reload_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 invariant: the reloaded model scores every row exactly as the original."""
    return _max_diff(batch_score(spark, sf_dir), model_reload(spark, sf_dir))


@query("stream_batch_identity", f"SELECT count(*) AS n_rows, 0.0 AS max_abs_diff {_DOC_COUNT_SQL}")
def stream_batch_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming scoring equals batch scoring, row for row."""
    return _max_diff(batch_score(spark, sf_dir), stream_score(spark, sf_dir))


@query("predict_job_contract", f"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS bad_probability, CAST(0 AS BIGINT) AS bad_class {_DOC_COUNT_SQL}
""")
def predict_job_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 contract: one prediction per input row, probability in [0, 1],
    class = probability > 0.5."""
    t = predict_job(spark, sf_dir)
    p = F.col("prediction_proba").cast("double")
    return t.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(p.isNull() | (p < 0) | (p > 1)).alias("bad_probability"),
                 F.count_if(F.col("prediction_class").cast("int") != (p > 0.5).cast("int")).alias("bad_class"))


# ---------------------------------------------------------------------------
# contracts of fits, searches and runs
# ---------------------------------------------------------------------------

@query("classifier_contract", f"SELECT count(*) AS n_rows, 20 AS n_trees, TRUE AS beats_chance {_DOC_COUNT_SQL}")
def classifier_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: the asked number of trees, better than chance on its rows."""
    from tabforge.functions.metrics import auc_frame
    _, _, mat, model, _ = doc_model(spark, sf_dir)
    scored = score(model, mat, "classification")
    auc = auc_frame(scored, "quality", "prediction_proba").first()["auc"]
    return scored.agg(F.count("prediction_proba").alias("n_rows")).select(
        "n_rows", F.lit(int(model.getNumTrees)).alias("n_trees"), F.lit(auc > 0.6).alias("beats_chance"))


@query("regressor_contract", """
SELECT count(*) AS n_rows, TRUE AS trees_in_range, TRUE AS explains_most FROM lineitem
""")
def regressor_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: of a label that the features decide, the model explains most on
    the rows that early stopping kept out."""
    from tabforge.functions.metrics import regression_metrics
    _, mat, model, _ = lineitem_regression(spark, sf_dir)
    r2 = regression_metrics(score(model, mat.where(F.col("_is_val")), "regression"), "charge", "prediction").first()["r2"]
    kept = 1 <= model.getNumTrees <= REGRESSOR_PARAMS["n_estimators"]
    return score(model, mat, "regression").agg(F.count("prediction").alias("n_rows")).select(
        "n_rows", F.lit(kept).alias("trees_in_range"), F.lit(r2 > 0.8).alias("explains_most"))


@query("rounds_contract", f"""
SELECT count(*) AS n_rows, 20 AS n_rounds, CAST(0 AS BIGINT) AS outside_bound, TRUE AS bound_is_small {_DOC_COUNT_SQL}
""")
def rounds_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The binned AUC of every round, from one scan, is within its
    stated bound of the exact AUC of that many trees."""
    from tabforge.functions.metrics import auc_frame
    from tabforge.operators.ensemble import first_trees, round_scores
    _, _, mat, model, _ = doc_model(spark, sf_dir)
    mat = mat.select("doc_id", "features", "quality").cache()
    rounds = round_scores(mat, [model], "classification", "quality").select("round", "rocauc", "bound")
    parts = [score(first_trees(model, k), mat, "classification").select("quality", "prediction_proba", F.lit(k - 1).alias("round"))
             for k in (1, 5, 10, int(model.getNumTrees))]
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.union(p)
    both = rounds.join(auc_frame(scored, "quality", "prediction_proba", by=["round"]), "round", "left")
    facts = both.agg(F.count(F.lit(1)).cast("int").alias("n_rounds"),
                     F.count_if(F.abs(F.col("rocauc") - F.col("auc")) > F.col("bound") + 1e-12).alias("outside_bound"),
                     (F.max_by("bound", "round") < 0.05).alias("bound_is_small"))
    return mat.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(facts)       # one row each


@query("importance_contract", f"""
SELECT count(*) AS n_rows, TRUE AS splits_add_up, TRUE AS every_feature {_DOC_COUNT_SQL}
""")
def importance_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per feature, and the splits of all features are the inner
    nodes of all trees (leaves less one each)."""
    _, prep, mat, model, path = doc_model(spark, sf_dir)
    imp = explain.native_importance(spark, model, prep.feature_names, path)
    trees = _tree_summary(spark, model, path).agg(F.sum(F.col("leaves") - 1).alias("s")).first()["s"]
    facts = imp.agg((F.sum("importance") == trees).alias("splits_add_up"),
                    (F.count_distinct("feature") == len(prep.feature_names)).alias("every_feature"))
    return mat.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(facts)       # one row each


@query("train_job_contract", f"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS bad_probability, CAST(10 AS BIGINT) AS n_trials, CAST(5 AS BIGINT) AS n_folds,
       CAST(0 AS BIGINT) AS bad_trials {_DOC_COUNT_SQL}
""")
def train_job_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction per input row, and a row per trial and fold whose
    kept trees are at most the asked ones and whose score is a probability."""
    _, _, _, res = _job_inputs(spark, sf_dir)
    p = F.col("prediction_proba").cast("double")
    rows = train_job(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.count_if(p.isNull() | (p < 0) | (p > 1)).alias("bad_probability"))
    trials = spark.read.option("header", True).option("escape", '"').csv(f"{res.output_dir}/model/cv_results")
    asked = F.get_json_object("params", "$.n_estimators").cast("int")
    kept, val = F.col("n_trees").cast("int"), F.col("val_score").cast("double")
    fine = (kept >= 1) & (kept <= asked) & (val >= 0) & (val <= 1)
    facts = trials.agg(F.count(F.lit(1)).alias("n_trials"), F.count_distinct("fold").alias("n_folds"),
                       F.count_if(~F.coalesce(fine, F.lit(False))).alias("bad_trials"))
    return rows.crossJoin(facts)       # one row each


@query("run_manifest", f"""
SELECT 'quality' AS target, 'classification' AS problem_type, 2 AS n_searches, TRUE AS has_score, TRUE AS committed,
       count(*) AS n_rows {_DOC_COUNT_SQL}
""")
def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the published run, and the rows that it vouches for."""
    from tabforge.sources.storage import committed
    _, _, _, res = _job_inputs(spark, sf_dir)
    m = spark.read.json(f"{res.output_dir}/training_config").select(
        F.get_json_object("modeling_config", "$.target_variable").alias("target"),
        F.get_json_object("modeling_config", "$.problem_type").alias("problem_type"),
        F.get_json_object("modeling_config", "$.num_hp_searches").cast("int").alias("n_searches"),
        F.get_json_object("training_results", "$.cv_mean_val_score").cast("double").between(0, 1).alias("has_score"),
        F.lit(committed(spark, res.output_dir)).alias("committed"))
    return m.crossJoin(train_job(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows")))      # one row each


@query("target_missing", f"""
SELECT count(*) AS n_rows, TRUE AS training_fails, TRUE AS names_target, TRUE AS scoring_passes {_DOC_COUNT_SQL}
""")
def target_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: without the target column training is refused, by the target's name;
    scoring goes on."""
    from tabforge.operators.validate import validate
    from tabforge.plans.queries_prepare import DOC_SPEC, docs_labeled
    rows = docs_labeled(spark, sf_dir).drop("quality")
    train, test = [validate(rows, DOC_SPEC, "quality", training=t) for t in (True, False)]
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(bool(train.errors)).alias("training_fails"), F.lit(any("quality" in e for e in train.errors)).alias("names_target"),
        F.lit(not test.errors).alias("scoring_passes"))


@query("metric_direction", """
SELECT * FROM (VALUES ('accuracy', 'gt'), ('f1', 'gt'), ('mse', 'lt'), ('r2', 'gt'), ('rmse', 'lt'), ('rocauc', 'gt')) m(metric, better),
  (SELECT count(*) AS n_rows, TRUE AS ranks_first FROM orders) o
""")
def metric_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By every metric's direction, predictions that follow the label rank
    before those that contradict it on a part of the rows."""
    from tabforge.operators.model import evaluate, rank_score
    from tabforge.spec import METRIC_SIGN
    o = table(spark, sf_dir, "orders").select((F.col("o_orderstatus") == "F").cast("double").alias("y"), "o_orderkey")
    wrong = F.when(F.col("o_orderkey") % 5 == 0, 1 - F.col("y")).otherwise(F.col("y"))
    rows = []
    for metric, sign in METRIC_SIGN.items():
        if metric == "auc":
            continue
        problem = "classification" if metric in ("rocauc", "accuracy", "f1") else "regression"
        column = "prediction_proba" if problem == "classification" else "prediction"
        good, bad = [evaluate(o.withColumn(column, 0.1 + 0.8 * p), problem, metric, "y") for p in (F.col("y"), wrong)]
        rows.append((metric, "gt" if sign > 0 else "lt", rank_score(sign, good) > rank_score(sign, bad)))
    facts = spark.createDataFrame(rows, "metric string, better string, ranks_first boolean")
    return facts.crossJoin(o.agg(F.count(F.lit(1)).alias("n_rows")))         # one row on the right
