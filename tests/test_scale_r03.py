"""Findings of round 3: what grows with the input, on rows made here."""

from pyspark.sql import functions as F

from tabforge.operators.prepare import FeaturePrep
from tabforge.spec import FeatureSpec


def test_dictionary_vectors_name_no_attribute_per_category(spark):
    """the driver holds a vector column's length, not its categories."""
    df = spark.range(3000).select("id", F.concat(F.lit("c"), "id").alias("kind"))
    spec = FeatureSpec.from_columns({"kind": ["category", 1, "unknown", "one-hot", "f"]})
    prep = FeaturePrep(spec, passthrough=["id"], encoding="dictionary").fit(df)
    column = prep.transform(df).schema["kind_onehot"]
    assert len(str(column.metadata)) < 100 and column.metadata["ml_attr"]["num_attrs"] == 3000


def _documents(spark, path, files):
    rows = spark.range(300).select(
        F.col("id").alias("doc_id"), F.lit("a text").alias("text"), F.element_at(F.array(F.lit("de"), F.lit("en")), (F.col("id") % 2 + 1).cast("int")).alias("lang"),
        F.concat(F.lit("src"), F.col("id") % 3).alias("source"), (F.col("id") * 37 % 101).alias("n_chars"))
    rows.repartition(files).write.parquet(f"{path}/documents.parquet")
    spark.range(0, 300, 2).select(F.col("id").alias("doc_id"), (F.col("id") * 37 % 101 > 50).cast("int").alias("quality"),
                                  (F.col("id") % 5 == 0).cast("int").alias("toxic")).write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stream_reads_a_table_of_part_files(spark, tmp_path):
    """the documents table as a folder, with a file of each part."""
    from tabforge.plans.queries_model import stream_batch_identity, stream_score
    path = _documents(spark, tmp_path, 3)
    assert sorted(r["doc_id"] for r in stream_score(spark, path).collect()) == list(range(0, 300, 2))
    assert stream_batch_identity(spark, path).first().asDict() == {"n_rows": 150, "max_abs_diff": 0.0}


def _parts(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_fit_tasks_hold_bounded_rows():
    """Rows of a task stay under the limit however many there are."""
    from tabforge.operators.model import MAX_ROWS_PER_TASK, fit_tasks
    for rows in (0, 1, 49_999, 600_000, 36_000_000, 216_000_000):
        tasks = fit_tasks(rows, 12)
        assert tasks >= 1 and rows <= tasks * MAX_ROWS_PER_TASK
    assert [fit_tasks(n, 12) for n in (0, 4000, 600_000, 1_200_000)] == [1, 1, 12, 24]


def test_a_fit_deals_out_one_large_part(spark, monkeypatch):
    """The source's parts follow its files; a fit's follow its rows."""
    from tabforge.operators import model as M
    monkeypatch.setattr(M, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(M, "MAX_ROWS_PER_TASK", 200)
    one = spark.range(0, 1000, 1, 1).persist()
    even, tasks = M.spread(one, 100)
    try:
        assert 5 <= tasks <= 10 and max(_parts(even)) <= 2 * 1000 / tasks and even.count() == 1000
        assert sorted(r["id"] for r in even.collect()) == list(range(1000))
    finally:
        even.unpersist()
    few = spark.range(0, 90, 1, 3).persist()
    same, tasks = M.spread(few, 100)
    assert tasks == 1 and same is few and _parts(few) == [30, 30, 30]
    few.unpersist()


def test_fit_reads_even_parts(spark, monkeypatch):
    """The frames that fits get have no part over twice a task's share,
    and shallow trees keep no node table."""
    from pyspark.ml.functions import array_to_vector
    from tabforge.operators import model as M
    monkeypatch.setattr(M, "MAX_ROWS_PER_TASK", 100)
    rows = spark.range(0, 600, 1, 1).select((F.col("id") % 7).cast("double").alias("y"),
                                            array_to_vector(F.array((F.col("id") % 7).cast("double"), F.lit(1.0))).alias("features"))
    seen, make = [], M.make_estimator

    def watch(*args):
        est = make(*args)
        assert not est.getCacheNodeIds()
        fit = est.fit
        est.fit = lambda df: (seen.append(max(_parts(df))), fit(df))[1]
        return est

    monkeypatch.setattr(M, "make_estimator", watch)
    M.fit_single(rows, "regression", {"n_estimators": 2, "num_leaves": 4}, "y")
    assert seen and max(seen) <= 200
