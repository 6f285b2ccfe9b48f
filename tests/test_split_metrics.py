"""Folds, samples and metrics: exactness and scale-path equivalence."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.functions.metrics import auc_frame, classification_metrics, regression_metrics, roc_auc
from tabforge.operators.split import assign_folds, class_weight_frame, sample_exact

SF = "/root/testdata/sf0.01"


def brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_stratified_fold_balance(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderstatus")
    folded = assign_folds(o, k=5, seed=42, label="o_orderstatus", id_cols=["o_orderkey"], n_buckets=16)
    counts = folded.groupBy("o_orderstatus", "fold").count().toPandas()
    for _, g in counts.groupby("o_orderstatus"):
        assert len(g) == 5 and g["count"].max() - g["count"].min() <= 1


def test_folds_partition_and_bucket_invariant(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderstatus")
    a = assign_folds(o, label="o_orderstatus", id_cols=["o_orderkey"], n_buckets=1).toPandas()
    b = assign_folds(o.repartition(13), label="o_orderstatus", id_cols=["o_orderkey"], n_buckets=64).toPandas()
    m = a.merge(b, on=["o_orderkey", "o_orderstatus"])
    assert len(m) == len(a) and (m["fold_x"] == m["fold_y"]).all()


def test_sample_exact_count_and_determinism(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey")
    n = o.count()
    s1 = sample_exact(o, 0.137, id_cols=["o_orderkey"], n_buckets=32)
    s2 = sample_exact(o.repartition(5), 0.137, id_cols=["o_orderkey"], n_buckets=3)
    assert s1.count() == int(n * 0.137)
    assert sorted(r[0] for r in s1.collect()) == sorted(r[0] for r in s2.collect())
    assert sample_exact(o, 1e-9, id_cols=["o_orderkey"]).count() == 1


def test_auc_matches_pairwise_with_ties(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) + 0.3 * y, 1)          # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    exp = brute_auc(y, s)
    assert abs(roc_auc(df, "y", "s") - exp) < 1e-12
    assert abs(roc_auc(df, "y", "s", n_buckets=7) - exp) < 1e-12
    assert abs(roc_auc(df, "y", 1 - F.col("s")) - (1 - exp)) < 1e-12


def test_grouped_auc(spark):
    df = spark.createDataFrame([(g, y, s) for g, (y, s) in
                                itertools.product([0, 1], [(0, 0.1), (1, 0.9), (0, 0.5), (1, 0.5)])],
                               "g int, y int, s double")
    r = {row["g"]: row["auc"] for row in auc_frame(df, "y", "s", by=["g"]).collect()}
    assert r == {0: 0.875, 1: 0.875}


def test_classification_and_regression_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.1), (1, 0.7)], "y int, p double")
    r = classification_metrics(df, "y", "p").collect()[0]
    assert (r["accuracy"], r["precision"], r["recall"]) == (0.6, 2 / 3, 2 / 3)
    assert abs(r["f1"] - 2 / 3) < 1e-12
    none = classification_metrics(df, "y", F.lit(0.0)).collect()[0]
    assert none["precision"] == 0.0 and none["f1"] == 0.0
    reg = regression_metrics(spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "y double, p double"),
                             "y", "p").collect()[0]
    assert abs(reg["mse"] - 1 / 6) < 1e-12 and abs(reg["r2"] - 0.75) < 1e-12


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)], "y int")
    w = {r["y"]: r["weight"] for r in class_weight_frame(df, "y").collect()}
    assert w == {1: 4 / 6, 0: 4 / 2}


def test_auc_bucketizer_path(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 2000)
    s = np.round(rng.random(2000) + 0.2 * y, 3)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double").repartition(6)
    exp = roc_auc(df, "y", "s", n_buckets=1)
    assert abs(roc_auc(df, "y", "s", n_buckets=200) - exp) < 1e-12    # > 64 buckets: binary search


def test_hash_folds_no_shuffle(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey")
    f = assign_folds(o, k=5, id_cols=["o_orderkey"], exact=False)
    assert "Exchange" not in f._jdf.queryExecution().executedPlan().toString()
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) < 0.1 * sum(sizes) / 5


@pytest.mark.parametrize("bound", [None, 4])
def test_grouped_auc_bucketed(spark, bound):
    rng = np.random.default_rng(5)
    rows = [(int(g), int(y), float(np.round(rng.random() + 0.3 * y, 2)))
            for g in range(3) for y in rng.integers(0, 2, 300)]
    df = spark.createDataFrame(rows, "g int, y int, s double")
    got = {r["g"]: r["auc"] for r in auc_frame(df, "y", "s", by=["g"], n_buckets=6).collect()}
    for g in range(3):
        ys = [y for gg, y, _ in rows if gg == g]
        ss = [s for gg, _, s in rows if gg == g]
        assert abs(got[g] - brute_auc(ys, ss)) < 1e-12


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=5, max_size=200), st.integers(1, 7), st.integers(1, 9))
def test_fold_balance_property(spark, labels, parts, buckets):
    df = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "id long, y int").repartition(parts)
    pdf = assign_folds(df, k=5, label="y", id_cols=["id"], n_buckets=buckets).toPandas()
    assert len(pdf) == len(labels)
    for y, g in pdf.groupby("y"):
        counts = g["fold"].value_counts().reindex(range(5), fill_value=0)
        assert counts.max() - counts.min() <= 1


def test_auc_has_no_single_task_over_the_scores(spark):
    df = spark.range(1000).selectExpr("id % 2 y", "id / 1000.0 s")
    plan = auc_frame(df, "y", "s")._jdf.queryExecution().executedPlan().toString()
    scores_in_one_task = [x for x in plan.split("\n") if "SinglePartition" in x]
    assert plan.count("Window") >= 2 and "hashpartitioning(_b" in plan
    # what meets in one task are the per-bucket totals and the last sum, not the scores
    assert len(scores_in_one_task) <= 2


def test_folds_keep_rows_without_a_label(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else float(i % 2)) for i in range(100)], "id long, y double")
    out = assign_folds(df, k=5, label="y", id_cols=["id"]).groupBy("y", "fold").count().collect()
    assert sum(r["count"] for r in out) == 100 and {r["count"] for r in out if r["y"] is None} == {2}


def _sizes(df, k, by="c"):
    rows = df.groupBy(by, "fold").count().collect()
    out = {}
    for r in rows:
        out.setdefault(r[by], [0] * k)[r["fold"]] = r["count"]
    return out


@pytest.mark.parametrize("bracket_rows", [3, 2_000_000])
def test_folds_by_cuts_are_ranges_of_the_shuffled_order(spark, bracket_rows):
    import hashlib
    from tabforge.operators.split import folds_by_cuts
    rows = [(i, ["a", "b", None, "rare"][0 if i % 3 else 1 + (i // 3) % 2] if i > 4 else "rare", float(i)) for i in range(997)]
    df = spark.createDataFrame(rows, "id long, c string, x double").repartition(5).cache()
    out = folds_by_cuts(df, 5, 42, "c", ["id"], bracket_rows=bracket_rows)
    got = {r["id"]: r["fold"] for r in out.collect()}
    want = {}
    for c in ("a", "b", None, "rare"):
        order = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i, x, _ in rows if x == c)
        want |= {i: place * 5 // len(order) for place, (_, i) in enumerate(order)}
    assert got == want and out.columns == ["id", "c", "x", "fold"]
    assert all(max(s) - min(s) <= 1 for s in _sizes(out, 5).values())


def test_folds_by_cuts_move_no_rows(spark):
    from tabforge.operators.split import assign_folds
    df = spark.range(5000).selectExpr("id", "id % 3 as c", "id * 0.5 as feature").cache()
    out = assign_folds(df, 5, 1, "c", ["id"], dealt="ranges")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert all(max(s) - min(s) <= 1 for s in _sizes(out, 5).values())


def test_folds_by_cuts_of_equal_rows_and_many_classes(spark):
    from tabforge.operators.split import assign_folds, folds_by_cuts
    same = spark.createDataFrame([(1, "a")] * 203 + [(i, "b") for i in range(40)] + [(7, "c")], "id long, c string").repartition(4).cache()
    for ids in (["id"], None):
        out = folds_by_cuts(same, 4, 3, "c", ids, ids_unique=False)
        assert out.count() == 244 and all(max(s) - min(s) <= 1 for s in _sizes(out, 4).values())
    many = spark.range(600).selectExpr("id", "id % 300 as c").cache()
    assert folds_by_cuts(many, 2, 1, "c", ["id"]) is None
    assert all(s == [1, 1] for s in _sizes(assign_folds(many, 2, 1, "c", ["id"], dealt="ranges"), 2).values())
    empty = spark.createDataFrame([], "id long, c string")
    assert folds_by_cuts(empty, 3, 1, "c", ["id"]).count() == 0 and folds_by_cuts(empty, 3, 1, None, ["id"]).count() == 0
