"""Feature preparation (reference processor tests + properties)."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabforge.operators.prepare import FeaturePrep, FeaturePrepModel, imputed_moments
from tabforge.operators.ranking import exact_medians
from tabforge.spec import FeatureSpec

F3_SPEC = FeatureSpec.from_columns({
    "id_col": ["category", 0, "unknown", "one-hot", "1_id"],
    "float_feature": ["float", 1, "mean", "NaN", "3_features"],
    "cat_feature": ["category", 1, "unknown", "one-hot", "3_features"],
    "bool_feature": ["bool", 1, "unknown", "NaN", "3_features"],
})


@pytest.fixture()
def f3(spark):
    return spark.createDataFrame(
        [(1, 1.5, "A", True), (2, 2.5, "B", False), (3, None, "A", True), (4, 4.5, "C", None),
         (5, 5.5, None, False)],
        "id_col int, float_feature double, cat_feature string, bool_feature boolean")


def test_fit_transform_contract(f3):
    out = FeaturePrep(F3_SPEC).fit_transform(f3)
    assert "id_col" not in out.columns                   # usage 0 dropped
    assert out.columns == ["float_feature_missing", "float_feature", "cat_feature_A", "cat_feature_B",
                           "cat_feature_C", "cat_feature_unknown", "cat_feature_missing",
                           "bool_feature", "bool_feature_missing"]
    rows = out.collect()
    assert all(v is not None for r in rows for v in r)   # no nulls after transform
    vals = np.array([r["float_feature"] for r in rows])
    assert abs(vals.mean()) < 1e-12 and abs(vals.std() - 1) < 1e-12   # population std
    assert [r["cat_feature_unknown"] for r in rows] == [0, 0, 0, 0, 1]
    assert [r["float_feature_missing"] for r in rows] == [0, 0, 1, 0, 0]
    assert [r["bool_feature"] for r in rows] == [1, 0, 1, 0, 0]


def test_save_load_identical(spark, f3, tmp_path):
    model = FeaturePrep(F3_SPEC, passthrough=["id_col"]).fit(f3)
    model.save(spark, str(tmp_path / "prep"))
    copy = FeaturePrepModel.load(spark, str(tmp_path / "prep"))
    assert copy.feature_names == model.feature_names
    a = model.transform(f3).orderBy("id_col").toPandas()
    b = copy.transform(f3).orderBy("id_col").toPandas()
    assert a.equals(b)


def test_transform_needs_features(spark, f3):
    model = FeaturePrep(F3_SPEC).fit(f3)
    with pytest.raises(ValueError):
        model.transform(f3.drop("cat_feature"))


def test_unseen_category_all_zero(spark, f3):
    model = FeaturePrep(F3_SPEC).fit(f3)
    new = spark.createDataFrame([(9, 1.0, "Z", True)], f3.schema)
    r = model.transform(new).collect()[0]
    assert sum(r[c] for c in model.feature_names if c.startswith("cat_feature_") and c != "cat_feature_missing") == 0


def test_mode_median_zero_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0, "b", 3.0), (2.0, None, "a", 3.0), (None, 1.0, "b", 3.0),
                                (4.0, 2.0, "a", None), (None, 7.0, None, 3.0)],
                               "m double, z double, c string, k double")
    spec = FeatureSpec.from_columns({"m": ["float", 1, "median", None, None],
                                     "z": ["float", 1, "0", None, None],
                                     "c": ["category", 1, "most_frequent", "one-hot", None],
                                     "k": ["float", 1, "mean", None, None]})
    model = FeaturePrep(spec).fit(df)
    stats = {s.name: s for s in model.numeric}
    assert stats["m"].fill == 2.0                  # even count: mean of the two middle values
    assert stats["z"].fill == 0.0
    assert stats["k"].scale == 1.0                 # constant after imputation -> divide by 1
    assert model.categorical[0].fill == "a"        # tie a/b (2 each) -> smallest
    assert model.categorical[0].vocab == ["a", "b"]


def test_all_null_numeric_and_reserved_names(spark):
    df = spark.createDataFrame([(None, "missing"), (None, "x"), (None, None)], "e double, c string")
    spec = FeatureSpec.from_columns({"e": ["float", 1, "mean", None, None],
                                     "c": ["category", 1, "unknown", "one-hot", None]})
    with pytest.warns(UserWarning):
        model = FeaturePrep(spec).fit(df)
    out = model.transform(df)
    assert len(set(out.columns)) == len(out.columns)          # 'c_missing' category vs indicator
    assert [r["e"] for r in out.collect()] == [0.0, 0.0, 0.0]


def test_fill_one_indicator_parity(spark, f3):
    model = FeaturePrep(F3_SPEC, indicator="fill_one").fit(f3)
    rows = model.transform(f3).collect()
    assert [r["float_feature_missing"] for r in rows] == [1.5, 2.5, 1.0, 4.5, 5.5]


def test_max_categories_guard(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    spec = FeatureSpec.from_columns({"c": ["category", 1, "unknown", "one-hot", None]})
    with pytest.raises(ValueError):
        FeaturePrep(spec, max_categories=10).fit(df)


def test_imputed_moments_formula():
    rng = np.random.default_rng(0)
    x = rng.normal(3, 2, 101)
    mask = rng.random(101) < 0.3
    v = x[~mask]
    for fill in (v.mean(), np.median(v), 0.0):
        m, var = imputed_moments(101, len(v), v.mean(), v.var(), fill)
        full = np.where(mask, fill, x)
        assert abs(m - full.mean()) < 1e-12 and abs(var - full.var()) < 1e-10


def test_exact_median_narrowing(spark, monkeypatch):
    import tabforge.operators.ranking as rk
    monkeypatch.setattr(rk, "MAX_BRACKET_ROWS", 1)       # force the narrowing passes
    rng = np.random.default_rng(1)
    vals = np.round(rng.lognormal(0, 2, 4001), 3)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(7)
    assert exact_medians(df, ["v"])["v"] == float(np.median(vals))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False)), min_size=2, max_size=30),
       st.lists(st.sampled_from(["p", "q", "r", None]), min_size=30, max_size=30))
def test_properties(spark, xs, cs):
    n = len(xs)
    df = spark.createDataFrame(list(zip(range(n), xs, cs[:n])), "i long, x double, c string")
    spec = FeatureSpec.from_columns({"x": ["float", 1, "mean", None, None],
                                     "c": ["category", 1, "unknown", "one-hot", None]})
    model = FeaturePrep(spec, passthrough=["i"]).fit(df)
    out = model.transform(df).toPandas()
    assert len(out) == n                                          # row preserving
    assert not out.isna().any().any()                             # null free
    x = out["x"].to_numpy()
    assert abs(x.mean()) < 1e-6 and (abs(x.std() - 1) < 1e-6 or abs(x.std()) < 1e-6)
    onehot = [c for c in model.feature_names if c.startswith("c_") and c != "c_missing"]
    assert (out[onehot].sum(axis=1) == 1).all()                   # seen values: exactly one hot


def test_several_medians_one_job(spark):
    from tabforge.operators.ranking import exact_medians
    rng = np.random.default_rng(7)
    a = rng.normal(size=501).round(2)
    b = rng.exponential(size=501).round(1)
    rows = [(float(x), float(y) if i % 2 else None, None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = exact_medians(df, ["a", "b", "c"])
    assert got["a"] == float(np.median(a))
    assert got["b"] == float(np.median(b[1::2]))       # even count: mean of the middle two
    assert got["c"] is None


def test_fit_partition_invariant(spark):
    from tabforge.plans.queries_prepare import STANDARD_SCALE_SPEC, lineitem_nulls
    df = lineitem_nulls(spark, "/root/testdata/sf0.001")
    a = FeaturePrep(STANDARD_SCALE_SPEC, missing_indicators=False).fit(df)
    b = FeaturePrep(STANDARD_SCALE_SPEC, missing_indicators=False).fit(df.repartition(11))
    for x, y in zip(a.numeric, b.numeric):
        assert x.name == y.name and x.fill == y.fill or abs(x.fill - y.fill) < 1e-9
        assert abs(x.mean - y.mean) < 1e-9 and abs(x.scale - y.scale) < 1e-9


def test_numeric_typed_category(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.5,), (None,)], "c double")
    spec = FeatureSpec.from_columns({"c": ["category", 1, "unknown", "one-hot", None]})
    model = FeaturePrep(spec).fit(df)
    assert model.feature_names == ["c_1", "c_2", "c_2.5", "c_unknown", "c_missing"]
    rows = model.transform(df).collect()
    assert [r["c_1"] for r in rows] == [1.0, 0.0, 0.0, 0.0]


def test_approximate_median_option(spark):
    df = spark.range(1, 1002).select(F.col("id").cast("double").alias("v"))
    spec = FeatureSpec.from_columns({"v": ["float", 1, "median", None, None]})
    exact = FeaturePrep(spec).fit(df).numeric[0].fill
    approx = FeaturePrep(spec, median_relative_error=0.01).fit(df).numeric[0].fill
    assert exact == 501.0 and abs(approx - 501.0) <= 0.01 * 1001 + 1


def test_sparse_one_hot_for_large_vocabulary(spark, tmp_path):
    from pyspark.ml.functions import vector_to_array
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet").select(
        "p_partkey", F.concat(F.lit("n"), (F.col("p_partkey") % 150).cast("string")).alias("c"))
    spec = FeatureSpec.from_columns({"c": ["category", 1, "unknown", "one-hot", None]})
    model = FeaturePrep(spec, passthrough=["p_partkey"], encoding="vector").fit(part)
    st = model.categorical[0]
    assert st.sparse and len(st.vocab) == 150
    assert model.output_columns == ["c_onehot", "c_missing"]
    assert model.feature_names[:2] == [f"c_{st.vocab[0]}", f"c_{st.vocab[1]}"] and len(model.feature_names) == 151
    new = spark.createDataFrame([(1, st.vocab[7]), (2, "unseen")], "p_partkey long, c string")
    rows = model.transform(new, assemble=True).select("p_partkey", vector_to_array("features").alias("f")).collect()
    f = {r["p_partkey"]: r["f"] for r in rows}
    assert len(f[1]) == 151 and f[1][7] == 1.0 and sum(f[1][:150]) == 1.0
    assert sum(f[2][:150]) == 0.0                               # unseen -> all zeros
    model.save(spark, str(tmp_path / "p"))
    copy = FeaturePrepModel.load(spark, str(tmp_path / "p"))
    assert copy.categorical[0].sparse and copy.feature_names == model.feature_names


def test_empty_table(spark, f3):
    empty = f3.limit(0)
    with pytest.warns(UserWarning):
        model = FeaturePrep(F3_SPEC).fit(empty)
    assert model.transform(empty).count() == 0
    out = model.transform(f3).collect()                 # a fitted-on-nothing model still transforms
    assert len(out) == 5 and all(v is not None for r in out for v in r)


def test_jobs_of_medians_do_not_grow_with_the_columns(spark):
    """Brackets narrowed to 20 values: the same jobs for one column and for nine."""
    from tabforge.operators.ranking import exact_medians
    r = np.random.default_rng(4)
    x = r.normal(size=(20_000, 9)) ** 3
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{i}" for i in range(9)])).repartition(4).cache()
    df.count()

    def run(cols, group):
        spark.sparkContext.setJobGroup(group, group)
        got = exact_medians(df, cols, bracket_rows=20)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert got == {c: float(np.median(x[:, int(c[1:])])) for c in cols}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    one, nine = run(["c0"], "median-one"), run([f"c{i}" for i in range(9)], "median-nine")
    assert nine <= one + 2


def test_medians_with_ties_gaps_and_missed_brackets(spark, monkeypatch):
    from tabforge.operators import ranking
    columns = {"same": [7.0] * 4001, "two": [1.0] * 2000 + [2.0] * 2000, "gap": [0.0] * 1999 + [1e300] * 2000,
               "wide": [(-1.0) ** i * 2.0 ** (i % 900) for i in range(4000)], "none": [], "one": [3.5]}
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(4001)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(3)
    want = {c: float(np.median(v)) if v else None for c, v in columns.items()}
    for most in (1, 50, 10_000):
        assert ranking.exact_medians(df, list(columns), bracket_rows=most) == want
    # a sketch that is wrong everywhere: brackets are opened again
    wrong = {c: (len(v), [1e9, 2e9] if v else None) for c, v in columns.items()}
    for most in (1, 50, 10_000):
        assert ranking.exact_medians_from_sketches(df, wrong, bracket_rows=most) == want
