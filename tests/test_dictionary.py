"""Distributed category dictionary: positions, encoding, persistence, skew."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.operators import dictionary as D
from tabforge.operators.prepare import FeaturePrep, FeaturePrepModel
from tabforge.spec import FeatureSpec

SPEC = FeatureSpec.from_columns({"kind": ["category", 1, "most_frequent", "one-hot", "f"],
                                 "odd`name": ["category", 1, "unknown", "one-hot", "f"],
                                 "x": ["float", 1, "mean", None, "f"]})


@pytest.fixture(scope="module")
def rows(spark):
    """A hot value on two thirds of the rows, nulls, odd values, repeated rows."""
    values = ["hot"] * 200 + [f"v{i}" for i in range(60)] + [None] * 30 + ["", "a|b", "é", "Hot"]
    data = [(i, v, ["p", None, "unknown", "q r"][i % 4], float(i)) for i, v in enumerate(values)]
    return spark.createDataFrame(data + data[:3], "id long, kind string, `odd``name` string, x double").repartition(5)


def test_positions_are_dense_and_the_fill_is_a_category(rows):
    words = D.fit_dictionary(rows, {"kind": F.col("kind"), "o": F.col("`odd``name`")}, {"kind"})
    got = {f: {} for f in ("kind", "o")}
    for r in words.table.collect():
        got[r["feature"]][r["category"]] = r["pos"]
    assert set(got["kind"]) == {"hot", "", "a|b", "é", "Hot"} | {f"v{i}" for i in range(60)}
    assert set(got["o"]) == {"p", "unknown", "q r"} and words.fills == {"kind": "hot", "o": "unknown"}
    for f, places in got.items():
        assert sorted(places.values()) == list(range(len(places))) and words.sizes[f] == len(places)
    assert words.nulls["kind"] == 30


@pytest.mark.parametrize("share", [1, 8, 10_000])
def test_encoding_equals_the_vocabulary_one(spark, rows, monkeypatch, share):
    """However many values are hot, vectors hold a one at their value's place;
    unseen values have none."""
    monkeypatch.setattr(D, "HOT_SHARE", share)
    prep = FeaturePrep(SPEC, passthrough=["id"], encoding="dictionary").fit(rows)
    new = rows.unionByName(spark.createDataFrame([(900, "never seen", "p", 1.0)], rows.schema))
    out = prep.transform(new, assemble=True)
    place = {(r["feature"], r["category"]): r["pos"] for r in prep.vocabulary_frame(spark).collect()}
    columns = prep.output_columns
    got = sorted((r["id"], r["k"], r["o"], r["x"]) for r in out.select(
        "id", vector_to_array("kind_onehot").alias("k"), vector_to_array(F.col("`odd``name_onehot`")).alias("o"), "x").collect())
    want = []
    plain = FeaturePrep(SPEC, passthrough=["id"]).fit(rows)
    scaled = {r["id"]: r["x"] for r in plain.transform(new).select("id", "x").collect()}
    for r in new.collect():
        k, o = [[0.0] * prep.words.sizes[f] for f in ("kind", "odd`name")]
        if r["kind"] != "never seen":
            k[place["kind", r["kind"] or ("hot" if r["kind"] is None else r["kind"])]] = 1.0
        o[place["odd`name", r["odd`name"] or "unknown"]] = 1.0
        want.append((r["id"], k, o, scaled[r["id"]]))
    assert got == sorted(want)
    v = out.select("features").first()[0]
    assert v.size == prep.slots == len(prep.feature_names) and len(columns) == 6


def test_saved_and_reloaded(spark, rows, tmp_path):
    prep = FeaturePrep(SPEC, passthrough=["id"], encoding="dictionary").fit(rows)
    again = FeaturePrepModel.load(spark, prep.save(spark, str(tmp_path / "prep")))
    a, b = [sorted(map(str, p.transform(rows, assemble=True).collect())) for p in (prep, again)]
    assert a == b and again.feature_names == prep.feature_names


def test_plan_does_not_grow_with_categories(spark):
    def size(n):
        df = spark.range(n).select(F.col("id"), F.concat(F.lit("c"), "id").alias("kind"))
        spec = FeatureSpec.from_columns({"kind": ["category", 1, "unknown", "one-hot", "f"]})
        prep = FeaturePrep(spec, passthrough=["id"], encoding="dictionary", max_categories=10).fit(df)
        out = prep.transform(df, assemble=True)
        assert out.select("features").first()[0].size == n + 1
        return len(out._jdf.queryExecution().optimizedPlan().toString())

    assert abs(size(3000) - size(30)) < 400


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "id long, kind string, `odd``name` string, x double")
    with pytest.warns(UserWarning):
        prep = FeaturePrep(SPEC, passthrough=["id"], encoding="dictionary").fit(empty)
    assert prep.words.sizes == {"kind": 0, "odd`name": 0} and prep.transform(empty, assemble=True).count() == 0
    nulls = spark.createDataFrame([(1, None, None, 1.0), (2, None, None, 2.0)], empty.schema)
    prep = FeaturePrep(SPEC, passthrough=["id"], encoding="dictionary").fit(nulls)
    assert prep.words.fills == {"kind": "unknown", "odd`name": "unknown"}
    assert [r["v"] for r in prep.transform(nulls).select(vector_to_array("kind_onehot").alias("v")).collect()] == [[1.0], [1.0]]
