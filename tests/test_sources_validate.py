"""Loader behaviour: CSV scan, null normalisation, target split, validation."""

import json

import pytest
from pyspark.sql import functions as F

from tabforge.operators.prepare import select_features
from tabforge.operators.validate import validate
from tabforge.sources.readers import apply_types, normalize_nulls, read_source
from tabforge.spec import FeatureSpec

F1_CSV = "id_col,target,feature_1,feature_2,feature_3\n1,0,1.5,A,True\n2,1,2.5,B,False\n" \
         "3,0,3.5,A,True\n4,1,4.5,C,False\n5,0,5.5,B,True\n"
F1_SPEC = FeatureSpec.from_columns({
    "id_col": ["category", 0, "unknown", None, "1_id"],
    "target": ["bool", 1, "unknown", None, "2_DEPENDENT"],
    "feature_1": ["float", 1, "mean", None, "3_features"],
    "feature_2": ["category", 1, "unknown", "one-hot", "3_features"],
    "feature_3": ["bool", 1, "unknown", None, "3_features"],
})


def _csv(tmp_path, text, name="data.csv"):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_csv_roundtrip_and_typing(spark, tmp_path):
    raw = read_source(spark, _csv(tmp_path, F1_CSV), "CSV")
    assert all(t == "string" for _, t in raw.dtypes)
    typed = apply_types(raw, F1_SPEC, target="target")
    d = dict(typed.dtypes)
    assert d["feature_1"] == "double" and d["feature_3"] == "boolean" and d["target"] == "double"
    rows = typed.orderBy(F.col("id_col").cast("int")).collect()
    assert [r["feature_1"] for r in rows] == [1.5, 2.5, 3.5, 4.5, 5.5]
    assert [r["feature_3"] for r in rows] == [True, False, True, False, True]


def test_unsupported_source_and_missing_path(spark, tmp_path):
    with pytest.raises(ValueError):
        read_source(spark, _csv(tmp_path, F1_CSV), "XLSX")
    with pytest.raises(ValueError):
        read_source(spark, None, "CSV")


def test_na_tokens_and_nan_become_null(spark, tmp_path):
    text = "a,b\nNA,1.0\nnan,NaN\n,2.0\nx,\n"
    raw = read_source(spark, _csv(tmp_path, text), "CSV")
    rows = raw.collect()
    assert [r["a"] for r in rows] == [None, None, None, "x"]
    typed = apply_types(raw, FeatureSpec.from_columns({"b": ["float", 1, "mean", None, None]}))
    assert [r["b"] for r in typed.collect()] == [1.0, None, 2.0, None]
    df = spark.createDataFrame([(float("nan"), "NULL")], "x double, s string")
    r = normalize_nulls(df).collect()[0]
    assert r["x"] is None and r["s"] is None


def test_target_split(spark, tmp_path):
    raw = apply_types(read_source(spark, _csv(tmp_path, F1_CSV), "CSV"), F1_SPEC, target="target")
    x = select_features(raw, F1_SPEC, "target", training=True)
    assert x.columns == ["feature_1", "feature_2", "feature_3", "target"]
    with pytest.raises(ValueError):
        select_features(raw.drop("target"), F1_SPEC, "target", training=True)
    # scoring: a missing target stays missing
    assert "target" not in select_features(raw.drop("target"), F1_SPEC, "target", training=False).columns


def test_valid_data_passes(spark, tmp_path):
    raw = read_source(spark, _csv(tmp_path, F1_CSV), "CSV")
    res = validate(raw, F1_SPEC, "target", training=True)
    assert res.passed and not res.errors and not res.warnings


def test_missing_target_fails(spark, tmp_path):
    text = "id_col,feature_1,feature_2,feature_3\n1,1.5,A,True\n"
    raw = read_source(spark, _csv(tmp_path, text), "CSV")
    res = validate(raw, F1_SPEC, "target", training=True)
    assert not res.passed
    assert any("target" in e for e in res.errors)
    with pytest.raises(ValueError):
        res.raise_if_failed()
    # scoring mode: the target need not be there (metadata marks it use=1)
    assert validate(raw, F1_SPEC, "target", training=False).passed


def test_row_level_checks(spark, tmp_path):
    text = "id_col,target,feature_1,feature_2,feature_3\n1,,abc,A,2\n2,1,2.5,B,yes\n3,0,1,C,0\n"
    raw = read_source(spark, _csv(tmp_path, text), "CSV")
    res = validate(raw, F1_SPEC, "target", training=True)
    checks = {(r[1], r[2]): r[3] for r in res.rows}
    assert checks[("target", "target_nulls")] == 1
    assert checks[("feature_1", "not_numeric")] == 1
    assert checks[("feature_3", "not_boolean")] == 2
    assert not res.passed and len(res.warnings) == 2


def test_rows_of_another_width_fail(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("id,v\n1,2,3\n4,5\n")
    with pytest.raises(Exception):
        read_source(spark, str(tmp_path / "wide.csv"), "CSV").select("id").collect()


def test_quotes_and_line_breaks(spark, tmp_path):
    pd = pytest.importorskip("pandas")
    frame = pd.DataFrame({"a": ['say "hi"', "x, y", "two\nlines", "plain"], "b": ["1", "2", "3", "4"]})
    frame.to_csv(tmp_path / "q.csv", index=False)
    got = read_source(spark, str(tmp_path / "q.csv"), "CSV", multi_line=True).collect()
    assert [(r.a, r.b) for r in got] == list(frame.itertuples(index=False, name=None))
