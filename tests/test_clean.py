import pytest
from pyspark.sql import functions as F

from strata import runtime
from strata.operators import clean, derive


def test_winsorize_clips_a_hundred_rows_at_each_end(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    out = clean.winsorize(df, "x")
    low, high = out.agg(F.min("x"), F.max("x")).first()
    assert (low, high) == pytest.approx((99.99, 9899.01))
    assert out.filter(F.col("x") == low).count() == 100 and out.filter(F.col("x") == high).count() == 100


def test_winsorize_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (5.0,)], "x double")
    assert clean.winsorize(df, "x").filter("x is null").count() == 1


def test_impute_median(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    rows = clean.impute_median(df, ["a", "b"]).collect()
    assert sorted(r["a"] for r in rows) == [1.0, 2.0, 3.0]
    assert all(r["b"] is None for r in rows)
    reused = clean.impute_median(df, "a", medians={"a": 9.0}).collect()
    assert sorted(r["a"] for r in reused) == [1.0, 3.0, 9.0]


def test_fill_constant_rejects_the_wrong_kind_and_does_not_truncate(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "i int, s string")
    with pytest.raises(TypeError):
        clean.fill_constant(df, "missing", "i")
    with pytest.raises(TypeError):
        clean.fill_constant(df, 0.0, "s")
    assert sorted(r["i"] for r in clean.fill_constant(df, 2.7, "i").collect()) == [1.0, 2.7]


def test_fill_constant_fills_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert sorted(r["x"] for r in clean.fill_constant(df, 0.0, "x").collect()) == [0.0, 0.0, 1.0]


def test_top_k_tie_goes_to_the_smaller_value_and_null_takes_no_place(spark):
    df = spark.createDataFrame([(v,) for v in ["a", "a", "b", "b", "c", None, None, None]], "v string")
    got = sorted(r["v"] for r in clean.top_k_categories(df, "v", k=1).collect())
    assert got == ["a", "a"] + ["other"] * 6


def test_top_k_without_broadcast_is_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(str(i % 7), i) for i in range(100)], "v string, id int")
    plain = sorted(clean.top_k_categories(df, "v", k=3).collect())
    monkeypatch.setattr(runtime, "fits_broadcast", lambda *a, **k: False)
    assert sorted(clean.top_k_categories(df, "v", k=3).collect()) == plain


def test_sentinel_and_drop_nulls(spark):
    df = spark.createDataFrame([(999, 1.0), (5, float("nan")), (6, 2.0)], "dti int, x double")
    out = clean.sentinel_to_null(df, {"dti": 999})
    assert out.filter("dti is null").count() == 1
    assert clean.drop_nulls(out, ["dti", "x"]).count() == 1


def test_ratio_with_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(10.0, -1.0), (10.0, 1.0)], "a double, b double")
    assert [r["r"] for r in derive.ratio(df, "a", "b", "r").collect()] == [None, 5.0]


def test_feature_columns_keep_the_label_sources_out(spark):
    df = spark.createDataFrame([(1, "x", 1.0, "F", 1)], "id int, grade string, amt double, loan_status string, y int")
    assert derive.feature_columns(df, "y", ["id", "loan_status"]) == (["amt"], ["grade"])
