"""NaN, infinity and wide integers: missing is missing, and nothing is rounded together."""

import math

import pytest

from strata.operators import clean, contracts, drift, evaluate, features, profile, sampling
from strata.operators.quantiles import quantile_map


@pytest.fixture
def numbers(spark):
    rows = [(float(i),) for i in range(100)] + [(math.nan,), (None,), (math.nan,)]
    return spark.createDataFrame(rows, "x double")


def test_infinity_in_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (math.inf,)], "x double")
    assert quantile_map(df, ["x"], [0.5, 1.0])["x"] == [2.0, math.inf]


def test_nan_is_missing(numbers):
    filled = clean.impute_median(numbers, "x")
    assert filled.filter("x = 49.5").count() == 3
    kept = clean.winsorize(numbers, "x", 0.1, 0.9)
    assert kept.filter("isnan(x)").count() == 2 and kept.filter("NOT isnan(x)").agg({"x": "max"}).first()[0] == pytest.approx(89.1)
    row = profile.numeric_summary(numbers, ["x"]).first()
    assert (row["n_distinct"], row["max"], row["mean"]) == (100, 99.0, 49.5)
    assert profile.iqr_outliers(numbers, ["x"]).first()["n_outliers"] == 0
    assert profile.tail_outliers(numbers, ["x"], 0.1, 0.9).first()["n_outliers"] == 20


def test_wide_integers_are_told_apart(spark):
    df = spark.range(2**53, 2**53 + 10).selectExpr("id AS k")
    assert profile.numeric_summary(df, ["k"]).first()["n_distinct"] == 10


def test_nan_score_is_dropped(spark):
    df = spark.createDataFrame([(1, math.nan), (1, 0.5), (0, 0.4)], "y int, s double")
    counts = evaluate.score_counts(df, "y", "s").collect()
    assert sorted((r["score"], r["pos"], r["neg"]) for r in counts) == [(0.4, 0, 1), (0.5, 1, 0)]


def test_arrays_are_never_cut(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([4.0, 5.0],)], "v array<double>")
    assert features.array_to_features(df.filter("size(v) = 3"), "v").first()["features"].size == 3
    with pytest.raises(Exception, match="not of 2 elements"):
        features.array_to_features(df, "v", 2).collect()


def test_temporal_split_keeps_all_rows(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE'1999-05-01'), (DATE'1980-01-01'), (CAST(NULL AS DATE)) AS t(d)")
    ranges = [(1995, 1998), (1999, 1999), (2000, 2000)]
    assert sorted(str(r["split"]) for r in sampling.temporal_split(df, "d", *ranges).collect()) == ["None", "None", "val"]
    assert sampling.temporal_split(df, "d", *ranges, drop_outside=True).count() == 1


def test_unique_ignores_null_keys(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    rule = contracts.Rule(column="k", kind="unique")
    assert contracts.contract_check(df, [rule]).first()["violations"] == 0
    assert contracts.contract_check(df, []).collect() == []
