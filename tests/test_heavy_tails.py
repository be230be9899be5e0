"""Missing, infinite and far values in histograms, densities, curves and drift."""

import math

import numpy as np
import pytest

from strata.operators import drift, evaluate, features, profile, sparse_bins


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3)


def test_one_far_value_costs_one_bin(spark):
    df = column(spark, [float(i) for i in range(1000)] + [1e12])
    rows = sparse_bins.histogram(df, "x").collect()
    assert len(rows) <= 1001 and sum(r["n"] for r in rows) == 1001
    last = max(rows, key=lambda r: r["bin"])
    assert last["n"] == 1 and last["high"] == pytest.approx(1e12)
    auto = profile.histogram(df, "x", "auto").collect()
    assert sorted(map(tuple, auto)) == sorted(map(tuple, rows))  # too many bins for a grid: occupied ones only


def test_missing_and_infinite_values(spark):
    df = column(spark, [1.0, 2.0, 2.5, 4.0, math.nan, None, math.inf, math.inf, -math.inf])
    for rows in (sparse_bins.histogram(df, "x", 3).collect(), profile.histogram(df, "x", 3).collect()):
        assert {r["bin"]: r["n"] for r in rows if r["bin"] is not None} == {0: 1, 1: 2, 2: 1}
        assert {(r["low"], r["high"]): r["n"] for r in rows if r["bin"] is None} == {(math.inf, math.inf): 2, (-math.inf, -math.inf): 1}
    assert profile.histogram(column(spark, [1.0, math.nan]), "x", 4).filter("n > 0").count() == 1


def test_empty_and_constant_columns(spark):
    assert sparse_bins.histogram(column(spark, [None, math.nan]), "x").collect() == []
    assert [tuple(r) for r in sparse_bins.histogram(column(spark, [5.0] * 9), "x").collect()] == [(0, 5.0, 5.0, 9)]
    assert sparse_bins.density(column(spark, [5.0] * 9), "x").collect() == []
    assert profile.histogram(column(spark, [None]), "x", "auto").collect() in ([], profile.histogram(column(spark, [None]), "x", 1).collect())


def test_density_equals_the_kernel_sum(spark):
    data = np.concatenate([np.random.default_rng(4).normal(10, 2, 3000), [1e6]])
    df = column(spark, [*data.tolist(), math.nan, math.inf, None])
    rows = sparse_bins.density(df, "x", cells=64).collect()
    h = sparse_bins.Spread.of(df, "x").bandwidth()
    for r in rows[:: max(1, len(rows) // 40)]:
        exact = np.exp(-0.5 * ((r["x"] - data) / h) ** 2).sum() / (len(data) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(exact, rel=2e-2, abs=1e-5)
    assert len(rows) < 17 * 3001 and sum(r["density"] for r in rows) * h / 2 == pytest.approx(1, abs=1e-3)
    even = profile.density(column(spark, [*data[:-1].tolist(), math.nan]), "x").collect()
    assert all(math.isfinite(r["density"]) for r in even)


def test_curves_and_areas_see_the_same_rows(spark):
    df = spark.createDataFrame([(1, math.nan), (1, 0.5), (0, 0.4), (None, 0.9), (0, None)], "label int, score double")
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df, "label", "score").collect()}
    assert roc[0.5] == (0.0, 1.0) and roc[0.4] == (1.0, 1.0)
    recall = {r["threshold"]: r["recall"] for r in evaluate.pr_curve(df, "label", "score").collect()}
    assert recall[0.5] == 1.0
    assert evaluate.roc_auc(df, "label", "score").first()["auc"] == 1.0


def test_drift_takes_nan_for_missing(spark):
    a, b = column(spark, [1.0, math.nan]), column(spark, [1.0, 1.0])
    assert drift.ks(a, b, "x").first()["ks"] == 0.0


def test_scaling_and_summary_without_nan(spark):
    df = column(spark, [1.0, 3.0, math.nan, None])
    out = sorted((str(r["x_std"]) for r in features.standardize(df, ["x"]).collect()))
    sd = math.sqrt(2.0)
    assert out == sorted([str(1 / sd), str(3 / sd), "None", "None"])
    assert [tuple(r) for r in profile.scalar_summary(df, ["x"]).collect()] == [("x", 2.0, 1.0, 3.0)]
