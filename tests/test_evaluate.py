import math

import pytest

from strata.operators import drift, evaluate


def scored(spark, scores, labels):
    return spark.createDataFrame(list(zip(labels, scores)), "label int, score double")


def areas(spark, scores, labels):
    row = evaluate.ranking_metrics(scored(spark, scores, labels), "label", "score").first()
    return row["auc"], row["pr_auc"]


def test_areas(spark):
    auc, ap = areas(spark, [0.8, 0.4, 0.35, 0.1], [1, 0, 1, 0])
    assert auc == pytest.approx(0.75) and ap == pytest.approx(0.8333333333)
    assert areas(spark, [0.5] * 4, [1, 0, 1, 0]) == pytest.approx((0.5, 0.5))
    assert areas(spark, [0.1, 0.2], [1, 1]) == (None, None)


def test_curves_start_and_end(spark):
    df = scored(spark, [0.8, 0.4, 0.35, 0.1], [1, 0, 1, 0])
    roc = sorted((r["fpr"], r["tpr"], -r["threshold"]) for r in evaluate.roc_curve(df, "label", "score").collect())
    assert roc[0] == (0.0, 0.0, -math.inf) and roc[-1][:2] == (1.0, 1.0) and len(roc) == 5
    pr = evaluate.pr_curve(df, "label", "score").collect()
    assert [(r["precision"], r["recall"]) for r in pr if r["threshold"] is None] == [(1.0, 0.0)]
    assert {r["threshold"]: r["precision"] for r in pr}[0.35] == pytest.approx(2 / 3)


def test_groups_are_independent(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.1), ("b", 0, 0.9), (None, 1, 0.5), (None, 0, 0.5)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r["g"]: r["auc"] for r in evaluate.roc_auc(df, "label", "score", by="g").collect()}
    assert got == {"a": 1.0, "b": 0.0, None: 0.5}
    assert evaluate.roc_curve(df, "label", "score", by="g").count() == 3 + 2 + 2 + 1


def test_confusion_grid_has_zeros(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 2)], "label int, prediction int")
    got = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion_matrix(df).collect()}
    assert len(got) == 9 and got[(1, 0)] == 1 and got[(1, 1)] == 0


def test_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = evaluate.binary_metrics(df).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)


def test_weighted_precision(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    row = evaluate.weighted_precision(df).first()
    assert row["weighted_precision"] == pytest.approx(2 / 4 * 1.0 + 1 / 4 * (1 / 3)) and row["accuracy"] == 0.5


def test_best_runs_rank_missing_last(spark):
    runs = spark.createDataFrame([("r1", "a", None), ("r2", "a", 0.7), ("r3", "b", 0.9), ("r0", "b", 0.9)], "run_id string, model string, val_auc double")
    assert evaluate.best_run(runs).first()["run_id"] == "r0"
    assert {r["model"]: r["run_id"] for r in evaluate.best_per_model(runs).collect()} == {"a": "r2", "b": "r0"}


def test_prefix_and_comparison(spark):
    long = spark.createDataFrame([("m", "train", "auc", 0.91234567), ("m", "test", "auc", 0.8)], "model string, split string, metric string, value double")
    named = evaluate.prefixed(long)
    assert {r["metric"] for r in named.collect()} == {"train_auc", "auc"}
    row = evaluate.model_comparison(named, ["auc", "train_auc"]).first()
    assert (row["auc"], row["train_auc"]) == (0.8, 0.9123)


def test_drift_of_equal_and_shifted_frames(spark):
    base = spark.range(1000).selectExpr("cast(id as double) as x")
    moved = base.selectExpr("x + 500 as x")
    assert drift.psi(base, base, "x").first()["psi"] == pytest.approx(0.0)
    assert drift.psi(base, moved, "x").first()["psi"] > 1
    assert drift.ks(base, base, "x").first()["ks"] == pytest.approx(0.0)
    assert drift.ks(base, moved, "x").first()["ks"] == pytest.approx(0.5)


def test_wssse(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (0, [2.0, 0.0]), (1, [5.0, 5.0])], "cluster int, features array<double>")
    assert evaluate.wssse(df).first()[0] == pytest.approx(2.0)
