"""Mergeable profiles, exact row budgets, and one-hot slots of any width."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import features, profile, sampling, sketches
from strata.runtime import scratch_path


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(6)
    values = np.concatenate([rng.normal(1e6, 2, 6000), rng.integers(0, 50, 3000)])
    rows = [(int(i % 7), float(v), int(v) % 900) for i, v in enumerate(values)]
    rows += [(7, None, None), (7, None, None), (8, math.nan, 3), (None, 5.0, 4)]
    return spark.createDataFrame(rows, "day int, x double, k int").repartition(6)


def test_merged_states_equal_the_whole(spark, parts):
    path = scratch_path(spark, "states")
    sketches.states(parts, ["x", "k"], "day").write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2 * 10
    whole = {r["column"]: r for r in sketches.summary(sketches.merged(stored)).collect()}
    exact = {r["column"]: r for r in profile.numeric_summary(parts, ["x", "k"]).collect()}
    values = sorted(r["x"] for r in parts.collect() if r["x"] is not None and not math.isnan(r["x"]))
    for c in ("x", "k"):
        got, want = whole[c], exact[c]
        assert (got["low"], got["high"], got["n_rows"]) == (want["min"], want["max"], 9004)
        assert got["mean"] == pytest.approx(want["mean"], rel=1e-12) and got["stddev"] == pytest.approx(want["stddev"], rel=1e-9)
        assert abs(got["n_distinct"] - want["n_distinct"]) <= 0.05 * want["n_distinct"]
    assert (whole["x"]["n_null"], whole["x"]["n_nan"], whole["k"]["n_null"]) == (2, 1, 2)
    for q in (25, 50, 75):
        below = np.searchsorted(values, whole["x"][f"q{q}"], "right") / len(values)
        assert abs(below - q / 100) < 0.03
    # in two steps, or at once: the exact parts agree
    half = sketches.merged(stored.filter("part < '3'")).withColumn("part", F.lit("a"))
    rest = sketches.merged(stored.filter("part >= '3' OR part IS NULL")).withColumn("part", F.lit("b"))
    again = {r["column"]: r for r in sketches.summary(sketches.merged(half.unionByName(rest))).collect()}
    assert again["x"]["mean"] == pytest.approx(whole["x"]["mean"]) and again["x"]["n_rows"] == 9004


def test_states_of_nothing(spark, parts):
    assert sketches.merged(sketches.states(parts.limit(0), ["x"], "day")).collect() == []
    none = sketches.summary(sketches.merged(sketches.states(parts.filter("day = 7"), ["x"]))).first()
    assert (none["n_rows"], none["n_null"], none["mean"], none["n_distinct"], none["q50"]) == (2, 2, None, 0, None)


@pytest.mark.parametrize("wanted", [0, 1, 250, 999, 1000, 5000])
def test_budget_is_met_exactly(spark, monkeypatch, wanted):
    monkeypatch.setattr(sampling, "DIRECT_ROWS", 3)
    df = spark.range(1000).withColumn("v", F.col("id") % 3)
    got = sampling.exact_rows(df, wanted, 5, "id")
    ids = [r["id"] for r in got.collect()]
    assert len(ids) == len(set(ids)) == min(wanted, 1000) and got.columns == df.columns
    same = [r["id"] for r in sampling.exact_rows(df.repartition(9), wanted, 5, "id").collect()]
    assert sorted(same) == sorted(ids)
    more = {r["id"] for r in sampling.exact_rows(df, wanted + 40, 5, "id").collect()}
    assert set(ids) <= more


def test_budget_among_rows_of_one_key(spark, monkeypatch):
    monkeypatch.setattr(sampling, "DIRECT_ROWS", 10)
    df = spark.range(600).select(F.lit(7).alias("k"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"))
    assert sampling.exact_rows(df, 123, 1, "k").count() == 123
    assert sampling.exact_rows(df.limit(0), 5, 1, "k").count() == 0
    assert sampling.exact_rows(spark.createDataFrame([(None,)] * 9, "k int"), 4, 1, "k").count() == 4


def test_slots_of_any_width(spark):
    rows = [(i, f"v{i % 5}" if i % 11 else None, f"w{i}", float(i % 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a string, b string, x double")
    slots, width = features.one_hot_slots(df, ["x"], ["a", "b"])
    assert width == 1 + (5 + 1) + (200 + 1)
    got = {r["id"]: {s["slot"]: s["value"] for s in r["slots"]} for r in slots.collect()}
    full = features.complete_features(df, ["x"], [])
    for r in full.collect():
        mine = got[r["id"]]
        assert mine.get(0, 0.0) == r["x"] and sum(1 for s in mine if 1 <= s < 7) == 1 and sum(1 for s in mine if s >= 7) == 1
        assert (6 in mine) == (r["a"] is None)
    assert len({s for m in got.values() for s in m if s >= 7}) == 200
    assert "ArrowEvalPython" not in slots._jdf.queryExecution().toString()
