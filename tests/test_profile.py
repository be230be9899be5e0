import numpy as np
import pytest

from strata.operators import profile
from strata.operators.contracts import Rule, contract_check, leak_audit, missing_columns


def by(df, key="column"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_null_and_nan_are_told_apart(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, None)], "x double, s string")
    got = by(profile.null_profile(df))
    assert (got["x"]["n_null"], got["x"]["n_nan"]) == (1, 1)
    assert (got["s"]["n_null"], got["s"]["n_nan"]) == (2, 0)
    assert profile.missing_pct(df).first()[0] == pytest.approx(50.0)
    assert [r["column"] for r in profile.top_missing(df, 1).collect()] == ["s"]


def test_wide_tables_take_several_passes(spark, monkeypatch):
    monkeypatch.setattr(profile, "EXPRESSIONS_PER_PASS", 3)
    df = spark.range(10).selectExpr(*[f"id + {i} as c{i}" for i in range(8)])
    assert len(by(profile.null_profile(df))) == 8
    pairs = profile.correlation(df, df.columns[:4]).collect()
    assert len(pairs) == 16 and all(r["r"] == pytest.approx(1.0) for r in pairs)


def test_constant_column(spark):
    df = spark.createDataFrame([(3.0, float(i)) for i in range(5)], "c double, x double")
    got = by(profile.iqr_outliers(df, ["c"]))["c"]
    assert (got["q1"], got["q3"], got["n_outliers"]) == (3.0, 3.0, 0)
    r = {(x["a"], x["b"]): x["r"] for x in profile.correlation(df, ["c", "x"]).collect()}
    assert r[("c", "x")] is None and r[("x", "x")] == pytest.approx(1.0)
    assert [r["n"] for r in profile.histogram(df, "c", 2).orderBy("bin").collect()] == [5, 0]


def test_numeric_summary(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (7.0,), (None,)], "x double")
    got = by(profile.numeric_summary(df))["x"]
    assert (got["n_distinct"], got["min"], got["median"], got["mean"], got["max"]) == (3, 1.0, 2.0, 3.0, 7.0)
    assert got["stddev"] == pytest.approx(2.7080128)
    rough = by(profile.numeric_summary(df, accuracy=100, exact_distinct=False))["x"]
    assert rough["n_distinct"] == 3


def test_empty_frame(spark):
    df = spark.createDataFrame([], "x double, s string")
    assert by(profile.null_profile(df))["x"]["n_null"] == 0
    assert by(profile.numeric_summary(df))["x"]["median"] is None
    assert profile.frequency(df, "s").count() == 0
    assert profile.pct_of_total(df, "s").count() == 0


def test_density_integrates_to_one(spark):
    df = spark.range(1000).selectExpr("cast(id % 100 as double) as x")
    rows = sorted((r["x"], r["density"]) for r in profile.density(df, "x", points=101).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(rows, rows[1:]))
    assert 0.85 < area < 1.0


def test_auto_bins(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as x")
    # Sturges: 999 / (log2(1000) + 1) = 91.1; Freedman-Diaconis: 2 * 499.5 / 10 = 99.9
    assert profile.auto_bins(df, "x") == 11


def test_correlation_drops_null_pairwise(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None), (None, 9.0), (5.0, 9.0)], "a double, b double")
    r = {(x["a"], x["b"]): x["r"] for x in profile.correlation(df).collect()}
    want = np.corrcoef([1.0, 2.0, 5.0], [2.0, 4.1, 9.0])[0, 1]
    assert r[("a", "b")] == r[("b", "a")] == pytest.approx(want)


def test_contract_rules(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "z", -1.0), (None, None, 200.0)], "k int, s string, x double")
    rules = [
        Rule("k", "not_null"),
        Rule("k", "unique"),
        Rule("s", "in_set", ("a", "b")),
        Rule("x", "range", (0, 100)),
        Rule("x", "type", ("double",)),
        Rule("s", "type", ("int",)),
    ]
    got = {r["rule"]: r["violations"] for r in contract_check(df, rules).collect()}
    assert got == {"k:not_null": 1, "k:unique": 1, "s:in_set": 1, "x:range": 2, "x:type": 0, "s:type": 3}
    assert missing_columns(df, ["k", "nope"]) == ["nope"]
    with pytest.raises(ValueError):
        contract_check(df, [Rule("k", "odd")])


def test_leak_audit_finds_the_label_source(spark):
    rows = [("F", "x", 1), ("F", "y", 1), ("O", "x", 0), ("O", "y", 0)]
    df = spark.createDataFrame(rows, "status string, grade string, label int")
    got = by(leak_audit(df, "label", ["status", "grade"]))
    assert (got["status"]["purity"], got["status"]["pct_determined"]) == (1.0, 100.0)
    assert (got["grade"]["purity"], got["grade"]["pct_determined"]) == (0.5, 0.0)
