"""Groups and columns that outgrow a first cut: finer buckets, labels as tables, honest sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata import runtime
from strata.functions import row_hash
from strata.operators import features, sampling
from strata.operators.prefix import row_numbers


def test_row_numbers_follow_the_order_over_ranges(spark):
    rows = spark.range(2_000).select((F.col("id") * 7919 % 2_003).alias("v"))
    got = sorted(row_numbers(rows, ["v"]).collect())
    assert [r["rank"] for r in got] == list(range(2_000))


def test_index_of_labels_counts_ties_and_nulls(spark, monkeypatch):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None, None, None]], "v string")
    want = {"c": 0.0, "a": 1.0, "b": 2.0, None: 3.0}
    assert {r["v"]: r["v_idx"] for r in features.index_strings(df, "v").collect()} == want
    monkeypatch.setattr(runtime, "fits_broadcast", lambda *a, **k: False)
    got = features.index_strings(df, "v").collect()
    assert {r["v"]: r["v_idx"] for r in got} == want and len(got) == 7


def test_index_of_an_empty_table(spark):
    assert features.index_strings(spark.createDataFrame([], "v string"), "v").collect() == []


def test_a_dominant_stratum_is_cut_into_finer_buckets(spark, monkeypatch):
    df = spark.range(6_000).select("id", F.when(F.col("id") < 5_900, "hot").otherwise("cold").alias("s"))
    plain = sorted(sampling.stratified_kfolds(df, "s", 5, 3, "id").collect())
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 1)
    monkeypatch.setattr(sampling, "BUCKET_ROWS", 20)
    assert sorted(sampling.stratified_kfolds(df, "s", 5, 3, "id").collect()) == plain
    assert [r["count"] for r in df.join(spark.createDataFrame(plain), ["id", "s"]).filter("s = 'hot'").groupBy("fold").count().collect()] == [1180] * 5


def test_null_keeps_its_place_in_a_key(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert len({r[0] for r in df.select(row_hash(["x", "y"], 1)).collect()}) == 2


def test_nested_columns_count_towards_a_broadcast(spark):
    df = spark.range(10).select(F.struct(F.repeat(F.lit("x"), 1_000).alias("t")).alias("s"))
    assert not runtime.fits_broadcast(df, max_bytes=5_000)
