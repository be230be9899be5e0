import pytest
from pyspark.sql import functions as F

from strata import runtime
from strata.operators import balance, joins


def weights(spark, labels):
    df = spark.createDataFrame([(v,) for v in labels], "label string")
    return {r["label"]: r["weight"] for r in balance.class_weights(df, "label").collect()}


def test_class_weights(spark):
    assert weights(spark, ["0", "0", "0", "1"]) == pytest.approx({"0": 4 / 6, "1": 2.0})
    assert weights(spark, ["a", "a", "b", "c"]) == pytest.approx({"a": 4 / 6, "b": 4 / 3, "c": 4 / 3})
    assert weights(spark, ["0", "0"]) == {"0": 1.0}
    assert weights(spark, ["0", "1", None]) == {"0": 1.0, "1": 1.0}


def test_weight_column_and_null_label(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "label int")
    rows = balance.add_class_weight(df, "label").collect()
    assert {r["label"]: r["weight"] for r in rows} == pytest.approx({0: 4 / 6, 1: 2.0, None: None})
    assert len(rows) == 5


def test_attach_beyond_the_broadcast_bound(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 7 != 0, F.col("id")).alias("k"), "id"
    )
    lookup = df.filter("k is not null").groupBy("k").agg(F.count("*").alias("n")).withColumn("twice", F.col("k") * 2)
    small = sorted(runtime.attach(df, lookup, "k", "n").select("id", "twice").collect())
    large = sorted(runtime.attach(df, lookup, "k", "n", max_rows=1).select("id", "twice").collect())
    assert small == large and len(small) == 5000


def test_fits_broadcast_measures_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "s string")
    assert runtime.fits_broadcast(df) and not runtime.fits_broadcast(df, max_bytes=5000)
    assert not runtime.fits_broadcast(df, max_rows=9)


def test_remainder_treats_null_as_equal(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (3, "c"), (None, None)], "k int, v string")
    part = df.filter("k = 2 or k is null")
    assert sorted(r["k"] for r in joins.remainder(df, part).collect()) == [1, 3, 3]
    assert sorted(r["k"] for r in joins.remainder(df, part, "k").collect()) == [1, 3, 3]


def test_row_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(r["k"] for r in joins.row_difference(a, b).collect()) == [1, 2]


def test_union_and_distinct(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2,), (2,)], "k int")
    both = joins.union_by_name(a, b)
    assert both.count() == 3 and both.filter("v is null").count() == 2
    assert joins.distinct_rows(both).count() == 2 and joins.distinct_rows(both, "k").count() == 2
