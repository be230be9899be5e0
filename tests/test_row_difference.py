"""Rows compared by fingerprint: against Python's counters, with one row that makes up most of the table."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import joins

NAN = float("nan")


def rows_of(df):
    return Counter(repr(tuple(r)).replace("-0.0", "0.0") for r in df.collect())


def odd_rows(spark):
    a = [(1, "a", 1.0), (1, "a", 1.0), (None, "a", 1.0), (2, None, 1.0), (2, None, None), (2, None, None)]
    a += [(3, "", NAN), (3, "", NAN), (4, "x", 0.0), (4, "x", -0.0), (None, None, None), (None, "", None)]
    b = [(1, "a", 1.0), (2, None, None), (2, None, None), (2, None, None), (3, "", NAN), (4, "x", -0.0), (None, None, None), (9, "z", 9.0)]
    schema = "k int, s string, v double"
    return spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)


@pytest.mark.parametrize("chunk", [1, 2, 100])
def test_row_difference_equals_counters(spark, chunk):
    a, b = odd_rows(spark)
    got = joins.row_difference(a, b, chunk_rows=chunk)
    assert got.schema.names == a.schema.names
    assert rows_of(got) == rows_of(a) - rows_of(b)
    assert rows_of(got) == rows_of(a.exceptAll(b))
    assert rows_of(joins.row_difference(a, a)) == Counter()
    assert rows_of(joins.row_difference(a, b.limit(0))) == rows_of(a)
    assert joins.row_difference(a.limit(0), b).count() == 0


def test_remainder_on_all_columns(spark):
    a, b = odd_rows(spark)
    gone = rows_of(b)
    assert rows_of(joins.remainder(a, b)) == Counter({r: n for r, n in rows_of(a).items() if r not in gone})


def test_types_are_widened_and_places_of_null_told_apart(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, k bigint")
    assert [r["k"] for r in joins.row_difference(a, b).collect()] == [2]
    assert [r["k"] for r in joins.remainder(a, b, "k").collect()] == [2]
    c = spark.createDataFrame([(None, "x"), ("x", None)], "l string, r string")
    assert joins.row_difference(c, c.limit(0).unionAll(spark.createDataFrame([("x", None)], "l string, r string"))).collect() == [(None, "x")]
    prints = c.select(*joins.fingerprint([F.col("l"), F.col("r")])).collect()
    assert prints[0] != prints[1]


def test_a_row_that_makes_up_most_of_the_table(spark):
    hot = spark.range(90_000).select(F.lit(7).alias("k"), F.lit("same").alias("s"))
    df = hot.unionAll(spark.range(5_000).select(F.col("id").cast("int"), F.lit("own")))
    out = joins.row_difference(df, hot.limit(10_000), chunk_rows=1_000)
    held = out.filter("s = 'same'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 80_000 and out.count() == 85_000
    # 80 chunks dealt over 8 tasks: none has half of the copies
    assert len(held) >= 4 and max(r["count"] for r in held) < 40_000
