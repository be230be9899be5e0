import unicodedata

import pytest
from pyspark.sql import functions as F

from strata.functions import first_int, fold_text, month_text_year, percent_to_double, row_hash, stratum_id, uniform
from strata.functions.keys import check_key


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_bad_text_is_null(spark):
    df = spark.createDataFrame([("13.5%", "Dec-2015", "10+ years"), ("n/a", "xx", ""), (None, None, None)], "p string, m string, e string")
    assert values(df, percent_to_double("p")) == [13.5, None, None]
    assert values(df, month_text_year("m")) == [2015, None, None]
    assert values(df, first_int("e")) == [10, None, None]


def test_fold_text_matches_unicode_rules(spark):
    texts = ["Café", "ÑANDÚ", "plain", "ﬁn²", "İstanbul", "Straße", "", None, "한글", "é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def expected(t):
        if t is None:
            return None
        return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower()

    assert values(df, fold_text("t")) == [expected(t) for t in texts]


def test_stratum_id_keeps_combinations_apart(spark):
    rows = [("A_B", "C"), ("A", "B_C"), ("A", None), (None, "A"), (None, None), ("", ""), ("~", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    ids = values(df, stratum_id(["a", "b"]))
    assert len(set(ids)) == len(rows) and None not in ids


def test_uniform_is_in_unit_interval_and_even(spark):
    u = spark.range(20_000).select(uniform(row_hash(["id"], 1)).alias("u"))
    row = u.agg(F.min("u").alias("lo"), F.max("u").alias("hi"), F.avg("u").alias("mean")).first()
    assert 0 <= row.lo and row.hi < 1 and abs(row["mean"] - 0.5) < 0.01


def test_key_rules(spark):
    df = spark.createDataFrame([(1.0, 1)], "x double, i int")
    with pytest.raises(TypeError):
        check_key(df, ["x"])
    with pytest.raises(ValueError):
        check_key(df, [])
    check_key(df, ["i"])
