import random

import pytest

from strata.operators.prefix import running_totals


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [1, 2, 16, 256])
def test_running_totals_equal_a_plain_loop(spark, descending, buckets):
    rnd = random.Random(3)
    rows = [(g, float(v), rnd.randint(0, 9)) for g in ("a", "b", None) for v in rnd.sample(range(-500, 500), 200)]
    df = spark.createDataFrame(rows, "g string, v double, n long").repartition(5)
    got = {
        (r["g"], r["v"]): r["cum_n"]
        for r in running_totals(df, "v", ["n"], by=["g"], descending=descending, buckets=buckets).collect()
    }
    want = {}
    for g in ("a", "b", None):
        total = 0
        for _, v, n in sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=descending):
            total += n
            want[(g, v)] = total
    assert got == want


def test_empty_input(spark):
    df = spark.createDataFrame([], "v double, n long")
    assert running_totals(df, "v", ["n"]).collect() == []
