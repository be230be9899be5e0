import random

import pytest

from strata.operators import audit
from strata.operators.evaluate import roc_auc


def test_rank_area_against_all_pairs(spark):
    rng = random.Random(4)
    rows = [(g, rng.randint(0, 1), rng.choice([0.1, 0.25, 0.5, 0.5, 0.9])) for g in "ab" for _ in range(60)]
    rows += [("one class", 1, 0.3), ("one class", 1, 0.4), ("a", None, 0.2), ("a", 1, float("nan")), ("a", 0, None)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    got = {r["g"]: r["rank_auc"] for r in audit.rank_auc(df, "label", "score", "g").collect()}
    for g in "ab":
        pos = [s for h, y, s in rows if h == g and y == 1 and s is not None and s == s]
        neg = [s for h, y, s in rows if h == g and y == 0 and s is not None and s == s]
        pairs = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
        assert got[g] == pytest.approx(pairs / (len(pos) * len(neg)))
    assert got["one class"] is None
    reported = {r["g"]: r["auc"] for r in roc_auc(df, "label", "score", "g").collect()}
    assert reported == pytest.approx(got)
    assert audit.rank_auc(df.limit(0), "label", "score", "g").collect() == []


def test_feature_roles(spark):
    rows = [(1, 0, 1.0, None, "x", None), (2, 1, float("nan"), 3, None, None)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b int, c string, d date")
    got = sorted(tuple(r) for r in audit.feature_roles(df, "y", "id").collect())
    assert got == [("a", "numeric", 1), ("b", "numeric", 1), ("c", "categorical", 1)]
    assert audit.feature_roles(df.select("id", "y"), "y", "id").collect() == []
    assert [r["n_present"] for r in audit.feature_roles(df.limit(0), "y", "id").collect()] == [0, 0, 0]
