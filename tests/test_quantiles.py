import numpy as np
import pytest

from strata.operators import quantiles as q

PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(spark, values, partitions=4):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(partitions)


@pytest.mark.parametrize("kind", ["uniform", "heavy_ties", "long_tail", "two_rows", "one_row"])
def test_exact_equals_numpy(spark, kind):
    rng = np.random.default_rng(5)
    data = {
        "uniform": rng.random(5000),
        "heavy_ties": np.where(rng.random(5000) < 0.4, 7.0, rng.integers(0, 50, 5000)).astype(float),
        "long_tail": np.exp(rng.normal(0, 3, 5000)),
        "two_rows": np.array([1.0, 2.0]),
        "one_row": np.array([3.0]),
    }[kind]
    df = frame(spark, data.tolist())
    got = q.quantile_map(df, "x", PS)["x"]
    assert got == pytest.approx(np.quantile(data, PS).tolist(), rel=1e-12)
    nearest = q.quantile_map(df, "x", PS, interpolate=False)["x"]
    assert nearest == np.quantile(data, PS, method="inverted_cdf").tolist()


def test_a_poor_sketch_changes_the_work_not_the_answer(spark, monkeypatch):
    data = np.random.default_rng(1).normal(size=3000)
    df = frame(spark, data.tolist())

    def blind(df, cols, points, accuracy):
        return {c: (len(data), [-0.1, 0.1, 0.1]) for c in cols}

    monkeypatch.setattr(q, "_sketch", blind)
    assert q.quantile_map(df, "x", PS)["x"] == pytest.approx(np.quantile(data, PS).tolist(), rel=1e-12)


def test_null_nan_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None, float("nan")), (None, None, 4.0), (3.0, None, None)], "a double, b double, c double"
    )
    assert q.quantile_map(df, ["a", "b", "c"], [0.5]) == {"a": [2.0], "b": [None], "c": [4.0]}
    assert q.quantile_map(df.limit(0), ["a"], [0.5]) == {"a": [None]}
    assert q.quantile_map(df, ["a", "b"], [0.5], accuracy=100)["b"] == [None]


def test_partitioning_does_not_matter(spark):
    data = np.random.default_rng(2).integers(0, 1000, 4000).astype(float).tolist()
    answers = {tuple(q.quantile_map(frame(spark, data, n), "x", PS)["x"]) for n in (1, 4, 17)}
    assert len(answers) == 1
