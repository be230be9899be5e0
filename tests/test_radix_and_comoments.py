"""Order statistics without an interval in one task, and correlations of wide tables in one scan."""

import math

import numpy as np
import pytest

from strata.operators import comoments, profile, radix
from strata.operators import quantiles as q

PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(spark, values, partitions=4):
    return spark.createDataFrame([(float(v),) for v in values], "x double").repartition(partitions)


def test_keys_keep_the_order():
    values = np.array([-math.inf, -1e308, -2.5, -1e-310, -0.0, 0.0, 1e-310, 1.0, 1.0000000000000002, 7e200, math.inf])
    keys = radix.keys_of(values)
    assert (np.diff(keys) >= 0).all() and (np.diff(keys) == 0).sum() == 1
    assert [radix.value_of(int(k)) for k in keys] == values.tolist()


@pytest.mark.parametrize("kind", ["mixed signs", "one value", "close", "few"])
def test_radix_equals_numpy(spark, kind):
    rng = np.random.default_rng(3)
    data = {
        "mixed signs": np.concatenate([rng.normal(0, 1e6, 3000), rng.normal(0, 1e-6, 3000), [0.0, -0.0, math.inf]]),
        "one value": np.concatenate([np.full(5000, 7.25), rng.random(300)]),
        "close": 1.0 + np.arange(4000) * 2.0**-52,
        "few": np.array([3.0]),
    }[kind]
    df = frame(spark, data)
    got = q.quantile_map(df, "x", PS[:-1], interpolate=False, method="radix")["x"]
    assert got == np.quantile(data, PS[:-1], method="inverted_cdf").tolist()


def test_an_interval_with_most_rows_is_narrowed_by_counts(spark, monkeypatch):
    data = np.concatenate([np.random.default_rng(1).normal(size=5000), [-50.0, 50.0]])
    df = frame(spark, data)
    # a blind sketch leaves nearly all rows in one interval
    monkeypatch.setattr(q, "_sketch", lambda df, cols, points, accuracy: {c: (len(data), [-40.0, 40.0]) for c in cols})
    monkeypatch.setattr(q, "DIRECT_ROWS", 100)
    monkeypatch.setattr(q, "_pick", lambda *a: pytest.fail("the interval went to one task"))
    middle = PS[1:-1]
    assert q.quantile_map(df, "x", middle)["x"] == pytest.approx(np.quantile(data, middle).tolist(), rel=1e-12)


def test_small_and_large_intervals_together(spark, monkeypatch):
    rng = np.random.default_rng(2)
    a, b = rng.random(4000), np.where(rng.random(4000) < 0.5, 3.0, rng.random(4000))
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").repartition(3)
    monkeypatch.setattr(q, "DIRECT_ROWS", 1)
    got = q.quantile_map(df, ["a", "b"], PS)
    assert got["a"] == pytest.approx(np.quantile(a, PS).tolist(), rel=1e-12)
    assert got["b"] == pytest.approx(np.quantile(b, PS).tolist(), rel=1e-12)


def plain_r(x, y):
    keep = ~np.isnan(x) & ~np.isnan(y)
    x, y = x[keep], y[keep]
    if len(x) == 0 or np.isinf(x).any() or np.isinf(y).any() or x.min() == x.max() or y.min() == y.max():
        return None
    x, y = x - x.mean(), y - y.mean()
    return float((x @ y) / math.sqrt((x @ x) * (y @ y)))


def wide_frame(spark, width=141, n=400):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(n, 9))
    data = base @ rng.normal(size=(9, width)) + rng.normal(size=(n, width))
    data[:, 20:40] += 1e7  # large against their spread
    data[rng.random(data.shape) < 0.1] = np.nan
    data[:, 50] = 4.2  # constant
    data[5, 60], data[6, 61] = math.inf, -math.inf
    data[:, 70] = np.nan
    data[n // 2 :, 80] = np.nan  # present only where the next column is constant
    data[: n // 2, 81] = 1 / 3
    data[7, :] = np.nan
    rows = [tuple(None if math.isnan(x) and (i + j) % 2 else float(x) for j, x in enumerate(r)) for i, r in enumerate(data)]
    cols = [f"x{j}" for j in range(width)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5), data, cols


@pytest.mark.parametrize("tile,held", [(64, 1 << 30), (17, 1 << 30), (50, 1)])
def test_correlations_equal_plain_form(spark, tile, held):
    df, data, cols = wide_frame(spark, n=160 if held == 1 else 400)
    got = {(r["a"], r["b"]): (r["n"], r["r"]) for r in comoments.correlations(df, cols, tile, held).collect()}
    assert len(got) == 141 * 141
    for i, a in enumerate(cols):
        for j in range(0, 141, 3):
            b = cols[j]
            n, r = got[a, b]
            assert n == int((np.isfinite(data[:, i]) & np.isfinite(data[:, j])).sum())
            want = plain_r(data[:, i], data[:, j])
            assert (r is None) == (want is None), (a, b, r, want)
            assert want is None or r == pytest.approx(want, abs=1e-7)
            assert got[b, a] == (n, r)


def test_one_scan_for_141_columns(spark, tmp_path):
    df, _, cols = wide_frame(spark, n=50)
    df.write.parquet(str(tmp_path / "wide"))
    out = profile.correlation(spark.read.parquet(str(tmp_path / "wide")), cols)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and out.count() == 141 * 141


def test_narrow_correlation_treats_nan_as_missing(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.5, 5.0), (math.nan, 100.0, 5.0), (None, -7.0, 5.0), (4.0, math.nan, math.inf)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["a"], r["b"]): r["r"] for r in profile.correlation(df).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1])
    assert got["a", "a"] == pytest.approx(1.0) and got["b", "c"] is None and got["c", "c"] is None


def test_empty_and_merge(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert {(r["n"], r["r"]) for r in comoments.correlations(df, ["a", "b"]).collect()} <= {(0, None)}
    x = np.random.default_rng(0).normal(5, 2, (60, 2))
    ones, none = np.ones_like(x), np.zeros_like(x)
    both = slice(0, 2)
    parts = [comoments._batch_tile(x[k] - c, ones[k], none[k], np.full(2, c), both, both) for k, c in ((slice(0, 20), 4.0), (slice(20, 60), 6.0))]
    whole = comoments._batch_tile(x - 5.0, ones, none, np.full(2, 5.0), both, both)
    assert comoments.merge(*parts)[:7] == pytest.approx(whole[:7])
