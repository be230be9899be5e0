import hashlib
import random

import numpy as np
import pytest

from strata.llm import centroids as C
from strata.llm.queries import QUERIES


def plain(rows, clusters=40, rounds=5):
    """Whole distances with Python integers, one vector at a time."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(256 * float(x))) for x in v]))
    order = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centers = [v for _, v in sorted(kept, key=order)[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for k, vs in groups.items():
            centers[k] = [sum(x) // len(vs) for x in zip(*vs)]
    final = [(i, *near(v)) for i, v in kept]
    out = []
    for i, d, k in final:
        digest = hashlib.sha256(",".join(map(str, centers[k])).encode()).hexdigest()
        out.append((i, k, d, sum(e for _, e, m in final if m == k), sum(e for _, e, _ in final), digest))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("spread", [0.2, 300.0])
def test_query_equals_plain_form(spark, tmp_path, spread):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(rng.choice((-1, 0, 2)), spread) for _ in range(64)]) for i in range(160)]
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, rows[5][1]), (500, None), (501, []), (502, [0.5] * 63), (503, [0.0] * 65)]
    rows += [(504, [0.1] * 63 + [None]), (505, [float("nan")] * 64), (506, [float("inf")] + [0.0] * 63), (-7, [0.0] * 64), (-8, [-0.001] * 64)]
    schema = "vec_id long, embedding array<double>, cluster string, distance string, inertia int, n int, vector int"
    spark.createDataFrame([(i, v, "a", "b", 1, 2, 3) for i, v in rows], schema).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op12_centroid_clusters"](spark, str(tmp_path)).collect()
    assert ordered(got) == ordered(plain(rows))


def test_few_vectors_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>"
    few = [(i, [float(i)] * 64) for i in range(3)]
    assert ordered(C.assigned(spark.createDataFrame(few, schema)).collect()) == ordered(plain(few))
    assert C.assigned(spark.createDataFrame([], schema)).collect() == []
    assert C.assigned(spark.createDataFrame([(1, None)], schema)).collect() == []


def test_products_follow_the_moves_exactly():
    rng = np.random.default_rng(1)
    x = rng.integers(-(1 << 27), 1 << 27, (50, 64))
    old = rng.integers(-(1 << 27), 1 << 27, (9, 64))
    new = old.copy()
    new[2, 5] += 7
    new[4] = 0
    products = C.moved(x, x @ old.T, old, new)
    assert (products == x @ new.T).all()
    unchanged = [k for k in range(9) if k not in (2, 4)]
    marked = C.moved(x, np.full((50, 9), 11), old, new)  # other columns are not even read
    assert (marked[:, unchanged] == 11).all()


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit"):
        C.assigned(df)


def test_binary_columns_hold_every_width():
    for values in ([[1, -2], [30_000, 5]], [[1 << 20, 0]], [[1 << 40, -(1 << 41)]], np.zeros((0, 2), np.int64)):
        rows = np.array(values, np.int64).reshape(-1, 2)
        assert (C.from_binary(C.to_binary(rows), 2) == rows).all()
