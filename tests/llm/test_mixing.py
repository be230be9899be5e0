from collections import defaultdict

import pytest

from strata.llm import mixing as M


def water(sizes):
    total = 1.5 * sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        mass = sum(weight[s] for s in order if s not in full)
        out = {s: 2.0 * sizes[s] if s in full else weight[s] * left / mass for s in order}
        over = {s for s in order if s not in full and out[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return out
        full |= over


def check(rows, slots):
    sizes, taken = defaultdict(int), defaultdict(int)
    for source, r in rows:
        sizes[source] += r["size"]
        taken[source] += r["taken"]
    want = water(sizes)
    block = max(1, -(-1.5 * sum(sizes.values()) // slots))
    for source, r in rows:
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(want[source])
        assert 0 <= r["taken"] <= 2 * r["size"]
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 6 * block + 1


def test_targets_and_taken(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), ["a", "b", "c", None, "é", "Z"][min(i % 9, 5)]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    mixed, pieces = M.mix(df, slots=4096)
    got = mixed.collect()
    source = {i: s for i, _, s in rows}
    check([(source[r["doc_id"]], r) for r in got], 4096)
    again = M.mix(df.repartition(3), slots=4096)[0].collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    assert sum(r["tokens"] for r in pieces.collect()) == sum(r["taken"] for r in got)
    plan = mixed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark, odd_documents):
    got = M.mix(odd_documents)[0].collect()
    assert len(got) == 10
    sizes = sorted(r["size"] for r in got)
    assert sizes[:3] == [0, 0, 0]
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert M.mix(odd_documents.limit(0))[0].collect() == []
    blank = M.mix(odd_documents.filter("doc_id IN (2, 3, 4)"))[0].collect()
    assert [r["taken"] for r in blank] == [0, 0, 0]
