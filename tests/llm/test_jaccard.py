import random
from collections import defaultdict

import pytest

from strata.llm import jaccard as J


def brute(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set())
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            common = len(sets[i] & sets[j])
            if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted(((d, len(s), None if d is None else find(d)) for (d, _), s in zip(rows, sets)), key=repr)


def corpus(seed, n_groups, group, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    rows, d = [], 0
    passage = [rng.choice(words) for _ in range(40)]
    for _ in range(n_groups):
        base = [rng.choice(words) for _ in range(rng.randint(3, 80))]
        if rng.random() < 0.3:
            base = base[: rng.randint(1, 20)] + passage
        for _ in range(rng.randint(1, group)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((d * 7 % 10007, " ".join(w)))
            d += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,group", [(1, 4), (2, 40)])
def test_equals_brute_force(spark, monkeypatch, seed, group):
    monkeypatch.setattr(J, "SHORT", 3)
    rows = corpus(seed, 400 // group + 12, group) + [(None, "a b c d e f"), (20001, None), (20002, ""), (20003, " \n"), (20004, "One"), (20005, "one")]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, n long, gram string").repartition(5)
    got = sorted((tuple(r) for r in J.join(df).collect()), key=repr)
    assert got == brute(rows)


def test_keep_one(spark, odd_documents):
    kept = J.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    empty = odd_documents.limit(0)
    assert J.join(empty).collect() == [] and J.keep_one(empty).collect() == []


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    got = dict(map(tuple, J.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    parent = defaultdict(lambda: None)

    def find(x):
        while parent[x] is not None and parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        if x != y:
            parent[y] = x
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
