import random

import pytest

from strata.llm import decontaminate as D


def substring_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(rng, item, n):
    for _ in range(n):
        i = rng.randrange(len(item))
        item = rng.choice([item[:i] + item[i + 1 :], item[:i] + rng.choice("abcxyz") + item[i + 1 :], item[:i] + rng.choice("abc") + item[i:]])
    return item


@pytest.mark.parametrize("seed", range(6))
def test_matcher_equals_dynamic_programming(seed):
    rng = random.Random(seed)
    words = ["the", "of", "ra", "tion", "and", "be", "shon", "in"]
    items = [" ".join(rng.choice(words) for _ in range(rng.randint(9, 40))) for _ in range(6)]
    matcher = D.Matcher(list(enumerate(items)), 0.1)
    for _ in range(12):
        item = rng.choice(items)
        text = " ".join([*rng.choices(words, k=12), edited(rng, item, rng.randint(0, 2 * D.budget(len(item), 0.1))), *rng.choices(words, k=12)])
        got = {n: e for n, (e, _) in matcher.of(text).items()}
        want = {n: e for n, x in enumerate(items) if (e := substring_distance(x, text)) <= D.budget(len(x), 0.1)}
        assert got == want


def test_tables(spark, odd_documents):
    item = "What is the capital of the largest country in the south?"
    docs = odd_documents.select("doc_id", "text").unionAll(
        spark.createDataFrame([(20, f"x {item.upper()} y"), (21, item.replace("largest", "largezt").replace(" ", "\n ")), (22, item[:40])], "doc_id long, text string")
    )
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, " "), (4, "A b c d e f G"), (None, "no id here")], "item_id long, text string")
    for size in (10, 10_000):
        got = sorted((tuple(r)[:3] for r in D.matches(docs, items, block_chars=size).collect()), key=repr)
        # the short item without an id stands inside the document without an id
        want = [(20, 1, 0), (20, 1, 0), (21, 1, 1), (21, 1, 1), (1, 4, 0), (1, 4, 0), (8, 4, 0), (None, None, 0)]
        assert got == sorted(want, key=repr)
    kept = D.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r[0] or 0) for r in kept.collect()) == [2, 3, 4, 5, 6, 7, 22]
    assert D.matches(docs.limit(0), items).collect() == [] and D.matches(docs, items.limit(0)).collect() == []
    assert D.clean(docs, items.limit(0)).count() == docs.count()
