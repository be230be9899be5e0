import random
import zlib

import pytest

from strata.llm import toxicity as T


def corpus(n=500):
    rng = random.Random(3)
    plain = ["".join(rng.choice(["ra", "ti", "on", "sel", "mo", "qua"]) for _ in range(rng.randint(1, 4))) for _ in range(200)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(8, 80))]
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(1 + len(words) // 12):
                words.insert(rng.randrange(len(words)), "vilhate" + rng.choice(["ra", "ti", "on", ""]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_accuracy_and_defined_cases(spark, odd_documents):
    docs, labels = corpus()
    names = odd_documents.columns
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id + 100 AS doc_id", "text").join(
        odd_documents.limit(0), ["doc_id", "text"], "left"
    ).select(*names).unionAll(odd_documents)
    marks = [(i + 100, q, t) for i, q, t in labels] + [(100, 1, 0), (None, 1, 1), (7, 1, None)]
    lab = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    truth = {i + 100: t for i, _, t in labels}
    got = T.score(df, lab).collect()
    assert len(got) == len(docs) + 10
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    tested = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in tested) >= 0.95 * len(tested)
    blank = {r["score"] for r in got if r["doc_id"] in (2, 3, 4)}
    assert len(blank) == 1 and blank.pop() < 0.5
    kept = T.clean(df, lab)
    assert kept.columns == names
    assert kept.count() == sum(r["predicted"] == 0 for r in got)


def test_without_labels(spark, odd_documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in T.score(odd_documents, none).collect()} == {0.0}
    assert T.clean(odd_documents, none).count() == 10
    assert T.score(odd_documents.limit(0), none).collect() == []


def test_probabilities_sum_to_one(spark):
    docs, labels = corpus(60)
    rows = spark.createDataFrame([(t, x, 0) for (_, t), (_, _, x) in zip(docs, labels)], "text string, toxic int, fold int")
    model = T.fit(rows)
    letters = sorted({c for _, t in docs for c in t if c != " "})
    import numpy as np

    for begin in ("", "ra", "vilh", "zz"):
        # all continuations of a start by one letter or the end, per class, from the tables themselves
        words = [begin + x for x in letters]
        total = np.zeros(2)
        for w in [*words, begin]:
            total += step(model, w, closing=w == begin)
        assert total == pytest.approx([1, 1], abs=0.02 + 2 / model.alphabet)


def step(model, word, closing):
    """P(last character of the word, or of its end, after what is before it), per class."""
    import numpy as np

    codes, place = T._codes([word])
    at_wanted = len(codes) - 1 if closing else len(codes) - 2
    prob = np.full((len(codes), 2), 1.0 / model.alphabet)
    for order, ((keys, value), (ctx, back)) in enumerate(zip(model.grams, model.contexts), 1):
        at, h = T._hashes(codes, place, order)
        if order == 1:
            weight = np.broadcast_to(back[0], (len(at), 2))
        else:
            before, hc = T._hashes(codes, place, order - 1)
            weight = T._look(ctx, back, hc[np.searchsorted(before, at - 1)], 1.0)
        prob[at] = T._look(keys, value, h, 0.0) + weight * prob[at]
    return prob[at_wanted]


def test_long_runs_of_letters_are_scored_and_counted_whole(spark, monkeypatch):
    rng = random.Random(5)
    run = "".join(rng.choice("abcdéßx") for _ in range(9_001))
    docs = [(f"{run} vilhate", 1, 0), (run[100:400], 0, 0), ("ra ti on", 0, 0), ("", 0, 0), (None, 1, 0)]
    rows = spark.createDataFrame(docs, "text string, toxic int, fold int")
    whole = T.fit(rows)
    expected = {}
    for text, toxic, _ in docs:
        for w in T.expressions(text):
            for k in range(1, T.ORDER + 1):
                marked = f"\x02{w}\x03"
                for i in range(len(marked) - k + 1):
                    expected.setdefault(marked[i : i + k], [0, 0])[1 - toxic] += 1
    words = [run, run[:5], "vilhate", run[7:5_000], run]
    counted = {r["gram"]: [r["toxic"], r["ordinary"]] for r in T.gram_counts(rows).collect()}
    assert counted == expected
    got = whole.log_ratio(words)
    monkeypatch.setattr(T, "SLICE", 100_000)
    want = whole.log_ratio(words)
    assert got == pytest.approx(want, abs=1e-9)
    held = T.Evidence(whole)
    assert held.of([run, f"{run} ra"])[0] == pytest.approx(want[0], abs=1e-9)
    assert set(held.known) == {"ra"}
