"""The mix is what a plain walk over the van der Corput points takes, and another schedule takes other words."""

from collections import defaultdict
from fractions import Fraction
from math import ceil

from strata.llm import mixing as M
from tests.llm.test_mixing import water

SLOTS = 64


def documents(spark):
    rows = [(i, "w " * (3 + i * 11 % 60), ["a", "b", "c", "d", None][min(i % 7, 4)]) for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), rows


def van_der_corput(i, bits):
    return int(f"{i:0{bits}b}"[::-1], 2)


def walked(sizes, shift):
    """Slots by walking i = 0, 1, ... through the cumulative targets: [(source, block)], and the words of a block."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = {s: max(1, round(x)) for s, x in water(sizes).items()}
    words = sum(goal.values())
    assert max(goal.values()) < M.TIER * min(goal.values())
    wish = max(SLOTS, M.LEAST * ceil(words / min(goal.values())))
    bits = len(f"{wish - 1:b}")
    n, had, plan = 1 << bits, defaultdict(int), []
    for i in range(n):
        point = Fraction(van_der_corput(i, bits)) + Fraction(shift)
        at, source = Fraction(0), None
        for s in order:
            at += goal[s]
            if point * words < at * n:
                source = s
                break
        else:
            continue
        plan.append((source, had[source]))
        had[source] += 1
    return plan, Fraction(words, n)


def test_schedule_and_taken_equal_the_walk(spark, monkeypatch):
    monkeypatch.setattr(M, "LEAST", 8)
    df, rows = documents(spark)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    plan, tokens = walked(sizes, 0.5)
    got = M.schedule(M.targets(M.sized(df)), SLOTS).orderBy("slot").collect()
    assert [(order[r["source_rank"]], r["block"]) for r in got] == plan
    assert [r["slot"] for r in got] == list(range(len(plan)))
    assert all(r["block_tokens"] == float(tokens) for r in got)

    # lay each source's documents end to end as the operator orders them, and read block after block
    mixed, pieces = M.mix(df, slots=SLOTS)
    found = mixed.orderBy("doc_number").collect()
    source = {i: s for i, _, s in rows}
    streams = defaultdict(list)
    for r in found:
        streams[source[r["doc_id"]]] += [r["doc_id"]] * r["size"]
    taken, in_slot = defaultdict(int), defaultdict(int)
    for slot, (s, block) in enumerate(plan):
        stream = streams[s] * 2
        for doc in stream[ceil(block * tokens) : ceil((block + 1) * tokens)]:
            taken[doc] += 1
            in_slot[slot, doc] += 1
    assert {r["doc_id"]: r["taken"] for r in found if r["taken"]} == dict(taken)
    ids = {r["doc_number"]: r["doc_id"] for r in found}
    assert {(r["slot"], ids[r["doc_number"]]): r["tokens"] for r in pieces.collect()} == dict(in_slot)
    per = defaultdict(int)
    for r in found:
        per[source[r["doc_id"]]] += r["taken"]
    assert all(abs(per[s] - x) <= tokens + 1 for s, x in water(sizes).items())


def test_another_schedule_takes_other_words(spark, monkeypatch):
    monkeypatch.setattr(M, "LEAST", 8)
    df, _ = documents(spark)
    one, two = (
        {r["doc_id"]: r["taken"] for r in M.mix(df, slots=SLOTS, shift=shift)[0].collect()} for shift in (0.05, 0.95)
    )
    assert one.keys() == two.keys() and one != two


def test_clashing_columns_and_a_very_long_text(spark):
    rows = [(1, "w " * 300_000, "a", 7, "x"), (2, "v " * 1000, "b", 8, "y"), (2, "v " * 1000, "b", 9, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, slot string")
    got = M.mix(df)[0].collect()
    assert sorted((r["doc_id"], r["size"]) for r in got) == [(1, 300_000), (2, 1000), (2, 1000)]
    assert [r["taken"] for r in got if r["doc_id"] == 2] == [2000, 2000]
    long = next(r for r in got if r["doc_id"] == 1)
    assert abs(long["taken"] - long["target"]) <= 3
    assert sorted(M.apply_mix(df).columns) == sorted(df.columns)
