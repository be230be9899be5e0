"""Sources far smaller than a slot of the mix get their target, and have their blocks spread over it."""

from strata.llm import mixing as M
from tests.llm.test_mixing import water

SLOTS = 64


def tiny_beside_huge(spark):
    """Twenty sources of 1 to 40 words beside one of 400,000; a slot of the mix has over 9,000."""
    rows = [(i, "w " * 1000, "huge") for i in range(400)]
    rows += [(1000 + i, "v " * (1 + 2 * i), f"tiny{i:02d}") for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def test_tiny_sources_get_their_targets(spark):
    docs = tiny_beside_huge(spark)
    mixed, pieces = M.mix(docs, slots=SLOTS)
    got = {r["source"]: r for r in mixed.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg({"taken": "sum", "size": "sum"}).collect()}
    want = water({s: r["sum(size)"] for s, r in got.items()})
    assert len(want) == 21
    for source, r in got.items():
        assert abs(r["sum(taken)"] - want[source]) <= 1, source
    # all tiny documents are read twice: none may be dropped by the pipeline
    assert M.apply_mix(docs).filter("source <> 'huge'").count() == 40
    # the blocks of the longest tiny document lie all over the mix
    last = mixed.filter("doc_id = 1019").select("doc_number")
    slots = sorted(r["slot"] for r in pieces.join(last, "doc_number").collect())
    total = M.schedule(M.targets(M.sized(docs)), SLOTS).count()
    assert len(slots) >= 32
    assert max(b - a for a, b in zip([0, *slots], [*slots, total])) <= total / 8


def test_every_source_keeps_its_share_at_every_length(spark):
    plan = M.schedule(M.targets(M.sized(tiny_beside_huge(spark))), SLOTS).orderBy("slot").collect()
    n = {}
    for r in plan:
        n[r["source_rank"]] = n.get(r["source_rank"], 0) + 1
    words = {r["source_rank"]: r["goal"] for r in plan}
    had, all_words = dict.fromkeys(n, 0), 0
    for r in plan:
        step = min(r["block_tokens"], r["goal"] - r["block"] * r["block_tokens"])
        had[r["source_rank"]] += 1
        all_words += step
        for s in n:
            # one block of its own, and what one block of the huge source moves the mix by
            assert abs(had[s] / n[s] - all_words / sum(words.values())) <= 1 / n[s] + 1 / SLOTS + 0.02
