"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

The mix is a row of N slots, N a power of two.  Slot i holds the van der Corput point of i (its
bits in reverse), which falls into one source's part of the cumulative targets: that source
fills the slot.  At every length of the mix each source therefore has had its share up to a few
slots, and at the end its share of N up to less than one.  A source's slots are ranked; its r-th
slot takes the r-th block of its words, which are its documents in hash order, laid end to end
and repeated.  All blocks of a schedule have the same number of words, the mix divided by N, so
a target is met up to less than one block, and the schedule alone says what is taken.

N is at least ``SLOTS`` and gives the smallest target ``LEAST`` slots; where that is more than
its words, a block is a fraction of a word and holds the word that begins in it, if any.
Sources whose targets differ more than ``TIER``-fold from the largest have schedules of their
own, of smaller blocks, which are merged by place: the number of slots follows from the number
of sources, not from the words.

Documents are ordered once by (source, hash) over range partitions, so a source that holds a
third of all rows is spread like any other; there is no window over a source.

Defined cases: NULL, empty and word-free texts have size 0 and nothing is taken of them; a
NULL source is a source of its own, after all others; documents that repeat are told apart by
a number; NULL ids take part; an empty table gives an empty result; very long texts lie in as
many blocks as they fill; other columns are kept out of the plan, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD_PATTERN, numbered, stored
from strata.runtime import attach

#: Weights of the sources in their order, repeated.
WEIGHTS = (5, 2, 1)
#: The mix as a multiple of all tokens, and the most that a source gives as a multiple of its own.
SHARE = 1.5
MOST = 2
#: Slots that a schedule has at least.
SLOTS = 1 << 18
#: Slots of the smallest target of a schedule: no target is missed by more than one part in LEAST.
LEAST = 1024
#: Targets of one schedule are within this factor of each other.
TIER = 16
#: Where in its step of 1/N a point lies.
SHIFT = 0.5


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, place): place is a hash that shuffles the documents of a source."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    return docs.select(
        F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"),
        F.xxhash64(F.col(key), F.col(text)).alias("place"),
    )


def _source_key() -> Column:
    """A text that is never NULL and tells a NULL source from all others."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("__key")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, n_rows, source_rank, weight, most, target) per source.

    With a level L, source i gets min(most * size_i, weight_i * L).  Sources reach their limit
    in ascending order of limit / weight, so L follows from running totals along that order.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    ranked = numbered(per, ["source"], rank="source_rank")
    cycle = F.array(*[F.lit(w) for w in weights])
    capped = ranked.select(
        "*", F.get(cycle, (F.col("source_rank") % len(weights)).cast("int")).alias("weight"), (F.col("source_size") * most).alias("most")
    ).withColumn("full_at", F.col("most") / F.col("weight"))
    along = stored(numbered(capped, ["full_at", "source_rank"], ("most", "weight"), rank="__along"), "targets")
    size, weight = F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
    tokens, all_weights = along.agg(size, weight).first()
    total = tokens * share
    # what the sources take at the level where this one is full; those at most the total are full
    taken = F.col("before_most") + F.col("most") + F.col("full_at") * (all_weights - F.col("before_weight") - F.col("weight"))
    full_most, full_weight = along.filter(taken <= total).agg(F.coalesce(F.sum("most"), F.lit(0)), weight).first()
    level = (total - full_most) / (all_weights - full_weight) if all_weights > full_weight else float("inf")
    found = along.withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * F.lit(level)))
    return found.select("source", "source_size", "n_rows", "source_rank", "weight", "most", "target")


def spans(wanted: DataFrame, slots: int = SLOTS, shift: float = SHIFT) -> DataFrame:
    """Per source its schedule (tier, n_slots, bits), the words of a block and the steps of its points, first_step up to next_step.

    A source's part of the cumulative targets is [low, low + goal) of the schedule's words.  The
    points of all N slots lie at (step + shift) / N, one a step, so the points in a part are a
    range of steps, and no slot has to be compared with the sources.
    """
    goal = F.greatest(F.lit(1), F.round("target")).cast("long")
    asked = wanted.filter("target > 0").withColumn("goal", goal)
    largest = asked.agg(F.coalesce(F.max("goal"), F.lit(1))).first()[0]
    # whole powers, so that no logarithm is rounded
    powers = [TIER**i for i in range(1, 64) if TIER**i <= largest]
    far = [F.when(F.col("goal") <= largest // p, 1).otherwise(0) for p in powers]
    asked = asked.withColumn("tier", sum(far, F.lit(0)).cast("int"))
    tiers = asked.groupBy("tier").agg(F.sum("goal").alias("words"), F.min("goal").alias("smallest"))
    wish = F.greatest(F.lit(slots).cast("long"), F.ceil(F.col("words") / F.col("smallest")) * LEAST)
    bits = F.length(F.bin(wish - 1))  # the least power of two that is enough
    tiers = tiers.withColumn("bits", bits.cast("int")).withColumn("n_slots", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")))
    tiers = numbered(tiers, ["tier"], ("words",), rank="__n").withColumnRenamed("tier", "__tier")
    laid = numbered(asked, ["tier", "source_rank"], ("goal",), rank="__along")
    met = laid.join(F.broadcast(tiers), F.col("tier") == F.col("__tier"))  # a row per power of TIER
    low = F.col("before_goal") - F.col("before_words")

    def step(words: Column) -> Column:
        return F.ceil(words.cast("double") * F.col("n_slots") / F.col("words") - F.lit(shift)).cast("long")

    return met.select(
        "source_rank", "tier", "n_slots", "bits", "goal", "most", (F.col("words") / F.col("n_slots")).alias("block_tokens"),
        step(low).alias("first_step"), step(low + F.col("goal")).alias("next_step"),
    )


def edge(block: Column, tokens: Column) -> Column:
    """Words of a source before its block: blocks of a fraction of a word more or less begin at whole words."""
    return F.ceil(block * tokens).cast("long")


def schedule(wanted: DataFrame, slots: int = SLOTS, shift: float = SHIFT) -> DataFrame:
    """(slot, source_rank, block, block_tokens, goal): which source each slot takes its next block from.

    ``goal`` is what the source's slots hold in words, at most what it may give.
    """
    parts = spans(wanted, slots, shift).filter("first_step < next_step")
    n = F.col("next_step") - F.col("first_step")
    held = F.least(F.col("most"), edge(n, F.col("block_tokens")))
    each = parts.withColumn("goal", held).withColumn("step", F.explode(F.sequence("first_step", F.col("next_step") - 1)))
    turned = F.reverse(F.call_function("lpad", F.bin("step"), F.col("bits"), F.lit("0")))
    each = each.withColumn("i", F.conv(turned, 2, 10).cast("long"))
    # the rank of a slot among its source's: all slots in order of (source, i), less those of the sources before
    ranked = numbered(each.drop("first_step", "next_step", "step", "most"), ["source_rank", "i"], rank="__along")
    counts = parts.select(F.col("source_rank").alias("__source"), n.alias("__slots"))
    first = numbered(counts, ["__source"], ("__slots",), rank="__n").select("__source", "before___slots")
    ranked = ranked.join(first, F.col("source_rank") == F.col("__source")).withColumn("block", F.col("__along") - F.col("before___slots"))
    placed = ranked.select((F.col("i") / F.col("n_slots")).alias("place"), "tier", "i", "source_rank", "block", "block_tokens", "goal")
    return numbered(placed, ["place", "tier", "i"], rank="slot").select("slot", "source_rank", "block", "block_tokens", "goal")


def mix(
    docs: DataFrame, slots: int = SLOTS, key: str = "doc_id", text: str = "text", source: str = "source", shift: float = SHIFT
) -> tuple[DataFrame, DataFrame]:
    """The documents with what the mix takes of them, and the pieces (slot, doc_number, tokens)."""
    sizes = sized(docs, key, text, source)
    wanted = targets(sizes)
    # rows that repeat get numbers, so that the order below tells all rows apart
    same = stored(sizes.withColumn("twin", F.monotonically_increasing_id()), "mix-sizes")
    laid = numbered(same, ["source", "place", "doc_id", "twin"], ("size",), rank="doc_number")
    plan = stored(schedule(wanted, slots, shift), "mix-plan")
    # what a source's slots hold; one row per source
    held = plan.groupBy("source_rank").agg(F.max("block_tokens").alias("block_tokens"), F.max("goal").alias("goal"))
    names = wanted.select(_source_key(), "source_size", "n_rows", "source_rank", "target")
    bases = numbered(names, ["source_rank"], ("source_size",), rank="__n").withColumnRenamed("before_source_size", "base")
    bases = stored(bases.drop("__n").join(held, "source_rank", "left"), "mix-sources")
    # few sources are broadcast; of many, those with many rows are joined apart
    laid = attach(laid.withColumn("__key", _source_key()).drop("source"), bases, "__key", "n_rows")
    laid = stored(
        laid.select(
            "doc_id", "place", "size", "source_size", "source_rank", "target", "block_tokens", "goal", "doc_number",
            (F.col("before_size") - F.col("base")).alias("at"),
        ),
        "mix-laid",
    )
    # each document lies in the repeated stream of its source once per epoch
    lying = laid.filter("size > 0 AND goal > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
    lying = lying.withColumn("start", F.col("at") + F.col("epoch") * F.col("source_size"))
    lying = lying.withColumn("stop", F.least(F.col("start") + F.col("size"), F.col("goal"))).filter("start < stop")
    # one block more at each end, as edges are whole words; those that do not meet the document go
    first, last = F.floor(F.col("start") / F.col("block_tokens")) - 1, F.floor(F.col("stop") / F.col("block_tokens")) + 1
    lying = lying.select(
        "doc_number", "source_rank", "start", "stop", "block_tokens",
        F.explode(F.sequence(F.greatest(F.lit(0).cast("long"), first), last)).alias("block"),
    )
    low = F.greatest(F.col("start"), edge(F.col("block"), F.col("block_tokens")))
    high = F.least(F.col("stop"), edge(F.col("block") + 1, F.col("block_tokens")))
    cut = lying.withColumn("tokens", high - low).filter("tokens > 0").select("doc_number", "source_rank", "block", "tokens")
    pieces = cut.join(plan.select("slot", "source_rank", "block"), ["source_rank", "block"]).select("slot", "doc_number", "tokens")
    taken = pieces.groupBy("doc_number").agg(F.sum("tokens").alias("taken"))
    mixed = laid.join(taken, "doc_number", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "doc_number", "place"
    )
    return mixed, pieces


def apply_mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix has read it, to the nearest whole number.

    Rows equal in id and text are read equally often (their mean).
    """
    mixed, _ = mix(docs, key=key, text=text, source=source)
    often = mixed.filter("size > 0").groupBy(F.col("place").alias("__place"), F.col("doc_id").alias("__id"))
    times = often.agg(F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int").alias("__times")).filter("__times > 0")
    same = (F.xxhash64(F.col(key), F.col(text)) == F.col("__place")) & F.col(key).eqNullSafe(F.col("__id"))
    met = docs.join(times, same)
    return met.withColumn("__times", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)
