"""N-gram Jaccard join by rare-first prefix filtering.

A document is the set of its 5-word shingles (64-bit hashes).  Shingles are ordered rare
first, by counts of all documents (a count vector of fixed size) and then by hash.  A
document linked with another shares one of its first n - ceil(0.75 n) + 1 shingles with it,
so only these prefixes are joined.

* Short posting lists emit their pairs that pass the length and positional filters.  A long
  list emits pairs with its first document only and is set aside.
* Each pair is verified once: after the suffix filter (how often the two sets fall into
  ranges of hashes bounds what they can share) the exact overlap decides.
* Links make components.  A long list whose documents are one component by now has no more
  to say.  Of the others, the first documents of their largest components are compared with
  the rest, and what then still lies in different components is compared pair by pair.  So a
  group of near copies costs pairs in proportion to its size, and no link between two
  components is lost.
* Texts of equal words are found by a 128-bit hash first; one of them stands for all.

Hot shingles are salted by document for the posting lists; their lists are long by
definition, so pairs across salts are found with the lists that were set aside.

Defined cases: NULL, empty and word-free texts have an empty set and no links; texts under
five words are one shingle, the whole sequence; rows that share a doc_id are one node and
each get its component; a NULL doc_id is left out of links and gets a NULL component; an
empty table gives an empty result; texts are hashed whole; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from strata.llm.common import (
    CELLS,
    WordHashes,
    cell_of,
    drop_ids,
    id_bitmap,
    in_batches,
    in_bitmap,
    maybe_in,
    mixed,
    release_memory,
    stored,
    summed_vector,
    vector_rows,
)

WORDS = 5
#: Similarity as a fraction of whole numbers: intersection / union >= NUM / DEN.
NUM, DEN = 75, 100
#: A posting list up to this length emits all its pairs at once.
SHORT = 6
#: A counter above this splits a shingle's posting list by document.
SALT_ROWS = 100_000
#: Components of a long list that are compared through their first document.
PIVOTS = 8
_MUL = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case; other letters stay."""
    return text.lower().split() if text else []


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a word sequence."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(WORDS, n)
    h = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        h = mixed((h ^ hashes[k : n - width + 1 + k]) * _MUL)
    return np.unique(h)


def ceil_div(a, b: int):
    return -(-a // b)


def needed(n1, n2):
    """Fewest common shingles of linked sets of n1 and n2."""
    return ceil_div(NUM * (n1 + n2), NUM + DEN)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))


def sizes_and_counts(rows: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n_shingles, high, low) of each row, the last two a 128-bit hash of its words; and the counter of every cell of shingles."""
    names = ["doc_id", "n_shingles", "high", "low", "slice", "cells"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        words, counts, seen = WordHashes(100_000), np.zeros(CELLS, np.int64), set()

        def piece(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            sizes, keys, found = [], [], []
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                split = words_of(t)
                s = shingle_set(words.of(split))
                key = xxhash.xxh3_128_digest(b" ".join(split))
                sizes.append(len(s))
                keys.append(key)
                if d is not None and key not in seen:  # copies in this task add nothing to the order
                    if len(seen) >= 50_000:
                        seen.clear()
                    seen.add(key)
                    found.append(s)
            if found:
                cells, times = np.unique(cell_of(np.concatenate(found)), return_counts=True)
                counts[cells] += times
            n = batch.num_rows
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(n, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                names=names,
            )

        yield from in_batches(batches, piece, 2 << 20)
        slices, cells = vector_rows(counts)
        none = pa.nulls(len(slices), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(slices, pa.int32()), pa.array(cells, pa.binary())], names=names)

    both = stored(rows.mapInArrow(measure, "doc_id long, n_shingles long, high long, low long, slice int, cells binary"), "shingle-counts")
    counts = summed_vector(both.filter("slice IS NOT NULL").select("slice", "cells"))
    return both.filter("slice IS NULL").drop("slice", "cells"), counts


def copy_links(sizes: DataFrame) -> DataFrame:
    """(a, b): documents with the same words as a document of smaller id, linked to the smallest; stored."""
    known = sizes.filter("doc_id IS NOT NULL AND n_shingles > 0")
    groups = known.groupBy("high", "low").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("__last")).filter("b < __last")
    met = known.select(F.col("doc_id").alias("a"), "high", "low").join(groups, ["high", "low"])
    return stored(met.filter("a <> b").select("a", "b").distinct(), "copies")


def prefixes(rows: DataFrame, counts: np.ndarray, without: DataFrame) -> DataFrame:
    """(gram, salt, doc_id, n, pos): the rarest shingles of each document whose id is not in ``without``.

    Documents that a bitmap of these ids clears are taken where they stand, by the same Python
    worker that cuts them; the others, most of them in ``without``, go through the exact join.
    """
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))
    gone = context.broadcast(id_bitmap(without))

    def emit(batches: Iterator[pa.RecordBatch], cleared: bool) -> Iterator[pa.RecordBatch]:
        release_memory()
        words, table = WordHashes(100_000), shared.value

        def piece(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if cleared:
                batch = batch.filter(pa.array(~in_bitmap(gone.value, batch.column("doc_id"))))
            grams, salts, ids, ns, poss = [], [], [], [], []
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                s = shingle_set(words.of(words_of(t))) if d is not None else ()
                n = len(s)
                if n == 0:
                    continue
                often = table[cell_of(s)]
                p = n - ceil_div(NUM * n, DEN) + 1
                rare = np.lexsort((s, often))[:p]
                grams.append(s[rare].view(np.int64))
                salts.append(np.where(often[rare] > SALT_ROWS, d % (1 + often[rare].astype(np.int64) // SALT_ROWS), -1))
                ids.append(np.full(p, d, np.int64))
                ns.append(np.full(p, n, np.int64))
                poss.append(np.arange(p, dtype=np.int32))
            if ids:
                parts = (grams, salts, ids, ns, poss)
                columns = [np.concatenate(x).astype(k) for x, k in zip(parts, (np.int64, np.int32, np.int64, np.int64, np.int32))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "salt", "doc_id", "n", "pos"])

        yield from in_batches(batches, piece)

    schema = "gram long, salt int, doc_id long, n long, pos int"
    clear = rows.mapInArrow(lambda batches: emit(batches, True), schema)
    rest = rows.filter(maybe_in(gone, "doc_id")).join(without.toDF("__gone").distinct(), F.col("doc_id") == F.col("__gone"), "left_anti")
    return clear.unionAll(rest.mapInArrow(lambda batches: emit(batches, False), schema))


def passing(n1, p1, n2, p2):
    """Length filter, and positional filter at a shared shingle (0-based positions)."""
    big, small = np.maximum(n1, n2), np.minimum(n1, n2)
    return (DEN * small >= NUM * big) & (np.minimum(n1 - p1, n2 - p2) >= needed(n1, n2))


def candidates(prefix_rows: DataFrame) -> DataFrame:
    """(gram, a, b, n, pos): gram NULL: candidate pair a < b; otherwise document a of a long list."""
    parts = int(prefix_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = prefix_rows.repartition(parts, "gram", "salt").sortWithinPartitions("gram", "salt", "doc_id")
    columns = ["gram", "salt", "doc_id", "n", "pos"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        carry = {c: np.zeros(0, np.int64) for c in columns}
        known_long = False  # whether the carried row is the first document of a long list already set aside

        def emit(rows: dict[str, np.ndarray], opened: bool) -> Iterator[pa.RecordBatch]:
            n = len(rows["gram"])
            if n == 0:
                return
            gram, salt, doc, size, pos = (rows[c] for c in columns)
            new = np.ones(n, bool)
            new[1:] = (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])
            start = np.flatnonzero(new)
            length = np.diff(np.append(start, n))
            own_start = np.repeat(start, length)
            long = np.repeat((length > SHORT) | (salt[start] >= 0), length)
            if opened:
                long[: length[0]] = True
            left, right = [], []
            for d in range(1, SHORT):
                i = np.flatnonzero((own_start[:-d] == own_start[d:]) & ~long[:-d]) if n > d else np.zeros(0, np.int64)
                left.append(i)
                right.append(i + d)
            member = np.flatnonzero(long & (own_start != np.arange(n)))
            left.append(own_start[member])
            right.append(member)
            i, j = np.concatenate(left), np.concatenate(right)
            ok = passing(size[i], pos[i], size[j], pos[j]) & (doc[i] != doc[j])
            i, j = i[ok], j[ok]
            pairs = np.unique(np.stack([np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j])]), axis=1)
            if opened:
                long[0] = False  # written with an earlier batch
            k = np.flatnonzero(long)
            m = pairs.shape[1]
            lists = np.zeros(m + len(k), bool)
            lists[:m] = True
            none = np.zeros(m, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([none, gram[k]]), mask=lists), pa.array(np.concatenate([pairs[0], doc[k]])),
                    pa.array(np.concatenate([pairs[1], doc[k]])), pa.array(np.concatenate([none, size[k]])),
                    pa.array(np.concatenate([none, pos[k]])),
                ],
                names=["gram", "a", "b", "n", "pos"],
            )

        for batch in batches:
            now = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns}
            rows = {c: np.concatenate([carry[c], now[c]]) for c in columns}
            n = len(rows["gram"])
            if n == 0:
                continue
            same = (rows["gram"] == rows["gram"][-1]) & (rows["salt"] == rows["salt"][-1])
            cut = int(n - same[::-1].argmin()) if not same.all() else 0
            whole = {c: v[:cut] for c, v in rows.items()}
            yield from emit(whole, known_long and cut > 0)
            rest = {c: v[cut:] for c, v in rows.items()}
            known_long = known_long and cut == 0
            if len(rest["gram"]) > max(SHORT, 20_000):  # a list that goes on: its first document stays as the pivot
                yield from emit(rest, known_long)
                rest, known_long = {c: v[:1] for c, v in rest.items()}, True
            carry = rest
        yield from emit(carry, known_long)

    return dealt.mapInArrow(join, "gram long, a long, b long, n long, pos long")


def sets_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, grams) of the documents whose id may be among ``ids``: a fixed-size bitmap keeps the others out."""
    shared = rows.sparkSession.sparkContext.broadcast(id_bitmap(ids))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        words = WordHashes(100_000)

        def piece(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            batch = batch.filter(pa.array(in_bitmap(shared.value, batch.column("doc_id"))))
            got = [shingle_set(words.of(words_of(t))).astype("<u8").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got, pa.binary())], names=["doc_id", "grams"])

        yield from in_batches(batches, piece)

    return rows.mapInArrow(build, "doc_id long, grams binary")


_RANGES = (np.arange(1, 16, dtype=np.uint64) << np.uint64(60)).astype(np.uint64)


def linked(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    n1, n2 = len(x), len(y)
    if DEN * min(n1, n2) < NUM * max(n1, n2) or not n1:
        return False
    least = needed(n1, n2)
    # suffix filter: sets that differ in how many hashes fall into a range differ by that many at least
    apart = np.abs(np.diff(np.searchsorted(x, _RANGES), prepend=0, append=n1) - np.diff(np.searchsorted(y, _RANGES), prepend=0, append=n2)).sum()
    if apart > n1 + n2 - 2 * least:
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return DEN * common >= NUM * (n1 + n2 - common)


@F.arrow_udf(BooleanType())
def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([linked(x.as_buffer(), y.as_buffer()) for x, y in zip(a, b)], pa.bool_())


def verified(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, ok) of different pairs; stored."""
    sets = sets_of(rows, pairs.select("a").unionAll(pairs.select("b")))
    one = pairs.join(sets.toDF("a", "x"), "a")
    two = one.join(sets.toDF("b", "y"), "b")
    return stored(two.select("a", "b", _linked("x", "y").alias("ok")).groupBy("a", "b").agg(F.max("ok").alias("ok")), "verified")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component) of all ends of ``links`` (a, b): stars are grown and joined until every node points at its smallest."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "stars")
    before = None
    while True:
        # large star: larger neighbours of a node move to its smallest neighbour
        around = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        grown = around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        low = grown.groupBy("u").agg(F.min("v").alias("m"))
        met = grown.join(low, "u")
        moved = met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    pointed = edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component"))
    return pointed.unionAll(edges.select(F.col("v").alias("doc_id"), F.col("v").alias("component"))).distinct()


def _passing_columns(x: str, y: str) -> Column:
    n1, p1, n2, p2 = (F.col(f"{s}.{c}") for s in (x, y) for c in ("n", "pos"))
    least = F.ceil(NUM * (n1 + n2) / F.lit(NUM + DEN))
    return (DEN * F.least(n1, n2) >= NUM * F.greatest(n1, n2)) & (F.least(n1 - p1, n2 - p2) >= least)


def _open_lists(lists: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of long lists that hold more than one component, with their component."""
    named = components(links).withColumnRenamed("doc_id", "a")
    named = lists.join(named, "a", "left").withColumn("component", F.coalesce("component", "a"))
    span = named.groupBy("gram").agg(F.min("component").alias("__lo"), F.max("component").alias("__hi"))
    return stored(named.join(span.filter("__lo < __hi").select("gram"), "gram", "left_semi"), "open-lists")


def _across(left: DataFrame, right: DataFrame, tested: DataFrame) -> DataFrame:
    """Untested pairs of one list in different components that pass the filters."""
    x, y = left.alias("x"), right.alias("y")
    met = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.component") != F.col("y.component")) & _passing_columns("x", "y"))
    pairs = met.select(F.least("x.a", "y.a").alias("a"), F.greatest("x.a", "y.a").alias("b")).distinct()
    return stored(pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti"), "pairs")


def all_links(rows: DataFrame, sizes: DataFrame, counts: np.ndarray) -> DataFrame:
    """Links (a, b) that connect every component; pairs already in one component are not looked for again."""
    copies = copy_links(sizes)
    spread = stored(candidates(prefixes(rows, counts, copies.select("a"))), "candidates")
    pairs = spread.filter("gram IS NULL").select("a", "b").distinct()
    tested = verified(rows, pairs)
    links = copies.unionAll(tested.filter("ok").select("a", "b"))
    lists = spread.filter("gram IS NOT NULL").select("gram", "a", "n", "pos")
    if lists.isEmpty():
        return links
    for final in (False, True):
        open_rows = _open_lists(lists, links)
        if open_rows.isEmpty():
            break
        if final:
            more = _across(open_rows, open_rows.filter("TRUE"), tested)
        else:
            each = open_rows.groupBy("gram", "component").agg(
                F.count(F.lit(1)).alias("__n"), F.min_by(F.struct("a", "n", "pos"), "a").alias("__p")
            )
            order = Window.partitionBy("gram").orderBy(F.desc("__n"), "component")
            pivots = each.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= PIVOTS).select("gram", "component", "__p.*")
            more = _across(open_rows, pivots, tested)
        if not more.isEmpty():
            found = verified(rows, more)
            tested = tested.unionAll(found)
            links = links.unionAll(found.filter("ok").select("a", "b"))
    return links


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = _texts(docs, key, text)
    sizes, counts = sizes_and_counts(rows)
    named = stored(components(all_links(rows, sizes, counts)), "components")
    found = sizes.join(named, "doc_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id, and of rows that share it one."""
    rows = _texts(docs, key, text)
    sizes, counts = sizes_and_counts(rows)
    named = stored(components(all_links(rows, sizes, counts)), "components")
    kept = drop_ids(docs, named.filter("component <> doc_id").select("doc_id"), key)
    again = sizes.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    again = stored(again, "repeated-ids")
    if again.isEmpty():
        return kept
    once = kept.join(again.toDF("__id"), F.col(key) == F.col("__id"), "left_semi").dropDuplicates([key])
    return drop_ids(kept, again, key).unionByName(once)
