"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may be matched with k = floor(``ERROR_RATE`` * m) edits.  Cut into
k + 1 pieces, at least one piece must occur unchanged, whatever the edits are.  One automaton
finds all pieces of all items in a text in a single pass; each hit is verified by Myers'
bit-parallel edit distance of the whole item against the window the piece points to.

The items are a stated query set: they are taken in blocks of at most ``BLOCK_CHARS``
characters, each block's pieces are broadcast (a fixed bound) and searched in all documents.

Texts are compared in lower case with every run of white space as one space.

Defined cases: NULL and empty documents match nothing; NULL and empty items are not searched;
items under ``SHORT_CHARS`` characters match without edits and only between word edges, so that a
short item is not found inside longer words; a NULL document id is reported as NULL; repeated documents and items are each reported; empty tables give an
empty result; very long texts are searched whole; other columns are not looked at.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import in_batches, worker_memory

ERROR_RATE = 0.08
#: Items of fewer characters have no edits: one edit makes another word of most of them.
SHORT_CHARS = 24
BLOCK_CHARS = 2_000_000
SPACE = re.compile(r"\s+")
SCHEMA = "doc_id long, item_id long, errors int, budget int, position long"


def folded(text: str | None) -> str:
    return SPACE.sub(" ", text.lower()).strip() if text else ""


def budget(length: int, rate: float = ERROR_RATE) -> int:
    return int(rate * length + 1e-9)


def _one_word(a: str, b: str) -> bool:
    """Whether two neighbouring characters belong to a word; scripts written without spaces have an edge everywhere."""
    return a.isalnum() and b.isalnum() and ord(a) < 0x2E80 and ord(b) < 0x2E80


def between_edges(text: str, start: int, stop: int) -> bool:
    if start > 0 and _one_word(text[start - 1], text[start]):
        return False
    return not (stop < len(text) and _one_word(text[stop - 1], text[stop]))


def pieces_of(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``errors`` + 1 pieces of nearly equal length."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' automaton of one item: per character the bits of the places where it stands."""

    def __init__(self, item: str, errors: int):
        self.item, self.errors = item, errors
        self.bits: dict[str, int] = {}
        for i, c in enumerate(item):
            self.bits[c] = self.bits.get(c, 0) | 1 << i

    def search(self, text: str, start: int, stop: int) -> tuple[int, int] | None:
        """Fewest edits between the item and a substring of text[start:stop], and where that ends; None beyond the budget."""
        at = text.find(self.item, start, stop)
        if at >= 0:
            return 0, at + len(self.item)
        m = len(self.item)
        full, top = (1 << m) - 1, 1 << (m - 1)
        up, down, score = full, 0, m
        best, where = self.errors + 1, -1
        get = self.bits.get
        for i in range(start, stop):
            eq = get(text[i], 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph = down | ~(xh | up) & full
            mh = up & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
                if score < best:
                    best, where = score, i + 1
            ph = ph << 1 & full
            mh = mh << 1 & full
            up = mh | ~(xv | ph) & full
            down = ph & xv
            if score - (stop - i - 1) >= best:
                break  # what is left cannot bring the score low enough
        return (best, where) if where >= 0 else None


class Matcher:
    """All items of a block."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float):
        self.ids: list[int | None] = []
        self.patterns: list[Pattern] = []
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, item in items:
            number = len(self.ids)
            self.ids.append(item_id)
            errors = budget(len(item), rate) if len(item) >= SHORT_CHARS else 0
            self.patterns.append(Pattern(item, errors))
            for offset, piece in pieces_of(item, errors):
                places[piece].append((number, offset))
        self.tree = ahocorasick.Automaton()
        for piece, where in places.items():
            self.tree.add_word(piece, (len(piece), where))
        if places:
            self.tree.make_automaton()
        self.any = bool(places)

    def of(self, text: str) -> dict[int, tuple[int, int]]:
        """item number -> (fewest edits, start of the match's window) in the folded text."""
        found: dict[int, tuple[int, int]] = {}
        if not self.any:
            return found
        windows: dict[int, set[int]] = defaultdict(set)
        for end, (length, where) in self.tree.iter(text):
            for number, offset in where:
                if len(self.patterns[number].item) < SHORT_CHARS:  # the piece is the item
                    if number not in found and between_edges(text, end + 1 - length, end + 1):
                        found[number] = (0, end + 1 - length)
                    continue
                windows[number].add(end + 1 - length - offset)
        for number, starts in windows.items():
            pattern = self.patterns[number]
            k, m = pattern.errors, len(pattern.item)
            best: tuple[int, int] | None = None
            begin = last = None
            for s in [*sorted(starts), None]:  # windows that overlap are searched as one
                if begin is None:
                    begin = last = s
                    continue
                if s is not None and s - k <= last + m + k and s - begin < 8 * m:
                    last = s
                    continue
                lo = max(0, begin - k)
                got = pattern.search(text, lo, min(len(text), last + m + k))
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], max(0, got[1] - m))
                begin = last = s
            if best:
                found[number] = best
        return found


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> Iterator[list]:
    """The folded items in blocks of at most ``block_chars`` characters or one item; one block is held at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_id).cast("long"), F.col(text).cast("string")).toLocalIterator():
        item = folded(row[1])
        if not item:
            continue
        if block and size + len(item) > block_chars:
            yield block
            block, size = [], 0
        block.append((row[0], item))
        size += len(item)
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, errors, budget, position) for every document and item that match; the best place of each pair."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = None
    for block in item_blocks(benchmark, block_chars=block_chars):
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def piece(batch: pa.RecordBatch, shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            matcher = worker_memory(name, lambda: Matcher(shared.value, rate))
            out = [
                (d, matcher.ids[n], errors, matcher.patterns[n].errors, at)
                for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                for n, (errors, at) in (matcher.of(folded(t)) if t else {}).items()
            ]
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "errors", "budget", "position"])

        part = rows.mapInArrow(lambda b, piece=piece, name=name: in_batches(b, piece, keeps=name), SCHEMA)
        found = part if found is None else found.unionAll(part)
    return spark.createDataFrame([], SCHEMA) if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, text: str = "text") -> DataFrame:
    """``docs`` without the rows that match an item, decided where the rows stand."""
    spark = docs.sparkSession
    for block in item_blocks(benchmark):
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def piece(batch: pa.RecordBatch, shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            matcher = worker_memory(name, lambda: Matcher(shared.value, rate))
            keep = [not (t and matcher.of(folded(t))) for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(lambda b, piece=piece, name=name: in_batches(b, piece, keeps=name), docs.schema)
    return docs
