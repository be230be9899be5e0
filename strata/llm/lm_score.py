"""Language-model scores by a weighted backoff automaton, with counts of the whole corpus.

The model is an interpolated bigram model, P(v | u) = (c(uv) + K P1(v)) / (c(u) + K), with
P1(v) = (c(v) + 1) / (N + V + 1).  As an automaton: every word is a state; a bigram that
occurred is an arc with weight log P(v | u); a failure arc of weight log(K / (c(u) + K)) leads
from u to the root, whose arcs carry log P1.  Scoring walks a document once from left to right.

No task ever holds the whole model.  Consecutive documents of a partition make blocks of
about ``BLOCK_TOKENS`` tokens.  A block asks for the counts of the n-grams it holds: packed
hash arrays go to ``buckets`` of the hash space, which add them up over all blocks, and the
totals that other blocks changed come back as one file per block.  Beside its own counts a
block then has every state and arc that its documents can reach.

Defined cases: NULL, empty and word-free texts are the end token alone; a NULL id is held in
no fold, so its text is learnt from; repeated rows count each; without training documents
N = V = 0 and every token has probability 1; an empty table gives an empty result; texts are
scored whole; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WordHashes, id_remainder, in_batches, mixed, stored
from strata.llm.store import located, put
from strata.runtime import scratch_path

#: Documents whose crc32(id) has this remainder are not learnt from.
MODULUS, HELD_OUT = 7, 2
#: Weight of the unigram model, in observations of a word as a context.
K = 1000.0
BLOCK_TOKENS = 4_000_000
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_MUL = np.uint64(0x9E3779B97F4A7C15)
#: Hashes that stand for the end of a document and for what is before its first word.
END, BEGIN = np.uint64(0x656E64), np.uint64(0x626567)
UNIGRAM, BIGRAM, TOTALS = 0, 1, 2


def _pack(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending hashes as differences of as many bytes as the largest needs; counts from 255 on apart."""
    wide = counts >= 255
    small = zlib.compress(np.where(wide, 255, counts).astype(np.uint8).tobytes(), 1)
    large = counts[wide].astype("<u8").tobytes()
    base = hashes[:1].astype("<u8")
    steps = np.diff(hashes).astype("<u8")
    width = (int(steps.max()).bit_length() + 7) // 8 if len(steps) else 0
    packed = steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    head = np.array([len(hashes), width, len(small)], "<u8").tobytes()
    return b"".join([head, base.tobytes(), packed, small, large])


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width, size = (int(x) for x in np.frombuffer(blob, "<u8", 3))
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = 32 + (n - 1) * width
    steps = np.zeros((n, 8), np.uint8)
    steps[0] = np.frombuffer(blob, np.uint8, 8, 24)
    steps[1:, :width] = np.frombuffer(blob, np.uint8, (n - 1) * width, 32).reshape(n - 1, width)
    hashes = np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)
    counts = np.frombuffer(zlib.decompress(blob[at : at + size]), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(blob, "<u8", offset=at + size).astype(np.int64)
    return hashes, counts


def _ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct values, place of each value among them)."""
    order = np.argsort(values)
    ranked = values[order]
    first = np.append(True, ranked[1:] != ranked[:-1])
    distinct = ranked[first]
    del ranked
    place = np.empty(len(values), np.int32)
    place[order] = np.cumsum(first, dtype=np.int32) - 1
    return distinct, place


def _slices(n: int, step: int = 250_000) -> Iterator[slice]:
    return (slice(i, min(n, i + step)) for i in range(0, n, step))


class Block:
    """The tokens of consecutive documents: each a place among the block's distinct words, and among its distinct bigrams."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.held: list[bool] = []
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, held: bool, hashes: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.held.append(held)
        self.parts.append(np.append(hashes, END))
        self.size += len(hashes) + 1

    def close(self) -> Block:
        self.lengths = np.array([len(p) for p in self.parts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.learnt = np.repeat(~np.array(self.held, bool), self.lengths)
        tokens = np.concatenate(self.parts)
        self.parts = []
        bigrams = np.empty_like(tokens)
        bigrams[1:] = tokens[:-1]
        bigrams[self.starts] = BEGIN
        # scrambled, both spread over the buckets in order
        for i in _slices(len(tokens)):
            bigrams[i] = mixed((mixed(bigrams[i]) ^ tokens[i]) * _MUL)
            tokens[i] = mixed(tokens[i])
        self.bigrams, self.bigram_at = _ranked(bigrams)
        del bigrams
        self.words, self.word_at = _ranked(tokens)
        return self

    def counts(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct n-grams of all documents, with how often the learnt ones hold them."""
        grams, place = (self.words, self.word_at) if kind == UNIGRAM else (self.bigrams, self.bigram_at)
        total = np.zeros(len(grams), np.int64)
        for i in _slices(len(place)):
            learnt, times = np.unique(place[i][self.learnt[i]], return_counts=True)
            total[learnt] += times
        return grams, total

    def groups(self, least: int = 100_000) -> Iterator[tuple[slice, slice]]:
        """(documents, tokens) of stretches of whole documents with at least ``least`` tokens."""
        ends = self.starts + self.lengths
        at = 0
        while at < len(ends):
            stop = min(len(ends), int(np.searchsorted(ends, self.starts[at] + least)) + 1)
            yield slice(at, stop), slice(int(self.starts[at]), int(ends[stop - 1]))
            at = stop

    def mark(self) -> int:
        """What tells this block from one cut in another way."""
        return zlib.crc32(self.lengths.astype("<i8").tobytes(), zlib.crc32(repr(self.ids).encode()))


def blocks(batches: Iterator[pa.RecordBatch], block_tokens: int) -> Iterator[tuple[int, Block]]:
    """(number, block) of a partition (doc_id, held_out, text binary)."""
    part = TaskContext.get().partitionId()
    words, seq, block = WordHashes(100_000), 0, Block()

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch

    for batch in in_batches(batches, whole):
        for d, h, t in zip(*[c.to_pylist() for c in batch.columns]):
            block.add(d, h, words.of(t.lower().split()) if t else np.zeros(0, np.uint64))
            if block.size >= block_tokens:
                yield (part << 20) + seq, block.close()
                seq, block = seq + 1, Block()
    if block.ids:
        yield (part << 20) + seq, block.close()


def exchange_counts(rows: DataFrame, folder: str, buckets: int, block_tokens: int) -> DataFrame:
    """Add the blocks' counts over the corpus and write to ``folder`` a file per block with what others changed.

    Returns the stored (n_tokens, n_types) of each bucket's share of the training tokens.
    """
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in blocks(batches, block_tokens):
            out = []
            for kind in (UNIGRAM, BIGRAM):
                grams, counts = block.counts(kind)
                cuts = np.searchsorted(grams >> shift, np.arange(buckets + 1, dtype=np.uint64))
                out += [(kind, i, number, _pack(grams[a:b], counts[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            out.append((TOTALS, number % buckets, number, np.array([block.mark()], "<u8").tobytes()))
            yield _rows(out)

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, bucket = key[0].as_py(), key[1].as_py()
        numbers, blobs = [], []
        for batch in batches:
            numbers += batch.column("block").to_pylist()
            blobs += batch.column("grams").to_pylist()
        if kind == TOTALS:
            yield _rows([(kind, bucket, n, b) for n, b in zip(numbers, blobs)])
            return
        parts = [_unpack(b) for b in blobs]
        grams = np.concatenate([p[0] for p in parts])
        counts = np.concatenate([p[1] for p in parts])
        order = np.argsort(grams, kind="stable")
        first = np.append(True, grams[order][1:] != grams[order][:-1])
        total = np.add.reduceat(counts[order], np.flatnonzero(first))
        answer = np.empty(len(grams), np.int64)
        answer[order] = total[np.cumsum(first) - 1]
        out, at = [], 0
        for number, (own, count) in zip(numbers, parts):
            got = answer[at : at + len(own)]
            at += len(own)
            new = got != count
            if new.any():
                out.append((kind, bucket, number, _pack(own[new], got[new])))
        if kind == UNIGRAM:
            out.append((kind, bucket, -1, np.array([total.sum(), (total > 0).sum()], "<u8").tobytes()))
        yield _rows(out)

    def deliver(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = key[0].as_py()
        found: dict[int, list[bytes]] = {UNIGRAM: [], BIGRAM: [], TOTALS: []}
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("grams").to_pylist()):
                found[kind].append(blob)
        if number < 0:
            sums = np.array([np.frombuffer(b, "<u8") for b in found[UNIGRAM]]).astype(np.int64).sum(0).tolist()
        else:
            sums = [0, 0]
            data = [found[TOTALS][0]]
            for kind in (UNIGRAM, BIGRAM):
                parts = [_unpack(b) for b in found[kind]] or [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
                grams, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                order = np.argsort(grams)
                packed = _pack(grams[order], counts[order])
                data += [np.array([len(packed)], "<u8").tobytes(), packed]
            put(folder, f"block-{number}", data)
        yield pa.RecordBatch.from_pydict({"n_tokens": pa.array([sums[0]], pa.int64()), "n_types": pa.array([sums[1]], pa.int64())})

    schema = "kind int, bucket int, block long, grams binary"
    asked = rows.mapInArrow(ask, schema)
    answered = asked.groupBy("kind", "bucket").applyInArrow(add, schema)
    return stored(answered.groupBy("block").applyInArrow(deliver, "n_tokens long, n_types long"), "lm-totals")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kind, bucket, block, grams = zip(*out) if out else ([], [], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(block, pa.int64()), pa.array(grams, pa.binary())],
        names=["kind", "bucket", "block", "grams"],
    )


class Automaton:
    """The part of the model that one block can reach, with weights (log10).

    A state for each word and one for the beginning; the arcs of a state by their bigrams; the
    failure arc of a state leads to the root, which has an arc for each word.
    """

    def __init__(self, c: np.ndarray, c2: np.ndarray, n: int, v: int, begins: int, k: float = K):
        self.k, self.known = k, c > 0
        self.chance = (c + 1) / float(n + v + 1)  # of a word at the root
        self.left = np.append(c, begins) + k  # how often each state was left in training; the begin state is the last
        self.failure = np.log10(k / self.left)
        self.root = np.log10(self.chance)
        self.arcs = c2

    @classmethod
    def of(cls, block: Block, folder: str, number: int, n: int, v: int, begins: int, k: float = K) -> Automaton:
        system, path = located(folder)
        with system.open_input_stream(f"{path}/block-{number}") as f:
            data = f.read()
        if int(np.frombuffer(data, "<u8", 1)[0]) != block.mark():
            raise RuntimeError("the rows came in other partitions than when they were counted; pass stable=False")
        tables, at = [], 8
        for kind in (UNIGRAM, BIGRAM):
            size = int(np.frombuffer(data, "<u8", 1, at)[0])
            grams, totals = _unpack(data[at + 8 : at + 8 + size])
            at += 8 + size
            own, counts = block.counts(kind)
            counts[np.searchsorted(own, grams)] = totals
            tables.append(counts)
        return cls(*tables, n, v, begins, k)

    def walk(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per document: its known tokens, its weight at the root and the weight of its path.

        A token leads to the state of its word, so the state that each token starts from is known
        and the steps of many documents are taken at once: along the state's arc where there is
        one, else along its failure arc and the root's arc.
        """
        n = len(block.lengths)
        known, base, path = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for docs, tokens in block.groups():
            word, first = block.word_at[tokens], block.starts[docs] - block.starts[docs.start]
            state = np.empty_like(word)
            state[1:] = word[:-1]
            state[first] = len(self.left) - 1
            times = self.arcs[block.bigram_at[tokens]]
            step = self.failure[state] + self.root[word]
            arc = np.flatnonzero(times)
            step[arc] = np.log10((times[arc] + self.k * self.chance[word[arc]]) / self.left[state[arc]])
            known[docs] = np.add.reduceat(self.known[word].astype(np.int64), first)
            base[docs] = np.add.reduceat(self.root[word], first)
            path[docs] = np.add.reduceat(step, first)
        return known, base, path


def score(docs: DataFrame, stable: bool = False, block_tokens: int = BLOCK_TOKENS, k: float = K, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    ``stable`` says that ``docs`` gives the same rows in the same partitions each time, as a plain
    scan of files does; otherwise the rows are stored first.  A difference is found and raised.
    """
    spark = docs.sparkSession
    held = F.coalesce(id_remainder(key, MODULUS) == HELD_OUT, F.lit(False))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text).cast("binary").alias("text"))
    if not stable:
        rows = stored(rows, "lm-rows")
    folder = scratch_path(spark, "lm-blocks")
    buckets = 1 << max(4, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    totals = exchange_counts(rows, folder, buckets, block_tokens).agg(F.sum("n_tokens"), F.sum("n_types")).first()
    n, v = totals[0] or 0, totals[1] or 0
    begins = rows.filter("NOT held_out").count()  # every learnt document leaves the begin state once

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in blocks(batches, block_tokens):
            known, base, path = Automaton.of(block, folder, number, n, v, begins, k).walk(block)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(block.ids, pa.int64()),
                    "held_out": pa.array(block.held, pa.bool_()),
                    "n_tokens": pa.array(block.lengths),
                    "n_known": pa.array(known),
                    "train_tokens": pa.array(np.full(len(block.ids), n, np.int64)),
                    "base_score": pa.array(base),
                    "score": pa.array(path),
                }
            )

    return rows.mapInArrow(walk, SCHEMA)
