"""Runs of consecutively repeated words, found in one pass from left to right.

A run is a stretch of words with smallest period q and at least max(6, 4 q) words that no
neighbour extends.  Word i lies on the diagonal of lag q while word i equals word i - q; the
number of words in a row that do so is the diagonal's length.  The pass keeps the lengths of
the active lags only: a word's earlier occurrences increment their lags, a lag that the word
does not carry on has ended, and its run is emitted there and then if it is long enough.

Most earlier occurrences can never lead to a run, so each word looks up only those that agree
in the words before it as well.  A run of lag q needs 3 q equal words in a row (5 for q = 1),
so the lags from Q to below 1.5 Q ask for the last 3 Q words to occur again, and the nearest
such occurrence decides: if its lag d is smaller than the lag q of another one, d and q both
are periods of those 3 Q words, d + q <= 3 Q, hence gcd(d, q) is one too, and q is no smallest
period.  A word thus carries at most one lag of each class, and a text of n words takes
O(n log n) steps, be it one word n times over.  Contexts are compared by 64-bit hashes.

Defined cases: NULL, empty and blank texts have no words and no runs; a NULL id is kept as it
is; repeated rows give a row each; very long texts are taken whole; of runs with the same
exponent the one that starts first, then the one with the smaller period, is the greatest; an
empty table gives an empty result; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import in_batches, mixed

#: A run has at least this many words, and this many times its period.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Any odd number; contexts are compared by a polynomial in it, modulo 2^64.
BASE = 0x9E3779B97F4A7C15
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

Run = tuple[int, int, int]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def lag_classes(longest: int) -> Iterator[tuple[int, int, int]]:
    """(first lag, end of lags, words of context) up to the lags that fit ``longest`` words."""
    first = 1
    while LEAST_PERIODS * first <= longest:
        end = max(first + 1, -(-3 * first // 2))
        yield first, end, max(LEAST_WORDS - first, (LEAST_PERIODS - 1) * first)
        first = end


class _Contexts:
    """Hashes of any stretch of words by prefix sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers = np.full(n + 1, BASE, np.uint64)
        powers[0] = 1
        inverse = np.full(n + 1, pow(BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.back = np.cumprod(inverse)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * np.cumprod(powers)[:n], out=self.sums[1:])

    def ending_at(self, last: np.ndarray, words: int) -> np.ndarray:
        first = last + 1 - words
        return mixed((self.sums[last + 1] - self.sums[first]) * self.back[first])


def _nearest(places: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, lag to the nearest earlier one of equal hash; all places whose hash occurs twice), ``places`` ascending."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    again = ranked[1:] == ranked[:-1]
    later, earlier = places[order[1:][again]], places[order[:-1][again]]
    shared = np.zeros(len(order), bool)
    shared[1:] = again
    shared[:-1] |= again
    return later, later - earlier, np.sort(places[order[shared]])


def occurrences(texts: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """(place, lag, words of context) of what each word's earlier occurrences carry on, by place.

    Places count all texts in a row, with one place between two texts.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    spans = sizes + 1
    ends = np.cumsum(spans)
    total = int(ends[-1]) if len(ends) else 0
    owner = np.repeat(np.arange(len(texts)), spans)
    numbers = np.empty(total, np.int64)
    inside = np.ones(total, bool)
    inside[ends - 1] = False
    numbers[inside] = np.fromiter((w for t in texts for w in t), np.int64, int(sizes.sum()))
    numbers[~inside] = -1
    contexts = _Contexts(mixed((numbers + 2).astype(np.uint64)))
    salt = mixed(np.arange(1, len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    start = (ends - spans)[owner]
    found: list[tuple[np.ndarray, np.ndarray, int]] = []
    places = np.flatnonzero(inside)
    for first, end, words in lag_classes(int(sizes.max(initial=0))):
        places = places[places - start[places] >= words - 1]
        if not len(places):
            break
        later, lags, places = _nearest(places, contexts.ending_at(places, words) ^ salt[owner[places]])
        wanted = (lags >= first) & (lags < end)
        if wanted.any():
            found.append((later[wanted], lags[wanted], words))
    if not found:
        return [], [], []
    at = np.concatenate([f[0] for f in found])
    lag = np.concatenate([f[1] for f in found])
    words = np.repeat([f[2] for f in found], [len(f[0]) for f in found])
    order = np.argsort(at, kind="stable")
    return at[order].tolist(), lag[order].tolist(), words[order].tolist()


def online_runs(events: Iterable[tuple[int, int, int]]) -> Iterator[Run]:
    """(start, length, period) of each run, as soon as its diagonal ends.

    ``events`` holds, from left to right, the lags that each word carries on, with the length
    that a diagonal has when it is first met.
    """
    before: dict[int, int] = {}  # length of each lag that was active at the word before
    now: dict[int, int] = {}
    at = -2

    def ended(lengths: dict[int, int], end: int) -> Iterator[Run]:
        for lag, length in lengths.items():
            if length >= max(LEAST_WORDS - lag, (LEAST_PERIODS - 1) * lag):
                yield end - length - lag, length + lag, lag

    for place, lag, context in events:
        if place != at:
            yield from ended(before, at)
            if place == at + 1:
                before, now = now, {}
            else:
                yield from ended(now, at + 1)
                before, now = {}, {}
            at = place
        now[lag] = before.pop(lag, context - 1) + 1
    yield from ended(before, at)
    yield from ended(now, at + 1)


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text, by start, then period."""
    number = _Numbers().__getitem__
    offsets, total = [], 0
    for text in texts:
        offsets.append(total)
        total += len(text) + 1
    found: list[list[Run]] = [[] for _ in texts]
    starts = np.array(offsets, np.int64)
    for start, length, period in online_runs(zip(*occurrences([list(map(number, t)) for t in texts]))):
        i = int(np.searchsorted(starts, start, "right")) - 1
        found[i].append((start - offsets[i], length, period))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run repeats: of each run its first period stays, unless another run drops it."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def collapse(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs, and its text with each run cut to one period.

    ``rewrite`` may change the words of a row first.  One pass without a shuffle; a task holds
    a few megabytes of texts, or one text.
    """

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0).to_pylist()
        texts = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
        if rewrite:
            texts = [rewrite(i, words) for i, words in zip(ids, texts)]
        found = runs_of(texts)
        names = ("start", "length", "period")
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0),
                "n_words": pa.array([len(words) for words in texts], pa.int64()),
                "runs": pa.array([[dict(zip(names, r)) for r in runs] for runs in found], _RUN),
                "collapsed": pa.array([b" ".join(kept_words(w, r)) for w, r in zip(texts, found)], pa.binary()).cast(pa.string()),
            }
        )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: in_batches(batches, scan), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The rewriting of the contract: every tenth id by checksum goes on periodically from a word on."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * -(-(n - a) // p))[: n - a]


def _greatest(runs: Column) -> Column:
    """The run of greatest exact length / period; the runs are by start, then period, so the first one wins ties."""

    def better(best: Column, run: Column) -> Column:
        return F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)


def digest(found: DataFrame) -> DataFrame:
    """What the contract asks of ``collapse``: counts, the greatest run, and checksums of runs and text."""
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = found.withColumn("best", F.when(F.size("runs") > 0, _greatest(F.col("runs"))))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
