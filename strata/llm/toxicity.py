"""Toxicity by class-conditional Kneser-Ney models.

Two models, toxic and ordinary, give the probability of each character of a word after the
characters before it (orders 1 to ``ORDER``, with word boundaries).  Each class has its own
discounted counts for orders 3 and up, and both share the continuation counts of orders 1
and 2, so an expression that is rare in both classes is smoothed alike and does not tip the
balance.  A toxic text is mostly ordinary words, so its word model is the toxic one mixed
with the ordinary one.  A document's evidence is the difference of the two log-likelihoods
divided by the words scored; a logistic curve fitted on labelled rows the counts have not seen turns
it into a score.

Labels are learnt from at most ``MAX_LABELLED`` labelled rows (chosen by a hash of the id),
which bounds the model; scoring covers every whole text.

Defined cases: NULL, empty and word-free texts have no evidence (0) and get the curve's value
there; very long texts and runs of letters are scored whole; other columns are not looked at,
whatever their names; NULL ids are scored but never learnt from; repeated labels count once, and toxic if any
is; without rows of both classes every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_remainder, in_batches, small_batches, worker_memory

ORDER = 6
#: Orders up to this one are shared by both classes.
SHARED_ORDER = 2
#: A toxic text is mostly ordinary words: its word model gives this share to toxic expressions, the rest to the ordinary model.
TOXIC_SHARE = 0.05
#: Labelled rows the models may be fitted on; the model's size is bounded by it.
MAX_LABELLED = 40_000
TOKEN = re.compile(r"[^\W\d_]+")
#: Characters taken at once; longer runs of letters go in slices that overlap by a context, with the same result.
SLICE = 4_096
#: Words of up to this many characters are remembered.
SHORT = 64
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, evidence double"
_MUL = np.uint64(0x9E3779B97F4A7C15)


def expressions(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    return TOKEN.findall(text.lower()) if text else []


def slices(word: str) -> Iterator[tuple[str, int]]:
    """(part, starts) of a word opened by \\x02 and closed by \\x03: every n-gram of the word starts among the
    first ``starts`` characters of one part, which holds it whole."""
    marked = f"\x02{word}\x03"
    for at in range(0, len(marked), SLICE):
        yield marked[at : at + SLICE + ORDER - 1], min(SLICE, len(marked) - at)


def _codes(words: list[str], whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """All characters in a row, each word opened by \\x02 and closed by \\x03 if they are ``whole``; per character its place in the word."""
    parts = [f"\x02{w}\x03" for w in words] if whole else words
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return codes, np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _hashes(codes: np.ndarray, place: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that have ``order`` characters of their word up to and with themselves, and the hash of these."""
    at = np.flatnonzero(place >= order - 1)
    h = np.zeros(len(at), np.uint64)
    for back in range(order - 1, -1, -1):
        h = (h ^ codes[at - back]) * _MUL
        h ^= h >> np.uint64(29)
    return at, h


@dataclass
class Model:
    """Per order: sorted n-gram hashes with discounted probabilities, sorted context hashes with backoff weights."""

    grams: list[tuple[np.ndarray, np.ndarray]]  # hashes, (n, 2) float64
    contexts: list[tuple[np.ndarray, np.ndarray]]
    alphabet: int

    def log_ratio(self, words: list[str]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) for each word, the toxic side mixed with the ordinary one."""
        short = [w for w in words if len(w) < SLICE]
        likely = dict(zip(short, self._sums([f"\x02{w}\x03" for w in short]).tolist()))
        for w in words:
            if w not in likely:
                marked, total = f"\x02{w}\x03", 0.0
                for at in range(0, len(marked), SLICE):
                    given = min(at, ORDER - 1)  # characters that are context only
                    total += float(self._sums([marked[at - given : at + SLICE]], max(1, given))[0])
                likely[w] = total
        word = np.array([likely[w] for w in words])
        return np.logaddexp(np.log1p(-TOXIC_SHARE), np.log(TOXIC_SHARE) + word)

    def _sums(self, parts: list[str], given: int = 1) -> np.ndarray:
        """Per part the log ratio of its characters after the first ``given`` ones."""
        if not parts:
            return np.zeros(0)
        codes, place = _codes(parts, whole=False)
        prob = np.full((len(codes), 2), 1.0 / self.alphabet)
        for order, ((keys, value), (ctx, back)) in enumerate(zip(self.grams, self.contexts), 1):
            at, h = _hashes(codes, place, order)
            if order == 1:
                weight = np.broadcast_to(back[0], (len(at), 2))
            else:
                # the context of a position is the (order-1)-gram that ends just before it
                before, hc = _hashes(codes, place, order - 1)
                hc = hc[np.searchsorted(before, at - 1)]
                weight = _look(ctx, back, hc, 1.0)
            prob[at] = _look(keys, value, h, 0.0) + weight * prob[at]
        ratio = np.log(prob[:, 0]) - np.log(prob[:, 1])
        ratio[place < given] = 0.0
        return np.add.reduceat(ratio, np.flatnonzero(place == 0))


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    out = np.full((len(wanted), 2), missing)
    if len(keys):
        i = np.searchsorted(keys, wanted)
        i[i == len(keys)] = 0
        hit = keys[i] == wanted
        out[hit] = values[i[hit]]
    return out


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, toxic, fold) of labelled rows that may be learnt from, at most about ``max_rows`` of them."""
    marks = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .filter(id_remainder("doc_id", 5) != 0)
        .groupBy(F.col("doc_id").cast("long").alias("__id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    n = marks.count()
    spread = F.pmod(F.xxhash64("__id", F.lit(17)), F.lit(1_000_000))
    if n > max_rows:
        marks = marks.filter(spread < int(1_000_000 * max_rows / n))
    marks = marks.withColumn("fold", F.pmod(F.xxhash64("__id", F.lit(23)), F.lit(4)).cast("int"))
    if min(n, max_rows) <= 50_000:  # at most 50,000 rows of 16 bytes
        marks = F.broadcast(marks)
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("text"))
    return texts.join(marks, "__id").select("__id", "text", "toxic", "fold")


def gram_counts(rows: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary): weighted character n-grams of the rows' expressions, counted by Spark."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for w in expressions(text):
                    seen.setdefault(w, [0, 0])[1 - toxic] += 1
            cut = [(part, starts, *n) for w, n in seen.items() for part, starts in slices(w)]
            columns = list(zip(*cut)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                names=["part", "starts", "toxic", "ordinary"],
            )

        yield from in_batches(batches, piece, 1 << 20)

    counted = rows.select("text", "toxic").mapInArrow(words, "part string, starts int, toxic long, ordinary long")
    counted = counted.groupBy("part", "starts").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(ORDER)),
            lambda k: F.filter(
                F.transform(F.sequence(F.lit(1), F.col("starts")), lambda i: F.substring("part", i, k)),
                lambda g: F.length(g) == k,
            ),
        )
    )
    return (
        counted.select(F.explode(grams).alias("gram"), "toxic", "ordinary")
        .groupBy("gram")
        .agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    )


def fit(rows: DataFrame) -> Model:
    """Kneser-Ney tables from the n-gram counts of bounded labelled rows."""
    with small_batches(rows.sparkSession):
        got = gram_counts(rows).toArrow()
    grams = got.column("gram").to_pylist()
    raw = np.stack([got.column("toxic").to_numpy(), got.column("ordinary").to_numpy()], axis=1).astype(float)
    index = {g: i for i, g in enumerate(grams)}
    size = np.array([len(g) for g in grams])
    # continuation counts: how many different characters stand before a gram
    cont = np.zeros_like(raw)
    shared = np.zeros(len(grams))
    for i, g in enumerate(grams):
        if len(g) > 1:
            j = index[g[1:]]
            cont[j] += raw[i] > 0
            shared[j] += 1
    opened = np.array([g[0] == "\x02" for g in grams], bool)
    model = Model([], [], max(2, int((size == 1).sum())))
    for order in range(1, ORDER + 1):
        at = np.flatnonzero(size == order)
        if order == ORDER:
            n = raw[at]
        elif order <= SHARED_ORDER:
            n = np.where(opened[at], raw[at].sum(1), shared[at])[:, None].repeat(2, 1)
        else:
            n = np.where(opened[at][:, None], raw[at], cont[at])
        names = [grams[i] for i in at]
        keep = np.array([not (order == 1 and g == "\x02") for g in names], bool)  # the opener is given, never predicted
        names, n = [g for g, k in zip(names, keep) if k], n[keep]
        ones, twos = (n == 1).sum(0), (n == 2).sum(0)
        discount = np.clip(ones / np.maximum(1, ones + 2 * twos), 0.1, 0.95)
        contexts: dict[str, int] = {}
        owner = np.array([contexts.setdefault(g[:-1], len(contexts)) for g in names], np.int64)
        total = np.zeros((len(contexts), 2))
        kinds = np.zeros((len(contexts), 2))
        np.add.at(total, owner, n)
        np.add.at(kinds, owner, n > 0)
        safe = np.maximum(total, 1e-9)
        value = np.maximum(n - discount, 0) / safe[owner]
        back = np.where(total > 0, discount * kinds / safe, 1.0)
        model.grams.append(_sorted(names, value))
        model.contexts.append(_sorted(list(contexts), back) if order > 1 else (np.zeros(1, np.uint64), back if len(back) else np.ones((1, 2))))
    return model


def _sorted(names: list[str], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not names:
        return np.zeros(0, np.uint64), np.zeros((0, 2))
    codes = np.frombuffer("".join(names).encode("utf-32-le"), "<u4").astype(np.uint64).reshape(len(names), -1)
    h = np.zeros(len(names), np.uint64)
    for k in range(codes.shape[1]):
        h = (h ^ codes[:, k]) * _MUL
        h ^= h >> np.uint64(29)
    order = np.argsort(h)
    return h[order], values[order]


class Evidence:
    """Length-normalised log-likelihood difference; remembers the words it has scored, up to ``limit``."""

    def __init__(self, model: Model, limit: int = 200_000):
        self.model, self.limit, self.known = model, limit, {}

    def of(self, texts: list[str | None]) -> np.ndarray:
        split = [expressions(t) for t in texts]
        fresh = list({w for words in split for w in words} - self.known.keys())
        if len(self.known) + len(fresh) > self.limit:
            self.known = {}
            fresh = list({w for words in split for w in words})
        for start in range(0, len(fresh), 50_000):
            part = fresh[start : start + 50_000]
            self.known.update(zip(part, self.model.log_ratio(part).tolist()))
        get = self.known.__getitem__
        out = np.array([sum(map(get, ws)) / len(ws) if ws else 0.0 for ws in split])
        for w in fresh:
            if len(w) > SHORT:
                del self.known[w]
        return out


def evidence_of(rows: DataFrame, shared, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` and ``__evidence``, from their ``text``."""
    fields = [rows.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", __evidence double"
    name = uuid.uuid4().hex

    def piece(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scored = worker_memory(name, lambda: Evidence(shared.value)).of(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(scored)], names=[*keep, "__evidence"])

    return rows.select(*keep, *[c for c in ["text"] if c not in keep]).mapInArrow(lambda batches: in_batches(batches, piece, keeps=name), schema)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a weak pull on the standardised slope."""
    centre, spread = x.mean(), x.std() or 1.0
    z = np.stack([(x - centre) / spread, np.ones_like(x)], 1)
    w = np.zeros(2)
    pull = np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + pull, z.T @ (y - p) - pull @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w[0] / spread, w[1] - w[0] * centre / spread


def score(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for every document; one scan after the fit."""
    spark = docs.sparkSession
    rows = training_rows(docs, labels, max_rows)
    model = fit(rows.filter("fold < 3"))
    shared = spark.sparkContext.broadcast(model)
    with small_batches(spark):
        seen = evidence_of(rows.filter("fold = 3"), shared, ["toxic"]).toArrow()
    y = seen.column("toxic").to_numpy().astype(float)
    both = len(y) and 0 < y.sum() < len(y)
    slope, offset = logistic(seen.column("__evidence").to_numpy(), y) if both else (0.0, -30.0)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = evidence_of(texts, shared, ["doc_id"])
    value = F.lit(0.0) if not both else 1 / (1 + F.exp(-(F.lit(float(slope)) * F.col("__evidence") + F.lit(float(offset)))))
    held = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        value.alias("score"),
        F.when(value >= 0.5, 1).otherwise(0).alias("predicted"),
        F.col("__evidence").alias("evidence"),
    )


def clean(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """``docs`` without the rows predicted toxic, columns unchanged; scored where the rows stand, without a join."""
    spark = docs.sparkSession
    rows = training_rows(docs, labels, max_rows)
    shared = spark.sparkContext.broadcast(fit(rows.filter("fold < 3")))
    with small_batches(spark):
        seen = evidence_of(rows.filter("fold = 3"), shared, ["toxic"]).toArrow()
    y = seen.column("toxic").to_numpy().astype(float)
    if not (len(y) and 0 < y.sum() < len(y)):
        return docs
    slope, offset = logistic(seen.column("__evidence").to_numpy(), y)
    names = docs.columns
    scored = evidence_of(docs.withColumn("text", F.col("text").cast("string")), shared, names)
    return scored.filter(F.lit(float(slope)) * F.col("__evidence") + F.lit(float(offset)) < 0).select(*names)
