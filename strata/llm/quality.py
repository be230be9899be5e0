"""Quality rules as a short-circuit cascade.

Each rule is a test over the measures of a document.  A random sample of the whole table, taken
and timed where the rows stand, gives every rule its cost beyond what the base has measured and
the share it rejects of the documents that pass the base; rules are then tried by rejection per
cost, best first, and a document that one rule rejects is not shown to the next.  The order
changes the time only: a document is kept when no rule rejects it.  As it rests on measured
times, the rule that rejected first is named only under an order that the caller gives.

Defined cases: NULL and empty texts have no words and fail the base; a text of white space
alone likewise; very long texts are measured whole; an empty table gives an empty result;
repeated rows get equal answers; NULL ids are reported as NULL; other columns are not looked
at, whatever their names.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import in_batches

#: Rows of the sample that orders the rules, about; it never decides a verdict.
SAMPLE_ROWS = 2000
SEED = 8
MIN_WORDS = 50
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean"
)


class Doc:
    """One text with what has been measured of it; each measure is taken once, when first asked for."""

    __slots__ = ("text", "words", "_repeat", "_lines", "_dup", "_symbols", "_chars")

    def __init__(self, text: str):
        self.text = text
        self.words = WORD.findall(text)
        self._repeat = self._lines = self._dup = self._symbols = self._chars = None

    def word_chars(self) -> int:
        if self._chars is None:
            self._chars = len("".join(self.words))
        return self._chars

    def symbols(self) -> int:
        if self._symbols is None:
            self._symbols = len(SYMBOLS.findall(self.text))
        return self._symbols

    def dup_lines(self) -> int:
        if self._dup is None:
            lines = [x for x in self.text.split("\n") if WORD.search(x)]
            self._lines = len(lines)
            self._dup = len(lines) - len(set(lines))
        return self._dup

    def lines(self) -> int:
        self.dup_lines()
        return self._lines

    def repeat_words(self) -> int:
        """Words inside a 3-word window that occurs twice or more."""
        if self._repeat is None:
            n = len(self.words)
            self._repeat = 0
            if n >= 4:
                number: dict[str, int] = {}
                ids = np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, n)
                base = len(number)
                pairs = ids[:-2] * base + ids[1:-1]
                if base**3 < 2**63:
                    windows = pairs * base + ids[2:]
                else:  # number the pairs first, so that the product fits
                    windows = np.unique(pairs, return_inverse=True)[1].astype(np.int64) * base + ids[2:]
                order = np.argsort(windows, kind="stable")
                same = windows[order[1:]] == windows[order[:-1]]
                twice = np.zeros(n - 2, bool)
                twice[order[1:]] |= same
                twice[order[:-1]] |= same
                covered = np.zeros(n, bool)
                covered[:-2] |= twice
                covered[1:-1] |= twice
                covered[2:] |= twice
                self._repeat = int(covered.sum())
        return self._repeat


def _alphabetic(doc: Doc) -> bool:
    return sum(1 for w in doc.words if w.isalpha() or any(map(str.isalpha, w))) < 0.7 * len(doc.words)


def _top_word(doc: Doc) -> bool:
    return Counter(doc.words).most_common(1)[0][1] > 0.3 * len(doc.words)


#: Rule name -> whether it rejects a document that has at least one word.
RULES: dict[str, Callable[[Doc], bool]] = {
    "mean_word_length": lambda d: not 3 * len(d.words) <= d.word_chars() <= 10 * len(d.words),
    "symbol_share": lambda d: 10 * d.symbols() > len(d.words),
    "duplicate_lines": lambda d: 10 * d.dup_lines() > 4 * d.lines(),
    "upper_case_share": lambda d: 10 * sum(map(str.isupper, d.words)) > 3 * len(d.words),
    "alphabetic_share": _alphabetic,
    "top_word_share": _top_word,
    "longest_word": lambda d: max(map(len, d.words)) > 1000,
}


def base_failed(doc: Doc) -> bool:
    return len(doc.words) < MIN_WORDS or 100 * doc.repeat_words() > 50 * len(doc.words)


def _measured(doc: Doc) -> Doc:
    """What every document is asked for in any case: a rule pays only for what comes on top."""
    doc.word_chars(), doc.symbols(), doc.dup_lines()
    return doc


def cascade_order(docs: DataFrame, text: str = "text", rules: dict | None = None, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Measured (rule, rows, cost, rejected share, worth), best first, on about ``sample_rows`` rows that pass the base.

    Texts stay in the tasks that sample them; one row of numbers a rule and batch is added up.
    """
    rules = rules or RULES
    rows = docs.count()
    share = min(1.0, sample_rows / max(1, rows))
    sample = docs.select(F.col(text).cast("string").alias("text")).sample(False, share, SEED)

    def piece(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fresh = [_measured(d) for d in map(Doc, filter(None, batch.column(0).to_pylist())) if not base_failed(d)]
        found = []
        for name, rule in rules.items():
            start = time.perf_counter()
            hits = sum(map(rule, fresh))
            found.append((name, len(fresh), hits, time.perf_counter() - start))
        yield pa.RecordBatch.from_pylist([dict(zip(("rule", "rows", "hits", "seconds"), x)) for x in found], schema=parts)

    parts = pa.schema([("rule", pa.string()), ("rows", pa.int64()), ("hits", pa.int64()), ("seconds", pa.float64())])
    timed = sample.mapInArrow(lambda b: in_batches(b, piece), "rule string, rows long, hits long, seconds double")
    sums = {r["rule"]: r for r in timed.groupBy("rule").agg(F.sum("rows").alias("n"), F.sum("hits").alias("hits"), F.sum("seconds").alias("s")).collect()}
    found = []
    for name in rules:
        n, hits, seconds = (sums[name]["n"], sums[name]["hits"], sums[name]["s"]) if name in sums else (0, 0, 0.0)
        cost = max(seconds, 1e-9) / max(1, n)
        rejected = (hits + 0.5) / (n + 1)  # a rule that rejects nothing here may still reject elsewhere
        found.append({"rule": name, "rows": n, "cost": cost, "rejected": rejected, "worth": rejected / cost})
    return sorted(found, key=lambda x: (-x["worth"], x["rule"]))


def run_cascade(docs: list[Doc], order: list[str], rules: dict | None = None) -> list[str | None]:
    """The first rule that rejects each document, None if none does; rejected ones are not tried again."""
    rules = rules or RULES
    verdict: list[str | None] = [None] * len(docs)
    alive = [i for i, d in enumerate(docs) if d.words]
    for name in order:
        rule = rules[name]
        rest = []
        for i in alive:
            if rule(docs[i]):
                verdict[i] = name
            else:
                rest.append(i)
        alive = rest
    return verdict


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", order: list[str] | None = None) -> DataFrame:
    """Base measures, base verdict and the cascade's verdict for every document, in one scan without a shuffle.

    With an ``order`` of the caller's, failed_rule names the first rule that rejected, or ``base``.
    """
    named_rules = order is not None
    order = order or [x["rule"] for x in cascade_order(docs, text)]

    def piece(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [Doc(x or "") for x in batch.column(1).to_pylist()]
        failed = [base_failed(d) for d in texts]
        passed = [d for d, f in zip(texts, failed) if not f]
        rule_of = iter(run_cascade(passed, order))
        named = ["base" if f else next(rule_of) for f in failed]
        longs = lambda fn: pa.array([fn(d) for d in texts], pa.int64())
        columns = {
            "doc_id": batch.column(0),
            "n_words": longs(lambda d: len(d.words)),
            "word_chars": longs(Doc.word_chars),
            "n_symbols": longs(Doc.symbols),
            "n_dup_lines": longs(Doc.dup_lines),
            "n_repeat_words": longs(Doc.repeat_words),
            "base_failed": pa.array(failed, pa.bool_()),
            "kept": pa.array([x is None for x in named], pa.bool_()),
        }
        if named_rules:
            columns["failed_rule"] = pa.array(named, pa.string())
        yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = f"{SCHEMA}, failed_rule string" if named_rules else SCHEMA
    return rows.mapInArrow(lambda batches: in_batches(batches, piece), schema)
