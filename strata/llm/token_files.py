"""Token ids in word-aligned Simple-8b files.

A file holds 64-bit little-endian words.  The low four bits of a word select how many ids it
packs and how wide each is; an id of more than 60 bits is an escape, whose payload is an
index into the file's list of wide ids.  Words come in blocks of at most ``BLOCK`` ids with
an offset per block, so all words of a file are decoded at once without walking it.

    magic  | words | wide ids | first word of each block | ids of each block
           | doc ids | doc id is set | ids of each document | seven lengths | magic

Documents are ordered by id (NULL first, then by a hash of the text) across files: part number, then
sequence number.  Each file is bounded by ``FILE_IDS`` ids or one document.

Defined cases: NULL and empty texts give the end id only; a NULL id sorts first; repeated
rows are each written; an empty table writes nothing and gives an empty result; very long
texts are encoded whole; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import in_batches, release_memory, stored, worker_memory
from strata.llm.store import put
from strata.runtime import scratch_path

MAGIC = b"S8BTOK01"
BLOCK = 1024
FILE_IDS = 1_000_000
END_ID = 1
#: Selector -> (ids in a word, bits of each).  Selector 0 is the escape, 15 a run of zeros.  Fixed values.
SELECTORS = {
    15: (120, 0), 1: (60, 1), 2: (30, 2), 3: (20, 3), 4: (15, 4), 5: (12, 5), 6: (10, 6), 7: (8, 7),
    8: (7, 8), 9: (6, 10), 10: (5, 12), 11: (4, 15), 12: (3, 20), 13: (2, 30), 14: (1, 60), 0: (1, 64),
}
_COUNT = np.array([SELECTORS[s][0] for s in range(16)], np.int64)


def pack(ids: np.ndarray, step: int = 256 * BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, wide ids, first word of each block, ids of each block) of unsigned 64-bit ids, ``step`` at a time."""
    none, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parts, n_words, n_wide = [(none, none, at, at)], 0, 0
    for i in range(0, len(ids), step):
        words, wide, first, sizes = _pack(ids[i : i + step].astype(np.uint64), n_wide)
        parts.append((words, wide, first + n_words, sizes))
        n_words, n_wide = n_words + len(words), n_wide + len(wide)
    return tuple(np.concatenate(p) for p in zip(*parts))


def _pack(ids: np.ndarray, n_wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``pack``, of some ids, when ``n_wide`` wide ids came before."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    sizes = np.full(blocks, BLOCK, np.int64)
    sizes[-1] = n - BLOCK * (blocks - 1)
    # the ids of a block, with room behind for words that are not full
    room = 120
    kind = np.uint32 if int(ids.max()) < 1 << 32 else np.uint64
    grid = np.zeros((blocks, BLOCK + room), kind)
    full = np.zeros(blocks * BLOCK, kind)
    full[:n] = ids
    grid[:, :BLOCK] = full.reshape(blocks, BLOCK)
    choice = np.zeros((blocks, BLOCK), np.uint8)  # the escape fits always
    widest, span = _needed(grid), 1  # most bits among the ``span`` ids from a place on
    for selector in (14, 13, 12, 11, 10, 9, 8, 7, 6, 5, 4, 3, 2, 1, 15):
        count, width = SELECTORS[selector]
        while 2 * span <= count:
            wider = widest.copy()
            np.maximum(widest[:, :-span], widest[:, span:], out=wider[:, :-span])
            widest, span = wider, 2 * span
        fits = np.maximum(widest[:, :BLOCK], widest[:, count - span : count - span + BLOCK]) <= width
        if not fits.any():
            break  # more ids of fewer bits fit nowhere either
        choice[fits] = selector
    # all blocks step from word to word together
    at = np.zeros(blocks, np.int64)
    live = np.arange(blocks)
    found_block, found_at = [], []
    while len(live):
        found_block.append(live)
        found_at.append(at[live])
        at[live] += _COUNT[choice[live, at[live]]]
        live = live[at[live] < sizes[live]]
    block, start = np.concatenate(found_block), np.concatenate(found_at)
    order = np.lexsort((start, block))
    block, start = block[order], start[order]
    selector = choice[block, start]
    words = selector.astype(np.uint64)
    wide, flat = np.zeros(0, np.uint64), grid.ravel()
    for s in np.unique(selector):
        which = np.flatnonzero(selector == s)
        count, width = SELECTORS[int(s)]
        if s == 0:
            wide = grid[block[which], start[which]]
            words[which] |= np.arange(n_wide, n_wide + len(which), dtype=np.uint64) << np.uint64(4)
            continue
        if s == 15:
            continue
        at, body = block[which] * (BLOCK + room) + start[which], np.zeros(len(which), np.uint64)
        for k in range(count):
            body |= flat[at + k].astype(np.uint64) << np.uint64(4 + k * width)
        words[which] |= body
    first = np.searchsorted(block, np.arange(blocks))
    return words, wide, first.astype(np.int64), sizes


_BITS = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def _needed(grid: np.ndarray) -> np.ndarray:
    """Bits that each id takes."""
    if int(grid.max()) < len(_BITS):
        return _BITS[grid.astype(np.uint16)]
    need = np.zeros(grid.shape, np.uint8)
    for part in range(4):
        piece = (grid >> np.uint64(16 * part)).astype(np.uint16)
        need = np.where(piece > 0, _BITS[piece] + np.uint8(16 * part), need)
    return need


def unpack(words: np.ndarray, wide: np.ndarray, first: np.ndarray, sizes: np.ndarray, step: int = 256) -> np.ndarray:
    """The ids again, ``step`` blocks at a time."""
    out = np.empty(int(sizes.sum()), np.uint64)
    ends, edges = np.cumsum(sizes), np.append(first, len(words))
    for i in range(0, len(sizes), step):
        j = min(i + step, len(sizes))
        out[ends[i] - sizes[i] : ends[j - 1]] = _unpack(words[edges[i] : edges[j]], wide, first[i:j] - edges[i], sizes[i:j])
    return out


def _unpack(words: np.ndarray, wide: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ids of whole blocks; every word finds its place by sums alone."""
    total = int(sizes.sum())
    out = np.zeros(total, np.uint64)
    if not len(words):
        return out
    selector = (words & np.uint64(15)).astype(np.int64)
    count = _COUNT[selector]
    block = np.zeros(len(words), np.int64)
    block[first[1:]] = 1
    block = np.cumsum(block)
    ends = np.cumsum(count)
    inside = ends - count - (ends[first] - count[first])[block]
    base = (np.cumsum(sizes) - sizes)[block]
    for s in np.unique(selector):
        which = np.flatnonzero(selector == s)
        n, width = SELECTORS[int(s)]
        if s == 15:
            continue
        body = words[which] >> np.uint64(4)
        for k in range(n):
            spot = inside[which] + k
            ok = spot < sizes[block[which]]
            value = wide[body.astype(np.int64)] if s == 0 else (body >> np.uint64(k * width)) & np.uint64((1 << width) - 1)
            out[(base[which] + spot)[ok]] = value[ok]
    return out


def file_bytes(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> list[bytes]:
    words, wide, first, sizes = pack(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    parts = [
        words.astype("<u8"), wide.astype("<u8"), first.astype("<u4"), sizes.astype("<u2"),
        numbers, known, counts.astype("<u8"),
    ]
    lengths = np.array([len(p) for p in parts], "<u8")
    return [MAGIC, *[p.tobytes() for p in parts], lengths.tobytes(), MAGIC]


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, ids of each document, all ids) of one file."""
    if data[:8] != MAGIC or data[-8:] != MAGIC:
        raise ValueError("not a whole token file")
    kinds = ["<u8", "<u8", "<u4", "<u2", "<i8", "<u1", "<u8"]
    lengths = np.frombuffer(data[-64:-8], "<u8").astype(np.int64)
    parts, at = [], 8
    for kind, n in zip(kinds, lengths):
        size = int(n) * np.dtype(kind).itemsize
        parts.append(np.frombuffer(data[at : at + size], kind))
        at += size
    words, wide, first, sizes, numbers, known, counts = parts
    ids = unpack(words.astype(np.uint64), wide.astype(np.uint64), first.astype(np.int64), sizes.astype(np.int64))
    return [int(d) if k else None for d, k in zip(numbers, known)], counts.astype(np.int64), ids


#: Unicode white space, at which the vocabulary's tokenizer always cuts.
CHUNK = re.compile("[^\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
#: What ``str.split`` takes for white space and the vocabulary's tokenizer does not.
SEPARATORS = re.compile("[\x1c-\x1f]")


def chunks(text: str) -> list[str]:
    return CHUNK.findall(text) if SEPARATORS.search(text) else text.split()


#: How a vocabulary of lower-case words with marked ends prepares a text.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Texts of these characters are in normal form C, and their letters, digits and lower case are plain:
#: ASCII, the letters of Latin-1 and Latin Extended-A but for the dotted capital I, and some marks.
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u017f"
PLAIN = re.compile("[\\t-\\r -~\u00a1\u00ab\u00bb\u00bf\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f\u2013\u2014\u2018-\u201a\u201c-\u201e\u2026]*")
#: The pieces of such a text in lower case, which the vocabulary encodes one by one.
PIECES = re.compile(f"[{_LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\t-\\r {_LETTERS}0-9]+")


class _Places(dict):
    """Numbers of keys in the order they are met; ``fresh`` lists those met since it was last emptied."""

    def __init__(self, keys=()):
        super().__init__((k, i) for i, k in enumerate(keys))
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        value = self[key] = len(self)
        self.fresh.append(key)
        return value


class ChunkEncoder:
    """Ids of whole texts, each different piece encoded once by the tokenizers library.

    If the vocabulary cuts texts into the pieces of ``WORD_PIECES`` in lower case, plain texts
    are cut so here, and unknown pieces go to the library as lines of pieces, whose marked ends
    tell their ids apart.  Other texts of such a vocabulary are cut at white space, and other
    vocabularies get texts whole.  Of more than ``limit`` remembered pieces, or 16 ``limit``
    characters in them, the half used most stays, without pieces of over 64 characters.
    """

    def __init__(self, path: str, limit: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        before = (form.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_words = (
            (form.get("normalizer") or {}).get("normalizers") == NORMALIZERS
            and before[0].get("pattern") == {"Regex": WORD_PIECES}
            and form["model"].get("end_of_word_suffix") == "</w>"
        )
        self.specials = [t["content"] for t in form.get("added_tokens") or []]
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.word_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.places = _Places()
        self.characters = 0
        self.uses = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _one_by_one(self, texts: list[str]) -> tuple[list[int], list[int]]:
        lengths, flat = [], []
        for i in range(0, len(texts), 5_000):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + 5_000], add_special_tokens=False):
                ids = e.ids
                lengths.append(len(ids))
                flat += ids
        return lengths, flat

    def _as_lines(self, pieces: list[str], line: int = 2_000) -> tuple[list[int], list[int]]:
        """As ``_one_by_one``, for pieces of one marked end each."""
        lengths, flat = [], []
        for i in range(0, len(pieces), line):
            some = pieces[i : i + line]
            ids = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(self.word_end[np.array(ids, np.int64)]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                lengths += np.diff(ends, prepend=0).tolist()
                flat += ids
            else:
                more = self._one_by_one(some)
                lengths += more[0]
                flat += more[1]
        return lengths, flat

    def _cut(self, text: str) -> list[str]:
        """Keys of a text's parts, in order: pieces, or chunks behind a NUL, which no piece holds."""
        if PLAIN.fullmatch(text) and not any(s in text for s in self.specials):
            return PIECES.findall(text.lower())
        return ["\0" + c for c in chunks(text)]

    def _learn(self) -> None:
        fresh = self.places.fresh
        self.places.fresh = []
        if not fresh:
            return
        self.characters += sum(map(len, fresh))
        lines = [k for k in fresh if k[0] != "\0"]
        n1, ids1 = self._as_lines(lines)
        n2, ids2 = self._one_by_one([k[1:] for k in fresh if k[0] == "\0"])
        pool = np.array(ids1 + ids2, np.uint32)
        lengths = np.array(n1 + n2, np.int64)
        starts = np.cumsum(lengths) - lengths
        if n2:  # back into the order in which they were met
            order = np.argsort(np.array([k[0] == "\0" for k in fresh]), kind="stable")
            back = np.empty(len(fresh), np.int64)
            back[order] = np.arange(len(fresh))
            starts, lengths = starts[back], lengths[back]
        self.starts = np.append(self.starts, len(self.ids) + starts)
        self.lengths = np.append(self.lengths, lengths)
        self.ids = np.append(self.ids, pool)
        self.uses = np.append(self.uses, np.zeros(len(fresh), np.int64))

    def _forget(self) -> None:
        """Keep the half of the pieces that was used most."""
        short = np.fromiter((len(k) <= 64 for k in self.places), bool, len(self.places))
        wanted = np.zeros(len(self.uses), bool)
        wanted[np.argsort(-self.uses, kind="stable")[: self.limit // 2]] = True
        keep = np.flatnonzero(wanted & short)
        self.places = _Places(k for k, w in zip(self.places, (wanted & short).tolist()) if w)
        self.characters = sum(map(len, self.places))
        self.ids, ends = gather(self.starts, self.lengths, self.ids, keep)
        self.lengths = self.lengths[keep]
        self.starts = ends - self.lengths
        self.uses = self.uses[keep] // 2

    def encode(self, texts: list[str | None], end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text, all ids), each text closed by ``end_id``."""
        if not self.by_words:
            counts, flat = self._one_by_one([t or "" for t in texts])
            ends = np.cumsum(counts, dtype=np.int64)
            if end_id is None:
                return np.array(counts, np.int64), np.array(flat, np.uint32)
            return np.array(counts, np.int64) + 1, np.insert(np.array(flat, np.uint32), ends, np.uint32(end_id))
        if len(self.places) > self.limit or self.characters > 16 * self.limit:
            self._forget()
        listed: list[int] = []
        edges: list[int] = []
        for text in texts:
            parts = self._cut(text) if text else ()
            if len(parts) > 1:
                listed += itemgetter(*parts)(self.places)
            elif parts:
                listed.append(self.places[parts[0]])
            listed.append(-1)  # stands for the end id
            edges.append(len(listed) - 1)
        self._learn()
        index = np.array(listed, np.int64)
        closing = len(self.starts)
        self.uses += np.bincount(index[index >= 0], minlength=closing)
        index[index < 0] = closing
        starts = np.append(self.starts, len(self.ids))
        lengths = np.append(self.lengths, 0 if end_id is None else 1)
        pool = self.ids if end_id is None else np.append(self.ids, np.uint32(end_id))
        ids, ends = gather(starts, lengths, pool, index)
        return np.diff(ends[edges], prepend=0) if edges else np.zeros(0, np.int64), ids


def gather(starts: np.ndarray, lengths: np.ndarray, pool: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``index`` of a pool of id lists put behind one another, and where each ends."""
    n = lengths[index]
    ends = np.cumsum(n)
    return pool[np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - n - starts[index], n)], ends


def memory_of(path: str) -> str:
    return f"pieces {path}"


def encoder(path: str) -> ChunkEncoder:
    """One per Python worker, so that its memory of pieces lasts over tasks."""
    return worker_memory(memory_of(path), lambda: ChunkEncoder(path))


def write_tokens(
    docs: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID, file_ids: int = FILE_IDS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode every text and write the files; the stored manifest (file, part, seq, n_docs, n_ids)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the text takes part in the order, so that rows of one id, or without any, can be split
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie")
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").drop("tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        done: list[tuple] = []

        def flush() -> None:
            if held:
                doc_ids = [d for h in held for d in h[0]]
                counts, ids = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
                name = f"part-{part:07d}-{len(done):05d}.s8b"
                put(folder, name, file_bytes(doc_ids, counts, ids))
                done.append((name, part, len(done), len(doc_ids), len(ids)))
                held.clear()

        def piece(batch: pa.RecordBatch) -> Iterator[None]:
            counts, ids = encoder(vocabulary).encode(batch.column(1).to_pylist(), end_id)
            held.append((batch.column(0).to_pylist(), counts, ids))
            if sum(len(h[2]) for h in held) >= file_ids:
                flush()
            yield from ()

        for _ in in_batches(batches, piece, 2 << 20, memory_of(vocabulary)):
            pass
        flush()
        columns = list(zip(*done)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
            names=["file", "part", "seq", "n_docs", "n_ids"],
        )

    return stored(rows.mapInArrow(write, "file string, part int, seq int, n_docs long, n_ids long"), "token-manifest")


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                doc_ids, counts, ids = read_file(data.as_py())
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(counts)
                starts = ends - counts
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": pa.array([path.rsplit("/", 1)[1]] * len(doc_ids), pa.string()),
                        "doc_id": pa.array(doc_ids, pa.int64()),
                        "local": pa.array(starts, pa.int64()),
                        "n_tokens": pa.array(counts, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    # one row per file: a few numbers for each of the files, which hold millions of ids
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    first = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.s8b").load(folder).select("path", "content")
    rows = files.mapInArrow(decode, "file string, doc_id long, local long, n_tokens long, ids_crc32 long")
    return rows.join(first, "file").select(
        "doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, vocabulary: str, **names) -> DataFrame:
    """Write the files into the scratch folder and return what they hold."""
    folder = scratch_path(docs.sparkSession, "tokens")
    return read_tokens(docs.sparkSession, folder, write_tokens(docs, vocabulary, folder, **names))
