"""WARC archives and their capture index, merged from sorted runs.

Writing: payloads are digested in one pass; of records with equal payloads of at least
``MIN_REVISIT`` bytes the one with the smallest id is a ``response``, the others ``revisit``
it and store no body.  Each task writes gzip archives (one member per record) of bounded size.

Reading: every archive is parsed record by record and gives one run of its captures, sorted
by URL key and time.  The runs are range-partitioned by (URL key, time, id), so that one
busy URL is split by time, and each task merges the runs of its range with a loser tree.  The
result is globally ordered: by range, then by place in it.

Defined cases: NULL html is an empty payload; a NULL URL is written as an empty target and
read back as NULL (so is an empty one); a NULL id never becomes the response while the group
has another id, and refers to the smallest one; rows that repeat the smallest id are responses; an empty table
gives an empty result; other columns are not looked at; very long payloads are written whole.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator
from typing import Any
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import in_batches, stored
from strata.llm.store import put
from strata.runtime import scratch_path

MIN_REVISIT = 100
#: An archive is closed once it holds this many compressed bytes.
ARCHIVE_BYTES = 16 << 20
#: Capture time where the table has none: seconds after 2020-01-01 by page id.
EPOCH = 1_577_836_800
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long,"
    " url_key string, captured long, archive string, offset long, length long"
)


def digested(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", captured: str | None = None) -> DataFrame:
    """(page_id, url, html, payload_digest, captured, record_type, refers_to) per row; only digests are shuffled for the grouping."""
    body = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    when = F.col(captured).cast("long") if captured else F.lit(EPOCH) + F.coalesce(F.pmod(F.col(key), F.lit(1_000_000_000)), F.lit(0))
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        body.alias("html"),
        F.sha2(body, 256).alias("payload_digest"),
        when.alias("captured"),
    )
    # only digests that occur twice can make a revisit
    groups = rows.filter(F.octet_length("html") >= MIN_REVISIT).groupBy("payload_digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id")
    )
    groups = groups.filter("n > 1 AND first_id IS NOT NULL").select("payload_digest", "first_id")
    joined = rows.join(groups, "payload_digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "html", "payload_digest", "captured",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
    )


def record_bytes(page_id: int | None, url: str | None, html: bytes, digest: str, captured: int, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record."""
    import datetime

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    block = http + (html if kind == "response" else b"")
    date = (datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=captured)).strftime("%Y-%m-%dT%H:%M:%SZ")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Target-URI: {quote(url or '', safe=_PRINTABLE)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: Characters of a URL that are written as they are; '%' is not, so that reading gives back the very text.
_PRINTABLE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``digested`` rows; the stored list (archive, records)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        held: list[bytes] = []
        done: list[tuple[str, int]] = []

        def flush() -> None:
            if held:
                name = f"run-{part:07d}-{len(done):05d}-{attempt}.warc.gz"  # a second attempt may cut its rows otherwise
                put(folder, name, held)
                done.append((name, len(held)))
                held.clear()

        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                member = gzip.compress(record_bytes(*row), 5, mtime=0)
                if size + len(member) > archive_bytes:
                    flush()
                    size = 0
                held.append(member)
                size += len(member)
        flush()
        yield pa.RecordBatch.from_pydict({"archive": pa.array([d[0] for d in done], pa.string()), "records": pa.array([d[1] for d in done], pa.int64())})

    columns = ["page_id", "url", "html", "payload_digest", "captured", "record_type", "refers_to"]
    return stored(rows.select(*columns).mapInArrow(write, "archive string, records long"), "warc-list")


def url_key(url: str | None) -> str:
    """Sort-friendly form: host labels turned round, then path and query; scheme, 'www.' and fragment do not count."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path.lower() or '/'}{query.lower()}"


def records_of(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of each record of an archive."""
    at = 0
    while at < len(data):
        member, pieces, end = zlib.decompressobj(31), [], at
        while not member.eof:
            piece = data[end : end + 65536]
            if not piece:
                raise ValueError(f"record at {at} is cut off")
            pieces.append(member.decompress(piece))
            end += len(piece)
        raw = b"".join(pieces)
        length = end - len(member.unused_data) - at
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        yield at, length, headers, rest[: int(headers["Content-Length"])]
        at += length


def _capture(archive: str, at: int, length: int, headers: dict[str, str], block: bytes) -> dict[str, Any]:
    import datetime

    number = lambda x: None if x == "<urn:page:none>" else int(x[10:-1])
    head, _, body = block.partition(b"\r\n\r\n")
    kind = headers["WARC-Type"]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(head.rsplit(b"Content-Length: ", 1)[1])
    if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} in {archive} differs from its digest")
    url = unquote(headers["WARC-Target-URI"]) or None
    when = datetime.datetime.strptime(headers["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ") - datetime.datetime(1970, 1, 1)
    return {
        "page_id": number(headers["WARC-Record-ID"]), "url": url, "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": number(headers["WARC-Refers-To"]) if kind == "revisit" else None,
        "url_key": url_key(url), "captured": when.days * 86400 + when.seconds, "archive": archive, "offset": at, "length": length,
    }


def _order(c: dict[str, Any]) -> tuple:
    return (c["url_key"], c["captured"], c["page_id"] is not None, c["page_id"] or 0, c["archive"], c["offset"])


def archive_runs(spark: SparkSession, folder: str, written: DataFrame) -> DataFrame:
    """Every capture read back from the archives that ``written`` lists; each archive is a run sorted by URL key and time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                name = path.rsplit("/", 1)[1]
                run = sorted((_capture(name, *r) for r in records_of(data.as_py())), key=_order)
                yield pa.RecordBatch.from_pylist(run, schema=_SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "run-*.warc.gz").load(folder)
    captures = files.select("path", "content").mapInArrow(read, CAPTURES)
    # files of lost or second attempts are not listed
    return captures.join(written.select("archive"), "archive", "left_semi").select(*_NAMES)


_TEXT = {"url", "payload_digest", "record_type", "url_key", "archive"}
_NAMES = [x.split()[0] for x in CAPTURES.split(", ")]
_SCHEMA = pa.schema([(n, pa.string() if n in _TEXT else pa.int64()) for n in _NAMES])


class LoserTree:
    """k-way merge: inner nodes keep the loser of their match, so the next item costs one path of log2(k) matches."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads: list[tuple | None] = [next(r, None) for r in runs] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node:
            held = self.losers[node]
            if held < 0:  # while the tree is filled, the first to arrive waits here
                self.losers[node] = i
                return
            if self._beats(held, i):
                self.losers[node], i = i, held
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple]:
        while (best := self.heads[self.losers[0]]) is not None:
            yield best
            top = self.losers[0]
            self.heads[top] = next(self.runs[top], None)
            self._play(top)


def merged_index(runs: DataFrame) -> DataFrame:
    """Globally ordered captures: ``runs`` and (range, place), ascending in URL key, time and id."""
    spark = runs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("url_key"), F.col("captured"), F.col("page_id").asc_nulls_first(), F.col("archive"), F.col("offset")]
    dealt = runs.repartitionByRange(parts, *keys).sortWithinPartitions("archive", *keys[:3], "offset")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        found: dict[str, list[tuple]] = {}  # the index lines of one range: bounded by the range, without payloads
        for batch in batches:
            for row in batch.to_pylist():
                found.setdefault(row["archive"], []).append((_order(row), row))
        out, place = [], 0
        for _, row in LoserTree([iter(r) for r in found.values()]):
            out.append(row | {"range": part, "place": place})
            place += 1
            if len(out) == 10_000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = _SCHEMA.append(pa.field("range", pa.int32())).append(pa.field("place", pa.int64()))
    return dealt.mapInArrow(merge, f"{CAPTURES}, range int, place long")


def round_trip(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, **names) -> DataFrame:
    """Write the archives into the scratch folder and return their merged index."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    written = write_archives(digested(pages, **names), folder, archive_bytes)
    if written.isEmpty():
        return spark.createDataFrame([], f"{CAPTURES}, range int, place long")
    return merged_index(archive_runs(spark, folder, written))
