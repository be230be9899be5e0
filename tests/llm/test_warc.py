import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import warc as W

LONG = "ä" * 60
ROWS = [
    (1, "http://www.b.org/x?Q=1", LONG), (5, "http://b.org/x?q=1", LONG), (3, "https://a.org/", LONG), (2, None, None),
    (9, "", ""), (4, "http://a.org/%41 b\r\nc", "short"), (6, "http://a.org/2", "short"), (None, "http://c.org", LONG),
    (1, "http://again.org", LONG), (7, "http://[bad", "x" * 100_000), (None, "n", "y" * 100), (None, "n", "y" * 100),
]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=8), max_size=9))
def test_loser_tree(lists):
    runs = [iter([((x,), i) for x in sorted(run)]) for i, run in enumerate(lists)]
    assert [x[0][0] for x in W.LoserTree(runs)] == sorted(x for run in lists for x in run)


def brute(rows):
    out = []
    for page_id, url, html in rows:
        body = (html or "").encode()
        ids = [r[0] for r in rows if (r[2] or "").encode() == body and r[0] is not None]
        first = min(ids, default=None)
        again = len(body) >= 100 and first is not None and page_id != first
        kind = "revisit" if again else "response"
        out.append((page_id, url or None, len(body), hashlib.sha256(body).hexdigest(), kind, first if again else None))
    return sorted(out, key=repr)


def test_archives(spark):
    df = spark.createDataFrame([(*r, "z") for r in ROWS], "page_id long, url string, html string, captured string").repartition(3)
    got = W.round_trip(df, archive_bytes=700).collect()
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == brute(ROWS)
    got.sort(key=lambda r: (r["range"], r["place"]))
    keys = [(r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in got]
    assert keys == sorted(keys)
    assert len({r["archive"] for r in got}) > 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.round_trip(df).collect() == []


def test_url_key():
    assert W.url_key("https://www.Example.com/A/b?x=1#top") == "com,example)/a/b?x=1"
    assert W.url_key(None) == ""
