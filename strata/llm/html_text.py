"""Main text of web pages by nearest-URL page differencing.

A page becomes lines, one per block of text, each marked by where it stands (article, main
part, page furniture).  Pages of a host are put in order of their URL path, those with the same
lines as one.  A page is compared with the nearer of its two neighbours by aligning their line
hashes along a longest common subsequence, and lines shared by both are deleted: what the
neighbour has too is the site's, not the article's.  A neighbour with mostly the same text is a
copy of the article and shows nothing about the site, so it and its copies are passed over.
Inside an ``article`` element shared sentences stay, because articles of one host do quote the same
passages; other shared lines (labels, buttons, captions) go.  Scripts, forms, navigation and
other marked furniture never become article lines.  The text is what is left in the article
elements if that is at least half of what is left at all, else in the main part, else on the page.

Hashes only are ordered and compared; groups of ``GROUP`` consecutive pages (with one page of
overlap at each end) make the work even, however many pages one host has.

Defined cases: NULL and empty html give an empty text; a NULL or broken URL belongs to the
host ''; rows that repeat page, URL and html, and pages of a host with equal lines, are compared once
and each get the text; NULL
ids take part; an empty table gives an empty result; texts of any length are kept whole;
other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import in_batches, numbered, stored
from strata.runtime import attach, pin

GROUP = 256
#: A neighbour that shares more than this part of the page's text is a copy of its article.
COPY_SHARE = 0.5

#: How a sentence ends, closing marks included.
SENTENCE = re.compile(r"[.!?\u2026\u3002\uff01\uff1f\u061f\u0964][\s\"'\u00bb\u2019\u201d)\]]*$")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>"
    r"|<[!?][^>]*+>",
    re.S,
)
ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Fixed values of HTML: elements by role.
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rb rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr img br input meta link base area source track embed param".split()
)
VOID = set("img br input meta link base area source track embed param hr wbr col".split())
FURNITURE = set(
    "nav header footer aside form noscript template svg math object applet audio video canvas button select"
    " option datalist dialog menu head map".split()
)
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
#: Parts of class and id names that mark furniture.
FURNITURE_NAMES = set(
    "ad ads advert adverts advertisement advertising adslot sponsor sponsored promo promos promotion banner sidebar"
    " nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notices alert"
    " popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended"
    " comment comments disqus reply replies pagination pager copyright widget widgets toolbar disclaimer paywall".split()
)
ARTICLE_NAMES = set("article post entry content body story main text".split())


def _furniture(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in FURNITURE and not (tag == "header" and in_article):
        return True
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return False
    if tag in ("body", "html", "main"):
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)}
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    names = {p.lower() for p in NAME_PART.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    if names & FURNITURE_NAMES:
        return True
    return "header" in names and not in_article and not names & ARTICLE_NAMES


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """(line, place) of each block: place 3 in an article, 2 in the main part, 1 elsewhere, 0 furniture."""
    out: list[tuple[str, int]] = []
    if not page:
        return out
    stack: list[tuple[str, int]] = []  # open block elements with the place of their text
    text: list[str] = []
    place, at = 1, 0

    def close_line() -> None:
        if text:
            line = SPACE.sub(" ", entities.unescape("".join(text))).strip()
            if line:
                out.append((line, place))
            text.clear()

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:  # a comment or declaration
            continue
        tag = tag.lower()
        end = m["end"] or m["end2"]
        if tag == "br":
            text.append(" ")
            continue
        if tag in RAW and not end:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        attrs = m["attrs"] if m["tag"] else m["attrs2"]
        if end:
            if any(t == tag for t, _ in stack):
                if tag not in INLINE:
                    close_line()
                elif place != _outer(stack, tag):
                    close_line()
                while stack.pop()[0] != tag:
                    pass
                place = stack[-1][1] if stack else 1
            elif tag not in INLINE:
                close_line()
            continue
        if tag in INLINE:
            if tag not in VOID and attrs and place and _furniture(tag, attrs, place == 3):
                close_line()
                stack.append((tag, 0))
                place = 0
            elif tag not in VOID and any(t == tag for t, _ in stack):
                stack.append((tag, place))  # so that its end does not close an outer one
            continue
        close_line()
        if tag == "body":
            stack = [x for x in stack if x[0] != "head"]
            place = stack[-1][1] if stack else 1
        if tag in VOID or attrs.endswith("/"):
            continue
        if tag in ("p", "li", "td", "th", "tr", "dt", "dd") and stack and stack[-1][0] == tag:
            stack.pop()
            place = stack[-1][1] if stack else 1
        if place and _furniture(tag, attrs, place == 3):
            place = 0
        elif place and tag == "article":
            place = 3
        elif place == 1 and (tag == "main" or re.search(r"role\s*=\s*[\"']?main\b", attrs)):
            place = 2
        stack.append((tag, place))
    close_line()
    return out


def _outer(stack: list[tuple[str, int]], tag: str) -> int:
    i = max(i for i, x in enumerate(stack) if x[0] == tag)
    return stack[i - 1][1] if i else 1


def host_and_path(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit((url or "").strip())
        return (parts.hostname or "").removeprefix("www."), f"{parts.path}?{parts.query}"
    except ValueError:
        return "", url or ""


def line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def shared_lines(a: list[int], b: list[int]) -> set[int]:
    """Positions of ``a`` on a longest common subsequence with ``b``."""
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(a) - head and tail < len(b) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = {*range(head), *range(len(a) - tail, len(a))}
    # between them only lines that both have can match
    both = set(a[head : len(a) - tail]) & set(b[head : len(b) - tail])
    x = [i for i in range(head, len(a) - tail) if a[i] in both]
    y = np.array([v for v in b[head : len(b) - tail] if v in both], np.int64)
    if x:
        best = np.zeros((len(x) + 1, len(y) + 1), np.int32)
        for i in range(len(x) - 1, -1, -1):
            # best[i][j] = max(best[i+1][j], match + best[i+1][j+1], best[i][j+1]): the last by a running maximum
            row = np.maximum(best[i + 1, :-1], best[i + 1, 1:] + (y == a[x[i]]))
            best[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
        i = j = 0
        while i < len(x) and j < len(y):
            if a[x[i]] == y[j] and best[i, j] == best[i + 1, j + 1] + 1:
                found.add(x[i])
                i, j = i + 1, j + 1
            elif best[i + 1, j] >= best[i, j + 1]:
                i += 1
            else:
                j += 1
    return found


def first_others(pages: list[tuple], step: int) -> list[tuple[int, set[int]] | None]:
    """Per page the nearest page of its host before (``step`` -1) or after (1) it that is no copy, and the lines they share.

    Pages are (host, path, hashes, sizes).  From a copy the way goes on to the copy's own nearest other page.
    """
    found: list[tuple[int, set[int]] | None] = [None] * len(pages)
    for i in range(len(pages))[::-step]:
        host, _, hashes, sizes = pages[i]
        total = sum(s for s in sizes if s > 0)
        j = i + step
        while 0 <= j < len(pages) and pages[j][0] == host:
            shared = shared_lines(hashes, pages[j][2])
            if sum(sizes[k] for k in shared if sizes[k] > 0) <= COPY_SHARE * total:
                found[i] = j, shared
                break
            j = found[j][0] if found[j] else -1
    return found


def deletions(pages: list[tuple]) -> list[list[int]]:
    """Lines of each page to delete: those it shares with the nearer, by path, of the first other pages on both sides."""
    out = []
    for page, *sides in zip(pages, first_others(pages, -1), first_others(pages, 1)):

        def nearness(side: tuple[int, set[int]]) -> int:
            n = 0
            for x, y in zip(page[1], pages[side[0]][1]):
                if x != y:
                    break
                n += 1
            return -n

        out.append(sorted(min((s for s in sides if s), key=nearness, default=(0, set()))[1]))
    return out


def text_of(lines: list[tuple[str, int]], lost: set[int]) -> str:
    """The text of a page's lines without furniture and the ``lost`` lines, article sentences excepted."""
    left = [(x, place) for i, (x, place) in enumerate(lines) if place and (i not in lost or place == 3 and SENTENCE.search(x))]
    total = sum(len(x) for x, _ in left)
    place = next((p for p in (3, 2) if 2 * sum(len(x) for x, q in left if q >= p) >= total), 1)
    return "\n".join(x for x, q in left if q >= place)


def page_lines(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(page_key, layout, url_host, url_path, hashes, sizes); size is negative for furniture, pages of a host with the same lines have one layout."""

    def piece(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hosts, hashes, sizes, layouts = [], [], [], []
        for u, h in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            lines = lines_of(h)
            hosts.append(host_and_path(u))
            hashes.append([line_hash(x) for x, _ in lines])
            sizes.append([len(x) if place else -len(x) for x, place in lines])
            layouts.append(xxhash.xxh3_128_hexdigest(repr((hosts[-1][0], hashes[-1], sizes[-1]))))
        yield pa.RecordBatch.from_pydict(
            {
                "page_key": batch.column("page_key"),
                "layout": pa.array(layouts, pa.string()),
                "url_host": pa.array([h[0] for h in hosts], pa.string()),
                "url_path": pa.array([h[1] for h in hosts], pa.string()),
                "hashes": pa.array(hashes, pa.list_(pa.int64())),
                "sizes": pa.array(sizes, pa.list_(pa.int64())),
            }
        )

    schema = "page_key string, layout string, url_host string, url_path string, hashes array<long>, sizes array<long>"
    return _keyed(pages, key, url, html).select("page_key", "url", "html").mapInArrow(lambda b: in_batches(b, piece), schema)


def _keyed(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    page_id, u, h = F.col(key).cast("long"), F.col(url).cast("string"), F.col(html).cast("string")
    said = F.concat_ws("\x00", F.coalesce(page_id.cast("string"), F.lit("\x01")), F.coalesce(u, F.lit("\x01")), F.coalesce(h, F.lit("\x01")))
    return pages.select(F.md5(said).alias("page_key"), page_id.alias("page_id"), u.alias("url"), h.alias("html"))


def shared_with_neighbour(lines: DataFrame) -> DataFrame:
    """(page_key, gone, n_rows): the numbers of the lines to delete, for pages that lose any, pinned."""
    lines = stored(lines, "page-lines")
    layouts = lines.groupBy("layout").agg(
        F.min("url_path").alias("url_path"), *[F.first(c).alias(c) for c in ("url_host", "hashes", "sizes")], F.count(F.lit(1)).alias("n_pages")
    )
    ranked = numbered(layouts, ["url_host", "url_path", "layout"])
    place = F.col("rank") % GROUP
    group = F.floor(F.col("rank") / GROUP)
    homes = F.when(place == 0, F.array(group, group - 1)).when(place == GROUP - 1, F.array(group, group + 1)).otherwise(F.array(group))
    dealt = ranked.withColumn("home", group).withColumn("grp", F.explode(homes)).filter("grp >= 0")

    def compare(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["rank"])
        lost = deletions([(r["url_host"], r["url_path"], r["hashes"], r["sizes"]) for r in rows])
        own = [(r["layout"], gone, r["n_pages"]) for r, gone in zip(rows, lost) if gone and r["home"] == key[0].as_py()]
        columns = list(zip(*own)) or [[]] * 3
        types = pa.string(), pa.list_(pa.int32()), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["layout", "gone", "n_pages"])

    found = pin(dealt.groupBy("grp").applyInArrow(compare, "layout string, gone array<int>, n_pages long"))
    pages = lines.groupBy("page_key", "layout").agg(F.count(F.lit(1)).alias("n_rows"))
    return pin(attach(pages, found, "layout", "n_pages").filter("gone IS NOT NULL").select("page_key", "gone", "n_rows"))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_shared, n_decided) for every row; ``n_decided`` counts characters that differencing has taken away."""
    shared = shared_with_neighbour(page_lines(pages, key, url, html))
    joined = attach(_keyed(pages, key, url, html), shared, "page_key", "n_rows")

    def piece(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, counts, decided = [], [], []
        for page, gone in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist()):
            lost, lines = set(gone or ()), lines_of(page)
            texts.append(text_of(lines, lost))
            counts.append(len(lost))
            decided.append(max(0, len(text_of(lines, set())) - len(texts[-1])) if lost else 0)
        yield pa.RecordBatch.from_pydict(
            {
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                "n_shared": pa.array(counts, pa.int32()),
                "n_decided": pa.array(decided, pa.int64()),
            }
        )

    schema = "page_id long, url string, text string, n_chars long, n_shared int, n_decided long"
    return joined.select("page_id", "url", "html", "gone").mapInArrow(lambda b: in_batches(b, piece), schema)
