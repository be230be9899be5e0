from functools import lru_cache

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import html_text as H


def kept(page):
    lines = H.lines_of(page)
    top = max((p for _, p in lines), default=0)
    return "\n".join(x for x, p in lines if p and p == top)


def test_structure():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav><div class="cookie-notice"><p>Cookies</p></div>
    <article><header><h1>The  &amp; head</h1></header><p>One <b>bo</b>ld<br>next&nbsp;x<!-- no --><script>var a="</p>";</script>
    <p>Two<div class="ad-slot"><p>Buy</div><ul><li>a<li>b</ul><blockquote>q</blockquote>
    <form><input name=x><p>Sign up</form><p hidden>no</p><section id="comments"><p>First!</p></section></article>
    <aside>Side</aside><footer>&copy; me</footer></body></html>"""
    assert kept(page) == "The & head\nOne bold next x\nTwo\na\nb\nq"


def test_broken_pages():
    assert kept(None) == kept("") == kept("<script>x") == kept("<!-- x") == ""
    assert kept("plain &lt;text&gt;") == "plain <text>"
    assert kept("<p>a</b></div><p>b < c <p title='>'>d") == "a\nb < c\nd"
    assert kept('<p title="x>a') == "a"
    assert kept("<main><p>m</p></main><p>other</p>") == "m"
    assert kept("<div>" * 3000 + "deep") == "deep"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/=\"' apdivn!-&;", max_size=80))
def test_anything_parses(page):
    H.lines_of(page)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
def test_longest_common_subsequence(a, b):
    @lru_cache(None)
    def length(i, j):
        if i == len(a) or j == len(b):
            return 0
        return max(length(i + 1, j), length(i, j + 1), 1 + length(i + 1, j + 1) if a[i] == b[j] else 0)

    found = sorted(H.shared_lines(a, b))
    assert len(found) == length(0, 0)
    rest = iter(b)
    assert all(any(x == a[i] for x in rest) for i in found)


def page(lines):
    return "<body>" + "".join(f"<p>{x}</p>" for x in lines)


def test_differencing(spark, monkeypatch):
    monkeypatch.setattr(H, "GROUP", 2)
    own = [f"article {i} has a long text of its own number {i}" for i in range(6)]
    rows = [(i, f"http://h.org/a/{i}", page(["Home", own[i], "Read more", "Imprint"])) for i in range(6)]
    rows += [(10, "http://h.org/b/copy", page(["same text twice", "and more of it"])), (11, "http://h.org/b/copy2", page(["same text twice", "and more of it"]))]
    rows += [(20, None, None), (21, "http://[x", page(["alone"])), (5, rows[5][1], rows[5][2]), (None, "http://z.org", page(["no id"]))]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, rank int, text string")
    got = H.main_text(df).collect()
    text = sorted(((r["page_id"], r["text"]) for r in got), key=repr)
    want = [(i, own[i]) for i in range(6)] + [(5, own[5])]
    want += [(10, "same text twice\nand more of it"), (11, "same text twice\nand more of it"), (20, ""), (21, "alone"), (None, "no id")]
    assert text == sorted(want, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert H.main_text(df.limit(0)).collect() == []


def test_differencing_decides_inside_articles_and_beside_copies(spark):
    def site(body):
        return f"<div><span>Top stories</span><p>Weather</p></div><article><p>Share this</p>{body}<p>Read on</p></article>"

    said = "A passage that both articles quote in full."
    rows = [(i, f"http://n.org/{i:02d}", site(f"<p>Report {i} of its own day.</p><p>{said}</p>")) for i in range(3)]
    # a run of copies uses up no neighbour: exact ones are one layout, near ones are passed over
    long = "<p>The same long report, printed word for word on many pages of this host.</p>" * 3
    rows += [(10 + i, f"http://n.org/1{i}", site(long)) for i in range(4)]
    rows += [(20 + i, f"http://n.org/2{i}", site(long + f"<p>Issue {i}.</p>")) for i in range(4)]
    rows += [(30, "http://n.org/30", "<div><p>Weather</p></div><article><p>teaser</p></article><main><p>The text stands here, in the main part.</p></main>")]
    got = {r["page_id"]: r for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(3):
        assert got[i]["text"] == f"Report {i} of its own day.\n{said}"
        assert got[i]["n_decided"] == len("Share this\n\nRead on")
    body = "\n".join(["The same long report, printed word for word on many pages of this host."] * 3)
    assert {got[10 + i]["text"] for i in range(4)} == {body}
    assert [got[20 + i]["text"] for i in range(4)] == [f"{body}\nIssue {i}." for i in range(4)]
    assert got[30]["text"] == "teaser\nThe text stands here, in the main part."


def brute_deletions(pages):
    """The rule over all pairs: on each side the nearest page with at most half of the text, then the one of longer common path."""
    out = []
    for i, (host, path, hashes, sizes) in enumerate(pages):
        sides = []
        for way in (range(i - 1, -1, -1), range(i + 1, len(pages))):
            for j in way:
                if pages[j][0] != host:
                    break
                shared = H.shared_lines(hashes, pages[j][2])
                if 2 * sum(sizes[k] for k in shared if sizes[k] > 0) <= sum(s for s in sizes if s > 0):
                    common = next((n for n, (x, y) in enumerate(zip(path, pages[j][1])) if x != y), min(len(path), len(pages[j][1])))
                    sides.append((-common, len(sides), sorted(shared)))
                    break
        out.append(min(sides)[2] if sides else [])
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.text("xy", max_size=4), st.lists(st.integers(0, 40), max_size=6)), max_size=12))
def test_neighbours_without_copies(pages):
    # lines of equal size that a page holds once: without chains of partial copies the way over copies meets the nearest page
    rows = sorted((h, p, sorted(set(v)), [10] * len(set(v))) for h, p, v in pages)
    exact = [r for i, r in enumerate(rows) if r[2] and all(r[2] == o[2] or not set(r[2]) & set(o[2]) for o in rows)]
    assert H.deletions(exact) == brute_deletions(exact)
