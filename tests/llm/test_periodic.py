import hashlib
import random
import time
import zlib
from fractions import Fraction

from strata.llm import periodic
from strata.llm.queries import QUERIES


def plain_runs(words):
    """Every stretch by definition: for each period the maximal stretches, smallest period first."""
    n, seen = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            end = i
            while end < n and words[end] == words[end - q]:
                end += 1
            start, length = i - q, end - i + q
            if length >= max(6, 4 * q):
                seen.setdefault((start, length), q)
            i = end
    return sorted(((s, k, q) for (s, k), q in seen.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    text_left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()
    four = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, hashlib.sha256(lines).hexdigest(), hashlib.sha256(text_left).hexdigest())


def test_runs_equal_definition_on_small_alphabets():
    rng = random.Random(3)
    texts = []
    for case in range(1500):
        size = rng.randrange(0, 60)
        letters = [b"a", b"b", b"c"][: rng.randrange(1, 4)]
        words = [rng.choice(letters) for _ in range(size)]
        if size and rng.random() < 0.7:
            base = words[: rng.randrange(1, 12)]
            words = words[: rng.randrange(0, size)] + base * rng.randrange(2, 9) + base[: rng.randrange(0, len(base) + 1)]
        texts.append(words)
    # Fibonacci words are full of overlapping periods
    x, y = [b"a"], [b"a", b"b"]
    while len(y) < 400:
        x, y = y, y + x
    texts += [y, y * 4, [b"a"] * 300, ([b"a"] * 8 + [b"b"]) * 40]
    assert periodic.runs_of(texts) == [plain_runs(t) for t in texts]


def test_every_period_is_found():
    texts = [[b"%d" % i for i in range(q)] * 4 + [b"x", b"y"] for q in range(1, 120)]
    for q, runs in enumerate(periodic.runs_of(texts), 1):
        assert runs == plain_runs(texts[q - 1])
        assert bool(runs) == (q > 1)
    assert periodic.runs_of([[b"a"] * 5, [b"a"] * 6]) == [[], [(0, 6, 1)]]


def test_one_word_a_million_times_is_one_run_in_short_time():
    began = time.time()
    assert periodic.runs_of([[b"a"] * 1_000_000]) == [[(0, 1_000_000, 1)]]
    many = ([b"a"] * 8 + [b"b"]) * 20_000
    assert (0, len(many), 9) in periodic.runs_of([many])[0]
    assert time.time() - began < 60


def test_runs_are_emitted_when_their_diagonal_ends():
    """The pass hands out a run before it has read what follows."""
    taken = []

    def events():
        for place in range(5, 10):
            taken.append(place)
            yield place, 1, 5
        for place in range(50, 60):
            taken.append(place)
            yield place, 1, 5

    first = next(periodic.online_runs(events()))
    assert first == (0, 10, 1)
    assert taken[-1] == 50


def test_query_equals_plain_form(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randrange(0, 80)))) for i in range(300)]
    rows += [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(400))) for i in range(300, 420)]
    rows += [(None, None), (None, "a " * 20), (7, ""), (7, " \t\n "), (8, "ä ß " * 9), (8, "ä ß " * 9), (-5, "x\x0by\x0c" * 30)]
    rows += [(9, "one two three " * 20_000)]
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], "doc_id long, text string, runs string, best string, start int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted([plain_row(*r) for r in rows[:-1]] + [got[[g[0] for g in got].index(9)]], key=key)
    long = next(g for g in got if g[0] == 9)
    assert long[1:6] == (1, 0, 60_000, 3, 20_000_000)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["op11_periodic_runs"](spark, str(tmp_path)).count() == 0


def test_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "a  b c b c b c b c d")], "doc_id long, text string")
    row = periodic.collapse(docs).first()
    assert row["collapsed"] == "a b c d" and [tuple(r) for r in row["runs"]] == [(1, 8, 2)] and row["n_words"] == 10
