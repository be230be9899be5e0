"""Short items are found inside texts, whole words only; a plain search finds the same."""

import random
import re

from strata.llm import decontaminate as D


def test_short_items_inside_texts(spark):
    docs = [(1, "Ask: Who  wrote\nHamlet now? Nobody."), (2, "who wrote hamlet nowadays"), (3, "xwho wrote hamlet now?"), (4, "who wrote hamlet no?"), (5, "前谁写了哈姆雷特后"), (None, "(who wrote hamlet now?)")]
    items = [(10, "who wrote hamlet now?"), (11, "who wrote hamlet now"), (12, "谁写了哈姆雷特")]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    i = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r)[:5] for r in D.matches(d, i).collect()}
    assert got == {(1, 10, 0, 0, 5), (1, 11, 0, 0, 5), (None, 10, 0, 0, 1), (None, 11, 0, 0, 1), (5, 12, 0, 0, 1)}
    assert sorted(r["doc_id"] for r in D.clean(d, i).collect()) == [2, 3, 4]


def test_short_items_equal_a_plain_search():
    rng = random.Random(5)
    words = ["a", "ab", "ba", "b,", "aa", "-b"]
    items = sorted({" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(20)})
    matcher = D.Matcher(list(enumerate(items)), 0.08)
    for _ in range(60):
        text = D.folded(" ".join(rng.choices(words, k=12)) if rng.random() < 0.8 else "".join(rng.choices("ab, -", k=30)))
        want = set()
        for n, item in enumerate(items):
            left, right = (r"(?<![a-z])" if item[0].isalnum() else ""), (r"(?![a-z])" if item[-1].isalnum() else "")
            if re.search(left + re.escape(item) + right, text):
                want.add(n)
        assert set(matcher.of(text)) == want


def test_a_very_long_text_is_searched_to_its_end():
    matcher = D.Matcher([(1, "the last words")], 0.08)
    assert matcher.of("x " * 2_000_000 + "the last words") == {0: (0, 4_000_000)}
