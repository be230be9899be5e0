import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import quality as Q


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, dup, len(covered), failed


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n#|é\t", max_size=120))
def test_measures(text):
    d = Q.Doc(text)
    assert (len(d.words), d.word_chars(), d.symbols(), d.dup_lines(), d.repeat_words(), Q.base_failed(d)) == brute(text)


def test_many_different_words():
    text = " ".join(f"w{i % 700}" for i in range(1500))
    assert Q.Doc(text).repeat_words() == brute(text)[4] == 1500


def test_order_changes_time_only(spark, odd_documents):
    good = " ".join(f"word{i} and{i} more{i} the" for i in range(60))
    rows = [(100, good), (101, good.upper()), (102, good.replace("and", "%%%and")), (103, "\n".join(["a line of text here"] * 3 + [good]))]
    df = odd_documents.select("doc_id", "text").unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    order = [x["rule"] for x in Q.cascade_order(df)]
    assert sorted(order) == sorted(Q.RULES)
    one = sorted(((r["doc_id"], *tuple(r)[1:8]) for r in Q.judge(df, order=order).collect()), key=repr)
    two = sorted(((r["doc_id"], *tuple(r)[1:8]) for r in Q.judge(df, order=order[::-1]).collect()), key=repr)
    assert one == two
    by_id = {r[0]: r for r in one}
    assert [by_id[i][7] for i in (100, 101, 102, 103)] == [True, False, False, False]
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    assert all(r[1:7] == brute(texts[r[0]]) for r in one)
    assert Q.judge(df.limit(0)).collect() == []


def test_rejected_documents_are_not_shown_again():
    seen = []
    rules = {"first": lambda d: d.text == "a", "second": lambda d: seen.append(d.text) or False}
    assert Q.run_cascade([Q.Doc("a"), Q.Doc("b")], ["first", "second"], rules) == ["first", None]
    assert seen == ["b"]


def test_verdict_equals_every_rule_and_reruns_agree(spark):
    base = [f"word{i} and{i} more{i} the" for i in range(40)]
    rows = [(0, " ".join(base)), (1, " ".join(base).upper()), (2, " ".join(base) + " " + "q" * 1001), (3, " ".join(base).replace("and", "#")), (4, None)]
    rows += [(5 + k, " ".join([*base, *["the"] * k])) for k in range(0, 60, 7)]
    rows += [(100, " ".join(f"{i}" for i in range(400))), (101, "\n".join([" ".join(base), *["a b c d"] * 3, *map(str, range(2))]))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int").repartition(3)
    want = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        chars, symbols, dup = sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), brute(text)[3]
        lines = sum(bool(x.strip()) for x in (text or "").split("\n"))
        bad = brute(text)[5] or not 3 <= chars / len(w) <= 10 or symbols > 0.1 * len(w) or dup > 0.4 * lines
        bad = bad or sum(x.isupper() for x in w) > 0.3 * len(w) or sum(any(c.isalpha() for c in x) for x in w) < 0.7 * len(w)
        want[i] = not (bad or Counter(w).most_common(1)[0][1] > 0.3 * len(w) or max(map(len, w)) > 1000)
    one, two = Q.judge(df), Q.judge(df.repartition(5))
    assert one.columns[-1] == "kept"
    assert {r["doc_id"]: r["kept"] for r in one.collect()} == want
    assert sorted(one.collect()) == sorted(two.collect())
    named = Q.judge(df, order=list(Q.RULES)).filter("doc_id = 1").first()
    assert named["failed_rule"] == "upper_case_share"


def test_order_is_measured_on_documents_that_pass_the_base(spark):
    good = " ".join(f"word{i} and{i} more{i} the" for i in range(60))
    df = spark.createDataFrame([(i, good.upper() if i % 2 else "short") for i in range(80)], "doc_id long, text string")
    order = {x["rule"]: x for x in Q.cascade_order(df)}
    assert all(x["rows"] == 40 for x in order.values())
    assert order["upper_case_share"]["rejected"] == 40.5 / 41 and order["longest_word"]["rejected"] == 0.5 / 41
