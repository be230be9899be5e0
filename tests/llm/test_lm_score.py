import math
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import lm_score as L


def brute(rows, k):
    docs = []
    for d, t in rows:
        held = d is not None and zlib.crc32(str(d).encode()) % 7 == 2
        docs.append((d, held, [*(t or "").encode().lower().split(), None]))
    uni, bi, begins = Counter(), Counter(), 0
    for _, held, w in docs:
        if not held:
            uni.update(w)
            bi.update(zip(["<", *w], w))
            begins += 1
    n, v = sum(uni.values()), len(uni)
    out = []
    for d, held, w in docs:
        root = [(uni[x] + 1) / (n + v + 1) for x in w]
        left = [begins, *[uni[x] for x in w]]
        step = [(bi[a, x] + k * p) / (c + k) for a, x, p, c in zip(["<", *w], w, root, left)]
        out.append((d, held, len(w), sum(uni[x] > 0 for x in w), n, sum(map(math.log10, root)), sum(map(math.log10, step))))
    return out


@pytest.mark.parametrize("block_tokens,stable", [(4_000_000, False), (60, False), (60, True)])
def test_equals_brute_force(spark, odd_documents, block_tokens, stable, tmp_path):
    odd = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    rows = odd + [(100 + i, f"The cat {'sat on' if i % 3 else 'ran off'} the mat {i % 7} É é") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    if stable:
        df.write.parquet(str(tmp_path / "t"))
        df = spark.read.parquet(str(tmp_path / "t"))
    got = sorted((tuple(r) for r in L.score(df, stable=stable, block_tokens=block_tokens).collect()), key=repr)
    want = sorted(brute(rows, L.K), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_distribution_sums_to_one(spark):
    """After any known word, the known words, the end and one unknown word share all probability."""
    rows = [(i, t) for i, t in enumerate(["a b a b", "b a", "a a c", "c b a b", "b"])]
    probe = spark.createDataFrame(rows, "doc_id long, text string")
    words = ["a", "b", "c", "unknown"]
    texts = [(1000 + 7 * i, x) for i, x in enumerate(["a", *[f"a {w}" for w in words]])]
    held = [(next(j for j in range(10_000 * (i + 1), 10_000 * (i + 2)) if zlib.crc32(str(j).encode()) % 7 == 2), t) for i, (_, t) in enumerate(texts)]
    trained = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    got = {r[0]: r for r in brute(trained + held, L.K)}
    df = probe.unionAll(spark.createDataFrame(held, "doc_id long, text string"))
    for r in L.score(df).collect():
        if r["doc_id"] in got:
            assert r["score"] == pytest.approx(got[r["doc_id"]][6])


def test_packing():
    for values in ([], [7], [3, 2**64 - 1], sorted(range(0, 10**6, 7)), [0, 1, 2**48]):
        h, c = np.array(values, np.uint64), np.arange(len(values)) % 600
        got = L._unpack(L._pack(h, c))
        assert (got[0] == h).all() and (got[1] == c).all()


def test_empty_table(spark, odd_documents):
    assert L.score(odd_documents.limit(0)).collect() == []
