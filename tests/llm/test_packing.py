import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import packing as P
from strata.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def plain(rows, longest=4096):
    """(doc_id, start, length, crc, doc_tokens) of every piece, by subtraction of powers of two."""
    direct = Tokenizer.from_file(VOCABULARY)
    out = []
    for d, t in rows:
        ids = [*direct.encode(t or "", add_special_tokens=False).ids, 2]
        at, power = 0, longest
        while at < len(ids):
            while power > len(ids) - at:
                power //= 2
            piece = np.array(ids[at : at + power], "<u4").tobytes()
            out.append((d, at, power, zlib.crc32(piece), len(ids)))
            at += power
    return out


def test_pieces_are_the_binary_digits():
    counts = np.array([1, 2, 3, 4095, 4096, 4097, 3 * 4096 + 5, 8])
    of, start, length = P.pieces(counts)
    for i, n in enumerate(counts):
        mine = length[of == i]
        assert mine.sum() == n and (np.diff(mine) <= 0).all() and (start[of == i] == np.cumsum(mine) - mine).all()
        assert len(mine) == (n >> 12) + bin(n & 4095).count("1")
    assert P.pieces(np.zeros(0, np.int64))[0].tolist() == []


ROWS = [
    (1, "one two three"), (1, "one two three"), (1, "another text of the same id"), (2, None), (3, ""), (4, " \n "), (None, "no id"), (None, None),
    (5, "long words here " * 9_000), (-6, "ÉTÉ l'été <|endoftext|> 123"), (7, "w" * 20_000), *[(i, f"word {i} " * (i % 50)) for i in range(100, 260)],
]


@pytest.mark.parametrize("longest", [4096, 16])
def test_every_id_lies_in_one_piece(spark, longest):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in ROWS], "doc_id long, text string, length string, ids int, rank int").repartition(4)
    got = P.pack(df, VOCABULARY, longest=longest).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(plain(ROWS, longest))
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got)))
    assert all(r["offset"] == 0 for r in got)
    by_number = sorted(got, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_number] == sorted((r["length"] for r in got), reverse=True)
    assert all(r["length"] & (r["length"] - 1) == 0 and r["length"] <= longest for r in got)


def test_reruns_agree(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    runs = [Counter(map(tuple, P.pack(df.repartition(n), VOCABULARY).collect())) for n in (1, 7)]
    assert runs[0] == runs[1]


def test_buckets_hold_the_ids(spark, tmp_path):
    df = spark.createDataFrame(ROWS[:9], "doc_id long, text string")
    packed = P.write_buckets(df, VOCABULARY, str(tmp_path / "b"))
    direct = Tokenizer.from_file(VOCABULARY)
    parts = sorted((r["start"], bytes(r["ids"])) for r in packed.filter("doc_id = 5").collect())
    want = [*direct.encode(ROWS[8][1], add_special_tokens=False).ids, 2]
    assert np.frombuffer(b"".join(p for _, p in parts), "<u4").tolist() == want
    assert {r["length"] for r in packed.select("length").distinct().collect()} == {int(p.name.split("=")[1]) for p in (tmp_path / "b").glob("length=*")}


def test_query_and_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    empty = QUERIES["op13_sequence_packing"](spark, str(tmp_path))
    assert empty.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and empty.count() == 0
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY, longest=100)
