import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import token_files as T

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=400), st.integers(1, 9))
def test_pack_round_trip(values, repeat):
    ids = np.array(values * repeat, np.uint64)
    assert (T.unpack(*T.pack(ids)) == ids).all()


def test_pack_zero_runs_and_density():
    ids = np.zeros(5000, np.uint64)
    words = T.pack(ids)[0]
    assert len(words) <= 5 * 9
    assert (T.unpack(*T.pack(ids)) == ids).all()


TEXTS = [
    None, "", "   \n ", "Hello, World!  it's I'LL 'tis", "É́ é x ́y", "a<|endoftext|>b <|startoftext|>", "x\x1cy\x85z q",
    "ΑΣ ΑΣΑ ǅ İ", "12 345 ½ Ⅷ", "日本語 テスト", "😀👍🏽 ok", "a" * 3000,
]


def test_chunks_equal_whole_text():
    direct = Tokenizer.from_file(VOCABULARY)
    enc = T.ChunkEncoder(VOCABULARY, limit=9)
    for _ in range(2):
        counts, ids = enc.encode(TEXTS, 1)
        want = [[*direct.encode(t or "", add_special_tokens=False).ids, 1] for t in TEXTS]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [x for w in want for x in w]


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_chunks_equal_whole_text_anything(text):
    direct = Tokenizer.from_file(VOCABULARY)
    assert T.encoder(VOCABULARY).encode([text], None)[1].tolist() == direct.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file_ids", [20, 3_000_000])
def test_files(spark, file_ids):
    rows = [(i * 3 % 11, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (5, "twice", "x"), (5, "twice", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = sorted(T.round_trip(df, VOCABULARY, file_ids=file_ids).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    direct = Tokenizer.from_file(VOCABULARY)
    left = {}
    for d, t, _ in rows:
        ids = np.array([*direct.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        left.setdefault(d, []).append((len(ids), zlib.crc32(ids.tobytes())))
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
        left[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
    assert not any(left.values())


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert T.round_trip(df, VOCABULARY).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aBéÉßœŒÿİıſŉΣς.,'_-<|>!×÷9 1̸́ª", max_size=40))
def test_words_and_marks_equal_whole_text(text):
    direct = Tokenizer.from_file(VOCABULARY)
    enc = T.encoder(VOCABULARY)
    assert enc.by_words
    assert enc.encode([text], None)[1].tolist() == direct.encode(text, add_special_tokens=False).ids


def test_vocabulary_without_word_ends_is_not_cut_into_words():
    assert not T.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json")).by_words


def test_vocabulary_without_word_ends_gets_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    direct = Tokenizer.from_file(path)
    counts, ids = T.ChunkEncoder(path).encode(TEXTS, 3)
    want = [[*direct.encode(t or "", add_special_tokens=False).ids, 3] for t in TEXTS]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]


def test_forgetting_changes_nothing():
    direct = Tokenizer.from_file(VOCABULARY)
    enc = T.ChunkEncoder(VOCABULARY, limit=20)
    for i in range(200):
        text = f"the word{i} and {'long' * (i % 40)} it's {i}, ÆTHER{i % 7} ∂x{i}"
        assert enc.encode([text, "the end"], 1)[1].tolist() == [*direct.encode(text).ids, 1, *direct.encode("the end").ids, 1]
    assert len(enc.places) < 60
