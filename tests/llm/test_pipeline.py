import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
    direct = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in docs.collect():
        ids = np.array([*direct.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((r["doc_id"], len(ids), zlib.crc32(ids.tobytes())))
    got = P.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(want)
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0


def test_odd_rows_pass_all_stages(spark, odd_documents):
    docs = odd_documents
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() >= 1
    empty = odd_documents.limit(0)
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, empty, SF).count() == 0
