import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from martforge.llm import bpe

TEXTS = ["", None, " ", "\n\n  a", "aaaa aaaaa", "it's we'll DON'T", "x<|endoftext|>y<|endoftext|>", "<|endoftext|>",
         "naïve café 中文 текст 🙂🙂", "a b c\x1c\x1fd　 \t e", "123 4567 ½ Ⅷ", "\u0000﻿퟿", "The the THE " * 3000,
         "x" * 20_000, "tab\tand\r\nnew  \n line ", "The the THE ", "The the THE "]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def expected(reference, text):
    ids = reference.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_matches_tokenizers(spark, reference):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.encode(docs, P.path("byte_bpe_50k.json")).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == expected(reference, t), repr(t)[:50]
        assert got[i].ids == reference.encode(t or "", add_special_tokens=False).ids


def test_whole_table(spark, reference):
    from martforge.llm.queries import op6_bpe_codec
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op6_bpe_codec(spark, d).collect()}
    texts = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for r in texts:
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == expected(reference, r.text)


def test_empty_table_and_null_id(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(docs, P.path("byte_bpe_50k.json")).collect() == []
    docs = spark.createDataFrame([(None, "a")], "doc_id long, text string")
    assert bpe.encode(docs, P.path("byte_bpe_50k.json")).first().n_tokens == 1
