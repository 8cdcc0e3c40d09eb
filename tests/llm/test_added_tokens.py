"""Texts that hold an added token's literal text, against the tokenizer files as they are."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidegauge.llm import queries
from tidegauge.llm.tokens import PieceEncoder

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
TEXTS = [
    "hi <|endoftext|> x", "<|endoftext|>", "word<|endoftext|>!? 's", "a\n\n<|endoftext|>  b <|startoftext|>", "plain text, here.",
    "<|EndOfText|> <|STARTOFTEXT|>", "<|endoftext|><|endoftext|> Zé ", "<|endof text|> x", "", None, "<|startoftext|>Σας ΣΑΣ\x1c\n z",
]


def want(path):
    t = Tokenizer.from_file(path)
    return [t.encode(x or "", add_special_tokens=False).ids for x in TEXTS]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize(("path", "vanish"), [(BYTE, False), (WORD, True)])
def test_added_tokens_are_recognised(path, vanish):
    encoder = PieceEncoder(path, vanish)
    for _ in range(2):  # the second time pieces are remembered
        ids, counts = encoder.encode(pa.array(TEXTS))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want(path)
    assert encoder.encode(pa.array(TEXTS[:1]))[0].tolist() == ([5303, 220, 50256, 2124] if path == BYTE else [1883, 49407, 343])


def test_op7_and_op9_queries(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    packed = {r.doc_id: r for r in queries.op7_pack(spark, str(tmp_path)).collect()}
    stored = {r.doc_id: r for r in queries.op9_token_ids(spark, str(tmp_path)).collect()}
    at = 0
    for i, (by_byte, by_word) in enumerate(zip(want(BYTE), want(WORD), strict=True)):
        assert (packed[i].length, packed[i].ids_crc32) == (len(by_byte) + 1, crc([*by_byte, 0]))
        assert (stored[i].start, stored[i].n_tokens, stored[i].ids_crc32) == (at, len(by_word) + 1, crc([*by_word, 2]))
        at += len(by_word) + 1
