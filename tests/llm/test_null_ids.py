"""Token ids of rows without a doc_id."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidegauge.llm import huffman, queries

WORD = public_tokenizers.path("word_bpe_49k.json")


def test_op9_of_rows_without_doc_id(spark, tmp_path):
    rows = [(3, "three words here"), (None, "no id"), (-5, "below zero"), (2**53 + 1, "no float holds this id"), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    t, at, got = Tokenizer.from_file(WORD), 0, queries.op9_token_ids(spark, str(tmp_path)).collect()
    ids = lambda x: [*t.encode(x or "", add_special_tokens=False).ids, 2]
    crc = lambda x: zlib.crc32(np.asarray(ids(x), "<u4").tobytes())
    want = {(d, len(ids(x)), crc(x)) for d, x in rows}
    assert len(got) == len(rows) and {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == [None, None, -5, 3, 2**53 + 1]


def test_a_block_of_null_ids_alone(spark):
    docs = spark.createDataFrame([(None, "a b")] * 3, "doc_id long, text string")
    rows, kind = huffman.encoded(docs, WORD), huffman.id_type(WORD)
    ids = np.array(sorted(r.id for r in huffman.id_counts(rows, kind).collect()))
    blocks = huffman.coded_blocks(rows, ids, huffman.code_lengths(np.ones(len(ids), np.int64)), kind)
    assert [r.doc_ids for r in blocks.collect()] == [[None] * 3]
