"""Encoding, packing and the Huffman format against plain versions."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidegauge.llm import huffman, packing, queries
from tidegauge.llm.tokens import PieceEncoder

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
HOSTILE = [
    "", "  ", "a  b", "a\n\nb", " x", "x ", "\n", "a \n b", "\tz\t y", "it's  don't 's", "Σας ΣΑΣ", "\x1c\n z", "\na b\nc",
    "<|endoftext|> hi <|startoftext|>", "a\x1c b\x00c", "é é ́x", "12 345  6　 7", "日本 語", None, "a\r\nb", "İ İ",
    "q  r\u0085\ns", "  x",
]


def plain(path):
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.mark.parametrize(("path", "vanish"), [(BYTE, False), (WORD, True)])
def test_pieces_give_the_ids_of_the_whole_text(path, vanish):
    encoder, want = PieceEncoder(path, vanish), plain(path)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(st.sampled_from("aé's \n\t.1́　\x1c\u0085Zİ!"), max_size=14), max_size=6))
    def check(texts):
        ids, counts = encoder.encode(pa.array(texts, pa.string()))
        at = np.concatenate([[0], np.cumsum(counts)])
        for i, t in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == want(t)

    check()
    ids, counts = encoder.encode(pa.array(HOSTILE))
    assert ids.tolist() == [i for t in HOSTILE for i in want(t)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=60))
def test_best_fit_leaves_one_half_empty_bin_at_most(lengths):
    bins, offsets, fills = packing.best_fit(np.array(lengths, np.int64), 2048)
    assert (fills <= 2048).all() and (fills * 2 <= 2048).sum() <= 1
    for b in range(len(fills)):
        inside = sorted((o, n) for o, n, x in zip(offsets, lengths, bins, strict=True) if x == b)
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:i]) for i in range(len(inside))]


def rows_of(spark, texts, extra=False):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    return df if extra else df.drop("sequence_id")


def check_packing(out, texts, capacity=2048):
    want = plain(BYTE)
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = [*want(text), 0]
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(-(-len(ids) // capacity)))
        assert all(r.length == capacity for r in pieces[1:])
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        assert all(r.ids_crc32 == crc(ids[r.start : r.start + r.length]) for r in pieces)
        assert sum(r.length for r in pieces) == len(ids)
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    return len(by_sequence), -(-sum(n for p in by_sequence.values() for _, n in p) // capacity)


def test_op7_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    used, least = check_packing(queries.op7_pack(spark, sf).collect(), texts)
    assert used <= least * 1.03 + 1


def test_packing_many_leaves_and_odd_rows(spark):
    texts = [*HOSTILE, *["word " * n for n in (1, 700, 1500, 2047, 2048, 2049, 5000)], *["w " * (97 * i % 900) for i in range(300)]]
    docs = rows_of(spark, texts, extra=True).repartition(3)
    pieces = packing.token_pieces(docs, BYTE).cache()
    placed = packing.pack(pieces, leaf_pieces=20)
    out = queries.pack_digest(pieces.join(placed, "piece_key")).collect()
    used, least = check_packing(out, dict(enumerate(texts)))
    assert used <= least * 1.05 + 2
    pieces.unpersist()
    empty = packing.packed_pieces(docs.limit(0), BYTE)
    assert queries.pack_digest(empty).count() == 0
    twice = packing.packed_pieces(docs.filter("doc_id = 24").unionAll(docs.filter("doc_id = 24")), BYTE)
    assert twice.count() == 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=80), st.integers(7, 16))
def test_code_lengths_are_limited_complete_and_ordered(counts, limit):
    counts = np.array(counts, np.int64)
    bits = huffman.code_lengths(counts, limit)
    assert bits.max() <= limit and (len(bits) == 1 or sum(2.0 ** -bits) == 1)
    order = np.argsort(counts, kind="stable")
    assert all(bits[a] >= bits[b] for a, b in zip(order, order[1:], strict=False) if counts[a] < counts[b])


def test_limited_code_equals_huffman_when_the_limit_is_loose():
    import heapq

    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34])
    heap, total = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    assert int((huffman.code_lengths(counts) * counts).sum()) == total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=900), max_size=5))
def test_code_round_trip(blocks):
    arrays = [np.array(b, np.uint32) for b in blocks]
    everything = np.concatenate([*arrays, np.zeros(0, np.uint32)])
    ids, n = np.unique(everything, return_counts=True)
    code = huffman.Code(ids.astype(np.int64), huffman.code_lengths(n))
    coded = [code.encode(a) for a in arrays]
    back = code.decode([p.tobytes() for p, _ in coded], [c.tobytes() for _, c in coded], np.array([len(a) for a in arrays]))
    assert back.tolist() == everything.tolist()


def check_ids(out, texts):
    want, at = plain(WORD), 0
    by_doc = {r.doc_id: r for r in out}
    assert set(by_doc) == set(texts)
    for doc in sorted(texts):
        ids = [*want(texts[doc]), 2]
        assert (by_doc[doc].start, by_doc[doc].n_tokens, by_doc[doc].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)


def test_op9_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check_ids(queries.op9_token_ids(spark, sf).collect(), texts)


def test_token_ids_of_odd_tables(spark, tmp_path):
    texts = dict(enumerate([*HOSTILE, "long " * 90_000, *["some words"] * 40]))
    rows_of(spark, list(texts.values()), extra=True).repartition(4).write.parquet(f"{tmp_path}/a/documents.parquet")
    check_ids(queries.op9_token_ids(spark, f"{tmp_path}/a").collect(), texts)
    rows_of(spark, []).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert queries.op9_token_ids(spark, f"{tmp_path}/b").collect() == []
    rows_of(spark, ["a b"]).unionAll(rows_of(spark, ["a b"])).write.parquet(f"{tmp_path}/c/documents.parquet")
    assert sorted(r.start for r in queries.op9_token_ids(spark, f"{tmp_path}/c").collect()) == [0, 3]
