"""Token ids in a compact binary format: canonical length-limited Huffman codes from the counts of the whole corpus.

Three tables below one path:

- ``codebook`` (id, bits): the code length of each id in use. Codes are canonical: shorter first, then by id.
- ``blocks`` (file_no, block_no, doc_ids, counts, n_ids, checkpoints, payload): whole documents in ascending order of
  doc_id, about ``BLOCK_IDS`` ids each. ``payload`` is the bit stream, ``checkpoints`` the bit offset of every
  ``STRIDE``-th id (little-endian unsigned 32-bit), so each block, and each stride in it, is decoded by itself.
- files are numbered in ascending order of doc_id; all parts are written by Spark's own committed writer.

Decoding looks up ``max_bits`` bits at a time in a table, at all checkpoints of a batch side by side.

Rows: a NULL text counts as empty and is stored as its end id; rows without a doc_id stay so and come first; repeated ids are stored in a fixed order; an empty table
gives empty tables; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import drop_tables, materialize, slices, small_batches
from tidegauge.llm.tokens import blobs, encode_batches

END_ID = 2
BLOCK_IDS = 1 << 16
STRIDE = 256
MAX_BITS = 16

ENCODED = "doc_id long, tie long, ids binary"
BLOCKS = (
    "file_no int, block_no int, doc_ids array<long>, counts array<int>, n_ids long, checkpoints binary, payload binary"
)
DECODED = "doc_id long, file_no int, block_no int, inside long, n_tokens long, ids binary"


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive counts (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids do not fit codes of {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, current = [], leaves
    is_leaf = np.ones(n, bool)
    for _ in range(max_bits - 1):
        levels.append(is_leaf)
        even = len(current) // 2 * 2
        packages = current[0:even:2] + current[1:even:2]
        joined = np.concatenate([leaves, packages])
        rank = np.argsort(joined, kind="stable")
        current, is_leaf = joined[rank], rank < n
    levels.append(is_leaf)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        chosen = int(is_leaf[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (take - chosen)
    return lengths


def canonical_codes(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The code of each id: counting up by (length, id)."""
    codes, code, last = np.zeros(len(ids), np.int64), 0, 0
    for i in np.lexsort((ids, bits)).tolist():
        code <<= int(bits[i]) - last
        last = int(bits[i])
        codes[i] = code
        code += 1
    return codes


class Code:
    """Encoding and decoding tables of one codebook."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        self.width = int(bits.max()) if len(bits) else 1
        size = int(ids.max()) + 1 if len(ids) else 1
        codes = canonical_codes(ids, bits)
        self.code, self.bits = np.zeros(size, np.uint32), np.zeros(size, np.int32)
        self.code[ids], self.bits[ids] = codes, bits
        spans = np.left_shift(1, self.width - bits)
        first = np.left_shift(codes, self.width - bits)
        self.symbol = np.zeros(1 << self.width, np.uint32)
        self.step = np.ones(1 << self.width, np.int64)
        for i in np.argsort(first).tolist():
            at = slice(int(first[i]), int(first[i] + spans[i]))
            self.symbol[at], self.step[at] = ids[i], bits[i]

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the bit stream, and the bit offset of every ``STRIDE``-th id."""
        bits = self.bits[ids]
        ends = np.cumsum(bits, dtype=np.int64)
        starts = ends - bits
        total = int(ends[-1]) if len(ends) else 0
        out = np.zeros((total + 7) // 8 + 4, np.uint8)
        if len(ids):
            # a code touches so many bytes at most; codes that begin in one byte are put together first
            touched = (self.width + 14) // 8
            word = self.code[ids] << (8 * touched - bits - (starts & 7)).astype(np.uint32)
            byte = starts >> 3
            groups = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]]))
            at = byte[groups]
            word = np.bitwise_or.reduceat(word, groups)
            for k in range(touched):
                out[at + k] |= (word >> np.uint32(8 * (touched - 1 - k))).astype(np.uint8)
        return out[: (total + 7) // 8], starts[::STRIDE].astype("<u4")

    def decode(self, payloads: list[bytes], checkpoints: list[bytes], n_ids: np.ndarray) -> np.ndarray:
        """All ids of the given blocks in a row, decoded side by side from every checkpoint."""
        sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
        stream = np.frombuffer(b"".join(payloads) + bytes(4 * self.width * STRIDE // 8 + 8), np.uint8)
        base = (np.cumsum(sizes) - sizes) * 8
        lanes = [np.frombuffer(c, "<u4").astype(np.int64) + b for c, b in zip(checkpoints, base, strict=True)]
        at = np.concatenate(lanes) if lanes else np.zeros(0, np.int64)
        per_block = np.fromiter(map(len, lanes), np.int64, len(lanes))
        left = np.full(len(at), STRIDE)
        full = per_block > 0
        left[np.cumsum(per_block)[full] - 1] = n_ids[full] - (per_block[full] - 1) * STRIDE
        out = np.zeros((len(at), STRIDE), np.uint32)
        last = len(stream) - 4
        mask, shift = (1 << self.width) - 1, 32 - self.width
        for k in range(STRIDE if len(at) else 0):
            byte = np.minimum(at >> 3, last)
            word = (
                (stream[byte].astype(np.int64) << 24) | (stream[byte + 1].astype(np.int64) << 16)
                | (stream[byte + 2].astype(np.int64) << 8) | stream[byte + 3]
            )
            seen = (word >> (shift - (at & 7))) & mask
            out[:, k] = self.symbol[seen]
            at = at + self.step[seen]
        return out[np.arange(STRIDE) < left[:, None]]


def id_type(tokenizer: str, end_id: int = END_ID) -> str:
    """The smallest little-endian type that holds every id of the tokenizer file."""
    from tokenizers import Tokenizer

    most = max(end_id, *Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values())
    return "<u2" if most < 1 << 16 else "<u4"


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, tie, ids) of every document, the end id included; ids as bytes of :func:`id_type`. ``tie`` orders the rows
    of a doc_id."""
    kind = id_type(tokenizer, end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, counts in encode_batches(batches, tokenizer, spaces_vanish=True):
            ends = np.cumsum(counts + 1)
            values = np.full(int(ends[-1]), end_id, kind)
            text = np.ones(len(values), bool)
            text[ends - 1] = False
            values[text] = ids
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), blobs(values, ends)], ["doc_id", "tie", "ids"]
            )

    small_batches(docs.sparkSession, 2048)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    return rows.mapInArrow(encode, ENCODED)


def id_counts(rows: DataFrame, kind: str) -> DataFrame:
    """(id, n): how often each id stands in ``rows`` (ids). One row per id and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            seen = np.bincount(values_of(batch.column("ids"), kind)[0])
            if len(seen) > len(total):
                seen, total = total, seen
            total[: len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return rows.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def values_of(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column in a row, and the number of each."""
    ends, raw = column.buffers()[1:]
    at = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None and len(column) else np.zeros(0, np.uint8)
    return held.view(kind), np.diff(at) // np.dtype(kind).itemsize


def coded_blocks(rows: DataFrame, ids: np.ndarray, bits: np.ndarray, kind: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``rows`` (doc_id, tie, ids) in ascending order as blocks of coded ids; a partition is a file."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, file_no, block_no = Code(ids, bits), TaskContext.get().partitionId(), 0
        doc_ids: list[pa.Array] = []
        held: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            stream, points = code.encode(np.concatenate(held))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file_no], pa.int32()), pa.array([block_no], pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, sum(map(len, doc_ids))], pa.int32()), pa.concat_arrays(doc_ids)),
                    pa.array([np.concatenate(lengths)], pa.list_(pa.int32())), pa.array([size], pa.int64()),
                    pa.array([points.tobytes()], pa.binary()), pa.array([stream.tobytes()], pa.binary()),
                ],
                ["file_no", "block_no", "doc_ids", "counts", "n_ids", "checkpoints", "payload"],
            )

        for batch in slices(batches, "ids"):
            values, n = values_of(batch.column("ids"), kind)
            ends = np.cumsum(n)
            own = batch.column("doc_id")
            begin, base = 0, 0
            while begin < len(n):
                upto = int(np.searchsorted(ends, base + block_ids - size, "left")) + 1
                upto = min(max(upto, begin + 1), len(n))
                doc_ids.append(own.slice(begin, upto - begin))
                lengths.append(n[begin:upto].astype(np.int32))
                held.append(values[base : int(ends[upto - 1])])
                size += int(ends[upto - 1]) - base
                base, begin = int(ends[upto - 1]), upto
                if size >= block_ids:
                    yield block()
                    block_no += 1
                    doc_ids, held, lengths, size = [], [], [], 0
        if doc_ids:
            yield block()

    small_batches(rows.sparkSession, 512)
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return ordered.drop("tie").mapInArrow(gather, BLOCKS)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) below ``path``. The texts are read once and not shuffled: what is put in order are
    the ids."""
    spark, kind = docs.sparkSession, id_type(tokenizer, end_id)
    rows = materialize(encoded(docs, tokenizer, end_id), "encoded-ids")
    counts = sorted(map(tuple, id_counts(rows, kind).collect()))  # one row per id of the tokenizer at most
    ids, n = (np.array([c[k] for c in counts], np.int64) for k in (0, 1))
    bits = code_lengths(n, max(MAX_BITS, (len(n) - 1).bit_length()))
    book = spark.createDataFrame(list(zip(ids.tolist(), bits.tolist(), strict=True)), "id int, bits int")
    book.coalesce(1).write.parquet(f"{path}/codebook")
    coded_blocks(rows, ids, bits, kind).write.option("compression", "none").parquet(f"{path}/blocks")
    drop_tables(rows)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents decoded from the blocks: (doc_id, file_no, block_no, inside, n_tokens, ids); ``inside`` counts the ids of
    the documents before it in its block."""
    book = spark.read.parquet(f"{path}/codebook").collect()  # one row per id of the tokenizer at most
    ids, bits = (np.array([r[k] for r in book], np.int64) for k in ("id", "bits"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(ids, bits)
        for batch in batches:
            n_ids = batch.column("n_ids").to_numpy()
            values = code.decode(
                batch.column("payload").to_pylist(), batch.column("checkpoints").to_pylist(), n_ids
            )
            counts = batch.column("counts").flatten().to_numpy().astype(np.int64)
            per_block = np.diff(np.asarray(batch.column("counts").offsets))
            row = np.repeat(np.arange(len(per_block)), per_block)
            ends = np.cumsum(counts)
            inside = ends - counts - (np.cumsum(n_ids) - n_ids)[row]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_ids").flatten(), batch.column("file_no").take(pa.array(row)),
                    batch.column("block_no").take(pa.array(row)), pa.array(inside), pa.array(counts),
                    blobs(values.astype("<u4"), ends),
                ],
                ["doc_id", "file_no", "block_no", "inside", "n_tokens", "ids"],
            )

    small_batches(spark, 16)
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(decode, DECODED)


def with_starts(decoded: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """``decoded`` with ``start``, the ids of all documents before it: those of earlier files, of earlier blocks of the
    file, and of earlier documents of the block. Only sums per block and file are shuffled, never documents."""
    sizes = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").select("file_no", "block_no", "n_ids")
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    files = sizes.groupBy("file_no").agg(F.sum("n_ids").alias("n")).select(
        "file_no", F.coalesce(F.sum("n").over(before("file_no")), F.lit(0)).alias("file_start")
    )
    blocks = sizes.select(
        "file_no", "block_no", F.coalesce(F.sum("n_ids").over(before("file_no", "block_no")), F.lit(0)).alias("at")
    ).join(files, "file_no").select("file_no", "block_no", (F.col("at") + F.col("file_start")).alias("block_start"))
    return decoded.join(blocks, ["file_no", "block_no"]).withColumn(
        "start", F.col("block_start") + F.col("inside")
    )
