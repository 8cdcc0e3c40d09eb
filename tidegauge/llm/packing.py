"""Best-fit packing of tokenised documents into sequences of fixed capacity, by hierarchical residual packing.

Groups of pieces are packed by best fit, largest first, in parallel. Bins that are nearly full are final. The others are
items of the next round, where groups of groups are packed in the same way, up a tree, until one group is left. In a
best-fit group at most one bin is half full or less (two such bins would have been joined), and two bins above one half
never fit together; so what a group must hand up is one small bin and some emptier partners, whatever its size.

Rows: a NULL text counts as empty and is packed as its end id alone; repeated rows are packed each by itself; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import materialize, small_batches
from tidegauge.llm.tokens import blobs, encode_batches

CAPACITY = 2048
END_ID = 0
#: Pieces that one task of the first round packs.
LEAF_PIECES = 50_000
#: Groups that one task of a later round brings together.
FAN_IN = 8
#: Emptiest bins above one half that a group hands up as partners, beside its one small bin.
PARTNERS = 64
#: Free tokens up to which a bin counts as full.
NEARLY_FULL = 4

PIECES = "piece_key long, doc_id long, piece int, start long, length long, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Ids of each document with ``end_id`` behind, cut into pieces of ``capacity`` where it is longer; the first piece
    is then the shorter one. ``ids`` holds little-endian unsigned 32-bit ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        for batch, ids, counts in encode_batches(batches, tokenizer, spaces_vanish=False):
            n = counts + 1
            ends = np.cumsum(n)
            values = np.full(int(ends[-1]), end_id, np.uint32)
            text = np.ones(len(values), bool)
            text[ends - 1] = False
            values[text] = ids
            per_doc = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), per_doc)
            first = np.cumsum(per_doc) - per_doc
            lengths = np.full(len(row), capacity, np.int64)
            lengths[first] = n - (per_doc - 1) * capacity
            piece = np.arange(len(row)) - first[row]
            piece_ends = np.cumsum(lengths)
            start = piece_ends - lengths - (ends - n)[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key + np.arange(len(row))), batch.column("doc_id").take(pa.array(row)),
                    pa.array(piece.astype(np.int32)), pa.array(start), pa.array(lengths), blobs(values, piece_ends),
                ],
                ["piece_key", "doc_id", "piece", "start", "length", "ids"],
            )
            key += len(row)

    small_batches(docs.sparkSession, 2048)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin: largest first, into the fullest bin that has room.

    The open bins of each free size are a stack, and the sizes with open bins are bits of one integer.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fills: list[int] = []
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    sizes = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = sizes >> n
        if fitting:
            free = n + (fitting & -fitting).bit_length() - 1
            b = stacks[free].pop()
            if not stacks[free]:
                sizes ^= 1 << free
        else:
            free, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        if free > n:
            stacks[free - n].append(b)
            sizes |= 1 << (free - n)
    return bins, offsets, np.asarray(fills, np.int64)


def handed_up(fills: np.ndarray, capacity: int) -> np.ndarray:
    """Which bins a group passes on: all half full or less (one at most), and the emptiest of the rest."""
    useful = np.flatnonzero((fills * 2 > capacity) & (fills < capacity - NEARLY_FULL))
    out = fills * 2 <= capacity
    out[useful[np.argsort(fills[useful], kind="stable")[:PARTNERS]]] = True
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, leaf_pieces: int = LEAF_PIECES) -> DataFrame:
    """(piece_key, sequence_id, offset) for rows (piece_key, length)."""
    slim = pieces.select("piece_key", "length")
    short = slim.filter(F.col("length") < capacity)
    groups = max(1, -(-short.count() // leaf_pieces))
    leaf = F.pmod(F.xxhash64("piece_key"), F.lit(groups))

    def pack_leaf(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("piece_key")
        bins, offsets, fills = best_fit(pdf["length"].to_numpy(), capacity)
        up = handed_up(fills, capacity)
        return pd.DataFrame({
            "piece_key": pdf["piece_key"].to_numpy(), "bin": (int(key[0]) << 40) + bins, "offset": offsets,
            "fill": fills[bins], "up": up[bins],
        })

    placed = materialize(
        short.withColumn("leaf", leaf).groupBy("leaf").applyInPandas(
            pack_leaf, "piece_key long, bin long, offset long, fill long, up boolean"
        ),
        "packed",
    )
    whole = slim.filter(F.col("length") >= capacity).select(
        "piece_key", (-F.col("piece_key") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    open_bins = placed.filter("up").select("bin", "fill").distinct()
    moves = merge_up(open_bins, groups, capacity)
    if moves is None:
        return whole.unionByName(placed.select("piece_key", F.col("bin").alias("sequence_id"), "offset"))
    moved = placed.join(moves, "bin", "left").select(
        "piece_key", F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
    return whole.unionByName(moved)


def merge_up(open_bins: DataFrame, groups: int, capacity: int) -> DataFrame | None:
    """(bin, into, shift): where each open bin of the leaves ends up; NULL result when there is one leaf only."""
    if groups <= 1:
        return None

    def repack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        bins, offsets, fills = best_fit(pdf["fill"].to_numpy(), capacity)
        own = pdf["bin"].to_numpy()
        lead = np.zeros(len(fills), np.int64)
        lead[bins[::-1]] = own[::-1]
        return pd.DataFrame({
            "bin": own, "into": lead[bins], "shift": offsets, "fill": fills[bins],
            "up": handed_up(fills, capacity)[bins],
        })

    state = open_bins.select(
        "bin", F.col("bin").alias("into"), F.lit(0).cast("long").alias("shift"), "fill", F.lit(True).alias("up")
    )
    width = 1
    while width < groups:
        width *= FAN_IN
        items = state.filter("up").select(F.col("into").alias("bin"), "fill").distinct()
        node = F.floor(F.shiftright("bin", 40) / F.lit(width))
        step = items.withColumn("node", node).groupBy("node").applyInPandas(
            repack, "bin long, into long, shift long, fill long, up boolean"
        ).select(F.col("bin").alias("into"), F.col("into").alias("next"), F.col("shift").alias("more"),
                 F.col("fill").alias("now"), F.col("up").alias("still"))
        state = materialize(
            state.join(step, "into", "left").select(
                "bin", F.coalesce("next", "into").alias("into"),
                (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"),
                F.coalesce("now", "fill").alias("fill"), F.coalesce("still", F.lit(False)).alias("up"),
            ),
            "merged",
        )
    return state.select("bin", "into", "shift")


def packed_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece with its ids, sequence and place: (piece_key, doc_id, piece, start, length, ids, sequence_id,
    offset). The sequences are the ids of each ``sequence_id`` in order of ``offset``."""
    pieces = materialize(token_pieces(docs, tokenizer, capacity, end_id), "pieces")
    return pieces.join(pack(pieces, capacity), "piece_key")
