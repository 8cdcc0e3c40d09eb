"""Exact Jaccard self-join on word n-grams by vertical partitioning, with the classes of linked documents.

The global order of n-grams is that of their 64-bit hashes. It is cut into fragments, and so is every set:

1. **Candidates.** Linked sets of ``a`` and ``b`` n-grams differ in at most ``D = (a+b)(100-p)/(100+p)`` of them for ``p``
   percent, so of ``F > D`` fragments ``F - D`` at least are equal in both. A set stands under its fragments but for the
   ``F - D - 1`` first by (n-grams in it, hash), ``D`` being that of its largest partner: the order is the same for equal
   fragments, so one that is equal in both stays in both. What stays are the fuller fragments, which sets that only share
   some passages do not have in common. Sets meet under equal (size class, fragment, content). Tiny sets (18 n-grams for
   90 percent, 8 for 80) differ in one n-gram at most on either side and meet under themselves less one. No linked pair is
   missed. Sets that meet within a part of a task's texts are tied there, and one of
   them stands for all, so a key sends one row for each such part, however many sets have it.
2. **Overlaps with a centre.** Sets that meet, directly or by others, are a group, and the smallest of its nodes is the
   centre. Each set is compared with it once: common n-grams are counted fragment by fragment, each fragment separately,
   and the counts summed. What remains of the set are the n-grams that it or the centre has and not both.
3. **Rest.** Groups that are not yet one class are compared blockwise, by these differences alone: two sets differ by the
   n-grams in which their differences differ, which gives their overlap exactly. Partial matrices per fragment are summed
   for blocks of bounded size; a block returns one row per document. All pairs of a group are never rows.

Exact copies are one set (equal 128-bit sums of n-gram hashes and equal counts); the copies get its class. A set is known
by a 64-bit node made from these; should two sets share one, both get another.

Rows: NULL or blank text has no n-grams and its own class; fewer words than the width are one n-gram; rows that repeat a
doc_id are judged each by its own text; a row without a doc_id takes part and
gets the smallest doc_id of its class, or NULL; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import drop_tables, materialize, slices, small_batches, space_words
from tidegauge.llm.components import connected_components

#: Words of an n-gram, and linked: percent * union <= 100 * intersection. These are what ``op10_ngram_join`` joins by;
#: each function takes others, and size classes and fragment counts are derived from them.
WIDTH, PERCENT = 3, 90
#: Size classes grow by this factor.
GROWTH = 1.5
#: Fragments beyond the differences of a linked pair, in percent of these: so many sparse ones need not be keys.
SPARE = 30
#: Fragments in which overlaps are counted.
FRAGMENTS = 8
#: Bytes of text within which sets are tied before keys are shuffled.
TIED_BYTES = 4 << 20
#: Bounds of one side of a block in step 3, and of the n-grams of a star's part in step 2.
BLOCK_NGRAMS, BLOCK_SETS = 1_000_000, 2_000

#: Rows of one or two numbers up to which a table of groups is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 50_000
#: Which rows may be candidates is told by bits, about so many for each candidate, before texts are shuffled. They stand
#: in bitmaps of 32,768 (4 KB), of which there are at most so many, however many candidates there are.
BITS_EACH, BITMAP_BITS, MOST_BITMAPS = 16, 1 << 15, 2048

SETS = "doc_id long, text_hash long, n_shingles long, node long, sig_a long, sig_b long"
PARTS = "node long, cluster long, chunk int, n long, grams array<array<long>>"
COMPARED = "node long, cluster long, n long, linked boolean, n_apart long, apart array<array<long>>"


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def gram_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    import xxhash

    words, at, counts = space_words(texts)
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    h = own[at] if len(at) else np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        grams = h.copy()
        for k in range(1, width):
            grams = mixed(grams[:-1], k) + h[k:] if len(grams) > 1 else grams[:0]
    grams = mixed(grams, 77)
    begin = 0
    for n in counts.tolist():
        if n >= width:
            yield np.unique(grams[begin : begin + n - width + 1])
        elif n:
            short = np.uint64(n)
            for k in range(n):
                short = mixed(np.array([short]), 5)[0] ^ h[begin + k]
            yield mixed(np.array([short]), 99)
        else:
            yield np.zeros(0, np.uint64)
        begin += n


def fragment_sums(grams: np.ndarray, fragments: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash sum and size of each of ``fragments`` equal ranges of the n-gram order."""
    high = (grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
    ends = np.searchsorted(high, np.arange(fragments + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(grams, 3), dtype=np.uint64)])
        return sums[ends[1:]] - sums[ends[:-1]], np.diff(ends)


def tiny(percent: int) -> int:
    """The size up to which linked sets have one n-gram at most that the other lacks: fewer common ones than this do
    not outweigh two differences."""
    return -(-2 * percent // max(100 - percent, 1))


def size_classes(size: int, percent: int = PERCENT) -> Iterator[tuple[int, int]]:
    """(class, largest size in it) for the class of ``size`` and for the later ones that a linked set can be in."""
    low, k, reach = tiny(percent) + 1, 0, size * 100 // percent
    while low <= reach:
        after = int(low * GROWTH)
        if reach >= low and size < after:
            yield k, after - 1
        low, k = after, k + 1


def candidate_keys(grams: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    n, out = len(grams), []
    with np.errstate(over="ignore"):
        if 0 < n <= tiny(percent):
            m = mixed(grams, 3)
            out.append(mixed(np.concatenate([[m.sum(dtype=np.uint64)], m.sum(dtype=np.uint64) - m]), 11))
        for k, largest in size_classes(n, percent):
            most = 2 * largest * (100 - percent) // (100 + percent)
            fragments = most + most * SPARE // 100 + 2
            sums, sizes = fragment_sums(grams, fragments)
            keys = mixed(mixed(sums, 21 + k) + np.arange(fragments, dtype=np.uint64), 31)
            differ = (n + min(largest, n * 100 // percent)) * (100 - percent) // (100 + percent)
            out.append(keys[np.lexsort((keys, sizes))[fragments - differ - 1 :]])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(values)))


def set_ids(grams: list[np.ndarray], clashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The node and the two hash sums of each set; sets whose first node is one of ``clashes`` get a second one."""
    n = np.fromiter(map(len, grams), np.uint64, len(grams))
    a = np.array([mixed(g, 1).sum(dtype=np.uint64) for g in grams], np.uint64)
    b = np.array([mixed(g, 2).sum(dtype=np.uint64) for g in grams], np.uint64)
    with np.errstate(over="ignore"):
        node = mixed(a ^ mixed(b + n, 41), 42)
        other = mixed(b ^ mixed(a - n, 43), 44)
    return np.where(np.isin(node, clashes), other, node), a, b


def set_table(docs: DataFrame, width: int = WIDTH, clashes: tuple[int, ...] = ()) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, sig_a, sig_b) of every row; NULL nodes where there is no n-gram."""
    known = np.array(clashes, np.int64).view(np.uint64)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            grams = list(gram_sets(batch.column("text"), width))
            node, a, b = set_ids(grams, known)
            n = np.fromiter(map(len, grams), np.int64, len(grams))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n), pa.array(signed(node), mask=n == 0),
                 pa.array(signed(a)), pa.array(signed(b))],
                ["doc_id", "text_hash", "n_shingles", "node", "sig_a", "sig_b"],
            )

    small_batches(docs.sparkSession, 512)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(build, SETS)


def tied(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, node) with each key once: of the nodes that have a key the smallest keeps it, and each other one is tied to
    it by a key of their own."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node = key[new], node[new]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    least = node[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))][~first]
    rest = node[~first]
    with np.errstate(over="ignore"):
        between = np.unique(np.stack([mixed(rest ^ mixed(least, 51), 52), rest, least]), axis=1)
    return np.concatenate([key[first], between[0], between[0]]), np.concatenate([node[first], between[1], between[2]])


def key_rows(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, clashes: tuple[int, ...] = ()
) -> DataFrame:
    """(key, a): the candidate keys of the sets of ``docs``, those of a part of the texts tied together."""
    known = np.array(clashes, np.int64).view(np.uint64)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TIED_BYTES):
            keys: dict[int, np.ndarray] = {}
            grams = list(gram_sets(batch.column("text"), width))
            for node, g in zip(set_ids(grams, known)[0].tolist(), grams, strict=True):
                if node not in keys and len(g):
                    keys[node] = candidate_keys(g, percent)
            del grams
            if keys:
                sizes = np.fromiter(map(len, keys.values()), np.int64, len(keys))
                key, node = tied(np.concatenate(list(keys.values())), np.repeat(np.array(list(keys), np.uint64), sizes))
                for k in range(0, len(key), 1 << 16):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(key[k : k + (1 << 16)])), pa.array(signed(node[k : k + (1 << 16)]))], ["key", "a"]
                    )

    small_batches(docs.sparkSession, 512)
    return docs.select("text").mapInArrow(build, "key long, a long")


def gram_parts(docs: DataFrame, fragments: int = FRAGMENTS, width: int = WIDTH) -> DataFrame:
    """The n-grams of each row of ``docs`` (node, cluster, chunk, text), one list per fragment of their order."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            n, grams = [], []
            for g in gram_sets(batch.column("text"), width):
                n.append(len(g))
                grams += fragmented(g, fragments)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "cluster", "chunk")), pa.array(n, pa.int64()), nested(grams, fragments)],
                ["node", "cluster", "chunk", "n", "grams"],
            )

    small_batches(docs.sparkSession, 512)
    return docs.select("node", "cluster", "chunk", "text").mapInArrow(build, PARTS)


def fragmented(grams: np.ndarray, fragments: int = FRAGMENTS) -> list[np.ndarray]:
    high = (grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
    return np.split(grams, np.searchsorted(high, np.arange(1, fragments, dtype=np.uint64)))


def nested(arrays: list[np.ndarray], fragments: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(arrays) + 1, fragments, dtype=np.int32)), lists(arrays))


def small(df: DataFrame) -> DataFrame:
    """``df`` (a stored table of groups), broadcast where it is bounded, else joined by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def bitmaps(keys: DataFrame, key: str = "key") -> tuple[DataFrame, int]:
    """(bitmap, bits) with the bit of every ``key`` (a 64-bit hash) of ``keys`` set, and the number of bitmaps: bounded,
    so it is broadcast whatever the number of keys. Other keys may have a bit that is set."""
    most = min(MOST_BITMAPS, keys.count() * BITS_EACH // BITMAP_BITS + 1)
    dealt = keys.select(*bit_of(F.col(key), most)).repartition("bitmap")
    return dealt.groupBy("bitmap").agg(F.bitmap_construct_agg("bit").alias("bits")), most


def bit_of(key: Column, most: int) -> tuple[Column, Column]:
    """The bitmap, of ``most``, and the place in it of a key."""
    place = F.pmod(F.shiftrightunsigned(key, 40), F.lit(BITMAP_BITS))
    return F.pmod(key, F.lit(most)).alias("bitmap"), place.cast("long").alias("bit")


def texts_of(docs: DataFrame, source: DataFrame) -> DataFrame:
    """(node, cluster, chunk, text) of the rows of ``docs`` that ``source`` (node, cluster, d, none, h, chunk) names.

    Only rows with a key whose bit is set are shuffled, and ``source`` is no larger on the driver for more candidates."""
    named = F.xxhash64("d", "none", "h")
    marks, most = bitmaps(source.select(named.alias("key")))
    rows = docs.select(
        "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("none"),
        F.xxhash64("text").alias("h"),
    )
    rows = rows.select("*", *bit_of(named, most)).join(F.broadcast(marks), "bitmap")
    byte = F.conv(F.hex(F.substring("bits", (F.shiftright("bit", 3) + 1).cast("int"), 1)), 16, 10).cast("int")
    likely = rows.filter(F.getbit(byte, F.pmod("bit", F.lit(8)).cast("int")) == 1).select("d", "none", "h", "text")
    return likely.join(source, ["d", "none", "h"]).select("node", "cluster", "chunk", "text")


def chunked(sized: DataFrame, key: str, label: str, by_sets: bool = False) -> DataFrame:
    """``sized`` (node, n, key, ...) with ``chunks``, the parts of bounded size into which the nodes of a key are cut."""
    chunks = F.ceil(F.sum("n") / BLOCK_NGRAMS)
    if by_sets:
        chunks = F.greatest(chunks, F.ceil(F.count("*") / BLOCK_SETS))
    large = materialize(sized.groupBy(key).agg(chunks.cast("int").alias("chunks")).filter("chunks > 1"), label)
    return sized.join(small(large), key, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))


def compared_with_centres(parts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Each set of ``parts`` (node, cluster, chunk, n, grams) against its cluster's centre, which stands in every chunk:
    (node, cluster, n, linked, n_apart, apart), ``apart`` being the n-grams that only one of the two has, by fragment."""
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        node, n, held = pdf["node"].to_numpy(), pdf["n"].to_numpy(), pdf["grams"].to_numpy()
        centre = int(np.flatnonzero(node == pdf["cluster"].iloc[0])[0])
        apart, common = [], np.zeros(len(node), np.int64)
        for k, own in enumerate(held):
            parts_of = [np.setxor1d(a, b, assume_unique=True) for a, b in zip(own, held[centre], strict=True)]
            apart.append(parts_of)
            common[k] = (n[k] + n[centre] - sum(map(len, parts_of))) // 2
        linked = 100 * common >= percent * (n + n[centre] - common)
        out = pd.DataFrame({
            "node": node, "cluster": pdf["cluster"], "n": n, "linked": linked, "n_apart": n + n[centre] - 2 * common, "apart": apart,
        })
        # the centre itself is told by its first chunk
        return out[(node != node[centre]) | (pdf["chunk"].to_numpy() == 0)]

    return parts.groupBy("cluster", "chunk").applyInPandas(compare, COMPARED)


def block_links(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) that connect what is linked within each group of ``members`` (node, cluster, component, n, n_apart,
    apart), the differences of the sets from one centre.

    A group is cut into chunks of bounded size; a task compares two chunks. Fragment by fragment it counts the common
    differences of all its pairs as a matrix product and sums the counts; pairs of one known component are of no use, so a
    block of one component is left out.
    """
    sized = members.select("node", "cluster", "component", (F.col("n_apart") + 1).alias("n"))
    dealt = chunked(sized, "cluster", "large-groups", by_sets=True).withColumn(
        "own", F.pmod(F.xxhash64("node"), "chunks").cast("int")
    )
    refs = materialize(dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "component"
    ), "blocks")
    blocks = members.select("node", "n", "apart").join(refs, "node")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        docs, row = np.unique(pdf["node"].to_numpy(), return_inverse=True)
        first = np.zeros(len(docs), np.int64)
        first[row[::-1]] = np.arange(len(pdf))[::-1]
        n = pdf["n"].to_numpy()[first]
        if pdf["component"].nunique() == 1:
            return pd.DataFrame({"a": docs[:0], "b": docs[:0]})
        common = np.zeros((len(docs), len(docs)), np.float32)
        held_apart = pdf["apart"].to_numpy()[first]
        for fragment in range(len(held_apart[0])):
            part = [g[fragment] for g in held_apart]
            grams, owner = np.concatenate(part), np.repeat(np.arange(len(docs)), list(map(len, part)))
            _, token, times = np.unique(grams, return_inverse=True, return_counts=True)
            shared = times[token] > 1
            _, token = np.unique(token[shared], return_inverse=True)
            owner = owner[shared]
            for low in range(0, int(token.max()) + 1 if len(token) else 0, 4096):
                inside = (token >= low) & (token < low + 4096)
                held = np.zeros((len(docs), 4096), np.float32)
                held[owner[inside], token[inside] - low] = 1
                common += held @ held.T
        away = np.array([sum(map(len, a)) for a in held_apart])
        label, last = docs.copy(), None
        while last is None or (label != last).any():
            last = label.copy()
            for low in range(0, len(docs), 256):
                rows = slice(low, low + 256)
                differ = away[rows, None] + away[None, :] - 2 * common[rows].astype(np.int64)
                both = (n[rows, None] + n[None, :] - differ) // 2
                linked = 100 * both >= percent * (both + differ)
                seen = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
                label[rows] = np.minimum(label[rows], seen)
        moved = label != docs
        return pd.DataFrame({"a": docs[moved], "b": label[moved]})

    return blocks.groupBy("cluster", "i", "j").applyInPandas(compare, "a long, b long")


def ngram_classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) of every row of ``docs`` (doc_id, text), linked by the Jaccard
    similarity of their n-grams of ``width`` words from ``percent`` on."""
    return node_classes(docs, width, percent).drop("component")


def node_classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """:func:`ngram_classes` with ``component``, the class by its smallest node: unlike the smallest doc_id, no other
    class has it. NULL for rows without n-grams.

    A node is a distinct set of n-grams, whatever rows have it."""
    sets, clashes = materialize(set_table(docs, width), "gram-sets"), ()
    identity = F.struct("sig_a", "sig_b", "n_shingles")
    shared = sets.filter("n_shingles > 0").groupBy("node").agg(F.min(identity).alias("low"), F.max(identity).alias("high"))
    shared = shared.filter("low <> high").select("node").collect()  # about n * n / 2**65 of n sets
    if shared:
        clashes = tuple(r.node for r in shared)
        drop_tables(sets)
        sets = materialize(set_table(docs, width, clashes), "gram-sets")
    real = sets.filter("n_shingles > 0")
    keys = key_rows(docs, width, percent, clashes).repartition("key")
    met = keys.withColumn("b", F.first("a").over(Window.partitionBy("key").orderBy("a")))
    pairs = materialize(met.filter("a <> b").select("a", "b").distinct(), "pairs")
    tops = real.groupBy("node").agg(F.min("doc_id").alias("top")).withColumn("component", F.col("node"))
    if not pairs.isEmpty():
        repeated = not real.groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty()
        found = candidate_links(docs, real, pairs, repeated, width, percent)
        drop_tables(pairs)
        joined = tops.drop("component").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = joined.groupBy("component").agg(F.min("top").alias("least"))
        tops = joined.join(least, "component").select("node", "component", F.col("least").alias("top"))
    return sets.select("doc_id", "text_hash", "n_shingles", "node").join(tops, "node", "left").select(
        "doc_id", "text_hash", "n_shingles", "component", F.coalesce("top", "doc_id").alias("component_id")
    )


def candidate_links(
    docs: DataFrame, real: DataFrame, pairs: DataFrame, repeated: bool, width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """(node, component) of the nodes of candidate ``pairs`` that are linked with another one.

    ``real`` (node, doc_id, text_hash, n_shingles) names rows of ``docs`` for each node; ``repeated`` tells that some row stands
    in ``docs`` more than once."""
    clusters = connected_components(pairs).withColumnRenamed("component", "cluster")
    name = F.struct(F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("none"), F.col("text_hash").alias("h"))
    named = real.join(clusters, "node").groupBy("node", "cluster").agg(
        F.min(name).alias("name"), F.min("n_shingles").alias("n")
    )
    dealt = chunked(materialize(named, "candidates"), "cluster", "large-clusters")
    # the centre goes to every chunk of its cluster
    chunk = F.when(F.col("node") == F.col("cluster"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    )
    source = materialize(dealt.select("node", "cluster", "name.*", F.explode(chunk).alias("chunk")), "sources")
    parts = gram_parts(texts_of(docs, source), width=width)
    if repeated:
        parts = parts.dropDuplicates(["node", "chunk"])  # a row that stands in the table twice gives its n-grams once
    told = materialize(compared_with_centres(parts, percent), "compared")
    state = told.withColumn("component", F.when(F.col("linked"), F.col("cluster")).otherwise(F.col("node")))
    groups = state.groupBy("cluster").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_clusters = materialize(groups.filter("low < high AND n > 2").select("cluster"), "open-clusters")
    more = materialize(block_links(state.join(small(open_clusters), "cluster", "left_semi"), percent), "block-links")
    held = state.filter("component <> node").select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = held.select(F.col("a").alias("node"), F.col("b").alias("component"))
    if not more.isEmpty():
        found = connected_components(held.unionByName(more))
    else:  # stars around their centres already
        found = found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
        found = materialize(found, "stars")
    for done in (source, told, open_clusters, more):
        drop_tables(done)
    return found


def one_of_each_class(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row of its smallest doc_id (then hash of text; a
    row without a doc_id only where no row of the class has one). Rows without n-grams stay, once each."""
    found = node_classes(docs, width, percent)
    classes = materialize(found.select("doc_id", "text_hash", "component"), "classes")
    drop_tables(found)
    named = lambda d, h: F.struct(d.isNull().alias("none"), F.coalesce(d, F.lit(0)).alias("d"), h.alias("h"))
    row = named(F.col("doc_id"), F.col("text_hash"))
    first = classes.filter("component IS NOT NULL").groupBy("component").agg(F.min(row).alias("kept")).select("kept")
    first = first.unionByName(classes.filter("component IS NULL").select(row.alias("kept")).distinct())
    # the row itself travels as one column, so no name of its columns matters
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), named(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("kept"))
    out = whole.join(first, "kept", "left_semi")
    repeated = classes.groupBy("doc_id", "text_hash").count().filter("count > 1")
    return (out if repeated.isEmpty() else out.dropDuplicates(["kept"])).select("row.*")
