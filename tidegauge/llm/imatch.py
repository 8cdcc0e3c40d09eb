"""I-Match fingerprints: hashes of a document's significant terms under many randomised lexicons.

The lexicon holds the terms whose inverse document frequency, log2(documents / documents with the term), lies within a
band: words that most documents share say nothing, and the rarest are misprints and names. A term is in a randomised
lexicon by its hash, and the lexicons differ in how many terms they keep: all, and half, a quarter and so on down to
``2**-LEVELS``, ``SUBSETS`` of each. For each lexicon the distinct terms of a document that it keeps are sorted and hashed
in that order, to 16 bits (0: none). These hashes are the fingerprint.

An edit changes the hash of a lexicon only where the lexicon keeps a changed term, so lexicons that keep few terms of a
text survive edits of a part of it. :func:`likeness` is the share of equal hashes among the lexicons that are sparse for
the two texts; it estimates the share of terms they have in common.

The band bounds the lexicon: a term in it stands in at least one of ``2**HIGHEST`` documents, so there are at most
``2**HIGHEST`` times as many terms as a document has distinct terms on average. ``HIGHEST`` is lowered by that average
where the product would exceed ``MOST_TERMS``, which is what travels to tasks (8 bytes each).

Rows: NULL text counts as empty. A text without a term of the band is fingerprinted by all its terms, and one without
any term by its characters, so equal texts and only they agree. Documents follow each other by doc_id, rows without one
first, ties by the hash of the text; a repeated row is followed by its copy; a single document follows itself. An empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import drop_tables, materialize, slices, small_batches

#: The band of inverse document frequencies, in bits.
LOWEST, HIGHEST = 4.0, 13.0
LEVELS, SUBSETS = 11, 12
LEXICONS = 1 + LEVELS * SUBSETS
MOST_TERMS = 4_000_000
#: Ranges of doc_id to a partition; several even out what hashing their numbers deals to one task.
RANGES = 3
#: Hexadecimal digits of one hash.
DIGITS = 4
#: Text that is fingerprinted at once.
FOLLOWED_BYTES = 2 << 20
#: A lexicon level is sparse for two texts if so many of its lexicons at most keep a term of either.
SPARSE = 10

FINGERPRINTS = (
    "doc_id {}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _plain_bytes() -> np.ndarray:
    """Bytes with A-Z in lower case and ASCII other than letters and digits as blanks."""
    keep = [chr(b).lower() if chr(b).isascii() and chr(b).isalnum() else " " for b in range(128)]
    return np.array([ord(c) for c in keep] + list(range(128, 256)), np.uint8)


PLAIN = _plain_bytes()


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms of ``texts`` in order, and the (text, term) pairs that occur: each once, in order."""
    texts = pa.concat_arrays([texts.fill_null("")])
    ends, raw = texts.buffers()[1:]
    raw = b"" if raw is None else PLAIN[np.frombuffer(raw, np.uint8)].tobytes()
    plain = pa.StringArray.from_buffers(len(texts), ends, pa.py_buffer(raw), offset=texts.offset)
    split = pc.ascii_split_whitespace(plain)
    counts = np.diff(np.asarray(split.offsets))
    coded = split.flatten().dictionary_encode()
    order = np.asarray(pc.sort_indices(coded.dictionary))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    terms = coded.dictionary.take(pa.array(order))
    pair = np.unique(np.repeat(np.arange(len(texts)), counts) * max(len(terms), 1) + rank[np.asarray(coded.indices)])
    text, term = np.divmod(pair, max(len(terms), 1))
    if len(terms) and not terms[0].as_py():  # blanks at the ends of a text split off empty terms
        text, term = text[term > 0], term[term > 0]
    return terms, text, term


def hashes(terms: pa.Array) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms.to_pylist()), np.uint64, len(terms))


def term_counts(texts: DataFrame) -> DataFrame:
    """(term, n): how many rows of ``texts`` (text) have each term, by the term's 64-bit hash. A task sends each of its
    terms once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            terms, _, term = terms_of(batch.column("text"))
            n = np.bincount(term, minlength=len(terms))
            used = np.flatnonzero(n)
            own = hashes(terms).view(np.int64)[used]
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n[used])], ["term", "n"])

    small_batches(texts.sparkSession, 2048)
    return texts.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame) -> np.ndarray:
    """The sorted hashes of the terms of ``docs`` (text) in the band; at most ``MOST_TERMS``."""
    counts = materialize(term_counts(docs), "term-counts")
    n, total = docs.count(), counts.agg(F.sum("n")).first()[0] or 0
    highest = min(HIGHEST, np.log2(MOST_TERMS / max(total / max(n, 1), 1.0)))
    idf = F.log2(F.lit(float(n)) / F.col("n"))
    held = counts.filter((idf >= LOWEST) & (idf <= highest)).select("term")
    found = held.toArrow().column("term").to_numpy().view(np.uint64)
    drop_tables(counts)
    return np.sort(found)


def lexicons_of(term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For term hashes, the randomised lexicons that keep them: (index of the term, lexicon), by term."""
    member = np.zeros((len(term), LEXICONS), bool)
    member[:, 0] = True
    for level in range(1, LEVELS + 1):
        for k in range(SUBSETS):
            at = 1 + (level - 1) * SUBSETS + k
            member[:, at] = mixed(term, at) >> np.uint64(64 - level) == 0
    return np.nonzero(member)


def fingerprints(texts: pa.Array, known: np.ndarray) -> np.ndarray:
    """The hashes (text, lexicon) of texts, by the sorted hashes of the lexicon's terms."""
    import xxhash

    terms, text, term = terms_of(texts)
    own = hashes(terms)
    inside = np.isin(own, known)
    banded = np.zeros(len(texts), bool)
    banded[text[inside[term]]] = True
    use = inside[term] | ~banded[text]
    text, term = text[use], term[use]
    index, subset = lexicons_of(own)
    starts = np.searchsorted(index, np.arange(len(own) + 1))
    width = np.diff(starts)[term]
    # every (text, lexicon, term) kept, in order of text, lexicon and term
    ends = np.cumsum(width)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[term] - (ends - width), width)
    key = np.repeat(text, width) * LEXICONS + subset[at]
    order = np.argsort(key, kind="stable")
    key, value = key[order], np.repeat(own[term], width)[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    place = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
    with np.errstate(over="ignore"):
        placed = mixed(value + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 101)
        sums = np.add.reduceat(placed, first) if len(first) else np.zeros(0, np.uint64)
    out = np.zeros(len(texts) * LEXICONS, np.uint16)
    out[key[first]] = (mixed(sums, 102) % np.uint64((1 << 16) - 1) + np.uint64(1)).astype(np.uint16)
    out = out.reshape(len(texts), LEXICONS)
    for i in np.flatnonzero(~out.any(axis=1)):  # no term at all
        out[i, 0] = xxhash.xxh3_64_intdigest(texts[int(i)].as_py() or "") % ((1 << 16) - 1) + 1
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From 0 to 1 for rows of fingerprints: the share of equal hashes among the lexicons that keep a term of either, over
    the levels that are sparse for the two (the last level, if none is; all, if the sparse ones keep nothing)."""
    held, equal = (a != 0) | (b != 0), (a == b) & (a != 0)
    by_level = lambda x: x[:, 1:].reshape(len(x), LEVELS, SUBSETS).sum(axis=2)
    n, m = by_level(held), by_level(equal)
    sparse = n <= SPARSE
    sparse[~sparse.any(axis=1), -1] = True
    n_sparse, m_sparse = (n * sparse).sum(axis=1), (m * sparse).sum(axis=1)
    n_all, m_all = held.sum(axis=1), equal.sum(axis=1)
    out = np.where(n_sparse > 0, m_sparse / np.maximum(n_sparse, 1), m_all / np.maximum(n_all, 1))
    return np.where((a == b).all(axis=1), 1.0, out)


def texts_of(prints: np.ndarray) -> list[str]:
    raw = prints.astype(">u2").tobytes().hex()
    width = DIGITS * LEXICONS
    return [raw[k : k + width] for k in range(0, len(raw), width)]


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many first characters of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def in_buckets(rows: DataFrame) -> DataFrame:
    """``rows`` (d, tie, ...) in order, as ranges that each know the row that follows them: (bucket, last, ...) sorted by
    bucket, with the first row of the next range (of the first one, after the last) at the end, marked ``last``."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.select("d", "tie").repartitionByRange(RANGES * n, "d", "tie").groupBy(F.spark_partition_id().alias("p"))
    # one row for each range
    firsts = sorted(tuple(r.least) for r in ranges.agg(F.min(F.struct("d", "tie")).alias("least")).collect())
    d0, tie0 = (np.array([x[k] for x in firsts], np.int64) for k in (0, 1))

    @F.pandas_udf("int")
    def bucket(d: pd.Series, tie: pd.Series) -> pd.Series:
        """How many ranges begin at or before (d, tie), less one."""
        d, tie = d.to_numpy(), tie.to_numpy()
        equal, after = np.searchsorted(d0, d, "left"), np.searchsorted(d0, d, "right")
        at = equal.copy()
        for k in range(int((after - equal).max(initial=0))):
            begun = tie0[np.minimum(equal + k, len(d0) - 1)] <= tie
            at += (equal + k < after) & begun
        return pd.Series((at - 1).astype(np.int32))

    heads = spark.createDataFrame(
        [(*first, (k - 1) % len(firsts)) for k, first in enumerate(firsts)], "d long, tie long, bucket int"
    )
    tails = rows.join(F.broadcast(heads), ["d", "tie"]).dropDuplicates(["d", "tie"]).withColumn("last", F.lit(True))
    dealt = rows.withColumn("bucket", bucket("d", "tie")).withColumn("last", F.lit(False)).unionByName(tails)
    return dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "last", "d", "tie")


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row of ``docs``
    (doc_id, text)."""
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"),
    ).withColumn("tie", F.xxhash64("text"))
    shape = FINGERPRINTS.format(docs.schema["doc_id"].dataType.simpleString())
    if rows.isEmpty():
        return spark.createDataFrame([], shape)
    held = spark.sparkContext.broadcast(lexicon(docs.select("text")))

    def judge(rows: pa.RecordBatch, following: pa.Array) -> pa.RecordBatch:
        """The rows of a batch, with the text that follows each."""
        n = len(rows)
        texts, after = rows.column("text").to_pylist(), following.to_pylist()
        new = [edited(*two) for two in zip(texts, after, strict=True)]
        tail = pa.concat_arrays([rows.column("text"), pa.array(after[-1:], pa.string()), pa.array(new, pa.string())])
        prints = fingerprints(tail, held.value)
        own, other, changed = prints[:n], prints[1 : n + 1], prints[n + 1 :]
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]), pa.array(texts_of(own)),
             pa.array(texts_of(changed)), pa.array(likeness(own, changed)), pa.array(likeness(own, other))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.RecordBatch | None = None
        for batch in slices(batches, "text", FOLLOWED_BYTES):
            batch = batch if waiting is None else pa.concat_batches([waiting, batch])
            last = np.asarray(batch.column("last"))
            begin = 0
            for end in [*np.flatnonzero(last).tolist(), None]:
                # a bucket ends at its tail; the last row of the batch waits for the row behind it
                stop = batch.num_rows - 1 if end is None else end
                if stop > begin:
                    yield judge(batch.slice(begin, stop - begin), batch.column("text").slice(begin + 1, stop - begin))
                if end is not None:
                    begin = end + 1
            left = batch.num_rows - max(begin, batch.num_rows - 1)
            waiting = batch.slice(batch.num_rows - left) if left else None

    small_batches(spark, 1024)
    return in_buckets(rows).select("doc_id", "text", "last").mapInArrow(follow, shape)
