"""What the operators of this subpackage share: reading, words, folds, intermediate tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of characters that separate words: everything in ASCII but digits and letters (text already lower-cased).
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is.

    ``lower`` would also change letters outside ASCII, so it is used only where there are none.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def alnum_words(text: Column) -> Column:
    """Words of letters and digits as an array: split at separators, without the empty ends. NULL has no words."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_ALNUM)
    return F.array_remove(parts, "")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def materialize(df: DataFrame, label: str, compression: str = "zstd", **options: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: computed once, and no longer tied to the executors
    that made it."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(compression=compression, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(df: DataFrame) -> None:
    """Delete the intermediate tables (:func:`materialize`) that ``df`` reads, once nothing needs them any more."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    spark = df.sparkSession
    for folder in sorted(f for f in folders if f.rsplit("/", 1)[1].startswith("tidegauge-")):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: The batch size that an application had of its own, before the first operator here bounded it.
_own_batches: dict[str, int] = {}


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the rows of the Arrow batches that carry whole texts to Python; a smaller setting of the user stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = _own_batches.setdefault(spark.sparkContext.applicationId, int(spark.conf.get(key)))
    spark.conf.set(key, str(min(own, rows) if own > 0 else rows))


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, cut and joined to batches of about ``most_bytes`` of ``column`` (one row at least)."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.concat_batches(held)

    for batch in batches:
        begin = 0
        for i, n in enumerate(pc.binary_length(batch.column(column)).fill_null(0).to_pylist()):
            if size and size + n > most_bytes:
                if i > begin:
                    held.append(batch.slice(begin, i - begin))
                yield joined()
                held, begin, size = [], i, 0
            size += n
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if held:
        yield joined()


def space_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space, A-Z in lower case: the distinct ones, the index of every word, the number of
    words of each text. NULL has no words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    offsets = np.asarray(lists.offsets)
    flat = lists.flatten()
    real = np.asarray(pc.greater(pc.binary_length(flat), 0))
    counts = np.diff(np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]])
    coded = flat.filter(pa.array(real)).dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False), np.asarray(coded.indices), counts
