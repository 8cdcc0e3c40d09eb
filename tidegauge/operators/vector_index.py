"""Summary embeddings: building and syncing the index, search, related events, novelty."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.vectors import cosine
from tidegauge.model.contracts import NOVELTY_THRESHOLD
from tidegauge.sources.tables import written

DIMENSIONS = 1024
INDEX_COLUMNS = ("id", "title", "z_score", "summary", "generated_at", "embedding")
RETURN_COLUMNS = ("id", "title", "z_score", "summary", "generated_at")
SCORE_DIGITS = 9  # scores are compared at this precision, so equal vectors tie and the id decides


def embed(df: DataFrame, text: str = "summary", dimensions: int = DIMENSIONS) -> DataFrame:
    """Add ``embedding``: the unit vector of hashed words of the whole text, each at 1 + ln(count).

    It has no fitted state, so rows embedded in different runs, and queries, are comparable. How much a word tells is
    known from all texts, and applied where vectors are compared: see :func:`word_weights`.
    """
    words = RegexTokenizer(inputCol="text__", outputCol="words__", pattern=r"[^\p{L}\p{N}]+")
    counts = HashingTF(inputCol="words__", outputCol="counts__", numFeatures=dimensions)
    out = df.withColumn("text__", F.coalesce(F.col(text), F.lit("")))
    for stage in (words, counts):
        out = stage.transform(out)
    damped = F.transform(vector_to_array("counts__"), lambda x: F.when(x > 0, 1 + F.ln(x)).otherwise(F.lit(0.0)))
    unit = Normalizer(inputCol="damped__", outputCol="unit__", p=2.0).transform(out.withColumn("damped__", array_to_vector(damped)))
    return unit.withColumn("embedding", vector_to_array("unit__", "float32")).drop(
        "text__", "words__", "counts__", "damped__", "unit__")


# The number of texts stands in the frequency table under this slot.
ALL_TEXTS = -1


def slot_frequencies(embedded: DataFrame, vector: str = "embedding") -> DataFrame:
    """(slot, texts): in how many rows each slot of the vectors is not zero, and the number of rows. Tables of several
    batches are added up slot by slot, so the table grows with the index and is never fitted anew."""
    numbers = F.transform(vector, lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))
    seen = embedded.filter(F.col(vector).isNotNull()).select(array_to_vector(numbers).alias("numbers"))
    # one group, and none without any row
    told = seen.groupBy(F.lit("all")).agg(Summarizer.metrics("numNonZeros", "count").summary(F.col("numbers")).alias("told"))
    used = told.select(F.posexplode(vector_to_array("told.numNonZeros")).alias("slot", "texts")).filter("texts > 0")
    return used.select("slot", F.col("texts").cast("bigint")).unionAll(
        told.select(F.lit(ALL_TEXTS).alias("slot"), F.col("told.count").alias("texts")))


def word_weights(frequencies: DataFrame, dimensions: int = DIMENSIONS) -> list[float]:
    """ln((1 + texts) / (1 + texts with the slot)) of each slot, from one or more :func:`slot_frequencies`: a word of every
    text weighs nothing, one that no text had yet the most. Without any text all weigh the same."""
    told = {r.slot: r.n for r in frequencies.groupBy("slot").agg(F.sum("texts").alias("n")).collect()}  # a row per slot
    n = told.get(ALL_TEXTS, 0)
    return [math.log((1 + n) / (1 + told.get(k, 0))) if n else 1.0 for k in range(dimensions)]


def weighted(df: DataFrame, weights: Sequence[float] | None, vector: str = "embedding") -> DataFrame:
    """``df`` with the slots of ``vector`` multiplied by ``weights``. Stored vectors stay as they are, so a change of the
    weights needs no new embedding."""
    if weights is None:
        return df
    return df.withColumn(vector, F.zip_with(F.col(vector), F.lit([float(w) for w in weights]), lambda x, w: (x * w).cast("float")))


def _moment() -> Column:
    """When a row was generated; an undated one is older than any other."""
    return F.coalesce("generated_at", F.lit("0001-01-01").cast("timestamp"))


def latest_per_id(summaries: DataFrame) -> DataFrame:
    """One row per id, the last generated; combined before the shuffle."""
    rest = [c for c in summaries.columns if c != "id"]
    newest = F.max_by(F.struct(*rest), _moment()).alias("row")
    return summaries.groupBy("id").agg(newest).select("id", "row.*")


def index_additions(summaries: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Index rows for the summaries that are new or newer than what the index holds of their id; only those are grouped by
    id and embedded. The index is appended to: :func:`current_index` tells the rows that count."""
    fresh = summaries.select(*RETURN_COLUMNS)
    if index is not None:
        told = F.xxhash64("summary", "generated_at").alias("told")  # NULLs count as a value
        fresh = fresh.select("*", told).join(index.select("id", told), ["id", "told"], "left_anti").drop("told")
    newest = latest_per_id(fresh)
    if index is not None:
        held = index.select("id", _moment().alias("at")).join(newest.select("id"), "id", "left_semi")
        newest = newest.join(held.groupBy("id").agg(F.max("at").alias("held_at")), "id", "left").filter(
            F.col("held_at").isNull() | (_moment() > F.col("held_at"))).drop("held_at")
    return embed(newest).select(*INDEX_COLUMNS)


def current_index(index: DataFrame) -> DataFrame:
    """The newest row of each id: what a rewritten summary replaced is not found any more."""
    return latest_per_id(index).select(*index.columns)


def similarity_search(
    index: DataFrame,
    query: Column | Sequence[float],
    k: int = 10,
    columns: Sequence[str] = RETURN_COLUMNS,
    vector: str = "embedding",
    key: str = "id",
) -> DataFrame:
    """The ``k`` rows most like ``query`` by cosine, with their ``score``. One scan; each task keeps
    ``k`` rows and only those are merged. ``query`` may be a scalar subquery."""
    probe = query if isinstance(query, Column) else F.lit([float(x) for x in query])
    return (
        index.withColumn("probe__", probe)
        .withColumn("score", cosine(F.col(vector), F.col("probe__")))
        .filter(F.col("score").isNotNull())
        .orderBy(F.round("score", SCORE_DIGITS).desc(), key)
        .limit(k)
        .select(*columns, "score")
    )


def search_text(
    index: DataFrame, text: str, k: int = 10, columns: Sequence[str] = RETURN_COLUMNS, weights: Sequence[float] | None = None
) -> DataFrame:
    """Search by the words of a phrase: embedded the same way as the rows, and weighted like them."""
    spark = SparkSession.active()
    phrase = weighted(embed(spark.createDataFrame([(text,)], "summary string")).select("embedding"), weights)
    return similarity_search(weighted(index, weights), phrase.scalar(), k, columns)


def related_events(
    index: DataFrame,
    k: int = 6,
    columns: Sequence[str] = RETURN_COLUMNS,
    latest_by: Sequence[str] = ("generated_at", "z_score"),
    vector: str = "embedding",
    key: str = "id",
) -> DataFrame:
    """Neighbours of the newest row (highest z-score among equals), itself removed from the ``k`` found."""
    seed = index.orderBy(*[F.desc(c) for c in latest_by], key).limit(1)
    found = similarity_search(index, seed.select(vector).scalar(), k, columns, vector, key)
    return found.filter(F.col(key) != seed.select(key).scalar())


# ---------------------------------------------------------------------------------------------
# k nearest neighbours of many vectors at once
# ---------------------------------------------------------------------------------------------

# Pivots are the square root of the number of distinct index vectors, at most so many (they go to every task).
MOST_PIVOTS = 4096
BLOCK_BYTES = 16 << 20
# Vectors of a block: two blocks have at most the square of it as scores, which are in memory at once.
BLOCK_ROWS = 1536
# How the vectors of a block travel: those of texts are mostly zeros.
PACKED = "lz4"
# Numbers in each array of distances to pivots; rows are taken a few at a time.
GAP_CELLS = 1 << 20
# The best of a block are first told from the largest scores of so many parts of it for each result.
PARTS = 16
# Blocks that one task compares with each other, streamed and held in memory; fewer where there would be few tasks.
STREAMED_BLOCKS, HELD_BLOCKS = 24, 8
# Vectors whose best results a task holds before it hands them on.
HELD_ROWS = 1 << 18
ROW_GROUP_BYTES = 32 << 20


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Unit rows."""
    m = np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _gaps(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit rows to unit pivots."""
    return np.sqrt(np.clip(2.0 - 2.0 * (m @ pivots.T), 0.0, None))


def _some_rows(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """The batches cut so that an array of ``width`` numbers a row stays within ``GAP_CELLS``."""
    step = max(1, GAP_CELLS // width)
    for b in batches:
        for start in range(0, len(b), step):
            yield b.iloc[start:start + step]


class _Block:
    """Vectors of one block, ordered by their smallest keys: what tells them, these keys, and unit rows in single precision."""

    def __init__(self, number: int, keys: list, same: pa.Buffer, size: pa.Buffer, width: int, vectors: pa.Buffer, wide: bool):
        whole = keys and isinstance(keys[0], int)  # blocks of queries have no keys
        self.number, self.keys = number, np.array(keys, np.int64 if whole else object)
        self.same, self.size = np.frombuffer(same, np.int64).reshape(-1, 2), np.frombuffer(size, np.float64)
        kind = np.dtype(np.float64 if wide else np.float32)
        raw = pa.decompress(vectors, len(self.same) * width * kind.itemsize, PACKED)
        self.raw = np.frombuffer(raw, kind).reshape(len(self.same), width)
        if wide or self.size.min() < 1e-30 or self.size.max() > 1e30:
            self.unit = self.exact(slice(None)).astype(np.float32)
        else:  # two roundings of each number, within the error that is allowed for
            self.unit = self.raw * (1 / self.size).astype(np.float32)[:, None]

    @classmethod
    def of(cls, side: pa.StructArray, i: int) -> _Block:
        at = lambda name: side.field(name)[i]
        return cls(at("number").as_py(), at("keys").as_py(), at("same").as_buffer(), at("size").as_buffer(),
                   at("width").as_py(), at("vectors").as_buffer(), at("wide").as_py())

    def exact(self, rows) -> np.ndarray:
        return self.raw[rows].astype(np.float64) / self.size[rows][:, None]


class _Bests:
    """The best ``reach`` results so far of every vector of a block."""

    def __init__(self, block: _Block, reach: int):
        n = len(block.same)
        self.same, self.scores = block.same, np.full((n, reach), -np.inf)
        self.keys, self.found = np.empty((n, reach), block.keys.dtype), np.zeros((n, reach, 2), np.int64)

    def add(self, row: np.ndarray, scores: np.ndarray, keys: np.ndarray, found: np.ndarray) -> None:
        reach = self.scores.shape[1]
        old, place = np.nonzero(np.isfinite(self.scores) & np.isin(np.arange(len(self.scores)), row)[:, None])
        row = np.concatenate([old, row])
        scores = np.concatenate([self.scores[old, place], scores])
        keys = np.concatenate([self.keys[old, place], keys])
        found = np.concatenate([self.found[old, place], found])
        order = np.lexsort((-scores, row))
        equal = (row[order][1:] == row[order][:-1]) & (scores[order][1:] == scores[order][:-1])
        if equal.any():  # only then the keys decide
            tied = order[np.append(equal, False) | np.append(False, equal)]
            rank = np.zeros(len(row), np.int64)
            rank[tied] = np.unique(keys[tied], return_inverse=True)[1]
            order = np.lexsort((rank, -scores, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        order, row, place = order[place < reach], row[place < reach], place[place < reach]
        self.scores[row, place], self.keys[row, place], self.found[row, place] = scores[order], keys[order], found[order]

    def rows(self, key_type: pa.DataType) -> pa.RecordBatch:
        row, place = np.nonzero(np.isfinite(self.scores))
        q, s = self.same[row], self.found[row, place]
        columns = {"q1": q[:, 0], "q2": q[:, 1], "s1": s[:, 0], "s2": s[:, 1], "score": self.scores[row, place]}
        key = pa.array(self.keys[row, place].tolist(), key_type)
        return pa.RecordBatch.from_arrays([*map(pa.array, columns.values()), key], [*columns, "key"])


def _reached(scores: np.ndarray, reach: int) -> np.ndarray:
    """A score that at least ``reach`` of each row are not below: that many parts of the row have a larger one. Close to the
    best ones if there are many parts; read in the order in which the scores lie in memory."""
    rows, columns = scores.shape
    parts = min(PARTS * reach, columns)
    if parts < reach:
        return np.full(rows, -np.inf)
    width = columns // parts
    if scores.flags.c_contiguous:
        tops = scores[:, : parts * width].reshape(rows, parts, width).max(axis=2).T
    else:
        tops = scores.T[: parts * width].reshape(parts, width, rows).max(axis=1)
    return np.partition(tops, parts - reach, axis=0)[parts - reach]


def _compare(q: _Block, s: _Block, scores: np.ndarray, bests: _Bests, reach: int) -> None:
    """Add to ``bests`` of ``q`` what ``s`` has: ``scores`` in single precision and their proven error say which pairs can be
    among the best, and only these are worked out in double precision."""
    error = (q.unit.shape[1] + 8) * 2.0**-23

    def at_least(least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        floor = np.nextafter(least.astype(np.float32), np.float32(-np.inf))
        if scores.flags.c_contiguous:
            return np.divmod(np.flatnonzero(scores >= floor[:, None]), scores.shape[1])
        return np.divmod(np.flatnonzero(scores.T >= floor), scores.shape[0])[::-1]

    known = bests.scores[:, -1] - error - 10.0**-SCORE_DIGITS
    row, col = at_least(np.maximum(_reached(scores, reach) - 2 * error, known))
    step = max(1, GAP_CELLS // (4 * q.unit.shape[1]))
    if len(row) * 8 > scores.size:  # as many ties as a whole product has rows to offer
        full = np.round(q.exact(slice(None)) @ s.exact(slice(None)).T, SCORE_DIGITS)
        found = full[row, col]
    else:
        found = np.concatenate([np.empty(0), *[
            np.round(np.einsum("ij,ij->i", q.exact(row[i:i + step]), s.exact(col[i:i + step])), SCORE_DIGITS)
            for i in range(0, len(row), step)]])
    order = np.lexsort((col, -found, row))  # a block is ordered by its keys
    row, col, found = row[order], col[order], found[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < reach
    row, col, found = row[kept], col[kept], found[kept]
    if len(row):
        bests.add(row, found, s.keys[col], s.same[col])


def _bundles(sizes: np.ndarray, order: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bundle and number of slices of each cell: cells that follow each other in ``order`` share a bundle while it holds no
    more than ``most`` rows, and a cell with more than that is a bundle of several slices."""
    bundle, slices = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    last, held = -1, most
    for cell in order.tolist():
        n = int(sizes[cell])
        if held + n > most or n > most:
            last, held = last + 1, 0
        bundle[cell], held = last, held + n
        slices[cell] = max(1, -(-n // most))
    return bundle, slices


def _side(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, same, vector) of the rows with a finite vector that is not zero; ``same`` is equal where vectors are."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return df.select(F.col(key).alias("key"), F.col(vector).alias("vector")).filter(
        F.forall("vector", number) & F.exists("vector", lambda x: x != 0)
    ).select("key", F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), "vector").alias("b")).alias("same"), "vector")


def _distinct(side: DataFrame, reach: int) -> DataFrame:
    """(same, keys, vector): each vector once, with the ``reach`` smallest keys of its rows."""
    first = F.dense_rank().over(Window.partitionBy("same").orderBy("key"))
    few = side.filter(F.col("key").isNotNull()).withColumn("first", first).filter(F.col("first") <= reach)
    return few.groupBy("same").agg(F.sort_array(F.collect_list("key")).alias("keys"), F.first("vector").alias("vector"))


def nearest_neighbours(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    key: str = "id",
    vector: str = "embedding",
    drop_self: bool = False,
    pivots: int | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Exact k nearest rows of ``index`` by cosine for every row of ``queries``; neither side bounded.

    Returns (``key``, ``neighbour``, ``score``, ``place``). Method (a pivot-pruned block join of distinct vectors):

    1. Equal vectors are compared once, and stand for the rows with their smallest keys, of which no more
       than k can be found; the results are dealt to all rows with the vector.
    2. Some index vectors become pivots; each vector joins the cell of its closest one. Of a cell only
       the size and radius are kept. Neighbouring cells share a block of bounded rows and bytes, a larger
       cell is cut into several blocks. A block is one row: its vectors travel side by side.
    3. Pivots are index vectors, so the k-th closest pivot bounds a query's k-th distance from above. By
       the triangle inequality that rules out the cells that lie farther away, and blocks of which no
       query needs the other are not compared.
    4. Blocks are paired without a shuffle of the pairs, each pair of blocks of a table with itself once
       for both sides. A task multiplies two blocks in single precision, works out what is within the
       proven error of the best in double precision, and holds k results per vector, not the pairs.
    5. The partial bests of each vector are merged.

    Nothing is approximate: the pruning is a proof, and blocks lose nothing. Unclustered vectors prune
    badly and cost a full block join, whose work is the square of the distinct vectors and whose memory
    is bounded by the blocks.
    """
    spark = queries.sparkSession
    key_type = index.schema[key].dataType
    wide = index.schema[vector].dataType.simpleString() == "array<double>"
    reach = k + 1 if drop_self else k
    out_schema = f"key {queries.schema[key].dataType.simpleString()}, neighbour {key_type.simpleString()}, score double, place int"
    alike = queries is index
    told = written(_distinct(_side(index, key, vector), reach), "vectors")
    n = told.count()
    if not n:
        return spark.createDataFrame([], out_schema)
    asked = told if alike else written(
        _side(queries, key, vector).groupBy("same").agg(F.first("key").alias("key"), F.first("vector").alias("vector")), "queries"
    ).select("same", F.array().cast(f"array<{key_type.simpleString()}>").alias("keys"), "vector")
    # Which vectors they are does not matter for the result; with fewer pivots than `reach` nothing is ruled out.
    # Only what tells vectors is put in order, so that a task does not hand on as many vectors as there are pivots.
    last = told.select("same").orderBy("same").limit(pivots or min(MOST_PIVOTS, math.isqrt(n) + 1)).collect()[-1]["same"]
    a, b = F.col("same.a"), F.col("same.b")
    chosen = told.filter((a < last["a"]) | ((a == last["a"]) & (b <= last["b"]))).select("vector").collect()
    centres = _matrix(pd.Series([r["vector"] for r in chosen]))
    width = max(centres.shape)
    most = max(64, min(BLOCK_ROWS, block_bytes // (8 * centres.shape[1])))

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _some_rows(batches, width):
            gaps = _gaps(_matrix(b["vector"]), centres)
            yield b[["a", "b"]].assign(cell=gaps.argmin(axis=1).astype("int32"), gap=gaps.min(axis=1))

    def placed(df: DataFrame) -> DataFrame:
        return df.select("same.*", "vector").mapInPandas(to_cells, "a long, b long, cell int, gap double")

    cells = placed(told).groupBy("cell").agg(F.count("*").alias("rows"), F.max("gap").alias("radius")).collect()
    at = np.array([c["cell"] for c in cells])
    radius = np.full(len(centres), -np.inf)
    radius[at] = [c["radius"] for c in cells]
    # neighbours along the direction in which the pivots spread most come next to each other
    order = np.argsort(centres @ np.linalg.svd(centres - centres.mean(axis=0), full_matrices=False)[2][0], kind="stable")

    def numbered(sizes: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """First block and number of blocks of each cell."""
        bundle, slices = _bundles(np.array([sizes.get(i, 0) for i in range(len(centres))]), order, most)
        per_bundle = np.ones(bundle.max() + 1, np.int64)
        np.maximum.at(per_bundle, bundle, slices)
        return (np.cumsum(per_bundle) - per_bundle)[bundle], per_bundle[bundle]

    s_first, s_count = numbered({c["cell"]: c["rows"] for c in cells})
    q_first, q_count = (s_first, s_count) if alike else numbered(
        {r["cell"]: r["n"] for r in placed(asked).groupBy("cell").agg(F.count("*").alias("n")).collect()})
    blocks = int((s_first + s_count).max())

    def to_blocks(first: np.ndarray, count: np.ndarray):
        def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in _some_rows(batches, width):
                home = _gaps(_matrix(b["vector"]), centres).argmin(axis=1)
                yield b.assign(number=(first[home] + b["a"].to_numpy() % count[home]).astype("int32"))
        return deal

    def pack(b: pd.DataFrame) -> pd.DataFrame:
        keys = b["least"].dropna().to_list()
        if keys:
            order = np.argsort(np.array(keys, np.int64 if isinstance(keys[0], int) else object), kind="stable")
            b, keys = b.iloc[order], [keys[i] for i in order]
        vectors = np.vstack(b["vector"].to_list()).astype(np.float64 if wide else np.float32)
        size = np.linalg.norm(vectors.astype(np.float64), axis=1)
        return pd.DataFrame({
            "number": [b["number"].iloc[0]], "same": [b[["a", "b"]].to_numpy(np.int64).tobytes()],
            "keys": [keys], "size": [size.tobytes()], "width": [vectors.shape[1]],
            "vectors": [pa.compress(vectors.tobytes(), PACKED, asbytes=True)]})

    def packed(df: DataFrame, first: np.ndarray, count: np.ndarray) -> DataFrame:
        dealt = f"a long, b long, least {key_type.simpleString()}, vector {index.schema[vector].dataType.simpleString()}, number int"
        rows = df.select("same.*", F.get("keys", F.lit(0)).alias("least"), "vector").mapInPandas(to_blocks(first, count), dealt)
        return rows.groupBy("number").applyInPandas(
            pack, f"number int, same binary, keys array<{key_type.simpleString()}>, size binary, width int, vectors binary")

    def needed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Which blocks the queries need, by the block of the queries."""
        for b in _some_rows(batches, max(width, blocks)):
            gaps = _gaps(_matrix(b["vector"]), centres)
            limit = np.partition(gaps, reach - 1, axis=1)[:, reach - 1] if reach <= len(centres) else np.full(len(b), np.inf)
            home = gaps.argmin(axis=1)
            own = gaps[np.arange(len(b)), home][:, None]
            apart = _gaps(centres[home], centres)
            plane = np.divide(gaps**2 - own**2, 2 * apart, out=np.zeros_like(gaps), where=apart > 0)
            row, cell = np.nonzero((np.maximum(gaps - radius, plane) <= limit[:, None] + 1e-6) & np.isfinite(radius))
            part = q_first[home] + b["a"].to_numpy() % q_count[home]
            here = row * (blocks + 1)  # ranges of blocks, begun and ended
            begun, ended = (np.bincount(here + x[cell], minlength=len(b) * (blocks + 1)) for x in (s_first, s_first + s_count))
            some, meant = np.nonzero((begun - ended).reshape(len(b), -1)[:, :-1].cumsum(axis=1))
            yield pd.DataFrame({"q": part[some], "s": meant}, dtype="int32").drop_duplicates()

    meets = asked.select("same.a", "vector").mapInPandas(needed, "q int, s int")
    if alike:
        meets = meets.select(F.least("q", "s").alias("q"), F.greatest("q", "s").alias("s"))
    # told before the pairs are made, whose batches are of one row
    meets = written(meets.groupBy("q").agg(F.collect_set("s").alias("meets")), "meets")
    stored = lambda df, label: written(df, label, **{"parquet.block.size": ROW_GROUP_BYTES})
    s_blocks = stored(packed(told, s_first, s_count), "blocks")
    q_blocks = s_blocks if alike else stored(packed(asked, q_first, q_count), "query-blocks")
    q_blocks = q_blocks.join(F.broadcast(meets) if blocks < 2048 else meets, q_blocks["number"] == meets["q"])
    # a task compares the neighbouring blocks of one part with those of another
    q_total = blocks if alike else int((q_first + q_count).max())
    tasks = 6 * spark.sparkContext.defaultParallelism
    s_parts = min(blocks, max(-(-blocks // HELD_BLOCKS), math.isqrt(tasks) + 1))
    q_parts = min(q_total, max(-(-q_total // STREAMED_BLOCKS), -(-tasks // s_parts)))
    dealt = lambda df, parts, of: df.repartitionById(
        parts, F.floor(F.col("number").cast("bigint") * parts / of).cast("int"))
    as_block = lambda side: F.struct("number", "same", "keys", "size", "width", "vectors", F.lit(wide).alias("wide")).alias(side)
    pairs = dealt(q_blocks, q_parts, q_total).select(as_block("q"), "meets").hint("shuffle_replicate_nl").join(
        dealt(s_blocks, s_parts, blocks).select(as_block("s")), F.array_contains("meets", F.col("s.number")))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # of earlier steps in this worker
        held: dict[tuple, _Bests] = {}
        q, arrow_key = None, None
        for batch in batches:
            arrow_key = arrow_key or batch.schema.field("s").type.field("keys").type.value_type
            for i in range(batch.num_rows):
                mine, other = batch.column("q"), batch.column("s")
                if q is None or q.number != mine.field("number")[i].as_py():
                    q = _Block.of(mine, i)
                s = q if alike and q.number == other.field("number")[i].as_py() else _Block.of(other, i)
                scores = q.unit @ s.unit.T
                for x, y, z in [(q, s, scores), (s, q, scores.T)][: 2 if alike and s is not q else 1]:
                    if x.number not in held:
                        held[x.number] = _Bests(x, reach)
                    _compare(x, y, z, held[x.number], reach)
            if sum(len(x.same) for x in held.values()) > HELD_ROWS:
                yield from (x.rows(arrow_key) for x in held.values())
                held = {}
        yield from (x.rows(arrow_key) for x in held.values())

    partial = f"q1 long, q2 long, s1 long, s2 long, score double, key {key_type.simpleString()}"
    batch_rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(batch_rows)
    spark.conf.set(batch_rows, "1")  # a row is two blocks
    try:
        found = written(pairs.select("q", "s").mapInArrow(best, partial), "bests")
    finally:
        spark.conf.set(batch_rows, usual)
    same = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    merged = found.select(same("q1", "q2").alias("same"), same("s1", "s2").alias("found"), "key", "score").withColumn(
        "place", F.row_number().over(Window.partitionBy("same").orderBy(F.desc("score"), "key"))).filter(F.col("place") <= reach)
    keys = told.select(F.col("same").alias("found"), F.explode("keys").alias("neighbour"))
    results = merged.select("same", "found", "score").join(keys, "found").select("same", "score", "neighbour")
    rows = _side(queries, key, vector).select("key", "same").join(results, "same").select("key", "neighbour", "score")
    if drop_self:
        rows = rows.filter(F.col("key") != F.col("neighbour"))
    order_of = Window.partitionBy("key").orderBy(F.desc("score"), "neighbour")
    return rows.withColumn("place", F.row_number().over(order_of)).filter(F.col("place") <= k)


def novelty(
    queries: DataFrame,
    index: DataFrame,
    threshold: float = NOVELTY_THRESHOLD,
    key: str = "id",
    vector: str = "embedding",
    show: Sequence[str] = (),
    weights: Sequence[float] | None = None,
) -> DataFrame:
    """Whether each query is news: (key, is_novel, score, neighbour), and the neighbour's ``show`` columns
    as ``neighbour_<column>``.

    The closest indexed row other than itself decides; a query with no other row is novel, with a
    NULL score. ``weights`` (:func:`word_weights`) say how much the slots of the vectors tell.
    """
    told = weighted(index, weights, vector)
    asked = told if queries is index else weighted(queries, weights, vector)
    closest = nearest_neighbours(asked, told, 1, key, vector, drop_self=True).select(
        F.col("key").alias(key), "score", "neighbour"
    )
    told = queries.select(key).join(closest, key, "left").select(
        key, F.coalesce(F.col("score") < threshold, F.lit(True)).alias("is_novel"), "score", "neighbour"
    )
    if not show:
        return told
    shown = index.select(F.col(key).alias("neighbour"), *[F.col(c).alias(f"neighbour_{c}") for c in show])
    return told.join(shown, "neighbour", "left").select(*told.columns, *[f"neighbour_{c}" for c in show])
