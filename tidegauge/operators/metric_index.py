"""A stored vector index that a search reads a few cells of.

Rows lie in one partition per cell: that of the closest centre. A small table keeps, for every batch of rows added, the
size of each cell and how near and far its rows are from the centre. A search works out, by the triangle inequality, the
best score that each cell can hold; it reads the most promising cells, then those that could still hold one of the best k,
and stops when no other can. The result is that of a full scan.

Rows are only appended. A row that replaces an older one of the same key is added under a new batch number, and the older
one is named in a table of retired rows, in its cell. Below one path:

- ``centres`` (cell, centre): fixed when the index is built;
- ``rows/cell=<n>`` (the columns of the rows, content, batch, gap): ``content`` is the hash of what a row says;
- ``sizes`` (batch, cell, rows, nearest, farthest);
- ``retired/cell=<n>`` (key, batch).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.vectors import cosine
from tidegauge.operators.vector_index import MOST_PIVOTS, SCORE_DIGITS, _gaps, _matrix
from tidegauge.sources.tables import exists, written

# Scores are told apart from this on; a cell is opened if its best possible score is within it of the k-th.
SCORE_SLACK, GAP_SLACK = 1e-8, 1e-6
OWN_COLUMNS = ("content__", "batch__", "gap__", "cell__")


class MetricIndex:
    """Rows with vectors below ``path``: built once, added to and replaced by batches, searched by cells.

    Rows whose vector is NULL or has no direction are not kept: they have no cosine with anything. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id", vector: str = "embedding"):
        self.spark, self.root, self.key, self.vector = spark, path.rstrip("/"), key, vector

    # ------------------------------------------------------------------ writing

    def build(self, rows: DataFrame, content: Column | None = None, cells: int | None = None) -> None:
        """Take centres from ``rows``, as many as the square root of their number, and add all of them."""
        known = self._with_direction(rows)
        if cells is None:
            cells = min(MOST_PIVOTS, math.isqrt(known.count()) + 1)
        chosen = known.select(self.key, self.vector).orderBy(F.xxhash64(self.key), self.key).limit(cells).collect()
        centres = [(n, [float(x) for x in r[self.vector]]) for n, r in enumerate(chosen)]
        self.spark.createDataFrame(centres, "cell INT, centre ARRAY<DOUBLE>").coalesce(1).write.parquet(f"{self.root}/centres")
        self._add(known, content, 0)

    def upsert(self, rows: DataFrame, content: Column, order: Column) -> None:
        """Add the rows whose key is new or whose ``content`` has changed, the last of each key by ``order``; rows that
        they replace are retired. Run again after a failure, it does what is left to do."""
        if not exists(self.spark, f"{self.root}/centres"):
            newest = _last_per_key(rows, self.key, order)
            self.build(newest, content)
            return
        live = self.live().select(F.col(self.key).alias("k"), F.col("content__").alias("h"), "cell__", "batch__")
        hashed = _last_per_key(self._with_direction(rows), self.key, order).withColumn("h", F.xxhash64(content))
        fresh = written(hashed.join(live.select(F.col("k").alias(self.key), "h"), [self.key, "h"], "left_anti").drop("h"), "fresh")
        if fresh.isEmpty():
            return
        batch = self._batches() + 1
        old = live.join(fresh.select(F.col(self.key).alias("k")), "k").select(F.col("k").alias(self.key), "batch__", "cell__")
        # retired first: what is lost between the two writes is only absent until the next run
        old.hint("rebalance", F.col("cell__")).write.mode("append").partitionBy("cell__").parquet(f"{self.root}/retired")
        self._add(fresh, content, batch)

    def compact(self) -> None:
        """One file per cell and no retired rows: cells are replaced one by one, by what they hold now."""
        live = self.live()
        live.hint("rebalance", F.col("cell__")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "cell__").parquet(f"{self.root}/rows")

    def _add(self, rows: DataFrame, content: Column | None, batch: int) -> None:
        hashed = F.xxhash64(content if content is not None else F.col(self.vector))
        placed = self._placed(rows.withColumns({"content__": hashed, "batch__": F.lit(batch)}))
        # sizes first: sizes of rows that never come only make a search read more
        placed.groupBy(F.col("batch__").alias("batch"), F.col("cell__").alias("cell")).agg(
            F.count("*").alias("rows"), F.min("gap__").alias("nearest"), F.max("gap__").alias("farthest")
        ).coalesce(1).write.mode("append").parquet(f"{self.root}/sizes")
        placed.hint("rebalance", F.col("cell__")).write.mode("append").partitionBy("cell__").parquet(f"{self.root}/rows")

    def _with_direction(self, rows: DataFrame) -> DataFrame:
        return rows.filter(F.exists(self.vector, lambda x: x != 0) & F.forall(self.vector, lambda x: x.isNotNull() & ~F.isnan(x)))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the cell of each and its distance from the centre, as unit vectors."""
        numbers, centres = self._centres()

        @F.pandas_udf("cell INT, gap DOUBLE")
        def place(vectors: pd.Series) -> pd.DataFrame:
            if not len(vectors):
                return pd.DataFrame({"cell": np.zeros(0, np.int32), "gap": np.zeros(0)})
            gaps = _gaps(_matrix(vectors), centres)
            return pd.DataFrame({"cell": numbers[gaps.argmin(axis=1)].astype("int32"), "gap": gaps.min(axis=1)})

        return rows.withColumn("at__", place(self.vector)).withColumns(
            {"gap__": F.col("at__.gap"), "cell__": F.col("at__.cell")}).drop("at__")

    # ------------------------------------------------------------------ reading

    def _centres(self) -> tuple[np.ndarray, np.ndarray]:
        rows = self.spark.read.parquet(f"{self.root}/centres").orderBy("cell").collect()  # MOST_PIVOTS rows at most
        return np.array([r.cell for r in rows]), _matrix(pd.Series([r.centre for r in rows]))

    def _batches(self) -> int:
        return self.spark.read.parquet(f"{self.root}/sizes").agg(F.max("batch")).first()[0] or 0

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/rows")

    def live(self, cells: Sequence[int] | None = None) -> DataFrame:
        """The newest row of each key, of all cells or of the given ones; only their partitions are read."""
        inside = F.lit(True) if cells is None else F.col("cell__").isin([int(c) for c in cells])
        rows = self._rows().filter(inside)
        if not exists(self.spark, f"{self.root}/retired"):
            return rows
        gone = self.spark.read.parquet(f"{self.root}/retired").filter(inside).select(self.key, "batch__")
        return rows.join(gone, [self.key, "batch__"], "left_anti")

    def _best_possible(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells with rows and the best score a row in each can have, best first."""
        numbers, centres = self._centres()
        sizes = self.spark.read.parquet(f"{self.root}/sizes").groupBy("cell").agg(
            F.min("nearest").alias("nearest"), F.max("farthest").alias("farthest")).collect()  # a row per cell
        held = {r.cell: (r.nearest, r.farthest) for r in sizes}
        used = np.flatnonzero(np.isin(numbers, list(held)))
        if not len(used):
            return np.zeros(0, int), np.zeros(0)
        gaps = _gaps(query[None, :], centres)[0]
        near, far = (np.array([held[int(numbers[u])][k] for u in used]) for k in (0, 1))
        closest = int(gaps.argmin())
        apart = _gaps(centres[used], centres[closest:closest + 1])[:, 0]
        # a row is closer to its own centre than to the query's, which puts it beyond the plane between the two
        plane = np.divide(gaps[used] ** 2 - gaps[closest] ** 2, 2 * apart, out=np.zeros(len(used)), where=apart > 0)
        least = np.maximum.reduce([gaps[used] - far, near - gaps[used], plane]) - GAP_SLACK
        score = 1.0 - np.clip(least, 0.0, None) ** 2 / 2
        order = np.argsort(-score, kind="stable")
        return numbers[used][order], score[order]

    def cells_for(self, query: Sequence[float], k: int, within: Column | None = None) -> list[int]:
        """The cells that hold the best ``k`` rows for ``query``, and those read to prove it. ``within`` restricts the
        rows. The cells read double from round to round, so there are few rounds whatever their number."""
        q = _matrix(pd.Series([query]))[0]
        cells, possible = self._best_possible(q)
        read, best, step = 0, np.zeros(0), 1
        while read < len(cells):
            floor = best[k - 1] if len(best) >= k else -np.inf
            promising = int(np.searchsorted(-possible, SCORE_SLACK - floor, "right"))
            if promising <= read:
                break
            some = cells[read:min(read + step, promising)]
            rows = self.live(some)
            rows = rows if within is None else rows.filter(within)
            score = F.round(cosine(F.col(self.vector), F.lit([float(x) for x in q])), SCORE_DIGITS).alias("score")
            found = rows.select(score).orderBy(F.desc("score")).limit(k).collect()
            best = np.sort(np.concatenate([best, [r.score for r in found]]))[::-1][:k]
            read, step = read + len(some), step * 2
        return [int(c) for c in cells[:read]]

    def search(
        self, query: Sequence[float], k: int = 10, columns: Sequence[str] | None = None, within: Column | None = None
    ) -> DataFrame:
        """The ``k`` rows most like ``query`` by cosine, with their ``score``: what a scan of all rows gives, from the cells
        that can hold them. A query without direction finds nothing."""
        shown = list(columns) if columns else [c for c in self._rows().columns if c not in OWN_COLUMNS]
        if not any(query):
            return self.live([]).select(*shown, F.lit(0.0).alias("score"))
        rows = self.live(self.cells_for(query, k, within))
        rows = rows if within is None else rows.filter(within)
        return rows.withColumn("score", cosine(F.col(self.vector), F.lit([float(x) for x in query]))).orderBy(
            F.round("score", SCORE_DIGITS).desc(), self.key).limit(k).select(*shown, "score")


def _last_per_key(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """The last row of each key by ``order``; combined before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, F.xxhash64(*rest))).alias("row")).select(
        key, "row.*").select(*rows.columns)
