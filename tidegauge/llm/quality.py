"""Quality classifier: kernel ridge regression on document statistics by random Fourier features, with calibration.

Each text gives a short vector of statistics. Random Fourier features of the standardised vector approximate a Gaussian
kernel; the ridge weights come from normal equations that every partition sums over its rows, so what is gathered has a
fixed size. Scores of rows kept out of the fit are turned into probabilities by isotonic regression on binned counts.

Rows: a NULL text counts as empty and is scored by its (zero) statistics; labels that are NULL or have no document are
left out; repeated rows are scored alike and count each in the fit; without labels of training rows every score is 0.5;
an empty table gives no rows; further columns are ignored or carried, as asked.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from string import ascii_uppercase, digits, punctuation

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import drop_tables, fold, materialize, small_batches

#: Random features, width of the Gaussian kernel (in standard deviations), ridge penalty, and the seed of the features.
FEATURES, WIDTH, RIDGE, SEED = 256, 4.5, 1e-2, 11
#: Labelled rows the model is fitted on: all, or a hash sample of about so many.
FIT_ROWS = 500_000
#: Standardised statistics are cut to this range.
RANGE = 6.0
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
BINS = 1_000
KEEP_FROM = 0.3

UPPER, DIGITS, PUNCTUATION = ascii_uppercase.encode(), digits.encode(), punctuation.encode()
SYMBOLS, SPACE, BEYOND = b"!?|#*%$~^@<>{}[]=+_\\", b" \t\n\r\x0b\x0c", bytes(range(128, 256))
N_STATISTICS = 17


def statistics_of(text: str | None) -> list[float]:
    """Lengths, repetition, character classes, line structure and compressibility of a whole text."""
    data = (text or "").encode()
    n = max(len(data), 1)
    words = data.lower().split()
    k = max(len(words), 1)
    lines = data.split(b"\n")
    share = lambda characters: (len(data) - len(data.translate(None, characters))) / n
    counts = Counter(words)
    return [
        float(np.log1p(len(words))), (1 - share(SPACE)) * n / k, len(counts) / k,
        sum(map(bytes.__eq__, words, words[1:])) / k, share(UPPER), share(DIGITS), share(PUNCTUATION), share(SYMBOLS),
        share(BEYOND), sum(len(w) < 4 for w in words) / k, 1 - len(set(lines)) / len(lines),
        len(zlib.compress(data, 1)) / n, data.count(b".") / k, max(counts.values(), default=0) / k,
        float(np.log1p(len(lines))), data.count(b",") / k, max(map(len, counts), default=0) ** 0.5,
    ]


def with_statistics(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of ``docs`` and the array ``stats``, as a table: every text is read once."""
    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return texts.map(statistics_of)

    small_batches(docs.sparkSession, 2048)
    return materialize(docs.select(*carry, stats("text").alias("stats")), "statistics")


class Features:
    """Standardise statistics and map them to random Fourier features."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        self.mean, self.spread = mean, np.where(spread > 0, spread, 1.0)
        rng = np.random.default_rng(SEED)
        self.directions = rng.normal(size=(len(mean), FEATURES)) / WIDTH
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.spread, -RANGE, RANGE)
        return np.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phases)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), N_STATISTICS)


def normal_equations(rows: DataFrame, features: Features, centre: float) -> tuple[np.ndarray, np.ndarray]:
    """Sums over ``rows`` (stats, label) of feature products and of features times centred labels.

    Each partition returns one row per feature, and the rows of a feature are added up."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES, FEATURES + 1))
        for batch in batches:
            if batch.num_rows:
                p = features(matrix(batch.column("stats")))
                y = batch.column("label").to_numpy() - centre
                total += p.T @ np.hstack([p, y[:, None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(FEATURES), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["feature", "sums"]
        )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"feature": pdf["feature"].iloc[:1], "sums": [np.sum(np.stack(pdf["sums"].to_list()), axis=0)]})

    schema = "feature int, sums array<double>"
    added = rows.select("stats", "label").mapInArrow(sums, schema).groupBy("feature").applyInPandas(add, schema)
    full = np.zeros((FEATURES, FEATURES + 1))
    for r in added.collect():  # FEATURES rows
        full[r.feature] = r.sums
    return full[:, :-1], full[:, -1]


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing least-squares fit at ascending ``x``: pool adjacent violators; block centres and values."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x, y, weight, strict=True):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class Model:
    def __init__(self, features: Features, weights: np.ndarray, centre: float):
        self.features, self.weights, self.centre = features, weights, centre
        self.steps: tuple[np.ndarray, np.ndarray] | None = None

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.weights + self.centre, 0.0, 1.0)

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        return raw if self.steps is None else np.interp(raw, *self.steps)

    def column(self, calibrated: bool = True) -> Column:
        @F.pandas_udf("double")
        def apply(stats: pd.Series) -> pd.Series:
            x = np.stack(stats.to_list()) if len(stats) else np.zeros((0, N_STATISTICS))
            return pd.Series(self.score(x) if calibrated else self.raw(x))

        return apply("stats")


def fit(stats: DataFrame, labels: DataFrame) -> Model | None:
    """The model of ``stats`` (doc_id, stats) and ``labels`` (doc_id, quality), without held-out rows."""
    part = fold(F.col("doc_id"), FOLDS)
    rows = stats.select("doc_id", "stats").join(
        labels.filter("quality IS NOT NULL").select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id"
    ).select("stats", "label", part.alias("part"), F.xxhash64("doc_id").alias("h")).filter(F.col("part") != HELD_OUT)
    rows = materialize(rows, "labelled")
    n = rows.count()
    if not n:
        return None
    bound = F.pmod("h", F.lit(1_000_000)) < int(1_000_000 * min(1.0, FIT_ROWS / n))
    rows = rows.filter(bound)
    training = rows.filter(F.col("part") != CALIBRATION)
    training = rows if training.isEmpty() else training
    at = [F.get("stats", F.lit(i)) for i in range(N_STATISTICS)]
    moments = training.agg(F.avg("label"), *map(F.avg, at), *map(F.stddev_pop, at)).first()
    centre = moments[0]
    features = Features(np.array(moments[1 : 1 + N_STATISTICS]), np.array(moments[1 + N_STATISTICS :]))
    products, target = normal_equations(training, features, centre)
    model = Model(features, np.linalg.solve(products + RIDGE * np.eye(FEATURES), target), centre)
    raw = F.round(model.column(calibrated=False) * BINS).alias("bin")
    counts = rows.filter(F.col("part") == CALIBRATION).select(raw, "label").groupBy("bin").agg(
        F.avg("label").alias("y"), F.count("*").alias("n")
    ).orderBy("bin").collect()  # BINS + 1 rows at most
    if counts:
        x, y, w = (np.array([r[k] for r in counts], np.float64) for k in ("bin", "y", "n"))
        model.steps = isotonic(x / BINS, y, w)
    return model


def good_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, as they are. The model is fitted on stored statistics; the texts are
    then judged on the way, so no text is stored twice."""
    stats = with_statistics(docs)
    model = fit(stats, labels)
    drop_tables(stats)
    if model is None:
        return docs

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = np.array([statistics_of(t) for t in texts], np.float64).reshape(len(texts), N_STATISTICS)
        return pd.Series(model.score(found))

    return docs.filter(score("text") >= KEEP_FROM)


def scored(docs: DataFrame, labels: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of ``docs``, score (0 to 1) and predicted (1: keep)."""
    stats = with_statistics(docs, list(dict.fromkeys(["doc_id", *carry])))
    model = fit(stats, labels)
    score = F.lit(0.5) if model is None else model.column()
    return stats.select(*carry, score.alias("score")).withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int"))
