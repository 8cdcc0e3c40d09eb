"""Hidden Markov language model: latent states trained by Baum-Welch over partitions, exact likelihood of whole texts.

A text is its words and one end token. Words of the training texts are counted over the whole corpus. The model emits a
symbol per token: the most frequent words have their own, all others the symbol of their class (length and kind of last
character), and a word of a class has its smoothed share of the class's count. So the likelihood of a text is that of its
symbols, by the scaled forward recursion, times the shares of its rarer words.

Training: all training texts, dealt to parts by their hash. Incremental expectation maximization goes over the parts in
turn: the expected counts of a part, summed over partitions, replace those it had before, and the model is re-estimated
from the counts of all parts so far. So a sweep costs one pass over the texts and re-estimates as often as there are
parts, and the last estimate rests on the counts of every training text. Counts of frequent words (a bounded list)
travel to the tasks; the counts of the rest come by a join on the word, in which no frequent word takes part, so no key
is hot.

Rows: a NULL text counts as empty and is its end token alone; words unseen in training have count 0; without training
texts all probabilities are those of the smoothing; repeated rows count and are scored each; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import materialize, slices, small_batches, space_words
from tidegauge.session import scratch_path

STATES = 8
#: Words with a symbol of their own, and words whose counts travel to the tasks, at most.
SYMBOLS, FREQUENT = 4_096, 131_072
LENGTHS, KINDS = 16, 4
CLASSES = LENGTHS * KINDS
#: Parts that all training texts are dealt to, and sweeps over all parts.
PARTS, SWEEPS = 8, 2
#: Counts added to the expected ones in re-estimation.
ADD_MOVES, ADD_SYMBOLS = 0.5, 0.05
SEED = 29
#: Steps after which the forward pass leaves a checkpoint, so that the backward pass needs bounded memory.
SEGMENT = 256
#: Tokens between two checkpoints, as far as a step of all sequences allows: short texts are many side by side.
SEGMENT_TOKENS = 1 << 17
CHUNKS = 16
#: Text whose sequences run side by side.
BATCH_BYTES = 8 << 20
#: How much likelier than a move the initial model takes a state to stay: states then settle on kinds of text.
STAY = 30.0


# ------------------------------------------------------------------ words and classes

def word_class(word: Column) -> Column:
    last = F.ascii(F.right(word, F.lit(1)))
    kind = F.when(last.between(97, 122), 0).when(last.between(48, 57), 1).when(last < 128, 2).otherwise(3)
    return (F.least(F.octet_length(word), F.lit(LENGTHS)) - 1) * KINDS + kind


def class_of(word: str) -> int:
    last = word[-1]
    kind = 0 if "a" <= last <= "z" else 1 if "0" <= last <= "9" else 2 if last < "\x80" else 3
    return (min(len(word.encode()), LENGTHS) - 1) * KINDS + kind


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all ``docs`` (text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            words, at, _ = space_words(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(np.bincount(at, minlength=len(words)).astype(np.int64))], ["word", "c"]
            )

    small_batches(docs.sparkSession, 2048)
    return docs.select("text").mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequency_level() -> Column:
    """Eighths of a power of two of the count ``c``: some hundred levels at any size."""
    return F.floor(F.log2("c") * 8).cast("int")


class Vocabulary:
    """Totals of the training tokens, and the frequent words with their counts."""

    def __init__(self, words: DataFrame, n_texts: int):
        level = frequency_level()
        sizes = words.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
        self.low = self._lowest(sizes, FREQUENT)
        own = self._lowest(sizes, SYMBOLS)
        held = words.filter(level >= self.low).select("word", "c", (level >= own).alias("own")).collect()
        self.frequent = {r.word: r.c for r in held}
        self.symbols = {w: CLASSES + 1 + i for i, w in enumerate(sorted(r.word for r in held if r.own))}
        self.texts = n_texts
        rest = words.withColumn("k", F.when(level < own, word_class(F.col("word"))).otherwise(CLASSES)).groupBy("k").agg(
            F.sum("c").alias("c"), F.count("*").alias("n")
        ).collect()  # one row per class
        count, distinct = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
        for r in rest:
            count[r.k], distinct[r.k] = r.c, r.n
        self.tokens = int(count.sum()) + n_texts
        self.distinct = int(distinct.sum()) + (n_texts > 0)
        self.divisor = self.tokens + 0.5 * (self.distinct + 1)
        self.class_divisor = count[:CLASSES] + 0.5 * (distinct[:CLASSES] + 1)

    @staticmethod
    def _lowest(sizes: list, most: int) -> int:
        """The lowest level from which on there are at most ``most`` words."""
        low, total = 10**6, 0
        for r in sizes:
            total += r.n
            if total > most:
                break
            low = r.level
        return low


#: The end token's symbol.
END = CLASSES


class Reader:
    """Texts to symbols, with what the bounded word list says of them."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary

    def symbols(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Symbols of all texts in a row with the end symbol behind each, tokens per text, and (words, at, counts)."""
        words, at, counts = space_words(texts)
        get = self.v.symbols.get
        own = np.fromiter((get(w) or class_of(w) for w in words), np.int32, len(words))
        n = counts + 1
        ends = np.cumsum(n)
        out = np.full(int(ends[-1]) if len(n) else 0, END, np.int32)
        inside = np.ones(len(out), bool)
        inside[ends - 1] = False
        out[inside] = own[at]
        return out, n, (words, at, counts)


# ------------------------------------------------------------------ the model

class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (K), (K, K), (symbols, K): emit[s, k] = P(s | k)

    @classmethod
    def initial(cls, symbols: int) -> Model:
        rng = np.random.default_rng(SEED)
        return cls.estimated(
            rng.uniform(0.5, 1.5, STATES), rng.uniform(0.5, 1.5, (STATES, STATES)) + STAY * np.eye(STATES),
            rng.uniform(0.5, 1.5, (symbols, STATES))
        )

    @classmethod
    def estimated(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Model:
        start, move, emit = start + ADD_MOVES, move + ADD_MOVES, emit + ADD_SYMBOLS
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


class Batch:
    """Symbol sequences side by side, longest first: at step t the first ``active[t]`` of them still run."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.symbols, self.lengths = symbols, lengths[self.order]
        self.offsets = (np.cumsum(lengths) - lengths)[self.order]
        self.longest = int(self.lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-self.lengths, -np.arange(self.longest), "left")

    def at(self, t: int) -> np.ndarray:
        return self.symbols[self.offsets[: self.active[t]] + t]

    def forward(self, m: Model, begin: int, end: int, alpha: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(step, scaled forward variables, scales) for steps ``begin`` to ``end``; ``alpha`` is that before ``begin``."""
        for t in range(begin, end):
            n = self.active[t]
            alpha = (m.start if alpha is None else alpha[:n] @ m.move) * m.emit[self.at(t)]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            yield t, alpha, scale

    def log_likelihood(self, m: Model) -> np.ndarray:
        """Natural log of each sequence's probability, in the order given."""
        total = np.zeros(len(self.lengths))
        for _, alpha, scale in self.forward(m, 0, self.longest, None):
            total[: len(alpha)] += np.log(scale)
        out = np.empty_like(total)
        out[self.order] = total
        return out

    def segments(self) -> list[int]:
        """Where the checkpoints are: at most ``SEGMENT`` steps apart, and ``SEGMENT_TOKENS`` or a single step."""
        cuts, held = [0], 0
        for t, n in enumerate(self.active.tolist()):
            if t > cuts[-1] and (t - cuts[-1] >= SEGMENT or held + n > SEGMENT_TOKENS):
                cuts.append(t)
                held = 0
            held += n
        return [*cuts, self.longest] if self.longest else cuts

    def expected(self, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts (start, move, emit) of Baum-Welch."""
        k = len(m.start)
        start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((len(m.emit), k))
        cuts = self.segments()
        last = {end - 1 for end in cuts[1:]}
        points: list[np.ndarray | None] = [None]
        for t, alpha, _ in self.forward(m, 0, self.longest, None):
            if t in last:
                points.append(alpha)
        back, ahead = np.zeros((0, k)), None  # ahead: emission times backward over scale, of the step behind
        for segment in reversed(range(len(cuts) - 1)):
            begin, end = cuts[segment], cuts[segment + 1]
            steps = list(self.forward(m, begin, end, points[segment]))
            seen, weights = [], []
            for t, alpha, scale in reversed(steps):
                n = len(alpha)
                back = np.ones((n, k))
                if ahead is not None and len(ahead):
                    back[: len(ahead)] = ahead @ m.move.T
                    move += alpha[: len(ahead)].T @ ahead
                share = alpha * back
                seen.append(self.at(t))
                weights.append(share)
                ahead = m.emit[seen[-1]] * back / scale[:, None]
            if begin == 0 and weights:
                start += weights[-1].sum(axis=0)
            symbol, weight = np.concatenate(seen), np.concatenate(weights)
            for s in range(k):
                emit[:, s] += np.bincount(symbol, weights=weight[:, s], minlength=len(emit))
        return start, move * m.move, emit


def expected_counts(docs: DataFrame, reader: Reader, model: Model) -> np.ndarray:
    """The expected counts (start, move, emit) over ``docs`` (text), one behind the other, summed over partitions."""
    k, symbols = len(model.start), len(model.emit)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k + symbols * k)
        for batch in slices(batches, "text", BATCH_BYTES):
            flat, lengths, _ = reader.symbols(batch.column("text"))
            total += np.concatenate([x.ravel() for x in Batch(flat, lengths).expected(model)])
        parts = np.array_split(total, CHUNKS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(CHUNKS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["chunk", "sums"]
        )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in pdf["sums"])
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "sums": [total.tobytes()]})

    schema = "chunk int, sums binary"
    added = docs.select("text").mapInArrow(count, schema).groupBy("chunk").applyInPandas(add, schema).collect()
    if not added:
        return np.zeros(k + k * k + symbols * k)
    return np.concatenate([np.frombuffer(r.sums) for r in sorted(added, key=lambda r: r.chunk)])


def train(training: DataFrame, reader: Reader) -> Model:
    model = Model.initial(CLASSES + 1 + len(reader.v.symbols))
    if not reader.v.texts:
        return model
    k, symbols = len(model.start), len(model.emit)
    part = F.pmod(F.xxhash64("text"), F.lit(PARTS)).cast("int").alias("part")
    path = scratch_path(training.sparkSession, "parts")
    training.select("text", part).write.partitionBy("part").option("compression", "zstd").parquet(path)
    parts = training.sparkSession.read.schema("text string, part int").parquet(path)
    counts = np.zeros((PARTS, k + k * k + symbols * k))
    for _ in range(SWEEPS):
        for i in range(PARTS):
            counts[i] = expected_counts(parts.filter(F.col("part") == i), reader, model)
            start, move, emit = np.split(counts.sum(axis=0), [k, k + k * k])
            model = Model.estimated(start, move.reshape(k, k), emit.reshape(symbols, k))
    return model


# ------------------------------------------------------------------ scores

SCORED = (
    "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, "
    "rare_words array<string>, rare_counts array<int>"
)


def score_frequent(docs: DataFrame, reader: Reader, model: Model) -> DataFrame:
    """Per text all that the bounded word list tells, and its other words with their counts."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = reader.v
        row = TaskContext.get().partitionId() << 40
        end_base = np.log10((v.texts + 0.5) / v.divisor)
        for batch in slices(batches, "text", BATCH_BYTES):
            flat, lengths, (words, at, counts) = reader.symbols(batch.column("text"))
            hmm = Batch(flat, lengths).log_likelihood(model) / np.log(10)
            c = np.fromiter((v.frequent.get(w, 0) for w in words), np.float64, len(words))
            listed = c > 0
            base = np.where(listed, np.log10((c + 0.5) / v.divisor), 0.0)
            classed = np.fromiter((w not in v.symbols for w in words), bool, len(words))
            kind = np.fromiter(map(class_of, words), np.int64, len(words))
            share = np.where(listed & classed, np.log10((c + 0.5) / v.class_divisor[kind]), 0.0)
            doc = np.repeat(np.arange(len(counts)), counts)
            total = partial(np.bincount, doc, minlength=len(counts))
            rare = ~listed[at]
            pair, times = np.unique(doc[rare] * max(len(words), 1) + at[rare], return_counts=True)
            owner, word = np.divmod(pair, max(len(words), 1))
            cuts = pa.array(np.searchsorted(owner, np.arange(len(counts) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(len(counts))), batch.column("doc_id"), pa.array(lengths.astype(np.int64)),
                    pa.array(total(weights=listed[at]).astype(np.int64) + (v.texts > 0)),
                    pa.array(total(weights=base[at]) + end_base), pa.array(total(weights=share[at]) + hmm),
                    pa.ListArray.from_arrays(cuts, pa.array(words[word], pa.string())),
                    pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
                ],
                ["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "rare_words", "rare_counts"],
            )
            row += len(counts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, SCORED)


def scores(docs: DataFrame, training: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text), learned from
    the rows where ``training`` holds. Scores are log10 probabilities."""
    learned = docs.filter(training).select("text")
    words = materialize(word_counts(learned), "words")
    vocabulary = Vocabulary(words, learned.count())
    reader = Reader(vocabulary)
    small_batches(docs.sparkSession, 2048)
    model = train(learned, reader)
    rows = materialize(score_frequent(docs, reader, model), "scores")
    rare = rows.select("row", F.explode(F.arrays_zip("rare_words", "rare_counts")).alias("x")).select(
        "row", F.col("x.rare_words").alias("word"), F.col("x.rare_counts").alias("times")
    )
    c = F.coalesce("c", F.lit(0))
    divisor = F.element_at(F.array(*[F.lit(float(x)) for x in vocabulary.class_divisor]), word_class(F.col("word")) + 1)
    told = rare.join(words.filter(frequency_level() < vocabulary.low), "word", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(vocabulary.divisor))).alias("base"),
        F.sum(F.col("times") * F.log10((c + 0.5) / divisor)).alias("share"),
    )
    return rows.drop("rare_words", "rare_counts").join(told, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("share", F.lit(0.0))).alias("score"),
    )
