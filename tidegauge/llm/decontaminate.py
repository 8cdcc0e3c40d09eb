"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings (term, document, position) of the training texts for the terms of the benchmark,
sorted by term within each part. A search takes the rarest terms of a test phrase, shifts their posting lists by the
terms' places in the phrase, and intersects the lists: equal shifted positions are phrase candidates, nearly equal ones
proximity matches. Candidates are then checked word by word in the document.

Everything is DataFrame operations. Rows: a NULL text has no words; an item without words has no windows; a shorter
item than the window is one window; repeated items count once; rows that repeat a doc_id are judged each by its own text;
empty tables give no hits or no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import alnum_words, drop_tables, materialize

WINDOW = 13
#: Posting lists that are intersected per window, from the rarest on.
ANCHORS = 3
#: Largest distance, in words, between shifted positions of a proximity match.
SLACK = 8
#: Terms up to which the benchmark's vocabulary is broadcast (some 10 MB); a larger one is joined by a shuffle.
BROADCAST_TERMS = 200_000


def windows_of(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, phrase, n): the distinct windows of each item; ``phrase`` is its words joined by blanks."""
    words = benchmark.select("item_id", alnum_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    last = F.greatest(F.lit(1), F.size("words") - size + 1)
    starts = F.explode(F.sequence(F.lit(1), last)).alias("at")
    return (
        words.select("item_id", "words", starts)
        .select("item_id", F.slice("words", F.col("at"), size).alias("w"))
        .select("item_id", F.array_join("w", " ").alias("phrase"), F.size("w").alias("n")).distinct()
    )


def phrase_terms(phrases: DataFrame) -> DataFrame:
    """(phrase_id, place, term) for phrases (phrase_id, phrase)."""
    return phrases.select("phrase_id", F.posexplode(F.split("phrase", " ")).alias("place", "term"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term_id, doc_id, position) of ``terms`` (term_id, term) in ``docs`` (doc_id, text), as a table."""
    if terms.count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    tokens = docs.select("doc_id", F.posexplode(alnum_words(F.col("text"))).alias("position", "term"))
    postings = tokens.join(terms, "term").select("term_id", "doc_id", "position")
    return materialize(postings.sortWithinPartitions("term_id"), "postings")


def anchors_of(terms: DataFrame, counts: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """(phrase_id, rank, place, term_id): the rarest terms of each phrase whose terms all occur in the corpus.

    ``terms`` is (phrase_id, place, term_id), ``counts`` (term_id, df) the number of postings of each term."""
    rated = terms.join(counts, "term_id", "left")
    phrase = Window.partitionBy("phrase_id")
    return (
        rated.withColumn("absent", F.max(F.col("df").isNull()).over(phrase)).filter(~F.col("absent"))
        .withColumn("rank", F.row_number().over(phrase.orderBy("df", "place")))
        .filter(F.col("rank") <= anchors).select("phrase_id", "rank", "place", "term_id")
    )


def matches(index: DataFrame, anchors: DataFrame, slack: int = SLACK) -> DataFrame:
    """(phrase_id, doc_id, start, near, exact): where the anchor terms of a phrase stand together.

    ``start`` is where the phrase would begin by its rarest term. Every other anchor has an occurrence whose shifted
    position is within ``slack`` of it; ``exact`` when all are at it."""
    shifted = index.join(anchors, "term_id").select(
        "phrase_id", "rank", "doc_id", (F.col("position") - F.col("place")).alias("start")
    )
    of_phrase = anchors.groupBy("phrase_id").agg(F.count("*").alias("needed"))
    rarest = shifted.filter("rank = 1").join(of_phrase, "phrase_id")
    cell = lambda c: F.floor(c / F.lit(slack + 1))
    around = F.explode(F.array(*[cell(F.col("start")) + F.lit(k) for k in (-1, 0, 1)]))
    others = shifted.filter("rank > 1").select(
        "phrase_id", "doc_id", F.col("rank").alias("r"), F.col("start").alias("s"), cell(F.col("start")).alias("cell")
    )
    met = rarest.withColumn("cell", around).join(others, ["phrase_id", "doc_id", "cell"], "left").groupBy(
        "phrase_id", "doc_id", "start", "needed"
    ).agg(
        F.count_distinct(F.when(F.abs(F.col("s") - F.col("start")) <= slack, F.col("r"))).alias("close"),
        F.count_distinct(F.when(F.col("s") == F.col("start"), F.col("r"))).alias("same"),
    )
    return met.filter(F.col("close") == F.col("needed") - 1).select(
        "phrase_id", "doc_id", "start", (F.col("same") == F.col("needed") - 1).alias("exact")
    )


def item_digest(items: Column) -> Column:
    """sha256 of the ids as text, sorted as text, comma-joined."""
    return F.sha2(F.array_join(F.array_sort(items.cast("array<string>")), ",").cast("binary"), 256)


def judged_rows(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, carry: Sequence[str] = ("doc_id",)
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every row of ``docs`` judged: its ``carry`` columns, key, text_hash, n_words, n_hit, phrase_ids, contaminated; with
    the matches (key, phrase_id, ...) and the owners (phrase_id, item_id) of the phrases."""
    windows = materialize(windows_of(benchmark, size).withColumn("phrase_id", F.xxhash64("phrase")), "windows")
    phrases = windows.select("phrase_id", "phrase", "n").distinct()
    terms = phrase_terms(phrases).withColumn("term_id", F.xxhash64("term"))
    # rows without a doc_id are kept apart by their texts; a clash of keys only gives candidates that are not confirmed
    rows = docs.select(*carry, F.col("text").alias("_text"), F.xxhash64("doc_id", "text").alias("_key"))
    index = build_index(
        rows.select(F.col("_key").alias("doc_id"), F.col("_text").alias("text")), terms.select("term_id", "term").distinct()
    )
    counts = index.groupBy("term_id").agg(F.count("*").alias("df"))
    anchors = materialize(anchors_of(terms.select("phrase_id", "place", "term_id"), counts), "anchors")
    found = materialize(matches(index, anchors), "matches").withColumnRenamed("doc_id", "_key")
    drop_tables(index)
    per_doc = found.filter("exact").join(phrases, "phrase_id").groupBy("_key").agg(
        F.collect_list(F.struct("start", "n", "phrase", "phrase_id")).alias("_candidates")
    )
    words = F.col("_words")
    # a negative start is a phrase that would begin before the text
    fits = lambda c: (c["start"] >= 0) & (
        F.array_join(F.slice(words, c["start"] + 1, c["n"]), " ") == c["phrase"]
    )
    places = F.flatten(F.transform("_hits", lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1)))
    judged = (
        rows.join(per_doc, "_key", "left")
        .select(*carry, "_key", F.xxhash64("_text").alias("_hash"), alnum_words(F.col("_text")).alias("_words"), "_candidates")
        .withColumn("_hits", F.filter(F.coalesce("_candidates", F.array()), fits))
        .select(
            *carry, "_key", "_hash", F.size("_words").cast("long").alias("_n_words"),
            F.size(F.array_distinct(places)).cast("long").alias("_n_hit"),
            F.array_distinct(F.transform("_hits", lambda c: c["phrase_id"])).alias("_phrase_ids"),
        )
    )
    bad = (F.col("_n_hit") > 0) & (20 * F.col("_n_hit") >= F.col("_n_words"))
    return judged.withColumn("_contaminated", bad), found, windows.select("phrase_id", "item_id").distinct()


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are."""
    # the row itself travels as one column, so no name of its columns matters
    whole = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    judged, _, _ = judged_rows(whole, benchmark, carry=["_row"])
    return judged.filter(~F.col("_contaminated")).select("_row.*")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, near: bool = False) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated).

    With ``near`` also n_near_items, the items with a proximity match: the rarest terms of a window stand within
    ``SLACK`` words of their places in it."""
    judged, found, owners = judged_rows(docs, benchmark, size)
    judged = materialize(judged, "judged")
    hit_items = (
        judged.filter("_n_hit > 0").select("_key", "_hash", F.explode("_phrase_ids").alias("phrase_id"))
        .join(owners, "phrase_id").groupBy("_key", "_hash").agg(F.collect_set("item_id").alias("items"))
        .select("_key", "_hash", F.size("items").cast("long").alias("n_items"),
                item_digest(F.col("items")).alias("items_sha256"))
    )
    out = judged.join(hit_items, ["_key", "_hash"], "left").select(
        "_key", "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        F.col("_contaminated").alias("contaminated"),
    )
    if not near:
        return out.drop("_key")
    close = found.select("_key", "phrase_id").distinct().join(owners, "phrase_id").groupBy("_key").agg(
        F.count_distinct("item_id").alias("n_near_items")
    )
    return out.join(close, "_key", "left").drop("_key").fillna(0, ["n_near_items"])
