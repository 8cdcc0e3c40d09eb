"""The near-copies stage against all pairs at its own width and similarity."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from test_ngram_join import near_copies

from tidegauge.llm import ngram_join

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def kept_of(rows, width=5, percent=80):
    """The smallest id of each class of (id, text), by all pairs."""
    sets, top = [], {d: d for d, _ in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for d, text in rows:
        words = (text or "").split()
        s = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
        for e, o in sets:
            if s and o and 100 * len(s & o) >= percent * len(s | o):
                a, b = sorted((find(d), find(e)))
                top[b] = a
        sets.append((d, s))
    return sorted(d for d, _ in rows if find(d) == d)


def stage(spark, rows):
    docs = spark.createDataFrame([(d, t, "en", "x", 0) for d, t in rows], SCHEMA)
    return sorted(r.doc_id for r in corpus_pipeline.one_of_near_copies(spark, docs, "").collect())


def edited(size, edits, every):
    words = [f"w{i}" for i in range(size)]
    for k in range(edits):
        words[every * (k + 1)] = f"other{k}"
    return " ".join(words)


def test_stage_joins_five_words_at_four_fifths(spark):
    # by 3 words both pairs are below 0.9, by 5 words above 0.8; the last copy is below either
    rows = [(0, edited(100, 0, 1)), (1, edited(100, 2, 30)), (10, edited(400, 0, 1) + " z"), (11, edited(400, 8, 40) + " z"),
            (12, edited(400, 12, 30) + " z")]
    assert stage(spark, rows) == kept_of(rows) == [0, 10, 12]


def test_stage_equals_all_pairs(spark):
    texts = [None, "", "one", "one two three four", "one two three four", "a b a b a b a b", "a b c d e", "a b c d e f"]
    for k, (n, size, edits) in enumerate([(30, 60, 5), (25, 150, 12), (25, 14, 1), (20, 13, 2), (15, 400, 30), (20, 24, 2)]):
        texts += near_copies(k, n, size, edits)
    rows = list(enumerate(texts))
    random.Random(2).shuffle(rows)
    assert stage(spark, rows) == kept_of(rows)


def test_linked_sets_share_a_key_at_any_percent():
    rng = np.random.default_rng(6)
    for percent in (50, 70, 80, 85, 90, 95):
        linked = 0
        for _ in range(1200):
            n = int(rng.integers(1, 120))
            base = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
            most = 2 * n * (100 - percent) // (100 + percent) + 1
            gone, added = int(rng.integers(0, most + 1)), int(rng.integers(0, most + 1))
            x, y = np.unique(base), np.unique(np.concatenate([base[gone:], rng.integers(0, 2**63, added, dtype=np.uint64)]))
            common = len(np.intersect1d(x, y))
            if (gone or added) and common and 100 * common >= percent * (len(x) + len(y) - common):
                linked += 1
                assert len(np.intersect1d(ngram_join.candidate_keys(x, percent), ngram_join.candidate_keys(y, percent)))
        assert linked > 50


def test_classes_are_kept_by_their_own_key(spark):
    near = [edited(100, 0, 1), edited(100, 1, 30)]
    lone = [" ".join(f"{k}{w}" for w in near[0].split()) for k in "ab"]
    rows = [
        (3, "one clean text of its own"), (3, "another clean text with the same id"), (3, "another clean text with the same id"),
        (None, near[0]), (None, near[1]), (None, lone[0]), (-1, lone[1]), (None, lone[1] + " end"), (4, ""), (4, None), (4, ""), (None, " "),
    ]
    docs = spark.createDataFrame([(d, t, "en", "x", 0) for d, t in rows], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.one_of_near_copies(spark, docs, "").collect()), key=repr)
    first = [x for x in kept if x[1] in near]
    assert len(first) == 1
    assert [x for x in kept if x not in first] == sorted([*rows[:2], rows[5], rows[6], *rows[8:10], rows[11]], key=repr)


def test_candidates_are_fetched_without_a_broadcast_of_them(spark, monkeypatch):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame(
        [(None if k % 50 == 0 else k % 900, None if k % 97 == 0 else f"text {k % 700}") for k in range(2_000)] + [(5, "")], schema)
    named = docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("none"), F.xxhash64("text").alias("h")
    ).distinct()
    source = named.filter("pmod(h, 3) = 0").select(
        F.col("h").alias("node"), (F.col("h") % 7).alias("cluster"), "d", "none", "h", F.explode(F.array(F.lit(0), F.lit(1))).alias("chunk"))
    plain = docs.select("text", F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("none"), F.xxhash64("text").alias("h"))
    wanted = sorted(map(repr, plain.join(source, ["d", "none", "h"]).select("node", "cluster", "chunk", "text").collect()))
    assert 100 < len(wanted) < source.count() * 3
    monkeypatch.setattr(ngram_join, "BITMAP_BITS", 64)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most in (1, 3, 2048):  # too few bits for the keys, too, only let more rows pass
            monkeypatch.setattr(ngram_join, "MOST_BITMAPS", most)
            got = ngram_join.texts_of(docs, source)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert plan.count("BroadcastExchange") == 1 and "SortMergeJoin" in plan  # of the bitmaps, and of nothing else
            assert sorted(map(repr, got.collect())) == wanted
            assert ngram_join.bitmaps(source.select(F.xxhash64("d", "none", "h").alias("key")))[0].count() <= most
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
