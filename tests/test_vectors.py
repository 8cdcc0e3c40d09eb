"""Embedding, search, neighbours, novelty; neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidegauge import registry
from tidegauge.operators import vector_index as v
from tidegauge.sources.tables import written


def vectors(spark, m, first=0):
    data = [(first + i, [float(x) for x in row]) for i, row in enumerate(m)]
    return spark.createDataFrame(data, "id bigint, embedding array<float>")


def brute(q, s, k, same=False):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit(q) @ unit(s).T, 9)
    out = {}
    for i, line in enumerate(scores):
        order = sorted((j for j in range(len(s)) if not (same and i == j)), key=lambda j: (-line[j], j))[:k]
        out[i] = [(j, line[j]) for j in order]
    return out


@pytest.mark.parametrize("pivots, block_bytes", [(1, 1 << 20), (None, 1 << 20), (16, 1 << 20), (16, 1)])
@pytest.mark.parametrize("same", [False, True])
def test_neighbours_equal_brute_force(spark, pivots, block_bytes, same):
    r = np.random.default_rng(5)
    crowd = r.normal(size=(1, 6)) + 0.05 * r.normal(size=(200, 6))  # one crowded cell
    m = np.float32(np.vstack([crowd, r.normal(size=(100, 6)), crowd[:3]]))  # and exact copies
    df = vectors(spark, m)
    got = {}
    for row in v.nearest_neighbours(df, df, 4, drop_self=same, pivots=pivots, block_bytes=block_bytes).collect():
        got.setdefault(row["key"], []).append((row["place"], row["neighbour"], row["score"]))
    want = brute(m.astype(float), m.astype(float), 4, same)
    assert set(got) == set(want)
    for key, expected in want.items():
        found = sorted(got[key])
        assert [s for _, _, s in found] == pytest.approx([s for _, s in expected], abs=2e-9)
        assert [n for _, n, _ in found] == [n for n, _ in expected]


def test_many_equal_scores_and_text_keys(spark):
    """A third of all rows are copies of one vector: ties go to the smaller key, in every block."""
    m = np.float32(np.vstack([np.repeat([[1.0, 2.0]], 300, axis=0), np.random.default_rng(2).normal(size=(600, 2))]))
    df = vectors(spark, m).withColumn("id", F.format_string("k%04d", F.col("id")))
    got = v.nearest_neighbours(df, df, 3, drop_self=True, pivots=5, block_bytes=1)
    mine = {r["key"]: [] for r in df.select(F.col("id").alias("key")).collect()}
    for r in got.orderBy("key", "place").collect():
        mine[r["key"]].append(r["neighbour"])
    assert mine["k0000"] == ["k0001", "k0002", "k0003"] and mine["k0299"] == ["k0000", "k0001", "k0002"]
    assert {len(x) for x in mine.values()} == {3}


def test_equal_vectors_are_compared_once(spark, monkeypatch):
    """Exact copies, rows without a usable vector, and another table of queries: results of all rows, few comparisons."""
    r = np.random.default_rng(3)
    m = np.float32(np.repeat(r.normal(size=(30, 5)), 40, axis=0))
    s = vectors(spark, m)
    odd = spark.createDataFrame([(5000, [float("nan")] * 5), (5001, [1.0, None, 0.0, 0.0, 0.0]), (5002, None)], s.schema)
    s = s.unionByName(odd)
    stored = []
    keep = lambda df, label, **o: stored.append((label, written(df, label, **o))) or stored[-1][1]
    monkeypatch.setattr(v, "written", keep)
    for queries, first, same in [(s, 0, True), (vectors(spark, m[::7], 9000), 9000, False)]:
        stored.clear()
        got = {}
        for row in v.nearest_neighbours(queries, s, 3, drop_self=same, block_bytes=1).collect():
            got.setdefault(row["key"] - first, []).append((row["place"], row["neighbour"]))
        want = brute((m if same else m[::7]).astype(float), m.astype(float), 3, same)
        assert {q: [n for _, n in sorted(x)] for q, x in got.items()} == {q: [n for n, _ in x] for q, x in want.items()}
        assert dict(stored)["vectors"].count() == 30


def test_memory_of_a_step_does_not_grow_with_the_pivots():
    """Rows are taken so few at a time that their distances to all pivots have a bounded size."""
    frame = v.pd.DataFrame({"x": range(10_000)})
    for width in (64, 1024, 4096):
        sizes = [len(b) for b in v._some_rows([frame], width)]
        assert sum(sizes) == len(frame) and max(sizes) * width <= v.GAP_CELLS


def test_text_search_embeds_the_texts_once(spark, sf):
    found = registry.QUERIES["v3_text_search"](spark, sf)
    assert found.inputFiles() and not any("documents.parquet" in f for f in found.inputFiles())


def test_slot_frequencies_equal_plain_counts(spark):
    rows_ = [(1, [0.0, 2.0, -1.0]), (2, [0.0, 0.5, 0.0]), (3, None), (4, [0.0, None, 3.0]), (5, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows_, "id bigint, embedding array<float>")
    assert rows(v.slot_frequencies(df)) == [(-1, 4), (1, 2), (2, 2)]
    assert v.slot_frequencies(df.limit(0)).count() == 0


def test_far_cells_are_skipped(spark):
    """Tight clusters: a query is sent to its own cell, not to all."""
    r = np.random.default_rng(1)
    centres = np.eye(8)
    m = np.float32(np.repeat(centres, 40, axis=0) + 0.01 * r.normal(size=(320, 8)))
    df = vectors(spark, m)
    got = v.nearest_neighbours(df, df, 2, drop_self=True, pivots=24)
    assert {r["neighbour"] // 40 == r["key"] // 40 for r in got.collect()} == {True}


def test_zero_vectors_and_empty_index(spark):
    df = vectors(spark, [[1, 0], [0, 0], [0.6, 0.8]])
    assert {r["key"] for r in v.nearest_neighbours(df, df, 1).collect()} == {0, 2}
    assert v.nearest_neighbours(df, df.limit(0), 1).count() == 0
    assert [r["id"] for r in v.similarity_search(df, [1.0, 0.0], 5, ["id"]).collect()] == [0, 2]


def test_novelty(spark):
    df = vectors(spark, [[1, 0], [0.75, 0.6614378], [-1, 0.01], [0, -1]])
    got = {r["id"]: (r["is_novel"], r["neighbour"]) for r in v.novelty(df, df, 0.7).collect()}
    assert got == {0: (False, 1), 1: (False, 0), 2: (True, 3), 3: (True, 0)} or got[0] == (False, 1)
    alone = df.limit(1)
    assert rows(v.novelty(alone, alone)) == [(0, True, None, None)]
    pair = vectors(spark, [[1, 0], [0.6, 0.8]])
    assert rows(v.novelty(pair, pair, 0.6), "is_novel") == [(False,), (False,)]  # score at the threshold is known
    assert rows(v.novelty(pair, pair, 0.61), "is_novel") == [(True,), (True,)]


def summaries(spark, *texts):
    data = [(f"i{n}", f"t{n}", float(n), text) for n, text in enumerate(texts)]
    return spark.createDataFrame(data, "id string, title string, z_score double, summary string").withColumn(
        "generated_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def test_sync_search_and_related(spark):
    texts = summaries(
        spark, "Élection results were updated", "A storm hit the coast", "Storm damage along the coast", "élection night results")
    index = v.index_additions(texts)
    assert index.count() == 4
    assert v.index_additions(texts, index).count() == 0
    hits = v.search_text(index, "results of the élection", 2).collect()
    assert {h["id"] for h in hits} == {"i0", "i3"} and hits[0]["score"] >= hits[1]["score"]
    exact = v.search_text(index, "A storm hit the coast", 1).first()
    assert exact["id"] == "i1" and exact["score"] == pytest.approx(1.0)
    related = v.related_events(index, 3)  # the seed is the highest z-score, i3
    assert [r["id"] for r in related.collect()][0] == "i0" and "i3" not in {r["id"] for r in related.collect()}
    assert related.count() == 2


def test_newest_version_of_an_id_is_indexed(spark):
    one = summaries(spark, "old text")
    two = one.withColumn("summary", F.lit("new text")).withColumn("generated_at", F.lit("2024-02-01").cast("timestamp"))
    assert rows(v.index_additions(one.unionByName(two)), "summary") == [("new text",)]


PROSE = "the committee met on {a} to discuss the {b} of the {c} and after the debate the members of the house voted for the {b}"


def texts(spark):
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 7))
    rows_ = [(f"s{i}", "t", 1.0, " ".join([PROSE.format(a=word(), b=word(), c=word()), *(word() for _ in range(12))]), None) for i in range(60)]
    near = rows_[0][3].split()
    near[20] = "changed"
    rows_.append(("near", "t", 1.0, " ".join(near), None))
    return spark.createDataFrame(rows_, "id string, title string, z_score double, summary string, generated_at timestamp")


def test_weights_tell_unrelated_texts_of_one_language_from_copies(spark):
    index = v.embed(texts(spark)).cache()
    parts = [v.slot_frequencies(index.filter(cond)) for cond in ("id < 's3'", "id >= 's3'")]
    weights = v.word_weights(parts[0].unionByName(parts[1]))
    assert weights == v.word_weights(v.slot_frequencies(index)) and len(weights) == v.DIMENSIONS
    assert min(weights) == 0.0 and v.word_weights(spark.createDataFrame([], "slot int, texts bigint"))[:2] == [1.0, 1.0]
    plain = {r.id: r.score for r in v.novelty(index, index).collect()}
    told = {r.id: (r.is_novel, r.score) for r in v.novelty(index, index, weights=weights).collect()}
    assert not told["near"][0] and not told["s0"][0] and told["near"][1] > 0.8
    rest = [k for k in told if k not in ("near", "s0")]
    assert all(told[k][0] and told[k][1] < 0.5 for k in rest)
    assert min(plain[k] for k in rest) > 0.4  # without weights the common words make all alike
    phrase = " ".join(texts(spark).filter("id = 's7'").first().summary.split()[-4:]) + " the of and"
    assert v.search_text(index, phrase, 1, ["id"], weights).first().id == "s7"
    index.unpersist()


def test_embedding_damps_repeats_and_keeps_empty_texts(spark):
    df = spark.createDataFrame([("a a a a b",), ("a b",), ("",), (None,)], "summary string")
    got = [np.array(r.embedding) for r in v.embed(df).collect()]
    assert [round(float(np.linalg.norm(x)), 5) for x in got] == [1, 1, 0, 0] and all(len(x) == v.DIMENSIONS for x in got)
    assert sorted(got[0][got[0] > 0].tolist()) == pytest.approx(sorted([(1 + np.log(4)) / np.hypot(1 + np.log(4), 1), 1 / np.hypot(1 + np.log(4), 1)]), abs=1e-6)


def test_rewritten_summaries_replace_indexed_ones(spark):
    schema = "id string, title string, z_score double, summary string, generated_at timestamp"
    at = lambda day: f"2024-01-{day:02} 00:00:00"

    def table(*rows_):
        return spark.createDataFrame([(i, "t", 1.0, s, d) for i, s, d in rows_], schema.replace("timestamp", "string")).withColumn(
            "generated_at", F.col("generated_at").cast("timestamp"))

    stored = v.index_additions(table(("a", "one", at(1)), ("b", "two", at(1)), ("c", "three", None)))
    later = table(("a", "one", at(1)), ("a", "one again", at(3)), ("b", "older", at(1)), ("c", "dated", at(2)), ("d", "new", None))
    more = v.index_additions(later, stored)
    assert rows(more, "id", "summary") == [("a", "one again"), ("c", "dated"), ("d", "new")]
    now = v.current_index(stored.unionByName(more))
    assert rows(now, "id", "summary") == [("a", "one again"), ("b", "two"), ("c", "dated"), ("d", "new")]
    assert v.index_additions(later, stored.unionByName(more)).count() == 0
    back = v.index_additions(table(("a", "one", at(5))), stored.unionByName(more))
    assert rows(back, "id", "summary") == [("a", "one")]  # back to an earlier text


def test_only_pairs_of_blocks_travel_one_by_one(spark, monkeypatch):
    """Which blocks meet is worked out for many vectors at once, not within the small batches of the pairs."""
    key, sizes = "spark.sql.execution.arrow.maxRecordsPerBatch", {}
    keep = lambda df, label, **o: sizes.update({label: spark.conf.get(key)}) or written(df, label, **o)
    monkeypatch.setattr(v, "written", keep)
    df = vectors(spark, np.random.default_rng(4).normal(size=(200, 4)))
    v.nearest_neighbours(df, df, 1, drop_self=True, block_bytes=1).count()
    assert {label for label, n in sizes.items() if n == "1"} == {"bests"} and sizes["meets"] == spark.conf.get(key)


@pytest.mark.parametrize("columns", [1, 2, 3, 40, 200])
def test_what_the_best_of_a_block_reach(columns):
    """In either order in memory, ``reach`` scores of a row are no smaller, and few of a long one are."""
    scores = np.random.default_rng(columns).normal(size=(30, columns)).astype(np.float32)
    for reach in (1, 2, 5):
        for x in (scores, np.asfortranarray(scores)):
            above = (x >= v._reached(x, reach)[:, None]).sum(axis=1)
            assert (above >= min(reach, columns)).all() and (columns < 40 or above.mean() < reach + 2)
