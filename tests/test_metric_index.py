"""The stored vector index against full scans."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.operators.metric_index import MetricIndex
from tidegauge.operators.vector_index import similarity_search

SCHEMA = "id long, note string, embedding array<float>"


def clustered(n=600, clusters=12, size=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, size))
    return [(i, f"n{i}", [float(x) for x in centres[i % clusters] + 0.05 * rng.normal(size=size)]) for i in range(n)]


def found(df):
    return [(r.id, round(r.score, 7)) for r in df.collect()]


@pytest.fixture
def index(spark, tmp_path):
    rows = clustered()
    odd = [(9001, "none", None), (9002, "zero", [0.0] * 16), (9003, "nan", [float("nan")] * 16)]
    df = spark.createDataFrame(rows + odd, SCHEMA).repartition(3)
    out = MetricIndex(spark, f"{tmp_path}/index")
    out.build(df, F.col("note"))
    return out, rows


def test_search_equals_a_full_scan_and_reads_few_cells(spark, index):
    index, rows = index
    everything = spark.createDataFrame(rows, SCHEMA)
    cells = index.live().select("cell__").distinct().count()
    rng = np.random.default_rng(8)
    for query in [rows[0][2], rows[7][2], rng.normal(size=16).tolist()]:
        for k in (1, 5, 700):
            want = found(similarity_search(everything, query, k, ["id"]))
            assert found(index.search(query, k, ["id"])) == want
    got = index.search(rows[0][2], 5)
    assert got.columns == ["id", "note", "embedding", "score"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell__" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = index.cells_for(rows[0][2], 5)
    assert len(read) < cells / 3  # five of a tight cluster: its cells only


def test_search_within_a_condition_and_without_direction(spark, index):
    index, rows = index
    everything = spark.createDataFrame(rows, SCHEMA).filter("id % 7 = 3")
    want = found(similarity_search(everything, rows[0][2], 4, ["id"]))
    assert found(index.search(rows[0][2], 4, ["id"], within=F.col("id") % 7 == 3)) == want
    assert index.search([0.0] * 16, 4).collect() == []


def test_upsert_replaces_changed_rows_only(spark, index):
    index, rows = index
    changed = [(i, f"new {i}", rows[(i + 1) % 12][2]) for i in range(5)]
    same = rows[20:30]
    fresh = [(7000, "added", rows[3][2])]
    twice = [(7001, "first", rows[1][2]), (7001, "second", rows[2][2])]
    for _ in range(2):
        index.upsert(spark.createDataFrame(changed + same + fresh + twice, SCHEMA), F.col("note"), F.col("note"))
    state = {r.id: r.note for r in index.live().collect()}
    assert len(state) == 602 == index.live().count()
    assert [state[i] for i in range(5)] == [f"new {i}" for i in range(5)] and state[7001] == "second" and state[25] == "n25"
    now = {r[0]: r for r in [*rows, *changed, *fresh, twice[1]]}
    want = found(similarity_search(spark.createDataFrame(list(now.values()), SCHEMA), rows[1][2], 30, ["id"]))
    assert found(index.search(rows[1][2], 30, ["id"])) == want
    # back to an earlier content: the retired row of that content stays retired, the new one counts
    index.upsert(spark.createDataFrame(rows[:1], SCHEMA), F.col("note"), F.col("note"))
    assert [r.note for r in index.live().filter("id = 0").collect()] == ["n0"]
    index.compact()
    assert index.live().count() == 602 and found(index.search(rows[1][2], 9, ["id"])) == found(
        similarity_search(index.live(), rows[1][2], 9, ["id"]))
    assert index._rows().count() == 602


def test_an_upsert_that_died_between_its_writes_is_completed(spark, index, monkeypatch):
    index, rows = index
    changed = spark.createDataFrame([(3, "later", rows[4][2])], SCHEMA)
    add = MetricIndex._add
    monkeypatch.setattr(MetricIndex, "_add", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.upsert(changed, F.col("note"), F.col("note"))
    monkeypatch.setattr(MetricIndex, "_add", add)
    index.upsert(changed, F.col("note"), F.col("note"))
    assert [r.note for r in index.live().filter("id = 3").collect()] == ["later"] and index.live().count() == 600


def test_upsert_builds_what_is_not_there_and_empty_rows_give_an_empty_index(spark, tmp_path):
    index = MetricIndex(spark, f"{tmp_path}/none")
    index.upsert(spark.createDataFrame(clustered(20), SCHEMA), F.col("note"), F.col("note"))
    assert index.live().count() == 20
