"""Hard negatives against all rows, and the tree's parts."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from tidegauge.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label int, shard string, q string, anchor string"


def by_all_rows(rows):
    held = []
    for vec_id, v, label in rows:
        if v is None or label is None or None in v or not np.isfinite(np.array(v, float)).all():
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        held.append((vec_id, [math.floor(256 * x) for x in v], label))
    late = lambda i: (i is None, i or 0)
    out = []
    for k, (a, va, la) in enumerate(held):
        if a is None or a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(va, v, strict=True)), i, label) for n, (i, v, label) in enumerate(held) if n != k and len(v) == len(va)]
        scored.sort(key=lambda x: (-x[0], late(x[1])))
        for ps, p, _ in [x for x in scored if x[2] == la][:5]:
            fit = [(s, i) for s, i, label in scored if label != la and 80 * ps <= 100 * s <= 100 * ps][:5]
            out += [(a, p, r + 1, i, ps, s) for r, (s, i) in enumerate(fit)]
    return sorted(out, key=repr)


def result(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=repr)


def write(spark, path, rows):
    spark.createDataFrame([(*r, "s", "q", "a") for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/embeddings.parquet")


def test_copies_ties_and_odd_rows_over_many_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD", 60)
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    monkeypatch.setattr(negatives, "LEAF", 4)
    monkeypatch.setattr(negatives, "FANOUT", 3)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(5, 4))
    rows = [(i, [float(x) for x in np.round(base[i % 5] + 0.4 * rng.normal(size=4), 1)], i % 3) for i in range(300)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(20)] + [(1100 + i, rows[0][1], 1) for i in range(20)]  # copies
    rows += [rows[100], rows[100], rows[5], (100, rows[7][1], 2)]  # repeated rows; an id with two vectors
    rows += [
        (None, rows[0][1], 0), (None, rows[0][1], 1), (2000, None, 0), (2100, [float("nan")] * 4, 0), (2200, [float("inf")] * 4, 1),
        (2300, [None, 1.0, 1.0, 1.0], 1), (2400, rows[1][1], None), (2500, rows[1][1][:2], 1), (2501, rows[1][1][:2], 1),
        (2502, rows[2][1][:2], 0), (2600, [], 1), (2601, [], 1), (2602, [], 0), (2800, [0.0] * 4, 3), (2801, [0.0] * 4, 3),
        (-100, rows[3][1], 0), (-7, rows[3][1], 1),
    ]
    write(spark, tmp_path, rows)
    want = by_all_rows(rows)
    assert len(want) > 100 and result(queries.op13_hard_negatives(spark, str(tmp_path))) == want


def test_empty_tables_and_anchors_without_negatives(spark, tmp_path):
    write(spark, tmp_path / "a", [])
    assert queries.op13_hard_negatives(spark, str(tmp_path / "a")).collect() == []
    write(spark, tmp_path / "b", [(100, [1.0, 0.0], 1), (101, [1.0, 0.1], 1)])
    assert queries.op13_hard_negatives(spark, str(tmp_path / "b")).collect() == []


def test_the_operator_itself_keeps_the_positive_rank(spark):
    rows = [(i, [1.0, i / 50], i % 2) for i in range(20)]
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    out = negatives.hard_negatives(df, F.col("vec_id") == 4, positives=2, negatives=3, lowest=50).collect()
    assert {(r.anchor_id, r.positive_rank) for r in out} == {(4, 1), (4, 2)} and len(out) == 6


def test_packing_and_bounds():
    rng = np.random.default_rng(1)
    points = rng.integers(-40, 40, size=(700, 6)).astype(np.float64)
    groups = negatives.str_packed(points, 32)
    assert sorted(np.concatenate(groups).tolist()) == list(range(700)) and max(map(len, groups)) <= 32
    tree = negatives.Tree(np.arange(700), np.zeros(700), points)
    anchors = rng.integers(-40, 40, size=(9, 6)).astype(np.float64)
    least, most = tree.bounds(anchors)
    for node, rows in enumerate(tree.rows):
        if rows is not None:
            scores = anchors @ tree.vectors[rows].T
            assert (least[:, node] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, node]).all()
        else:
            inner = tree.children[node]
            assert (tree.low[node] <= tree.low[inner]).all() and (tree.high[node] >= tree.high[inner]).all()
