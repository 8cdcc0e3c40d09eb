"""Lattice hashing against all pairs."""

from __future__ import annotations

import numpy as np

from tidegauge.llm import lattice, queries


def by_all_pairs(rows):
    ok = {}
    for k, (_, v, label) in enumerate(rows):
        if v is not None and label is not None and None not in v and len(v) and np.isfinite(np.array(v, float)).all() and np.any(v):
            ok[k] = np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    links, top = {k: 0 for k in range(len(rows))}, list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    keys = list(ok)
    for x, i in enumerate(keys):
        for j in keys[:x]:
            if rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.93:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                if rows[a][0] > rows[b][0]:
                    a, b = b, a
                top[b] = a
    return sorted((r[0], links[k], rows[find(k)][0], rows[find(k)][0] == r[0]) for k, r in enumerate(rows))


def result(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def test_op4_query(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert result(queries.op4_embeddings(spark, sf)) == by_all_pairs(rows)


def write(spark, path, rows):
    spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, vec string").repartition(
        3
    ).write.parquet(f"{path}/embeddings.parquet")


def test_crowded_cells_copies_and_odd_vectors(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 9)
    monkeypatch.setattr(lattice, "GROUP", 300)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 16))
    rows = [(i, (base[i % 6] + 0.09 * rng.normal(size=16)).tolist(), i % 2) for i in range(150)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    rows += [(200 + i, rows[0][1], 0) for i in range(40)]
    rows += [
        (300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0), (303, [float("inf")] * 16, 0), (304, [], 0),
        (305, [None, *[1.0] * 15], 0), (306, rows[1][1], None), (307, rows[1][1][:8], 1), (308, rows[1][1][:8], 1),
        (309, [x * 4 for x in rows[1][1]], 1), (310, [-0.0, *[1.0] * 15], 1), (311, [0.0, *[1.0] * 15], 1),
    ]
    write(spark, tmp_path, rows)
    assert result(queries.op4_embeddings(spark, str(tmp_path))) == by_all_pairs(rows)


def test_repeated_and_missing_ids(spark, tmp_path):
    rng = np.random.default_rng(5)
    a, b = ([float(x) for x in np.float32(rng.normal(size=16))] for _ in range(2))
    near = lambda v: [float(x) for x in np.float32(np.array(v) + 0.01 * rng.normal(size=16))]
    twice = [(1, a, 0), (1, b, 0), (2, near(b), 0), (3, near(a), 0), (9, a, 1), (1, a, 1)]
    write(spark, tmp_path / "a", twice)
    assert result(queries.op4_embeddings(spark, str(tmp_path / "a"))) == by_all_pairs(twice)
    assert [(r.n_links, r.component_id) for r in queries.op4_embeddings(spark, str(tmp_path / "a")).collect()] == [(1, 1)] * 6
    none = [(None, a, 0), (None, b, 0), (2, near(b), 0), (3, near(a), 0), (None, a, 1), (None, near(a), 1), (None, None, 0)]
    write(spark, tmp_path / "b", none)
    found = sorted(map(tuple, queries.op4_embeddings(spark, str(tmp_path / "b")).collect()), key=repr)
    assert found == sorted([
        (None, 1, 3, False), (None, 1, 2, False), (2, 1, 2, True), (3, 1, 3, True), (None, 1, None, True),
        (None, 1, None, True), (None, 0, None, True),
    ], key=repr)


def test_empty_table(spark, tmp_path):
    write(spark, tmp_path, [])
    assert queries.op4_embeddings(spark, str(tmp_path)).collect() == []


def test_decoder_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(400, 8)) * 2
    found = lattice.nearest_e8(points)
    around = lattice.neighbours_e8()
    assert around.shape == (240, 8) and np.allclose((around**2).sum(1), 2)
    d = ((points - found) ** 2).sum(1)
    others = ((points[:, None] - found[:, None] - around[None]) ** 2).sum(-1).min(1)
    assert (d <= others + 1e-9).all() and d.max() <= 1 + 1e-9


def test_recall_at_the_threshold():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    n = rng.normal(size=a.shape)
    n -= (n * a).sum(1)[:, None] * a
    n /= np.linalg.norm(n, axis=1)[:, None]
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * n
    x, y = lattice.meeting_keys(a), lattice.meeting_keys(b)
    met = ((x == y[:, :, :1]).any(2) | (y == x[:, :, :1]).any(2)).any(1)
    assert met.mean() >= 0.98
