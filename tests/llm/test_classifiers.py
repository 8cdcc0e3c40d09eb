"""Language and quality: held-out accuracy, folds, plain versions of the parts, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegauge.llm import langid, quality, queries

ODD = [None, "", " \n", "123 !!", "a", "日本", "x" * 300_000, "word " * 60_000, "The the THE", "\x00"]


def folds(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_op3_query(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op3_language(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (folds(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.93 * len(held)
    train = [r for r in docs.values() if folds(r.doc_id, 3) != 1]
    contents = langid.dictionaries(spark.createDataFrame(train).select("text", "lang"))
    model = langid.Classifier(contents)
    for r in got[:40]:
        assert (r.lang_pred, r.rejected) == (model.judge(docs[r.doc_id].text)[0], model.judge(docs[r.doc_id].text)[3])


def test_language_of_odd_rows(spark, tmp_path):
    rows = [(i, t, "l", "x") for i, t in enumerate(ODD)]
    rows += [(100 + i, f"the cat and the dog number {i} went home", "en", "x") for i in range(12)]
    rows += [(200 + i, f"le chat et le chien ont mangé {i} pommes", "fr", "x") for i in range(12)] + [(300, "nobody", None, "x"), (None, "le chien", "fr", "x")]
    write = lambda r, p: spark.createDataFrame(r, "doc_id long, text string, lang string, score string").write.parquet(f"{tmp_path}/{p}/documents.parquet")
    write(rows, "a")
    got = {r.doc_id: r for r in queries.op3_language(spark, f"{tmp_path}/a").collect()}
    assert len(got) == len(rows)
    for i in (0, 1, 2, 3, 9):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert all(got[i].lang_pred == "en" for i in range(100, 112)) and all(got[i].lang_pred == "fr" for i in range(200, 212))
    write([(1, "some text", None, "x")], "b")
    assert queries.op3_language(spark, f"{tmp_path}/b").first().lang_pred == "und"
    write([], "c")
    assert queries.op3_language(spark, f"{tmp_path}/c").collect() == []


def test_op6_query(spark):
    sf = "/root/testdata/sf0.01"  # enough labels to measure held-out accuracy
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op6_quality(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (folds(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.93 * len(held)


def test_quality_of_odd_rows(spark, tmp_path):
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(None, "a b", "s"), (7, "again", "s")]
    rows += [(100 + i, f"good text with words {i}, and more of them.", "s") for i in range(30)] + [(200 + i, "BAD!! " * (i + 3), "s") for i in range(30)]
    marks = [(d, int(d < 200), 0) for d, *_ in rows if d is not None and d >= 100] + [(999, 1, 0), (101, None, 0)]
    docs, labels = "doc_id long, text string, score string", "doc_id long, quality int, toxic int"
    for name, r, m in (("a", rows, marks), ("b", rows, []), ("c", [], marks)):
        spark.createDataFrame(r, docs).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(m, labels).write.parquet(f"{tmp_path}/{name}/labels.parquet")
    got = queries.op6_quality(spark, f"{tmp_path}/a").collect()
    assert len(got) == len(rows)
    assert all(r.predicted == int(r.doc_id < 200) for r in got if r.doc_id is not None and r.doc_id >= 100)
    assert {r.score for r in queries.op6_quality(spark, f"{tmp_path}/b").collect()} == {0.5}
    assert queries.op6_quality(spark, f"{tmp_path}/c").collect() == []


def test_normal_equations_equal_a_direct_fit(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(200, quality.N_STATISTICS)), rng.integers(0, 2, 200).astype(float)
    features = quality.Features(x.mean(0), x.std(0))
    rows = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y, strict=True)], "stats array<double>, label double")
    products, target = quality.normal_equations(rows.repartition(5), features, 0.4)
    p = features(x)
    assert np.allclose(products, p.T @ p) and np.allclose(target, p.T @ (y - 0.4))


def test_random_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, quality.N_STATISTICS))
    features = quality.Features(np.zeros(quality.N_STATISTICS), np.ones(quality.N_STATISTICS))
    p = features(x)
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality.WIDTH**2))
    assert np.abs(p @ p.T - want).mean() < 0.06


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(1, 5)), min_size=1, max_size=12))
def test_isotonic_is_the_best_monotone_fit(points):
    y, w = np.array([p[0] for p in points], float), np.array([p[1] for p in points], float)
    x = np.arange(len(y), dtype=float)
    _, values = quality.isotonic(x, y, w)
    assert (np.diff(values) >= 0).all()
    # min-max formula of isotonic regression
    mean = lambda a, b: np.average(y[a : b + 1], weights=w[a : b + 1])
    want = [max(min(mean(a, b) for b in range(i, len(y))) for a in range(i + 1)) for i in range(len(y))]
    assert np.allclose(sorted(set(np.round(want, 9))), np.unique(np.round(values, 9)))
