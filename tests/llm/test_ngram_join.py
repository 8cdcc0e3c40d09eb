"""The n-gram join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np

from tidegauge.llm import ngram_join, queries
from tidegauge.llm.components import connected_components


def grams(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    return runs or ({tuple(words)} if words else set())


def by_all_pairs(rows, width=3, percent=90):
    sets = [(d, grams(t, width)) for d, t in rows]
    top = {d: d for d, _ in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (d, s) in enumerate(sets):
        for e, o in sets[:i]:
            if s and o and 100 * len(s & o) >= percent * len(s | o):
                a, b = sorted((find(d), find(e)))
                top[b] = a
    return sorted((d, len(s), find(d)) for d, s in sets)


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def near_copies(seed, n, size, edits):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)]
        out.append(" ".join(words))
    return out


def test_classes_equal_all_pairs(spark, tmp_path):
    texts = [None, "", "  \n", "one", "One", "one two", "one  TWO\n", "one two three", "a b a b a b a b", "É b c", "é b c"]
    for k, (n, size, edits) in enumerate([(40, 60, 3), (30, 150, 8), (25, 20, 1), (25, 12, 2), (20, 400, 25), (12, 21, 2)]):
        texts += near_copies(k, n, size, edits)
    texts += ["x " * 50_000, "y z " * 30_000 + "end"] + near_copies(50, 3, 20_000, 400) + texts[11:20]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, component string")
    path = f"{tmp_path}/documents.parquet"
    df.repartition(5).write.parquet(path)
    assert result(queries.op10_ngram_join(spark, str(tmp_path))) == by_all_pairs(rows)


def test_blocks_find_what_stars_miss(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)
    rows = list(enumerate(near_copies(3, 60, 70, 4)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert result(queries.op10_ngram_join(spark, str(tmp_path))) == by_all_pairs(rows)


def test_repeated_rows_and_ids(spark, tmp_path):
    texts = near_copies(8, 12, 80, 3)
    rows = [(i, t) for i, t in enumerate(texts)]
    both = rows + rows[:6] + [(3, "quite another text of four")]
    spark.createDataFrame([*both, (None, texts[0]), (None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {d: top for d, _, top in by_all_pairs(rows)}
    got = [(r.doc_id, r.component_id, r.n_shingles) for r in queries.op10_ngram_join(spark, str(tmp_path)).collect()]
    named = sorted((d, c) for d, c, n in got if d is not None and n > 3)
    assert named == sorted((d, want[d]) for d, t in both if len(grams(t)) > 3)
    assert (3, 3, 3) in got and (None, want[0], len(grams(texts[0]))) in got and (None, None, 0) in got


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op10_ngram_join(spark, str(tmp_path)).collect() == []


def test_op10_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(queries.op10_ngram_join(spark, sf)) == by_all_pairs(rows)


def test_every_linked_pair_of_sets_shares_a_key():
    rng = np.random.default_rng(5)
    for _ in range(1500):
        n = int(rng.integers(1, 300))
        base = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
        most = 2 * n // 19 + 1
        gone, added = int(rng.integers(0, most + 1)), int(rng.integers(0, most + 1))
        other = np.concatenate([base[gone:], rng.integers(0, 2**63, added, dtype=np.uint64)])
        x, y = np.unique(base), np.unique(other)
        common = len(np.intersect1d(x, y))
        if len(y) and 100 * common >= 90 * (len(x) + len(y) - common) and len(x) != common or len(y) != common:
            if 100 * common >= 90 * (len(x) + len(y) - common):
                assert len(np.intersect1d(ngram_join.candidate_keys(x), ngram_join.candidate_keys(y)))


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (300, 1), (1, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in (1, 7, 300, *range(200, 260))}}
