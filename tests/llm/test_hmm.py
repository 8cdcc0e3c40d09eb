"""The hidden Markov model against plain versions."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np

from tidegauge.llm import hmm, queries


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["<end>"]


def trains(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 != 1


def check_base(got, rows):
    c = Counter(("end",) if i == len(tk) - 1 else w for d, t in rows if trains(d) for tk in [tokens(t)] for i, w in enumerate(tk))
    n, v = sum(c.values()), len(c)
    logp = lambda w: math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1)))
    want = []
    for d, t in rows:
        seq = [*tokens(t)[:-1], ("end",)]
        want.append((d, not trains(d), len(seq), sum(c[w] > 0 for w in seq), n, round(sum(map(logp, seq)), 6)))
    have = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    order = lambda x: [repr(v) for v in x]
    for a, b in zip(sorted(have, key=order), sorted(want, key=order), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-5), (a, b)


def test_op5_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = queries.op5_language_model(spark, sf).collect()
    check_base(got, rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the states predict better than single words


def test_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(hmm, "SYMBOLS", 6)
    monkeypatch.setattr(hmm, "FREQUENT", 12)
    rows = [
        (0, None), (1, ""), (2, " \n\t"), (3, "One one ONE"), (4, "É é x1 , ..."), (5, "long " * 30_000), (6, "\x1ca b c\x0bd"),
        (3, "One one ONE"), (None, "no id"), *[(i, f"the cat {i} sat on the mat {i % 3}") for i in range(10, 60)],
    ]
    write = lambda r, p: spark.createDataFrame([(*x, "y") for x in r], "doc_id long, text string, score string").repartition(3).write.parquet(f"{tmp_path}/{p}/documents.parquet")
    write(rows, "a")
    got = queries.op5_language_model(spark, f"{tmp_path}/a").collect()
    check_base(got, rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    write([], "b")
    assert queries.op5_language_model(spark, f"{tmp_path}/b").collect() == []
    lone = next(i for i in range(100) if not trains(i))
    write([(lone, "nothing to learn from")], "c")
    assert math.isfinite(queries.op5_language_model(spark, f"{tmp_path}/c").first().score)


def test_every_training_text_is_learned_from(spark, monkeypatch):
    """The last estimate rests on the tokens of all texts, whatever their number."""
    seen = []
    real = hmm.expected_counts
    monkeypatch.setattr(hmm, "expected_counts", lambda docs, *a: seen.append((docs.count(), real(docs, *a))) or seen[-1][1])
    texts = spark.createDataFrame([(f"word{i % 50} of text {i}",) for i in range(3_000)] + [(None,)], "text string")
    reader = hmm.Reader(hmm.Vocabulary(hmm.word_counts(texts).cache(), 3_001))
    hmm.train(texts, reader)
    assert len(seen) == hmm.SWEEPS * hmm.PARTS
    last = seen[-hmm.PARTS:]
    assert sum(n for n, _ in last) == 3_001
    k = hmm.STATES
    assert math.isclose(sum(c[k + k * k:].sum() for _, c in last), 3_000 * 4 + 3_001, rel_tol=1e-9)


def test_short_texts_leave_checkpoints_by_their_tokens(monkeypatch):
    m, lengths = small_model(), np.array([4] * 50 + [9])
    flat = np.random.default_rng(4).integers(0, 5, lengths.sum()).astype(np.int32)
    want = hmm.Batch(flat, lengths).expected(m)
    monkeypatch.setattr(hmm, "SEGMENT_TOKENS", 60)
    batch = hmm.Batch(flat, lengths)
    assert batch.segments() == [0, 1, 2, 3, 9]
    for a, b in zip(batch.expected(m), want, strict=True):
        assert np.allclose(a, b)


def small_model(symbols=5):
    rng = np.random.default_rng(1)
    return hmm.Model.estimated(rng.random(3), rng.random((3, 3)), rng.random((symbols, 3)))


def likelihood(m, seq):
    """Sum over all state paths."""
    total = 0.0
    for path in itertools.product(range(3), repeat=len(seq)):
        p = m.start[path[0]] * m.emit[seq[0], path[0]]
        for t in range(1, len(seq)):
            p *= m.move[path[t - 1], path[t]] * m.emit[seq[t], path[t]]
        total += p
    return total


def test_forward_is_the_sum_over_all_paths():
    m, seqs = small_model(), [[0], [1, 2], [4, 4, 0, 1, 2], [3, 3, 3], [2, 0, 1, 4, 3, 0]]
    flat = np.array([s for q in seqs for s in q], np.int32)
    got = hmm.Batch(flat, np.array([len(q) for q in seqs])).log_likelihood(m)
    assert np.allclose(got, [math.log(likelihood(m, q)) for q in seqs])


def test_expected_counts_equal_the_sum_over_all_paths(monkeypatch):
    m, seqs = small_model(), [[1, 2], [4, 4, 0, 1, 2], [3], [2, 0, 1, 4, 3, 0]]
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for seq in seqs:
        whole = likelihood(m, seq)
        for path in itertools.product(range(3), repeat=len(seq)):
            p = m.start[path[0]] * m.emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= m.move[path[t - 1], path[t]] * m.emit[seq[t], path[t]]
            p /= whole
            start[path[0]] += p
            for t, s in enumerate(seq):
                emit[s, path[t]] += p
                if t:
                    move[path[t - 1], path[t]] += p
    flat, lengths = np.array([s for q in seqs for s in q], np.int32), np.array([len(q) for q in seqs])
    for segment in (1, 2, 4, 100):
        monkeypatch.setattr(hmm, "SEGMENT", segment)
        for got, want in zip(hmm.Batch(flat, lengths).expected(m), (start, move, emit), strict=True):
            assert np.allclose(got, want)


def test_classes_agree_in_both_languages(spark):
    words = ["a", "abc", "x1", "é", "日本語", "word,", "a" * 30, "…", "ab9"]
    got = {r.w: r.k for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", hmm.word_class(hmm.F.col("w")).alias("k")).collect()}
    assert got == {w: hmm.class_of(w) for w in words}
