"""Whitening against a plain eigenvalue decomposition, and its exact parts."""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from tidegauge.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, n string, component string"


def plain(rows, components=8):
    """(vec_id, component) -> row, by numpy in double precision, and the exact deviations."""
    held = [(i, v) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all()]
    x = np.array([[np.floor(1024 * c) + 100000 for c in v] for _, v in held])
    n, centred = len(x), x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    whole, sums = [[int(c) for c in r] for r in x], [sum(int(r[k]) for r in x) for k in range(x.shape[1])]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in whole]
    return held, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum(), deviations


def check(out, rows, components=8):
    held, want, explained, deviations = plain(rows, components)
    got = {}
    for r in out:
        got.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    assert sorted(got) == list(range(1, want.shape[1] + 1)) and len(out) == len(held) * want.shape[1]
    for k in range(want.shape[1]):
        ids = np.array([-(10**6) if i is None else i for i, _ in held])
        mine = [(-(10**6) if i is None else i, r.whitened) for i, rs in got[k + 1].items() for r in rs]
        both = [sorted(zip(ids.tolist(), (s * want[:, k]).tolist(), strict=True)) for s in (1, -1)]
        assert min(max(abs(a[1] - b[1]) + 1e6 * (a[0] != b[0]) for a, b in zip(sorted(mine), x, strict=True)) for x in both) < 1e-8
    for r in out:
        assert r.n == len(held) and abs(r.explained - explained[r.component - 1]) < 1e-9 and r.identity_error < 1e-9
    by_id = {}
    for (i, _), d in zip(held, deviations, strict=True):
        by_id.setdefault(i, set()).add(d)
    assert all(r.deviation in by_id[r.vec_id] for r in out)


def test_op11_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(queries.op11_whitening(spark, sf).collect(), rows)


def write(spark, path, rows):
    spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3).write.parquet(f"{path}/embeddings.parquet")


def test_odd_rows_repeats_and_few_dimensions(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(70)]
    rows += [rows[3], rows[3], (3, [9.0, 1.0, 0.0, 2.0, -4.0])]
    rows += [(200, None), (201, [None] * 5), (202, [float("nan")] * 5), (203, [float("-inf")] * 5), (None, [0.5] * 5)]
    write(spark, tmp_path, rows)
    check(queries.op11_whitening(spark, str(tmp_path)).collect(), rows)


def test_repeated_and_zero_eigenvalues_lengths_and_far_entries(spark, tmp_path):
    same = [(i, [1.0 if k == i % 3 else 0.0 for k in range(4)]) for i in range(30)]  # two equal eigenvalues, two of zero
    far = [(100, [1e300, 1.0]), (101, [2.0, 1.0]), (102, [0.0, 1.0])]
    write(spark, tmp_path / "a", [*same, *far, (103, []), (104, [7.0] * 3), (105, [7.0] * 3)])
    out = queries.op11_whitening(spark, str(tmp_path / "a")).collect()
    of = lambda ids: [r for r in out if r.vec_id in ids]
    four = of(range(30))
    assert {r.component for r in four} == {1, 2} and {r.explained for r in four} == {0.5} and max(r.identity_error for r in four) < 1e-9
    w = np.array([[r.whitened for r in sorted(four, key=lambda r: r.vec_id) if r.component == k] for k in (1, 2)])
    assert np.abs(w @ w.T / 30 - np.eye(2)).max() < 1e-12
    assert {r.vec_id for r in of({103, 104, 105})} == set()  # no entries, no variance
    x = [[min(max(int(1024 * c) if abs(c) < 1e200 else (1 if c > 0 else -1) << 62, -1 << 62), 1 << 62) for c in v] for _, v in far]
    n, s = 3, [sum(r[k] for r in x) for k in range(2)]
    for (i, _), r in zip(far, x, strict=True):
        exact = sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True))
        got = {(q.deviation, q.deviation_exact) for q in out if q.vec_id == i}
        assert got == {(None, None if exact >= 10**38 else Decimal(exact))}
    write(spark, tmp_path / "b", [])
    assert queries.op11_whitening(spark, str(tmp_path / "b")).collect() == []


def exact_polynomial(m):
    """Faddeev-LeVerrier with fractions."""
    d, a, c, out = len(m), np.zeros((len(m),) * 2, object), Fraction(1), [Fraction(1)]
    for k in range(1, d + 1):
        a = m.dot(a) + np.diag([c] * d)
        c = -Fraction(sum(m.dot(a)[i, i] for i in range(d))) / k
        out.append(c)
    return [int(x) for x in out[::-1]]


@pytest.mark.parametrize("d", [1, 2, 3, 7])
def test_characteristic_polynomial_is_exact(spark, d):
    rng = np.random.default_rng(d)
    b = np.array([[int(v) for v in r] for r in rng.integers(-10**9, 10**9, size=(d + 1, d))], object)
    b[:, 0] = b[:, -1] * 2 if d > 2 else b[:, 0]  # a zero eigenvalue
    m = b.T.dot(b)
    assert whitening.characteristic_polynomial(spark, m) == exact_polynomial(m)


def times(*factors):
    out = [1]
    for root in factors:
        out = [a - root * b for a, b in zip([0, *out], [*out, 0], strict=True)]
    return out


def test_roots_close_repeated_and_zero():
    poly = times(10**12, 10**12 - 1, 7, 7, 7, 3, 0, 0)
    found = whitening.largest_roots(poly, 8)
    assert [(round(r.high / 2**r.s), r.times) for r in found] == [(10**12, 1), (10**12 - 1, 1), (7, 3), (3, 1)]
    assert all(Fraction(r.high - r.low, 1 << r.s) < Fraction(1, 1 << 60) for r in found)
    assert [r.times for r in whitening.largest_roots(poly, 2)] == [1, 1]
    assert whitening.largest_roots([0, 0, 1], 3) == []


def test_sums_are_exact_for_large_entries():
    rng = np.random.default_rng(4)
    x = rng.integers(-(1 << 62), 1 << 62, size=(50, 3))
    want = [[sum(int(r[i]) * int(r[j]) for r in x) for j in range(3)] for i in range(3)]
    assert whitening.exact_products(x).tolist() == want
