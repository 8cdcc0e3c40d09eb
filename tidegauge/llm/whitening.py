"""Whitening of embeddings by the exact spectrum of their integer scatter.

Entries become integers ``floor(1024 c) + 100000``. Partitions add up counts, sums and products without rounding; the
scatter ``n * sum(x x') - S S'`` (``n`` squared times the covariance) is an integer matrix, and its spectrum is worked out
exactly:

1. **Characteristic polynomial.** Tasks reduce the matrix to Hessenberg form modulo primes of 31 bits, a share of the
   primes each, and read the polynomial off; Chinese remaindering gives its integer coefficients. The number of primes
   follows from a bound of the coefficients, so the result is proven.
2. **Roots.** All roots are real, so the sign changes of the polynomial shifted to a point count the roots above it
   exactly. Bisection isolates the largest roots (of the polynomial without repeated factors) and then narrows them to
   far below their distance.
3. **Components.** Inverse iteration with the matrix less the root, in integers of several hundred bits, gives unit
   vectors of its null space; a repeated root gives as many orthogonal ones.

Rows: a vector that is NULL or holds NULL or non-finite entries is left out; repeated rows count each; entries beyond
2**62 in the integer scale count as that. Vectors of another length have a fit of their own (``size`` tells which). A
component without variance cannot be scaled to one and is not returned, so equal vectors, a single one and empty ones give
no rows. Projections are in double precision: beside entries 2**50 times larger a component loses its digits. An empty
table gives none; further columns are ignored. The driver holds d * d sums for vectors of d entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from math import comb, gcd, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import materialize

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Entries in the integer scale are held within this.
FAR = 1 << 62
#: Rows whose products are added at once: limbs of 20 bits keep sums of products exact in doubles.
LIMB_BITS, ROWS_AT_ONCE = 20, 4096
#: Bits of one row of a partial sum.
PLANE = 30
#: Roots and components are right to so many bits more than a double has.
SPARE_BITS = 96

SUMS = "size int, i int, j int, plane int, value long"


def usable(vector: str = "embedding"):
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False)
    )


def integers(batch: pa.RecordBatch, column: str = "vec") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each vector length in a batch, and their entries in the integer scale, without ``SHIFT``."""
    vectors = batch.column(column)
    sizes = np.diff(np.asarray(vectors.offsets))
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        flat = vectors.take(pa.array(rows)).flatten().to_numpy().astype(np.float64)
        with np.errstate(over="ignore"):
            held = np.clip(np.floor(flat * SCALE), -float(FAR), float(FAR))
        yield rows, held.astype(np.int64).reshape(len(rows), size)


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """``x`` as sum of parts times 2**(20 k); all parts but the last are not negative."""
    out = []
    while len(x) and int(np.abs(x).max()) >= 1 << LIMB_BITS:
        out.append((x & ((1 << LIMB_BITS) - 1)).astype(np.float64))
        x = x >> LIMB_BITS
    return [*out, x.astype(np.float64)]


def exact_products(x: np.ndarray) -> np.ndarray:
    """The sum over rows of x x' as Python integers."""
    parts, out = limbs(x), np.zeros((x.shape[1],) * 2, object)
    for k, a in enumerate(parts):
        for m, b in enumerate(parts):
            out = out + ((a.T @ b).astype(np.int64).astype(object) << LIMB_BITS * (k + m))
    return out


def partial_sums(vectors: DataFrame) -> DataFrame:
    """Count, sums and products of all rows of ``vectors`` (vec) by length, split into planes of ``PLANE`` bits: a task
    gives one row for each, whatever rows it has."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for rows, x in integers(batch):
                size = x.shape[1]
                held = totals.setdefault(size, [0, np.zeros(size, object), np.zeros((size, size), object)])
                for k in range(0, len(rows), ROWS_AT_ONCE):
                    part = x[k : k + ROWS_AT_ONCE]
                    held[0] += len(part)
                    held[1] = held[1] + sum(p.sum(axis=0).astype(np.int64).astype(object) << LIMB_BITS * m
                                            for m, p in enumerate(limbs(part)))
                    held[2] = held[2] + exact_products(part)
        out: list[tuple[int, int, int, int, int]] = []
        for size, (n, sums, products) in totals.items():
            values = [(-1, -1, n), *((i, -1, int(sums[i])) for i in range(size))]
            values += [(i, j, int(products[i, j])) for i in range(size) for j in range(i + 1)]
            for i, j, value in values:
                sign, rest, plane = (1 if value > 0 else -1), abs(value), 0
                while rest:
                    out.append((size, i, j, plane, sign * (rest & ((1 << PLANE) - 1))))
                    rest, plane = rest >> PLANE, plane + 1
        columns = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in columns[:4]), pa.array(columns[4], pa.int64())],
            ["size", "i", "j", "plane", "value"],
        )

    return vectors.mapInArrow(add, SUMS).groupBy("size", "i", "j", "plane").agg(F.sum("value").alias("value"))


def scatters(sums: DataFrame) -> dict[int, tuple[int, list[int], np.ndarray]]:
    """For each vector length the count n, the sums S and the scatter n * products - S S'."""
    found: dict[int, dict[tuple[int, int], int]] = {}
    for r in sums.collect():  # d * d / 2 numbers for each length
        own = found.setdefault(r.size, {})
        own[r.i, r.j] = own.get((r.i, r.j), 0) + (r.value << PLANE * r.plane)
    out = {}
    for size, own in found.items():
        n, s = own[-1, -1], [own.get((i, -1), 0) for i in range(size)]
        m = np.zeros((size, size), object)
        for i in range(size):
            for j in range(i + 1):
                m[i, j] = m[j, i] = n * own.get((i, j), 0) - s[i] * s[j]
        out[size] = (n, s, m)
    return out


# -- characteristic polynomial -------------------------------------------------------------------------------------


def is_prime(n: int) -> bool:
    """For odd n below 2**32: no base of 2, 3, 5 and 7 tells it composite."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2**31 whose product exceeds ``bound``."""
    out, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def coefficient_bound(m: np.ndarray) -> int:
    """No coefficient of the characteristic polynomial of a positive semidefinite matrix is larger: the k-th elementary
    symmetric sum of d numbers is at most C(d, k) times the k-th power of their mean."""
    d, trace = len(m), sum(int(m[i, i]) for i in range(len(m)))
    return max(comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))


def polynomials_mod(m: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Coefficients (lowest first) of the characteristic polynomial modulo each prime, all primes side by side."""
    d, p = len(m), primes.astype(np.int64)
    a = np.stack([(m % int(q)).astype(np.int64) for q in p])
    every, p1, p2 = np.arange(len(p)), p[:, None], p[:, None, None]
    for k in range(1, d - 1):
        some = a[:, k:, k - 1] != 0
        pivot = some.argmax(axis=1) + k
        rows = a[every, pivot].copy()
        a[every, pivot], a[:, k] = a[:, k].copy(), rows
        columns = a[every, :, pivot].copy()
        a[every, :, pivot], a[:, :, k] = a[:, :, k].copy(), columns
        inverse = np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(a[:, k, k - 1], p, strict=True)])
        u = a[:, k + 1 :, k - 1] * inverse[:, None] % p1
        a[:, k + 1 :] = (a[:, k + 1 :] - u[:, :, None] * a[:, k, None, :] % p2) % p2
        a[:, :, k] = (a[:, :, k] + (a[:, :, k + 1 :] * u[:, None, :] % p2).sum(axis=2)) % p1
    polys = np.zeros((d + 1, len(p), d + 1), np.int64)
    polys[0, :, 0] = 1
    for k in range(1, d + 1):
        now = np.zeros((len(p), d + 1), np.int64)
        now[:, 1:] = polys[k - 1, :, :-1]
        now = (now - a[:, k - 1, k - 1, None] * polys[k - 1] % p1) % p1
        chain = np.ones(len(p), np.int64)
        for i in range(k - 1, 0, -1):
            chain = chain * a[:, i, i - 1] % p
            now = (now - (chain * a[:, i - 1, k - 1] % p)[:, None] * polys[i - 1] % p1) % p1
        polys[k] = now
    return polys[d]


def remaindered(residues: np.ndarray, primes: list[int]) -> list[int]:
    """The integers of least size with the given residues (prime, number)."""
    product = 1
    for p in primes:
        product *= p
    out = [0] * residues.shape[1]
    for row, p in zip(residues.tolist(), primes, strict=True):
        rest = product // p
        unit = rest * pow(rest, -1, p)
        out = [(x + r * unit) % product for x, r in zip(out, row, strict=True)]
    return [x - product if 2 * x > product else x for x in out]


def characteristic_polynomial(spark: SparkSession, m: np.ndarray) -> list[int]:
    """Coefficients, lowest first, of det(x - m) for an integer scatter ``m``; the primes are dealt to tasks."""
    d = len(m)
    primes = primes_beyond(2 * coefficient_bound(m))
    entries = [[int(x) for x in row] for row in m]

    def reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix = np.array(entries, object)
        for pdf in frames:
            for k in range(0, len(pdf), max(1, (1 << 20) // (d * d))):
                p = pdf["prime"].to_numpy()[k : k + max(1, (1 << 20) // (d * d))]
                yield pd.DataFrame({"prime": p, "residues": list(polynomials_mod(matrix, p))})

    dealt = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(min(len(primes), 64))
    found = {r.prime: r.residues for r in dealt.mapInPandas(reduce, "prime long, residues array<long>").collect()}
    return remaindered(np.array([found[p] for p in primes], np.int64), primes)


# -- roots ---------------------------------------------------------------------------------------------------------


def gcd_mod(a: list[int], b: list[int], p: int) -> list[int]:
    """The monic greatest common divisor modulo ``p``."""
    def trimmed(x: list[int]) -> list[int]:
        while x and x[-1] == 0:
            x.pop()
        return x

    a, b = trimmed([x % p for x in a]), trimmed([x % p for x in b])
    while b:
        unit = pow(b[-1], -1, p)
        while len(a) >= len(b):
            factor, at = a[-1] * unit % p, len(a) - len(b)
            for k, y in enumerate(b):
                a[at + k] = (a[at + k] - factor * y) % p
            trimmed(a)
        a, b = b, a
    unit = pow(a[-1], -1, p)
    return [x * unit % p for x in a]


def divided(a: list[int], b: list[int]) -> list[int] | None:
    """a / b for a monic ``b``, or None where it leaves a rest."""
    a, out = a[:], [0] * (len(a) - len(b) + 1)
    for at in range(len(out) - 1, -1, -1):
        out[at] = a[at + len(b) - 1]
        for k, y in enumerate(b):
            a[at + k] -= out[at] * y
    return None if any(a) else out


def without_repeats(poly: list[int]) -> list[int]:
    """The monic polynomial with the roots of monic ``poly``, each once. One prime that knows no common factor of the
    polynomial and its derivative proves that there is none; else the factor is put together from many and tried."""
    slope = [k * c for k, c in enumerate(poly)][1:]
    largest = max(abs(c) for c in poly)
    held: list[tuple[int, list[int]]] = []
    for p in primes_beyond(largest * largest << 2 * len(poly)):
        common = gcd_mod(poly, slope, p)
        if len(common) == 1:
            return poly
        if held and len(common) > len(held[0][1]):
            continue
        held = [(q, f) for q, f in held if len(f) == len(common)] + [(p, common)]
    factor = remaindered(np.array([f for _, f in held], np.int64), [p for p, _ in held])
    out = divided(poly, factor)
    assert out is not None, "the common factor does not divide"
    return out


def roots_above(poly: list[int], a: int, s: int) -> int:
    """How many roots of a monic polynomial with real roots lie above a / 2**s, repeated ones repeatedly: the sign
    changes of its coefficients after a shift to that point."""
    d = len(poly) - 1
    c = [x << s * (d - k) for k, x in enumerate(poly)][::-1]
    for upto in range(d, 0, -1):
        for k in range(1, upto + 1):
            c[k] += a * c[k - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def value_sign(poly: list[int], a: int, s: int) -> int:
    """The sign of ``poly`` at a / 2**s."""
    out = 0
    for k, c in enumerate(reversed(poly)):
        out = out * a + (c << s * k)
    return (out > 0) - (out < 0)


@dataclass
class Root:
    """A root in (low, high] / 2**s with ``above`` roots above ``high`` and the given multiplicity in the whole."""

    low: int
    high: int
    s: int
    above: int
    times: int = 1


def largest_roots(poly: list[int], wanted: int) -> list[Root]:
    """The largest positive roots of a monic polynomial whose roots are all real and not negative, until they count
    ``wanted`` with their multiplicities; each narrowed far below its distance from the others."""
    zeros = next(k for k, c in enumerate(poly) if c)
    poly = poly[zeros:]
    if len(poly) == 1:
        return []
    simple = without_repeats(poly)
    top = max(-poly[-2], 1)  # the sum of the roots
    out: list[Root] = []
    todo = [(0, top, 0, len(simple) - 1, 0)]  # low, high, s, roots above low, roots above high
    while todo and sum(r.times for r in out) < wanted:
        low, high, s, n_low, n_high = todo.pop()
        if n_low == n_high:
            continue
        if n_low - n_high == 1:
            times = 1 if simple is poly else roots_above(poly, low, s) - roots_above(poly, high, s)
            out.append(Root(low, high, s, n_high, times))
            continue
        if high - low == 1:
            low, high, s = 2 * low, 2 * high, s + 1
        middle = (low + high) // 2
        n = roots_above(simple, middle, s)
        todo += [(low, middle, s, n_low, n), (middle, high, s, n, n_high)]
    for root in out:
        narrow(simple, root, bits_of_gap(simple, root) + SPARE_BITS)
    return out


def narrow(poly: list[int], root: Root, s: int) -> None:
    """Halve the interval of ``root`` until it is 2**-s wide and a small part of the root."""
    while root.s < s or root.high - root.low > 1 or root.high < 1 << SPARE_BITS:
        if root.high - root.low == 1:
            root.low, root.high, root.s = 2 * root.low, 2 * root.high, root.s + 1
        middle = (root.low + root.high) // 2
        sign = value_sign(poly, middle, root.s)
        if sign == 0 or sign == (-1) ** root.above:
            root.high = middle
        else:
            root.low = middle
        if sign == 0:  # the root itself
            more = max(s - root.s, 0) + SPARE_BITS
            root.high, root.low, root.s = middle << more, (middle << more) - 1, root.s + more
            return


def bits_of_gap(poly: list[int], root: Root) -> int:
    """s such that no other root is within 2**-s of ``root``, which is narrowed to that."""
    s = 0
    while True:
        narrow(poly, root, s)
        at = (root.high << s) >> root.s
        if roots_above(poly, at - 2, s) - roots_above(poly, at + 2, s) == 1:
            return s
        s = 2 * s + 8


# -- components ----------------------------------------------------------------------------------------------------


def null_vectors(m: np.ndarray, root: Root) -> list[list[float]]:
    """Orthogonal unit vectors of the null space of m - root, as many as the root has multiplicities."""
    d = len(m)
    largest = max(max(abs(int(x)) for x in m.ravel()), 1)
    bits = root.s + largest.bit_length() + 2 * SPARE_BITS
    a = m * (1 << bits)
    value = root.high << (bits - root.s)
    for i in range(d):
        a[i, i] -= value
    a, order, factors = a.copy(), list(range(d)), np.zeros((d, d), object)
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(a[i, k]))
        if best != k:
            a[[k, best]], factors[[k, best]] = a[[best, k]], factors[[best, k]]
            order[k], order[best] = order[best], order[k]
        if a[k, k] == 0:
            a[k, k] = 1
        if k + 1 < d:
            factors[k + 1 :, k] = np.array([(int(x) << bits) // int(a[k, k]) for x in a[k + 1 :, k]], object)
            a[k + 1 :, k:] = a[k + 1 :, k:] - (np.outer(factors[k + 1 :, k], a[k, k:]) >> bits)

    def solved(b: list[int]) -> list[int]:
        y = [b[i] for i in order]
        for i in range(d):
            y[i] -= sum(int(f) * v for f, v in zip(factors[i, :i], y[:i], strict=True)) >> bits
        for i in range(d - 1, -1, -1):
            rest = (y[i] << bits) - sum(int(u) * v for u, v in zip(a[i, i + 1 :], y[i + 1 :], strict=True))
            y[i] = rest // int(a[i, i])
        return y

    def unit(v: list[int], others: list[list[int]]) -> list[int]:
        for _ in range(2):
            for o in others:
                along = sum(x * y for x, y in zip(v, o, strict=True)) >> bits
                v = [x - (along * y >> bits) for x, y in zip(v, o, strict=True)]
            length = max(isqrt(sum(x * x for x in v)), 1)
            v = [(x << bits) // length for x in v]
        return v

    found: list[list[int]] = []
    for start in range(root.times):
        v = [(1 << bits) // (1 + (7 * i + 3 * start) % d) for i in range(d)]
        v[start % d] += 1 << bits
        for _ in range(3):
            v = unit(solved(unit(v, found)), found)
        if v[max(range(d), key=lambda i: abs(v[i]))] < 0:
            v = [-x for x in v]
        found.append(v)
    return [[x / (1 << bits) for x in v] for v in found]


@dataclass
class Fit:
    """What whitening vectors of one length takes: components (one a row) already divided by the root of their scatter,
    and their shares of the whole variance."""

    n: int
    sums: list[int]
    scaled: np.ndarray
    explained: list[float]


def fitted(spark: SparkSession, n: int, sums: list[int], m: np.ndarray, components: int = COMPONENTS) -> Fit:
    d, content = len(m), 0
    for x in m.ravel().tolist():
        content = gcd(content, x)
    scaled, explained = np.zeros((0, d)), []
    if content:
        m = m // content
        trace = sum(int(m[i, i]) for i in range(d))
        for root in largest_roots(characteristic_polynomial(spark, m), components):
            share = root.high / (trace << root.s)
            size = root_of(root.high * content, root.s)
            for v in null_vectors(m, root):
                scaled = np.vstack([scaled, np.array(v) / size])
                explained.append(share)
    return Fit(n, sums, scaled[:components], explained[:components])


def root_of(a: int, s: int) -> float:
    """The square root of a / 2**s."""
    more = max(128 - a.bit_length(), 0)
    more += (s + more) % 2
    return isqrt(a << more) / (1 << (s + more) // 2)


def whitened_rows(vectors: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """(vec_id, size, n, deviation, whitened) of ``vectors`` (vec_id, vec)."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integers(batch):
                fit = fits[x.shape[1]]
                if not len(fit.scaled):
                    continue
                most = max((abs(s) for s in fit.sums), default=0) + fit.n * int(np.abs(x).max(initial=0))
                if most < 1 << 62:
                    off = fit.n * x - np.array(fit.sums, np.int64)
                else:
                    off = fit.n * x.astype(object) - np.array(fit.sums, object)
                values = off.astype(np.float64) @ fit.scaled.T
                k = len(fit.scaled)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(np.full(len(rows), x.shape[1], np.int32)),
                     pa.array(np.full(len(rows), fit.n, np.int64)), exact_squares(off),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * k), pa.array(values.ravel()))],
                    ["vec_id", "size", "n", "deviation", "whitened"],
                )

    shape = f"vec_id {kind}, size int, n long, deviation decimal(38,0), whitened array<double>"
    return vectors.select("vec_id", "vec").mapInArrow(project, shape)


def exact_squares(off: np.ndarray) -> pa.Array:
    """The sum of squares of each row, exact; NULL beyond 38 digits."""
    most = int(np.abs(off).max(initial=0))
    if most * most * off.shape[1] < 1 << 63:
        return pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
    if most < 1 << 52:
        high, low = off >> 26, off & ((1 << 26) - 1)
        parts = [(a * b).sum(axis=1).astype(object) for a, b in ((high, high), (high, low), (low, low))]
        total = (parts[0] << 52) + (parts[1] << 27) + parts[2]
    else:
        whole = off.astype(object)
        total = (whole * whole).sum(axis=1)
    return pa.array([Decimal(int(t)) if t < 10**38 else None for t in total], pa.decimal128(38, 0))


def identity_error(rows: DataFrame, components: int = COMPONENTS) -> float:
    """The largest entry, in size, of the covariance of ``whitened`` less the identity, over all rows."""
    at = lambda k: F.get("whitened", F.lit(k))
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    seen = rows.groupBy("size").agg(*(F.covar_pop(at(i), at(j)).alias(f"c_{i}_{j}") for i, j in pairs)).collect()
    errors = [abs(r[f"c_{i}_{j}"] - (i == j)) for r in seen for i, j in pairs if r[f"c_{i}_{j}"] is not None]
    return max(errors, default=0.0)


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, size, component, n, deviation, whitened, explained, identity_error) of ``embeddings`` (vec_id,
    embedding): a row for each vector and component. ``deviation`` is a decimal(38,0)."""
    spark = embeddings.sparkSession
    vectors = embeddings.filter(usable() & (F.size("embedding") > 0)).select("vec_id", F.col("embedding").alias("vec"))
    fits = {
        size: fitted(spark, n, sums, m, components)
        for size, (n, sums, m) in sorted(scatters(partial_sums(vectors.select("vec"))).items())
    }
    rows = materialize(whitened_rows(vectors, fits), "whitened")
    error = identity_error(rows, components)
    shares = F.create_map(*(F.lit(x) for size, fit in fits.items() for x in (size, fit.explained or [0.0]))) if fits else \
        F.lit(None).cast("map<int,array<double>>")
    return rows.select(
        "vec_id", "size", "n", "deviation", F.posexplode("whitened").alias("k", "whitened")
    ).select(
        "vec_id", "size", (F.col("k") + 1).alias("component"), "n", "deviation", "whitened",
        F.get(shares[F.col("size")], F.col("k")).alias("explained"), F.lit(error).alias("identity_error"),
    )
