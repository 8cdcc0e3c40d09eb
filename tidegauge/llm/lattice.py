"""Near-duplicate embeddings by lattice hashing.

Each table projects a unit vector on eight random directions and decodes the point to the nearest point of the E8
lattice: its cell. A vector also visits the neighbouring cells nearest to its point. Vectors of one label that meet in a
cell (one at home, the other at home or visiting) are compared by cosine in double precision. With the parameters below
99.4 % of pairs at cosine 0.93 meet, and more at higher cosines (measured; see the tests).

Exact copies are one vector with a weight. Cells are cut into blocks of bounded size, and blocks return one row per
vector, so a crowded cell neither lands in one task nor gives a row per pair. A pair that meets several times is counted
at its first meeting only, which both vectors' cells tell.

Rows: vectors that are NULL, zero, or hold NULL or non-finite components, and rows without a label, link with nothing;
vectors of different lengths never link; repeated rows count each; rows of one vec_id with different vectors are judged
each by its own; rows without a vec_id take part, and their component is the smallest vec_id in it, or NULL where none of
its rows has one; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import materialize
from tidegauge.llm.components import connected_components

COSINE = 0.93
TABLES, PROBES = 4, 8
#: Edge of a cell in the projected space; the projections have unit variance.
CELL = 1.3
SEED = 41
#: Members of a block, meetings that one group of blocks holds, and pairs compared at once.
BLOCK, GROUP, PAIRS_AT_ONCE = 1_000, 20_000, 40_000


def nearest_d8(points: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd round the worst coordinate the other way."""
    near = np.rint(points)
    odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
    off = (points - near)[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the integer points with an even sum and those moved by one half in every coordinate."""
    whole, half = nearest_d8(points), nearest_d8(points - 0.5) + 0.5
    closer = ((points - half) ** 2).sum(axis=1) < ((points - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def neighbours_e8() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def cell_keys(cells: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit key of lattice points (last axis)."""
    key = np.full(cells.shape[:-1], table + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(8):
            part = np.rint(cells[..., k] * 2).astype(np.int64).astype(np.uint64)
            key = (key ^ part) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    return key.view(np.int64)


def meeting_keys(vectors: np.ndarray, tables: int = TABLES, probes: int = PROBES, cell: float = CELL) -> np.ndarray:
    """Keys of each vector's cells: (vector, table, 1 + probes), the home cell first."""
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    around = neighbours_e8()
    out = np.zeros((len(vectors), tables, 1 + probes), np.int64)
    for t in range(tables):
        points = unit @ np.random.default_rng((SEED, t, vectors.shape[1])).normal(size=(vectors.shape[1], 8)) / cell
        home = nearest_e8(points)
        best = np.argsort(-((points - home) @ around.T), axis=1, kind="stable")[:, :probes]
        cells = np.concatenate([home[:, None, :], home[:, None, :] + around[best]], axis=1)
        out[:, t] = cell_keys(cells, t)
    return out


def valid(vector: str = "embedding", label: str = "label"):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(
        F.col(label).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def meetings(reps: DataFrame) -> DataFrame:
    """(rep, place, key): every cell of every vector; at ``place`` 0 of a table it is at home."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vec")
            sizes = np.diff(np.asarray(vectors.offsets))
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                picked = vectors.take(pa.array(rows)).flatten().to_numpy().astype(np.float64)
                found = meeting_keys(picked.reshape(len(rows), size))
                each = found.shape[1] * found.shape[2]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").take(pa.array(np.repeat(rows, each))),
                     pa.array(np.tile(np.arange(each, dtype=np.int32), len(rows))), pa.array(found.ravel())],
                    ["rep", "place", "key"],
                )

    cells = reps.select("rep", "vec").mapInArrow(keys, "rep long, place int, key long").withColumn(
        "table", F.floor(F.col("place") / (1 + PROBES)).cast("int")
    ).withColumn("home", F.col("place") % (1 + PROBES) == 0)
    own = reps.select("rep", "label", F.size("vec").alias("size"))
    # only equal labels and lengths meet
    return cells.join(own, "rep").withColumn("cell", F.xxhash64("key", "label", "size")).drop("place", "size", "label")


def blocks_of(met: DataFrame) -> DataFrame:
    """The meetings in cells that matter, dealt to blocks (cell, i, j) of two chunks of the cell's members."""
    counts = met.groupBy("cell").agg(F.count("*").alias("n"), F.max("home").alias("any_home")).filter("any_home AND n > 1")
    chunked = met.join(counts.select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks")), "cell")
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    return chunked.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "cell", "key", "table", "home", "rep", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )


def compare(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of the vectors of whole blocks: (rep, links, root).

    ``links`` counts the rows linked with the vector in pairs that meet here first; ``root`` is the smallest vector
    connected with it within these blocks."""
    pdf = pdf.assign(side=(pdf["own"] != pdf["i"]).astype(int))
    pdf = pdf.sort_values(["cell", "i", "j", "side", "rep"], ignore_index=True)
    reps, row = np.unique(pdf["rep"].to_numpy(), return_inverse=True)
    first = np.zeros(len(reps), np.int64)
    first[row[::-1]] = np.arange(len(pdf))[::-1]
    vec, copies = pdf["vec"].to_numpy()[first], pdf["copies"].to_numpy()[first]
    home, table, key = (pdf[c].to_numpy() for c in ("home", "table", "key"))
    starts = np.flatnonzero((pdf[["cell", "i", "j"]] != pdf[["cell", "i", "j"]].shift()).any(axis=1).to_numpy())
    stops = np.append(starts[1:], len(pdf))
    group = np.repeat(np.arange(len(starts)), stops - starts)
    inner = (pdf["i"] == pdf["j"]).to_numpy()
    side = pdf["side"].to_numpy()
    second = stops - np.add.reduceat(side, starts)
    low = np.where(inner, np.arange(len(pdf)) + 1, second[group])
    high = np.where(inner | (side == 0), stops[group], low)
    width = np.maximum(high - low, 0)
    links = np.zeros(len(reps), np.int64)
    edges: list[np.ndarray] = []
    sizes = np.array([len(v) for v in vec])
    units, cells = [None] * len(reps), [None] * len(reps)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        v = np.stack([np.asarray(x, np.float64) for x in vec[at]])
        for k, u, m in zip(at.tolist(), v / np.linalg.norm(v, axis=1)[:, None], meeting_keys(v), strict=True):
            units[k], cells[k] = u, m
    ends = np.cumsum(width)
    begin = 0
    while begin < len(pdf):
        upto = max(int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS_AT_ONCE, "right")), begin + 1)
        n = width[begin:upto]
        p = np.repeat(np.arange(begin, upto), n)
        q = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[begin:upto], n)
        begin = upto
        use = (home[p] | home[q]) & (row[p] != row[q]) & (sizes[row[p]] == sizes[row[q]])
        p, q = p[use], q[use]
        if not len(p):
            continue
        a, b = row[p], row[q]
        near = np.fromiter((units[x] @ units[y] for x, y in zip(a, b, strict=True)), np.float64, len(a)) if len(set(sizes)) > 1 \
            else np.einsum("ij,ij->i", np.stack(units)[a], np.stack(units)[b])
        linked = near >= COSINE
        p, a, b = p[linked], a[linked], b[linked]
        if not len(a):
            continue
        edges.append(np.stack([a, b], axis=1))
        once = np.ones(len(a), bool)
        for k in range(0, len(a), PAIRS_AT_ONCE):
            part = slice(k, k + PAIRS_AT_ONCE)
            once[part] = first_meeting(
                np.stack([cells[x] for x in a[part]]), np.stack([cells[x] for x in b[part]]), table[p[part]], key[p[part]]
            )
        np.add.at(links, a[once], copies[b[once]])
        np.add.at(links, b[once], copies[a[once]])
    root = np.arange(len(reps))
    if edges:
        pairs, last = np.concatenate(edges), None
        while last is None or (root != last).any():
            last = root.copy()
            least = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
            np.minimum.at(root, pairs[:, 0], least)
            np.minimum.at(root, pairs[:, 1], least)
            root = root[root]
    told = (links > 0) | (root != np.arange(len(reps)))
    return pd.DataFrame({"rep": reps[told], "links": links[told], "root": reps[root[told]]})


def first_meeting(a: np.ndarray, b: np.ndarray, table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the pairs with cells ``a`` and ``b`` meet at (table, key) first, in order of table, then key."""
    at_b, at_a = (a == b[:, :, :1]).any(axis=2), (b == a[:, :, :1]).any(axis=2)
    none = np.iinfo(np.int64).max
    where = np.minimum(np.where(at_b, b[:, :, 0], none), np.where(at_a, a[:, :, 0], none))
    met = at_a | at_b
    earliest = met.argmax(axis=1)
    return (earliest == table) & (where[np.arange(len(a)), earliest] == key)


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``embeddings`` (vec_id, embedding, label)."""
    rows = embeddings.select("vec_id", "label", F.col("embedding").alias("vec"), valid().alias("usable"))
    usable = rows.filter("usable")
    # a vector is known by a number of its own: neither its vec_id nor any of its rows need be unique
    alike = usable.groupBy("label", "vec").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    reps = materialize(alike.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    met = materialize(meetings(reps), "meetings")
    homes = met.filter("home").select("cell").distinct()
    blocks = blocks_of(met.join(homes, "cell", "left_semi"))
    held = blocks.join(reps.select("rep", "vec", "copies"), "rep")
    groups = max(1, met.count() // GROUP)
    found = materialize(
        held.withColumn("group", F.pmod(F.xxhash64("cell", "i", "j"), F.lit(groups)))
        .groupBy("group").applyInPandas(compare, "rep long, links long, root long"),
        "links",
    )
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = connected_components(found.filter("rep <> root"), "rep", "root").withColumnRenamed("node", "rep")
    top = classes.join(reps.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("top"))
    tops = classes.join(top, "component").select("rep", "top")
    known = reps.join(links, "rep", "left").join(tops, "rep", "left").select(
        F.col("label").alias("l"), F.col("vec").alias("v"), F.lit(True).alias("known"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("top", "least").alias("component_id"),
    )
    joined = rows.join(known, F.col("usable") & (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v")), "left")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("known"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
