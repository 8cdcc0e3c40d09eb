"""Hard negatives by best-first search in STR-packed R-trees.

Components become integers ``floor(256 x)``; a row's score for an anchor is their integer inner product. For each anchor
the best rows of its own label are its positives; for each positive, the best rows of other labels within a window below
the positive's score are its hard negatives.

- **Shards.** Rows are sorted into ranges by label, then components, each of bounded size; a range is one shard. Rows with
  equal label and vector score alike whatever the anchor, so of these only the few with the smallest vec_ids can be
  returned; the others are left out before anything is shuffled further (see :func:`distinguishable`).
- **Tree.** A task packs the rows of its shard by sort-tile-recursive into leaves, and their boxes into a tree. A minimum
  bounding box gives each component an interval, hence bounds of the inner product with an anchor.
- **Search.** A queue holds boxes, largest upper bound first. A box whose interval misses the score window is dropped; the
  search ends when the next upper bound is strictly below the k-th score found (equal scores are ordered by vec_id, so
  boxes at the k-th score are still opened) or below the window. What an anchor has computed serves all its windows.
- **Blocks.** Anchors meet shards in blocks of bounded size, in two rounds: positives in the shards that hold their label,
  negatives in all. A task returns at most k rows for each anchor and window; the best of these are the result, so it is
  exact. Anchors are a stated part of the rows; all rows are searched for each.

Rows: a row with a NULL label or vector, or with NULL or non-finite components takes no part; rows of another vector length
than the anchor's are no candidates for it; rows without a vec_id take part (but are no anchors), last among equal
scores; repeated rows count each, also as anchors; components beyond 2**27 in the integer scale count as that. An anchor
without positives, or a positive without negatives in its window, gives no rows, as does an empty table; further columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import drop_tables, materialize

SCALE, FAR = 256, 1 << 27
POSITIVES, NEGATIVES = 5, 5
#: A window: LOWEST percent of the positive's score to all of it.
LOWEST = 80
#: Rows of a shard and of a block of anchors; rows of a leaf and boxes of a node; anchors whose bounds are worked out at
#: once.
SHARD, ANCHORS, LEAF, FANOUT, AT_ONCE = 16_384, 4_096, 256, 16, 256

#: The vec_id of rows that have none, within tasks; the score of rows that are no candidates, below every window.
NO_ID, NOT_MEANT = (1 << 63) - 1, -(1 << 62)
POSITIVE = "anchor long, window int, vec_id long, score long"


def usable(vector: str = "embedding", label: str = "label") -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & finite, F.lit(False))


def quantized(vector: str = "embedding") -> Column:
    def whole(x: Column) -> Column:
        scaled = F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(FAR))), F.lit(-float(FAR)))
        return F.floor(scaled).cast("int")

    return F.transform(vector, whole)


def distinguishable(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` (vec_id, label, q) without those that no search can return: of rows alike in label and vector, which score
    alike for every anchor and differ in vec_id only, the first ``most`` stay. It takes one more than are returned, since an
    anchor itself is none of its positives."""
    alike = Window.partitionBy("label", "q").orderBy("vec_id")
    return rows.withColumn("nth", F.row_number().over(alike)).filter(F.col("nth") <= most).drop("nth")


def str_packed(points: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Groups of at most ``capacity`` rows of ``points``: sort by a coordinate, cut into tiles, and so on within each tile
    by the next coordinate; coordinates that spread most come first."""
    by_spread = np.argsort(-points.var(axis=0), kind="stable") if points.size else np.zeros(0, np.int64)

    def cut(rows: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        left = len(by_spread) - depth
        if len(rows) <= capacity or not left:
            for k in range(0, len(rows), capacity):
                yield rows[k : k + capacity]
            return
        pages = -(-len(rows) // capacity)
        tiles = max(2, round(pages ** (1 / left)))
        step = capacity * -(-pages // tiles)
        rows = rows[np.argsort(points[rows, by_spread[depth]], kind="stable")]
        for k in range(0, len(rows), step):
            yield from cut(rows[k : k + step], depth + 1)

    return list(cut(np.arange(len(points)), 0))


class Tree:
    """An R-tree over rows of (vec_id, label, vector), kept in the order of the leaves: node 0.. with boxes ``low`` and
    ``high``, children or a range of rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        leaves = str_packed(vectors, LEAF)
        order = np.concatenate(leaves)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        ends = np.cumsum([len(r) for r in leaves])
        self.rows: list[slice | None] = [slice(int(e) - len(r), int(e)) for e, r in zip(ends, leaves, strict=True)]
        self.children: list[np.ndarray | None] = [None] * len(leaves)
        low = [self.vectors[r].min(axis=0) for r in self.rows]
        high = [self.vectors[r].max(axis=0) for r in self.rows]
        level = np.arange(len(leaves))
        while len(level) > 1:
            centres = (np.stack([low[k] for k in level]) + np.stack([high[k] for k in level])) / 2
            groups = [level[g] for g in str_packed(centres, FANOUT)]
            for g in groups:
                self.rows.append(None)
                self.children.append(g)
                low.append(np.min([low[k] for k in g], axis=0))
                high.append(np.max([high[k] for k in g], axis=0))
            level = np.arange(len(low) - len(groups), len(low))
        self.root = int(level[0])
        self.low, self.high = np.stack(low), np.stack(high)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and largest score that each box allows each anchor: (anchor, node)."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def best(
        self, k: int, window: tuple[int, int], least: list, most: list, score: Callable[[int], tuple]
    ) -> list[tuple]:
        """The first ``k`` (score falling, vec_id) of the rows whose scores lie in ``window``. ``score`` gives the scores of
        the rows of a leaf, NOT_MEANT for those that do not qualify, and the largest of them."""
        floor, top = window
        queue, found = [(-most[self.root], self.root)], []
        while queue:
            upper, node = heapq.heappop(queue)
            if -upper < floor:
                break
            if least[node] > top:
                continue
            if self.rows[node] is None:
                for child in self.children[node].tolist():
                    if most[child] >= floor and least[child] <= top:
                        heapq.heappush(queue, (-most[child], child))
                continue
            scores, largest = score(node)
            if largest < floor:
                continue
            near = np.flatnonzero((scores >= floor) & (scores <= top))
            if len(near):
                ids = self.ids[self.rows[node]][near]
                found += zip(scores[near].tolist(), ids.tolist(), strict=True)
                found = sorted(found, key=lambda x: (-x[0], x[1]))[:k]
                if len(found) == k:  # what is strictly below the k-th score is of no use
                    floor = found[-1][0]
        return found


def exact_type(*arrays: np.ndarray) -> type:
    """Doubles where every inner product is exact in them, else 64-bit integers."""
    most = max((int(np.abs(a).max(initial=0)) for a in arrays), default=0)
    return np.float64 if most * most * max(arrays[0].shape[1], 1) < 1 << 53 else np.int64


def searched(same: bool, k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The search of one shard for one block of anchors, as a function of both. Anchors have ``windows``, lists of
    (floor, top); ``same`` says whether rows of the anchor's label are wanted or those of the others."""

    def search(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int]] = []
        if len(anchors) and len(rows):
            sizes = rows["q"].map(len)
            for size, own in rows.groupby(sizes):
                meant = anchors[anchors["q"].map(len) == size]
                if len(meant):
                    search_tree(meant, own, out)
        return pd.DataFrame(out, columns=["anchor", "window", "vec_id", "score"])

    def search_tree(anchors: pd.DataFrame, rows: pd.DataFrame, out: list[tuple[int, int, int, int]]) -> None:
        vectors, points = (np.stack(d["q"].to_numpy()).astype(np.int64) for d in (rows, anchors))
        kind = exact_type(vectors, points)
        tree = Tree(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), vectors.astype(kind))
        for begin in range(0, len(anchors), AT_ONCE):
            part = anchors.iloc[begin : begin + AT_ONCE]
            block = points[begin : begin + AT_ONCE].astype(kind)
            least, most = tree.bounds(block)
            for point, low, high, (uid, own_id, label, windows) in zip(
                block, least.tolist(), most.tolist(),
                part[["anchor", "vec_id", "label", "windows"]].itertuples(index=False, name=None), strict=True,
            ):
                leaf = leaf_scores(tree, point, own_id, label)
                for w, (floor, top) in enumerate(windows):
                    best = tree.best(k, (floor, top), low, high, leaf)
                    out += ((uid, w, vec_id, int(s)) for s, vec_id in best)

    def leaf_scores(tree: Tree, point: np.ndarray, own_id: int, label: int) -> Callable[[int], tuple]:
        known: dict[int, tuple] = {}
        itself = same  # one row that is the anchor itself is to be passed over

        def score(node: int) -> tuple:
            nonlocal itself
            if node not in known:
                at = tree.rows[node]
                scores = tree.vectors[at] @ point
                scores[(tree.labels[at] == label) != same] = NOT_MEANT
                if itself:
                    equal = np.flatnonzero((tree.ids[at] == own_id) & (tree.labels[at] == label))
                    equal = equal[(tree.vectors[at][equal] == point).all(axis=1)]
                    if len(equal):
                        scores[equal[0]], itself = NOT_MEANT, False
                known[node] = scores, scores.max(initial=NOT_MEANT)
            return known[node]

        return score

    return search


def best_rows(anchors: DataFrame, shards: DataFrame, routes: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor, window, vec_id, score, rank) of the best ``k`` rows of ``shards`` (shard, vec_id, label, q) in each window
    of ``anchors`` (anchor, block, vec_id, label, q, windows), which visit the shards that ``routes`` (anchor, shard) names."""
    visiting = anchors.join(routes, "anchor")
    blocks = visiting.select(F.col("shard").alias("s"), F.col("block").alias("b")).distinct()
    visited = shards.join(blocks, F.col("shard") == F.col("s")).select(
        F.col("s").alias("shard"), F.col("b").alias("block"), *(F.col(c).alias(c) for c in ("vec_id", "label", "q"))
    )
    found = visiting.groupBy("shard", "block").cogroup(visited.groupBy("shard", "block")).applyInPandas(
        searched(same, k), POSITIVE
    )
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST
) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score) for the rows of
    ``embeddings`` (vec_id, embedding, label) that are anchors."""
    taken = embeddings.filter(usable()).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col("label").cast("long").alias("label"),
        quantized().alias("q"), F.coalesce(is_anchor & F.col("vec_id").isNotNull(), F.lit(False)).alias("is_anchor"),
    )
    rows = materialize(taken, "quantized")
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    kept = distinguishable(rows.drop("is_anchor"), max(positives + 1, negatives))
    n_shards = max(1, -(-n_rows // SHARD))
    shards = materialize(
        kept.repartitionByRange(n_shards, "label", "q").withColumn("shard", F.spark_partition_id()), "shards"
    )
    block = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-n_anchors // ANCHORS)))).cast("int")
    anchors = materialize(
        rows.filter("is_anchor").withColumn("anchor", F.monotonically_increasing_id()).withColumn("block", block)
        .drop("is_anchor"),
        "anchors",
    )
    everything = F.array(F.array(F.lit(-(1 << 61)), F.lit(1 << 61)))
    held = shards.select("shard", "label").distinct()
    first = materialize(
        best_rows(
            anchors.withColumn("windows", everything), shards, anchors.select("anchor", "label").join(held, "label").drop("label"),
            True, positives,
        ),
        "positives",
    )
    # a window's bounds are whole scores: the least score with 100 * score >= lowest * positive, and the positive's
    scaled = F.lit(lowest) * F.col("score") + 99
    floor = F.call_function("div", scaled - F.pmod(scaled, F.lit(100)), F.lit(100))
    found = first.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", floor.alias("floor"), F.col("score").alias("top")))).alias("ordered")
    ).select("anchor", F.transform("ordered", lambda x: F.array(x["floor"], x["top"])).alias("windows"))
    last_shard = shards.agg(F.max("shard")).first()[0] or 0
    everywhere = found.select("anchor", F.explode(F.sequence(F.lit(0), F.lit(last_shard))).alias("shard"))
    last = best_rows(anchors.join(found, "anchor"), shards, everywhere, False, negatives)
    first = first.select(
        "anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive"), F.col("score").alias("positive_score")
    )
    named = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    ids = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    return last.join(first, ["anchor", "window"]).join(ids, "anchor").select(
        "anchor_id", named("positive").alias("positive_id"), (F.col("window") + 1).alias("positive_rank"), "rank",
        named("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
