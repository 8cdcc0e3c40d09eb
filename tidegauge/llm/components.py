"""Connected components of an edge table, without collecting edges or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import drop_tables, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Alternating large-star and small-star steps: each hangs neighbours on the smallest node in sight, so long chains
    shrink quickly and a hub costs one row per neighbour. Each step is a written table; it ends when nothing changes.
    """
    def downward(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = materialize(downward(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = downward(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        roots = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(roots, "u")
        hung = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            roots.select("u", F.col("m").alias("v"))
        )
        last, now = now, materialize(downward(hung), "edges")
        drop_tables(last)
        before, seen = seen, mark(now)
        if seen == before:
            break
    nodes = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    tops = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return nodes.unionByName(tops)
