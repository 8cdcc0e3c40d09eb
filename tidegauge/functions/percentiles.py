"""Exact percentiles of integer columns without gathering the values in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 16  # a 32-bit value has at most 65,536 blocks of at most 65,536 values


def exact_percentiles(df: DataFrame, column: str, named: dict[str, float]) -> DataFrame:
    """One row of linearly interpolated percentiles of an INT column, NULLs ignored.

    Values are first counted (combined before the shuffle), the counts are summed per block of
    neighbouring values, the block holding each wanted rank is found in that small histogram, and only
    those blocks are looked at value by value. Every window below sees at most 2^16 rows, whatever
    the number or skew of the input rows; the built-in ``percentile`` would keep all distinct values
    in one task.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("int").alias("v"))
        .agg(F.count("*").alias("n"))
        # Never NULL, and known to be: both uses below then share one shuffle of the counts.
        .withColumn("block", F.coalesce(F.shiftright("v", BLOCK_BITS), F.lit(0)))
    )
    whole, upto = Window.partitionBy(), Window.orderBy("block")
    blocks = (
        counts.groupBy("block").agg(F.sum("n").alias("m"))
        .withColumn("total", F.sum("m").over(whole))
        .withColumn("after", F.sum("m").over(upto))
        .withColumn("before", F.col("after") - F.col("m"))
    )
    wanted = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                (F.lit(p) * (F.col("total") - 1)).alias("position"),
                side.alias("upper"),
            )
            for name, p in named.items()
            for side in (F.lit(False), F.lit(True))
        ]
    )
    rank = F.when(F.col("upper"), F.ceil("position")).otherwise(F.floor("position"))
    targets = (
        blocks.select("block", "before", "after", F.inline(wanted))
        .withColumn("rank", rank)
        .filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("after")))
        .drop("after")
    )
    running = Window.partitionBy("name", "upper").orderBy("v")
    hits = (
        counts.join(F.broadcast(targets), "block")
        .withColumn("through", F.col("before") + F.sum("n").over(running))
        .filter((F.col("rank") < F.col("through")) & (F.col("rank") >= F.col("through") - F.col("n")))
    )
    at = lambda name, upper: F.max(
        F.when((F.col("name") == name) & (F.col("upper") == upper), F.col("v"))
    )
    share = lambda name: F.max(
        F.when(F.col("name") == name, F.col("position") - F.floor("position"))
    )
    return hits.agg(
        *[
            (at(n, False) + (at(n, True) - at(n, False)) * share(n)).alias(n)
            for n in named
        ]
    )
