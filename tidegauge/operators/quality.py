"""The pass/quarantine split, expectations, and the conservation check over the layers."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalars import count_when
from tidegauge.operators.parse import parse_events

# Which events pass.
WIKI = "enwiki"
EDIT_TYPES = ("edit", "new")
ARTICLE_NAMESPACE = 0


def passes(
    wiki: str = WIKI, types: tuple[str, ...] = EDIT_TYPES, namespace: int = ARTICLE_NAMESPACE
) -> Column:
    """Human edits and new pages of one wiki and namespace. NULL fields make this NULL, not false."""
    return (
        ~F.col("bot")
        & (F.col("wiki") == wiki)
        & F.col("event_type").isin(*types)
        & (F.col("namespace") == namespace)
    )


def quarantine_reason(
    wiki: str = WIKI, types: tuple[str, ...] = EDIT_TYPES, namespace: int = ARTICLE_NAMESPACE
) -> Column:
    """The first rule a rejected row breaks, most specific first; ``unknown`` when none explains it."""
    unlike = lambda name, ok: F.col(name).isNull() | ~ok
    rules = [
        ("parse_failure", F.col("event_id").isNull()),
        ("bot", F.col("bot").eqNullSafe(True)),
        ("non_enwiki", unlike("wiki", F.col("wiki") == wiki)),
        ("non_edit_type", unlike("event_type", F.col("event_type").isin(*types))),
        ("non_article_namespace", unlike("namespace", F.col("namespace") == namespace)),
    ]
    return reduce(
        lambda rest, rule: F.when(rule[1], rule[0]).otherwise(rest), reversed(rules), F.lit("unknown")
    )


def accepted(parsed: DataFrame, **rule) -> DataFrame:
    """Rows that pass."""
    return parsed.filter(passes(**rule))


def rejected(parsed: DataFrame, **rule) -> DataFrame:
    """The exact complement of :func:`accepted`, each row with its reason; NULL counts as not passing."""
    return parsed.filter(~F.coalesce(passes(**rule), F.lit(False))).withColumn(
        "quarantine_reason", quarantine_reason(**rule)
    )


def clean(parsed: DataFrame, **rule) -> DataFrame:
    """Batch silver: accepted rows, one per event_id (NULL ids count as one), with their event date.

    The batch de-duplication is an aggregate, so copies collapse before the shuffle and an id that
    holds a large share of the rows costs one row per task.
    """
    return accepted(parsed, **rule).dropDuplicates(["event_id"]).transform(with_event_date)


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.col("event_timestamp").cast("date"))


@dataclass(frozen=True)
class Expectation:
    """A named row condition. ``hard`` ones drop the rows that do not meet it."""

    name: str
    condition: str
    hard: bool = False

    @property
    def kind(self) -> str:
        return "drop" if self.hard else "warn"

    def met(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


# The expectations on silver.
SILVER_EXPECTATIONS = (
    Expectation("title_not_null", "title IS NOT NULL", hard=True),
    Expectation("user_not_null", "user IS NOT NULL", hard=True),
    Expectation(
        "byte_delta_plausible", "byte_delta IS NULL OR byte_delta BETWEEN -10000000 AND 10000000"
    ),
)


def expectation_counters(expectations) -> list[Column]:
    """Pass and fail counters, one pair per expectation, in one row."""
    counters = []
    for e in expectations:
        counters += [
            count_when(e.met()).alias(f"{e.name}__passed"),
            count_when(~e.met()).alias(f"{e.name}__failed"),
        ]
    return counters


def enforce(df: DataFrame, expectations=SILVER_EXPECTATIONS, observe_as: str | None = None) -> DataFrame:
    """Drop rows that break a hard expectation; with ``observe_as`` every outcome is counted on the way.

    The counters ride along with the write (``DataFrame.observe``), so no second pass is made; on a
    stream they appear in the progress of each micro-batch.
    """
    if observe_as:
        df = df.observe(observe_as, *expectation_counters(expectations))
    keep = [e.met() for e in expectations if e.hard]
    return df.filter(reduce(lambda a, b: a & b, keep)) if keep else df


def expectation_report(df: DataFrame, expectations=SILVER_EXPECTATIONS, flow: str = "silver") -> DataFrame:
    """Outcome per expectation over a whole table: one aggregation, no shuffle of rows."""
    totals = df.agg(*expectation_counters(expectations))
    lines = F.array(
        *[
            F.struct(
                F.lit(e.name).alias("expectation"),
                F.lit(e.kind).alias("kind"),
                F.col(f"{e.name}__passed").alias("passed"),
                F.col(f"{e.name}__failed").alias("failed"),
            )
            for e in expectations
        ]
    )
    return totals.select(F.lit(flow).alias("flow"), F.inline(lines))


def failures(metrics: DataFrame, n: int = 20) -> DataFrame:
    """Latest metric rows of hard expectations that dropped something."""
    return (
        metrics.filter((F.col("kind") == "drop") & (F.col("failed") > 0))
        .orderBy(F.desc("at"), "flow", "expectation")
        .limit(n)
    )


def conservation(bronze: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Where every captured row went: silver, quarantine, or neither and why.

    ``duplicates`` and ``dropped`` are recomputed from bronze, so on a live system the remainder
    ``unexplained`` is the rows that came too late for the stream.
    """
    passed = accepted(parse_events(bronze))
    hard = reduce(lambda a, b: a & b, [e.met() for e in SILVER_EXPECTATIONS if e.hard])
    # One row per id; copies are merged before the shuffle.
    per_id = passed.groupBy("event_id").agg(F.count("*").alias("copies"), F.bool_and(hard).alias("kept"))
    explained = per_id.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
        count_when(~F.col("kept")).alias("dropped"),
    )
    rows = [("bronze", bronze), ("silver", silver), ("quarantine", quarantine)]
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n") for name, df in rows]
        + [explained.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("part"), F.col(c).alias("n")) for c in ("duplicates", "dropped")])))],
    )
    pick = lambda part: F.sum(F.when(F.col("part") == part, F.col("n")).otherwise(0))
    names = ["bronze", "silver", "quarantine", "duplicates", "dropped"]
    wide = counts.agg(*[pick(n).alias(n) for n in names])
    rest = F.col("bronze") - F.col("silver") - F.col("quarantine") - F.col("duplicates") - F.col("dropped")
    return wide.withColumn("unexplained", rest)
