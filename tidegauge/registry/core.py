"""Registration, and the adapter from the ``events`` table to the change-event model.

The adapter derives the fields of a change event from the columns of ``events`` (see FIXTURES.md);
it never removes a row. The same expressions exist as SQL common table expressions for the checks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.scalars import summary_id
from tidegauge.operators import anomaly, baseline, quality, summaries, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

HOUR = "1 hour"


def zone_free(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as in the source table, so results do not depend on the session zone."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Model` under ``name``, with its check in SQL."""
    def add(fn: Callable[[Model], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: zone_free(fn(Model(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return fn

    return add


class Model:
    """The layers of one test scale, lazily derived from the given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # the times of the given tables are UTC

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def as_of(self) -> Column:
        """The latest event time: the 'now' of the test data. It is resolved once to a literal, as the
        jobs do, so that relative-time filters fold to constants and reach the Parquet scan."""
        latest = self.events.agg(F.max("ts").cast("string")).first()[0]
        return F.lit(latest).cast("timestamp_ntz")

    @cached_property
    def parsed(self) -> DataFrame:
        """Events as parsed rows."""
        return derive(self.events)

    @cached_property
    def bronze(self) -> DataFrame:
        """Events as raw lines."""
        return self.parsed.select(
            raw_line().alias("raw_json"), "ingest_timestamp", F.lit("events").alias("source_file"), "event_id",
            "ingest_date",
        )

    @cached_property
    def silver(self) -> DataFrame:
        """Accepted rows. ``event_id`` is unique in the given table, so nothing is left to de-duplicate."""
        return quality.with_event_date(quality.accepted(self.parsed))

    @cached_property
    def quarantine(self) -> DataFrame:
        return quality.rejected(self.parsed)

    @cached_property
    def gold(self) -> DataFrame:
        return windows.page_metrics(self.silver, exact=True)

    @cached_property
    def hourly(self) -> DataFrame:
        """The test data is too thin for surges in 5-minute windows; detection runs on hours."""
        return windows.page_metrics(self.silver, HOUR, exact=True)

    @cached_property
    def baseline(self) -> DataFrame:
        return baseline.baseline_stats(self.hourly)

    @cached_property
    def flags(self) -> DataFrame:
        """Every surge of the whole history, detected a quarter hour after its window and pending."""
        hits = anomaly.surges(self.hourly, self.baseline)
        return anomaly.as_flags(hits).withColumn("detected_at", F.col("window_end") + F.expr("INTERVAL 15 MINUTES"))

    @cached_property
    def flag_history(self) -> DataFrame:
        """The flags of a system that has summarised everything up to the 20th."""
        done = F.col("window_start") < F.lit("2024-01-20").cast("timestamp_ntz")
        return self.flags.withColumn("summarized", done)

    @cached_property
    def flag_clock(self) -> Column:
        return self.flags.agg(F.max("detected_at")).scalar()

    @cached_property
    def summaries(self) -> DataFrame:
        """A stored summary for every flag, five minutes after its detection."""
        return self.flags.select(
            "title", "window_start", "z_score", "edit_count",
            F.format_string("%s drew %s edits", "title", F.col("edit_count").cast("string")).alias("summary"),
            (F.col("unique_editors") - 1).alias("searches_used"),
            F.lit(summaries.LOCAL_MODEL).alias("model_used"),
            (F.col("detected_at") + F.expr("INTERVAL 5 MINUTES")).alias("generated_at"),
            summary_id(F.col("title"), F.col("window_start")).alias("id"),
        )

    @cached_property
    def summary_clock(self) -> Column:
        return self.summaries.agg(F.max("generated_at")).scalar()


# Event types of the test table and the change types they stand for.
CHANGE_TYPES = {"click": "edit", "view": "edit", "purchase": "new", "signup": "log", "error": "categorize"}


def derive(events: DataFrame) -> DataFrame:
    n, value = F.col("event_id"), F.col("value")
    k = F.get_json_object("props", "$.k").cast("int")
    change = F.lit(None).cast("string")
    for source, target in CHANGE_TYPES.items():
        change = F.when(F.col("event_type") == source, target).otherwise(change)
    is_new, is_log = F.col("event_type") == "purchase", F.col("event_type") == "signup"
    old = F.when(~is_new, 1000)
    new = (950 + F.floor(value)).cast("int")
    nothing = lambda kind: F.lit(None).cast(kind)
    second = F.date_trunc("second", "ts").cast("timestamp_ntz")
    said = F.concat_ws(" ", "event_type", value.cast("string"))
    comment = F.when(n % 11 == 0, None).when(n % 4 == 0, "").otherwise(said)
    wiki = F.when(n % 7 == 0, "dewiki").otherwise("enwiki")
    title = F.concat(F.lit("page-"), (k % 20).cast("string"))
    columns = {
        "event_id": F.concat(F.lit("ev-"), n.cast("string")),
        "mw_id": n,
        "event_type": change,
        "wiki": wiki,
        "namespace": F.when(n % 5 == 0, 1).otherwise(0),
        "title": title,
        "title_url": nothing("string"),
        "server_name": nothing("string"),
        "server_url": nothing("string"),
        "user": F.concat(F.lit("user-"), F.col("user_id").cast("string")),
        "bot": n % 10 == 0,
        "minor": n % 3 == 0,
        "patrolled": nothing("boolean"),
        "event_timestamp": second,
        "event_dt": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "comment": comment,
        "parsedcomment": nothing("string"),
        "length_old": old,
        "length_new": new,
        "byte_delta": new - old,
        "revision_old": nothing("bigint"),
        "revision_new": n,
        "log_id": F.when(is_log, n),
        "log_type": F.when(is_log, "newusers"),
        "log_action": nothing("string"),
        "log_params": F.when(is_log, F.format_string('{"k":%d}', k)),
        "log_action_comment": nothing("string"),
        "ingest_timestamp": F.col("ts"),
        "ingest_date": F.col("ts").cast("date"),
        "source_file": F.lit("events"),
    }
    return events.select(*[c.alias(name) for name, c in columns.items()])


def raw_line() -> Column:
    """A parsed row back as the raw JSON line it would have come from."""
    c = F.col
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c("event_timestamp"))
    part = lambda **f: F.struct(*[v.alias(k) for k, v in f.items()])
    return F.to_json(
        part(
            meta=part(id=c("event_id"), dt=c("event_dt")),
            id=c("mw_id"), type=c("event_type"), namespace=c("namespace"), title=c("title"), comment=c("comment"),
            timestamp=epoch, user=c("user"), bot=c("bot"), minor=c("minor"), wiki=c("wiki"),
            length=part(old=c("length_old"), new=c("length_new")), revision=part(new=c("revision_new")),
            log_id=c("log_id"), log_type=c("log_type"),
            log_params=F.from_json("log_params", "struct<k: int>"),
        ),
        {"ignoreNullFields": "false"},
    )


# ---------------------------------------------------------------------------------------------
# The same as SQL
# ---------------------------------------------------------------------------------------------

def _metrics_sql(source: str, width: str) -> str:
    return f"""
    SELECT time_bucket(INTERVAL {width}, event_timestamp) AS window_start,
           time_bucket(INTERVAL {width}, event_timestamp) + INTERVAL {width} AS window_end,
           CAST(time_bucket(INTERVAL {width}, event_timestamp) AS DATE) AS window_date,
           title, namespace, count(*) AS edit_count, count(DISTINCT "user") AS unique_editors,
           CAST(sum(byte_delta) AS BIGINT) AS total_byte_delta, round(avg(byte_delta), 1) AS avg_byte_delta,
           max(byte_delta) AS max_byte_delta, count(*) FILTER (WHERE minor) AS minor_edit_count
    FROM {source} GROUP BY ALL"""


CTES = {
    "parsed": """
    SELECT 'ev-' || event_id AS event_id, event_id AS mw_id,
           CASE event_type WHEN 'click' THEN 'edit' WHEN 'view' THEN 'edit' WHEN 'purchase' THEN 'new'
                           WHEN 'signup' THEN 'log' WHEN 'error' THEN 'categorize' END AS event_type,
           CASE WHEN event_id % 7 = 0 THEN 'dewiki' ELSE 'enwiki' END AS wiki,
           CAST(CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS namespace,
           'page-' || (CAST(json_extract_string(props, '$.k') AS INTEGER) % 20) AS title,
           'user-' || user_id AS "user", event_id % 10 = 0 AS bot, event_id % 3 = 0 AS minor,
           date_trunc('second', ts) AS event_timestamp, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_dt,
           CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 4 = 0 THEN ''
                ELSE event_type || ' ' || CAST(value AS VARCHAR) END AS comment,
           CAST(CASE WHEN event_type <> 'purchase' THEN 1000 END AS INTEGER) AS length_old,
           CAST(950 + floor(value) AS INTEGER) AS length_new,
           CAST(CASE WHEN event_type <> 'purchase' THEN floor(value) - 50 END AS INTEGER) AS byte_delta,
           CASE WHEN event_type = 'signup' THEN event_id END AS log_id,
           CASE WHEN event_type = 'signup' THEN 'newusers' END AS log_type,
           CASE WHEN event_type = 'signup' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS log_k,
           ts AS ingest_timestamp, CAST(ts AS DATE) AS ingest_date
    FROM events""",
    "bronze": """
    SELECT CAST(to_json({'meta': {'id': event_id, 'dt': event_dt}, 'id': mw_id, 'type': event_type,
               'namespace': namespace, 'title': title, 'comment': comment,
               'timestamp': CAST(floor(epoch(event_timestamp)) AS BIGINT), 'user': "user", 'bot': bot,
               'minor': minor, 'wiki': wiki, 'length': {'old': length_old, 'new': length_new},
               'revision': {'new': mw_id}, 'log_id': log_id, 'log_type': log_type,
               'log_params': CASE WHEN log_k IS NOT NULL THEN {'k': log_k} END}) AS VARCHAR) AS raw_json,
           ingest_timestamp, event_id, ingest_date
    FROM parsed""",
    "silver": """
    SELECT *, CAST(event_timestamp AS DATE) AS event_date FROM parsed
    WHERE NOT bot AND wiki = 'enwiki' AND event_type IN ('edit', 'new') AND namespace = 0""",
    "quarantine": """
    SELECT *, CASE WHEN event_id IS NULL THEN 'parse_failure' WHEN bot THEN 'bot'
                   WHEN wiki IS DISTINCT FROM 'enwiki' THEN 'non_enwiki'
                   WHEN event_type IS NULL OR event_type NOT IN ('edit', 'new') THEN 'non_edit_type'
                   WHEN namespace IS DISTINCT FROM 0 THEN 'non_article_namespace' ELSE 'unknown'
              END AS quarantine_reason
    FROM parsed
    WHERE NOT coalesce(NOT bot AND wiki = 'enwiki' AND event_type IN ('edit', 'new') AND namespace = 0, false)""",
    "gold": _metrics_sql("silver", "5 MINUTE"),
    "hourly": _metrics_sql("silver", "1 HOUR"),
    "baseline": """
    SELECT title, namespace, count(*) AS window_count, avg(edit_count) AS mean_edit_count,
           stddev_samp(edit_count) AS stddev_edit_count, avg(unique_editors) AS mean_unique_editors,
           avg(total_byte_delta) AS mean_total_byte_delta, min(window_start) AS data_from,
           max(window_start) AS data_through
    FROM hourly GROUP BY title, namespace HAVING count(*) >= 10""",
    "flags": """
    SELECT title, namespace, window_start, window_end, edit_count, unique_editors, total_byte_delta,
           round(mean_edit_count, 2) AS baseline_mean, round(stddev_edit_count, 2) AS baseline_stddev,
           round((edit_count - mean_edit_count) / nullif(stddev_edit_count, 0), 2) AS z_score,
           window_end + INTERVAL 15 MINUTE AS detected_at, false AS summarized
    FROM hourly JOIN baseline USING (title, namespace)
    WHERE edit_count >= 3 AND round((edit_count - mean_edit_count) / nullif(stddev_edit_count, 0), 2) >= 3""",
    "flag_history": """
    SELECT * EXCLUDE (summarized), window_start < TIMESTAMP '2024-01-20' AS summarized FROM flags""",
    "summaries": """
    SELECT title, window_start, z_score, edit_count, title || ' drew ' || edit_count || ' edits' AS summary,
           unique_editors - 1 AS searches_used, 'keyword-rules' AS model_used,
           detected_at + INTERVAL 5 MINUTE AS generated_at,
           md5(title || '|' || CAST(window_start AS VARCHAR)) AS id
    FROM flags""",
    "clock": "SELECT max(ts) AS t FROM events",
    "flag_clock": "SELECT max(detected_at) AS t FROM flags",
    "summary_clock": "SELECT max(generated_at) AS t FROM summaries",
}


def with_ctes(body: str) -> str:
    """``body`` behind the definitions of the layers; unused ones cost nothing."""
    definitions = ",\n".join(f"{name} AS ({text})" for name, text in CTES.items())
    words = body.split(None, 1)
    if words[0].upper() == "WITH":
        return f"WITH {definitions},\n{words[1]}"
    return f"WITH {definitions}\n{body.strip()}"
