"""Writing and maintaining tables: landing, partition overwrite, append, update, views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.model import contracts as c
from tidegauge.operators import anomaly
from tidegauge.plans import jobs
from tidegauge.registry.core import query
from tidegauge.session import scratch_path
from tidegauge.sources.landing import land_lines
from tidegauge.sources.tables import Tables, roundtrip


@query("s7_land_hours", """
    SELECT CAST(strftime(ingest_timestamp, '%Y') AS INTEGER) AS year, CAST(strftime(ingest_timestamp, '%m') AS INTEGER) AS month,
           CAST(strftime(ingest_timestamp, '%d') AS INTEGER) AS day, CAST(strftime(ingest_timestamp, '%H') AS INTEGER) AS hour,
           count(*) AS lines, CAST(sum(length(raw_json)) AS BIGINT) AS characters
    FROM bronze GROUP BY 1, 2, 3, 4""")
def _(m):
    path = scratch_path(m.spark, "landing")
    land_lines(m.bronze, path, F.col("ingest_timestamp"))
    landed = m.spark.read.text(path)
    return landed.groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("lines"), F.sum(F.length("value")).alias("characters"))


@query("s13_replace_partition", """
    SELECT CAST(window_start AS DATE) AS window_date, CAST(sum(edit_count) AS BIGINT)
             * CASE WHEN CAST(window_start AS DATE) = (SELECT CAST(t AS DATE) FROM clock) THEN 10 ELSE 1 END AS edits
    FROM gold GROUP BY 1, window_start::DATE""")
def _(m):
    """Write all days, then only the last day again with ten times the counts."""
    tables = Tables(m.spark, scratch_path(m.spark, "replace"))
    tables.replace_partitions(c.GOLD_5MIN, m.gold)
    last = m.gold.filter(F.col("window_date") == m.as_of.cast("date"))
    tables.replace_partitions(c.GOLD_5MIN, last.withColumn("edit_count", F.col("edit_count") * 10))
    return tables.read(c.GOLD_5MIN).groupBy("window_date").agg(F.sum("edit_count").alias("edits"))


@query("s14_append_flags", "SELECT title, namespace, window_start, z_score FROM flags")
def _(m):
    """Two detection runs over the same windows: the second finds nothing new to append."""
    tables = Tables(m.spark, scratch_path(m.spark, "append"))
    for _ in range(2):
        known = tables.read(c.FLAGS) if tables.exists(c.FLAGS) else None
        tables.append(c.FLAGS, anomaly.unflagged(m.flags, known, ("title", "window_start")).select(*anomaly.FLAG_COLUMNS))
    return tables.read(c.FLAGS).select("title", "namespace", "window_start", "z_score")


@query("s15_update_flags", """
    WITH done AS (SELECT DISTINCT title FROM flags WHERE z_score >= 4)
    SELECT title, namespace, window_start, title IN (SELECT title FROM done) AS summarized FROM flags""")
def _(m):
    tables = Tables(m.spark, scratch_path(m.spark, "update"))
    """Summaries of the strongest titles are appended; the state of the flags follows."""
    tables.append(c.FLAGS, m.flags)
    later = m.flags.agg(F.max("detected_at")).scalar()
    tables.append(c.SUMMARIES, m.summaries.filter("z_score >= 4").withColumn("generated_at", later))
    return jobs.flag_state(tables).select("title", "namespace", "window_start", "summarized")


@query("s18_view_sql", """
    SELECT title, count(*) AS windows, max(z_score) AS peak_z_score FROM flags GROUP BY title""")
def _(m):
    m.flags.createOrReplaceTempView("anomaly_flags_view")
    return m.spark.sql(
        "SELECT title, count(*) AS windows, max(z_score) AS peak_z_score FROM anomaly_flags_view GROUP BY title")


@query("s20_roundtrip", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def _(m):
    return roundtrip(m.events, scratch_path(m.spark, "roundtrip"))
