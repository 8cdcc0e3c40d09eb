"""The landing zone: raw lines as text files under year/month/day/hour folders."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.model.contracts import FLUSH_SECONDS, RETENTION_DAYS
from tidegauge.operators.parse import capture

# Folder levels and their date formats.
HOUR_FOLDERS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
MAX_LINES_PER_FILE = 4_000_000


def in_hour_folders(df: DataFrame, at: Column, line: str = "raw_json") -> DataFrame:
    return df.select(
        F.col(line).alias("value"), *[F.date_format(at, f).alias(name) for name, f in HOUR_FOLDERS.items()]
    )


def land_lines(
    df: DataFrame, path: str, at: Column, line: str = "raw_json", max_lines: int = MAX_LINES_PER_FILE
) -> None:
    """Append lines to the landing zone in batch.

    Rows are brought together per hour with the REBALANCE hint: AQE merges small hours into one task and splits an hour that is too large for one.
    """
    foldered = in_hour_folders(df, at, line)
    (
        foldered.hint("rebalance", *[F.col(c) for c in HOUR_FOLDERS])
        .write.mode("append").partitionBy(*HOUR_FOLDERS).option("maxRecordsPerFile", max_lines).text(path)
    )


def land_stream(
    df: DataFrame, path: str, checkpoint: str, at: Column, line: str = "raw_json", every_seconds: int = FLUSH_SECONDS
) -> StreamingQuery:
    """Land a stream of lines, one flush per interval; restarting on the checkpoint loses nothing."""
    return (
        in_hour_folders(df, at, line)
        .writeStream.format("text").partitionBy(*HOUR_FOLDERS)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{every_seconds} seconds")
        .start()
    )


def bronze_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    clean: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Stream the landing zone into bronze rows: files already there first, new folders as they appear.

    ``clean='delete'`` or ``'archive'`` lets the source remove files it has finished.
    """
    reader = spark.readStream.format("text").schema("value STRING").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if clean:
        reader = reader.option("cleanSource", clean)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return capture(reader.load(path))


def bronze_batch(spark: SparkSession, path: str, ingest_timestamp: Column | None = None) -> DataFrame:
    """The same rows for a backfill."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return capture(lines, ingest_timestamp)


def expire_landed(
    spark: SparkSession, path: str, as_of: datetime, days: int = RETENTION_DAYS, dry_run: bool = False
) -> list[str]:
    """Delete the hour folders that ended more than ``days`` ago; returns their paths.

    Only folder names are looked at (24 per day), never file contents.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*/day=*/hour=*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit = as_of.replace(tzinfo=None) - timedelta(days=days)
    expired = []
    for status in fs.globStatus(pattern) or []:
        folder = status.getPath()
        levels = folder.toString().split("/")[-len(HOUR_FOLDERS):]
        start = datetime(*[int(level.split("=")[1]) for level in levels])
        if start + timedelta(hours=1) <= limit:
            expired.append(folder.toString())
            if not dry_run:
                fs.delete(folder, True)
    return sorted(expired)


def retention_report(bronze: DataFrame, as_of: Column, days: int = RETENTION_DAYS, ts: str = "ingest_timestamp") -> DataFrame:
    """Lines per landed hour and whether that hour is past retention."""
    hour = F.date_trunc("hour", F.col(ts))
    return bronze.groupBy(hour.alias("hour")).agg(F.count("*").alias("lines")).withColumn(
        "expired", F.col("hour") + F.expr("INTERVAL 1 HOUR") <= as_of - F.expr(f"INTERVAL {days} DAYS")
    )
