"""Parquet tables under one root folder."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.model import contracts as c
from tidegauge.session import scratch_path

SCHEMAS = {
    c.BRONZE: c.BRONZE_DDL,
    c.SILVER: c.SILVER_DDL,
    c.QUARANTINE: c.QUARANTINE_DDL,
    c.GOLD_5MIN: c.GOLD_DDL,
    c.GOLD_15MIN: (
        "window_start TIMESTAMP, window_end TIMESTAMP, window_date DATE, title STRING, namespace INT, "
        "edit_count BIGINT, unique_editors BIGINT, total_byte_delta BIGINT"
    ),
    c.BASELINE: c.BASELINE_DDL,
    c.PANES: c.PANES_DDL,
    c.MOMENTS: c.MOMENTS_DDL,
    c.FLAGS: c.FLAGS_DDL,
    c.SUMMARIES: c.SUMMARIES_DDL,
    c.INDEX: (
        "id STRING, title STRING, z_score DOUBLE, summary STRING, generated_at TIMESTAMP, embedding ARRAY<FLOAT>"
    ),
    c.FREQUENCIES: c.FREQUENCIES_DDL,
    c.METRICS: c.METRICS_DDL,
}

# Partition columns.
PARTITIONS = {
    c.BRONZE: ("ingest_date",),
    c.SILVER: ("ingest_date", "event_date"),
    c.QUARANTINE: ("ingest_date",),
    c.GOLD_5MIN: ("window_date",),
    c.GOLD_15MIN: ("window_date",),
    c.BASELINE: ("baseline_date",),
    c.PANES: ("pane_date",),
    c.MOMENTS: ("window_date",),
}

# The table whose rows are changed by a maintenance run; each rewrite is a new folder.
REWRITTEN = {c.SUMMARIES}


# Metrics are kept by the day of their batch.
METRICS_DAY = "metric_date"


class Tables:
    """Reads and writes the tables of one lake root.

    A table is a folder. What streams write to it stands beside that, a folder for each micro-batch
    (:meth:`stream_path`); :meth:`close_days` puts the days that no stream adds to any more together in a
    third place. Readers of the table see the three as one; readers of the stream follow the micro-batches.

    A table that is updated keeps each state in its own
    ``v=<n>`` folder: the current one is the highest that Spark has committed (``_SUCCESS``), so a
    writer that dies half-way leaves the previous state in place and nothing that is being read is
    ever overwritten. Its leftover folder keeps its number; the next writer takes a later one. One
    maintenance run at a time, with no appends beside it. Flags are only ever appended.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _there(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _version(self, name: str) -> int:
        found = self._fs.globStatus(self._path(f"{self.root}/{name}/v=*/_SUCCESS")) or []
        return max([int(s.getPath().getParent().getName().split("=")[1]) for s in found], default=0)

    def _folders(self, name: str) -> list[int]:
        """Numbers of all state folders, committed or left behind."""
        found = self._fs.globStatus(self._path(f"{self.root}/{name}/v=*")) or []
        return sorted(int(s.getPath().getName().split("=")[1]) for s in found)

    def path(self, name: str) -> str:
        base = f"{self.root}/{name}"
        return f"{base}/v={self._version(name)}" if name in REWRITTEN else base

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def stream_path(self, name: str) -> str:
        """Where the micro-batches of a stream are: ``batch=<id>`` folders, each with the table's partitions."""
        return f"{self.root}/{name}__stream"

    def _closed_path(self, name: str) -> str:
        return f"{self.root}/{name}__closed"

    def exists(self, name: str) -> bool:
        return self._there(self.path(name)) or self._there(self.stream_path(name))

    def read(self, name: str) -> DataFrame:
        """The table, with its fixed schema; empty when nothing was written yet."""
        columns = self.spark.createDataFrame([], SCHEMAS[name]).columns
        if name == c.METRICS:
            return self._metrics().select(*columns)
        at = lambda path: self.spark.read.schema(SCHEMAS[name]).parquet(path)
        parts = [at(self.path(name))] if self._there(self.path(name)) else []
        if self._there(self.stream_path(name)):
            open_days, through = self._batches(name), self.closed_through(name)
            if through is not None:
                day = F.col(PARTITIONS[name][0])
                open_days = open_days.filter(day.isNull() | (day > F.lit(through)))
                parts.append(at(self._closed_path(name)).filter(day <= F.lit(through)))
            parts.append(open_days)
        if not parts:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return reduce(DataFrame.unionAll, [p.select(*columns) for p in parts])

    def _batches(self, name: str) -> DataFrame:
        return self.spark.read.schema(f"{SCHEMAS[name]}, batch BIGINT").parquet(self.stream_path(name))

    def stream(self, name: str, max_files: int | None = None) -> DataFrame:
        """New rows of a streamed table, or of an append-only one, as they are committed."""
        batched = self._there(self.stream_path(name))
        reader = self.spark.readStream.schema(f"{SCHEMAS[name]}, batch BIGINT" if batched else SCHEMAS[name])
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.stream_path(name)).drop("batch") if batched else reader.parquet(self.path(name))

    def write_batch(self, name: str, df: DataFrame, batch_id: int) -> None:
        """Store one micro-batch, once: a batch that is committed stays, one that was cut short is written anew. Rows are
        dealt by the table's partitions, so a partition gets one file, or several of a bounded size."""
        folder = f"{self.stream_path(name)}/batch={batch_id}"
        if self._there(f"{folder}/_SUCCESS"):
            return
        parts, session = PARTITIONS[name], df.sparkSession
        adaptive = session.conf.get("spark.sql.adaptive.enabled")
        # the session of a stream plans without adaptive execution, which its state needs; a write has no state
        session.conf.set("spark.sql.adaptive.enabled", "true")
        try:
            df.hint("rebalance", *map(F.col, parts)).write.mode("overwrite").partitionBy(*parts).parquet(folder)
        finally:
            session.conf.set("spark.sql.adaptive.enabled", adaptive)

    def closed_through(self, name: str) -> date | None:
        """The last day of a streamed table that is put together."""
        found = self._fs.globStatus(self._path(f"{self._closed_path(name)}/_through/*")) or []
        return max([date.fromisoformat(s.getPath().getName()) for s in found], default=None)

    def close_days(self, name: str, through: date) -> date | None:
        """Put the days up to ``through`` together, a few large files each, and drop what an earlier run has put together
        from the stream's folders. Streams must be done with these days, in and out. A run that is cut short changes nothing
        that readers see, and the next one does its work again. Returns the last day that is closed."""
        day, done = PARTITIONS[name][0], self.closed_through(name)
        if not self._there(self.stream_path(name)):
            return done
        if done is not None:
            self._drop_days(name, done)
        if done is not None and through <= done:
            return done
        rows = self._batches(name).filter(F.col(day) <= F.lit(through))
        rows = rows if done is None else rows.filter(F.col(day) > F.lit(done))
        rows.drop("batch").hint("rebalance", *map(F.col, PARTITIONS[name])).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS[name]).parquet(self._closed_path(name))
        # from here on readers take these days from the closed place
        self._fs.create(self._path(f"{self._closed_path(name)}/_through/{through.isoformat()}"), True).close()
        return through

    def _drop_days(self, name: str, through: date) -> None:
        day = PARTITIONS[name][0]
        for s in self._fs.globStatus(self._path(f"{self.stream_path(name)}/batch=*/{day}=*")) or []:
            value = s.getPath().getName().split("=", 1)[1]
            if value[:4].isdigit() and date.fromisoformat(value) <= through:
                self._fs.delete(s.getPath(), True)

    def append(self, name: str, df: DataFrame) -> None:
        parts = PARTITIONS.get(name, ())
        writer = (df.hint("rebalance", *map(F.col, parts)) if parts else df).write.mode("append")
        path = self.path(name)
        if name in REWRITTEN and self._version(name) == 0:
            path = f"{self.root}/{name}/v={max(self._folders(name), default=0) + 1}"
        (writer.partitionBy(*parts) if parts else writer).parquet(path)

    def replace_partitions(self, name: str, df: DataFrame) -> None:
        """Overwrite only the partitions present in ``df``; the others keep their rows."""
        parts = PARTITIONS[name]
        (
            df.hint("rebalance", *map(F.col, parts))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
            .parquet(self.path(name))
        )

    def days(self, name: str) -> list[date]:
        """The days of which a table has a partition, from the folders alone."""
        found = self._fs.globStatus(self._path(f"{self.path(name)}/{PARTITIONS[name][0]}=*")) or []
        values = (s.getPath().getName().split("=", 1)[1] for s in found)
        return sorted(date.fromisoformat(v) for v in values if v[:4].isdigit())

    def rewrite(self, name: str, df: DataFrame) -> None:
        """Publish ``df`` as the next state of an updated table."""
        df.write.mode("errorifexists").parquet(f"{self.root}/{name}/v={max(self._folders(name), default=0) + 1}")

    def append_metrics(self, rows: list) -> None:
        """Store what some micro-batches have counted; a batch that is repeated is stored again, and counts as it was last."""
        df = self.spark.createDataFrame(rows, SCHEMAS[c.METRICS]).withColumn(METRICS_DAY, F.to_date("at")).coalesce(1)
        df.write.mode("append").partitionBy(METRICS_DAY).parquet(self.path(c.METRICS))

    def _metrics(self) -> DataFrame:
        """The last report of each batch, with its day."""
        if not self._there(self.path(c.METRICS)):
            return self.spark.createDataFrame([], f"{SCHEMAS[c.METRICS]}, {METRICS_DAY} DATE")
        stored = self.spark.read.schema(f"{SCHEMAS[c.METRICS]}, {METRICS_DAY} DATE").parquet(self.path(c.METRICS))
        last = F.max_by(F.struct("passed", "failed", "at", METRICS_DAY), "at").alias("last")
        return stored.groupBy("flow", "batch_id", "expectation", "kind").agg(last).select(
            "flow", "batch_id", "expectation", "kind", "last.*")

    def compact_metrics(self, before: date) -> None:
        """One file for each day before ``before``, with the last report of each batch."""
        old = self._metrics().filter(F.col(METRICS_DAY) < F.lit(before))
        old.hint("rebalance", F.col(METRICS_DAY)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(METRICS_DAY).parquet(self.path(c.METRICS))

    def drop_old(self, name: str, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` committed states of an updated table (and stale leftovers)."""
        newest = self._version(name)
        committed = {int(s.getPath().getParent().getName().split("=")[1])
                     for s in self._fs.globStatus(self._path(f"{self.root}/{name}/v=*/_SUCCESS")) or []}
        dropped = [n for n in self._folders(name) if n <= newest - keep or (n < newest and n not in committed)]
        for n in dropped:
            self._fs.delete(self._path(f"{self.root}/{name}/v={n}"), True)
        return dropped

    def register_views(self) -> None:
        """Every table as a temp view under its own name, for SQL users."""
        for name in SCHEMAS:
            self.read(name).createOrReplaceTempView(name)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, in whatever store it names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def written(df: DataFrame, label: str, **options: object) -> DataFrame:
    """``df`` as a table in the shared folder: worked out once, whatever is done with it."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_to_table(spark: SparkSession, rows: list, ddl: str) -> DataFrame:
    """Driver rows (a bounded handful, such as one run's results) with an explicit schema."""
    return spark.createDataFrame(rows, ddl)


def roundtrip(df: DataFrame, path: str) -> DataFrame:
    """Write rows and read them back: the connectivity check of a storage location."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_title(silver: DataFrame, title: str) -> DataFrame:
    """Point lookup; the predicate reaches the Parquet scan."""
    return silver.filter(F.col("title") == title)
