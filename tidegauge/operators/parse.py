"""Raw lines to typed, flat event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.model.contracts import RAW_EVENT_DDL

# Output column and its path in the raw event, in table order.
FLAT_FIELDS = """
    event_id             meta.id
    mw_id                id
    event_type           type
    wiki                 wiki
    namespace            namespace
    title                title
    title_url            title_url
    server_name          server_name
    server_url           server_url
    user                 user
    bot                  bot
    minor                minor
    patrolled            patrolled
    event_timestamp      timestamp
    event_dt             meta.dt
    comment              comment
    parsedcomment        parsedcomment
    length_old           length.old
    length_new           length.new
    byte_delta           -
    revision_old         revision.old
    revision_new         revision.new
    log_id               log_id
    log_type             log_type
    log_action           log_action
    log_params           -
    log_action_comment   log_action_comment
"""
#: Seconds since 1970 of the first and last second that a timestamp may have.
YEARS = (-62_135_596_800, 253_402_300_799)
LINEAGE = ("ingest_timestamp", "ingest_date", "source_file")


def byte_delta(old: Column, new: Column) -> Column:
    """Size change of a page; NULL when either side is unknown, as for new pages, or when it is out of range."""
    return F.try_subtract(new, old)


def capture(lines: DataFrame, ingest_timestamp: Column | None = None) -> DataFrame:
    """Text lines with file metadata to bronze rows: the line verbatim plus lineage and its id.

    Nothing is parsed beyond one path lookup, so a malformed line can never fail the capture.
    """
    clock = F.current_timestamp() if ingest_timestamp is None else ingest_timestamp
    return lines.select(
        F.col("value").alias("raw_json"),
        clock.alias("ingest_timestamp"),
        F.col("_metadata.file_path").alias("source_file"),
        F.get_json_object("value", "$.meta.id").alias("event_id"),
        clock.cast("date").alias("ingest_date"),
    )


def narrowed(leaves: set[str]) -> str:
    """DDL of the raw event with only the given leaf paths."""
    def keep(struct: T.StructType, prefix: str) -> list[T.StructField]:
        kept = []
        for f in struct.fields:
            path = prefix + f.name
            if isinstance(f.dataType, T.StructType):
                inner = keep(f.dataType, path + ".")
                if inner:
                    kept.append(T.StructField(f.name, T.StructType(inner)))
            elif path in leaves:
                kept.append(f)
        return kept

    chosen = keep(T.StructType.fromDDL(RAW_EVENT_DDL), "")
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen)


def parse_events(bronze: DataFrame, raw: str = "raw_json") -> DataFrame:
    """Typed flat rows; a malformed line becomes a row of NULLs, a mistyped field one NULL.

    The document is produced by a generator (``inline``) rather than by a projection: filters on its
    fields are then applied to the parsed row. Through a projection Catalyst would push them down by
    repeating ``from_json`` inside the filter, once per condition, and parse every line several times.

    ``log_params`` has no stable type and comes as JSON text from a second look at the line, which is
    taken only where the first one found the field (or failed).
    """
    fields = [line.split() for line in FLAT_FIELDS.strip().splitlines()]
    leaves = {path for _, path in fields if path != "-"}
    document = F.from_json(raw, narrowed(leaves) + ", log_params string")
    lineage = [c for c in LINEAGE if c in bronze.columns]
    doc = bronze.select(raw, *lineage, F.inline(F.array(document)))
    has_params = F.col("log_params").isNotNull() | F.col("meta.id").isNull()
    special = {
        # seconds outside the years 1 to 9999 are no time; later arithmetic on them would overflow
        "event_timestamp": F.when(F.col("timestamp").between(*YEARS), F.col("timestamp").cast("timestamp")),
        "byte_delta": byte_delta(F.col("length.old"), F.col("length.new")),
        "log_params": F.when(has_params, F.get_json_object(raw, "$.log_params")),
    }
    return doc.select(*[special.get(name, F.col(path)).alias(name) for name, path in fields], *lineage)
