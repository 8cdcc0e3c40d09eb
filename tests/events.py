"""Raw change events made by hand, in the shape of the feed."""

from __future__ import annotations

import json

T0 = 1704067200  # 2024-01-01 00:00:00 UTC


def raw(id="e1", at=T0, drop=(), **fields) -> str:
    """One JSON line of an event that passes; ``drop`` removes fields, keywords replace them."""
    doc = {
        "meta": {"id": id, "dt": "2024-01-01T00:00:00Z"}, "id": 1, "type": "edit", "namespace": 0, "title": "Page",
        "comment": "hello", "timestamp": at, "user": "ann", "bot": False, "minor": False, "wiki": "enwiki",
        "length": {"old": 100, "new": 150},
    }
    doc.update(fields)
    for name in drop:
        if name == "meta.id":
            doc["meta"].pop("id")
        else:
            doc.pop(name)
    return json.dumps(doc, separators=(",", ":"))


def bronze(spark, lines):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(x,) for x in lines], "raw_json string")
    return df.select(
        "raw_json", F.current_timestamp().alias("ingest_timestamp"), F.lit("f").alias("source_file"),
        F.get_json_object("raw_json", "$.meta.id").alias("event_id"), F.current_date().alias("ingest_date"))


def write_lines(path, lines) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
