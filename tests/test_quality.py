"""Parsing, the pass/quarantine split, expectations, conservation."""

from __future__ import annotations

from conftest import rows
from events import bronze, raw
from pyspark.sql import functions as F

from tidegauge.functions.scalars import namespace_label, pct, signed_bytes
from tidegauge.model import contracts as c
from tidegauge.operators import quality
from tidegauge.operators.parse import parse_events
from tidegauge.plans import checks


def split(spark, lines):
    parsed = parse_events(bronze(spark, lines))
    return quality.accepted(parsed), quality.rejected(parsed)


def reason(spark, line):
    passed, failed = split(spark, [line])
    assert passed.count() + failed.count() == 1
    got = failed.select("quarantine_reason").collect()
    return got[0][0] if got else None


def test_passing_rows_and_byte_delta(spark):
    new = raw("n", type="new", length={"new": 70})
    passed, failed = split(spark, [raw("a"), new])
    assert rows(passed, "event_id", "byte_delta") == [("a", 50), ("n", None)]
    assert failed.count() == 0


def test_reasons_in_first_match_order(spark):
    assert reason(spark, raw(bot=True, wiki="dewiki")) == "bot"
    assert reason(spark, raw(wiki="dewiki")) == "non_enwiki"
    assert reason(spark, raw(wiki="dewiki", drop=["bot"])) == "non_enwiki"
    assert reason(spark, raw(type="log")) == "non_edit_type"
    assert reason(spark, raw(drop=["type"])) == "non_edit_type"
    assert reason(spark, raw(namespace=1)) == "non_article_namespace"
    assert reason(spark, raw(namespace="x")) == "non_article_namespace"
    assert reason(spark, raw(drop=["bot"])) == "unknown"
    assert reason(spark, "{bad json") == "parse_failure"
    assert reason(spark, "") == "parse_failure"
    assert reason(spark, raw(drop=["meta.id"], bot=True)) == "parse_failure"
    assert reason(spark, raw(drop=["meta.id"])) is None  # passes without an id


def test_null_line_is_a_parse_failure(spark):
    df = spark.createDataFrame([(None,)], "raw_json string")
    assert rows(quality.rejected(parse_events(df)), "event_id", "quarantine_reason") == [(None, "parse_failure")]


def test_log_params_keep_their_shape(spark):
    lines = [
        raw("o", type="log", log_params={"a": [1, 2]}), raw("l", type="log", log_params=[1, "x"]),
        raw("s", type="log", log_params="text"), raw("n", type="log", log_params=7), raw("z", type="log"),
        raw("j", type="log", log_params=None),
    ]
    got = dict(rows(parse_events(bronze(spark, lines)), "event_id", "log_params"))
    assert got == {"o": '{"a":[1,2]}', "l": '[1,"x"]', "s": "text", "n": "7", "z": None, "j": None}


def test_mistyped_field_nulls_only_itself(spark):
    row = parse_events(bronze(spark, [raw(namespace="x")])).first()
    assert row["namespace"] is None and row["title"] == "Page" and row["event_id"] == "e1"


def test_parsed_schema_is_the_contract(spark):
    want = spark.createDataFrame([], c.PARSED_DDL).dtypes
    assert parse_events(bronze(spark, [raw()])).dtypes == want


def test_line_is_parsed_once(spark):
    plan = split(spark, [raw()])[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_expectations_drop_warn_and_count(spark):
    lines = [
        raw("ok"), raw("t", drop=["title"]), raw("u", drop=["user"]),
        raw("big", length={"old": 0, "new": 10_000_001}), raw("edge", length={"old": 10_000_000, "new": 0}),
    ]
    passed, _ = split(spark, lines)
    assert rows(quality.enforce(passed), "event_id") == [("big",), ("edge",), ("ok",)]
    report = rows(quality.expectation_report(passed), "expectation", "kind", "passed", "failed")
    assert report == [
        ("byte_delta_plausible", "warn", 4, 1), ("title_not_null", "drop", 4, 1), ("user_not_null", "drop", 4, 1)]


def test_null_ids_count_as_one_and_conservation_adds_up(spark):
    lines = [
        raw("a"), raw("a"), raw(drop=["meta.id"]), raw(drop=["meta.id"]), raw("t", drop=["title"]),
        raw("b", bot=True), "{bad",
    ]
    b = bronze(spark, lines)
    parsed = parse_events(b)
    silver = quality.enforce(quality.clean(parsed))
    assert rows(silver, "event_id") == [("a",), (None,)]
    got = quality.conservation(b, silver, quality.rejected(parsed)).first().asDict()
    assert got == {"bronze": 7, "silver": 2, "quarantine": 2, "duplicates": 2, "dropped": 1, "unexplained": 0}


def test_small_functions(spark):
    df = spark.createDataFrame([(0, 5), (4, None), (7, -3)], "ns int, d int")
    assert rows(df, namespace_label(F.col("ns")), signed_bytes(F.col("d"))) == [
        ("7", "-3"), ("article", "+5"), ("project", "n/a")]
    assert df.select(pct(F.lit(1), F.lit(0))).first()[0] is None
    assert df.select(pct(F.lit(1), F.lit(8))).first()[0] == 12.5


def test_byte_delta_profile_matches_builtin_percentile(spark):
    import random

    r = random.Random(3)
    values = [r.choice([r.randint(-2**31, 2**31 - 1), r.randint(-50, 50), 7]) for _ in range(999)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "byte_delta int")
    want = df.selectExpr(
        "percentile(byte_delta, 0.5) a", "percentile(byte_delta, 0.95) b", "min(byte_delta) c", "max(byte_delta) d").first()
    got = checks.byte_delta_profile(df).first()
    assert (got["p50_delta"], got["p95_delta"]) == (want["a"], want["b"])
    assert (got["min_delta"], got["max_delta"], got["null_delta_rows"]) == (want["c"], want["d"], 5)
    empty = checks.byte_delta_profile(df.limit(0)).first()
    assert empty["p50_delta"] is None and empty["null_delta_rows"] == 0


def test_consistency_on_empty_tables(spark):
    b = bronze(spark, [raw()]).limit(0)
    parsed = parse_events(b)
    gold = spark.createDataFrame([], c.GOLD_DDL)
    got = checks.consistency(b, quality.clean(parsed), quality.rejected(parsed), gold).first()
    assert (got["bronze"], got["silver_pct"], got["gold_events"]) == (0, None, None)
