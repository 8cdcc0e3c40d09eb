"""The pipeline, stage by stage, against plain versions of what each stage decides."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F
from test_decontaminate import plain as contaminated
from test_ngram_join import by_all_pairs
from test_tokens import check_packing

from tidegauge.llm import langid, queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_stages(spark, sf, tmp_path):
    # some rows twice and some odd ones, on top of the table
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "x", 0), (10**6 + 1, "", None, "x", 0), (None, "le the der", None, None, None)], docs.schema)
    docs = docs.unionByName(docs.limit(5)).unionByName(odd).select(*COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    docs, held = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        held[name] = docs.collect()
        out = f"{tmp_path}/out-{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "packing":
            assert docs.columns == COLUMNS
    stages = [n for n, _ in corpus_pipeline.STAGES]
    assert stages == ["quality", "language", "near_copies", "benchmark", "packing"]

    marks = {(r.doc_id): r.predicted for r in queries.op6_quality(spark, str(tmp_path)).collect()}
    assert sorted(map(repr, held["language"])) == sorted(repr(r) for r in held["quality"] if marks[r.doc_id])

    learned = [r for r in held["language"] if r.lang is not None]
    contents = langid.dictionaries(
        spark.createDataFrame(learned, docs_schema(spark, sf)).filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1)
    )
    model = langid.Classifier(contents)
    assert sorted(map(repr, held["near_copies"])) == sorted(repr(r) for r in held["language"] if not model.judge(r.text)[3])

    distinct = {(r.doc_id, r.text) for r in held["near_copies"] if r.doc_id is not None}
    classes = by_all_pairs(sorted(distinct, key=repr), corpus_pipeline.NEAR_WIDTH, corpus_pipeline.NEAR_PERCENT)
    assert (corpus_pipeline.NEAR_WIDTH, corpus_pipeline.NEAR_PERCENT) == (5, 80)
    kept = sorted(r.doc_id for r in held["benchmark"] if r.doc_id is not None)
    assert kept == sorted(d for d, _, top in classes if d == top)
    assert sum(r.doc_id is None for r in held["benchmark"]) == sum(r.doc_id is None for r in held["near_copies"])

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {d for d, *_, flag in contaminated([(r.doc_id, r.text) for r in held["benchmark"]], items) if flag}
    assert bad and {r.doc_id for r in held["packing"]} == {r.doc_id for r in held["benchmark"]} - bad

    used, least = check_packing(docs.collect(), {r.doc_id: r.text for r in held["packing"]})
    assert used <= least * 1.03 + 1
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def docs_schema(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select(*COLUMNS).schema


def test_empty_tables(spark, sf, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_extra_columns_with_names_of_the_stages_own(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    extra = {c: F.concat(F.lit(c), F.col("doc_id")) for c in ("kept", "_key", "_text", "_row", "row", "language", "node", "stats", "score")}
    docs.withColumns(extra).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = f"{tmp_path}/out-{name}"
        stage(spark, now, str(tmp_path)).write.parquet(out)
        now = spark.read.parquet(out)
        assert now.columns == [*COLUMNS, *extra]
        assert all(r[c] == f"{c}{r.doc_id}" for r in now.collect() for c in extra)
    assert now.count() > 0
