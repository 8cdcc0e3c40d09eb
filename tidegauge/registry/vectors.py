"""Vector operators over the ``embeddings`` and ``documents`` tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators import vector_index
from tidegauge.operators.metric_index import MetricIndex
from tidegauge.registry.core import query
from tidegauge.session import scratch_path
from tidegauge.sources.tables import written

KEY, VECTOR = "vec_id", "embedding"

# The cosine as the SQL side computes it; equal to the digit the operators compare at.
PAIRS = """
    pairs AS (SELECT q.vec_id AS q, s.vec_id AS s,
                     round(list_cosine_similarity(q.embedding::DOUBLE[], s.embedding::DOUBLE[]), 9) AS score
              FROM {queries} q, embeddings s)"""


@query("v3_similarity_search", """
    WITH seed AS (SELECT * FROM embeddings WHERE vec_id = (SELECT max(vec_id) FROM embeddings)),"""
       + PAIRS.format(queries="seed") + """
    SELECT s AS vec_id, label, round(score, 6) AS score FROM pairs JOIN embeddings ON s = vec_id
    ORDER BY pairs.score DESC, s LIMIT 10""")
def _(m):
    e = m.table("embeddings")
    seed = e.filter(F.col(KEY) == e.agg(F.max(KEY)).scalar()).select(VECTOR).scalar()
    found = vector_index.similarity_search(e, seed, 10, [KEY, "label"], VECTOR, KEY)
    return found.withColumn("score", F.round("score", 6))


def metric_index(m, rows):
    index = MetricIndex(m.spark, scratch_path(m.spark, "metric-index"), KEY, VECTOR)
    index.build(rows)
    return index


@query("v3_metric_search", """
    WITH seed AS (SELECT * FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings)),"""
       + PAIRS.format(queries="seed") + """
    SELECT s AS vec_id, label, round(score, 6) AS score FROM pairs JOIN embeddings ON s = vec_id
    ORDER BY pairs.score DESC, s LIMIT 10""")
def _(m):
    """The same search on a stored index, which reads the cells that can hold a result."""
    e = m.table("embeddings")
    seed = e.filter(F.col(KEY) == e.agg(F.min(KEY)).scalar()).select(VECTOR).first()[0]
    return metric_index(m, e).search(seed, 10, [KEY, "label"]).withColumn("score", F.round("score", 6))


@query("v2_metric_upsert", """
    WITH seed AS (SELECT * FROM embeddings WHERE vec_id = (SELECT max(vec_id) FROM embeddings)),"""
       + PAIRS.format(queries="seed") + """
    SELECT s AS vec_id, label, round(score, 6) AS score, (SELECT count(*) FROM embeddings) AS indexed
    FROM pairs JOIN embeddings ON s = vec_id ORDER BY pairs.score DESC, s LIMIT 10""")
def _(m):
    """An index whose rows are partly missing and partly of an older state, brought up to date: changed rows are found,
    what they replaced is not."""
    e = m.table("embeddings")
    older = e.filter(F.col(KEY) % 5 != 0).withColumn(VECTOR, F.when(F.col(KEY) % 3 == 0, F.reverse(VECTOR)).otherwise(F.col(VECTOR)))
    index = metric_index(m, older)
    for _ in range(2):  # the second run has nothing to do
        index.upsert(e, F.col(VECTOR), F.col(KEY))
    seed = e.filter(F.col(KEY) == e.agg(F.max(KEY)).scalar()).select(VECTOR).first()[0]
    return index.search(seed, 10, [KEY, "label"]).withColumns(
        {"score": F.round("score", 6), "indexed": F.lit(index.live().count())})


@query("v4_nearest_neighbours", "WITH" + PAIRS.format(queries="embeddings") + """
    SELECT q AS key, s AS neighbour, round(score, 6) AS score,
           CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, s) AS INTEGER) AS place
    FROM pairs QUALIFY place <= 3""")
def _(m):
    e = m.table("embeddings")
    return vector_index.nearest_neighbours(e, e, 3, KEY, VECTOR).withColumn("score", F.round("score", 6))


@query("v5_related_events", """
    WITH seed AS (SELECT * FROM embeddings ORDER BY label DESC, vec_id DESC LIMIT 1),"""
       + PAIRS.format(queries="seed") + """,
    found AS (SELECT * FROM pairs ORDER BY score DESC, s LIMIT 6)
    SELECT s AS vec_id, label, round(score, 6) AS score FROM found JOIN embeddings ON s = vec_id WHERE s <> q""")
def _(m):
    found = vector_index.related_events(
        m.table("embeddings"), 6, [KEY, "label"], ("label", "vec_id"), VECTOR, KEY)
    return found.withColumn("score", F.round("score", 6))


NOVELTY = """
    WITH""" + PAIRS.format(queries="embeddings") + """,
    best AS (SELECT q, s, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, s) AS place
             FROM pairs WHERE q <> s QUALIFY place = 1)
    SELECT q AS vec_id, score < {threshold} AS is_novel, round(score, 6) AS score, s AS neighbour FROM best"""


@query("v6_novelty", NOVELTY.format(threshold=0.75))
def _(m):
    e = m.table("embeddings")
    return vector_index.novelty(e, e, key=KEY).withColumn("score", F.round("score", 6))


@query("v6_novelty_low_threshold", NOVELTY.format(threshold=0.4))
def _(m):
    e = m.table("embeddings")
    return vector_index.novelty(e, e, threshold=0.4, key=KEY).withColumn("score", F.round("score", 6))


@query("v6_novelty_with_titles", """
    WITH""" + PAIRS.format(queries="embeddings") + """,
    best AS (SELECT q, s, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, s) AS place
             FROM pairs WHERE q <> s QUALIFY place = 1)
    SELECT q AS vec_id, score < 0.75 AS is_novel, round(score, 6) AS score, s AS neighbour, label AS neighbour_label
    FROM best JOIN embeddings ON vec_id = s""")
def _(m):
    e = m.table("embeddings")
    return vector_index.novelty(e, e, key=KEY, show=["label"]).withColumn("score", F.round("score", 6))


@query("v1_embed_documents")
def _(m):
    return vector_index.embed(m.table("documents").select("doc_id", "text"), "text").select(
        "doc_id", F.transform("embedding", lambda x: F.round(x.cast("double"), 6)).alias("embedding"))


def documents_as_summaries(m):
    """Documents in the shape of summaries: their texts are the only long prose among the tables."""
    return m.table("documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("source").alias("title"),
        F.col("n_chars").cast("double").alias("z_score"), F.col("text").alias("summary"),
        F.timestamp_seconds("doc_id").alias("generated_at"))


@query("v2_index_sync", "SELECT CAST(doc_id AS VARCHAR) AS id, source AS title FROM documents")
def _(m):
    """Sync one language first, then everything: the second sync adds only what is missing."""
    docs = documents_as_summaries(m)
    first = vector_index.index_additions(docs.filter(F.col("title") == "src0"))
    rest = vector_index.index_additions(docs, first)
    return first.unionByName(rest).select("id", "title")


@query("v3_text_search")
def _(m):
    index = written(vector_index.index_additions(documents_as_summaries(m)), "index")
    weights = vector_index.word_weights(vector_index.slot_frequencies(index))
    found = vector_index.search_text(index, "the elections and the results", 8, weights=weights)
    return found.withColumn("score", F.round("score", 6))


@query("v6_novelty_of_texts")
def _(m):
    """Which documents are like none that came before, by their words and how much these tell."""
    index = written(vector_index.index_additions(documents_as_summaries(m)), "index")
    weights = vector_index.word_weights(vector_index.slot_frequencies(index))
    return vector_index.novelty(index, index, weights=weights).withColumn("score", F.round("score", 6))


@query("v2_rewritten_summaries", """
    SELECT CAST(doc_id AS VARCHAR) AS id, source AS title, md5(CASE WHEN doc_id % 4 = 0 THEN 'again ' || text ELSE text END) AS told
    FROM documents""")
def _(m):
    """A quarter of the summaries is rewritten after a first sync: the second one indexes these, and they replace the others."""
    docs = documents_as_summaries(m)
    index = written(vector_index.index_additions(docs), "index")
    later = docs.filter(F.col("id").cast("bigint") % 4 == 0).withColumns({
        "summary": F.concat(F.lit("again "), "summary"), "generated_at": F.col("generated_at") + F.expr("INTERVAL 1 DAY")})
    more = vector_index.index_additions(docs.unionByName(later), index)
    now = vector_index.current_index(index.unionByName(more))
    return now.select("id", "title", F.md5(F.col("summary").cast("binary")).alias("told"))
