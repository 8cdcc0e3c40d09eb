"""The dealt operators as queries of (spark, sf_dir), with their SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    decontaminate, hmm, huffman, imatch, langid, lattice, licenses, negatives, ngram_join, packing, quality, urls, whitening,
)
from tidegauge.llm.common import fold, table
from tidegauge.llm.oracles import ORACLES  # noqa: F401  the SQL of this module's queries
from tidegauge.session import scratch_path


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack_digest(packed: DataFrame) -> DataFrame:
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 3) == 1
    labelled = docs.filter(~held_out)
    return langid.with_language(docs.select("doc_id", "text"), labelled).select(
        "doc_id", held_out.alias("held_out"), "language.*"
    )


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 1
    return hmm.scores(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT
    return quality.scored(docs, labels).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack_digest(packing.packed_pieces(docs, tokenizer_file("byte_bpe_50k.json")))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    huffman.write_ids(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"))
    digest = huffman.read_ids(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return huffman.with_starts(digest, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_classes(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whitened(table(spark, sf_dir, "embeddings"))
    # a deviation beyond a long is NULL here; ``deviation_exact`` has it
    return out.select(
        "vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_exact"),
    )


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.document_fingerprints(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0).drop("positive_rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_licenses": op2_licenses,
    "op3_language": op3_language,
    "op4_embeddings": op4_embeddings,
    "op5_language_model": op5_language_model,
    "op6_quality": op6_quality,
    "op7_pack": op7_pack,
    "op8_urls": op8_urls,
    "op9_token_ids": op9_token_ids,
    "op10_ngram_join": op10_ngram_join,
    "op11_whitening": op11_whitening,
    "op12_fingerprints": op12_fingerprints,
    "op13_hard_negatives": op13_hard_negatives,
}
