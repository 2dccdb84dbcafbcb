"""The operators as registered queries over the whole test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.llm import (
    collocations, combination_join, latent_retrieval, license_join, piece_lattice, quality_rules, recurrent_lm, rendezvous,
    rule_ensemble, sentence_spans, separator_scan, simhash_grid, whitening,
)
from lakemill.llm.frames import documents

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


@query
def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separator_scan.token_counts(spark, documents(spark, sf_dir)).select("doc_id", "n_tokens")


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, p = piece_lattice.encoded(spark, documents(spark, sf_dir), piece_lattice.load_pieces())
    return found.select(
        "doc_id", F.size(f"{p}ids").alias("n_pieces"), F.col(f"{p}ids").alias("ids"),
        F.col("text").eqNullSafe(F.col(f"{p}decoded")).alias("round_trip"))


@query
def op3_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.scored(spark, documents(spark, sf_dir))


@query
def op4_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    records = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    shards = rendezvous.sharded(records, "doc_id", weights=[1.0] * 8, grown=[1.0] * 9)
    return shards.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scanned(spark, documents(spark, sf_dir))


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = rule_ensemble.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found, p = rule_ensemble.scored(docs.select("doc_id", "text"), model)
    return found.select("doc_id", *[F.col(f"{p}{c}").alias(c) for c in ("held_out", "score", "predicted")])


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut, p = sentence_spans.without_repeats(spark, documents(spark, sf_dir))
    return cut.select(
        "doc_id", "text", F.col(f"{p}sentences").alias("n_sentences"), F.col(f"{p}removed").alias("n_removed_sentences"),
        F.col(f"{p}words").alias("n_removed_words"))


@query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found, p = latent_retrieval.searched(spark, documents(spark, sf_dir), benchmark)
    return found.select("doc_id", *[F.col(f"{p}{c}").alias(c) for c in (
        "candidates", "hits", "item_id", "cosine", "ordered_share", "contaminated")])


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged, p = quality_rules.judged_documents(documents(spark, sf_dir), labels)
    return judged.select(
        "doc_id", *[F.col(f"{p}{c}").alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


@query
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combination_join.near_duplicates(spark, documents(spark, sf_dir), width=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


@query
def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_grid.near_duplicates(spark, documents(spark, sf_dir), width=4, distance=4)


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, documents(spark, sf_dir), least=100, top=2000)
