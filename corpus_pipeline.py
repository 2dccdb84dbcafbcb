"""From raw documents to token ids: each stage works on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a frame, which is written and reread as the next one's docs.
All but the last return the columns of their input.

Defined cases, as each operator has them: a null or empty text fails the quality rules and goes first; repeated rows (same id,
same text) are one document from the second stage on; rows without an id are kept by their text; an empty table passes
through empty; very long texts are handled whole; of a group of near copies the one with the least id stays. Working columns of a
stage stand behind a prefix that no column has; columns named like the last stage's results are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemill.llm import combination_join, latent_retrieval, piece_lattice, quality_rules, sentence_spans
from lakemill.llm.frames import documents, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules calibrated on the labelled ones among them."""
    judged, p = quality_rules.judged_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.filter(F.col(f"{p}kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return combination_join.one_per_group(spark, docs, width=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without sentences that repeat; a document of which nothing is left goes, ``n_chars`` follows the text."""
    cut, p = sentence_spans.without_repeats(spark, docs)
    left = cut.filter((F.col(f"{p}removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.col(f"{p}removed") > 0
    columns = [
        F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c in docs.columns]
    return left.select(*columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found, p = latent_retrieval.searched(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(~F.col(f"{p}contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding gives the text back."""
    found, p = piece_lattice.encoded(spark, docs, piece_lattice.load_pieces())
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("ids", "n_pieces", "round_trip")],
        F.col(f"{p}ids").alias("ids"), F.size(f"{p}ids").alias("n_pieces"),
        F.col("text").eqNullSafe(F.col(f"{p}decoded")).alias("round_trip"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substrings),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", pieces),
]
ORACLE_SQL = None  # binomial bounds, a singular value decomposition and subword merges are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
