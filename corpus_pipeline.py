"""From raw documents to token ids in five stages, each written before the next.

Every stage takes all that the one before it kept, with the columns of
documents, and decides on whole texts. The last one returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.llm import decontam, exactdup, neardup, pieces, quality
from parcelmill.llm.common import learn_row, stage, table
from parcelmill.llm.registry import QUALITY_FOLD

#: The columns of documents, which every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more stay; a null text counts as empty."""
    docs = docs.select(*COLUMNS)
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, "quality", learn_row("doc_id", *QUALITY_FOLD))
    return quality.score(docs, model, name="quality_score").where("quality_score >= 0.5").select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exactdup.drop_copies(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return neardup.drop_near(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding gives the text back."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode_and_decode(docs.select(*COLUMNS), model)
    return rows.select(
        "doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode_pieces", encode_pieces),
]

#: Trees, alignments and shortest paths have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
