"""From raw documents to token ids in five stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.lines import dedup_lines
from tidemark.llm.mixing import mix
from tidemark.llm.near import keep_one_alike
from tidemark.llm.pieces import encode_pieces
from tidemark.llm.quality import quality_rules
from tidemark.session import configure, materialise


def with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """Rows with their text replaced, the length along with it, and only the columns of documents."""
    changed = docs.withColumn("text", F.col(text)).withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, and documents that fail the base rules or lose too much text. Null texts fail."""
    return with_text(quality_rules(docs).where("kept"), docs.columns, "clean_text")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go, and documents of which no line with a word is left."""
    left = dedup_lines(docs).where(F.col("dedup_text").rlike(r"[^\x20\x09-\x0D]"))
    return with_text(left, docs.columns, "dedup_text")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by five-word shingles alike to 0.8 or more, the one with the smallest doc_id stays."""
    return keep_one_alike(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions; a document taken twice has two rows."""
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, piece_ids and piece_offsets of every row."""
    encoded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    n_tokens = F.size("piece_ids").cast("long").alias("n_tokens")
    return encoded.select("doc_id", "source", n_tokens, "piece_ids", "piece_offsets")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("source mixing", mixing),
    ("SentencePiece encoding", encoding),
]

#: XXH64 and SentencePiece have no SQL; tests/llm compares the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
