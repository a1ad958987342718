"""From documents to packed training sequences: quality, near-duplicates, benchmark passages, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffcast.llm.common import free_name, numbered, read_table
from staffcast.llm.feistel import key_of, pseudonymized
from staffcast.llm.packing import pack, pieces
from staffcast.llm.positional import find_items
from staffcast.llm.rule_ensemble import score_quality
from staffcast.llm.simhash import near_duplicates
from staffcast.staging import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labelled ones among them, doesn't reject."""
    row = free_name(docs, "row")
    rows = stage(numbered(docs, row), "documents")
    scored, _ = score_quality(rows, "doc_id", "text", read_table(spark, sf_dir, "labels"), "doc_id", "quality", row=row)
    kept = scored.where("predicted = 1").select(F.col("kept.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    row = free_name(docs, "row")
    rows = stage(numbered(docs, row), "documents")
    groups = near_duplicates(rows, "doc_id", "text", row)
    return rows.join(groups.where("row = first_row").select(F.col("row").alias(row)), row, "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words in a row, or short item as a whole, of the benchmark."""
    row = free_name(docs, "row")
    rows = stage(numbered(docs, row), "documents")
    _, matches = find_items(rows, row, "text", read_table(spark, sf_dir, "benchmark"), "item_id", "text")
    return rows.join(matches.select(F.col("row").alias(row)).distinct(), row, "left_anti").select(*docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; ``n_chars`` follows them."""
    hidden = pseudonymized(docs, "text", key_of(spark))
    return hidden.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else hidden


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their ids, and the sequence and place of each."""
    parts = pieces(docs, "text", ["doc_id"], public_tokenizers.path("word_bpe_49k.json"), tokens=True)
    parts = parts.select(F.col("kept.doc_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "ids")
    return pack(parts, "length")


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("PII", hide_personal_data),
    ("best-fit packing", pack_sequences),
]

# The classifier, the fingerprints and the tokenizer are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
