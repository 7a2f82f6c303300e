"""From raw documents to packed training sequences, one landed table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from windrow.llm import exact_dedup, packing, quality, secret_scan, simhash
from windrow.llm.common import land, module_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is learned from ``labels`` and the documents themselves."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, the one with the smallest id."""
    return simhash.keep_first(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets put as a mark and their number of characters counted anew."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and its place there."""
    return packing.pack_documents(docs, module_file("word_bpe_49k.json"), special=True)


#: Each function takes (spark, docs, sf_dir); its rows are written and read again as the next one's docs.
STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL cannot express the stages; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name)
    return docs
