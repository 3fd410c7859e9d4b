"""Training-data pipeline over ``documents``: each stage is one operator on what the last one kept.

Null and empty texts fail the quality rules. Repeated rows are near-duplicates of each other, and
one stays. Null ids and sources are values like others. Further columns of the input are left
out. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import bpe, mixing, quality_rules, secret_scan, simhash
from shelfwatch.llm.common import materialise, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the policy in force rejects."""
    rows = quality_rules.apply_policy(quality_rules.ledger(docs.select(COLUMNS)), "v2")
    return rows.where("kept").select(COLUMNS)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component, the row with the smallest doc_id."""
    return simhash.keep_first(docs.select(COLUMNS), shingle=4, bits=4)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and ``n_chars`` counted anew."""
    clean = secret_scan.redact(docs.select(COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that each source's words meet its target."""
    return mixing.mix(docs.select(COLUMNS))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every row as little-endian 32-bit integers, and the text they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = bpe.encode(docs.select("doc_id", "source", "text"), path, decoded="decoded").withColumn("exact", F.col("decoded") == F.coalesce("text", F.lit("")))
    return rows.select("doc_id", "source", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids", "exact")


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", dedup_stage),
    ("secret scan", secrets_stage),
    ("mixing", mixing_stage),
    ("bpe encoding", encoding_stage),
]

#: the stages iterate and encode, which SQL cannot state
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
