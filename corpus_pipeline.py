"""The training-data pipeline: quality, near copies, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns the next one's documents; the
last returns where each piece of a document lies in the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brookmart.llm import decontaminate, neardup, packing, rules, secrets
from brookmart.llm.common import stored, table
from brookmart.llm.tokens import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL has neither the tokenizer nor the packing.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes failing lines out, and documents that fail or lose too much."""
    return rules.clean(docs).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of fingerprints linked at four bits or fewer."""
    return neardup.deduplicate(docs).select(*COLUMNS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out documents with a passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def secret_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark."""
    return secrets.redact(docs).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of what is left."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("near copies", near_copies),
    ("benchmark passages", benchmark_passages),
    ("secrets", secret_strings),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
