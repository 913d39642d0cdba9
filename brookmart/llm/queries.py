"""The registered queries of this subpackage: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brookmart.llm import (
    collocations, decontaminate, linkgraph, lm, neardup, packing, pii, records, rules, secrets, tiledcosine, warc,
    whitening,
)
from brookmart.llm.common import table
from brookmart.llm.tokens import vocabulary


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary("byte_bpe_50k.json")).drop("ids")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).drop("clean_text")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return records.round_trip(docs, vocabulary("word_bpe_49k.json")).drop("ids")


def op4_character_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op5_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op6_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judge(table(spark, sf_dir, "pages"))


def op7_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op8_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.damaged_replica(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_sha256", "damaged")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.build_index(table(spark, sf_dir, "documents"))
    return decontaminate.search(index, table(spark, sf_dir, "benchmark")).drop("items")


def op11_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_tiled_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiledcosine.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_multiplicity_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).drop("deviation_wide", "n_rows")


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op3_token_records": op3_token_records,
    "op4_character_tagger": op4_character_tagger,
    "op5_secret_novelty": op5_secret_novelty,
    "op6_link_graph": op6_link_graph,
    "op7_deleted_interpolation": op7_deleted_interpolation,
    "op8_simhash_pigeonring": op8_simhash_pigeonring,
    "op9_warc_fixity": op9_warc_fixity,
    "op10_decontaminate": op10_decontaminate,
    "op2_quality_rules": op2_quality_rules,
    "op11_son_collocations": op11_son_collocations,
    "op12_tiled_cosine": op12_tiled_cosine,
    "op13_multiplicity_whitening": op13_multiplicity_whitening,
}
