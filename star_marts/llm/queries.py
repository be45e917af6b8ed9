"""The registered queries: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from star_marts.llm import (
    attention_lm,
    bit_sliced_topk,
    byte_bpe,
    exact_dedup,
    hard_negatives,
    secret_scan,
    simhash_dedup,
    source_mixing,
    spelling_variants,
    substring_dedup,
    toxicity,
    vantage_points,
    warc_store,
)
from star_marts.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_sentences", "n_removed")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("digest")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(table(spark, sf_dir, "documents"))


def op6_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return bit_sliced_topk.top_k(rows, rows.filter(F.col("vec_id") % bit_sliced_topk.QUERY_EVERY == 0))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_content_addressed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_store.archive_round_trip(table(spark, sf_dir, "pages"))


def op9_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vantage_points.nearest(rows, rows.filter(F.col("vec_id") % vantage_points.QUERY_EVERY == 0))


def op10_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_toxicity, op3_simhash_near_dedup, op4_byte_bpe, op5_source_mixing, op6_bit_sliced_topk,
        op7_secret_scan, op8_content_addressed_warc, op9_vantage_points, op10_attention_lm, op11_spelling_variants, op12_exact_dedup,
        op13_hard_negatives,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.ORACLE_SQL,
    "op5_source_mixing": source_mixing.ORACLE_SQL,
    "op6_bit_sliced_topk": bit_sliced_topk.ORACLE_SQL,
    "op8_content_addressed_warc": warc_store.ORACLE_SQL,
    "op11_spelling_variants": spelling_variants.ORACLE_SQL,
    "op12_exact_dedup": exact_dedup.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
