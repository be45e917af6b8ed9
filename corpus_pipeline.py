"""A corpus pipeline of the operators in `star_marts.llm`.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept.  All but the last
return the columns of `documents`.  Every stage is defined for empty input, nulls and extra columns
as its operator is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from star_marts.llm import byte_bpe, secret_scan, simhash_dedup, source_mixing, toxicity
from star_marts.llm.common import table
from star_marts.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id."""
    return simhash_dedup.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is masked; no document goes."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: whole, cut, repeated or left out."""
    return source_mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, and digests of the ids and of what they decode to."""
    return byte_bpe.digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Scores of a trained network and byte-pair ids are beyond SQL; the tests hold the stages against
#: plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`; each result is stored and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
