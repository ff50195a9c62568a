"""A training-data pipeline over `documents`: five stages, each an operator of `riskgraph.llm`."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskgraph.llm import bpe, exact_dedup, mixing, quality, simhash
from riskgraph.llm.common import start, table
from riskgraph.llm.queries import RANKS
from riskgraph.session import materialise


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    start(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    start(spark)
    return exact_dedup.keep_winners(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    start(spark)
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is taken to its target: a document goes, stays or stands twice."""
    start(spark)
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, ids, n_tokens): the ids of every text that is left."""
    start(spark)
    return bpe.encode_ids(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level bpe", encode),
]

#: A trained classifier and a knapsack are no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
