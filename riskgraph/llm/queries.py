"""The registered queries of this subpackage and the DuckDB text of those that SQL can state."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskgraph.llm import ann, bpe, exact_dedup, lm_scoring, merkle, mixing, packing, pii, prefix_trie, quality, reshard, simhash, suffix_dedup
from riskgraph.llm.common import table, text_bytes
from riskgraph.session import materialise, new_path

RANKS = "byte_bpe_multi_50k.tiktoken"
PACKING_TOKENIZER = "byte_bpe_50k.json"
#: The same vocabulary as ranks, for the faster encoder.
PACKING_RANKS = "byte_bpe_50k.tiktoken"
OLD_SHARDS, SHARDS = 32, 40


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("times")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout keeps a source together, so it is as uneven as the sources are. It is written as
    files, the files of the shards that change are rewritten, and sizes and shards are read from them."""
    old = F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")), F.lit(OLD_SHARDS))
    layout = reshard.lay_out(table(spark, sf_dir, "documents"), old, new_path(spark, "old-shards"))
    plan = materialise(reshard.reshard(layout, F.col("old_shard"), SHARDS))
    path = new_path(spark, "shards")
    affected = materialise(reshard.rewrite(layout, plan, path))
    found = reshard.read_back(layout, affected, path).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (text_bytes() + F.lit(reshard.ROW_BYTES)).alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"), "row", "shard")
    return found.join(plan.select("row", "shard", "slot", "old_shard"), ["row", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(*exact_dedup.halves(table(spark, sf_dir, "documents")))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How near each document is to the language of the conversations."""
    return lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether its tampered form still verifies."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations, with its subtree totals."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, placed in sequences of at most 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER),
                        public_tokenizers.path(PACKING_RANKS), public_tokenizers.PATTERN)


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_suffix_dedup, op3_mixing, op4_simhash_near_dedup, op5_resharding, op6_exact_dedup, op7_byte_bpe, op8_lm_scoring,
    op9_quality, op10_nearest, op11_merkle, op12_prefix_trie, op13_packing)}

ORACLES = {
    "op6_exact_dedup": """
WITH t AS (
 SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
 doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)""",
}
