"""Candidate fraud rings: neighbours with common merchants and similar amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskgraph.functions.rules import flag
from riskgraph.functions.skew import attach
from riskgraph.operators.sharing import Sharing, lowest_neighbours, sharing, visits
from riskgraph.session import materialise

MOST_NEIGHBOURS = 10


def fraud_rings(df: DataFrame, graph: Sharing | None = None) -> DataFrame:
    """account1, account2, shared_merchants, amount_similarity, ring_size.

    Each account is compared with its ten lowest-named neighbours, as the rule says;
    both directions of a pair may appear.
    """
    graph = graph or sharing(df)
    pairs = materialise(lowest_neighbours(df, MOST_NEIGHBOURS, graph.pairs))
    v = materialise(visits(df))
    first = v.withColumnRenamed("account_id", "account1")
    second = v.withColumnRenamed("account_id", "account2")
    common = attach(pairs, first, "account1", how="inner")
    common = attach(common, second, ["account2", "merchant_id"], how="left_semi")
    common = common.groupBy("account1", "account2").agg(F.count(F.lit(1)).alias("shared_merchants")).where(
        "shared_merchants >= 2"
    )
    means = materialise(
        df.groupBy("account_id").agg(F.avg("amount").alias("avg")).join(graph.degrees(), "account_id")
    )
    for i in ("1", "2"):
        side = means.select(
            F.col("account_id").alias(f"account{i}"), F.col("avg").alias(f"_avg{i}"),
            F.col("connected_accounts").alias(f"_deg{i}"),
        )
        common = attach(common, side, f"account{i}", how="inner")
    a, b = F.col("_avg1"), F.col("_avg2")
    apart = F.least(F.abs(a - b) / F.greatest(a, b, F.lit(1.0)), F.lit(1.0))
    return (
        common.withColumn("amount_similarity", 1 - apart).where("amount_similarity > 0.7")
        .select("account1", "account2", "shared_merchants", "amount_similarity",
                (F.col("_deg1") + F.col("_deg2")).alias("ring_size"))
    )


def ring_members(rings: DataFrame) -> DataFrame:
    """(account_id, fraud_ring_flag = 1) of every account on either side."""
    members = rings.select(F.col("account1").alias("account_id")).union(rings.select("account2")).distinct()
    return members.withColumn("fraud_ring_flag", F.lit(1))


def ring_flags(df: DataFrame, rings: DataFrame) -> DataFrame:
    """Transactions with `fraud_ring_flag` 0/1."""
    return attach(df, ring_members(rings), "account_id").withColumn(
        "fraud_ring_flag", flag(F.col("fraud_ring_flag") == 1)
    )
