"""Account-level graph features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskgraph.operators.sharing import Sharing, sharing


def node_features(df: DataFrame, graph: Sharing | None = None) -> DataFrame:
    """One row per account: activity, amounts (population deviation), reach and fraud."""
    graph = graph or sharing(df)
    stats = df.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        F.count(F.lit(1)).alias("node_degree"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
        F.coalesce(F.stddev_pop("amount"), F.lit(0.0)).alias("std_amount"),
        F.max("amount").alias("max_amount"),
        F.min("amount").alias("min_amount"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
        F.count_distinct("device_id").alias("unique_devices"),
        F.sum("is_fraud").cast("bigint").alias("fraud_count"),
    ).withColumn("fraud_rate", F.col("fraud_count") / F.col("node_degree"))
    return stats.join(graph.degrees(), "account_id")
