"""Report queries over a scored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskgraph.functions import rules
from riskgraph.operators.property_graph import top_distinct


def _share(part: Column, whole: Column) -> Column:
    """Percentage, 0 on an empty table."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def _high() -> Column:
    return F.coalesce(F.sum(F.when(F.col("fraud_risk_level") == "HIGH", 1)), F.lit(0))


def summary_stats(df: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("total_transactions"),
        F.coalesce(F.sum("is_fraud"), F.lit(0)).alias("total_frauds"),
        F.round(_share(F.sum("is_fraud"), rows), 2).alias("fraud_rate"),
        F.round(F.coalesce(F.avg("fraud_probability") * 100, F.lit(0.0)), 2).alias("avg_fraud_probability"),
        F.coalesce(F.sum(F.when(F.col("fraud_probability") > 0.8, 1)), F.lit(0)).alias("high_risk_count"),
        F.count_distinct("account_id").alias("unique_accounts"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
        F.count_distinct("device_id").alias("unique_devices"),
    )


def top_high_risk(df: DataFrame, threshold: float = 0.5, limit: int = 100) -> DataFrame:
    return (
        df.where(F.col("fraud_probability") > threshold)
        .orderBy(F.desc("fraud_probability"), "transaction_id").limit(limit)
        .select("transaction_id", "timestamp", "amount", "account_id", "merchant_id", "fraud_probability")
    )


def dashboard_filter(df: DataFrame, levels: Sequence[str] = (), min_probability: float = 0.0) -> DataFrame:
    """Chosen risk levels (none chosen = all) at or above a probability."""
    if levels:
        df = df.where(F.col("fraud_risk_level").isin(*levels))
    return df.where(F.col("fraud_probability") >= min_probability)


def kpis(df: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("total_transactions"),
        _share(F.sum("is_fraud"), rows).alias("real_fraud_rate"),
        _share(_high(), rows).alias("predicted_fraud_rate"),
        F.coalesce(F.avg("fraud_probability") * 100, F.lit(0.0)).alias("avg_fraud_probability"),
        _high().alias("high_risk_count"),
        F.count_distinct("community_id").alias("communities"),
    )


def daily_trend(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.to_date("timestamp").alias("date"))
        .agg(
            F.count("transaction_id").alias("txn_count"),
            F.sum("is_fraud").alias("fraud_count"),
            F.avg("fraud_probability").alias("avg_probability"),
        )
        .withColumn("fraud_rate", F.col("fraud_count") / F.col("txn_count") * 100)
    )


def probability_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Count per equal bin of [0, 1]; empty bins are listed with 0."""
    place = F.least(F.floor(F.col("fraud_probability") * bins), F.lit(bins - 1)).cast("bigint")
    counted = df.where(F.col("fraud_probability").isNotNull()).groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("txn_count")
    )
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return grid.join(counted, "bin", "left").select("bin", F.coalesce("txn_count", F.lit(0)).alias("txn_count"))


def community_risk(df: DataFrame, limit: int = 15) -> DataFrame:
    return (
        df.groupBy("community_id")
        .agg(F.avg("fraud_probability").alias("avg_prob"), F.count("transaction_id").alias("size"))
        .orderBy(F.desc("avg_prob"), "community_id").limit(limit)
        .withColumn("band", rules.community_band(F.col("avg_prob")))
    )


def hourly_volume(df: DataFrame) -> DataFrame:
    return df.groupBy(F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("txn_count"))


def search(
    df: DataFrame,
    account: str | None = None,
    merchant: str | None = None,
    device: str | None = None,
    transaction: str | None = None,
    regex: bool = False,
) -> DataFrame:
    """Case-insensitive search by parts of ids; a null id never matches."""
    for column, text in (
        ("account_id", account), ("merchant_id", merchant), ("device_id", device), ("transaction_id", transaction)
    ):
        if text:
            c = F.col(column)
            df = df.where(c.rlike(f"(?i){text}") if regex else F.lower(c).contains(text.lower()))
    return df.select(
        "transaction_id", "timestamp", "amount", "account_id", "merchant_id", "fraud_probability", "fraud_risk_level"
    ).orderBy(F.desc("fraud_probability"), "transaction_id")


def _of(df: DataFrame, account_id: str) -> DataFrame:
    return df.where(F.col("account_id") == account_id)


def account_overview(df: DataFrame, account_id: str) -> DataFrame:
    return _of(df, account_id).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("fraud_probability").alias("avg_probability"),
        _high().alias("high_risk_count"),
    )


def account_entities(df: DataFrame, account_id: str, limit: int = 10) -> DataFrame:
    """First distinct devices and merchants of an account, in order of appearance."""
    mine = _of(df, account_id)

    def part(kind: str, column: str) -> DataFrame:
        return top_distinct(mine, "account_id", column, limit).select(
            F.lit(kind).alias("kind"), F.col(column).alias("id"), F.col("_rank").alias("position")
        )

    return part("device", "device_id").unionByName(part("merchant", "merchant_id"))


def account_high_risk(df: DataFrame, account_id: str) -> DataFrame:
    return _of(df, account_id).where(F.col("fraud_risk_level") == "HIGH").select(
        "transaction_id", "timestamp", "amount", "fraud_probability", "fraud_risk_level"
    )


def ego_network(df: DataFrame, account_id: str, limit: int = 5) -> DataFrame:
    """Rows `node` (kind, id) and `edge` (account -> entity) around one account."""
    around = account_entities(df, account_id, limit).select("kind", "id")
    centre = _of(df, account_id).select(F.lit("account").alias("kind"), F.col("account_id").alias("id")).limit(1)
    nodes = centre.unionByName(around).select(
        F.lit("node").alias("element"), "kind", "id", F.lit(None).cast("string").alias("source")
    )
    edges = around.select(F.lit("edge").alias("element"), "kind", "id", F.lit(account_id).alias("source"))
    return nodes.unionByName(edges)


def top_accounts(df: DataFrame, limit: int = 10) -> DataFrame:
    return (
        df.where(F.col("fraud_risk_level") == "HIGH").groupBy("account_id")
        .agg(
            F.count("transaction_id").alias("txn_count"),
            F.avg("fraud_probability").alias("avg_probability"),
            F.sum("amount").alias("total_amount"),
        )
        .orderBy(F.desc("avg_probability"), "account_id").limit(limit)
    )


def transaction_lookup(df: DataFrame, transaction_id: str) -> DataFrame:
    order = "_seq" if "_seq" in df.columns else "timestamp"
    return df.where(F.col("transaction_id") == transaction_id).orderBy(order).limit(1).select(
        "transaction_id", "amount", "fraud_probability", "fraud_risk_level"
    )


def top_features(importance: DataFrame, limit: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("shap_importance"), "feature").limit(limit)
