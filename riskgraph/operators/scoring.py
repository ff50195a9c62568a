"""From a probability to risk level, flags and investigation priority."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskgraph.functions import rules


def score_by_rules(df: DataFrame, keep_exact: bool = False) -> DataFrame:
    """`fraud_probability` without a model, rounded to 4 places; `_exact` is the unrounded sum."""
    out = df.withColumn("_exact", rules.rule_probability(F.col("amount"), F.col("hour"), F.col("day_of_week")))
    out = out.withColumn("fraud_probability", F.round("_exact", 4))
    return out if keep_exact else out.drop("_exact")


def assign_risk_levels(df: DataFrame) -> DataFrame:
    return df.withColumn("fraud_risk_level", rules.risk_level(F.col("fraud_probability")))


def risk_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("fraud_risk_level").agg(F.count(F.lit(1)).alias("txn_count"))


def add_graph_flags(df: DataFrame) -> DataFrame:
    """`graph_risk_flag`: ring, shared device or suspicious; a missing column counts as 0."""
    for c in ("fraud_ring_flag", "shared_device_flag"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0))
    hit = (F.col("fraud_ring_flag") == 1) | (F.col("shared_device_flag") == 1)
    if "suspicious_flag" in df.columns:
        hit = hit | (F.col("suspicious_flag") == 1)
    return df.withColumn("graph_risk_flag", rules.flag(hit))


def investigation_priority(df: DataFrame) -> DataFrame:
    def optional(c: str):
        return F.col(c) if c in df.columns else F.lit(0)

    score = rules.priority_score(F.col("fraud_probability"), optional("graph_risk_flag"), optional("fraud_ring_flag"))
    out = df.withColumn("investigation_priority", score)
    return out.withColumn("priority_level", rules.priority_level(F.col("investigation_priority")))


def scoring(df: DataFrame, model=None) -> DataFrame:
    """All steps. `fraud_probability` comes from the model, else from the column already
    there, else from the rules."""
    if model is not None:
        df = model.score(df)
    elif "fraud_probability" not in df.columns:
        df = score_by_rules(df)
    return df.transform(assign_risk_levels).transform(add_graph_flags).transform(investigation_priority)


def with_final_score(df: DataFrame) -> DataFrame:
    graph = F.col("graph_risk_flag") if "graph_risk_flag" in df.columns else F.lit(0)
    return df.withColumn(
        "final_risk_score", rules.final_risk_score(F.col("fraud_probability"), F.col("anomaly_score"), graph)
    )


def high_risk(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.where(F.col("fraud_probability") >= threshold).orderBy(F.desc("fraud_probability"), "transaction_id")


def suspicious_communities(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("community_id").agg(
            F.count("transaction_id").alias("transaction_count"),
            F.avg("fraud_probability").alias("avg_fraud_prob"),
            F.sum("is_fraud").alias("confirmed_fraud_count"),
            F.sum("fraud_ring_flag").alias("fraud_ring_count"),
        )
        .withColumn("community_risk_level", rules.community_level(F.col("avg_fraud_prob")))
        .orderBy(F.desc("avg_fraud_prob"), "community_id")
    )
