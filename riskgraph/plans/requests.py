"""Scoring of request tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskgraph.functions import rules

# What an absent request field stands for.
DEFAULTS = {"merchant_category": "general", "entry_mode": "chip", "hour": 12, "day_of_week": 0}


def with_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in DEFAULTS.items()})


def is_valid():
    needed = [F.col(c).isNotNull() for c in ("transaction_id", "account_id", "merchant_id", "device_id", "timestamp")]
    ok = F.coalesce(F.col("amount") > 0, F.lit(False)) & F.col("hour").between(0, 23) & F.col("day_of_week").between(0, 6)
    for c in needed:
        ok = ok & c
    return ok


def score_requests(df: DataFrame) -> DataFrame:
    """One response row per request; an invalid one has status `error` and no scores.

    Levels and flags are decided on the unrounded probability.
    """
    out = with_defaults(df).withColumn("_ok", is_valid()).withColumn(
        "_p", rules.rule_probability(F.col("amount"), F.col("hour"), F.col("day_of_week"))
    )
    p = F.col("_p")

    def scored(value):
        return F.when(F.col("_ok"), value)

    return out.select(
        "transaction_id",
        scored(F.round(p, 4)).alias("fraud_probability"),
        scored(rules.risk_level(p)).alias("fraud_risk_level"),
        scored(p > 0.5).alias("graph_risk_flag"),
        scored(F.lit(False)).alias("fraud_ring_flag"),
        scored(F.round(p, 4)).alias("investigation_priority"),
        scored(rules.priority_level(p)).alias("priority_level"),
        F.when(F.col("_ok"), "success").otherwise("error").alias("status"),
    )


def respond_with_model(df: DataFrame, probability: str = "fraud_probability") -> DataFrame:
    """Response rows of the model path, with its three-level priority."""
    p = F.col(probability)
    return df.select(
        "transaction_id",
        F.round(p, 4).alias("fraud_probability"),
        rules.risk_level(p).alias("fraud_risk_level"),
        (p > 0.5).alias("graph_risk_flag"),
        F.lit(False).alias("fraud_ring_flag"),
        F.round(p, 4).alias("investigation_priority"),
        rules.model_priority_level(p).alias("priority_level"),
    )


def request_features(df: DataFrame) -> DataFrame:
    """The eleven columns a request is scored on; graph columns are placeholders."""
    hour, dow = F.col("hour"), F.col("day_of_week")
    return with_defaults(df).select(
        "transaction_id", "amount", "hour", "day_of_week",
        F.log1p("amount").alias("amount_log"),
        rules.is_night(hour).alias("is_night"),
        rules.flag(dow >= 5).alias("is_weekend"),
        *[
            F.lit(0).alias(c)
            for c in ("node_degree", "pagerank_score", "community_id", "fraud_ring_flag", "shared_device_flag")
        ],
    )
