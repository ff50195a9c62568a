"""Scalar business rules as column expressions (all stay inside code generation)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def day_of_week(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)


def is_weekend(dow: Column) -> Column:
    return flag(dow.isin(5, 6))


def is_night(hour: Column) -> Column:
    return flag((hour >= 22) | (hour <= 5))


# Upper edges of the amount bands, each band right-closed.
AMOUNT_EDGES = [10, 50, 100, 500, 1000]


def amount_bin(amount: Column) -> Column:
    """Band 0..5 for positive amounts, null otherwise."""
    band = F.when(amount <= 0, F.lit(None).cast("int"))
    for i, edge in enumerate(AMOUNT_EDGES):
        band = band.when(amount <= edge, F.lit(i))
    return band.when(amount.isNotNull(), F.lit(len(AMOUNT_EDGES)))


def risk_level(p: Column) -> Column:
    return F.when(p > 0.8, "HIGH").when(p > 0.4, "MEDIUM").otherwise("LOW")


def priority_level(score: Column) -> Column:
    return F.when(score > 0.7, "CRITICAL").when(score > 0.5, "HIGH").when(score > 0.3, "MEDIUM").otherwise("LOW")


def model_priority_level(p: Column) -> Column:
    """The three-level scale of the model path."""
    return F.when(p > 0.5, "HIGH").when(p > 0.3, "MEDIUM").otherwise("LOW")


def community_level(avg_p: Column) -> Column:
    return F.when(avg_p > 0.5, "HIGH").when(avg_p > 0.2, "MEDIUM").otherwise("LOW")


def community_band(avg_p: Column) -> Column:
    return F.when(avg_p > 0.5, "HIGH").when(avg_p > 0.3, "MEDIUM").otherwise("LOW")


def rule_probability(amount: Column, hour: Column, dow: Column) -> Column:
    """Model-free probability, unrounded.

    The terms are added as doubles in this order: thresholds further down compare
    the binary sum, so the order is part of the rule.
    """
    by_amount = F.when(amount > 500, 0.15).when(amount > 200, 0.08).otherwise(0.0)
    by_hour = F.when((hour >= 22) | (hour <= 5), 0.10).otherwise(0.0)
    by_day = F.when(dow >= 5, 0.05).otherwise(0.0)
    return F.least(F.lit(0.05) + by_amount + by_hour + by_day, F.lit(0.95))


def priority_score(p: Column, graph_flag: Column, ring_flag: Column) -> Column:
    return p * 0.6 + graph_flag * 0.2 + ring_flag * 0.2


def final_risk_score(p: Column, anomaly: Column, graph_flag: Column) -> Column:
    return p * 0.5 + anomaly * 0.3 + graph_flag * 0.2


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) fixed by the keys: the same on every retry and partitioning."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 52)).cast("double") / float(1 << 52)
