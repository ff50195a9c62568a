"""Explicit schemas and the fixed column lists."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("card_present", T.IntegerType()),
        T.StructField("entry_mode", T.StringType()),
        T.StructField("currency", T.StringType()),
    ]
)
TRANSACTION_NAMES = TRANSACTION_SCHEMA.fieldNames()

CARD_SCHEMA = T.StructType(
    [T.StructField("Time", T.LongType())]
    + [T.StructField(f"V{i}", T.DoubleType()) for i in range(1, 29)]
    + [T.StructField("Amount", T.DoubleType()), T.StructField("Class", T.IntegerType())]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Columns that never enter a feature matrix.
NOT_FEATURES = [
    "transaction_id", "timestamp", "account_id", "merchant_id", "device_id",
    "is_fraud", "merchant_category", "entry_mode", "currency",
    "fraud_probability", "fraud_risk_level",
]

# The feature list a trained model is applied and explained with.
# `community_id` is a string label here and is left out of vectors.
MODEL_FEATURES = [
    "amount", "hour", "day_of_week", "is_weekend", "amount_log", "is_night",
    "high_risk_time", "high_amount", "amount_bin", "account_txn_count",
    "account_amount_mean", "account_amount_std", "account_amount_max",
    "amount_vs_account_mean", "time_since_last_txn", "merchant_txn_count",
    "device_txn_count", "unique_merchants_per_device", "accounts_per_device",
    "shared_device_flag", "devices_per_account", "fraud_count_per_account",
    "fraud_rate_per_account", "merchant_category_encoded", "entry_mode_encoded",
    "currency_encoded", "node_degree", "total_amount", "avg_amount", "std_amount",
    "max_amount", "min_amount", "unique_merchants", "unique_devices",
    "connected_accounts", "fraud_count", "fraud_rate", "community_id",
    "community_size", "pagerank_score", "betweenness_centrality", "fraud_ring_flag",
]

# Columns a live row must not carry into scoring.
LABEL_AND_SCORE_COLUMNS = [
    "is_fraud", "fraud_probability", "fraud_risk_level", "graph_risk_flag",
    "investigation_priority", "priority_level",
]
