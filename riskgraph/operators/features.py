"""Time, amount and per-entity behaviour features.

Per-entity numbers are grouped (partial sums before the shuffle) and joined back,
never computed in a window over the entity: an account may hold a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskgraph.functions import skew
from riskgraph.functions.order import exact_quantile
from riskgraph.functions.rules import amount_bin, day_of_week, flag, is_night, is_weekend
from riskgraph.functions.skew import attach
from riskgraph.session import materialise

MICROS_PER_HOUR = 3.6e9
# Slice of an account's timeline: at most this many distinct microseconds.
SLICE_MICROS = 60_000_000


def calendar(df: DataFrame) -> DataFrame:
    ts = F.col("timestamp")
    return df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": day_of_week(ts),
        "month": F.month(ts),
        "day_of_month": F.dayofmonth(ts),
    })


def weekend_night(df: DataFrame) -> DataFrame:
    return df.withColumns({"is_weekend": is_weekend(F.col("day_of_week")), "is_night": is_night(F.col("hour"))})


def high_risk_time(df: DataFrame) -> DataFrame:
    return df.withColumn("high_risk_time", flag((F.col("is_night") == 1) | (F.col("is_weekend") == 1)))


def amount_shape(df: DataFrame) -> DataFrame:
    return df.withColumns({"amount_log": F.log1p("amount"), "amount_bin": amount_bin(F.col("amount"))})


def high_amount(df: DataFrame, p: float = 0.95) -> DataFrame:
    """Above the exact global quantile; the number is a literal in the plan."""
    edge = exact_quantile(df, "amount", p)
    return df.withColumn("high_amount", flag(F.col("amount") > F.lit(edge)))


def account_table(df: DataFrame) -> DataFrame:
    """One row per account with every account-level feature."""
    return df.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("account_txn_count"),
        F.avg("amount").alias("account_amount_mean"),
        F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("account_amount_std"),
        F.max("amount").alias("account_amount_max"),
        F.sum("is_fraud").alias("fraud_count_per_account"),
        F.count_distinct("device_id").alias("devices_per_account"),
    )


def merchant_table(df: DataFrame) -> DataFrame:
    return df.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("merchant_txn_count"))


def device_table(df: DataFrame) -> DataFrame:
    return df.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("device_txn_count"),
        F.count_distinct("merchant_id").alias("unique_merchants_per_device"),
        F.count_distinct("account_id").alias("accounts_per_device"),
    )


def account_features(df: DataFrame) -> DataFrame:
    mean, std = F.col("account_amount_mean"), F.col("account_amount_std")
    return attach(df, account_table(df), "account_id", weight="account_txn_count").withColumns({
        "amount_vs_account_mean": (F.col("amount") - mean) / (std + 1),
        "fraud_rate_per_account": F.col("fraud_count_per_account") / F.col("account_txn_count"),
    })


def merchant_features(df: DataFrame) -> DataFrame:
    return attach(df, merchant_table(df), "merchant_id", weight="merchant_txn_count")


def device_features(df: DataFrame) -> DataFrame:
    return attach(df, device_table(df), "device_id", weight="device_txn_count").withColumn(
        "shared_device_flag", flag(F.col("accounts_per_device") > 3)
    )


def time_since_last(df: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Hours since the account's previous transaction in (timestamp, transaction_id) order.

    Ordinary accounts use one `lag` window. An account above the hot limit is cut
    along its timeline: its distinct timestamps are numbered slice by slice, each
    slice starting from the end of the slice before; rows that repeat a timestamp are 0.
    """
    counts = df.groupBy("account_id").agg(F.count(F.lit(1)).alias("_n"))
    hot = skew.hot_keys(counts, ["account_id"], hot_rows)
    if hot is None:
        return _lag_within_accounts(df)
    hot = F.broadcast(hot.select("account_id"))
    cold_rows = _lag_within_accounts(df.join(hot, "account_id", "left_anti"))
    hot_rows_ = _lag_along_timeline(df.join(hot, "account_id", "left_semi"))
    return cold_rows.unionByName(hot_rows_)


def _lag_within_accounts(df: DataFrame) -> DataFrame:
    before = Window.partitionBy("account_id").orderBy("timestamp", "transaction_id")
    gap = F.unix_micros("timestamp") - F.lag(F.unix_micros("timestamp")).over(before)
    return df.withColumn("time_since_last_txn", gap / MICROS_PER_HOUR)


def _lag_along_timeline(df: DataFrame) -> DataFrame:
    at = F.unix_micros("timestamp")
    moments = materialise(
        df.groupBy("account_id", at.alias("_at")).agg(
            F.min("transaction_id").alias("_first_id"), F.count(F.lit(1)).alias("_n")
        ).withColumn("_slice", F.floor(F.col("_at") / SLICE_MICROS))
    )
    by_slice = Window.partitionBy("account_id").orderBy("_slice")
    ends = moments.groupBy("account_id", "_slice").agg(F.max("_at").alias("_end")).select(
        "account_id", "_slice", F.lag("_end").over(by_slice).alias("_carried")
    )
    in_slice = Window.partitionBy("account_id", "_slice").orderBy("_at")
    gaps = (
        moments.withColumn("_before", F.lag("_at").over(in_slice))
        .join(ends, ["account_id", "_slice"])
        .select("account_id", "_at", "_first_id", "_n",
                (F.col("_at") - F.coalesce("_before", "_carried")).alias("_gap"))
    )
    joined = attach(df.withColumn("_at", at), gaps, ["account_id", "_at"], weight="_n")
    gap = F.when(F.col("transaction_id") == F.col("_first_id"), F.col("_gap")).otherwise(F.lit(0))
    return joined.select(*df.columns, (gap / MICROS_PER_HOUR).alias("time_since_last_txn"))


def engineer(df: DataFrame) -> DataFrame:
    """Every feature of this module."""
    return (
        df.transform(calendar)
        .transform(weekend_night)
        .transform(high_risk_time)
        .transform(amount_shape)
        .transform(high_amount)
        .transform(time_since_last)
        .transform(account_features)
        .transform(merchant_features)
        .transform(device_features)
    )
