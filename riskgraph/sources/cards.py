"""Raw card table -> transaction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskgraph.functions.order import exact_quantiles, with_row_position
from riskgraph.functions.rules import day_of_week, is_weekend, uniform

DEFAULT_BASE = "2024-01-01 00:00:00"

# Labels of the equal-width bins of V5 and V6.
CATEGORY_LABELS = [
    "grocery", "electronics", "restaurant", "gas_station",
    "online_shopping", "travel", "entertainment", "healthcare",
]
ENTRY_LABELS = ["chip", "swipe", "online"]

# Fixed values: (column, id column, id prefix, most buckets, rows per bucket).
ENTITY_BUCKETS = [
    ("V1", "account_id", "ACC_", 100, 100),
    ("V2", "merchant_id", "MER_", 50, 200),
    ("V4", "device_id", "DEV_", 30, 500),
]


def _bucket_of(v: Column, edges: list[float]) -> Column:
    """Right-closed bucket number: how many interior edges lie below the value."""
    inner = F.array(*[F.lit(float(e)) for e in edges[1:-1]]) if len(edges) > 2 else None
    return F.lit(0) if inner is None else F.size(F.filter(inner, lambda e: v > e))


def entity_buckets(df: DataFrame) -> DataFrame:
    """Quantile buckets of V1, V2 and V4 as account, merchant and device ids."""
    n = df.count()
    wanted = {}
    for column, _, _, most, per in ENTITY_BUCKETS:
        q = max(1, min(most, n // per))
        wanted[column] = [i / q for i in range(q + 1)]
    edges = exact_quantiles(df, wanted)
    for column, name, prefix, _, _ in ENTITY_BUCKETS:
        kept = sorted({e for e in edges[column] if e is not None})
        bucket = _bucket_of(F.col(column), kept).cast("string")
        df = df.withColumn(name, F.when(F.col(column).isNotNull(), F.concat(F.lit(prefix), F.lpad(bucket, 6, "0"))))
    return df


def _equal_width(v: Column, low: float, high: float, labels: list[str]) -> Column:
    bins = len(labels)
    width = (high - low) / bins
    # Interior edges only: the outermost bins take the extremes.
    number = F.size(F.filter(F.array(*[F.lit(low + width * i) for i in range(1, bins)]), lambda e: v > e))
    return F.when(v.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in labels]), number + 1))


def category_cut(df: DataFrame) -> DataFrame:
    """Equal-width bins of V5 (category) and V6 (entry mode)."""
    lo5, hi5, lo6, hi6 = df.agg(F.min("V5"), F.max("V5"), F.min("V6"), F.max("V6")).first()
    if lo5 is None or lo6 is None:
        return df.withColumn("merchant_category", F.lit(None).cast("string")).withColumn(
            "entry_mode", F.lit(None).cast("string")
        )
    return df.withColumn("merchant_category", _equal_width(F.col("V5"), lo5, hi5, CATEGORY_LABELS)).withColumn(
        "entry_mode", _equal_width(F.col("V6"), lo6, hi6, ENTRY_LABELS)
    )


def random_attributes(df: DataFrame, id_column: str = "transaction_id", seed: int = 42) -> DataFrame:
    """`card_present` (75% yes) and `currency` (85/10/5), fixed by the row id."""
    u = uniform(F.col(id_column), F.lit(seed))
    w = uniform(F.col(id_column), F.lit(seed + 1))
    return df.withColumn("card_present", F.when(u < 0.25, 0).otherwise(1)).withColumn(
        "currency", F.when(w < 0.85, "USD").when(w < 0.95, "EUR").otherwise("GBP")
    )


def card_core(df: DataFrame, order: str = "_seq", base: str = DEFAULT_BASE) -> DataFrame:
    """Id from the row position, timestamp from the elapsed seconds, calendar columns."""
    ts = F.timestamp_micros(F.unix_micros(F.lit(base).cast("timestamp")) + F.col("Time").cast("bigint") * 1_000_000)
    out = with_row_position(df, [order], "_position").withColumn("timestamp", ts)
    dow = day_of_week(F.col("timestamp"))
    # Spark matches column names without case, so the renames replace Amount and Class.
    return (
        out.withColumnRenamed("Amount", "amount")
        .withColumnRenamed("Class", "is_fraud")
        .withColumn("transaction_id", F.concat(F.lit("TXN_"), F.lpad(F.col("_position").cast("string"), 10, "0")))
        .withColumn("hour", F.hour("timestamp"))
        .withColumn("day_of_week", dow)
        .withColumn("is_weekend", is_weekend(dow))
        .drop("_position")
    )


def card_to_transactions(df: DataFrame, order: str = "_seq", base: str = DEFAULT_BASE, seed: int = 42) -> DataFrame:
    out = card_core(df, order, base)
    return random_attributes(category_cut(entity_buckets(out)), seed=seed)
