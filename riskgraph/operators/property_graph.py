"""Property-graph tables (nodes, edges) and the pattern queries over them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from riskgraph.functions.skew import attach
from riskgraph.operators.components import account_components
from riskgraph.operators.sharing import sharing, uses
from riskgraph.session import materialise

HIGH_VALUE = 500
# Ratio of one amount band; below 1.2, so two amounts of one band always match.
BAND_RATIO = 1.19
FIRST_BATCH = 64


def account_nodes(df: DataFrame) -> DataFrame:
    return df.select("account_id").distinct()


def merchant_nodes(df: DataFrame, order: str = "_seq") -> DataFrame:
    """Merchants with the category written last."""
    return df.groupBy("merchant_id").agg(F.max_by("merchant_category", order).alias("category"))


def device_nodes(df: DataFrame) -> DataFrame:
    return df.select("device_id").distinct()


def transaction_nodes(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id", "amount", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        "is_fraud", "hour", "day_of_week",
    )


def nodes(df: DataFrame) -> DataFrame:
    """Long form: label, id and the properties a label has."""
    def long(part: DataFrame, label: str, key: str) -> DataFrame:
        return part.select(F.lit(label).alias("label"), F.col(key).alias("id"), *[c for c in part.columns if c != key])

    out = long(transaction_nodes(df), "Transaction", "transaction_id")
    for part, label, key in (
        (account_nodes(df), "Account", "account_id"),
        (merchant_nodes(df), "Merchant", "merchant_id"),
        (device_nodes(df), "Device", "device_id"),
    ):
        out = out.unionByName(long(part, label, key), allowMissingColumns=True)
    return out


def edges(df: DataFrame) -> DataFrame:
    """Long form: type, src, dst; each edge once."""
    def typed(kind: str, src: str, dst: str) -> DataFrame:
        return df.select(F.lit(kind).alias("type"), F.col(src).alias("src"), F.col(dst).alias("dst")).distinct()

    return (
        typed("MAKES", "account_id", "transaction_id")
        .unionByName(typed("TO", "transaction_id", "merchant_id"))
        .unionByName(typed("USES", "account_id", "device_id"))
    )


def stats(df: DataFrame) -> DataFrame:
    """Nodes per label and edges per type."""
    n = nodes(df).groupBy(F.col("label").alias("name")).agg(F.count(F.lit(1)).alias("count"))
    e = edges(df).groupBy(F.col("type").alias("name")).agg(F.count(F.lit(1)).alias("count"))
    return n.withColumn("kind", F.lit("node")).unionByName(e.withColumn("kind", F.lit("edge")))


def degree(df: DataFrame) -> DataFrame:
    return df.groupBy("account_id").agg(F.count(F.lit(1)).alias("node_degree"))


def shared_device_count(df: DataFrame) -> DataFrame:
    """Accounts with at least one other account on their devices, and how many others."""
    return sharing(df).degrees().where("connected_accounts > 0").withColumnRenamed(
        "connected_accounts", "shared_device_count"
    )


def merchant_transactions(df: DataFrame) -> DataFrame:
    return df.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("merchant_txn_count"))


def device_accounts(df: DataFrame) -> DataFrame:
    """Accounts per device; a device of one account matches no pair and is absent."""
    return uses(df).groupBy("device_id").agg(F.count(F.lit(1)).alias("device_account_count")).where(
        "device_account_count > 1"
    )


def suspicious_accounts(df: DataFrame, high_value: float = HIGH_VALUE) -> DataFrame:
    """Accounts with high-value payments on more than two devices, or more than five matched rows.

    The pattern multiplies payments by devices; the product is computed from the two
    counts, without building those rows.
    """
    payments = df.where(F.col("amount") > high_value).groupBy("account_id").agg(F.count(F.lit(1)).alias("_paid"))
    devices = uses(df).groupBy("account_id").agg(F.count(F.lit(1)).alias("device_count"))
    return (
        payments.join(devices, "account_id")
        .withColumn("high_value_txns", F.col("_paid") * F.col("device_count"))
        .where("device_count > 2 OR high_value_txns > 5")
        .select("account_id", "device_count", "high_value_txns", F.lit(1).alias("suspicious_flag"))
    )


def account_features(df: DataFrame) -> DataFrame:
    return (
        degree(df)
        .join(shared_device_count(df), "account_id", "left")
        .join(suspicious_accounts(df).select("account_id", "suspicious_flag"), "account_id", "left")
        .select(
            "account_id", "node_degree",
            F.coalesce("shared_device_count", F.lit(0)).cast("bigint").alias("shared_device_count"),
            F.coalesce("suspicious_flag", F.lit(0)).alias("suspicious_flag"),
        )
    )


def _amount_bands(df: DataFrame) -> DataFrame:
    """Per account, merchant and amount band: smallest and largest amount.

    Whether two accounts have amounts within 20% of each other at a merchant can be
    read off these extremes alone, so transactions never meet transactions.
    """
    band = F.floor(F.log("amount") / math.log(BAND_RATIO))
    return df.where(F.col("amount") > 0).groupBy("account_id", "merchant_id", band.alias("band")).agg(
        F.min("amount").alias("lo"), F.max("amount").alias("hi")
    )


def _similar_pairs(pairs: DataFrame, bands: DataFrame) -> DataFrame:
    """Pairs where account2 has t1 and account1 has t2 at one merchant, 0.8 t2 < t1 < 1.2 t2."""
    one = bands.select(
        F.col("account_id").alias("account1"), "merchant_id", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
        F.col("band").alias("_own"),
        F.explode(F.sequence(F.col("band") - 2, F.col("band") + 2)).alias("band"),
    )
    two = bands.select(
        F.col("account_id").alias("account2"), "merchant_id", F.col("lo").alias("lo1"), F.col("hi").alias("hi1"), "band"
    )
    match = (
        F.when(F.col("band") == F.col("_own"), F.lit(True))
        .when(F.col("band") > F.col("_own"), F.col("lo1") < F.col("hi2") * 1.2)
        .otherwise(F.col("hi1") > F.col("lo2") * 0.8)
    )
    met = attach(pairs, one, "account1", how="inner")
    met = attach(met, two, ["account2", "merchant_id", "band"], how="inner")
    return met.where(match).select("account1", "account2").distinct()


def device_rings(df: DataFrame, limit: int = 50) -> DataFrame:
    """First `limit` pairs (by account1, account2) sharing several devices and paying alike.

    Pairs are formed for a batch of the lowest account1 values at a time, doubling the
    batch until the limit is filled or no account is left, so the full pair list of a
    popular device is only ever built if the report needs it.
    """
    u = materialise(uses(df))
    bands = materialise(_amount_bands(df))
    shared = u.groupBy("device_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    starts = materialise(
        attach(u, shared, "device_id", how="inner", weight="_n")
        .groupBy("account_id").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1")
        .select(F.col("account_id").alias("account1"))
    )
    other = u.withColumnRenamed("account_id", "account2")
    found, after, batch = None, None, FIRST_BATCH
    while True:
        rest = starts if after is None else starts.where(F.col("account1") > after)
        chunk = materialise(rest.orderBy("account1").limit(batch))
        ends = chunk.agg(F.max("account1"), F.count(F.lit(1))).first()
        mine = u.join(F.broadcast(chunk), F.col("account_id") == F.col("account1"), "left_semi").withColumnRenamed(
            "account_id", "account1"
        )
        pairs = (
            attach(other, mine, "device_id", how="inner").where("account1 <> account2")
            .groupBy("account1", "account2").agg(F.count(F.lit(1)).alias("ring_size")).where("ring_size > 1")
        )
        pairs = materialise(pairs)
        hits = materialise(
            pairs.join(_similar_pairs(pairs.select("account1", "account2"), bands), ["account1", "account2"], "left_semi")
            .orderBy("account1", "account2").limit(limit)
        )
        found = hits if found is None else found.unionByName(hits)
        after = ends[0]
        if ends[1] < batch or found.count() >= limit:
            break
        batch = min(batch * 2, 65_536)
    top = materialise(found.orderBy("account1", "account2").limit(limit))
    # At most `limit` pairs are left: look their common devices up.
    a = u.withColumnRenamed("account_id", "account1").join(F.broadcast(top), "account1")
    return (
        other.join(F.broadcast(a), ["account2", "device_id"])
        .groupBy("account1", "account2", "ring_size")
        .agg(F.sort_array(F.collect_set("device_id")).alias("shared_devices"))
        .select("account1", "account2", "shared_devices", "ring_size")
    )


def neighbour_accounts(df: DataFrame, account_id: str, limit: int = 20) -> DataFrame:
    """Other accounts on the devices of one account, lowest ids first."""
    mine = df.where(F.col("account_id") == account_id).select("device_id").distinct()
    return (
        attach(df.select("account_id", "device_id"), mine, "device_id", how="left_semi")
        .where(F.col("account_id") != account_id)
        .select(F.col("account_id").alias("connected_account")).distinct()
        .orderBy("connected_account").limit(limit)
    )


def neighbour_entities(df: DataFrame, account_id: str, limit: int = 20) -> DataFrame:
    """Merchants visited and devices used by one account, `limit` of each, lowest ids first."""
    mine = df.where(F.col("account_id") == account_id)

    def part(kind: str, column: str) -> DataFrame:
        return mine.select(F.col(column).alias("id")).distinct().orderBy("id").limit(limit).select(
            F.lit(kind).alias("kind"), "id"
        )

    return part("merchant", "merchant_id").unionByName(part("device", "device_id"))


def simple_communities(df: DataFrame) -> DataFrame:
    """Clusters of accounts joined through devices; an isolated account is its own."""
    return account_components(df)


def top_distinct(df: DataFrame, key: str, value: str, limit: int, order: str = "_seq") -> DataFrame:
    """The first `limit` distinct values per key in order of appearance."""
    first = df.groupBy(key, value).agg(F.min(order).alias("_first"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_first"))
    return first.withColumn("_rank", rank).where(F.col("_rank") <= limit)
