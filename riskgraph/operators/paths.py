"""Betweenness: how often an account lies inside the chosen shortest path of a pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskgraph.functions.rules import uniform
from riskgraph.functions.skew import attach, loop_rows
from riskgraph.operators.sharing import Pairs, pairs_of
from riskgraph.session import materialise, materialise_with


def betweenness(
    df: DataFrame, sample_share: float | None = None, seed: int = 42, pairs: Pairs | None = None
) -> DataFrame:
    """(account_id, betweenness_centrality), scaled so the largest is 1.

    All sources advance one level per round. The search runs over account -> device
    -> account: each device is entered once per source, so the work is linear in
    (source, account, device) rows and cliques are never written out. Of several
    predecessors the largest id is the parent; the paths of a source form a tree and
    an account lies inside (subtree size - 1) of them.

    The result compares every pair of a component, so it grows with the sum of squared
    component sizes. `sample_share` searches from a fixed share of the accounts only
    and is an estimate; by default all accounts are sources.
    """
    pairs = pairs or pairs_of(df)
    u, rows, accounts = pairs.uses, pairs.rows, pairs.accounts
    of_account = u.withColumnRenamed("account_id", "node")
    of_device = u.withColumnRenamed("account_id", "next")
    sources = u.select("account_id").distinct()
    if sample_share is not None:
        sources = sources.where(uniform(F.col("account_id"), F.lit(seed)) < sample_share)
    level, seen = materialise_with(sources.select(
        F.col("account_id").alias("source"), F.col("account_id").alias("node"), F.lit(None).cast("string").alias("parent")
    ))
    levels: list[DataFrame] = []
    entered = None
    while seen["rows"]:
        levels.append(level)
        reach = attach(level.select("source", "node"), of_account, "node", how="inner", right_rows=rows, broadcast_rows=loop_rows())
        reach = reach.groupBy("source", "device_id").agg(F.max("node").alias("parent"))
        if entered is not None:
            # A device seen before was first entered exactly one level ago.
            reach = reach.join(entered.select("source", "device_id"), ["source", "device_id"], "left_anti")
        entered = materialise(reach)
        found = attach(entered, of_device, "device_id", how="inner", right_rows=rows, broadcast_rows=loop_rows())
        found = found.groupBy("source", F.col("next").alias("node")).agg(F.max("parent").alias("parent"))
        # Accounts of a newly entered device are either on this level or not yet seen.
        level, seen = materialise_with(found.join(level.select("source", "node"), ["source", "node"], "left_anti"))
    totals = None
    below = None
    for level in reversed(levels[1:]):
        sized = level if below is None else level.join(below, ["source", "node"], "left")
        inner = F.lit(0) if below is None else F.coalesce("_below", F.lit(0))
        sized = materialise(sized.select("source", "node", "parent", inner.cast("bigint").alias("_inside")))
        part = sized.groupBy("node").agg(F.sum("_inside").alias("_inside"))
        totals = part if totals is None else totals.unionByName(part)
        below = sized.groupBy("source", F.col("parent").alias("node")).agg(F.sum(F.col("_inside") + 1).alias("_below"))
    if totals is None:
        return accounts.withColumn("betweenness_centrality", F.lit(0.0))
    totals = materialise(
        totals.groupBy(F.col("node").alias("account_id")).agg(F.sum("_inside").alias("_inside"))
    )
    most = totals.agg(F.max("_inside")).first()[0] or 0
    return accounts.join(totals, "account_id", "left").select(
        "account_id",
        (F.coalesce("_inside", F.lit(0)) / F.lit(float(most if most > 0 else 1))).alias("betweenness_centrality"),
    )
