"""Connected components by randomised contraction.

Every round each vertex joins the neighbour (or itself) with the smallest hash of
that round, edges are renamed to the chosen representatives and deduplicated. A
constant share of the vertices disappears per round in expectation, whatever the
diameter, and the work per round is one grouping and two joins. The names are then
composed from the last round back to the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskgraph.functions.skew import attach, loop_rows
from riskgraph.operators.sharing import Pairs, pairs_of
from riskgraph.session import materialise, materialise_with


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) of every vertex of an edge table; the root is any one vertex of its component."""
    pairs, seen = materialise_with(
        edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct()
    )
    renames: list[tuple[DataFrame, int]] = []
    round_no = 0
    while seen["rows"]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.xxhash64(F.col("b"), F.lit(round_no))
        mine = F.struct(F.xxhash64(F.col("a"), F.lit(round_no)).alias("h"), F.col("a").alias("v"))
        chosen, size = materialise_with(
            both.groupBy("a").agg(
                F.min(F.struct(rank.alias("h"), F.col("b").alias("v"))).alias("_m"),
                F.count(F.lit(1)).alias("_n"),
            ).select("a", F.least(F.col("_m"), mine)["v"].alias("r"), "_n")
        )
        renames.append((chosen.select(F.col("a").alias("node"), F.col("r").alias("root")), size["rows"]))
        to_a = chosen.select("a", F.col("r").alias("ra"), "_n")
        to_b = chosen.select(F.col("a").alias("b"), F.col("r").alias("rb"), F.col("_n").alias("_m"))
        renamed = attach(pairs, to_a, "a", weight="_n", right_rows=size["rows"], broadcast_rows=loop_rows()).drop("_n")
        renamed = attach(renamed, to_b, "b", weight="_m", right_rows=size["rows"], broadcast_rows=loop_rows()).drop("_m")
        pairs, seen = materialise_with(
            renamed.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .where("a <> b").distinct()
        )
        round_no += 1
    if not renames:
        return edges.select(F.col(left).alias("node"), F.col(left).alias("root")).limit(0)
    roots, rows = renames[-1]
    for earlier, earlier_rows in reversed(renames[:-1]):
        later = roots.select(F.col("node").alias("root"), F.col("root").alias("_final"))
        roots = attach(earlier, later, "root", right_rows=rows, broadcast_rows=loop_rows()).select("node", F.coalesce("_final", "root").alias("root"))
        rows = earlier_rows
    return roots


def account_components(df: DataFrame, pairs: Pairs | None = None) -> DataFrame:
    """(account_id, community_id, community_size).

    Accounts and devices are the vertices, so a popular device costs one row per
    account. The id is the smallest account id of the component; an account without
    a device is a component of its own.
    """
    pairs = pairs or pairs_of(df)
    named = pairs.uses.select(
        F.concat(F.lit("a:"), "account_id").alias("src"), F.concat(F.lit("d:"), "device_id").alias("dst")
    )
    found = (
        connected_components(named, "src", "dst").where(F.col("node").startswith("a:"))
        .select(F.expr("substr(node, 3)").alias("account_id"), "root")
    )
    found = materialise(found)
    sizes = found.groupBy("root").agg(
        F.min("account_id").alias("community_id"), F.count(F.lit(1)).alias("community_size")
    )
    labelled = attach(found, sizes, "root", weight="community_size").drop("root")
    return pairs.accounts.join(labelled, "account_id", "left").select(
        "account_id",
        F.coalesce("community_id", "account_id").alias("community_id"),
        F.coalesce("community_size", F.lit(1)).cast("bigint").alias("community_size"),
    )
