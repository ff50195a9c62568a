"""Modularity communities of the account-device graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskgraph.functions import skew
from riskgraph.operators.sharing import uses
from riskgraph.session import materialise, materialise_with

# Most sweeps over the two halves per level, and most levels.
SWEEPS, LEVELS = 10, 10
# A sweep that gains less than this ends its level.
TOLERANCE = 1e-4


def attach(*sides, **options) -> DataFrame:
    """`skew.attach` with the limit of iterations: every sweep attaches the labels again."""
    return skew.attach(*sides, **options, broadcast_rows=skew.loop_rows())


def _join(left: DataFrame, right: DataFrame, key: str, rows: int, hot: DataFrame | None, how: str = "left") -> DataFrame:
    """`attach` of a written `right` of `rows` rows where the hot keys of `left` are known: plans a join, runs no job."""
    if rows <= skew.loop_rows():
        return left.join(F.broadcast(right), key, how)
    if hot is not None:
        hot = hot.withColumnRenamed(hot.columns[0], key)
    return skew.spread_join(left, right, key, how, hot)


def _hot(counts: DataFrame, key: str, most: int | None) -> DataFrame | None:
    """`hot_keys` of `counts(key, _n)`, whose largest count is known, so that usually no job runs."""
    return skew.hot_keys(counts.select(key, "_n"), [key]) if (most or 0) > skew.HOT_ROWS else None


def modularity(edges: DataFrame, labels: DataFrame, nodes: int, hot: DataFrame | None = None) -> float:
    """Modularity of `labels(node, c)` on undirected `edges(a, b, w)`; a loop a = b counts its weight twice."""
    first = labels.select(F.col("node").alias("a"), F.col("c").alias("ca"))
    second = labels.select(F.col("node").alias("b"), F.col("c").alias("cb"))
    ends = _join(_join(edges, first, "a", nodes, hot), second, "b", nodes, hot)
    inside = F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(0.0)
    halves = ends.select(F.explode(F.array(
        F.struct(F.col("ca").alias("c"), "w", inside.alias("i")), F.struct(F.col("cb").alias("c"), "w", F.lit(0.0).alias("i"))
    )).alias("e")).select("e.*")
    total, within, squares = halves.groupBy("c").agg(F.sum("w").alias("d"), F.sum("i").alias("i")).agg(
        F.sum("d"), F.sum("i"), F.sum(F.col("d") * F.col("d"))
    ).first()
    return 2 * within / total - squares / (total * total) if total else 0.0


def _sweep(both: DataFrame, state: DataFrame, m: float, turn: int, nodes: int, hot: DataFrame | None) -> tuple[DataFrame, int]:
    """`state(node, c, k)` after the nodes of one half moved to the neighbouring community with the best gain,
    and how many did. `hot`: the nodes with many `both(a, b, w)`.

    Two jobs: the totals of the communities, then the moves. A node carries its community's
    total to its neighbours, so links are joined by node only, whose hot keys stay the same all level.
    """
    totals, size = materialise_with(
        state.groupBy("c").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("_n")), most=F.max("_n")
    )
    known = _join(state, totals.drop("_n"), "c", size["rows"], _hot(totals, "c", size["most"]))
    half = F.pmod(F.xxhash64("node", F.lit(turn // 2)), F.lit(2)) == turn % 2
    movers = known.where(half).select("node", F.col("c").alias("own"), "k", F.col("total").alias("own_total"))
    neighbour = known.select(F.col("node").alias("b"), F.col("c").alias("nc"), "total")
    links = _join(both.where("a <> b"), neighbour, "b", nodes, hot)
    links = links.groupBy(F.col("a").alias("node"), "nc").agg(F.sum("w").alias("kin"), F.max("total").alias("total"))
    options = _join(links, movers, "node", nodes, hot, "inner").drop("own_total")
    # A node may stay where it has no link; where it has one, that option is the better of the two.
    stay = movers.select("node", F.col("own").alias("nc"), F.lit(0.0).alias("kin"), F.col("own_total").alias("total"), "own", "k")
    rest = F.col("total") - F.when(F.col("nc") == F.col("own"), F.col("k")).otherwise(0.0)
    priced = options.unionByName(stay).withColumn("gain", F.col("kin") - F.col("k") * rest / (2 * m))
    # The own community wins a tie, then the larger name.
    rank = F.struct(F.round("gain", 9), (F.col("nc") == F.col("own")), F.col("nc"))
    moved = priced.groupBy("node", "own", "k").agg(F.max_by("nc", rank).alias("c"))
    moved = moved.select("node", "c", "k", (F.col("c") != F.col("own")).alias("moved"))
    out, seen = materialise_with(
        moved.unionByName(state.where(~half).withColumn("moved", F.lit(False))), n=F.count_if(F.col("moved"))
    )
    return out.drop("moved"), seen["n"]


def louvain(df: DataFrame) -> DataFrame:
    """(account_id, community_id, modularity).

    Local moving with the two hash halves of the nodes taking turns (both moving at
    once can oscillate), then communities become nodes, until modularity stops rising.
    """
    u = uses(df)
    level_edges, size = materialise_with(u.select(
        F.concat(F.lit("a:"), "account_id").alias("a"), F.concat(F.lit("d:"), "device_id").alias("b"), F.lit(1.0).alias("w")
    ))
    m = float(size["rows"])
    everyone = df.select("account_id").where(F.col("account_id").isNotNull()).distinct()
    if not m:
        return everyone.select("account_id", F.col("account_id").alias("community_id"), F.lit(0.0).alias("modularity"))
    membership, best = None, None
    for _ in range(LEVELS):
        both = level_edges.unionByName(level_edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))
        state, size = materialise_with(both.groupBy(F.col("a").alias("node")).agg(
            F.col("a").alias("c"), F.sum("w").alias("k"), F.count(F.lit(1)).alias("_n")), most=F.max("_n"))
        nodes, hot = size["rows"], _hot(state, "node", size["most"])
        state = state.drop("_n")
        start = modularity(level_edges, state, nodes, hot)
        if membership is None:
            membership, best = state.select("node", "c"), start
        chosen, value, before = state, start, start
        for turn in range(0, 2 * SWEEPS, 2):
            state, moves = _sweep(both, state, m, turn, nodes, hot)
            state, more = _sweep(both, state, m, turn + 1, nodes, hot)
            now = modularity(level_edges, state, nodes, hot)
            if now > value + 1e-9:
                chosen, value = state, now
            if not moves + more or now < before + TOLERANCE:
                break
            before = now
        if value <= start + 1e-9:
            break
        best = value
        step = chosen.select(F.col("node").alias("c"), F.col("c").alias("_new"))
        membership = materialise(attach(membership, step, "c", right_rows=nodes).select("node", F.col("_new").alias("c")))
        ends = _join(level_edges, chosen.select(F.col("node").alias("a"), F.col("c").alias("ca")), "a", nodes, hot)
        ends = _join(ends, chosen.select(F.col("node").alias("b"), F.col("c").alias("cb")), "b", nodes, hot)
        level_edges = materialise(
            ends.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), "w")
            .groupBy("a", "b").agg(F.sum("w").alias("w"))
        )
    accounts = membership.where(F.col("node").startswith("a:")).select(F.expr("substr(node, 3)").alias("account_id"), "c")
    names = accounts.groupBy("c").agg(F.min("account_id").alias("community_id"), F.count(F.lit(1)).alias("_n"))
    named = attach(accounts, names, "c", weight="_n").select("account_id", "community_id")
    return everyone.join(named, "account_id", "left").select(
        "account_id", F.coalesce("community_id", "account_id").alias("community_id"), F.lit(float(best)).alias("modularity")
    )
