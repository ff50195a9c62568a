"""Resharding by minimum-cost flow: fill new shards while moving the fewest bytes.

The network has a node for every old shard and for each stretch of its rows in order of
size, whose rows either stay, at no cost, or go through a hub to any new shard, at their
mean size each; new shards take their capacity of rows. The stretches end at the margin:
as new counts differ by one at most, an old shard of n rows gives up n - each or one less,
so the row at that rank is a stretch of its own with its exact size, and the optimum is
the fewest bytes. It says how many rows each old shard gives up; within a shard the
smallest go first. The rows given up are cut into blocks (old shard, range of ranks, new
shard). Only the network, whose size depends on the numbers of shards and not of rows, is
solved on the driver.

Ranks come from one distributed sort by (old shard, size, id), so an old shard may hold
any share of the rows. A row's place in its new shard is computed from its block: places
are gapless, and nothing is shuffled for them.

`lay_out` writes an old layout as files and numbers its rows, `rewrite` writes the files of
the shards that the plan changes. A block is a range of (size, id, row), so a row's new
shard follows from the ends of the blocks where the row stands: texts are written once for
each layout and never shuffled.

A null text has no bytes. Equal texts need not share a shard. Rows that repeat an id are
placed like any other rows. An empty table gives no rows. Other columns are not looked at
by the plan; `rewrite` writes all of them.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskgraph.functions.order import with_row_position
from riskgraph.llm.common import text_bytes
from riskgraph.session import materialise

ROW_BYTES = 16


class Flow:
    """Minimum-cost flow by successive shortest paths with potentials; costs must not be negative."""

    def __init__(self):
        self.edges: list[list] = []  # to, capacity, cost
        self.at: dict = defaultdict(list)

    def add(self, a, b, capacity: int, cost: float) -> int:
        self.at[a].append(len(self.edges))
        self.edges.append([b, capacity, cost])
        self.at[b].append(len(self.edges))
        self.edges.append([a, 0, -cost])
        return len(self.edges) - 2

    def used(self, edge: int) -> int:
        return self.edges[edge ^ 1][1]

    def solve(self, source, sink) -> None:
        height: dict = defaultdict(float)
        while True:
            far, via, queue, n = {source: 0.0}, {}, [(0.0, 0, source)], 0
            while queue:
                d, _, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for e in self.at[a]:
                    b, capacity, cost = self.edges[e]
                    new = d + max(0.0, cost + height[a] - height[b])
                    if capacity > 0 and new < far.get(b, float("inf")) - 1e-9:
                        far[b], via[b] = new, e
                        n += 1
                        heapq.heappush(queue, (new, n, b))
            if sink not in far:
                return
            for a in self.at:
                height[a] += min(far.get(a, far[sink]), far[sink])
            path, a = [], sink
            while a != source:
                path.append(via[a])
                a = self.edges[via[a] ^ 1][0]
            amount = min(self.edges[e][1] for e in path)
            for e in path:
                self.edges[e][1] -= amount
                self.edges[e ^ 1][1] += amount


def given_up(classes: dict[int, dict[int, tuple[int, int]]], shards: int) -> tuple[dict[int, int], dict[int, int]]:
    """(rows that leave each old shard, rows that come to each new shard).

    `classes`: by old shard and stretch of its rows in order of size, (rows, bytes). New shards are 0 to shards - 1;
    their counts differ by one at most. Old shards that are no longer there give up all rows.
    """
    rows = sum(n for by in classes.values() for n, _ in by.values())
    each, extra = divmod(rows, shards)
    net = Flow()
    leave: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, by in sorted(classes.items()):
        for c, (n, size) in sorted(by.items()):
            net.add("all", ("class", i, c), n, 0)
            if 0 <= i < shards:
                net.add(("class", i, c), ("shard", i), n, 0)
            leave[i].append((net.add(("class", i, c), "hub", n, size / n), n))
    come = {}
    for j in range(shards):
        come[j] = net.add("hub", ("shard", j), rows, 0)
        net.add(("shard", j), "end", each, 0)
        if extra:
            net.add(("shard", j), "one more", 1, 0)
    if extra:
        net.add("one more", "end", extra, 0)
    net.solve("all", "end")
    return {i: sum(net.used(e) for e, _ in es) for i, es in leave.items()}, {j: net.used(e) for j, e in come.items()}


def blocks(counts: dict[int, int], leave: dict[int, int], come: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """(old, first rank, end rank, new, first place): the rows that stay and the transfers."""
    out, free = [], {j: 0 for j in come}
    for i, n in sorted(counts.items()):
        if n > leave.get(i, 0):
            out.append((i, leave.get(i, 0), n, i, 0))
            free[i] = n - leave.get(i, 0)
    wants = [[j, n] for j, n in sorted(come.items()) if n]
    for i, n in sorted(leave.items()):
        at = 0
        while at < n:
            j, left = wants[-1]
            size = min(left, n - at)
            out.append((i, at, at + size, j, free[j]))
            free[j] += size
            at += size
            wants[-1][1] -= size
            if not wants[-1][1]:
                wants.pop()
    return out


def margins(counts: dict[int, int], shards: int) -> dict[int, int]:
    """By old shard, the rank of the row that it gives up or keeps, as one or no row more falls to it."""
    each = sum(counts.values()) // shards
    return {i: n - each - 1 for i, n in counts.items() if 0 <= i < shards and n > each}


def reshard(docs: DataFrame, old: Column, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, shard, slot): counts of the new shards differ by one at most.

    The `row` of `lay_out`, if `docs` has it, is carried along.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    numbered = ["row"] if "row" in docs.columns else []
    rows = materialise(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (text_bytes() + F.lit(ROW_BYTES)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), old.cast("int").alias("old_shard"), *numbered))
    counts = {r[0]: r[1] for r in rows.groupBy("old_shard").agg(F.count(F.lit(1))).collect()}  # one row per old shard
    begin, start = 0, {}
    for i in sorted(counts):
        start[i], begin = begin, begin + counts[i]
    spark = docs.sparkSession
    placed = with_row_position(rows, ["old_shard", "size", "doc_id", *numbered])
    margin = margins(counts, shards)
    edges = spark.createDataFrame([(i, start[i] + margin[i]) for i in sorted(margin)], "old_shard int, _edge long")
    stretch = F.coalesce(F.signum(F.col("position") - F.col("_edge")), F.lit(0.0)).cast("int")
    seen = placed.join(F.broadcast(edges), "old_shard", "left").groupBy("old_shard", stretch.alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect()  # three rows per old shard
    classes: dict[int, dict[int, tuple[int, int]]] = defaultdict(dict)
    for r in seen:
        classes[r["old_shard"]][r["c"]] = (r["n"], r["bytes"])
    plan = blocks(counts, *given_up(classes, shards)) if classes else []
    table = spark.createDataFrame(
        [(i, start[i] + a, start[i] + b, j, place) for i, a, b, j, place in plan],
        "old_shard int, _from long, _to long, shard int, _place long")
    inside = (F.col("position") >= F.col("_from")) & (F.col("position") < F.col("_to"))
    return placed.join(F.broadcast(table), "old_shard").where(inside).select(
        "doc_id", "size", "text_crc32", "old_shard", "shard",
        (F.col("_place") + F.col("position") - F.col("_from")).alias("slot"), *numbered)


def lay_out(docs: DataFrame, old: Column, path: str) -> DataFrame:
    """Write `docs` to `path`/old_shard=N, each row with a number of its own (`row`), and read it back."""
    rows = docs.withColumns({"row": F.monotonically_increasing_id(), "old_shard": old.cast("int")})
    rows.write.partitionBy("old_shard").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def _assigned(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """`docs` with the new `shard` of every row that `plan` names.

    Rows of a layout find it by where they stand between the first rows of the blocks of
    their old shard; rows without a number by their id, which must be unique.
    """
    if "row" not in docs.columns:
        return docs.join(plan.select("doc_id", "shard", "slot"), "doc_id")

    def place(size: Column, doc_id: Column) -> Column:
        return F.struct(size.alias("size"), doc_id.isNotNull().alias("named"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"),
                        F.col("row").alias("row"))

    firsts = plan.groupBy("old_shard", "shard").agg(F.min(place(F.col("size"), F.col("doc_id"))).alias("_first"))
    firsts = firsts.withColumn("_next", F.lead("_first").over(Window.partitionBy("old_shard").orderBy("_first")))
    at = place(text_bytes() + F.lit(ROW_BYTES), F.col("doc_id").cast("bigint"))
    inside = (F.col("_at") >= F.col("_first")) & (F.col("_next").isNull() | (F.col("_at") < F.col("_next")))
    return docs.withColumn("_at", at).join(
        F.broadcast(firsts), "old_shard").where(inside).drop("_at", "_first", "_next")  # one row per block


def rewrite(docs: DataFrame, plan: DataFrame, path: str) -> DataFrame:
    """Write the shards that the plan changes to `path`/shard=N and return their numbers.

    A shard is affected if a row leaves it or comes to it; the files of the others stay as
    they are. Every task writes its part of each shard, so a shard may hold any share of the rows.
    """
    moves = plan.where("old_shard <> shard")
    affected = moves.select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    rows = _assigned(docs, plan.join(F.broadcast(affected), "shard", "left_semi"))
    rows.write.partitionBy("shard").parquet(path)
    return affected


def read_back(layout: DataFrame, affected: DataFrame, path: str) -> DataFrame:
    """All rows after `rewrite`, with their `shard`: the rewritten files, and those of the old layout that stayed."""
    written = layout.withColumn("shard", F.lit(0))
    new = layout.sparkSession.read.schema(written.schema).parquet(path)
    stayed = layout.withColumn("shard", F.col("old_shard")).join(F.broadcast(affected), "shard", "left_anti")
    return new.unionByName(stayed)
