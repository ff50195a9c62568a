"""Mixing sources to target weights by fitting each source's budget as a subset sum.

The size of a document is its number of words. Each source has a budget of words; what
the budget holds of whole rounds takes every document, the rest is fitted exactly: documents
are counted by exact length, most of the rest takes the same share of every length, and
a bounded-knapsack program over the lengths fits what remains to the word. It says how
many documents of each length to take; which ones, a seeded hash decides, so reruns agree.

The tables of counts have one row for each source and length. A source of w words has at
most sqrt(2 w) lengths, which bounds what one task of the program reads. Documents are
ranked by one distributed sort of (source, length, hash, id), never inside a group.

A null text has size 0 and a document of size 0 is never taken, a null source is a source of
its own. Rows that repeat an id are ranked like any other rows. An empty table gives no rows,
and a source without words has the target 0. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskgraph.functions.order import with_row_position
from riskgraph.session import materialise

WEIGHTS = (3, 1, 2)
WORD = r"[^\x20\x09-\x0D]+"
#: The knapsack's budget is at most this many times the longest document of the source.
LONGEST_TIMES = 4


def sizes(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, size, *keep)."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD))
    return docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), words.cast("bigint").alias("size"),
                       *keep)


def targets(words: Sequence[int], share: float, most: float, weights: Sequence[int] = WEIGHTS) -> list[float]:
    """Words due to each source (in code-point order, null last): `share` of all words by repeating
    weights, at most `most` times its own; what is above goes to the others by weight."""
    weight = [weights[i % len(weights)] for i in range(len(words))]
    total, due = share * sum(words), [0.0] * len(words)
    open_ = [i for i in range(len(words))]
    while open_:
        level = total / sum(weight[i] for i in open_)
        full = [i for i in open_ if level * weight[i] > most * words[i]]
        if not full:
            for i in open_:
                due[i] = level * weight[i]
            break
        for i in full:
            due[i] = float(most * words[i])
            total -= due[i]
        open_ = [i for i in open_ if i not in set(full)]
    return due


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of `counts` documents of each length to take so that their words come nearest to `budget`.

    An even share first, then the longest that still leave the knapsack something to
    fit, then a program over reachable sums (one bit for each, lengths in binary bundles).
    """
    total = int((lengths * counts).sum())
    budget = min(max(budget, 0), total)
    if not len(lengths) or budget == 0:
        return np.zeros(len(lengths), np.int64)
    if budget == total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts], np.int64)
    rest = budget - int((taken * lengths).sum())
    room = LONGEST_TIMES * int(lengths.max())
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= room:
            break
        more = min(int(counts[i] - taken[i]), (rest - room) // int(lengths[i]) + 1)
        taken[i] += more
        rest -= more * int(lengths[i])
    # sums up to the longest document beyond the rest: the nearest may lie above it
    top = rest + int(lengths.max())
    reach, mask = 1, (1 << (top + 1)) - 1
    bundles: list[tuple[int, int]] = []
    before: list[int] = []
    for i in np.argsort(lengths, kind="stable"):
        free, size = int(min(counts[i] - taken[i], top // lengths[i])), 1
        while free > 0 and not reach >> rest & 1:
            size = min(size, free)
            before.append(reach)
            bundles.append((int(i), size))
            reach |= (reach << size * int(lengths[i])) & mask
            free -= size
            size *= 2
        if reach >> rest & 1:
            break
    under = (reach & ((1 << (rest + 1)) - 1)).bit_length() - 1
    over = reach >> rest
    gap = (over & -over).bit_length() - 1 if over else None
    at = rest + gap if gap is not None and gap < rest - under else under
    for (i, size), old in zip(reversed(bundles), reversed(before)):
        if not old >> at & 1:
            taken[i] += size
            at -= size * int(lengths[i])
    return taken


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """One source: (size, n, target) -> rounds that take every document, and how many one time more."""
    rows = rows.sort_values("size").reset_index(drop=True)
    lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    words = int((lengths * counts).sum())
    budget = int(round(float(rows["target"].iloc[0])))
    rounds, rest = divmod(budget, words) if words else (0, 0)
    rows["rounds"], rows["more"] = rounds, fit(lengths, counts, rest)
    return rows[["source", "size", "n", "rounds", "more"]]


def mix(docs: DataFrame, share: float = 1.5, most: int = 2, seed: int = 7, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, times, *keep) of every document; taken = size x times."""
    rows = materialise(sizes(docs, keep))
    counts = materialise(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    # one row for each source comes to the driver: sources are names that a person weights
    listed = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("w")).collect()
    listed.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    due = targets([r["w"] for r in listed], share, most)
    spark = docs.sparkSession
    known = spark.createDataFrame([(r["source"], r["w"], t) for r, t in zip(listed, due)],
                                  "source string, source_size long, target double")
    same = [F.col("source").eqNullSafe(F.col("_s"))]
    side = F.broadcast(known.withColumnRenamed("source", "_s"))
    plan = counts.where("size > 0").join(side, same).drop("_s").groupBy("source").applyInPandas(
        _plan, "source string, size long, n long, rounds long, more long")
    # rows of a (source, size) lie together in the sort: rank = position - first position of its group
    plan = materialise(plan)
    placed = with_row_position(rows, ["source", "size", F.xxhash64("doc_id", F.lit(seed)), "doc_id"])
    placed = materialise(placed)
    first = placed.groupBy("source", "size").agg(F.min("position").alias("_first"))
    groups = plan.select("source", "size", "rounds", "more").join(
        first.withColumnsRenamed({"source": "_s", "size": "_z"}),
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).drop("_s", "_z")
    groups = materialise(groups).withColumnsRenamed({"source": "_s", "size": "_z"})
    times = F.when(F.col("_z").isNull(), 0).otherwise(
        F.col("rounds") + (F.col("position") - F.col("_first") < F.col("more")).cast("int"))
    return (
        placed.join(groups, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")), "left")
        .select("doc_id", "source", "size", times.cast("bigint").alias("times"), *keep)
        .join(side, same)
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times", *keep)
    )


def take(docs: DataFrame, share: float = 1.5, most: int = 2, seed: int = 7) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with their columns.

    Rows are matched to the mix by a row number, not by id, so repeated ids and
    repeated rows are each taken as often as the mix says, never multiplied by each other.
    """
    numbered = materialise(docs.withColumn("_row", F.monotonically_increasing_id()))
    chosen = mix(numbered, share, most, seed, keep=("_row",)).where("times > 0").select("_row", "times")
    found = numbered.join(chosen, "_row")
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).select(*docs.columns)
