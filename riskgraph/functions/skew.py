"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskgraph.session import materialise, materialise_with

# A side is broadcast only after it has been counted and found no longer than this.
BROADCAST_ROWS = 200_000
# The same inside an iteration, where every round broadcasts again and what passes the driver adds up.
LOOP_BROADCAST_ROWS = 10_000
# A key is hot when it holds more rows than both of these allow; the second
# bounds the list of hot keys: at most HOT_SHARE keys can hold 1/HOT_SHARE each.
HOT_ROWS = 1_000_000
HOT_SHARE = 10_000


def loop_rows() -> int:
    """The `broadcast_rows` of joins that an iteration repeats."""
    return min(LOOP_BROADCAST_ROWS, BROADCAST_ROWS)


def attach(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    how: str = "left",
    weight: str | None = None,
    broadcast_rows: int | None = None,
    hot_rows: int | None = None,
    right_rows: int | None = None,
) -> DataFrame:
    """Join `right` to `left` on `key`, spreading hot keys of `left` over many tasks.

    `right` is computed once and counted. Small: broadcast. Otherwise the keys that
    are hot in `left` get several salts: a left row takes one of them by its hash, the
    matching right rows are repeated once per salt, and the result is the same as the
    plain join. `weight` names a column of `right` that already holds the number of
    left rows per key; without it the left keys are counted. A caller that has already
    computed and counted `right` passes its length as `right_rows`. A side that is too
    long is joined by shuffle even where its file is small enough for Spark to broadcast.
    """
    keys = [key] if isinstance(key, str) else list(key)
    broadcast_rows = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    if right_rows is None:
        right, seen = materialise_with(right)
        right_rows = seen["rows"]
    if right_rows <= broadcast_rows:
        return left.join(F.broadcast(right), keys, how)
    counts = (
        right.select(*keys, F.col(weight).alias("_n"))
        if weight
        else left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    )
    hot = hot_keys(counts, keys, hot_rows)
    return spread_join(left, right, keys, how, hot)


def spread_join(
    left: DataFrame, right: DataFrame, key: str | Sequence[str], how: str = "left", hot: DataFrame | None = None
) -> DataFrame:
    """The shuffle join of `attach` for a caller that already knows the `hot_keys` of `left` (None: there is none)."""
    keys = [key] if isinstance(key, str) else list(key)
    if hot is None:
        return left.join(right.hint("merge"), keys, how)
    spread = F.xxhash64(*left.columns)
    salted_left = left.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.coalesce(F.pmod(spread, F.col("_salts")), F.lit(0))
    ).drop("_salts")
    salted_right = right.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1).cast("array<bigint>"))
    ).drop("_salts")
    return salted_left.join(salted_right.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def hot_keys(counts: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """Keys of `counts(keys.., _n)` above the hot limit with their number of `_salts`.

    None when there is none. Never longer than HOT_SHARE rows.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    counts = materialise(counts)
    total, largest = counts.agg(F.sum("_n"), F.max("_n")).first()
    limit = max(hot_rows, (total or 0) // HOT_SHARE)
    if not largest or largest <= limit:
        return None
    return counts.where(F.col("_n") > limit).select(*keys, F.ceil(F.col("_n") / F.lit(limit)).alias("_salts"))
