"""Exact order statistics, row positions and running totals without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskgraph.session import materialise

# Below this many distinct values the built-in exact percentile keeps its value map in one task.
BUILT_IN_LIMIT = 500_000
BINS = 4096


def exact_quantiles(
    df: DataFrame, wanted: dict[str, Sequence[float]], built_in_limit: int | None = None
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles per column, as driver-side numbers.

    One aggregate sizes every column. Columns with few values use `percentile`;
    the others narrow a histogram of at most BINS rows per pass until a single
    value is left, so no task ever holds the column. NaN counts as missing; infinities
    are values at either end.
    """
    limit = BUILT_IN_LIMIT if built_in_limit is None else built_in_limit
    df = df.select(*[_without_nan(F.col(c)).alias(c) for c in wanted])
    sizes = []
    for i, c in enumerate(wanted):
        v = F.col(c)
        real = F.when(F.abs(v) < F.lit(float("inf")), v)
        sizes += [
            F.count(v).alias(f"n{i}"),
            F.approx_count_distinct(v).alias(f"d{i}"),
            F.count_if(v == F.lit(float("-inf"))).alias(f"below{i}"),
            F.count(real).alias(f"real{i}"),
            F.min(real).alias(f"lo{i}"),
            F.max(real).alias(f"hi{i}"),
        ]
    size = df.agg(*sizes).first()
    out: dict[str, list[float | None]] = {}
    built_in = []
    for i, (c, probs) in enumerate(wanted.items()):
        n = size[f"n{i}"]
        if n == 0:
            out[c] = [None] * len(probs)
        elif min(n, 2 * size[f"d{i}"]) <= limit:
            built_in.append((i, c, probs))
        else:
            out[c] = [_interpolate(df, c, p * (n - 1), size[f"lo{i}"], size[f"hi{i}"], size[f"below{i}"], size[f"real{i}"]) for p in probs]
    if built_in:
        row = df.agg(
            *[
                F.percentile(F.col(c), F.array(*[F.lit(float(p)) for p in probs])).alias(f"q{i}")
                for i, c, probs in built_in
            ]
        ).first()
        for i, c, _ in built_in:
            out[c] = list(row[f"q{i}"])
    return out


def exact_quantile(df: DataFrame, column: str, p: float) -> float | None:
    return exact_quantiles(df, {column: [p]})[column][0]


def _without_nan(column: Column) -> Column:
    v = column.cast("double")
    return F.when(~F.isnan(v), v)


def _interpolate(df: DataFrame, column: str, position: float, low: float, high: float, below: int, real: int) -> float:
    """Value at a fractional rank; `below` rows are -inf, `real` rows finite, the others inf."""
    rank = int(position)
    if rank < below:
        value, last_rank = float("-inf"), below - 1
    elif rank >= below + real:
        return float("inf")
    else:
        value, _, last_rank = select_rank(df, F.col(column), rank - below, low, high)
        last_rank += below
    share = position - rank
    if share == 0 or rank < last_rank:
        return value
    above = float(df.where(F.col(column) > F.lit(value)).agg(F.min(column)).first()[0])
    return value * (1 - share) + above * share


def select_rank(df: DataFrame, column: Column, rank: int, low: float, high: float) -> tuple[float, int, int]:
    """Value at 0-based `rank` among the finite numbers of a column, and the first and last rank that value holds.

    Each pass cuts the range into BINS; where rounding no longer lets a pass cut it, the range
    holds a few thousand doubles at most, and they are counted one by one.
    """
    values = df.select(_without_nan(column).alias("v")).where(F.col("v").isNotNull())
    below, single = 0, False
    while True:
        width = high / BINS - low / BINS
        single = single or width <= 0
        place = F.col("v") if single else F.greatest(F.lit(0.0), F.least(
            F.floor(F.col("v") / F.lit(width) - F.lit(low / width)).cast("double"), F.lit(float(BINS - 1))))
        bins = (
            values.where(F.col("v").between(low, high))
            .groupBy(place.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .collect()
        )
        for b in sorted(bins, key=lambda r: r["bin"]):
            if below + b["n"] > rank:
                single = (b["lo"], b["hi"]) == (low, high)
                low, high, n = b["lo"], b["hi"], b["n"]
                break
            below += b["n"]
        else:
            raise ValueError(f"rank {rank} is outside the column")
        if low == high:
            return low, below, below + n - 1


def _sorted_and_numbered(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Range-partitioned sort, frozen, with `_part` (rank of the range) and `_index` in it."""
    frozen = materialise(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    return frozen.select(
        *df.columns,
        F.shiftright("_id", 33).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_index"),
    )


def with_row_position(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """0-based position of every row in the order given.

    The sort is distributed; only one count per sort partition is accumulated in a
    single window, so its length is the number of partitions and not of rows.
    """
    numbered = _sorted_and_numbered(df, order)
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"))
    )
    return numbered.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_index")).alias(name)
    )


def with_total_before(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum of `value` over all rows that come earlier in the order (0 for the first)."""
    numbered = _sorted_and_numbered(df, order)
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part").agg(F.sum(value).alias("_sum"))
        .select("_part", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_part").orderBy("_index").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0))).alias(name)
    )


#: Bits of a 52-bit key resolved per pass of `rank_limits`: 4,096 counts per wanted rank.
LIMIT_BITS = 12
KEY_BITS = 52


def rank_limits(
    df: DataFrame, group: str, key: str, tie: str, wanted: Sequence[tuple[object, int]]
) -> dict[tuple[object, int], tuple[int, str | None]]:
    """For each (group value, rank), the (key, tie) of the row at that 0-based rank, all found together.

    `key` is an integer column in [0, 2**52). Every pass counts the rows of all wanted
    ranks at once in 4,096 buckets of their current range (one aggregate, its rows
    bounded by ranks x 4,096), so five passes settle the key of every rank; one more
    query counts the distinct `tie` values of the settled keys. Six collects in all. Rows with equal key and
    tie are never split: a limit includes all of them.
    """
    ranges = {w: (0, KEY_BITS, 0) for w in wanted}  # lowest key, bits still open, rows below
    spark = df.sparkSession
    while any(bits > 0 for _, bits, _ in ranges.values()):
        open_ = [(i, w, *ranges[w]) for i, w in enumerate(wanted) if ranges[w][1] > 0]
        shift = {i: max(bits - LIMIT_BITS, 0) for i, _, _, bits, _ in open_}
        targets = spark.createDataFrame(
            [(i, g, lo, lo + (1 << bits), shift[i]) for i, (g, _), lo, bits, _ in open_],
            f"_t int, _g {df.schema[group].dataType.simpleString()}, _lo long, _hi long, _shift int",
        )
        hits = df.select(group, key).join(
            F.broadcast(targets),  # one row per wanted rank
            F.col(group).eqNullSafe(F.col("_g")) & (F.col(key) >= F.col("_lo")) & (F.col(key) < F.col("_hi")),
        )
        counts: dict[int, list] = {}
        for r in hits.groupBy("_t", F.expr(f"shiftright(`{key}` - _lo, _shift)").alias("_b")).agg(
            F.count(F.lit(1)).alias("_n")
        ).collect():
            counts.setdefault(r["_t"], []).append((r["_b"], r["_n"]))
        for i, w, lo, bits, below in open_:
            for b, n in sorted(counts.get(i, [])):
                if below + n > w[1]:
                    ranges[w] = (lo + (b << shift[i]), shift[i], below)
                    break
                below += n
            else:
                raise ValueError(f"rank {w[1]} is outside group {w[0]!r}")
    settled = spark.createDataFrame(
        list({(w[0], ranges[w][0]) for w in wanted}), f"_g {df.schema[group].dataType.simpleString()}, _v long"
    )
    tied = df.join(F.broadcast(settled), F.col(group).eqNullSafe(F.col("_g")) & (F.col(key) == F.col("_v")))
    found: dict[tuple, list] = {}
    for r in tied.groupBy("_g", "_v", tie).agg(F.count(F.lit(1)).alias("_n")).collect():
        found.setdefault((r["_g"], r["_v"]), []).append((r[tie], r["_n"]))
    out = {}
    for w in wanted:
        value, _, below = ranges[w]
        for t, n in sorted(found[(w[0], value)], key=lambda x: (x[0] is not None, x[0])):
            below += n
            if below > w[1]:
                out[w] = (value, t)
                break
    return out
