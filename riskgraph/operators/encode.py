"""Categorical codes, numeric clean-up, scaling and feature lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from riskgraph.functions import skew
from riskgraph.functions.order import with_row_position
from riskgraph.functions.skew import attach
from riskgraph.schemas import MODEL_FEATURES, NOT_FEATURES
from riskgraph.session import materialise, materialise_with


def first_seen_codes(df: DataFrame, columns: Sequence[str], order: str = "_seq") -> tuple[DataFrame, int]:
    """(name, category, code, n) for all columns and its length.

    Codes count up in the order the categories of a column first appear. The rows are
    reduced to one per category before anything is ordered; only a table counted to be
    short is numbered in a window, a long one is sorted in parallel.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("category")) for c in columns])
    seen, size = materialise_with(
        df.select(F.explode(pairs).alias("e"), F.col(order).alias("_o")).where("e.category is not null")
        .groupBy("e.name", "e.category").agg(F.min("_o").alias("_first"), F.count(F.lit(1)).alias("n"))
    )
    rows = size["rows"]
    if rows <= skew.BROADCAST_ROWS:
        by_name = Window.partitionBy("name").orderBy("_first", "category")
        coded = materialise(seen.withColumn("code", F.row_number().over(by_name) - 1))
    else:
        placed = with_row_position(seen, ["name", "_first", "category"], "_place")
        starts = F.broadcast(placed.groupBy("name").agg(F.min("_place").alias("_start")))  # one row per column
        coded = materialise(placed.join(starts, "name").withColumn("code", F.col("_place") - F.col("_start")))
    return coded.select("name", "category", F.col("code").cast("int").alias("code"), "n"), rows


def _coded(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """Adds `_code_<column>` for every column."""
    codes, rows = first_seen_codes(df, columns, order)
    for c in columns:
        mine = codes.where(F.col("name") == c).select(
            F.col("category").alias(c), F.col("code").alias(f"_code_{c}"), F.col("n").alias("_n")
        )
        df = attach(df, mine, c, weight="_n", right_rows=rows).drop("_n")
    return df


def encode_first_seen(
    df: DataFrame,
    columns: Sequence[str] = ("merchant_category", "entry_mode", "currency"),
    order: str = "_seq",
) -> DataFrame:
    names = df.columns
    return _coded(df, columns, order).select(*names, *[F.col(f"_code_{c}").alias(f"{c}_encoded") for c in columns])


def factorize(df: DataFrame, columns: Sequence[str], order: str = "_seq") -> DataFrame:
    """Replace string columns by first-seen codes, null by -1."""
    chosen = set(columns)
    return _coded(df, columns, order).select(
        *[F.coalesce(F.col(f"_code_{c}"), F.lit(-1)).alias(c) if c in chosen else c for c in df.columns]
    )


def clean_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null, NaN and both infinities become 0."""
    types = {f.name: f.dataType for f in df.schema}
    fixed = {}
    for c in columns:
        v = F.col(c)
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            bad = v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
            fixed[c] = F.when(bad, F.lit(0.0)).otherwise(v)
        else:
            fixed[c] = F.coalesce(v, F.lit(0).cast(types[c]))
    return df.withColumns(fixed)


def scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column from one aggregate; no deviation counts as 1."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standard_scale(
    df: DataFrame, columns: Sequence[str], fitted: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    fitted = fitted or scaling(df, columns)
    return df.withColumns({c: (F.col(c) - F.lit(fitted[c][0])) / F.lit(fitted[c][1]) for c in columns})


def feature_columns(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES, extra_exclude: Sequence[str] = ()) -> list[str]:
    """All columns but the excluded ones; helper columns (leading underscore) never count."""
    skip = {*exclude, *extra_exclude}
    return [c for c in df.columns if c not in skip and not c.startswith("_")]


def model_columns(df: DataFrame) -> list[str]:
    """The fixed list, as far as present."""
    present = set(df.columns)
    return [c for c in MODEL_FEATURES if c in present]


def prepare_matrix(
    df: DataFrame,
    columns: Sequence[str],
    keep: Sequence[str] = ("transaction_id",),
    order: str = "_seq",
) -> DataFrame:
    """Numeric, hole-free feature table: strings coded, bad numbers zeroed."""
    strings = [f.name for f in df.schema if f.name in set(columns) and isinstance(f.dataType, T.StringType)]
    carried = [c for c in dict.fromkeys([*keep, order, *columns]) if c in df.columns]
    out = df.select(*carried)
    if strings:
        out = factorize(out, strings, order)
    out = clean_numeric(out, list(columns))
    return out.select(*[c for c in keep if c in out.columns], *columns)
