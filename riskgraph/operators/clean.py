"""Cleaning steps, each `DataFrame -> DataFrame`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window, functions as F
from pyspark.sql import types as T

from riskgraph.functions.order import exact_quantiles
from riskgraph.session import materialise


def drop_duplicate_ids(df: DataFrame, id_column: str = "transaction_id", order: str = "_seq") -> DataFrame:
    """First row of every id in input order.

    Asking for rank 1 lets Spark apply the limit inside every input partition as
    well, so an id repeated very often is cut down before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(id_column).orderBy(order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def fill_strings(df: DataFrame, value: str = "UNKNOWN") -> DataFrame:
    return df.na.fill(value, subset=[f.name for f in df.schema if isinstance(f.dataType, T.StringType)])


def _numeric(df: DataFrame, skip: tuple[str, ...] = ("_seq",)) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def fill_medians(df: DataFrame) -> DataFrame:
    """Null and NaN numerics become the exact median of their column."""
    numeric = _numeric(df)
    real = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name in numeric]
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in real})
    nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in numeric]).first()
    holed = [c for c in numeric if nulls[c]]
    if not holed:
        return df
    medians = exact_quantiles(df, {c: [0.5] for c in holed})
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0])) for c in holed
    })


def positive_amounts(df: DataFrame) -> DataFrame:
    """Rows with an amount above zero; NaN is none."""
    return df.where((F.col("amount") > 0) & ~F.isnan(F.col("amount").cast("double")))


def not_future(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rows before `as_of`; the present moment when none is given."""
    limit = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return df.where(F.col("timestamp") < limit)


def clean(df: DataFrame, as_of: str | None = None, observe: tuple[Observation, Observation] | None = None) -> DataFrame:
    """All steps in order. `observe` collects `rows` before and after as the job runs."""
    if observe:
        df = df.observe(observe[0], F.count(F.lit(1)).alias("rows"))
    # written once: counting holes, the medians and the result would each repeat the shuffle
    df = materialise(drop_duplicate_ids(df))
    out = df.transform(fill_strings).transform(fill_medians).transform(positive_amounts).transform(not_future, as_of)
    return out.observe(observe[1], F.count(F.lit(1)).alias("rows")) if observe else out
