"""CSV and parquet sources and sinks, timestamp parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskgraph.functions.order import with_row_position
from riskgraph.schemas import TRANSACTION_SCHEMA
from riskgraph.sources.cards import card_to_transactions


def read_transactions_csv(spark: SparkSession, path: str, schema=TRANSACTION_SCHEMA) -> DataFrame:
    """Header CSV with explicit types; the timestamp is parsed here and nowhere later."""
    return (
        spark.read.schema(schema).option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path)
    )


def read_transactions(spark: SparkSession, path: str, schema=TRANSACTION_SCHEMA) -> DataFrame:
    """Header CSV as `read_transactions_csv`, with `_seq`: the input order, gapless from 0.

    The order is the file path, then the place in the file (start of the split, then the
    row within it), so it is the order of the lines whatever the split sizes; the positions
    come from a distributed sort. The batch job (`plans.pipeline.full_run`) can read this directly.
    """
    raw = read_transactions_csv(spark, path, schema).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return with_row_position(raw, ["_file", "_start", "_row"], "_seq").drop("_file", "_start", "_row")


def normalise_layout(df: DataFrame, **card_options) -> DataFrame:
    """Card-layout tables become transactions, anything else passes unchanged."""
    if {"V1", "Class"} <= set(df.columns):
        return card_to_transactions(df, **card_options)
    return df


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option(
        "timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(path)
    return path


def write_scored(df: DataFrame, path: str) -> str:
    """Scored table by calendar date, so reports over a period prune folders."""
    df.withColumn("date", F.to_date("timestamp")).write.mode("overwrite").partitionBy("date").parquet(path)
    return path


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parse_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Text timestamps to timestamps; text that is none becomes null."""
    return df.withColumn(column, F.try_to_timestamp(F.col(column)))
