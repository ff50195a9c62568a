"""Row counts of the cleaning job, and sources."""

from pyspark.sql import Observation, functions as F

from riskgraph import fixtures as fx
from riskgraph.operators import clean
from riskgraph.sources.files import normalise_layout, parse_timestamp


def test_rows_in_and_out(spark, sf):
    before, after = Observation(), Observation()
    dirty = fx.transactions_dirty(spark, sf)
    kept = clean.clean(dirty, fx.AS_OF, (before, after)).collect()
    assert before.get["rows"] == dirty.count() and after.get["rows"] == len(kept)


def test_an_often_repeated_id_keeps_its_first_row(spark):
    df = spark.range(1000).select(F.col("id").alias("_seq"), F.lit("same").alias("transaction_id")).repartition(5)
    assert [r["_seq"] for r in clean.drop_duplicate_ids(df).collect()] == [0]


def test_other_layouts_pass_through(spark, sf):
    df = fx.transactions(spark, sf)
    assert normalise_layout(df) is df


def test_text_that_is_no_timestamp_becomes_null(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("soon",)], "timestamp string")
    assert [r[0] is None for r in parse_timestamp(df).collect()] == [False, True]
