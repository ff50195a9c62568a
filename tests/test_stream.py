"""Streams over several files give the batch results."""

import pytest
from pyspark.sql import functions as F

from riskgraph import fixtures as fx
from riskgraph.operators.scoring import score_by_rules
from riskgraph.streaming import live


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    at = tmp_path_factory.mktemp("stream")
    spark.read.parquet(f"{sf}/events.parquet").repartition(5).write.parquet(f"{at}/events.parquet")
    return str(at)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def stream(spark, folder):
    return live.read_event_stream(spark, folder, files_per_batch=1)


def demo(df):
    return live.score_stream(df.withColumn("fraud_probability", F.col("demo_probability")))


def test_scores(spark, folder):
    got = live.run_to_table(live.score_stream(stream(spark, folder)), "t")
    want = live.score_stream(score_by_rules(fx.transactions(spark, folder)))
    assert rows(got.select("transaction_id", "fraud_probability")) == rows(want.select("transaction_id", "fraud_probability"))


def test_strip(spark, folder):
    assert "is_fraud" not in live.strip_labels(stream(spark, folder)).columns


def test_stats_and_feed_and_alerts(spark, folder):
    batch = demo(fx.transactions(spark, folder))
    assert rows(live.run_latest(live.live_stats(demo(stream(spark, folder))), "s")) == rows(live.live_stats(batch))
    assert rows(live.recent_feed(demo(stream(spark, folder)))) == rows(live.latest(batch))
    assert rows(live.run_to_table(live.alerts(demo(stream(spark, folder))), "a")) == rows(live.alerts(batch))


def test_stats_of_nothing(spark):
    empty = spark.createDataFrame([], "fraud_probability double, risk_level string")
    assert set(live.live_stats(empty).first()) == {0}


def test_feed_survives_a_restart(spark, sf, tmp_path):
    """Two files arrive, the query stops; a third arrives and a new query on the same path goes on."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    source = tmp_path / "in"
    first, second, third = events.randomSplit([1.0, 1.0, 1.0], seed=3)
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(f"{source}/events.parquet")
    feed = str(tmp_path / "feed")

    def run():
        return live.recent_feed(demo(live.read_event_stream(spark, str(source), files_per_batch=1)), most=5, path=feed)

    run()
    third.coalesce(1).write.mode("append").parquet(f"{source}/events.parquet")
    got = run()
    everything = demo(fx.events_to_transactions(events))
    assert rows(got) == rows(live.latest(everything, 5))
