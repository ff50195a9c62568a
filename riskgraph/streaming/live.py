"""Live scoring, statistics, feed and alerts on Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskgraph.fixtures import events_to_transactions
from riskgraph.functions import rules
from riskgraph.operators.scoring import score_by_rules
from riskgraph.schemas import EVENT_SCHEMA, LABEL_AND_SCORE_COLUMNS
from riskgraph.session import new_path, prepare

FEED_ROWS = 20


def read_event_stream(spark: SparkSession, sf_dir: str, files_per_batch: int = 64) -> DataFrame:
    """The event table as a stream of transactions, whether it is one file or a folder of files."""
    path = f"{sf_dir}/events.parquet"
    hadoop_path = prepare(spark).sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    if fs.getFileStatus(hadoop_path).isFile():
        events = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    else:
        events = reader.parquet(path)
    return events_to_transactions(events)


def strip_labels(df: DataFrame) -> DataFrame:
    """Remove the label and earlier scores, as a live row would arrive."""
    return df.drop(*[c for c in LABEL_AND_SCORE_COLUMNS if c in df.columns])


def score_stream(df: DataFrame, model=None) -> DataFrame:
    """The six output fields of a live transaction.

    Rules decide the level on the unrounded probability, as the model path does.
    """
    if model is not None:
        scored = model.score(df)
    elif "fraud_probability" in df.columns:
        scored = df
    else:
        scored = score_by_rules(df, keep_exact=True).withColumn("fraud_probability", F.col("_exact"))
    p = F.col("fraud_probability")
    return scored.select(
        "transaction_id", "timestamp", "amount", "account_id",
        F.round(p, 4).alias("fraud_probability"), rules.risk_level(p).alias("risk_level"),
    )


def live_stats(df: DataFrame) -> DataFrame:
    """Running totals over scored rows; zeros before the first row."""
    rows = F.count(F.lit(1))
    caught = F.coalesce(F.sum(F.when(F.col("fraud_probability") > 0.5, 1)), F.lit(0))
    return df.groupBy().agg(
        rows.alias("total_transactions"),
        caught.alias("detected_frauds"),
        F.round(F.when(rows > 0, caught / rows * 100).otherwise(F.lit(0.0)), 2).alias("fraud_rate"),
        F.coalesce(F.sum(F.when(F.col("risk_level") == "HIGH", 1)), F.lit(0)).alias("high_risk_count"),
        F.round(F.coalesce(F.avg("fraud_probability") * 100, F.lit(0.0)), 2).alias("avg_probability"),
    )


def alerts(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    return df.where(F.col("fraud_probability") > threshold)


def run_to_table(df: DataFrame, label: str) -> DataFrame:
    """Run a stream over what has arrived, appending to a parquet table, and read it."""
    spark = df.sparkSession
    path = new_path(spark, label)
    query = (
        df.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def run_latest(df: DataFrame, label: str) -> DataFrame:
    """Run a one-row running aggregate in complete mode and read its last state."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    query = (
        df.writeStream.format("memory").queryName(name).outputMode("complete")
        .option("checkpointLocation", new_path(df.sparkSession, label)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.table(name)


def latest(rows: DataFrame, most: int = FEED_ROWS) -> DataFrame:
    return rows.orderBy(F.desc("timestamp"), F.desc("transaction_id")).limit(most)


def _feed_folders(spark: SparkSession, path: str) -> dict[int, str]:
    """{batch id: folder} of the finished feeds written under `path`."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("batch-") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[int(name[len("batch-"):])] = status.getPath().toString()
    return found


def recent_feed(df: DataFrame, label: str = "feed", most: int = FEED_ROWS, path: str | None = None) -> DataFrame:
    """Keep the newest `most` scored rows over all batches, also across restarts.

    The feed is a numbered manifest: batch n writes `path/batch-n` from its rows and the
    feed of the highest finished batch before n, found by listing the folder. State is
    therefore on the shared file system and not in the driver: a query started again on
    the same `path` (its checkpoint is `path-state`) continues the feed it left, and a
    retried batch rewrites its own folder from the same predecessor. The feed is never
    longer than `most` rows.
    """
    spark = df.sparkSession
    path = path or new_path(spark, label)

    def keep(batch: DataFrame, batch_id: int) -> None:
        earlier = [n for n in _feed_folders(batch.sparkSession, path) if n < batch_id]
        rows = batch
        if earlier:
            rows = batch.unionByName(batch.sparkSession.read.schema(df.schema).parquet(f"{path}/batch-{max(earlier)}"))
        latest(rows, most).write.mode("overwrite").parquet(f"{path}/batch-{batch_id}")

    query = (
        df.writeStream.foreachBatch(keep).option("checkpointLocation", f"{path}-state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    done = _feed_folders(spark, path)
    if not done:
        return spark.createDataFrame([], df.schema)
    return latest(spark.read.schema(df.schema).parquet(done[max(done)]), most)
