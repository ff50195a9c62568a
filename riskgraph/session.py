"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def build_session(master: str | None = None, app: str = "riskgraph", **conf) -> SparkSession:
    """A session with the settings the operators rely on; `conf` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the clock zone every operator assumes and make sure checkpoints have a home."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    return spark


#: Called by `release`: what holds on to written tables lets go of them here.
ON_RELEASE: list[Callable[[], None]] = []
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, so it need not be installed there."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    _SHIPPED.add(application)
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="riskgraph-code-"), "riskgraph_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("riskgraph", os.path.relpath(path, here)))
    spark.sparkContext.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The folder that outlives executors: `spark.checkpoint.dir`, as the cluster names it.

    A local-mode session without that setting (tests, bench) gets a new temporary
    folder. A cluster session without it is refused, because a machine-local folder
    would not survive the loss of an executor.
    """
    ship(spark)
    sc = spark.sparkContext
    known = sc.getCheckpointDir()
    if known:
        return known.rsplit("/", 1)[0] if _is_uuid(known.rsplit("/", 1)[-1]) else known
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="riskgraph-")
    sc.setCheckpointDir(named)
    return named


def _is_uuid(text: str) -> bool:
    try:
        uuid.UUID(text)
    except ValueError:
        return False
    return True


def work_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared folder."""
    return f"{shared_dir(spark)}/riskgraph-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written table."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Delete every table this application wrote through `new_path`, once results are consumed."""
    for let_go in ON_RELEASE:
        let_go()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Compute `df` once into a written table in the shared folder and read it back.

    Lineage ends here, so a lost executor costs a re-read and not a re-run. A table is
    used and not `checkpoint()`: it is columnar and pruned when read, and its file size
    is its statistic, whereas a checkpoint keeps the estimate of the plan behind it,
    which in a loop of joins multiplies from round to round.
    """
    spark = df.sparkSession
    path = new_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_with(df: DataFrame, **observed: Column) -> tuple[DataFrame, dict]:
    """`materialise` that also returns aggregates collected by the same job.

    A retried task may be counted twice, so the numbers only steer decisions (is it
    empty, is it short enough to broadcast, has it converged); they are never results.
    """
    seen = Observation()
    out = materialise(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in observed.items()]))
    return out, seen.get
