"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskgraph.session import prepare

BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return start(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def start(spark: SparkSession) -> SparkSession:
    """Settings that bound the memory of a Python worker: few rows to a batch, few bytes too."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """`df` through `fn`, one Arrow batch at a time; `fn` returns the new columns by name.

    The columns of a batch are produced in the order of `schema`, which may have more
    or fewer rows than the batch.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8, null as empty."""
    return [b or b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


def text_bytes(column: str = "text"):
    """Length of a text in UTF-8 bytes, null as 0."""
    return F.coalesce(F.octet_length(F.col(column)), F.lit(0)).cast("bigint")
