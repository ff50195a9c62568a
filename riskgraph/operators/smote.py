"""Minority oversampling between near neighbours."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskgraph.functions.order import with_row_position
from riskgraph.functions.rules import uniform
from riskgraph.session import materialise

NEIGHBOURS = 5
# Up to this many minority rows every row is compared with all of them.
EXACT_ROWS = 20_000
# Beyond it a row is compared with the rows of its stretch along a random projection.
STRETCH_ROWS = 8_192


def _nearest(queries: np.ndarray, own: np.ndarray, pool: np.ndarray, k: int) -> np.ndarray:
    """Indices into `pool` of the k nearest other rows; `own` is the query's own index."""
    out = np.empty((len(queries), k), dtype=np.int64)
    norms = (pool * pool).sum(axis=1)
    for start in range(0, len(queries), 512):
        q = queries[start:start + 512]
        d = norms[None, :] - 2 * q @ pool.T
        d[np.arange(len(q)), own[start:start + 512]] = np.inf
        out[start:start + 512] = _lowest(d, k)
    return out


def _lowest(d: np.ndarray, k: int) -> np.ndarray:
    """Per row the columns of the k lowest values, lowest first, ties by column; only those up to the k-th are sorted."""
    if k < 1:
        return np.empty((len(d), 0), dtype=np.int64)
    row, column = np.nonzero(d <= np.partition(d, k - 1, axis=1)[:, k - 1:k])
    order = np.lexsort((column, d[row, column], row))
    first = np.searchsorted(row, np.arange(len(d)))
    return column[order][first[:, None] + np.arange(k)]


def minority_neighbours(minority: DataFrame, features: Sequence[str], id_column: str, seed: int) -> DataFrame:
    """id, x (feature array), near (array of up to five neighbours' feature arrays)."""
    spark = minority.sparkSession
    x = F.array(*[F.col(c).cast("double") for c in features])
    rows = materialise(minority.select(F.col(id_column).alias("id"), x.alias("x")))
    n = rows.count()
    schema = "id string, x array<double>, near array<array<double>>"
    if n <= EXACT_ROWS:
        pool = rows.orderBy("id").toPandas()
        where = spark.sparkContext.broadcast(dict(zip(pool["id"], range(n))))
        matrix = spark.sparkContext.broadcast(np.array(pool["x"].tolist(), dtype=float).reshape(n, len(features)))

        def against_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                own = np.array([where.value[i] for i in b["id"]], dtype=np.int64)
                k = min(NEIGHBOURS, n - 1)
                near = _nearest(np.array(b["x"].tolist(), dtype=float), own, matrix.value, k) if len(b) else []
                yield b.assign(near=[[matrix.value[j].tolist() for j in r] for r in near])

        return rows.mapInPandas(against_all, schema)

    direction = np.random.default_rng(seed).normal(size=len(features)).tolist()
    along = F.aggregate(
        F.zip_with("x", F.array(*[F.lit(v) for v in direction]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v
    )
    placed = with_row_position(rows.withColumn("_along", along), ["_along", "id"], "_place")
    stretch = F.least(F.floor(F.col("_place") / STRETCH_ROWS), F.lit(max(0, n // STRETCH_ROWS - 1)))

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        m = np.array(group["x"].tolist(), dtype=float)
        near = _nearest(m, np.arange(len(m)), m, min(NEIGHBOURS, len(m) - 1))
        return pd.DataFrame({"id": group["id"], "x": group["x"], "near": [[m[j].tolist() for j in r] for r in near]})

    # A stretch has fewer than 2 * STRETCH_ROWS rows by construction.
    return placed.groupBy(stretch.alias("_stretch")).applyInPandas(lambda g: inside(g[["id", "x"]]), schema)


def smote(
    df: DataFrame, features: Sequence[str], label: str = "label", id_column: str = "transaction_id", seed: int = 42
) -> DataFrame:
    """(features.., label, synthetic): the table with minority rows added up to parity.

    A new row is base + u * (neighbour - base); base, neighbour and u are fixed by hashes.
    """
    df = materialise(df.select(id_column, *features, label))
    counts = {int(r[0]): r[1] for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()}
    original = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("int").alias(label),
                         F.lit(0).alias("synthetic"))
    if len(counts) < 2 or min(counts.values()) < 2 or counts[0] == counts[1]:
        return original
    minor = min(counts, key=lambda k: counts[k])
    have, wanted = counts[minor], max(counts.values()) - min(counts.values())
    near = materialise(minority_neighbours(df.where(F.col(label) == minor), features, id_column, seed))
    bases = with_row_position(near.withColumn("_h", uniform(F.col("id"), F.lit(seed))), ["_h", "id"], "_place")
    copies = F.lit(wanted // have) + F.when(F.col("_place") < wanted % have, 1).otherwise(0)
    made = bases.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    pick = F.floor(uniform(F.col("id"), F.col("_copy"), F.lit(seed + 1)) * F.size("near")).cast("int")
    u = uniform(F.col("id"), F.col("_copy"), F.lit(seed + 2))
    made = made.select("x", F.get("near", pick).alias("y"), u.alias("u"))
    synthetic = made.select(
        *[(F.get("x", F.lit(i)) + F.col("u") * (F.get("y", F.lit(i)) - F.get("x", F.lit(i)))).alias(c)
          for i, c in enumerate(features)],
        F.lit(minor).alias(label),
        F.lit(1).alias("synthetic"),
    )
    return original.unionByName(synthetic)
