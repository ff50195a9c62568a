"""Isolation forest: exact per-tree samples by lowest draw, trees grown in parallel groups, scored in Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskgraph.functions.order import exact_quantile
from riskgraph.functions.rules import flag, uniform
from riskgraph.operators.encode import prepare_matrix, scaling
from riskgraph.session import materialise

TREES = 200
SAMPLE = 256
# Rows that walk the trees together.
BLOCK_ROWS = 2048
EULER = 0.5772156649015329
TREE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double"
TREE_SCHEMA_NAMES = ["tree", "node", "feature", "threshold", "left", "right", "path"]


def _usual_path(n):
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * (np.log(big - 1) + EULER) - 2 * (big - 1) / big))


@dataclass
class Detector:
    """Fitted forest: scaling, node arrays shaped (trees, nodes) and the decision offset."""

    columns: list[str]
    scale: dict[str, tuple[float, float]]
    nodes: dict[str, np.ndarray]
    sample: int
    offset: float = 0.0


def _grow(seed: int, depth_limit: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        tree = int(pdf["tree"].iloc[0])
        x = np.array(pdf["x"].tolist(), dtype=float)
        rng = np.random.default_rng([seed, tree])
        rows: list[list] = []
        waiting = [(np.arange(len(x)), 0, -1, "left")]
        while waiting:
            members, depth, parent, side = waiting.pop()
            me = len(rows)
            if parent >= 0:
                rows[parent][4 if side == "left" else 5] = me
            low, high = x[members].min(axis=0), x[members].max(axis=0)
            varying = np.flatnonzero(high > low)
            if depth >= depth_limit or len(members) <= 1 or len(varying) == 0:
                rows.append([tree, me, -1, 0.0, me, me, depth + float(_usual_path(len(members)))])
                continue
            f = int(rng.choice(varying))
            # uniform() may round up to `high` between neighbouring doubles: every row would go
            # left. Below `high` by one step, the row at `low` still goes left, the one at `high` right.
            t = min(float(rng.uniform(low[f], high[f])), float(np.nextafter(high[f], -np.inf)))
            rows.append([tree, me, f, t, -1, -1, 0.0])
            goes_left = x[members, f] <= t
            waiting.append((members[~goes_left], depth + 1, me, "right"))
            waiting.append((members[goes_left], depth + 1, me, "left"))
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "path"])

    return grow


def _bottom_k(rows: DataFrame, n: int, trees: int, k: int, seed: int) -> DataFrame:
    """(tree, id, x): for each tree exactly the k rows with the lowest draws (ties by id).

    A row's draw for a tree is a hash of (id, tree), so reruns and lost tasks draw the same.
    One JVM-side pass meets each row with every tree and keeps the draws below a bar that
    about 2k + 64 rows pass; the exact k lowest per tree are then ranked among those few.
    Should a tree fall short of k, the bar is raised and the pass repeated, so the sample
    is exact at every size, and no tree ever groups more than a few k rows.
    """
    room = 2.0
    while True:
        bar = min(1.0, (room * k + 64) / max(n, 1))
        offered = rows.select("id", "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumn(
            "draw", uniform(F.col("id"), F.col("tree"), F.lit(seed + 1)))
        passed = materialise(offered.where(F.col("draw") < F.lit(bar)).select("tree", "draw", "id", "x"))
        full = passed.groupBy("tree").count().where(F.col("count") >= k).count()
        if full == trees or bar >= 1.0:
            break
        room *= 4
    lowest = F.row_number().over(Window.partitionBy("tree").orderBy("draw", "id"))
    return passed.withColumn("_rank", lowest).where(F.col("_rank") <= k).select("tree", "id", "x")


def fit(
    df: DataFrame,
    columns: Sequence[str],
    id_column: str = "transaction_id",
    trees: int = TREES,
    sample: int = SAMPLE,
    contamination: float = 0.05,
    seed: int = 42,
) -> Detector:
    """Grow the forest on scaled features and place the offset at the contamination quantile.

    Each tree grows on the min(sample, rows) rows of lowest draw (`_bottom_k`); only the
    scaling aggregate, the drawing pass and one scoring pass (offset) read all rows.
    An empty table gives a detector without trees, whose scores are all 0.
    """
    columns = list(columns)
    ready = prepare_matrix(df, columns, keep=(id_column,))
    scale = scaling(ready, columns)
    x = F.array(*[((F.col(c) - F.lit(scale[c][0])) / F.lit(scale[c][1])).cast("double") for c in columns])
    rows = ready.select(F.col(id_column).alias("id"), x.alias("x"))
    n = rows.count()
    per_tree = min(sample, n)
    if per_tree == 0:
        return Detector(columns, scale, _arrays(pd.DataFrame(columns=TREE_SCHEMA_NAMES), 0), 0)
    drawn = _bottom_k(rows, n, trees, per_tree, seed)
    depth = int(np.ceil(np.log2(max(per_tree, 2))))
    # Bounded: a tree of k rows has at most 2k - 1 nodes, so trees * (2k - 1) rows come back.
    table = drawn.groupBy("tree").applyInPandas(_grow(seed, depth), TREE_SCHEMA).toPandas()
    detector = Detector(columns, scale, _arrays(table, trees), per_tree)
    scores = materialise(ready.select(_score(detector, scaled=False).alias("s")))
    detector.offset = exact_quantile(scores, "s", contamination) or 0.0
    return detector


def save(spark, detector: Detector, path: str) -> str:
    """Write the detector as two tables under `path`: `nodes` of the forest, `meta` of scaling and offset."""
    a = detector.nodes
    trees, width = a["feature"].shape
    node_rows = [
        (t, i, int(a["feature"][t, i]), float(a["threshold"][t, i]), int(a["left"][t, i]), int(a["right"][t, i]),
         float(a["path"][t, i]))
        for t in range(trees) for i in range(width) if a["left"][t, i] >= 0
    ]
    spark.createDataFrame(node_rows, TREE_SCHEMA).write.parquet(f"{path}/nodes")
    meta = [(i, c, float(detector.scale[c][0]), float(detector.scale[c][1]), float(detector.offset), int(detector.sample),
             int(trees)) for i, c in enumerate(detector.columns)]
    spark.createDataFrame(
        meta, "position int, column string, center double, spread double, offset double, sample int, trees int"
    ).write.parquet(f"{path}/meta")
    return path


def load(spark, path: str) -> Detector:
    """The detector that `save` wrote; its size is checked against the bound of a forest."""
    meta = spark.read.parquet(f"{path}/meta").orderBy("position").collect()
    trees, sample = (meta[0]["trees"], meta[0]["sample"]) if meta else (0, 0)
    bound = trees * max(2 * sample - 1, 1)
    table = spark.read.parquet(f"{path}/nodes").limit(bound + 1).toPandas()
    if len(table) > bound:
        raise ValueError(f"{path}: more nodes than {trees} trees of {sample} rows can have")
    scale = {r["column"]: (r["center"], r["spread"]) for r in meta}
    detector = Detector([r["column"] for r in meta], scale, _arrays(table, trees), sample)
    detector.offset = meta[0]["offset"] if meta else 0.0
    return detector


def _arrays(table: pd.DataFrame, trees: int) -> dict[str, np.ndarray]:
    width = int(table["node"].max()) + 1 if len(table) else 1
    out = {}
    for c, kind in (("feature", int), ("threshold", float), ("left", int), ("right", int), ("path", float)):
        a = np.full((trees, width), -1 if kind is int else 0.0, dtype=kind)
        a[table["tree"].to_numpy(dtype=int), table["node"].to_numpy(dtype=int)] = table[c].to_numpy(dtype=kind)
        out[c] = a
    return out


def _score(detector: Detector, scaled: bool):
    """Column with minus the anomaly score of the row: the lower, the more anomalous."""
    columns, scale = detector.columns, detector.scale
    spark_x = F.array(*[
        (F.col(c) if scaled else (F.col(c) - F.lit(scale[c][0])) / F.lit(scale[c][1])).cast("double") for c in columns
    ])
    trees = len(detector.nodes["feature"])
    usual, levels = float(_usual_path(detector.sample)) or 1.0, _levels(detector.nodes)
    # One broadcast for all batches; trees x 2^depth numbers.
    shared = SparkSession.active().sparkContext.broadcast(_heaps(detector.nodes, levels))

    @F.pandas_udf("double")
    def walk(batch: pd.Series) -> pd.Series:
        feature, threshold, path = shared.value
        if not trees:
            return pd.Series(np.zeros(len(batch)))
        total = np.zeros(len(batch))
        for start in range(0, len(batch), BLOCK_ROWS):
            x = np.array(batch.iloc[start:start + BLOCK_ROWS].tolist(), dtype=float)
            flat, row = x.ravel(), np.arange(len(x)) * x.shape[1]
            for t in range(trees):
                at = np.zeros(len(x), dtype=np.intp)
                for _ in range(levels):
                    at = 2 * at + 1 + ~(flat[row + feature[t].take(at)] <= threshold[t].take(at))
                total[start:start + BLOCK_ROWS] += path[t].take(at)
        return pd.Series(-np.power(2.0, -total / trees / usual))

    return walk(spark_x)


def _levels(nodes: dict[str, np.ndarray]) -> int:
    """Levels of the deepest tree below its root."""
    left, right, inner = nodes["left"], nodes["right"], nodes["feature"] >= 0
    at = np.zeros(inner.shape, dtype=bool)
    at[:, 0] = True
    deep = 0
    while (at & inner).any():
        deep += 1
        below = np.zeros(inner.shape, dtype=bool)
        tree, node = np.nonzero(at & inner)
        below[tree, left[tree, node]] = below[tree, right[tree, node]] = True
        at = below
    return deep


def _heaps(nodes: dict[str, np.ndarray], levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, threshold, path) of every tree as a full binary tree, children of i at 2i + 1 and 2i + 2.

    Below a leaf there are copies of it, whichever side a row takes, so all rows walk the
    same number of steps.
    """
    trees = len(nodes["feature"])
    at = np.full((trees, 2 ** (levels + 1) - 1), 0)
    for i in range(2 ** levels - 1):
        tree = np.arange(trees)
        inner = nodes["feature"][tree, at[:, i]] >= 0
        for child, side in ((2 * i + 1, "left"), (2 * i + 2, "right")):
            at[:, child] = np.where(inner, nodes[side][tree, at[:, i]], at[:, i])
    tree = np.arange(trees)[:, None]
    return np.maximum(nodes["feature"][tree, at], 0), nodes["threshold"][tree, at], nodes["path"][tree, at]


def minmax_inverted(df: DataFrame, column: str, name: str = "anomaly_score") -> DataFrame:
    """(max - s) / (max - min); a column without range becomes 0."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or high == low:
        return df.withColumn(name, F.when(F.col(column).isNotNull(), F.lit(0.0)))
    return df.withColumn(name, (F.lit(high) - F.col(column)) / F.lit(high - low))


def flag_anomalies(df: DataFrame, column: str = "anomaly_raw") -> DataFrame:
    """`is_anomaly`: the raw score lies below the offset (raw scores are relative to it)."""
    return df.withColumn("is_anomaly", flag(F.col(column) < 0))


def detect(df: DataFrame, detector: Detector, id_column: str = "transaction_id") -> DataFrame:
    """`df` with anomaly_score in [0, 1] and is_anomaly."""
    inputs = [c for c in detector.columns]
    ready = prepare_matrix(
        df.withColumn("_row", F.struct(*df.columns)), inputs, keep=(id_column, "_row")
    )
    raw = ready.select("_row", (_score(detector, scaled=False) - F.lit(detector.offset)).alias("anomaly_raw"))
    raw = materialise(raw.select("_row.*", "anomaly_raw"))
    return flag_anomalies(minmax_inverted(raw, "anomaly_raw")).drop("anomaly_raw")


def top_anomalies(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.where(F.col("anomaly_score") >= threshold).orderBy(F.desc("anomaly_score"), "transaction_id")
