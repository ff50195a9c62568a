"""Per-row feature contributions of a tree ensemble, and the tables built from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from riskgraph.functions import rules
from riskgraph.functions.rules import uniform
from riskgraph.operators.encode import clean_numeric, model_columns, prepare_matrix
from riskgraph.operators.training import BOOSTED, RiskModel
from riskgraph.session import new_path

PROXY_SAMPLE_SEED = 42


@dataclass
class Leaf:
    """One leaf: bounds of every feature on its path, share of rows passing each, value."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: float


def model_leaves(model: RiskModel, spark) -> list[Leaf]:
    """Leaves of the fitted ensemble from its saved node table (model-sized, not data-sized)."""
    path = new_path(spark, "trees")
    model.classifier.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount", "nodeData.impurityStats",
        "nodeData.leftChild", "nodeData.rightChild", F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).collect()
    trees: dict[int, dict[int, object]] = {}
    for n in nodes:
        trees.setdefault(n["treeID"], {})[n["id"]] = n
    weights = list(model.classifier.treeWeights)
    boosted = model.kind == BOOSTED
    leaves = []
    for tree, of_tree in trees.items():
        weight = weights[tree] if boosted else 1.0 / len(trees)
        waiting: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
        while waiting:
            at, path_so_far = waiting.pop()
            node = of_tree[at]
            if node["leftChild"] < 0:
                stats = node["impurityStats"]
                value = node["prediction"] if boosted else stats[1] / sum(stats)
                bounds = list(path_so_far.values())
                leaves.append(Leaf(
                    np.array(list(path_so_far), dtype=int),
                    np.array([b[0] for b in bounds]), np.array([b[1] for b in bounds]),
                    np.array([b[2] for b in bounds]), float(weight * value),
                ))
                continue
            f, t = node["feature"], node["threshold"]
            low, high, share = path_so_far.get(f, (-np.inf, np.inf, 1.0))
            for child, bounds in (
                (node["leftChild"], (low, min(high, t))), (node["rightChild"], (max(low, t), high))
            ):
                part = of_tree[child]["rawCount"] / max(node["rawCount"], 1)
                waiting.append((child, {**path_so_far, f: (*bounds, share * part)}))
    return leaves


def base_value(leaves: Sequence[Leaf]) -> float:
    """Expected output over the training rows."""
    return float(sum(leaf.value * leaf.share.prod() for leaf in leaves))


def _pattern_table(leaf: Leaf, patterns: np.ndarray) -> np.ndarray:
    """Shapley values of one leaf for patterns of satisfied path features: (patterns, features)."""
    m = len(leaf.features)
    met = ((patterns[:, None] >> np.arange(m)) & 1).astype(float)
    out = np.empty((len(patterns), m))
    weight = [factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)]
    for j in range(m):
        # Coefficient k: total over coalitions of k other features that keep the leaf reachable.
        poly = np.zeros((len(patterns), m))
        poly[:, 0] = 1.0
        for i in range(m):
            if i != j:
                up = poly[:, :-1] * met[:, i:i + 1]
                poly *= leaf.share[i]
                poly[:, 1:] += up
        out[:, j] = leaf.value * (met[:, j] - leaf.share[j]) * (poly @ weight)
    return out


def contributions(x: np.ndarray, leaves: Sequence[Leaf]) -> np.ndarray:
    """Exact path-dependent Shapley values, rows by features."""
    out = np.zeros(x.shape)
    for leaf in leaves:
        m = len(leaf.features)
        if m == 0:
            continue
        values = x[:, leaf.features]
        met = (values > leaf.low) & (values <= leaf.high)
        pattern = met @ (1 << np.arange(m))
        seen, place = np.unique(pattern, return_inverse=True)
        out[:, leaf.features] += _pattern_table(leaf, seen)[place]
    return out


def explain_rows(df: DataFrame, model: RiskModel, id_column: str = "transaction_id") -> DataFrame:
    """Long table: id, feature, shap_value, feature_value, abs_shap, base_value.

    Contributions of one row add up, with the base value, to the margin of boosted
    trees or to the probability of a forest.
    """
    spark = df.sparkSession
    features = model.features
    leaves = model_leaves(model, spark)
    shared = spark.sparkContext.broadcast(leaves)

    @F.pandas_udf("array<double>")
    def shap(batch: pd.Series) -> pd.Series:
        x = np.array(batch.tolist(), dtype=float).reshape(len(batch), -1)
        return pd.Series(list(contributions(x, shared.value)))

    ready = clean_numeric(df.select(id_column, *features), features)
    x = F.array(*[F.col(c).cast("double") for c in features])
    names = F.array(*[F.lit(c) for c in features])
    rows = ready.select(id_column, x.alias("x")).withColumn("s", shap("x"))
    long = rows.select(id_column, F.explode(F.arrays_zip(
        names.alias("feature"), F.col("s").alias("shap_value"), F.col("x").alias("feature_value")
    )).alias("e"))
    return long.select(
        id_column, "e.feature", "e.shap_value", "e.feature_value",
        F.abs("e.shap_value").alias("abs_shap"), F.lit(base_value(leaves)).alias("base_value"),
    )


def hash_sample(df: DataFrame, rows: int | None = None, id_column: str = "transaction_id", seed: int = PROXY_SAMPLE_SEED) -> DataFrame:
    """A fixed random sample: the `rows` lowest hashes of the id; all rows without a number.

    The bulk is refused by a threshold before anything is ordered.
    """
    if rows is None:
        return df
    n = df.count()
    if n <= rows:
        return df
    key = uniform(F.col(id_column), F.lit(seed))
    offered = df.where(key < F.lit(min(1.0, (2 * rows + 64) / n)))
    return offered.orderBy(key, id_column).limit(rows)


def global_importance(df: DataFrame, model: RiskModel, sample_size: int | None = None) -> DataFrame:
    """Mean absolute contribution per feature, over all rows or a sample."""
    return (
        explain_rows(hash_sample(df, sample_size), model)
        .groupBy("feature").agg(F.avg("abs_shap").alias("shap_importance"))
        .orderBy(F.desc("shap_importance"), "feature")
    )


def variance_importance(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Without a model: each feature's share of the summed sample variances."""
    ready = clean_numeric(df.select(*features), features)
    row = ready.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in features])
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c), F.lit(0.0)).alias("v")) for c in features
    ])).alias("e")).select("e.*")
    total = F.sum("v").over(Window.partitionBy())  # one row per feature
    return long.select("feature", F.when(total > 0, F.col("v") / total).otherwise(F.lit(0.0)).alias("shap_importance")).orderBy(
        F.desc("shap_importance"), "feature"
    )


def importance_proxy(model: RiskModel, spark) -> DataFrame:
    """Without contributions: the model's own importances in their place."""
    return model.importance(spark).withColumnRenamed("importance", "shap_importance")


def top_contributors(contributed: DataFrame, k: int = 5, id_column: str = "transaction_id") -> DataFrame:
    """The k largest contributions per row and their direction."""
    by_size = Window.partitionBy(id_column).orderBy(F.desc(F.abs("shap_value")), "feature")
    return (
        contributed.withColumn("rank", F.row_number().over(by_size)).where(F.col("rank") <= k)
        .select(
            id_column, "rank", "feature", F.col("feature_value").alias("value"),
            F.col("shap_value").alias("shap_impact"),
            F.when(F.col("shap_value") > 0, "increases").otherwise("decreases").alias("direction"),
        )
    )


def explanations(df: DataFrame, model: RiskModel, k: int = 5) -> DataFrame:
    """Top contributors of every row with its probability and risk level."""
    scored = model.score(df.select("transaction_id", *model.features))
    level = scored.select("transaction_id", "fraud_probability",
                          rules.risk_level(F.col("fraud_probability")).alias("risk_level"))
    return top_contributors(explain_rows(df, model), k).join(level, "transaction_id")


def align(df: DataFrame, keep: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """The fixed feature list as far as present, numeric and without holes."""
    return prepare_matrix(df, model_columns(df), keep)


def beeswarm_table(df: DataFrame, model: RiskModel, sample_size: int | None = None) -> DataFrame:
    """Long (feature, feature_value, shap_value) rows behind a summary plot."""
    return explain_rows(hash_sample(df, sample_size), model).select(
        "transaction_id", "feature", "feature_value", "shap_value"
    )
