"""End-to-end jobs: clean -> features -> graph -> anomaly -> score."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from riskgraph.functions.skew import attach
from riskgraph.operators import anomaly, clean, encode, features, scoring
from riskgraph.operators.components import account_components
from riskgraph.operators.nodes import node_features
from riskgraph.operators.paths import betweenness
from riskgraph.operators.rank import pagerank
from riskgraph.operators.rings import fraud_rings, ring_members
from riskgraph.operators.sharing import sharing
from riskgraph.session import materialise


def account_graph_table(
    df: DataFrame, with_pagerank: bool = True, with_betweenness: bool = True, sample_share: float | None = None
) -> DataFrame:
    """Every graph feature, one row per account."""
    graph = sharing(df)
    out = node_features(df, graph).join(account_components(df, graph.pairs), "account_id", "left")
    if with_pagerank:
        out = out.join(pagerank(df, graph=graph), "account_id", "left")
    if with_betweenness:
        out = out.join(betweenness(df, sample_share, pairs=graph.pairs), "account_id", "left")
    return out.join(ring_members(fraud_rings(df, graph)), "account_id", "left").withColumn(
        "fraud_ring_flag", F.coalesce("fraud_ring_flag", F.lit(0))
    )


def merge_graph_features(df: DataFrame, **options) -> DataFrame:
    """Transactions with the graph features of their account; holes become 0 or 'UNKNOWN'."""
    table = account_graph_table(df, **options)
    shared = [c for c in table.columns if c in df.columns and c != "account_id"]
    out = attach(df, table.drop(*shared), "account_id", weight="node_degree")
    numeric = [f.name for f in out.schema if isinstance(f.dataType, T.NumericType)]
    strings = [f.name for f in out.schema if isinstance(f.dataType, T.StringType)]
    return out.na.fill(0, subset=numeric).na.fill("UNKNOWN", subset=strings)


def etl(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Cleaned, engineered and encoded rows; what several jobs read next is written once."""
    return materialise(materialise(clean.clean(df, as_of)).transform(features.engineer)).transform(encode.encode_first_seen)


def full_run(df: DataFrame, as_of: str | None = None, model=None, **graph_options) -> DataFrame:
    """The batch job: everything up to the final risk score."""
    out = materialise(merge_graph_features(materialise(etl(df, as_of)), **graph_options))
    detector = anomaly.fit(out, encode.feature_columns(out, extra_exclude=("community_id", "demo_probability")))
    out = anomaly.detect(out, detector)
    return scoring.with_final_score(scoring.scoring(out, model))
