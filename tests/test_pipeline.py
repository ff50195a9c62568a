"""The batch job from cleaned transactions to the final score."""

from riskgraph import fixtures as fx
from riskgraph.plans import pipeline


def test_full_run(spark, sf):
    df = fx.transactions(spark, sf)
    out = pipeline.full_run(df, fx.AS_OF)
    names = {"pagerank_score", "betweenness_centrality", "community_id", "fraud_ring_flag", "anomaly_score", "is_anomaly",
             "fraud_probability", "fraud_risk_level", "graph_risk_flag", "investigation_priority", "priority_level",
             "final_risk_score"}
    assert names <= set(out.columns)
    rows = out.select("transaction_id", "final_risk_score", "anomaly_score", "fraud_probability", "graph_risk_flag").collect()
    assert len(rows) == df.where("amount > 0").count() == len({r[0] for r in rows})
    for r in rows:
        assert abs(r[1] - (r[3] * 0.5 + r[2] * 0.3 + r[4] * 0.2)) < 1e-12
