"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the cores.
Every query is computed in full and written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "src_csv", "clean_pipeline", "feat_all", "enc_first_seen", "sink_csv",
    "graph_shared_device_edges", "graph_node_features", "graph_components", "graph_pagerank",
    "graph_rings", "graph_merge", "risk_level", "scoring_pipeline", "suspicious_communities",
    "summary_stats", "api_high_risk", "dash_daily_trend", "dash_top_accounts", "ml_metrics",
    "stream_score",
]


def main() -> None:
    from riskgraph.catalog import QUERIES
    from riskgraph.session import build_session, release

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="riskgraph-bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["summary_stats"](spark, sf_dir).collect()  # start the JVM's engines outside the clock
    took = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    release(spark)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
