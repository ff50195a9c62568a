"""Queries over scoring rules, reports and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskgraph import fixtures as fx
from riskgraph.catalog.graph import ACCOUNT
from riskgraph.catalog.registry import part, query, r6
from riskgraph.operators import components, features, rings, scoring, sharing
from riskgraph.functions import rules
from riskgraph.plans import reports, requests
from riskgraph.streaming import live

TRANSACTION = "TXN_0000000042"


def _level(p: str) -> str:
    return f"CASE WHEN {p} > 0.8::DOUBLE THEN 'HIGH' WHEN {p} > 0.4::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END"


def _priority(p: str) -> str:
    return (f"CASE WHEN {p} > 0.7::DOUBLE THEN 'CRITICAL' WHEN {p} > 0.5::DOUBLE THEN 'HIGH'"
            f" WHEN {p} > 0.3::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END")


RULE = ("least(0.05::DOUBLE + CASE WHEN amount > 500 THEN 0.15::DOUBLE WHEN amount > 200 THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END"
        " + CASE WHEN hour >= 22 OR hour <= 5 THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END"
        " + CASE WHEN day_of_week >= 5 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END, 0.95::DOUBLE)")

part("ruled", f"SELECT *, {RULE} AS p FROM transactions")
part("scored", f"SELECT *, demo_probability AS fraud_probability, {_level('demo_probability')} AS fraud_risk_level FROM transactions")
part("flagged", """SELECT s.*, CASE WHEN d.accounts_per_device > 3 THEN 1 ELSE 0 END AS shared_device_flag,
 CASE WHEN r.account_id IS NULL THEN 0 ELSE 1 END AS fraud_ring_flag, c.community_id
FROM scored s JOIN device_stats d ON d.device_id = s.device_id LEFT JOIN ring_accounts r ON r.account_id = s.account_id
JOIN component_table c ON c.account_id = s.account_id""")
part("prioritised", """SELECT *, CASE WHEN shared_device_flag = 1 OR fraud_ring_flag = 1 THEN 1 ELSE 0 END AS graph_risk_flag,
 fraud_probability * 0.6::DOUBLE + (CASE WHEN shared_device_flag = 1 OR fraud_ring_flag = 1 THEN 1 ELSE 0 END) * 0.2::DOUBLE
 + fraud_ring_flag * 0.2::DOUBLE AS investigation_priority FROM flagged""")


def demo(spark, sf):
    """Transactions with the fixture's score as their probability."""
    return fx.transactions(spark, sf).withColumn("fraud_probability", F.col("demo_probability"))


def scored(spark, sf):
    return scoring.assign_risk_levels(demo(spark, sf))


def with_graph(df):
    """Shared-device flag, ring flag and community of every transaction."""
    from riskgraph.functions.skew import attach

    graph = sharing.sharing(df)
    accounts = components.account_components(df, graph.pairs).join(
        rings.ring_members(rings.fraud_rings(df, graph)), "account_id", "left"
    ).withColumn("fraud_ring_flag", F.coalesce("fraud_ring_flag", F.lit(0)))
    return attach(features.device_features(df), accounts, "account_id")


# ---------------------------------------------------------------- scoring


@query("score_rules", "SELECT transaction_id, round(p, 4) AS fraud_probability FROM ruled")
def score_rules(spark, sf):
    return scoring.score_by_rules(fx.transactions(spark, sf)).select("transaction_id", "fraud_probability")


@query("risk_level", "SELECT transaction_id, fraud_risk_level FROM scored")
def risk_level(spark, sf):
    return scored(spark, sf).select("transaction_id", "fraud_risk_level")


@query("risk_distribution", "SELECT fraud_risk_level, count(*) AS txn_count FROM scored GROUP BY fraud_risk_level")
def risk_distribution(spark, sf):
    return scoring.risk_distribution(scored(spark, sf))


@query("graph_risk_flag", "SELECT transaction_id, graph_risk_flag FROM prioritised")
def graph_risk_flag(spark, sf):
    return scoring.add_graph_flags(with_graph(scored(spark, sf))).select("transaction_id", "graph_risk_flag")


@query("priority", "SELECT transaction_id, round(investigation_priority, 6) AS investigation_priority FROM prioritised")
def priority(spark, sf):
    rows = scoring.add_graph_flags(with_graph(scored(spark, sf)))
    return scoring.investigation_priority(rows).select("transaction_id", r6("investigation_priority"))


@query("priority_level", f"SELECT transaction_id, {_priority('p')} AS priority_level FROM ruled")
def priority_level(spark, sf):
    rows = scoring.score_by_rules(fx.transactions(spark, sf), keep_exact=True)
    return rows.select("transaction_id", rules.priority_level(F.col("_exact")).alias("priority_level"))


@query("scoring_pipeline", f"""SELECT transaction_id, round(p, 4) AS fraud_probability, {_level('round(p, 4)')} AS fraud_risk_level,
 graph_risk_flag, fraud_ring_flag, round(round(p, 4) * 0.6::DOUBLE + graph_risk_flag * 0.2::DOUBLE + fraud_ring_flag * 0.2::DOUBLE, 6) AS investigation_priority,
 {_priority('(round(p, 4) * 0.6::DOUBLE + graph_risk_flag * 0.2::DOUBLE + fraud_ring_flag * 0.2::DOUBLE)')} AS priority_level
FROM (SELECT *, {RULE} AS p FROM prioritised)""")
def scoring_pipeline(spark, sf):
    rows = scoring.scoring(with_graph(fx.transactions(spark, sf)))
    return rows.select("transaction_id", "fraud_probability", "fraud_risk_level", "graph_risk_flag", "fraud_ring_flag",
                       r6("investigation_priority"), "priority_level")


@query("high_risk", "SELECT transaction_id, account_id, amount, fraud_probability FROM scored WHERE fraud_probability >= 0.5::DOUBLE")
def high_risk(spark, sf):
    return scoring.high_risk(demo(spark, sf)).select("transaction_id", "account_id", "amount", "fraud_probability")


@query("suspicious_communities", """SELECT community_id, count(*) AS transaction_count, round(avg(fraud_probability), 6) AS avg_fraud_prob,
 cast(sum(is_fraud) AS bigint) AS confirmed_fraud_count, cast(sum(fraud_ring_flag) AS bigint) AS fraud_ring_count,
 CASE WHEN avg(fraud_probability) > 0.5::DOUBLE THEN 'HIGH' WHEN avg(fraud_probability) > 0.2::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS community_risk_level
FROM prioritised GROUP BY community_id""")
def suspicious_communities(spark, sf):
    rows = scoring.scoring(with_graph(demo(spark, sf)))
    out = scoring.suspicious_communities(rows)
    return out.withColumn("avg_fraud_prob", F.round("avg_fraud_prob", 6))


# ---------------------------------------------------------------- requests and API reports

part("asked", """SELECT * REPLACE (coalesce(merchant_category, 'general') AS merchant_category, coalesce(entry_mode, 'chip') AS entry_mode,
 coalesce(hour, 12) AS hour, coalesce(day_of_week, 0) AS day_of_week) FROM requests""")
part("answered", f"""SELECT *, amount > 0 AND hour BETWEEN 0 AND 23 AND day_of_week BETWEEN 0 AND 6 AS ok, {RULE} AS p FROM asked""")


@query("score_requests", f"""SELECT transaction_id, CASE WHEN ok THEN round(p, 4) END AS fraud_probability,
 CASE WHEN ok THEN {_level('p')} END AS fraud_risk_level, CASE WHEN ok THEN p > 0.5::DOUBLE END AS graph_risk_flag,
 CASE WHEN ok THEN FALSE END AS fraud_ring_flag, CASE WHEN ok THEN round(p, 4) END AS investigation_priority,
 CASE WHEN ok THEN {_priority('p')} END AS priority_level, CASE WHEN ok THEN 'success' ELSE 'error' END AS status FROM answered""")
def score_requests(spark, sf):
    return requests.score_requests(fx.requests(spark, sf))


@query("model_priority_variant", f"""SELECT transaction_id, round(fraud_probability, 4) AS fraud_probability, fraud_risk_level,
 fraud_probability > 0.5::DOUBLE AS graph_risk_flag, FALSE AS fraud_ring_flag, round(fraud_probability, 4) AS investigation_priority,
 CASE WHEN fraud_probability > 0.5::DOUBLE THEN 'HIGH' WHEN fraud_probability > 0.3::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS priority_level FROM scored""")
def model_priority_variant(spark, sf):
    return requests.respond_with_model(demo(spark, sf))


@query("request_features", """SELECT transaction_id, amount, hour, day_of_week,
 CASE WHEN amount > -1 THEN round(ln(1 + amount), 6) END AS amount_log,
 CASE WHEN hour >= 22 OR hour <= 5 THEN 1 ELSE 0 END AS is_night, CASE WHEN day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend,
 0 AS node_degree, 0 AS pagerank_score, 0 AS community_id, 0 AS fraud_ring_flag, 0 AS shared_device_flag FROM asked""")
def request_features(spark, sf):
    return requests.request_features(fx.requests(spark, sf)).withColumn("amount_log", F.round("amount_log", 6))


@query("summary_stats", """SELECT count(*) AS total_transactions, cast(sum(is_fraud) AS bigint) AS total_frauds,
 round(sum(is_fraud) / count(*)::DOUBLE * 100, 2) AS fraud_rate, round(avg(fraud_probability) * 100, 2) AS avg_fraud_probability,
 count(*) FILTER (fraud_probability > 0.8::DOUBLE) AS high_risk_count, count(DISTINCT account_id) AS unique_accounts,
 count(DISTINCT merchant_id) AS unique_merchants, count(DISTINCT device_id) AS unique_devices FROM scored""")
def summary_stats(spark, sf):
    return reports.summary_stats(scored(spark, sf))


@query("api_high_risk", """SELECT transaction_id, timestamp, amount, account_id, merchant_id, fraud_probability FROM scored
WHERE fraud_probability > 0.5::DOUBLE ORDER BY fraud_probability DESC, transaction_id LIMIT 100""")
def api_high_risk(spark, sf):
    return reports.top_high_risk(scored(spark, sf))


# ---------------------------------------------------------------- dashboard


@query("dash_filter", """SELECT transaction_id, fraud_probability, fraud_risk_level FROM scored
WHERE fraud_risk_level IN ('HIGH', 'MEDIUM') AND fraud_probability >= 0.45::DOUBLE""")
def dash_filter(spark, sf):
    return reports.dashboard_filter(scored(spark, sf), ["HIGH", "MEDIUM"], 0.45).select(
        "transaction_id", "fraud_probability", "fraud_risk_level"
    )


@query("dash_kpis", """SELECT count(*) AS total_transactions, round(sum(is_fraud) / count(*)::DOUBLE * 100, 6) AS real_fraud_rate,
 round(count(*) FILTER (fraud_risk_level = 'HIGH') / count(*)::DOUBLE * 100, 6) AS predicted_fraud_rate,
 round(avg(fraud_probability) * 100, 6) AS avg_fraud_probability, count(*) FILTER (fraud_risk_level = 'HIGH') AS high_risk_count,
 count(DISTINCT community_id) AS communities FROM scored JOIN component_table USING (account_id)""")
def dash_kpis(spark, sf):
    from riskgraph.functions.skew import attach

    rows = scored(spark, sf)
    out = reports.kpis(attach(rows, components.account_components(rows), "account_id"))
    rounded = ("real_fraud_rate", "predicted_fraud_rate", "avg_fraud_probability")
    return out.select(*[r6(c) if c in rounded else c for c in out.columns])


@query("dash_daily_trend", """SELECT cast(timestamp AS date) AS date, count(*) AS txn_count, cast(sum(is_fraud) AS bigint) AS fraud_count,
 round(avg(fraud_probability), 6) AS avg_probability, round(sum(is_fraud) / count(*)::DOUBLE * 100, 6) AS fraud_rate
FROM scored GROUP BY 1""")
def dash_daily_trend(spark, sf):
    return reports.daily_trend(scored(spark, sf)).withColumns({
        "avg_probability": F.round("avg_probability", 6), "fraud_rate": F.round("fraud_rate", 6)
    })


@query("dash_probability_histogram", """SELECT b AS bin, count(s.bin) AS txn_count FROM range(50) g(b)
LEFT JOIN (SELECT cast(least(floor(fraud_probability * 50), 49) AS bigint) AS bin FROM scored) s ON s.bin = b GROUP BY b""")
def dash_probability_histogram(spark, sf):
    return reports.probability_histogram(scored(spark, sf))


@query("dash_community_risk", """SELECT community_id, round(avg_prob, 6) AS avg_prob, size,
 CASE WHEN avg_prob > 0.5::DOUBLE THEN 'HIGH' WHEN avg_prob > 0.3::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS band
FROM (SELECT community_id, avg(fraud_probability) AS avg_prob, count(*) AS size FROM scored JOIN component_table USING (account_id)
 GROUP BY community_id ORDER BY avg_prob DESC, community_id LIMIT 15)""")
def dash_community_risk(spark, sf):
    from riskgraph.functions.skew import attach

    rows = scored(spark, sf)
    out = reports.community_risk(attach(rows, components.account_components(rows), "account_id"))
    return out.withColumn("avg_prob", F.round("avg_prob", 6))


@query("dash_hourly_volume", "SELECT cast(hour(timestamp) AS int) AS hour, count(*) AS txn_count FROM scored GROUP BY 1")
def dash_hourly_volume(spark, sf):
    return reports.hourly_volume(scored(spark, sf))


@query("dash_search", """SELECT transaction_id, timestamp, amount, account_id, merchant_id, fraud_probability, fraud_risk_level FROM scored
WHERE contains(lower(account_id), 'acc_00000') AND contains(lower(merchant_id), '_00001')""")
def dash_search(spark, sf):
    return reports.search(scored(spark, sf), account="acc_00000", merchant="_00001")


@query("dash_account_overview", f"""SELECT count(*) AS txn_count, round(sum(amount), 6) AS total_amount,
 round(avg(fraud_probability), 6) AS avg_probability, count(*) FILTER (fraud_risk_level = 'HIGH') AS high_risk_count
FROM scored WHERE account_id = '{ACCOUNT}'""")
def dash_account_overview(spark, sf):
    return reports.account_overview(scored(spark, sf), ACCOUNT).withColumns({
        "total_amount": F.round("total_amount", 6), "avg_probability": F.round("avg_probability", 6)
    })


part("mine", f"SELECT * FROM scored WHERE account_id = '{ACCOUNT}'")
part("entity_rank", """SELECT 'device' AS kind, device_id AS id, cast(row_number() OVER (ORDER BY min(_seq)) AS int) AS position FROM mine GROUP BY device_id
UNION ALL SELECT 'merchant', merchant_id, cast(row_number() OVER (ORDER BY min(_seq)) AS int) FROM mine GROUP BY merchant_id""")


@query("dash_account_entities", "SELECT * FROM entity_rank WHERE position <= 10")
def dash_account_entities(spark, sf):
    return reports.account_entities(scored(spark, sf), ACCOUNT)


@query("dash_account_high_risk", """SELECT transaction_id, timestamp, amount, fraud_probability, fraud_risk_level FROM mine
WHERE fraud_risk_level = 'HIGH'""")
def dash_account_high_risk(spark, sf):
    return reports.account_high_risk(scored(spark, sf), ACCOUNT)


@query("dash_ego_network", f"""SELECT 'node' AS element, 'account' AS kind, '{ACCOUNT}' AS id, NULL::VARCHAR AS source
UNION ALL SELECT 'node', kind, id, NULL FROM entity_rank WHERE position <= 5
UNION ALL SELECT 'edge', kind, id, '{ACCOUNT}' FROM entity_rank WHERE position <= 5""")
def dash_ego_network(spark, sf):
    return reports.ego_network(scored(spark, sf), ACCOUNT)


@query("dash_top_accounts", """SELECT account_id, txn_count, round(avg_probability, 6) AS avg_probability, round(total_amount, 6) AS total_amount
FROM (SELECT account_id, count(*) AS txn_count, avg(fraud_probability) AS avg_probability, sum(amount) AS total_amount FROM scored
 WHERE fraud_risk_level = 'HIGH' GROUP BY account_id ORDER BY avg_probability DESC, account_id LIMIT 10)""")
def dash_top_accounts(spark, sf):
    return reports.top_accounts(scored(spark, sf)).withColumns({
        "avg_probability": F.round("avg_probability", 6), "total_amount": F.round("total_amount", 6)
    })


@query("dash_txn_lookup", f"""SELECT transaction_id, amount, fraud_probability, fraud_risk_level FROM scored
WHERE transaction_id = '{TRANSACTION}' ORDER BY _seq LIMIT 1""")
def dash_txn_lookup(spark, sf):
    return reports.transaction_lookup(scored(spark, sf), TRANSACTION)


# ---------------------------------------------------------------- streams


@query("stream_strip_labels", """SELECT _seq, transaction_id, timestamp, amount, account_id, merchant_id, device_id, merchant_category,
 hour, day_of_week, is_weekend, card_present, entry_mode, currency, demo_probability FROM transactions""")
def stream_strip_labels(spark, sf):
    return live.run_to_table(live.strip_labels(live.read_event_stream(spark, sf)), "strip")


@query("stream_score", f"""SELECT transaction_id, timestamp, amount, account_id, round(p, 4) AS fraud_probability, {_level('p')} AS risk_level FROM ruled""")
def stream_score(spark, sf):
    return live.run_to_table(live.score_stream(live.strip_labels(live.read_event_stream(spark, sf))), "live")


def _demo_stream(spark, sf):
    rows = live.read_event_stream(spark, sf)
    return live.score_stream(rows.withColumn("fraud_probability", F.col("demo_probability")))


@query("stream_live_stats", """SELECT count(*) AS total_transactions, count(*) FILTER (fraud_probability > 0.5::DOUBLE) AS detected_frauds,
 round(count(*) FILTER (fraud_probability > 0.5::DOUBLE) / count(*)::DOUBLE * 100, 2) AS fraud_rate,
 count(*) FILTER (fraud_risk_level = 'HIGH') AS high_risk_count, round(avg(fraud_probability) * 100, 2) AS avg_probability FROM scored""")
def stream_live_stats(spark, sf):
    return live.run_latest(live.live_stats(_demo_stream(spark, sf)), "stats")


@query("stream_recent_feed", """SELECT transaction_id, timestamp, amount, account_id, fraud_probability, fraud_risk_level AS risk_level FROM scored
ORDER BY timestamp DESC, transaction_id DESC LIMIT 20""")
def stream_recent_feed(spark, sf):
    return live.recent_feed(_demo_stream(spark, sf))


@query("stream_alerts", """SELECT transaction_id, timestamp, amount, account_id, fraud_probability, fraud_risk_level AS risk_level FROM scored
WHERE fraud_probability > 0.8::DOUBLE""")
def stream_alerts(spark, sf):
    return live.run_to_table(live.alerts(_demo_stream(spark, sf)), "alerts")
