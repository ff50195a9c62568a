"""Queries over the account graph and the property graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskgraph import fixtures as fx
from riskgraph.catalog.registry import part, query, r6
from riskgraph.operators import components, louvain as louvain_op, nodes, paths, property_graph as pg, rank, rings, sharing
from riskgraph.plans import pipeline

ACCOUNT = "ACC_000003"

part("uses", "SELECT DISTINCT account_id, device_id FROM transactions")
part("visits", "SELECT DISTINCT account_id, merchant_id FROM transactions")
part("accounts", "SELECT DISTINCT account_id FROM transactions")
part("shared_edges", """SELECT DISTINCT a.account_id AS src, b.account_id AS dst FROM uses a JOIN uses b
 ON a.device_id = b.device_id AND a.account_id <> b.account_id""")
part("degrees", "SELECT account_id, count(dst) AS deg FROM accounts LEFT JOIN shared_edges ON src = account_id GROUP BY account_id")
part("node_table", """SELECT t.account_id, count(*) AS node_degree, round(sum(amount), 6) AS total_amount,
 round(avg(amount), 6) AS avg_amount, round(stddev_pop(amount), 6) AS std_amount, max(amount) AS max_amount,
 min(amount) AS min_amount, count(DISTINCT merchant_id) AS unique_merchants, count(DISTINCT device_id) AS unique_devices,
 any_value(d.deg) AS connected_accounts, cast(sum(is_fraud) AS bigint) AS fraud_count,
 round(sum(is_fraud) / count(*)::DOUBLE, 6) AS fraud_rate
FROM transactions t JOIN degrees d ON d.account_id = t.account_id GROUP BY t.account_id""")
part("reached", """SELECT account_id AS start, account_id AS node FROM accounts
UNION SELECT r.start, e.dst FROM reached r JOIN shared_edges e ON e.src = r.node""")
part("labels", "SELECT node AS account_id, min(start) AS community_id FROM reached GROUP BY node")
part("component_table", """SELECT account_id, community_id, count(*) OVER (PARTITION BY community_id) AS community_size FROM labels""")
part("near_pairs", """SELECT src, dst FROM shared_edges QUALIFY row_number() OVER (PARTITION BY src ORDER BY dst) <= 10""")
part("account_means", "SELECT account_id, avg(amount) AS m FROM transactions GROUP BY account_id")
part("common_merchants", """SELECT p.src, p.dst, count(*) AS shared FROM near_pairs p JOIN visits a ON a.account_id = p.src
 JOIN visits b ON b.account_id = p.dst AND b.merchant_id = a.merchant_id GROUP BY p.src, p.dst""")
part("ring_table", """SELECT c.src AS account1, c.dst AS account2, c.shared AS shared_merchants,
 1 - least(abs(a.m - b.m) / greatest(a.m, b.m, 1), 1) AS amount_similarity, x.deg + y.deg AS ring_size
FROM common_merchants c JOIN account_means a ON a.account_id = c.src JOIN account_means b ON b.account_id = c.dst
JOIN degrees x ON x.account_id = c.src JOIN degrees y ON y.account_id = c.dst
WHERE shared >= 2 AND 1 - least(abs(a.m - b.m) / greatest(a.m, b.m, 1), 1) > 0.7""")
part("ring_accounts", "SELECT account1 AS account_id FROM ring_table UNION SELECT account2 FROM ring_table")
part("moves", """SELECT e.dst, e.src, 1.0::DOUBLE / d.deg AS w FROM shared_edges e JOIN degrees d ON d.account_id = e.src
UNION ALL SELECT account_id, account_id, 0.0::DOUBLE FROM accounts""")
part("steps", """SELECT 0 AS it, account_id AS node, 1.0::DOUBLE / (SELECT count(*) FROM accounts) AS pr FROM accounts
UNION ALL SELECT it + 1, dst, (1 - 0.85::DOUBLE) / (SELECT count(*) FROM accounts) + 0.85::DOUBLE * sum(w * pr)
 FROM steps JOIN moves ON src = node WHERE it < 100 GROUP BY it, dst""")
part("settled", """SELECT min(it) AS it FROM (SELECT a.it, max(abs(b.pr - a.pr) - (1e-6::DOUBLE + 1e-5::DOUBLE * abs(a.pr))) AS over
 FROM steps a JOIN steps b ON b.node = a.node AND b.it = a.it + 1 GROUP BY a.it) WHERE over <= 0""")
part("walks", """SELECT account_id AS source, account_id AS node, 0 AS lvl FROM accounts
UNION SELECT w.source, e.dst, w.lvl + 1 FROM walks w JOIN shared_edges e ON e.src = w.node WHERE w.lvl < 9""")
part("distances", "SELECT source, node, min(lvl) AS d FROM walks GROUP BY source, node")
part("parents", """SELECT a.source, a.node, max(b.node) AS parent FROM distances a JOIN shared_edges e ON e.dst = a.node
 JOIN distances b ON b.source = a.source AND b.node = e.src AND b.d = a.d - 1 WHERE a.d > 0 GROUP BY a.source, a.node""")
part("inner_nodes", """SELECT source, node AS target, parent AS node FROM parents WHERE parent <> source
UNION ALL SELECT i.source, i.target, p.parent FROM inner_nodes i JOIN parents p ON p.source = i.source AND p.node = i.node
 WHERE p.parent <> i.source""")
part("inner_counts", "SELECT node, count(*) AS c FROM inner_nodes GROUP BY node")


@query("graph_account_profile", """SELECT account_id, cast(0 AS bigint) AS part, cast(count(*) AS int) AS txn_count,
 round(sum(amount), 6) AS total_amount,
 string_agg(DISTINCT merchant_id, ',' ORDER BY merchant_id) AS merchants,
 string_agg(DISTINCT device_id, ',' ORDER BY device_id) AS devices FROM transactions GROUP BY account_id""")
def graph_account_profile(spark, sf):
    """The whole account, whatever its size: the parts of its days put together."""
    parts = sharing.account_profile(fx.transactions(spark, sf))
    return sharing.whole_profile(parts).select(
        "account_id", F.lit(0).cast("bigint").alias("part"), F.col("txn_count").cast("int").alias("txn_count"),
        r6("total_amount"), F.array_join("merchants", ",").alias("merchants"), F.array_join("devices", ",").alias("devices"),
    )


@query("graph_shared_device_edges", "SELECT src, dst FROM shared_edges")
def graph_shared_device_edges(spark, sf):
    return sharing.shared_device_edges(fx.transactions(spark, sf))


NODE_ROUNDED = ("total_amount", "avg_amount", "std_amount", "fraud_rate")


def _rounded(df, names):
    return df.select(*[r6(c) if c in names else c for c in df.columns])


@query("graph_node_features", "SELECT * FROM node_table")
def graph_node_features(spark, sf):
    return _rounded(nodes.node_features(fx.transactions(spark, sf)), NODE_ROUNDED)


@query("graph_components", "SELECT * FROM component_table")
def graph_components(spark, sf):
    return components.account_components(fx.transactions(spark, sf))


@query("graph_rings", "SELECT * REPLACE (round(amount_similarity, 6) AS amount_similarity) FROM ring_table")
def graph_rings(spark, sf):
    return _rounded(rings.fraud_rings(fx.transactions(spark, sf)), ("amount_similarity",))


@query("graph_pagerank", "SELECT node AS account_id, round(pr, 6) AS pagerank_score FROM steps JOIN settled USING (it)")
def graph_pagerank(spark, sf):
    return _rounded(rank.pagerank(fx.transactions(spark, sf)), ("pagerank_score",))


@query("graph_betweenness", """SELECT account_id, round(coalesce(c, 0) / greatest((SELECT coalesce(max(c), 0) FROM inner_counts), 1)::DOUBLE, 6)
 AS betweenness_centrality FROM accounts LEFT JOIN inner_counts ON node = account_id""")
def graph_betweenness(spark, sf):
    return _rounded(paths.betweenness(fx.transactions(spark, sf)), ("betweenness_centrality",))


@query("graph_ring_flag", """SELECT transaction_id, t.account_id, CASE WHEN r.account_id IS NULL THEN 0 ELSE 1 END AS fraud_ring_flag
 FROM transactions t LEFT JOIN ring_accounts r ON r.account_id = t.account_id""")
def graph_ring_flag(spark, sf):
    rows = fx.transactions(spark, sf)
    return rings.ring_flags(rows, rings.fraud_rings(rows)).select("transaction_id", "account_id", "fraud_ring_flag")


MERGED = ("node_degree, total_amount, avg_amount, std_amount, max_amount, min_amount, unique_merchants, unique_devices,"
          " connected_accounts, fraud_count, fraud_rate, community_id, community_size")


@query("graph_merge", f"""SELECT transaction_id, t.account_id, {MERGED},
 CASE WHEN r.account_id IS NULL THEN 0 ELSE 1 END AS fraud_ring_flag FROM transactions t
 JOIN node_table n ON n.account_id = t.account_id JOIN component_table c ON c.account_id = t.account_id
 LEFT JOIN ring_accounts r ON r.account_id = t.account_id""")
def graph_merge(spark, sf):
    out = pipeline.merge_graph_features(fx.transactions(spark, sf), with_pagerank=False, with_betweenness=False)
    names = ["transaction_id", "account_id", *MERGED.split(", "), "fraud_ring_flag"]
    return _rounded(out.select(*names), NODE_ROUNDED)


# ---------------------------------------------------------------- property graph


@query("pg_nodes", """SELECT 'Account' AS label, account_id AS id, NULL::VARCHAR AS category, NULL::DOUBLE AS amount, NULL::VARCHAR AS timestamp,
 NULL::INT AS is_fraud, NULL::INT AS hour, NULL::INT AS day_of_week FROM accounts
UNION ALL SELECT 'Merchant', merchant_id, max_by(merchant_category, _seq), NULL, NULL, NULL, NULL, NULL FROM transactions GROUP BY merchant_id
UNION ALL SELECT DISTINCT 'Device', device_id, NULL, NULL, NULL, NULL, NULL, NULL FROM transactions
UNION ALL SELECT 'Transaction', transaction_id, NULL, amount, strftime(timestamp, '%Y-%m-%dT%H:%M:%S'), is_fraud, hour, day_of_week FROM transactions""")
def pg_nodes(spark, sf):
    return pg.nodes(fx.transactions(spark, sf))


part("pg_edge_table", """SELECT DISTINCT 'MAKES' AS type, account_id AS src, transaction_id AS dst FROM transactions
UNION ALL SELECT DISTINCT 'TO', transaction_id, merchant_id FROM transactions
UNION ALL SELECT 'USES', account_id, device_id FROM uses""")


@query("pg_edges", "SELECT * FROM pg_edge_table")
def pg_edges(spark, sf):
    return pg.edges(fx.transactions(spark, sf))


@query("pg_stats", """SELECT 'edge' AS kind, type AS name, count(*) AS count FROM pg_edge_table GROUP BY type
UNION ALL SELECT 'node', 'Account', count(DISTINCT account_id) FROM transactions
UNION ALL SELECT 'node', 'Merchant', count(DISTINCT merchant_id) FROM transactions
UNION ALL SELECT 'node', 'Device', count(DISTINCT device_id) FROM transactions
UNION ALL SELECT 'node', 'Transaction', count(*) FROM transactions""")
def pg_stats(spark, sf):
    return pg.stats(fx.transactions(spark, sf))


part("hits", """SELECT t.account_id, count(DISTINCT device) AS device_count, count(*) AS high_value_txns FROM transactions t
 JOIN (SELECT account_id, device_id AS device FROM uses) u ON u.account_id = t.account_id
WHERE t.amount > 500 GROUP BY t.account_id HAVING count(DISTINCT device) > 2 OR count(*) > 5""")


@query("pg_degree", "SELECT account_id, count(*) AS node_degree FROM transactions GROUP BY account_id")
def pg_degree(spark, sf):
    return pg.degree(fx.transactions(spark, sf))


@query("pg_shared_device_count", "SELECT account_id, deg AS shared_device_count FROM degrees WHERE deg > 0")
def pg_shared_device_count(spark, sf):
    return pg.shared_device_count(fx.transactions(spark, sf))


@query("pg_merchant_txn_count", "SELECT merchant_id, count(*) AS merchant_txn_count FROM transactions GROUP BY merchant_id")
def pg_merchant_txn_count(spark, sf):
    return pg.merchant_transactions(fx.transactions(spark, sf))


@query("pg_device_account_count", "SELECT device_id, count(*) AS device_account_count FROM uses GROUP BY device_id HAVING count(*) > 1")
def pg_device_account_count(spark, sf):
    return pg.device_accounts(fx.transactions(spark, sf))


@query("pg_suspicious", "SELECT account_id, device_count, high_value_txns, 1 AS suspicious_flag FROM hits")
def pg_suspicious(spark, sf):
    return pg.suspicious_accounts(fx.transactions(spark, sf))


@query("pg_account_features", """SELECT d.account_id, (SELECT count(*) FROM transactions t WHERE t.account_id = d.account_id) AS node_degree,
 d.deg AS shared_device_count, CASE WHEN h.account_id IS NULL THEN 0 ELSE 1 END AS suspicious_flag
FROM degrees d LEFT JOIN hits h ON h.account_id = d.account_id""")
def pg_account_features(spark, sf):
    return pg.account_features(fx.transactions(spark, sf))


@query("pg_rings", """SELECT p.account1, p.account2, p.shared_devices, p.ring_size FROM (
 SELECT a.account_id AS account1, b.account_id AS account2, string_agg(a.device_id, ',' ORDER BY a.device_id) AS shared_devices,
  cast(count(*) AS int) AS ring_size FROM uses a JOIN uses b ON a.device_id = b.device_id AND a.account_id <> b.account_id
 GROUP BY a.account_id, b.account_id HAVING count(*) > 1) p
WHERE EXISTS (SELECT 1 FROM transactions x JOIN transactions y ON x.merchant_id = y.merchant_id
 AND x.amount > y.amount * 0.8::DOUBLE AND x.amount < y.amount * 1.2::DOUBLE
 WHERE x.account_id = p.account2 AND y.account_id = p.account1)
ORDER BY account1, account2 LIMIT 50""")
def pg_rings(spark, sf):
    return pg.device_rings(fx.transactions(spark, sf)).select(
        "account1", "account2", F.array_join("shared_devices", ",").alias("shared_devices"),
        F.col("ring_size").cast("int").alias("ring_size"),
    )


@query("pg_neighbors_accounts", f"SELECT dst AS connected_account FROM shared_edges WHERE src = '{ACCOUNT}' ORDER BY dst LIMIT 20")
def pg_neighbors_accounts(spark, sf):
    return pg.neighbour_accounts(fx.transactions(spark, sf), ACCOUNT)


@query("pg_neighbors_entities", f"""(SELECT 'merchant' AS kind, merchant_id AS id FROM visits WHERE account_id = '{ACCOUNT}' ORDER BY id LIMIT 20)
UNION ALL (SELECT 'device', device_id AS id FROM uses WHERE account_id = '{ACCOUNT}' ORDER BY id LIMIT 20)""")
def pg_neighbors_entities(spark, sf):
    return pg.neighbour_entities(fx.transactions(spark, sf), ACCOUNT)


@query("pg_louvain")
def pg_louvain(spark, sf):
    return louvain_op.louvain(fx.transactions(spark, sf))


@query("pg_simple_communities", "SELECT * FROM component_table")
def pg_simple_communities(spark, sf):
    return pg.simple_communities(fx.transactions(spark, sf))
