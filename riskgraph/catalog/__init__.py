from riskgraph.catalog import tables, graph, reports, models  # noqa: F401  (each registers its queries)
from riskgraph.catalog.registry import ORACLES, QUERIES, oracle_texts  # noqa: F401
