"""Input tables of the engine, derived from the driver's parquet tables.

Each adapter is one SQL text that runs in Spark and in DuckDB; only the
spelling of three expressions differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskgraph.session import prepare

AS_OF = "2024-02-01 00:00:00"

SPARK = {
    "K": "get_json_object(props, '$.k')",
    "DOW": "weekday(ts)",
    "E": "element_at(embedding, ",
}
DUCKDB = {
    "K": "json_extract_string(props, '$.k')",
    "DOW": "(isodow(ts)-1)",
    "E": "list_extract(embedding, ",
}

# Split into two projections so a stream of events can use them as well.
EVENT_KEY = "cast({K} AS int) AS k"
TRANSACTION_COLUMNS = [
    "event_id AS _seq",
    "'TXN_' || lpad(cast(event_id AS string), 10, '0') AS transaction_id",
    "cast(ts AS timestamp) AS timestamp",
    "round(value * 4, 2) AS amount",
    "'ACC_' || lpad(cast(user_id AS string), 6, '0') AS account_id",
    "'MER_' || lpad(cast(k AS string), 6, '0') AS merchant_id",
    "'DEV_' || lpad(cast(cast(floor(user_id / 10.0) * 10"
    " + floor((user_id % 10 + k % 3) / 2.0) AS bigint) AS string), 6, '0') AS device_id",
    "CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END AS is_fraud",
    "event_type AS merchant_category",
    "cast(hour(ts) AS int) AS hour",
    "cast({DOW} AS int) AS day_of_week",
    "CASE WHEN {DOW} >= 5 THEN 1 ELSE 0 END AS is_weekend",
    "CASE WHEN k % 4 = 0 THEN 0 ELSE 1 END AS card_present",
    "CASE WHEN k % 10 < 5 THEN 'chip' WHEN k % 10 < 7 THEN 'swipe' ELSE 'online' END AS entry_mode",
    "CASE WHEN k % 20 < 17 THEN 'USD' WHEN k % 20 < 19 THEN 'EUR' ELSE 'GBP' END AS currency",
    "cast(event_id * 7919 % 1001 AS double) / 1000 AS demo_probability",
]

DIRTY_COLUMNS = [
    "_seq * 2 + copy AS _seq",
    "transaction_id",
    "CASE WHEN _seq % 107 = 0 THEN timestamp + interval '60' day ELSE timestamp END AS timestamp",
    "CASE WHEN _seq % 97 = 0 THEN NULL WHEN _seq % 101 = 0 THEN 0.0"
    " WHEN _seq % 103 = 0 THEN -amount ELSE amount + copy END AS amount",
    "account_id",
    "merchant_id",
    "device_id",
    "is_fraud",
    "CASE WHEN _seq % 89 = 0 THEN NULL ELSE merchant_category END AS merchant_category",
]

CARD_COLUMNS = [
    "vec_id AS _seq",
    "vec_id * 300 AS Time",
    *[f"cast({{E}}{i}) AS double) AS V{i}" for i in range(1, 7)],
    "round(abs(cast({E}7) AS double)) * 1000, 2) AS Amount",
    "CASE WHEN label = 0 THEN 1 ELSE 0 END AS Class",
]

REQUEST_COLUMNS = [
    "transaction_id",
    "account_id",
    "merchant_id",
    "device_id",
    "CASE WHEN _seq % 70 = 0 THEN -amount ELSE amount END AS amount",
    "timestamp",
    "CASE WHEN _seq % 40 = 0 THEN NULL ELSE merchant_category END AS merchant_category",
    "CASE WHEN _seq % 60 = 0 THEN NULL ELSE entry_mode END AS entry_mode",
    "CASE WHEN _seq % 30 = 0 THEN NULL WHEN _seq % 110 = 0 THEN 25 ELSE hour END AS hour",
    "CASE WHEN _seq % 80 = 0 THEN NULL WHEN _seq % 130 = 0 THEN 9 ELSE day_of_week END AS day_of_week",
]


def spell(columns: list[str], dialect: dict[str, str]) -> list[str]:
    out = []
    for c in columns:
        for name, text in dialect.items():
            c = c.replace("{" + name + "}", text)
        out.append(c)
    return out


def events_to_transactions(events: DataFrame) -> DataFrame:
    """Batch or streaming events -> the transaction table."""
    return events.selectExpr("*", *spell([EVENT_KEY], SPARK)).selectExpr(*spell(TRANSACTION_COLUMNS, SPARK))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_transactions(prepare(spark).read.parquet(f"{sf_dir}/events.parquet"))


def transactions_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds repeated ids, nulls, non-positive amounts and future timestamps."""
    copies = "explode(CASE WHEN _seq % 50 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    return transactions(spark, sf_dir).selectExpr("*", copies).selectExpr(*spell(DIRTY_COLUMNS, SPARK))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw card layout; `_seq` is the input order."""
    return prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr(*spell(CARD_COLUMNS, SPARK))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction as a scoring request, some of them incomplete or invalid."""
    return transactions(spark, sf_dir).selectExpr(*spell(REQUEST_COLUMNS, SPARK))


def _duck(columns: list[str], source: str) -> str:
    return "SELECT " + ",\n ".join(spell(columns, DUCKDB)) + f"\nFROM {source}"


DUCK_TABLES = {
    "transactions": _duck(
        TRANSACTION_COLUMNS, "(SELECT *, " + spell([EVENT_KEY], DUCKDB)[0] + " FROM events) e"
    ),
    "transactions_dirty": _duck(
        DIRTY_COLUMNS,
        "transactions CROSS JOIN (SELECT 0 AS copy UNION ALL SELECT 1 AS copy) c"
        " WHERE copy = 0 OR _seq % 50 = 0",
    ),
    "cards": _duck(CARD_COLUMNS, "embeddings"),
    "requests": _duck(REQUEST_COLUMNS, "transactions"),
}
