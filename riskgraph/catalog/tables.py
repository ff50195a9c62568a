"""Queries over sources, cleaning, features and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskgraph import fixtures as fx
from riskgraph.catalog.registry import part, query, r6
from riskgraph.operators import clean, encode, features
from riskgraph.schemas import TRANSACTION_NAMES
from riskgraph.session import new_path
from riskgraph.sources import cards as card_source
from riskgraph.sources import files

BASE = ", ".join(TRANSACTION_NAMES)

# ---------------------------------------------------------------- sources


@query("src_csv", f"SELECT {BASE} FROM transactions")
def src_csv(spark, sf):
    path = files.write_csv(fx.transactions(spark, sf).select(*TRANSACTION_NAMES), new_path(spark, "csv"))
    return files.read_transactions_csv(spark, path)


part("card_times", """SELECT _seq, Amount AS amount, Class AS is_fraud, V1, V2, V4, V5, V6,
 'TXN_' || lpad(cast(row_number() OVER (ORDER BY _seq) - 1 AS string), 10, '0') AS transaction_id,
 TIMESTAMP '2024-01-01 00:00:00' + to_seconds(Time) AS timestamp
FROM cards""")
part("card_sorted", """SELECT count(*) AS n, list_sort(list(V1)) AS s1, list_sort(list(V2)) AS s2, list_sort(list(V4)) AS s4,
 greatest(1, least(100, count(*) // 100)) AS q1, greatest(1, least(50, count(*) // 200)) AS q2,
 greatest(1, least(30, count(*) // 500)) AS q4,
 min(V5) AS lo5, max(V5) AS hi5, min(V6) AS lo6, max(V6) AS hi6 FROM cards""")


def _edge(s: str, q: str) -> str:
    at = f"(n - 1) * i::DOUBLE / {q}"
    low, high = f"{s}[cast(floor({at}) AS BIGINT) + 1]", f"{s}[cast(ceil({at}) AS BIGINT) + 1]"
    return f"list_transform(range(0, {q} + 1), lambda i: {low} + ({high} - {low}) * ({at} - floor({at})))"


part("card_edges", f"""SELECT *, list_sort(list_distinct({_edge('s1', 'q1')})) AS e1,
 list_sort(list_distinct({_edge('s2', 'q2')})) AS e2, list_sort(list_distinct({_edge('s4', 'q4')})) AS e4 FROM card_sorted""")


def _entity(prefix: str, v: str, e: str) -> str:
    return f"'{prefix}' || lpad(cast(len(list_filter({e}[2:-2], lambda x: {v} > x)) AS string), 6, '0')"


def _cut(v: str, low: str, high: str, labels: list[str]) -> str:
    n = len(labels)
    inner = ", ".join(f"{low} + ({high} - {low}) / {n} * {i}" for i in range(1, n))
    names = ", ".join(f"'{x}'" for x in labels)
    return f"([{names}])[len(list_filter([{inner}], lambda x: {v} > x)) + 1]"


part("card_entities", f"""SELECT _seq, {_entity('ACC_', 'V1', 'e1')} AS account_id,
 {_entity('MER_', 'V2', 'e2')} AS merchant_id, {_entity('DEV_', 'V4', 'e4')} AS device_id
FROM cards CROSS JOIN card_edges""")
part("card_cuts", f"""SELECT _seq, {_cut('V5', 'lo5', 'hi5', card_source.CATEGORY_LABELS)} AS merchant_category,
 {_cut('V6', 'lo6', 'hi6', card_source.ENTRY_LABELS)} AS entry_mode FROM cards CROSS JOIN card_sorted""")
part("card_core", """SELECT _seq, transaction_id, timestamp, amount, is_fraud, cast(hour(timestamp) AS int) AS hour,
 cast(isodow(timestamp) - 1 AS int) AS day_of_week, CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM card_times""")

CORE = ["transaction_id", "timestamp", "amount", "is_fraud", "hour", "day_of_week", "is_weekend"]


@query("src_detect_layout", f"""SELECT {', '.join('c.' + x for x in CORE)}, account_id, merchant_id, device_id,
 merchant_category, entry_mode FROM card_core c JOIN card_entities e USING (_seq) JOIN card_cuts k USING (_seq)""")
def src_detect_layout(spark, sf):
    out = files.normalise_layout(fx.cards(spark, sf))
    return out.select(*CORE, "account_id", "merchant_id", "device_id", "merchant_category", "entry_mode")


@query("src_card_to_txn", f"SELECT {', '.join(CORE)} FROM card_core")
def src_card_to_txn(spark, sf):
    return card_source.card_core(fx.cards(spark, sf)).select(*CORE)


@query("card_entity_qcut", "SELECT * FROM card_entities")
def card_entity_qcut(spark, sf):
    return card_source.entity_buckets(fx.cards(spark, sf)).select("_seq", "account_id", "merchant_id", "device_id")


@query("card_category_cut", "SELECT * FROM card_cuts")
def card_category_cut(spark, sf):
    return card_source.category_cut(fx.cards(spark, sf)).select("_seq", "merchant_category", "entry_mode")


@query("card_random_attrs")
def card_random_attrs(spark, sf):
    return card_source.random_attributes(card_source.card_core(fx.cards(spark, sf))).select(
        "transaction_id", "card_present", "currency"
    )


@query("sink_csv", f"SELECT {BASE} FROM transactions WHERE amount > 0")
def sink_csv(spark, sf):
    rows = clean.positive_amounts(fx.transactions(spark, sf)).select(*TRANSACTION_NAMES)
    return files.read_transactions_csv(spark, files.write_csv(rows, new_path(spark, "csv")))


@query("sink_parquet_scored", "SELECT transaction_id, amount, fraud_probability, fraud_risk_level,"
       " cast(timestamp AS date) AS date FROM scored")
def sink_parquet_scored(spark, sf):
    from riskgraph.catalog.reports import scored

    path = files.write_scored(scored(spark, sf), new_path(spark, "scored"))
    return files.read_scored(spark, path).select(
        "transaction_id", "amount", "fraud_probability", "fraud_risk_level", "date"
    )


@query("ts_parse", "SELECT transaction_id, timestamp FROM transactions")
def ts_parse(spark, sf):
    text = fx.transactions(spark, sf).select("transaction_id", F.col("timestamp").cast("string").alias("timestamp"))
    return files.parse_timestamp(text)


# ---------------------------------------------------------------- cleaning

DIRTY = "_seq, transaction_id, timestamp, amount, account_id, merchant_id, device_id, is_fraud, merchant_category"
part("deduped", "SELECT * FROM transactions_dirty QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY _seq) = 1")
part("filled", """SELECT * REPLACE (coalesce(amount, (SELECT median(amount) FROM deduped)) AS amount,
 coalesce(merchant_category, 'UNKNOWN') AS merchant_category) FROM deduped""")
AS_OF = f"TIMESTAMP '{fx.AS_OF}'"


@query("clean_dedup", f"SELECT {DIRTY} FROM deduped")
def clean_dedup(spark, sf):
    return clean.drop_duplicate_ids(fx.transactions_dirty(spark, sf))


@query("clean_fill_string", "SELECT _seq, transaction_id, coalesce(merchant_category, 'UNKNOWN') AS merchant_category"
       " FROM transactions_dirty")
def clean_fill_string(spark, sf):
    return clean.fill_strings(fx.transactions_dirty(spark, sf)).select("_seq", "transaction_id", "merchant_category")


@query("clean_fill_median", "SELECT _seq, transaction_id, amount FROM filled")
def clean_fill_median(spark, sf):
    rows = clean.drop_duplicate_ids(fx.transactions_dirty(spark, sf))
    return clean.fill_medians(rows).select("_seq", "transaction_id", "amount")


@query("clean_positive_amount", f"SELECT {DIRTY} FROM transactions_dirty WHERE amount > 0")
def clean_positive_amount(spark, sf):
    return clean.positive_amounts(fx.transactions_dirty(spark, sf))


@query("clean_not_future", f"SELECT {DIRTY} FROM transactions_dirty WHERE timestamp < {AS_OF}")
def clean_not_future(spark, sf):
    return clean.not_future(fx.transactions_dirty(spark, sf), fx.AS_OF)


@query("clean_pipeline", f"SELECT {DIRTY} FROM filled WHERE amount > 0 AND timestamp < {AS_OF}")
def clean_pipeline(spark, sf):
    return clean.clean(fx.transactions_dirty(spark, sf), fx.AS_OF)


# ---------------------------------------------------------------- features

part("account_stats", """SELECT account_id, count(*) AS account_txn_count, avg(amount) AS account_amount_mean,
 coalesce(stddev_samp(amount), 0) AS account_amount_std, max(amount) AS account_amount_max,
 cast(sum(is_fraud) AS bigint) AS fraud_count_per_account, count(DISTINCT device_id) AS devices_per_account
FROM transactions GROUP BY account_id""")
part("merchant_stats", "SELECT merchant_id, count(*) AS merchant_txn_count FROM transactions GROUP BY merchant_id")
part("device_stats", """SELECT device_id, count(*) AS device_txn_count,
 count(DISTINCT merchant_id) AS unique_merchants_per_device, count(DISTINCT account_id) AS accounts_per_device
FROM transactions GROUP BY device_id""")

# Feature name -> (SQL expression over the joined table, rounded).
EXPRESSIONS = {
    "hour": "cast(hour(timestamp) AS int)",
    "day_of_week": "cast(isodow(timestamp) - 1 AS int)",
    "month": "cast(month(timestamp) AS int)",
    "day_of_month": "cast(day(timestamp) AS int)",
    "is_weekend": "CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END",
    "is_night": "CASE WHEN hour(timestamp) >= 22 OR hour(timestamp) <= 5 THEN 1 ELSE 0 END",
    "high_risk_time": "CASE WHEN hour(timestamp) >= 22 OR hour(timestamp) <= 5 OR isodow(timestamp) >= 6 THEN 1 ELSE 0 END",
    "amount_log": "round(ln(1 + amount), 6)",
    "amount_bin": "CASE WHEN amount <= 0 THEN NULL WHEN amount <= 10 THEN 0 WHEN amount <= 50 THEN 1 WHEN amount <= 100 THEN 2"
    " WHEN amount <= 500 THEN 3 WHEN amount <= 1000 THEN 4 ELSE 5 END",
    "high_amount": "CASE WHEN amount > (SELECT quantile_cont(amount, 0.95) FROM transactions) THEN 1 ELSE 0 END",
    "account_txn_count": "account_txn_count",
    "account_amount_mean": "round(account_amount_mean, 6)",
    "account_amount_std": "round(account_amount_std, 6)",
    "account_amount_max": "account_amount_max",
    "amount_vs_account_mean": "round((amount - account_amount_mean) / (account_amount_std + 1), 6)",
    "time_since_last_txn": "round((epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER"
    " (PARTITION BY account_id ORDER BY timestamp, transaction_id)) / 3.6e9::DOUBLE, 6)",
    "merchant_txn_count": "merchant_txn_count",
    "device_txn_count": "device_txn_count",
    "unique_merchants_per_device": "unique_merchants_per_device",
    "accounts_per_device": "accounts_per_device",
    "shared_device_flag": "CASE WHEN accounts_per_device > 3 THEN 1 ELSE 0 END",
    "devices_per_account": "devices_per_account",
    "fraud_count_per_account": "fraud_count_per_account",
    "fraud_rate_per_account": "round(fraud_count_per_account / account_txn_count::DOUBLE, 6)",
}
ROUNDED = [n for n, e in EXPRESSIONS.items() if e.startswith("round")]
JOINED = (" FROM transactions JOIN account_stats USING (account_id) JOIN merchant_stats USING (merchant_id)"
          " JOIN device_stats USING (device_id)")


def feature_sql(names) -> str:
    return "SELECT transaction_id, " + ", ".join(f"{EXPRESSIONS[n]} AS {n}" for n in names) + JOINED


def _feature_query(key, names, build):
    def run(spark, sf):
        out = build(fx.transactions(spark, sf))
        return out.select("transaction_id", *[r6(n) if n in ROUNDED else n for n in names])

    query(key, feature_sql(names))(run)


def _times(df):
    return df.transform(features.calendar).transform(features.weekend_night)


_feature_query("feat_calendar", ["hour", "day_of_week", "month", "day_of_month"], features.calendar)
_feature_query("feat_weekend_night", ["is_weekend", "is_night"], _times)
_feature_query("feat_amount_log", ["amount_log"], features.amount_shape)
_feature_query("feat_amount_bin", ["amount_bin"], features.amount_shape)
_feature_query("feat_high_risk_time", ["high_risk_time"], lambda d: features.high_risk_time(_times(d)))
_feature_query("feat_high_amount", ["high_amount"], features.high_amount)
_feature_query("feat_account_count", ["account_txn_count"], features.account_features)
_feature_query("feat_account_amount_stats", ["account_amount_mean", "account_amount_std", "account_amount_max"],
               features.account_features)
_feature_query("feat_amount_deviation", ["amount_vs_account_mean"], features.account_features)
_feature_query("feat_time_since_last", ["time_since_last_txn"], features.time_since_last)
_feature_query("feat_merchant_count", ["merchant_txn_count"], features.merchant_features)
_feature_query("feat_device_count", ["device_txn_count"], features.device_features)
_feature_query("feat_merchants_per_device", ["unique_merchants_per_device"], features.device_features)
_feature_query("feat_accounts_per_device", ["accounts_per_device"], features.device_features)
_feature_query("feat_shared_device_flag", ["shared_device_flag"], features.device_features)
_feature_query("feat_devices_per_account", ["devices_per_account"], features.account_features)
_feature_query("feat_account_fraud", ["fraud_count_per_account", "fraud_rate_per_account"], features.account_features)
_feature_query("feat_all", list(EXPRESSIONS), features.engineer)

# ---------------------------------------------------------------- encoding


def _codes(column: str, table: str) -> str:
    return (f"SELECT {column}, cast(row_number() OVER (ORDER BY min(_seq)) - 1 AS int) AS code FROM {table}"
            f" WHERE {column} IS NOT NULL GROUP BY {column}")


part("code_category", _codes("merchant_category", "transactions"))
part("code_entry", _codes("entry_mode", "transactions"))
part("code_currency", _codes("currency", "transactions"))
part("code_dirty", _codes("merchant_category", "transactions_dirty"))


@query("enc_first_seen", """SELECT transaction_id, a.code AS merchant_category_encoded, b.code AS entry_mode_encoded,
 c.code AS currency_encoded FROM transactions JOIN code_category a USING (merchant_category)
 JOIN code_entry b USING (entry_mode) JOIN code_currency c USING (currency)""")
def enc_first_seen(spark, sf):
    return encode.encode_first_seen(fx.transactions(spark, sf)).select(
        "transaction_id", "merchant_category_encoded", "entry_mode_encoded", "currency_encoded"
    )


@query("enc_factorize", "SELECT _seq, coalesce(code, -1) AS merchant_category FROM transactions_dirty"
       " LEFT JOIN code_dirty USING (merchant_category)")
def enc_factorize(spark, sf):
    return encode.factorize(fx.transactions_dirty(spark, sf), ["merchant_category"]).select("_seq", "merchant_category")


@query("enc_clean_numeric", """SELECT _seq, coalesce(amount, 0) AS amount,
 CASE WHEN is_fraud = 1 OR _seq % 3 = 0 THEN 0.0::DOUBLE ELSE _seq::DOUBLE END AS odd FROM transactions_dirty""")
def enc_clean_numeric(spark, sf):
    odd = (F.when(F.col("is_fraud") == 1, float("inf")).when(F.col("_seq") % 6 == 0, float("-inf"))
           .when(F.col("_seq") % 3 == 0, float("nan")).otherwise(F.col("_seq").cast("double")))
    rows = fx.transactions_dirty(spark, sf).withColumn("odd", odd)
    return encode.clean_numeric(rows, ["amount", "odd"]).select("_seq", "amount", "odd")


@query("enc_standard_scale", """SELECT transaction_id,
 round((amount - (SELECT avg(amount) FROM transactions)) / (SELECT stddev_pop(amount) FROM transactions), 6) AS amount,
 round((hour - (SELECT avg(hour) FROM transactions)) / (SELECT stddev_pop(hour) FROM transactions), 6) AS hour
FROM transactions""")
def enc_standard_scale(spark, sf):
    out = encode.standard_scale(fx.transactions(spark, sf), ["amount", "hour"])
    return out.select("transaction_id", r6("amount"), r6("hour"))


@query("enc_feature_select", "SELECT amount, hour, day_of_week, is_weekend, card_present FROM transactions")
def enc_feature_select(spark, sf):
    rows = fx.transactions(spark, sf)
    return rows.select(*encode.feature_columns(rows, extra_exclude=("demo_probability",)))
