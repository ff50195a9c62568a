"""Queries over training, anomaly detection and explanation.

Models are fitted on the whole feature table of the given data. The fitted model
and its feature table are kept per session and data folder, so the queries that
need "a trained model" share one. Boosting, the comparison and cross-validation use
ROUNDS trees here; the library default is 200, and the single forest keeps it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from riskgraph import fixtures as fx
from riskgraph.catalog.registry import part, query, r6
from riskgraph.catalog.tables import EXPRESSIONS, JOINED, ROUNDED
from riskgraph.operators import anomaly, encode, explain, features, metrics, scoring, smote, training
from riskgraph.plans import pipeline, reports
from riskgraph.session import ON_RELEASE, materialise, new_path

ROUNDS = 20
_KEPT: dict[tuple, object] = {}
ON_RELEASE.append(_KEPT.clear)


def _once(spark, sf, name, build):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def training_table(spark, sf):
    """Cleaned, engineered, encoded transactions with the account graph features and a label."""
    def build():
        rows = pipeline.etl(fx.transactions(spark, sf), fx.AS_OF)
        rows = pipeline.merge_graph_features(rows)
        return materialise(rows.withColumn("label", F.col("is_fraud")))

    return _once(spark, sf, "table", build)


def model_features(df):
    """The fixed list as far as present, without the community label."""
    return [c for c in encode.model_columns(df) if c != "community_id"]


def matrix(spark, sf):
    df = training_table(spark, sf)
    return _once(spark, sf, "matrix", lambda: materialise(
        encode.prepare_matrix(df, model_features(df), keep=("transaction_id", "label"))
    ))


def trained(spark, sf):
    df = matrix(spark, sf)
    return _once(spark, sf, "boosted", lambda: training.train(df, model_features(df), training.BOOSTED))


# ---------------------------------------------------------------- training

PREPARED = [n for n in EXPRESSIONS]
part("coded", """SELECT transaction_id, a.code AS merchant_category_encoded, b.code AS entry_mode_encoded, c.code AS currency_encoded
FROM transactions JOIN code_category a USING (merchant_category) JOIN code_entry b USING (entry_mode)
JOIN code_currency c USING (currency)""")
_PREPARED_SQL = ", ".join(f"coalesce({EXPRESSIONS[n]}, 0) AS {n}" for n in PREPARED)
part("prepared", f"SELECT transaction_id, transactions.amount AS amount, is_fraud AS label, card_present, {_PREPARED_SQL}{JOINED}")
CODES = ["merchant_category_encoded", "entry_mode_encoded", "currency_encoded"]


def _engineered(spark, sf):
    return encode.encode_first_seen(features.engineer(fx.transactions(spark, sf)))


@query("ml_prepare", f"""SELECT p.transaction_id, label, amount, card_present, {', '.join(PREPARED)}, {', '.join(CODES)}
FROM prepared p JOIN coded USING (transaction_id)""")
def ml_prepare(spark, sf):
    rows = _engineered(spark, sf).withColumn("label", F.col("is_fraud"))
    names = encode.feature_columns(rows, extra_exclude=("label", "demo_probability"))
    out = encode.prepare_matrix(rows, names, keep=("transaction_id", "label"))
    return out.select(*[r6(c) if c in ROUNDED else c for c in out.columns])


part("class_counts", """SELECT count(*) FILTER (is_fraud = 1) AS pos, count(*) FILTER (is_fraud = 0) AS neg FROM transactions
 WHERE amount > 0 AND timestamp < TIMESTAMP '2024-02-01 00:00:00'""")


@query("ml_smote", """SELECT 0 AS label, 0 AS synthetic, neg AS row_count, cast(0 AS bigint) AS outside FROM class_counts
UNION ALL SELECT 1, 0, pos, 0 FROM class_counts UNION ALL SELECT 1, 1, neg - pos, 0 FROM class_counts""")
def ml_smote(spark, sf):
    """Rows per class after oversampling, and how many new values leave the minority's range."""
    df = matrix(spark, sf)
    names = model_features(df)
    made = smote.smote(df, names)
    low_high = df.where("label = 1").agg(*[F.min(c) for c in names], *[F.max(c) for c in names]).first()
    out = F.lit(False)
    for i, c in enumerate(names):
        slack = 1e-9 * (1 + abs(low_high[i]) + abs(low_high[len(names) + i]))
        out = out | (F.col(c) < low_high[i] - slack) | (F.col(c) > low_high[len(names) + i] + slack)
    return made.groupBy("label", "synthetic").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.when((F.col("synthetic") == 1) & out, 1).otherwise(0)).alias("outside"),
    )


@query("ml_class_weight", """SELECT 0 AS label, neg AS rows, round((neg + pos) / (2 * neg)::DOUBLE, 6) AS balanced_weight, 1.0::DOUBLE AS boosting_weight FROM class_counts
UNION ALL SELECT 1, pos, round((neg + pos) / (2 * pos)::DOUBLE, 6), round(neg / pos::DOUBLE, 6) FROM class_counts""")
def ml_class_weight(spark, sf):
    out = training.class_weights(matrix(spark, sf))
    return out.select("label", "rows", r6("balanced_weight"), r6("boosting_weight"))


@query("ml_stratified_split", """SELECT 0 AS label, cast(floor(neg * 0.8::DOUBLE + 0.5) AS bigint) AS train_rows, neg - cast(floor(neg * 0.8::DOUBLE + 0.5) AS bigint) AS test_rows FROM class_counts
UNION ALL SELECT 1, cast(floor(pos * 0.8::DOUBLE + 0.5) AS bigint), pos - cast(floor(pos * 0.8::DOUBLE + 0.5) AS bigint) FROM class_counts""")
def ml_stratified_split(spark, sf):
    folds = training.stratified_folds(matrix(spark, sf), [0.8])
    return folds.groupBy("label").agg(
        F.sum(F.when(F.col("fold") == 0, 1).otherwise(0)).alias("train_rows"),
        F.sum(F.when(F.col("fold") == 1, 1).otherwise(0)).alias("test_rows"),
    )


@query("ml_boosted_trees")
def ml_boosted_trees(spark, sf):
    return trained(spark, sf)[1].withColumn("model", F.lit(training.BOOSTED))


@query("ml_random_forest")
def ml_random_forest(spark, sf):
    df = matrix(spark, sf)
    return training.train(df, model_features(df), training.FOREST)[1].withColumn(
        "model", F.lit(training.FOREST)
    )


def _predictions(spark, sf):
    return fx.transactions(spark, sf).select(
        "transaction_id", F.col("is_fraud").alias("label"), F.col("demo_probability").alias("score")
    )


part("by_score", """SELECT demo_probability AS s, sum(is_fraud) AS pos, count(*) - sum(is_fraud) AS neg FROM transactions GROUP BY 1""")
part("stacked", "SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM by_score")
part("tallies", """SELECT sum(pos * (below + neg / 2.0::DOUBLE)) / sum(pos) / sum(neg) AS auc,
 sum(pos) FILTER (s > 0.5::DOUBLE) AS tp, sum(neg) FILTER (s > 0.5::DOUBLE) AS fp, sum(pos) AS p FROM stacked""")


@query("ml_metrics", """SELECT round(auc, 6) AS roc_auc, round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / p::DOUBLE, 6) AS recall,
 round(2.0::DOUBLE * tp / (tp + fp + p), 6) AS f1 FROM tallies""")
def ml_metrics(spark, sf):
    out = metrics.metrics(_predictions(spark, sf))
    return out.select(*[r6(c) for c in out.columns])


@query("ml_confusion", """SELECT label, predicted, (SELECT count(*) FROM transactions WHERE is_fraud = label
 AND (CASE WHEN demo_probability > 0.5::DOUBLE THEN 1 ELSE 0 END) = predicted) AS row_count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(label, predicted)""")
def ml_confusion(spark, sf):
    return metrics.confusion(_predictions(spark, sf))


@query("ml_cross_validate")
def ml_cross_validate(spark, sf):
    df = matrix(spark, sf)
    return training.cross_validate(df, model_features(df), training.FOREST, folds=5)


@query("ml_feature_importance")
def ml_feature_importance(spark, sf):
    return trained(spark, sf)[0].importance(spark)


@query("ml_best_model")
def ml_best_model(spark, sf):
    df = matrix(spark, sf)
    return training.train_best(df, model_features(df), rounds=ROUNDS)[1]


@query("ml_score")
def ml_score(spark, sf):
    return trained(spark, sf)[0].score(training_table(spark, sf)).select("transaction_id", "fraud_probability")


@query("model_save_load")
def model_save_load(spark, sf):
    """Scores of a model that was saved, then found behind a path that holds none."""
    path = trained(spark, sf)[0].save(new_path(spark, "model"))
    loaded = training.load_model(spark, [path + "-absent", path])
    return loaded.score(training_table(spark, sf)).select(
        "transaction_id", "fraud_probability", F.lit(loaded is not None).alias("loaded")
    )


# ---------------------------------------------------------------- anomaly


def _detector(spark, sf):
    df = matrix(spark, sf)
    return _once(spark, sf, "detector", lambda: anomaly.fit(df, model_features(df)))


@query("anom_fit", """SELECT cast(t.range AS int) AS tree, cast(least(256, pos + neg) AS int) AS sample, true AS grown, true AS depth_ok
FROM range(200) t, class_counts""")
def anom_fit(spark, sf):
    """Per tree of the fitted forest: its sample, whether it split at all, whether it kept the depth limit."""
    d = _detector(spark, sf)
    limit = int(np.ceil(np.log2(max(d.sample, 2))))
    rows = []
    for t in range(d.nodes["feature"].shape[0]):
        deepest, waiting = 0, [(0, 0)]
        while waiting:
            at, depth = waiting.pop()
            deepest = max(deepest, depth)
            if d.nodes["feature"][t, at] >= 0:
                waiting += [(int(d.nodes["left"][t, at]), depth + 1), (int(d.nodes["right"][t, at]), depth + 1)]
        rows.append((t, d.sample, bool(d.nodes["feature"][t, 0] >= 0), deepest <= limit))
    return spark.createDataFrame(rows, "tree int, sample int, grown boolean, depth_ok boolean")


@query("anom_score", "SELECT pos + neg AS rows, 0.0::DOUBLE AS lowest, 1.0::DOUBLE AS highest FROM class_counts")
def anom_score(spark, sf):
    """Scores of all rows: how many, and that both ends of [0, 1] are reached."""
    scored = anomaly.detect(matrix(spark, sf), _detector(spark, sf))
    return scored.agg(F.count(F.lit(1)).alias("rows"), r6(F.min("anomaly_score")).alias("lowest"),
                      r6(F.max("anomaly_score")).alias("highest"))


@query("anom_flag", "SELECT pos + neg AS rows, true AS share_near_contamination FROM class_counts")
def anom_flag(spark, sf):
    """Flags of all rows: the flagged share lies within one point of the contamination (5%)."""
    scored = anomaly.detect(matrix(spark, sf), _detector(spark, sf))
    share = F.avg(F.col("is_anomaly").cast("double"))
    return scored.agg(F.count(F.lit(1)).alias("rows"), (F.abs(share - 0.05) <= 0.01).alias("share_near_contamination"))


@query("full_run", """SELECT pos + neg AS rows, 0.0::DOUBLE AS lowest_anomaly, 1.0::DOUBLE AS highest_anomaly,
 true AS share_near_contamination, true AS scores_in_range FROM class_counts""")
def full_run_query(spark, sf):
    """The whole batch job (cleaning, features, graph, forest, rules, final score) over all rows, summarised
    by what SQL can state: every cleaned row scored, both ends of the anomaly score reached, 5% flagged
    within a point, every final score in [0, 1]."""
    out = pipeline.full_run(fx.transactions(spark, sf), fx.AS_OF)
    share = F.avg(F.col("is_anomaly").cast("double"))
    in_range = F.min(F.col("final_risk_score").between(0, 1).cast("int")) == 1
    return out.agg(
        F.count(F.lit(1)).alias("rows"), r6(F.min("anomaly_score")).alias("lowest_anomaly"),
        r6(F.max("anomaly_score")).alias("highest_anomaly"),
        (F.abs(share - 0.05) <= 0.01).alias("share_near_contamination"), in_range.alias("scores_in_range"),
    )


def _fixed_anomaly(spark, sf):
    return fx.transactions(spark, sf).withColumn("anomaly_raw", F.col("demo_probability") - 0.5)


part("anomalies", """SELECT *, (hi - (demo_probability - 0.5::DOUBLE)) / (hi - lo) AS anomaly_score FROM transactions
CROSS JOIN (SELECT min(demo_probability - 0.5::DOUBLE) AS lo, max(demo_probability - 0.5::DOUBLE) AS hi FROM transactions)""")


@query("anom_minmax", "SELECT transaction_id, round(anomaly_score, 6) AS anomaly_score FROM anomalies")
def anom_minmax(spark, sf):
    return anomaly.minmax_inverted(_fixed_anomaly(spark, sf), "anomaly_raw").select("transaction_id", r6("anomaly_score"))


@query("anom_top", "SELECT transaction_id, round(anomaly_score, 6) AS anomaly_score FROM anomalies WHERE anomaly_score >= 0.5::DOUBLE")
def anom_top(spark, sf):
    rows = anomaly.minmax_inverted(_fixed_anomaly(spark, sf), "anomaly_raw")
    return anomaly.top_anomalies(rows).select("transaction_id", r6("anomaly_score"))


@query("final_risk_score", """SELECT transaction_id, round(demo_probability * 0.5::DOUBLE + anomaly_score * 0.3::DOUBLE
 + (CASE WHEN accounts_per_device > 3 THEN 1 ELSE 0 END) * 0.2::DOUBLE, 6) AS final_risk_score
FROM anomalies JOIN device_stats USING (device_id)""")
def final_risk_score(spark, sf):
    rows = anomaly.minmax_inverted(_fixed_anomaly(spark, sf), "anomaly_raw")
    rows = rows.withColumn("fraud_probability", F.col("demo_probability"))
    rows = scoring.add_graph_flags(features.device_features(rows))
    return scoring.with_final_score(rows).select("transaction_id", r6("final_risk_score"))


# ---------------------------------------------------------------- explanation


@query("explain_local")
def explain_local(spark, sf):
    return explain.explain_rows(training_table(spark, sf), trained(spark, sf)[0])


@query("explain_global")
def explain_global(spark, sf):
    return explain.global_importance(training_table(spark, sf), trained(spark, sf)[0])


VARIED = ["amount", "hour", "day_of_week", "is_weekend", "card_present"]
_VARIANCES = " UNION ALL ".join(f"SELECT '{c}' AS feature, var_samp({c}) AS v FROM transactions" for c in VARIED)
part("variances", _VARIANCES)


@query("explain_variance", "SELECT feature, round(v / (SELECT sum(v) FROM variances), 6) AS shap_importance FROM variances")
def explain_variance(spark, sf):
    out = explain.variance_importance(fx.transactions(spark, sf), VARIED)
    return out.select("feature", r6("shap_importance"))


@query("explain_importance_proxy")
def explain_importance_proxy(spark, sf):
    return explain.importance_proxy(trained(spark, sf)[0], spark)


CONTRIBUTING = ["amount", "hour", "day_of_week", "card_present", "is_weekend", "is_fraud"]
part("contributed", " UNION ALL ".join(
    f"SELECT transaction_id, demo_probability, '{c}' AS feature, cast({c} AS double) AS value,"
    f" (cast({c} AS double) - 3) / 10 AS shap_impact FROM transactions" for c in CONTRIBUTING
))


@query("explain_top_contributors", """SELECT transaction_id, cast(row_number() OVER w AS int) AS rank, feature, value, round(shap_impact, 6) AS shap_impact,
 CASE WHEN shap_impact > 0 THEN 'increases' ELSE 'decreases' END AS direction,
 CASE WHEN demo_probability > 0.8::DOUBLE THEN 'HIGH' WHEN demo_probability > 0.4::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM contributed WINDOW w AS (PARTITION BY transaction_id ORDER BY abs(shap_impact) DESC, feature)
QUALIFY row_number() OVER w <= 5""")
def explain_top_contributors(spark, sf):
    from riskgraph.functions import rules

    rows = fx.transactions(spark, sf)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("feature_value")) for c in CONTRIBUTING
    ])
    long = rows.select("transaction_id", F.explode(pairs).alias("e")).select(
        "transaction_id", "e.feature", "e.feature_value", ((F.col("e.feature_value") - 3) / 10).alias("shap_value")
    )
    level = rows.select("transaction_id", rules.risk_level(F.col("demo_probability")).alias("risk_level"))
    out = explain.top_contributors(long).join(level, "transaction_id")
    return out.withColumn("shap_impact", F.round("shap_impact", 6))


ALIGNED = ["amount", *[n for n in PREPARED if n not in ("month", "day_of_month")], *CODES]


@query("explain_align", f"SELECT p.transaction_id, {', '.join(ALIGNED)} FROM prepared p JOIN coded USING (transaction_id)")
def explain_align(spark, sf):
    out = explain.align(_engineered(spark, sf))
    return out.select(*[r6(c) if c in ROUNDED else c for c in out.columns])


@query("explain_beeswarm_table")
def explain_beeswarm_table(spark, sf):
    return explain.beeswarm_table(training_table(spark, sf), trained(spark, sf)[0])


@query("dash_top_features", """SELECT feature, round(v / (SELECT sum(v) FROM variances), 6) AS shap_importance FROM variances
ORDER BY v DESC, feature LIMIT 15""")
def dash_top_features(spark, sf):
    out = reports.top_features(explain.variance_importance(fx.transactions(spark, sf), VARIED))
    return out.select("feature", r6("shap_importance"))
