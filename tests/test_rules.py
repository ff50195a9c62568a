"""Boundaries of the scalar rules, and empty inputs."""

from pyspark.sql import functions as F

from riskgraph.functions import rules
from riskgraph.plans import reports
from riskgraph.operators import scoring


def values(spark, column, inputs, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {column} double")
    return [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]


def test_amount_edges(spark):
    amounts = [0.01, 10, 10.01, 50, 100, 200, 200.01, 500, 500.01, 1000, 1000.01]
    got = values(spark, "amount", map(float, amounts), rules.amount_bin(F.col("amount")),
                 F.round(rules.rule_probability(F.col("amount"), F.lit(12), F.lit(0)), 4))
    assert [g[0] for g in got] == [0, 0, 1, 1, 2, 3, 3, 3, 4, 4, 5]
    assert [g[1] for g in got] == [0.05] * 6 + [0.13, 0.13, 0.2, 0.2, 0.2]


def test_hours_and_days(spark):
    hours = [0, 5, 6, 21, 22, 23]
    got = values(spark, "h", map(float, hours), rules.is_night(F.col("h")))
    assert [g[0] for g in got] == [1, 1, 0, 0, 1, 1]
    got = values(spark, "d", [4.0, 5.0, 6.0], rules.is_weekend(F.col("d")),
                 F.round(rules.rule_probability(F.lit(1.0), F.lit(12), F.col("d")), 4))
    assert got == [(0, 0.05), (1, 0.1), (1, 0.1)]


def test_probability_edges(spark):
    edges = [0.2, 0.3, 0.4, 0.5, 0.7, 0.8]
    inputs = [x for e in edges for x in (e, e + 0.0001)]
    got = values(spark, "p", inputs, rules.risk_level(F.col("p")), rules.priority_level(F.col("p")),
                 rules.model_priority_level(F.col("p")), rules.community_level(F.col("p")), rules.community_band(F.col("p")))
    at = {i: g for i, g in zip(inputs, got)}
    assert at[0.4][0] == "LOW" and at[0.4001][0] == "MEDIUM" and at[0.8][0] == "MEDIUM" and at[0.8001][0] == "HIGH"
    assert at[0.3][1] == "LOW" and at[0.3001][1] == "MEDIUM" and at[0.5][1] == "MEDIUM" and at[0.7][1] == "HIGH"
    assert at[0.7001][1] == "CRITICAL"
    assert at[0.5][2] == "MEDIUM" and at[0.5001][2] == "HIGH"
    assert at[0.2][3] == "LOW" and at[0.2001][3] == "MEDIUM" and at[0.3][4] == "LOW" and at[0.3001][4] == "MEDIUM"


def test_rule_terms_are_added_as_doubles(spark):
    df = spark.createDataFrame([(600.0, 23, 0)], "amount double, hour int, day_of_week int")
    p = df.select(rules.rule_probability(F.col("amount"), F.col("hour"), F.col("day_of_week"))).first()[0]
    assert p == 0.05 + 0.15 + 0.10 and p > 0.3


def test_thresholds_of_the_two_high_risk_lists(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.51)], "transaction_id string, fraud_probability double").selectExpr(
        "*", "current_timestamp() as timestamp", "1.0 as amount", "'x' as account_id", "'m' as merchant_id")
    assert scoring.high_risk(df).count() == 2
    assert reports.top_high_risk(df).count() == 1


def test_empty_reports_are_zero(spark):
    df = spark.createDataFrame([], "transaction_id string, account_id string, merchant_id string, device_id string,"
                                   " is_fraud int, fraud_probability double, fraud_risk_level string, community_id string")
    assert set(reports.kpis(df).first()) == {0}
    assert set(reports.summary_stats(df).first()) == {0}


def test_missing_graph_columns_count_as_zero(spark):
    df = spark.createDataFrame([(0.9,)], "fraud_probability double")
    out = scoring.scoring(df).first()
    assert out["graph_risk_flag"] == 0 and out["investigation_priority"] == 0.9 * 0.6 and out["fraud_risk_level"] == "HIGH"
