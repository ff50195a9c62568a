"""The branches for large or skewed data give the results of the ordinary ones."""

import random

import pytest
from pyspark.sql import functions as F

from riskgraph import fixtures as fx
from riskgraph.functions import order, skew
from riskgraph.operators import encode, features


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_attach_salted(spark, how):
    left = spark.range(1000).select("id", F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    want = rows(left.join(right, "k", how))
    assert rows(skew.attach(left, right, "k", how)) == want
    assert rows(skew.attach(left, right, "k", how, broadcast_rows=0)) == want
    assert rows(skew.attach(left, right, "k", how, broadcast_rows=0, hot_rows=30)) == want


def test_hot_keys(spark):
    counts = spark.createDataFrame([(1, 100), (2, 5)], "k int, _n bigint")
    assert skew.hot_keys(counts, ["k"], 200) is None
    assert [tuple(r) for r in skew.hot_keys(counts, ["k"], 30).collect()] == [(1, 4)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quantiles_by_narrowing(spark, seed):
    rnd = random.Random(seed)
    values = [rnd.choice([0.0, 1.5, rnd.gauss(0, 1e6), rnd.random() * 1e-6]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    probs = [0.0, 0.05, 0.5, 0.95, 0.999, 1.0]
    want = order.exact_quantiles(df, {"v": probs})["v"]
    assert order.exact_quantiles(df, {"v": probs}, built_in_limit=0)["v"] == pytest.approx(want, rel=1e-12)


def test_positions_and_totals(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("k"), F.lit(2).alias("v")).repartition(7)
    placed = order.with_row_position(df, ["k"]).collect()
    assert all(r["k"] == r["position"] for r in placed)
    totals = order.with_total_before(df, ["k"], "v", "before").collect()
    assert all(r["before"] == 2 * r["k"] for r in totals)


def test_time_since_last_on_hot_accounts(spark, make_transactions):
    rnd = random.Random(5)
    table = [(rnd.choice(["hot", "hot", "hot", f"a{rnd.randrange(5)}"]), "1", "m", 1.0,
              f"2024-01-{rnd.choice([1, 1, 2, 9]):02d} 10:{rnd.randrange(3):02d}:{rnd.randrange(4):02d}") for _ in range(300)]
    df = make_transactions(table)
    want = rows(features.time_since_last(df).select("transaction_id", "time_since_last_txn"))
    got = rows(features.time_since_last(df, hot_rows=50).select("transaction_id", "time_since_last_txn"))
    assert got == want


def test_long_code_table(spark, sf, monkeypatch):
    df = fx.transactions(spark, sf).select("_seq", "merchant_id")
    want = rows(encode.factorize(df, ["merchant_id"]))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 3)
    assert rows(encode.factorize(df, ["merchant_id"])) == want


def test_features_do_not_depend_on_partitioning(spark, sf):
    df = fx.transactions(spark, sf)
    names = ["transaction_id", "account_txn_count", "time_since_last_txn", "accounts_per_device", "high_amount"]
    assert rows(features.engineer(df).select(*names)) == rows(features.engineer(df.repartition(13)).select(*names))


def test_one_row_account(make_transactions):
    out = features.engineer(make_transactions([("a", "1")])).first()
    assert out["account_amount_std"] == 0.0 and out["time_since_last_txn"] is None


def test_long_sides_are_not_broadcast_in_loops(spark, make_transactions, monkeypatch):
    """Above the limit of iterations nothing is broadcast, however small its file, and communities stay the same."""
    from riskgraph.operators import louvain, sharing

    df = make_transactions([(f"a{i // 3}", f"d{i % 3 + 3 * (i // 9)}") for i in range(60)] + [("x", "d0"), ("x", "d5")])
    want = rows(louvain.louvain(df))
    monkeypatch.setattr(skew, "LOOP_BROADCAST_ROWS", 0)
    assert rows(louvain.louvain(df)) == want
    left = spark.range(100).selectExpr("id % 5 as k", "id as v")
    joined = skew.attach(left, left.groupBy("k").count(), "k", broadcast_rows=skew.loop_rows())
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    graph = sharing.sharing(df)
    assert not graph.short and rows(graph.degrees()) == rows(sharing.sharing(df).degrees())


def test_louvain_sweeps_run_two_jobs_and_spread_hot_nodes(spark, make_transactions, monkeypatch):
    """Above the broadcast limit a sweep counts no join keys of its own, and salted nodes and communities change no label."""
    from riskgraph.operators import louvain

    df = make_transactions([(f"a{i:02d}", f"d{(i * 7 + j) % 9}") for i in range(30) for j in (0, i % 4)] + [("x", f"d{i}") for i in range(9)])
    monkeypatch.setattr(louvain, "SWEEPS", 2)
    monkeypatch.setattr(louvain, "LEVELS", 1)
    want = rows(louvain.louvain(df))
    counted, written, sweeps = [], [], []
    keys, table, sweep = skew.hot_keys, louvain.materialise_with, louvain._sweep
    monkeypatch.setattr(skew, "LOOP_BROADCAST_ROWS", 0)
    monkeypatch.setattr(skew, "hot_keys", lambda *a, **o: counted.append(1) or keys(*a, **o))
    monkeypatch.setattr(louvain, "materialise_with", lambda *a, **o: written.append(1) or table(*a, **o))
    monkeypatch.setattr(louvain, "_sweep", lambda *a: sweeps.append(1) or sweep(*a))
    assert rows(louvain.louvain(df)) == want
    assert len(sweeps) == 4 and len(counted) < len(sweeps)
    assert len(written) == 1 + louvain.LEVELS + 2 * len(sweeps)
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    assert rows(louvain.louvain(df)) == want
