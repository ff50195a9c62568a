"""Properties of the seeded and fitted operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskgraph import fixtures as fx
from riskgraph.operators import anomaly, explain, smote, training

FEATURES = ["amount", "hour", "day_of_week", "card_present"]


@pytest.fixture(scope="module")
def table(spark, sf):
    return fx.transactions(spark, sf).select("transaction_id", *FEATURES, F.col("is_fraud").alias("label")).cache()


@pytest.fixture(scope="module")
def boosted(table):
    return training.fit(table, FEATURES, training.BOOSTED, rounds=5)


@pytest.fixture(scope="module")
def forest(table):
    return training.fit(table, FEATURES, training.FOREST, rounds=10)


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_contributions_add_up(table, request, kind):
    model = request.getfixturevalue(kind)
    sums = explain.explain_rows(table, model).groupBy("transaction_id").agg(
        (F.first("base_value") + F.sum("shap_value")).alias("total"))
    joined = model.score(table).join(sums, "transaction_id").select("fraud_probability", "total").toPandas()
    total = joined["total"].to_numpy()
    want = 1 / (1 + np.exp(-2 * total)) if kind == "boosted" else total
    assert np.allclose(want, joined["fraud_probability"], atol=1e-9)


def test_fit_is_repeatable(table, boosted):
    again = training.fit(table, FEATURES, training.BOOSTED, rounds=5)
    a, b = (m.score(table).orderBy("transaction_id").toPandas()["fraud_probability"] for m in (boosted, again))
    assert np.array_equal(a, b)


def test_save_and_load(spark, table, boosted):
    from riskgraph.session import new_path

    path = new_path(spark, "model")
    assert training.load_model(spark, [path]) is None
    boosted.save(path)
    loaded = training.load_model(spark, [path + "-none", path])
    assert loaded.features == FEATURES and loaded.kind == training.BOOSTED


def test_split_sizes(table):
    counts = {r[0]: r[1] for r in table.groupBy("label").count().collect()}
    fit_part, rest = training.stratified_split(table.repartition(11), 0.2)
    got = {r[0]: r[1] for r in fit_part.groupBy("label").count().collect()}
    assert got == {k: int(0.8 * n + 0.5) for k, n in counts.items()}
    assert fit_part.count() + rest.count() == sum(counts.values())
    assert fit_part.join(rest, "transaction_id").count() == 0


def test_rank_limits_of_many_groups_in_six_collects(spark, monkeypatch):
    from riskgraph.functions.order import rank_limits

    rows = [(g, (i * 7919) % 50 if g == 2 else (i * 104729) % (1 << 52), f"r{i:04d}") for g in range(3) for i in range(400)]
    rows += [(1, 5, None), (1, 5, "a"), (1, 5, "a")]
    df = spark.createDataFrame(rows, "g int, k long, id string")
    wanted = [(g, r) for g in range(3) for r in (0, 57, 199, 399)] + [(1, 402)]
    calls = []
    real = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: calls.append(1) or real(self))
    got = rank_limits(df, "g", "k", "id", wanted)
    monkeypatch.undo()
    assert len(calls) == 6
    for g, r in wanted:
        ordered = sorted((k, i is not None, i or "") for gg, k, i in rows if gg == g)
        k, has, i = ordered[r]
        assert got[(g, r)] == (k, i if has else None)


@pytest.mark.parametrize("exact", [True, False])
def test_smote_is_balanced_and_inside(table, monkeypatch, exact):
    if not exact:
        monkeypatch.setattr(smote, "EXACT_ROWS", 4)
        monkeypatch.setattr(smote, "STRETCH_ROWS", 8)
    out = smote.smote(table, FEATURES)
    counts = {(r[0], r[1]): r[2] for r in out.groupBy("label", "synthetic").count().collect()}
    assert counts[(0, 0)] == counts[(1, 0)] + counts[(1, 1)]
    minority = table.where("label = 1").toPandas()
    made = out.where("synthetic = 1").toPandas()
    for c in FEATURES:
        assert made[c].min() >= minority[c].min() - 1e-9 and made[c].max() <= minority[c].max() + 1e-9


def test_neighbours_are_the_nearest(table):
    minority = table.where("label = 1")
    near = smote.minority_neighbours(minority, FEATURES, "transaction_id", 42).toPandas()
    x = {r["transaction_id"]: np.array([float(r[c]) for c in FEATURES]) for r in minority.collect()}
    for _, r in near.iterrows():
        d = sorted(((x[r["id"]] - v) ** 2).sum() for k, v in x.items() if k != r["id"])[:5]
        got = sorted(((x[r["id"]] - np.array(v)) ** 2).sum() for v in r["near"])
        assert np.allclose(d, got)


def test_anomaly_scores(table):
    detector = anomaly.fit(table, FEATURES, trees=50)
    out = anomaly.detect(table, detector).toPandas()
    assert out["anomaly_score"].min() == 0.0 and out["anomaly_score"].max() == 1.0
    assert abs(out["is_anomaly"].mean() - 0.05) < 0.01
    again = anomaly.detect(table.repartition(5), anomaly.fit(table.repartition(5), FEATURES, trees=50)).toPandas()
    a, b = (d.sort_values("transaction_id")["anomaly_score"].to_numpy() for d in (out, again))
    assert np.allclose(a, b)
    assert out.sort_values("anomaly_score")["amount"].tail(20).mean() > out["amount"].mean()


def test_constant_scores_do_not_divide_by_zero(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "s double")
    assert [r["anomaly_score"] for r in anomaly.minmax_inverted(df, "s").collect()] == [0.0, 0.0]


def test_forest_grows_on_neighbouring_doubles_and_constant_columns(spark):
    """A split between two neighbouring doubles must not send every row one way."""
    low = 0.1
    high = float(np.nextafter(low, 1.0))
    rows = [(f"t{i}", low if i % 2 else high, 7.0) for i in range(40)]
    df = spark.createDataFrame(rows, "transaction_id string, a double, c double")
    detector = anomaly.fit(df, ["a", "c"], trees=30, sample=16)
    assert (detector.nodes["feature"][:, 0] == 0).all()  # the constant column is never split on
    out = anomaly.detect(df, detector).toPandas()
    assert len(out) == 40 and out["anomaly_score"].between(0, 1).all()


def test_each_tree_draws_exactly_its_lowest_rows(spark):
    from riskgraph.functions.rules import uniform

    df = spark.range(500).select(F.col("id"), F.array(F.col("id").cast("double")).alias("x"))
    drawn = anomaly._bottom_k(df, 500, trees=7, k=20, seed=3).toPandas()
    draws = df.select("id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("tree")).select(
        "tree", "id", uniform(F.col("id"), F.col("tree"), F.lit(4)).alias("d")).toPandas()
    want = draws.sort_values(["tree", "d", "id"]).groupby("tree").head(20)
    assert sorted(zip(drawn["tree"], drawn["id"])) == sorted(zip(want["tree"], want["id"]))


def test_saved_detector_scores_another_table_alike(spark, table, tmp_path):
    detector = anomaly.fit(table, FEATURES, trees=20)
    loaded = anomaly.load(spark, anomaly.save(spark, detector, str(tmp_path / "forest")))
    other = table.where("hour < 12")
    a, b = (anomaly.detect(other, d).toPandas().sort_values("transaction_id") for d in (detector, loaded))
    assert np.array_equal(a["anomaly_score"].to_numpy(), b["anomaly_score"].to_numpy())
    assert loaded.offset == detector.offset and loaded.columns == detector.columns


def test_empty_table_gives_a_forest_without_trees(spark):
    df = spark.createDataFrame([], "transaction_id string, a double")
    detector = anomaly.fit(df, ["a"], trees=5)
    assert detector.nodes["feature"].shape[0] == 0


def test_lowest_columns_equal_a_stable_sort():
    rng = np.random.default_rng(7)
    for k in (1, 3, 5):
        d = rng.integers(0, 6, (40, 30)).astype(float)
        d[3, :29] = np.inf
        assert (smote._lowest(d, k) == np.argsort(d, axis=1, kind="stable")[:, :k]).all()
    assert smote._lowest(np.zeros((4, 1)), 0).shape == (4, 0)


def test_rows_walk_full_trees_like_the_grown_ones(spark):
    """Scores over the full binary trees equal a walk along the node table, row by row."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(5000, 4)), 1)
    df = spark.createDataFrame([(f"t{i:05d}", *map(float, v)) for i, v in enumerate(x)], "transaction_id string, a double, b double, c double, d double")
    detector = anomaly.fit(df, ["a", "b", "c", "d"], trees=12, sample=64)
    n = detector.nodes
    depth = anomaly._levels(n)
    assert depth <= 6 and all(a.shape == (12, 2 ** (depth + 1) - 1) for a in anomaly._heaps(n, depth))
    got = {r["transaction_id"]: r["s"] for r in df.select("transaction_id", anomaly._score(detector, scaled=False).alias("s")).collect()}
    for i in range(0, 5000, 97):
        z = [(v - detector.scale[c][0]) / detector.scale[c][1] for c, v in zip("abcd", x[i])]
        total = 0.0
        for t in range(12):
            at = 0
            while n["feature"][t, at] >= 0:
                at = n["left" if z[n["feature"][t, at]] <= n["threshold"][t, at] else "right"][t, at]
            total += n["path"][t, at]
        assert got[f"t{i:05d}"] == pytest.approx(-2 ** (-total / 12 / float(anomaly._usual_path(64))), rel=1e-12)


def test_training_rows_are_spread_over_tasks(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    seen = []
    plain = RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or plain(self, df))
    monkeypatch.setattr(training, "ROWS_PER_TASK", 50)
    df = spark.range(0, 600, 1, 2).selectExpr("cast(id % 7 as double) a", "cast(id % 3 = 0 as int) label")
    training.fit(df, ["a"], training.FOREST, rounds=2)
    monkeypatch.setattr(training, "ROWS_PER_TASK", 1000)
    training.fit(df, ["a"], training.FOREST, rounds=2)
    assert seen == [12, 2]


def _trees_asked(table, monkeypatch):
    """The trees every fit asks for, in order; one is grown."""
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    from riskgraph.catalog import models

    seen = []
    monkeypatch.setattr(models, "_KEPT", {})
    monkeypatch.setattr(models, "matrix", lambda *_: table)
    monkeypatch.setattr(models, "model_features", lambda _: FEATURES)
    for learner, name in ((GBTClassifier, "maxIter"), (RandomForestClassifier, "numTrees")):
        def fit(self, df, plain=learner.fit, name=name):
            seen.append(self.getOrDefault(name))
            return plain(self.copy({self.getParam(name): 1}), df)
        monkeypatch.setattr(learner, "fit", fit)
    return models, seen


def test_cross_validation_grows_a_hundred_trees_a_fold(spark, sf, table, monkeypatch):
    models, seen = _trees_asked(table, monkeypatch)
    assert models.ml_cross_validate(spark, sf).count() == 5 and seen == [100] * 5


def test_the_boosted_model_has_two_hundred_rounds(spark, sf, table, monkeypatch):
    models, seen = _trees_asked(table, monkeypatch)
    assert models.ml_boosted_trees(spark, sf).count() == 1 and seen == [200]
