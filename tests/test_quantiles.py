"""Quantiles with NaN, infinities, equal and neighbouring doubles: both ways end and agree."""

import math

import pytest

from riskgraph.functions.order import exact_quantiles
from riskgraph.operators.clean import fill_medians, positive_amounts

INF = float("inf")
STEP = math.ulp(1.0)


@pytest.mark.parametrize("values", [
    [1.0, float("nan"), 3.0, None, 2.0],
    [1.0, INF, 2.0, -INF, 5.0, 7.0, 7.0],
    [1.0 + i * STEP for i in range(9)],
    [5e-324, 1e-323, 0.0],
    [-1.7e308, 1.7e308, 0.0, 3.0],
    [4.0] * 6,
    [INF, INF],
])
def test_both_ways_agree(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    narrow = exact_quantiles(df, {"v": probs}, built_in_limit=0)["v"]
    real = sorted(v for v in values if v is not None and not math.isnan(v))
    for p, got in zip(probs, narrow):
        at = p * (len(real) - 1)
        low, high, share = real[int(at)], real[min(int(at) + 1, len(real) - 1)], at - int(at)
        want = low if share == 0 or low == high else low * (1 - share) + high * share
        assert got == want or got == pytest.approx(want, rel=1e-12) or math.isnan(got) and math.isnan(want)
    if all(abs(v) < 1e300 for v in real):
        assert exact_quantiles(df, {"v": probs})["v"] == pytest.approx(narrow, rel=1e-12)


def test_nan_amounts_from_a_file_are_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("_seq,amount\n1,1\n2,NaN\n3,3\n4,\n5,-2\n6,8\n")
    df = spark.read.schema("_seq long, amount double").csv(str(tmp_path / "a.csv"), header=True)
    got = sorted(r["amount"] for r in positive_amounts(fill_medians(df)).collect())
    assert got == [1.0, 2.0, 2.0, 3.0, 8.0]
    assert positive_amounts(df).count() == 3
