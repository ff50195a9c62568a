import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskgraph.session import build_session, release

    session = build_session("local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def make_transactions(spark):
    """Rows (account, device[, merchant, amount, timestamp text]) -> transaction table."""

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            account, device, merchant, amount, at = (*r, *("m", 10.0, "2024-01-01 10:00:00")[len(r) - 2:])
            full.append((i, f"t{i:05d}", at, float(amount), account, merchant, device, 0))
        df = spark.createDataFrame(
            full, "_seq bigint, transaction_id string, at string, amount double, account_id string,"
            " merchant_id string, device_id string, is_fraud int")
        return df.selectExpr("*", "cast(at as timestamp) as timestamp").drop("at")

    return make
