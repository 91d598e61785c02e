import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch.schemas import portal_schema, trade_schema  # noqa: E402
from tidewatch.session import build_session  # noqa: E402

BASE = datetime(2024, 3, 1, 10, 0)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "3", "spark.driver.memory": "6g", "spark.sql.codegen.wholeStage": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def portal(spark):
    """Portal events from dicts; what a row leaves out gets a default."""
    def make(rows):
        default = {"user_id": "U1", "event_type": "login", "timestamp": BASE, "ip_address": "1.1.1.1",
                   "device_id": "dev-1", "country": "IN", "amount": None, "status": "success",
                   "anomaly_flag": False, "anomaly_type": None}
        full = [{"event_id": f"e{i:05d}", **default, **r} for i, r in enumerate(rows)]
        schema = portal_schema()
        return spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in full], schema)
    return make


@pytest.fixture(scope="session")
def trades(spark):
    def make(rows):
        default = {"user_id": "U1", "instrument": "EURUSD", "direction": "buy", "lot_size": 1.0, "open_ts": BASE,
                   "close_ts": BASE + timedelta(minutes=5), "duration_min": 5.0, "pnl": 1.0, "margin_used": 10.0,
                   "anomaly_flag": False, "anomaly_type": None}
        full = [{"trade_id": f"t{i:05d}", **default, **r} for i, r in enumerate(rows)]
        schema = trade_schema()
        return spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in full], schema)
    return make


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]
