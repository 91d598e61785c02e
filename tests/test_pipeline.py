import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import BASE
from tidewatch.models.autoencoder import AutoencoderDetector
from tidewatch.models.baseline import BaselineDetector
from tidewatch.plans.explore import store_summary
from tidewatch.plans.pipeline import run_pipeline
from tidewatch.schemas import ALERT_SCHEMA
from tidewatch.sources.tables import read_portal, read_store, read_trades, write_table

AS_OF = datetime(2024, 7, 1)


@pytest.fixture(scope="module")
def activity(portal, trades):
    """40 usual users and 6 with many failed logins and fast winning trades."""
    rng = np.random.default_rng(8)
    events, deals = [], []
    for u in range(46):
        odd, user = u >= 40, f"U{u:03d}"
        for i in range(25 if odd else 8):
            kind = "login" if odd else rng.choice(["login", "deposit", "withdrawal", "support_ticket"])
            events.append({"user_id": user, "event_id": f"{user}-{i}", "event_type": str(kind),
                           "timestamp": BASE + timedelta(minutes=int(rng.integers(0, 60 if odd else 90000))),
                           "ip_address": str(rng.integers(0, 30 if odd else 3)), "anomaly_flag": bool(odd),
                           "status": "failed" if odd else "success",
                           "amount": float(round(rng.gamma(2, 300), 2)) if kind in ("deposit", "withdrawal") else None})
        for i in range(30 if odd else 10):
            deals.append({"user_id": user, "trade_id": f"{user}-{i}", "instrument": "EURUSD" if odd else str(rng.integers(0, 5)),
                          "lot_size": float(round(rng.gamma(2, 1), 2)), "pnl": float(round(rng.normal(20 if odd else 0, 10), 2)),
                          "open_ts": BASE + timedelta(minutes=int(rng.integers(0, 90000))),
                          "duration_min": 0.1 if odd else float(round(rng.gamma(2, 30), 2))})
    return portal(events), trades(deals)


def test_csv_round_trip(spark, activity, tmp_path):
    for df, reader, name in ((activity[0], read_portal, "p"), (activity[1], read_trades, "t")):
        write_table(df, str(tmp_path / name), "csv")
        back = reader(spark, str(tmp_path / name))
        assert back.schema == df.schema and back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_csv_arrays_are_json(spark, tmp_path):
    write_table(spark.createDataFrame([(1, ["a", "b"])], "i int, names array<string>"), str(tmp_path / "x"), "csv")
    assert json.loads(spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "x")).first().names) == ["a", "b"]


def test_whole_pipeline(spark, activity, tmp_path):
    out = str(tmp_path)
    result = run_pipeline(*activity, out, AS_OF, baseline=BaselineDetector(trees=30), autoencoder=AutoencoderDetector(epochs=3))
    assert result.store.count() == 46 and tuple(store_summary(result.store).first()) == (46, 6)
    report = {r.model: r for r in result.report.collect()}
    assert set(report) == {"Isolation Forest", "LOF", "IF+LOF Ensemble", "MLP Autoencoder"}
    assert report["Isolation Forest"].auc > 0.95
    alerts = result.alerts
    assert alerts.columns == ALERT_SCHEMA.fieldNames()
    high = result.baseline_scores.where("ensemble_score >= 0.30")
    assert alerts.count() == high.count() and alerts.where("ae_score <> 0.0").isEmpty()
    raised = {r.user_id: r for r in alerts.collect()}
    assert {f"U{u:03d}" for u in range(40, 46)} <= set(raised)
    assert any(f.startswith("Brute force pattern: 25 ") for f in raised["U041"].findings)
    store, names = read_store(spark, f"{out}/feature_store")
    assert len(names) == 56 and store.where(F.col("p_total_logins").isNull()).isEmpty()
    runs = {r.run_name: r for r in spark.read.parquet(f"{out}/runs").collect()}
    assert runs["isolation_forest_lof_ensemble"].params["n_estimators"] == "30" and runs["mlp_autoencoder"].params["epochs"] == "3"
    assert runs["isolation_forest_lof_ensemble"].metrics["if_auc"] == report["Isolation Forest"].auc
    assert set(runs["mlp_autoencoder"].metrics) == {f"ae_{m}" for m in ("auc", "ap", "precision", "recall", "f1")}


def test_registered_queries_have_names_in_both_lists():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
