"""The batch pipeline: events to features, models, scores, alerts and the comparison report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models.autoencoder import AutoencoderDetector, AutoencoderModel, layer_sizes
from ..models.baseline import BaselineDetector, BaselineModel
from ..schemas import KEY, LABEL, STORE_FEATURES
from ..session import clustered
from ..sources.tables import write_table
from . import metrics
from .alerts import alerts_from_scores
from .portal import portal_features
from .store import feature_store
from .trading import trading_features

PIPELINE_THRESHOLD = 0.30


@dataclass
class PipelineResult:
    store: DataFrame
    baseline_scores: DataFrame
    ae_scores: DataFrame
    alerts: DataFrame
    report: DataFrame
    baseline: BaselineModel
    autoencoder: AutoencoderModel


def run_pipeline(events: DataFrame, trades: DataFrame, out: str, as_of: datetime,
                 threshold: float = PIPELINE_THRESHOLD, baseline: BaselineDetector | None = None,
                 autoencoder: AutoencoderDetector | None = None, **rule_windows: int) -> PipelineResult:
    """Every stage that is read more than once is written under `out` and read back.

    The events are first laid out by user: seven feature and rule branches read each source.
    """
    spark = events.sparkSession
    events, trades = clustered(events, KEY, "events"), clustered(trades, KEY, "trades")

    def stored(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    p = stored(portal_features(events, **rule_windows), "portal_features")
    t = stored(trading_features(trades), "trading_features")
    store = stored(feature_store(p, t), "feature_store")
    baseline, autoencoder = baseline or BaselineDetector(), autoencoder or AutoencoderDetector()
    b_model = baseline.fit(store)
    b = stored(b_model.transform(store), "baseline_scores")
    b_model.save(f"{out}/models/baseline")
    a_model = autoencoder.fit(store)
    a = stored(a_model.transform(store), "ae_scores")
    a_model.save(f"{out}/models/autoencoder")
    alerts = stored(alerts_from_scores(b, events, trades, as_of, threshold, **rule_windows), "alerts")
    report = stored(metrics.model_comparison(b, a), "report")
    record_runs(b, a, f"{out}/runs", as_of, baseline, autoencoder)
    return PipelineResult(store, b, a, alerts, report, b_model, a_model)


def record_runs(baseline_scores: DataFrame, ae_scores: DataFrame, path: str, as_of: datetime,
                baseline: BaselineDetector, autoencoder: AutoencoderDetector, **more: object) -> None:
    """One row per training run with the parameters it was made with (and `more`) and its metrics, appended to the runs table."""
    width = len(STORE_FEATURES)
    label = F.col(LABEL)
    base = metrics.long_scores(baseline_scores, [
        ("if", "if_score", F.col("if_anomaly") == -1), ("lof", "lof_score", F.col("lof_anomaly") == -1),
        ("ens", "ensemble_score", F.col("if_anomaly") == -1)], label)
    auto = metrics.long_scores(ae_scores, [("ae", "lstm_score", F.col("lstm_anomaly") == 1)], label)
    for series, name, params in (
            (base, "isolation_forest_lof_ensemble",
             {"model_type": "IsolationForest+LOF", "contamination": baseline.getOrDefault("contamination"), "n_estimators": baseline.getOrDefault("trees"),
              "lof_n_neighbors": baseline.getOrDefault("neighbors")}),
            (auto, "mlp_autoencoder", {"model_type": "MLPAutoencoder", "hidden_dim": layer_sizes(width)[1],
                                       "latent_dim": layer_sizes(width)[2], "epochs": autoencoder.getOrDefault("epochs")})):
        write_table(metrics.run_record(metrics.binary_metrics(series), name, params | more, as_of), path, mode="append")
