
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import numpy as np  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracles  # noqa: E402
from tidewatch.functions.columns import (alert_risk, blend, response_risk, rounded)  # noqa: E402
from tidewatch.operators.ordered import exact_quantiles  # noqa: E402
from tidewatch.plans import alerts, explore, metrics, portal, rules, store, trading  # noqa: E402
from tidewatch.models import blended, density  # noqa: E402
from tidewatch.models.autoencoder import AutoencoderDetector, AutoencoderModel, Network, layer_sizes  # noqa: E402
from tidewatch.models.baseline import BaselineDetector, explained  # noqa: E402
from tidewatch.models.scaling import RobustScale  # noqa: E402
from tidewatch.schemas import KEY, LABEL, QUICK_PORTAL, QUICK_TRADE, STORE_FEATURES  # noqa: E402
from tidewatch.session import cut_lineage, shared_path  # noqa: E402
from tidewatch.sources import envelope, lookup  # noqa: E402
from tidewatch.sources.bridge import portal_columns, portal_view, trade_columns, trade_view  # noqa: E402
from tidewatch.streaming import buffers, scoring  # noqa: E402

try:  # the llm operators can be removed as a whole
    from tidewatch.llm import queries as llm_queries  # noqa: E402
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("tidewatch.llm", "corpus_pipeline")):
        raise
    llm_queries = None

AS_OF = datetime(2024, 7, 1)
# The driver's events are too sparse for the 60-minute and 4-hour frames to fire.
WINDOWS = {"burst_minutes": 24 * 60, "kyc_hours": 24}


def _portal_features(spark, d) -> DataFrame:
    return portal.portal_features(portal_view(spark, d), **WINDOWS)


def _trades(spark, d) -> DataFrame:
    """The trade view joined once and laid out by user, for queries that read it several times.

    Features and rules read all of a trade but its direction, closing time and kind of anomaly.
    """
    return cut_lineage(trade_view(spark, d, by_user=True).drop("direction", "close_ts", "anomaly_type"), "trades")


def _trading_features(spark, d, trades: DataFrame | None = None) -> DataFrame:
    return trading.trading_features(_trades(spark, d) if trades is None else trades)


def _store(spark, d, trades: DataFrame | None = None) -> DataFrame:
    return store.feature_store(_portal_features(spark, d), _trading_features(spark, d, trades))


def _imputed(spark, d) -> DataFrame:
    full = store.imputed(_store(spark, d))
    return full.select(KEY, LABEL, *[rounded(F.col(c), 6).alias(c) for c in STORE_FEATURES])


def _scored(spark, d, trades: DataFrame | None = None) -> DataFrame:
    return _stand_ins(_store(spark, d, trades))


def _stand_ins(full: DataFrame) -> DataFrame:
    """Stand-in scores taken from the store, so that an oracle exists for what follows them."""
    return full.select(
        KEY, LABEL, F.col("t_win_rate").alias("if_score"),
        F.col("t_pct_sub_minute_trades").alias("lof_score"),
        rounded(blend(F.col("t_win_rate"), F.col("t_pct_sub_minute_trades")), 4).alias("ensemble_score"),
        F.coalesce("p_pct_night_logins", F.lit(0.0)).alias("lstm_score"))


def _ip_burst(spark, d) -> DataFrame:
    return portal.login_bursts(portal_view(spark, d), WINDOWS["burst_minutes"]).distinct()


def _kyc_window(spark, d) -> DataFrame:
    return (portal.kyc_before_withdrawals(portal_view(spark, d), WINDOWS["kyc_hours"])
            .select(KEY, "at_us", "n", F.col("payload.amount").alias("amount")))


def _login_gaps(spark, d) -> DataFrame:
    return (portal_view(spark, d).where(portal.login()).groupBy(KEY)
            .agg(rounded(portal.base_aggregates()["inter_login_min"], 2).alias("inter_login_min")))


def _rolling(spark, d) -> DataFrame:
    recent = F.col("recent")
    return (portal.recent_days(portal_view(spark, d), "timestamp", "event_id", ["event_type"]).groupBy(KEY).agg(
        F.count_if(recent & portal.login()).alias("rolling_7d_logins"),
        F.count_if(recent & portal.deposit()).alias("rolling_7d_deposits"),
        F.count_if(recent & portal.withdrawal()).alias("rolling_7d_withdrawals")))


def _diversity(spark, d) -> DataFrame:
    return portal.diversity(portal_view(spark, d)).withColumn("ip_entropy", rounded(F.col("ip_entropy"), 4))


def _mix(spark, d) -> DataFrame:
    return (trading.instrument_mix(trade_view(spark, d))
            .withColumns({c: rounded(F.col(c), 4) for c in
                          ("top_instrument_concentration", "instrument_entropy")}))


def _daily(spark, d) -> DataFrame:
    return rules.daily_trades(trade_view(spark, d)).withColumn("mean_daily", rounded(F.col("mean_daily"), 6))


def _portal_rules(spark, d) -> DataFrame:
    stats = rules.portal_rule_stats(portal_view(spark, d), **WINDOWS)
    return stats.select(KEY, "portal_event_count", *[c.alias(n) for n, c in rules.portal_findings(**WINDOWS).items()])


def _trading_rules(spark, d) -> DataFrame:
    stats = rules.trading_rule_stats(_trades(spark, d))
    return stats.select(KEY, "trading_event_count", *[c.alias(n) for n, c in rules.trading_findings().items()])


def _alerts(spark, d) -> DataFrame:
    trades = _trades(spark, d)
    return alerts.alerts_from_scores(_scored(spark, d, trades), portal_view(spark, d), trades,
                                     AS_OF, threshold=0.30, **WINDOWS)


def _alert_rules(spark, d) -> DataFrame:
    return _alerts(spark, d).withColumn("findings", F.array_join("findings", " | ")).drop("top_features")


def _alerts_top(spark, d) -> DataFrame:
    return (alerts.top_alerts(_alerts(spark, d), 50, "medium")
            .select(KEY, "risk_level", "final_score", "summary"))


def _alerts_by_user(spark, d) -> DataFrame:
    """The user's own events are all that is read on, written once: features, scores and rules are per user."""
    events, trades = (cut_lineage(view(spark, d).where(F.col(KEY) == 42), "own") for view in (portal_view, trade_view))
    scores = _stand_ins(store.feature_store(portal.portal_features(events, **WINDOWS), trading.trading_features(trades)))
    raised = alerts.alerts_from_scores(scores, events, trades, AS_OF, threshold=0.30, **WINDOWS)
    return (alerts.alerts_of_user(raised, 42)
            .select(KEY, "alert_id", "risk_level", F.array_join("findings", " | ").alias("findings")))


def _blend(spark, d) -> DataFrame:
    final = rounded(blend(F.col("ensemble_score"), F.col("lstm_score")), 4)
    return _scored(spark, d).select(KEY, "ensemble_score", final.alias("final_score"),
                                    (final >= 0.5).alias("is_anomalous"))


def _risk_levels(spark, d) -> DataFrame:
    score = F.col("ensemble_score")
    return (_scored(spark, d)
            .groupBy(alert_risk(score).alias("alert_level"), response_risk(score).alias("response_level"))
            .agg(F.count("*").alias("n")))


def _wanted(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias(KEY))


def _hits(spark, d) -> DataFrame:
    return lookup.hits(_store(spark, d), _wanted(spark, d)).select(KEY, "t_total_trades", LABEL)


def _misses(spark, d) -> DataFrame:
    return lookup.misses(_portal_features(spark, d), _wanted(spark, d))


def _envelope(spark, d) -> DataFrame:
    rows = envelope.event_envelope(portal_view(spark, d), trade_view(spark, d))
    back = envelope.decoded(rows)
    return back.select("topic", "key", "source",
                       F.coalesce("portal.event_id", "trade.trade_id").alias("id"),
                       F.unix_micros(F.coalesce("portal.timestamp", "trade.open_ts")).alias("at_us"))


def _stream_users(spark, d) -> DataFrame:
    return portal_view(spark, d).select(KEY).union(trade_view(spark, d).select(KEY)).distinct()


def _value_counts(spark, d) -> DataFrame:
    return explore.value_counts(portal_view(spark, d), "event_type")


def _anomaly_types(spark, d) -> DataFrame:
    both = [view(spark, d).select("anomaly_type", "anomaly_flag") for view in (portal_view, trade_view)]
    return explore.value_counts(both[0].unionByName(both[1]), "anomaly_type", F.col("anomaly_flag"))


def _event_summary(spark, d) -> DataFrame:
    return (explore.event_summary(portal_view(spark, d))
            .withColumn("anomaly_rate", rounded(F.col("anomaly_rate"), 6)))


def _histograms(spark, d) -> DataFrame:
    return explore.histograms(cut_lineage(_store(spark, d), "store"), oracles.HIST_FEATURES)


def _doc_series(spark, d) -> DataFrame:
    docs = (spark.read.parquet(f"{d}/labels.parquet")
            .join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "n_chars"), "doc_id")
            .withColumn("shortness", -F.col("n_chars")))
    return metrics.long_scores(docs, [("long", "n_chars", F.col("n_chars") >= 500),
                                      ("short", "shortness", F.col("n_chars") < 100)], F.col("toxic"))


def _rounded_metrics(df: DataFrame) -> DataFrame:
    return df.select("model", *[rounded(F.col(c), 6).alias(c)
                                for c in ("auc", "ap", "precision", "recall", "f1")])


def _binary_metrics(spark, d) -> DataFrame:
    return _rounded_metrics(metrics.binary_metrics(_doc_series(spark, d)))


def _roc(spark, d) -> DataFrame:
    return metrics.roc_points(_doc_series(spark, d)).select(
        "model", rounded(F.col("fpr"), 6).alias("fpr"), rounded(F.col("tpr"), 6).alias("tpr"))


def _model_comparison(spark, d) -> DataFrame:
    series = metrics.long_scores(cut_lineage(_scored(spark, d), "scored"), [
        (name, score, F.col(score) >= 0.5) for name, score in (
            ("Isolation Forest", "if_score"), ("LOF", "lof_score"),
            ("IF+LOF Ensemble", "ensemble_score"), ("MLP Autoencoder", "lstm_score"))], F.col(LABEL))
    return _rounded_metrics(metrics.binary_metrics(series))


# Models are fitted once per session and folder, and used by all queries that score.
_FITTED: dict = {}


def _fitted(spark, d, what: str):
    key = (spark.sparkContext.applicationId, d, what)
    if key not in _FITTED:
        if what == "store":
            _FITTED[key] = cut_lineage(_store(spark, d), "store")
        elif what == "baseline":
            _FITTED[key] = BaselineDetector().fit(_fitted(spark, d, "store"))
        else:
            _FITTED[key] = AutoencoderDetector().fit(_fitted(spark, d, "store"))
    return _FITTED[key]


def _robust_scaled(spark, d) -> DataFrame:
    full = store.imputed(_store(spark, d), "zero")
    full = cut_lineage(full, "store")
    scale = RobustScale.fit(full, STORE_FEATURES, stored=True)
    return full.select(KEY, *[rounded(c, 6).alias(n) for n, c in zip(STORE_FEATURES, scale.columns())])


def _embeddings(spark, d) -> DataFrame:
    return spark.read.parquet(f"{d}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), "label")


def _lof(spark, d) -> DataFrame:
    factors = density.outlier_factors(_embeddings(spark, d), 64)
    return factors.select(F.col("id").alias("vec_id"), rounded(F.col("lof"), 6).alias("lof"),
                          (F.col("lof") > 1.5).alias("is_outlier"))


def _nn_lof(spark, d) -> DataFrame:
    """Every vector, moved a little, takes the factor of its nearest neighbour among all vectors."""
    vectors = _embeddings(spark, d)
    points = cut_lineage(density.outlier_factors(vectors, 64), "lof")
    moved = vectors.select("id", F.transform("x", lambda v: v * 0.75 + 0.125).alias("x"))
    return (density.adopt_factors(moved, points, 64)
            .select(F.col("id").alias("vec_id"), rounded(F.col("lof"), 6).alias("lof")))


def _iforest(spark, d) -> DataFrame:
    return _fitted(spark, d, "baseline").transform(_fitted(spark, d, "store"))


def _importance(spark, d) -> DataFrame:
    model, full = _fitted(spark, d, "baseline"), _fitted(spark, d, "store")
    names = F.array(*[F.lit(c) for c in model.params_.scale.features])
    vectors = cut_lineage(full.select(F.col(KEY).alias("id"), model.params_.scale.vector().alias("x")), "scaled")
    return (model.forest.importance(vectors).orderBy(F.desc("importance"), "feature").limit(15)
            .select(F.element_at(names, F.col("feature") + 1).alias("feature"), "importance"))


def _ae_scores(spark, d) -> DataFrame:
    return _fitted(spark, d, "autoencoder").transform(_fitted(spark, d, "store"))


def _ae_forward(spark, d) -> DataFrame:
    """The autoencoder's scores with weights from a formula that SQL can repeat."""
    full = _fitted(spark, d, "store")
    scale = RobustScale.fit(full.na.fill(0.0, STORE_FEATURES), STORE_FEATURES)
    sizes = layer_sizes(len(STORE_FEATURES))
    weights = [np.array([[((i * 7 + j * 13 + layer * 5) % 17 - 8) / 40.0 for j in range(b)] for i in range(a)])
               for layer, (a, b) in enumerate(zip(sizes, sizes[1:]))]
    network = Network(weights, [np.array([(j % 5 - 2) * 0.01 for j in range(b)]) for b in sizes[1:]])
    errors = full.where(~F.col(LABEL)).select(scale.vector().alias("x")).select(network.errors().alias("e")).select(
        (F.aggregate("e", F.lit(0.0), lambda a, v: a + v) / sizes[0]).alias("error"))
    threshold = exact_quantiles(errors, ["error"], [0.5])["error"][0]
    return (AutoencoderModel(scale, network, threshold).transform(full).drop(LABEL)
            .withColumn("lstm_top_features", F.array_join("lstm_top_features", "|")))


def _score_users(spark, d) -> DataFrame:
    wanted = _wanted(spark, d)
    scores = blended.blended_scores(lookup.hits(_fitted(spark, d, "store"), wanted),
                                    _fitted(spark, d, "baseline"), _fitted(spark, d, "autoencoder"))
    return blended.with_findings(scores, portal_view(spark, d), trade_view(spark, d), AS_OF, **WINDOWS)


def _score_maps(spark, d) -> DataFrame:
    pairs = F.create_map(*[x for c in ("t_total_trades", "t_win_rate", "t_pnl_volatility", "p_unique_ips")
                           for x in (F.lit(c), F.coalesce(c, F.lit(0.0)))])
    maps = _fitted(spark, d, "store").select(KEY, pairs.alias("features"))
    return blended.score_maps(maps, _fitted(spark, d, "baseline"), _fitted(spark, d, "autoencoder"))


def _explain(spark, d) -> DataFrame:
    """The five features furthest from their mean, in standard deviations, per user."""
    full = _fitted(spark, d, "store").na.fill(0.0, STORE_FEATURES)
    names = STORE_FEATURES
    stats = full.agg(*[a for c in names for a in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    top = explained([F.col(c) for c in names], names, [stats[f"m_{c}"] for c in names],
                    [stats[f"s_{c}"] + 1e-9 for c in names])
    return full.select(KEY, F.array_join(top, "|").alias("top_features"))


def _stream(spark, d) -> DataFrame:
    """The tables as an event stream of bus records."""
    def read(name: str) -> DataFrame:
        schema = spark.read.parquet(f"{d}/{name}.parquet").schema
        return spark.readStream.schema(schema).parquet(f"{d}/{name[:-1]}[{name[-1]}].parquet")

    trades = trade_columns(read("lineitem"), spark.read.parquet(f"{d}/orders.parquet"),
                           spark.read.parquet(f"{d}/part.parquet"))
    return envelope.event_envelope(portal_columns(read("events")), trades)


def _stream_features(spark, d) -> DataFrame:
    out = shared_path(spark, "stream-features")

    def each(batch, batch_id):
        features = scoring.quick_features(*scoring.buffered_events(cut_lineage(batch, "buffers")))
        features.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    scoring.run_to_end(buffers.user_buffers(_stream(spark, d)), each, shared_path(spark, "ckpt"))
    last = F.max_by(F.struct(*STORE_FEATURES), "batch_id")
    known = [f"p_{c}" for c in QUICK_PORTAL] + [f"t_{c}" for c in QUICK_TRADE]
    return (spark.read.parquet(out).groupBy(KEY).agg(last.alias("f"))
            .select(KEY, *[rounded(F.col(f"f.{c}"), 6).alias(c) for c in known]))


def _stream_alerts(spark, d) -> DataFrame:
    out = shared_path(spark, "stream-alerts")
    scorer = scoring.StreamScorer(_fitted(spark, d, "baseline"), _fitted(spark, d, "autoencoder"), out,
                                  as_of=AS_OF, rule_windows=WINDOWS)
    scoring.run_to_end(buffers.user_buffers(_stream(spark, d), every=10), scorer, shared_path(spark, "ckpt"))
    return scoring.read_alerts(spark, out)


def entry(spark: SparkSession) -> DataFrame:
    """Per-user risk features of both sources on the smallest tables."""
    return _store(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "portal_features": _portal_features,
        "trading_features": _trading_features,
        "feature_store": _store,
        "imputed_matrix": _imputed,
        "ip_burst": _ip_burst,
        "kyc_window": _kyc_window,
        "login_gaps": _login_gaps,
        "rolling_7d": _rolling,
        "win_streak": lambda s, d: trading.win_streaks(trade_view(s, d)),
        "login_diversity": _diversity,
        "instrument_mix": _mix,
        "daily_trades": _daily,
        "portal_rules": _portal_rules,
        "trading_rules": _trading_rules,
        "alert_rules": _alert_rules,
        "alerts_top": _alerts_top,
        "alerts_by_user": _alerts_by_user,
        "blend_scores": _blend,
        "risk_levels": _risk_levels,
        "batch_lookup_hits": _hits,
        "batch_lookup_misses": _misses,
        "event_envelope": _envelope,
        "stream_users": _stream_users,
        "value_counts": _value_counts,
        "anomaly_type_counts": _anomaly_types,
        "event_summary": _event_summary,
        "histogram_bins": _histograms,
        "binary_metrics": _binary_metrics,
        "roc_points": _roc,
        "model_comparison": _model_comparison,
        "robust_scaled": _robust_scaled,
        "explain_top5": _explain,
        "lof_scores": _lof,
        "nn_lof": _nn_lof,
        "iforest_scores": _iforest,
        "permutation_importance": _importance,
        "ae_scores": _ae_scores,
        "ae_forward": _ae_forward,
        "score_users": _score_users,
        "score_feature_maps": _score_maps,
        "stream_features": _stream_features,
        "stream_alerts": _stream_alerts,
        **(llm_queries.queries() if llm_queries else {}),
    }


def oracle_sql() -> dict[str, str]:
    known = queries()
    texts = oracles.oracle_sql() | (llm_queries.oracle_sql() if llm_queries else {})
    return {name: text for name, text in texts.items() if name in known}
