"""Features, scores and alerts of the buffered users of one micro-batch."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import finite_or_zero
from ..models.autoencoder import AutoencoderModel
from ..models.baseline import BaselineModel
from ..models.blended import ALERT_THRESHOLD, blended_scores
from ..plans import portal, trading
from ..plans.alerts import build_alerts
from ..plans.rules import portal_rule_stats, trading_rule_stats
from ..plans.store import feature_store
from ..schemas import (ALERT_TOPIC, KEY, LABEL, PORTAL_TOPIC, QUICK_PORTAL, QUICK_TRADE, STORE_FEATURES,
                       TRADE_TOPIC)
from ..session import cut_lineage
from ..sources.envelope import alert_records, decoded

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
#: Folders of the alert table inside a batch's folder; a batch reads only those of its users.
ALERT_BUCKETS = 64
BUCKET = "bucket"


def buffered_events(buffers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The buffered JSON as portal events and trades, keyed by the record key."""
    tables = []
    for column, topic, name in (("portal", PORTAL_TOPIC, "portal"), ("trades", TRADE_TOPIC, "trade")):
        rows = decoded(buffers.select(F.lit(topic).alias("topic"), F.col(KEY).alias("key"),
                                      F.explode(column).alias("value")))
        tables.append(rows.select("key", f"{name}.*").drop(KEY).withColumnRenamed("key", KEY))
    return tables[0], tables[1]


def quick_features(events: DataFrame, trades: DataFrame) -> DataFrame:
    """The features a buffer supports, unrounded; all other features are 0."""
    p, t = portal.base_aggregates(), trading.base_aggregates()
    login = portal.login()
    p = {**p, "unique_ips": F.count_distinct(F.when(login, F.col("ip_address"))),
         "unique_countries": F.count_distinct(F.when(login, F.col("country")))}
    left = events.groupBy(KEY).agg(*[finite_or_zero(p[c].cast("double")).alias(f"p_{c}") for c in QUICK_PORTAL])
    mix = trading.instrument_mix(trades).select(
        KEY, F.col("top_instrument_concentration").alias("t_top_instrument_concentration"))
    right = trades.groupBy(KEY).agg(*[finite_or_zero(t[c].cast("double")).alias(f"t_{c}")
                                      for c in QUICK_TRADE if c in t]).join(mix, KEY, "left")
    known = {f"p_{c}" for c in QUICK_PORTAL} | {f"t_{c}" for c in QUICK_TRADE}
    return (left.join(right, KEY, "full")
            .select(KEY, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) if c in known else F.lit(0.0).alias(c)
                           for c in STORE_FEATURES]))


def full_features(events: DataFrame, trades: DataFrame) -> DataFrame:
    """All 56 features from the buffered events."""
    return feature_store(portal.portal_features(events), trading.trading_features(trades)).drop(LABEL)


@dataclass
class StreamScorer:
    """What a micro-batch is scored with, and where its alerts go.

    The alert table is the memory of who was alerted: one folder per micro-batch, rewritten
    when the batch is replayed, so a restart neither repeats nor loses an alert. Inside a batch's
    folder alerts lie in ALERT_BUCKETS folders by a hash of the user; a batch reads only the buckets
    of the users it raises (partition pruning), so what it reads does not grow with the stream's length.
    """

    baseline: BaselineModel
    autoencoder: AutoencoderModel
    alert_path: str
    threshold: float = ALERT_THRESHOLD
    mode: str = "quick"
    as_of: datetime | None = None
    rule_windows: dict = field(default_factory=dict)
    publish: Callable[[DataFrame], None] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        buffers = cut_lineage(batch, "buffers")
        features = {"quick": quick_features, "full": full_features}[self.mode](*buffered_events(buffers))
        scores = blended_scores(cut_lineage(features, "stream-features"), self.baseline, self.autoencoder,
                                self.threshold)
        raised = cut_lineage(scores.where("is_alert").withColumn(BUCKET, alert_bucket()), "raised")
        earlier = earlier_alerts(spark, self.alert_path, raised, batch_id)
        if earlier is not None:
            # The batch's few users are looked up in their buckets of the alert table only.
            known = earlier.join(raised.select(KEY), KEY, "left_semi")
            raised = raised.join(known.select(KEY), KEY, "left_anti")
        raised = raised.drop(BUCKET)
        events, trades = buffered_events(buffers.join(raised.select(KEY), KEY, "left_semi"))
        alerts = build_alerts(raised.select(KEY, "final_score", "if_score", "ae_score", "top_features"),
                              portal_rule_stats(events, **self.rule_windows), trading_rule_stats(trades),
                              self.as_of or datetime.now(timezone.utc).replace(tzinfo=None), **self.rule_windows)
        target = os.path.join(self.alert_path, f"batch_id={batch_id}")
        # dealt by bucket, else each task writes a file into each of the buckets
        (alerts.withColumn(BUCKET, alert_bucket()).hint("rebalance", BUCKET)
         .write.mode("overwrite").partitionBy(BUCKET).parquet(target))
        written = _alert_memory(spark, target)  # None: the batch raised no alert (no bucket folder)
        if self.publish is not None and written is not None:
            self.publish(alert_records(written.drop(BUCKET), ALERT_TOPIC))


def alert_bucket() -> Column:
    """The folder of a user's alerts inside a batch's folder."""
    return F.pmod(F.xxhash64(F.col(KEY)), F.lit(ALERT_BUCKETS)).cast("int")


def earlier_alerts(spark: SparkSession, path: str, raised: DataFrame, batch_id: int) -> DataFrame | None:
    """Alerts of batches before `batch_id` in the buckets of the users of `raised` (which has BUCKET).

    Only those buckets' folders are listed and read, whatever the number of batches before.
    """
    table = _alert_memory(spark, path)
    if table is None:
        return None
    buckets = [r[BUCKET] for r in raised.select(BUCKET).distinct().collect()]  # at most ALERT_BUCKETS
    return table.where(F.col(BUCKET).isin(buckets) & (F.col("batch_id") < batch_id))


def _alert_memory(spark: SparkSession, path: str) -> DataFrame | None:
    """The alert table with batch_id and bucket as partition columns, or None before the first batch."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def read_alerts(spark: SparkSession, path: str) -> DataFrame | None:
    """The alert table with its batch_id, or None before the first batch."""
    table = _alert_memory(spark, path)
    return None if table is None else table.drop(BUCKET)


def first_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    """The first `limit` alerts of a finished run, in order of batch and score."""
    return alerts.orderBy("batch_id", F.col("final_score").desc(), KEY).limit(limit)


def run_to_end(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "update") -> None:
    """Process all that is available now in micro-batches, then stop."""
    spark = stream.sparkSession
    spark.conf.set(PROVIDER_CONF, ROCKSDB)
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .foreachBatch(on_batch).trigger(availableNow=True).start())
    query.awaitTermination()


def publish_to(format: str, **options: str) -> Callable[[DataFrame], None]:
    """A sink for alert records: format 'kafka' with its servers, or a file format with a path."""

    def write(records: DataFrame) -> None:
        records.write.format(format).mode("append").options(**options).save()

    return write
