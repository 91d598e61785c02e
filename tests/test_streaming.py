from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import BASE
from tidewatch.plans.portal import portal_features
from tidewatch.plans.trading import trading_features
from tidewatch.schemas import PORTAL_TOPIC, ROW, STORE_FEATURES, TRADE_TOPIC
from tidewatch.session import cut_lineage
from tidewatch.sources.envelope import alert_records, decoded, event_envelope
from tidewatch.streaming.buffers import UserBuffers, keyed_records, trimmed, user_buffers
from tidewatch.streaming.scoring import (ALERT_BUCKETS, BUCKET, StreamScorer, alert_bucket, buffered_events,
                                         earlier_alerts, first_alerts, publish_to, quick_features, read_alerts,
                                         run_to_end)

RECORDS = "topic string, key string, value string"


class FixedScore:
    """Stands in for both models: the score is the number of failed logins / 10.

    Like every detector it hands on the row number column of its input (ROW), by which scores are joined.
    """

    def transform(self, df):
        score = F.least(F.lit(1.0), F.col("p_failed_login_ratio") * F.col("p_total_logins") / 10)
        names = F.array(F.lit("p_total_logins"))
        return df.select("user_id", *[c for c in [ROW] if c in df.columns], score.alias("ensemble_score"),
                         score.alias("lstm_score"),
                         names.alias("top_features"), names.alias("lstm_top_features"))


def stream_of(spark, folder, parts):
    """A file stream with one micro-batch per part."""
    for i, part in enumerate(parts):
        path = str(folder / "in")
        part.coalesce(1).write.mode("append").parquet(path)
    return (spark.readStream.schema(RECORDS).option("maxFilesPerTrigger", 1).parquet(str(folder / "in")))


def logins(user, n, status="failed", start=0):
    return [{"user_id": user, "event_id": f"{user}{start + i:05d}", "status": status,
             "timestamp": BASE + timedelta(minutes=start + i), "ip_address": str((start + i) % 5)} for i in range(n)]


def test_envelope_round_trip(spark, portal, trades):
    p, t = portal([{"amount": 3.5}, {"user_id": None}]), trades([{"user_id": "U2"}])
    rows = event_envelope(p, t, ordered=True)
    assert rows.columns == ["topic", "key", "value"] and rows.count() == 3
    got = {r.key: r for r in decoded(rows).collect()}
    assert set(got) == {"U1", "U2"} and got["U1"].source == "portal" and got["U2"].source == "trading"
    assert got["U1"].portal.asDict() == p.first().asDict() and got["U1"].trade is None
    assert got["U2"].trade.asDict() == t.first().asDict()


def test_nan_tokens_become_null(spark):
    value = '{"event_id":"e","event_type":"login","amount":NaN,"ip_address":NaN,"timestamp":"2024-03-01 10:00:00"}'
    row = decoded(spark.createDataFrame([(PORTAL_TOPIC, "U1", value)], RECORDS)).first()
    assert row.portal.amount is None and row.portal.ip_address is None and row.portal.timestamp == BASE


def test_trimming_keeps_the_count(spark, portal, trades):
    rows = keyed_records(event_envelope(portal(logins("H", 450) + logins("a", 3)), trades([{"user_id": "H"}])))
    out = trimmed(rows.coalesce(1), 200).groupBy("key", "source").agg(
        F.count("*").alias("n"), F.sum("weight").alias("w"), F.min("id").alias("first")).collect()
    got = {(r.key, r.source): (r.n, r.w, r.first) for r in out}
    assert got == {("H", "portal"): (200, 450, "H00250"), ("a", "portal"): (3, 3, "a00000"),
                   ("H", "trading"): (1, 1, "t00000")}


def test_batches_without_a_long_buffer_are_handed_on(spark, portal, trades):
    """Sorting and grouping in pandas is left to the batches in which some user has too many events."""
    rows = keyed_records(event_envelope(portal(logins("H", 150) + logins("a", 60)), trades([{"user_id": "H"}])))
    plan = trimmed(rows, 200)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
    as_rows = lambda df: sorted(tuple(r) for r in df.select(*rows.columns).collect())
    assert as_rows(trimmed(rows.coalesce(1), 200)) == as_rows(rows)
    cut = trimmed(rows.coalesce(1), 100)
    assert {(r.key, r.source): (r.n, r.w) for r in cut.groupBy("key", "source").agg(
        F.count("*").alias("n"), F.sum("weight").alias("w")).collect()} == {
            ("H", "portal"): (100, 150), ("a", "portal"): (60, 60), ("H", "trading"): (1, 1)}


def test_buffers_over_micro_batches(spark, portal, trades, tmp_path):
    deals = trades([{"user_id": "H", "pnl": float(i), "open_ts": BASE + timedelta(hours=i)} for i in range(4)])
    parts = [event_envelope(portal(logins("H", 150)), deals),
             event_envelope(portal(logins("H", 51, start=150) + logins("b", 7)), deals.limit(0)),
             event_envelope(portal(logins("b", 2, start=7)), deals.limit(0))]
    seen = []

    def each(batch, batch_id):
        seen.append({r.user_id: r for r in batch.collect()})

    run_to_end(user_buffers(stream_of(spark, tmp_path, parts), every=10), each, str(tmp_path / "ckpt"))
    got = [{u: (r.seen, len(r.portal), len(r.trades)) for u, r in s.items()} for s in seen if s]
    assert got == [{"H": (154, 150, 4)}, {"H": (205, 200, 4)}]
    assert '"H00001"' in seen[1]["H"].portal[0] and '"H00200"' in seen[1]["H"].portal[-1]


def test_a_users_state_is_read_and_written_once_a_batch():
    calls, held = [], {}

    class Value:
        def exists(self):
            calls.append("exists")
            return bool(held)

        def get(self):
            calls.append("get")
            return held.get("v")

        def update(self, value):
            calls.append("update")
            held["v"] = value

    class Handle:
        def getValueState(self, name, schema):
            return Value()

    users = UserBuffers(rows=3, every=4)
    users.init(Handle())

    def event(source, at, id_, weight=1):
        return Row(key="u", source=source, value=f"{source}-{id_}", at_us=at, id=id_, weight=weight)

    first = [event("portal", 5, "b"), event("portal", 5, "a"), event("trading", 1, "t", 2)]
    assert [r.asDict() for r in users.handleInputRows(("u",), iter(first), None)] == [
        {"user_id": "u", "seen": 4, "portal": ["portal-a", "portal-b"], "trades": ["trading-t"]}]
    assert list(users.handleInputRows(("u",), iter([event("portal", 2, "c"), event("portal", 1, "d")]), None)) == []
    assert calls == ["get", "update"] * 2 and held["v"] == (6, ["portal-b", "portal-d", "portal-c"], ["trading-t"])


def test_alerts_of_a_batch_are_dealt_by_bucket(spark, portal, trades, tmp_path):
    """One file a bucket, not one for each task that holds a user of it."""
    events = portal([e for u in range(40) for e in logins(f"u{u}", 9)])
    buffers = event_envelope(events, trades([{}]).limit(0)).groupBy(F.col("key").alias("user_id")).agg(
        F.collect_list("value").alias("portal")).select("user_id", F.lit(9).cast("bigint").alias("seen"), "portal",
                                                        F.array().cast("array<string>").alias("trades"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        StreamScorer(FixedScore(), FixedScore(), str(tmp_path / "alerts"), as_of=datetime(2024, 7, 1))(buffers, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert read_alerts(spark, str(tmp_path / "alerts")).count() == 40
    folders = list((tmp_path / "alerts" / "batch_id=0").glob(f"{BUCKET}=*"))
    assert folders and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)


def test_quick_features_equal_batch_features(spark, portal, trades):
    p = portal(logins("a", 9) + logins("b", 4, "success", 900) + [
        {"user_id": "b", "event_type": "deposit", "amount": 100.0}, {"user_id": "b", "event_type": "withdrawal", "amount": 50.0}])
    t = trades([{"user_id": "b", "pnl": 1.0}, {"user_id": "b", "pnl": -2.0, "instrument": "XAUUSD"}, {"user_id": "c"}])
    buffers = decoded(event_envelope(p, t))  # decoded once to drop nothing: same rows as the buffers hold
    assert buffers.count() == p.count() + t.count()
    raw = event_envelope(p, t).groupBy(F.col("key").alias("user_id")).agg(
        F.collect_list(F.when(F.col("topic") == PORTAL_TOPIC, F.col("value"))).alias("portal"),
        F.collect_list(F.when(F.col("topic") == TRADE_TOPIC, F.col("value"))).alias("trades"))
    quick = quick_features(*buffered_events(raw))
    assert quick.columns == ["user_id", *STORE_FEATURES]
    got = {r.user_id: r for r in quick.collect()}
    for r in portal_features(p).collect():
        for c in ("total_logins", "failed_login_ratio", "unique_ips", "deposit_withdraw_ratio", "kyc_change_count"):
            assert got[r.user_id][f"p_{c}"] == pytest.approx(r[c], abs=1e-4)
    for r in trading_features(t).collect():
        for c in ("total_trades", "pnl_volatility", "top_instrument_concentration", "win_rate"):
            assert got[r.user_id][f"t_{c}"] == pytest.approx(r[c], abs=1e-4)
    assert got["c"].t_pnl_volatility == 0.0 and got["a"].t_total_trades == 0.0 and got["a"].p_total_deposits == 0.0


def test_alerts_once_per_user(spark, portal, trades, tmp_path):
    none = trades([{}]).limit(0)
    parts = [event_envelope(portal(logins("a", 9) + logins("b", 3)), none),
             event_envelope(portal(logins("a", 5, start=9) + logins("b", 4, start=3)), none),
             event_envelope(portal(logins("c", 8)), none)]
    out, bus = str(tmp_path / "alerts"), str(tmp_path / "bus")
    scorer = StreamScorer(FixedScore(), FixedScore(), out, as_of=datetime(2024, 7, 1),
                          publish=publish_to("parquet", path=bus))
    run_to_end(user_buffers(stream_of(spark, tmp_path, parts)), scorer, str(tmp_path / "ckpt"))
    rows = {r.user_id: r for r in read_alerts(spark, out).collect()}
    assert read_alerts(spark, out).count() == 3 and set(rows) == {"a", "b", "c"}
    assert [rows[u].batch_id for u in "abc"] == [0, 1, 2]
    assert rows["a"].final_score == 0.9 and rows["a"].risk_level == "CRITICAL" and rows["a"].portal_event_count == 9
    assert rows["b"].portal_event_count == 7 and "Brute force pattern: 7" in " ".join(rows["b"].findings)
    assert [r.user_id for r in first_alerts(read_alerts(spark, out), 2).collect()] == ["a", "b"]
    records = spark.read.parquet(bus)
    assert records.columns == ["topic", "key", "value"] and records.count() == 3
    # A replayed batch rewrites its own alerts and raises no second one.
    replay = cut_lineage(spark.createDataFrame(
        [("c", 8, [r.value for r in event_envelope(portal(logins("c", 8)), none).collect()], [])],
        "user_id string, seen long, portal array<string>, trades array<string>"))
    scorer(replay, 2)
    scorer(replay, 3)
    assert read_alerts(spark, out).count() == 3


def test_full_mode_uses_all_features(spark, portal, trades, tmp_path):
    seen = {}

    class Recorder(FixedScore):
        def transform(self, df):
            seen.update({r.user_id: r for r in df.collect()})
            return super().transform(df)

    values = [r.value for r in event_envelope(portal(logins("a", 6)), trades([{}]).limit(0)).collect()]
    batch = spark.createDataFrame([("a", 6, values, [])],
                                  "user_id string, seen long, portal array<string>, trades array<string>")
    StreamScorer(Recorder(), Recorder(), str(tmp_path / "alerts"), mode="full")(batch, 0)
    assert seen["a"].p_max_ips_in_1h == 5.0 and seen["a"].p_rolling_7d_logins == 6.0


def test_alert_records(spark):
    alerts = spark.createDataFrame([("ALT-1", "U1", ["x"])], "alert_id string, user_id string, findings array<string>")
    row = alert_records(alerts, "out").first()
    assert (row.topic, row.key, row.value) == ("out", "U1", '{"alert_id":"ALT-1","user_id":"U1","findings":["x"]}')


def test_alert_memory_reads_only_the_raised_users_buckets(spark, tmp_path):
    """Over 20 batches of 200 alerted users each, a batch that raises one user reads one bucket."""
    path = str(tmp_path / "alerts")
    for batch in range(20):
        users = spark.createDataFrame([(f"u{batch}-{i}", 0.9) for i in range(200)], "user_id string, final_score double")
        users.withColumn(BUCKET, alert_bucket()).write.partitionBy(BUCKET).parquet(f"{path}/batch_id={batch}")
    raised = spark.createDataFrame([("u3-7", 0.8)], "user_id string, final_score double").withColumn(BUCKET, alert_bucket())
    bucket = raised.first()[BUCKET]
    earlier = earlier_alerts(spark, path, raised, 20)
    plan = earlier._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert f"= {bucket})" in pruned or f"IN ({bucket})" in pruned  # only the user's bucket folders are read
    assert earlier.count() == read_alerts(spark, path).withColumn(BUCKET, alert_bucket()).where(f"{BUCKET} = {bucket}").count()
    assert earlier.count() < 2 * 20 * 200 / ALERT_BUCKETS + 20
    assert earlier.join(raised.select("user_id"), "user_id", "left_semi").count() == 1
    assert BUCKET not in read_alerts(spark, path).columns and earlier_alerts(spark, path, raised, 3).where("batch_id >= 3").count() == 0
