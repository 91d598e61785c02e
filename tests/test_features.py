import math
import random
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import BASE, one
from tidewatch.functions.columns import rounded, whole
from tidewatch.plans.portal import login_bursts, portal_features
from tidewatch.plans.store import feature_columns, feature_counts, feature_store, imputed
from tidewatch.plans.trading import trading_features, win_streaks
from tidewatch.schemas import PORTAL_FEATURES, STORE_FEATURES, TRADE_FEATURES
from tidewatch.sources.tables import read_portal


def at(**kw):
    return BASE + timedelta(**kw)


NIGHT = BASE.replace(hour=0)

# One user per case, so that the features of all cases come from one run.
PORTAL_CASES = {
    "single": [{}],
    "money": [{"event_type": "deposit", "amount": None}, {"event_type": "deposit", "amount": 10.0},
              {"event_type": "withdrawal", "amount": None, "anomaly_flag": True}],
    "null_ips": [{"ip_address": None}, {"ip_address": None}],
    "burst_3600": [{"ip_address": "a"}, {"ip_address": "b", "timestamp": at(seconds=3600)}],
    "burst_3601": [{"ip_address": "a"}, {"ip_address": "b", "timestamp": at(seconds=3601)}],
    "deposit_499": [{"event_type": "deposit", "amount": 499.99}],
    "deposit_500": [{"event_type": "deposit", "amount": 500.0}],
    "night": [{"timestamp": NIGHT.replace(hour=h)} for h in (0, 1, 4, 5, 6)],
    "week": [{"timestamp": at(days=-7)}, {"timestamp": at(days=-7, seconds=-1)}, {"event_type": "support_ticket"}],
    "entropy": [{"ip_address": ip, "timestamp": at(minutes=m)} for ip, m in (("a", 0), ("a", 10), ("b", 40))],
    "tie": [{"status": "failed"}] + [{}] * 31,
    **{f"kyc_{first}_{count}": [{"event_type": "kyc_change", "timestamp": at(seconds=-first)}]
       + [{"event_type": "kyc_change"}] * (count - 1) + [{"event_type": "withdrawal", "amount": 5.0}]
       for first, count in ((4 * 3600, 3), (4 * 3600 + 1, 3), (0, 3), (0, 2))},
}
TRADE_CASES = {
    "week": [{"open_ts": at(days=-7), "pnl": 2.0}, {"open_ts": at(days=-7, seconds=-1), "pnl": 50.0}, {"pnl": 3.0}],
    "fast": [{"duration_min": d} for d in (0.49, 0.50, 0.99, 1.00)],
    "single": [{"pnl": -3.0}],
    "streak": [{"pnl": p, "open_ts": at(minutes=i)} for i, p in enumerate([1.0, 1.0, 0.0, 1.0, 1.0, 1.0, -1.0])],
    "weekend": [{"open_ts": at(days=d)} for d in range(7)],
}


def rows_of(cases):
    return [{**r, "user_id": name} for name, rows in cases.items() for r in rows]


@pytest.fixture(scope="module")
def p(portal):
    return {r.user_id: r for r in portal_features(portal(rows_of(PORTAL_CASES))).collect()}


@pytest.fixture(scope="module")
def t(trades):
    return {r.user_id: r for r in trading_features(trades(rows_of(TRADE_CASES))).collect()}


def test_single_login_has_zero_defaults(p):
    row = p["single"]
    assert row.total_logins == 1 and row.login_hour_mean == 10.0
    assert row.login_hour_std == 0 and row.inter_login_min == 0 and row.ip_entropy == 0
    assert row.max_ips_in_1h == 1 and row.total_deposits == 0 and row.kyc_before_withdrawal == 0
    assert row.is_anomalous is False


def test_no_logins_and_null_amounts(p):
    row = p["money"]
    assert row.total_logins == 0 and row.failed_login_ratio == 0 and row.max_ips_in_1h == 0
    assert row.deposit_count == 1 and row.withdrawal_count == 0 and row.mean_deposit_amt == 10.0
    assert row.rolling_7d_deposits == 2 and row.rolling_7d_withdrawals == 1
    assert row.is_anomalous is True


def test_null_ips_count_as_one_in_the_burst(p):
    assert p["null_ips"].unique_ips == 0 and p["null_ips"].max_ips_in_1h == 1 and p["null_ips"].total_logins == 2


def test_burst_window_includes_its_end(p):
    assert p["burst_3600"].max_ips_in_1h == 2 and p["burst_3601"].max_ips_in_1h == 1


def test_kyc_window_includes_both_ends(p):
    got = {name: r.kyc_before_withdrawal for name, r in p.items() if name.startswith("kyc_")}
    assert got == {"kyc_14400_3": 1, "kyc_14401_3": 0, "kyc_0_3": 1, "kyc_0_2": 0}


def test_small_deposit_is_strict(p):
    assert p["deposit_499"].structuring_score == 1 and p["deposit_500"].structuring_score == 0


def test_night_hours(p):
    assert p["night"].pct_night_logins == 0.8


def test_last_seven_days_include_the_boundary(p, t):
    assert p["week"].rolling_7d_logins == 1 and p["week"].support_ticket_count == 1
    row = t["week"]
    assert row.rolling_7d_trades == 2 and row.rolling_7d_pnl == 5.0 and row.rolling_7d_lot_size == 2.0


def test_entropy_and_gaps(p):
    assert p["entropy"].ip_entropy == round(-(2 / 3 * math.log(2 / 3) + 1 / 3 * math.log(1 / 3)), 4)
    assert p["entropy"].inter_login_min == 20.0 and p["entropy"].unique_ips == 2


def test_ties_are_rounded_half_even(p):
    assert p["tie"].failed_login_ratio == 0.0312


def test_trading_boundaries(t):
    row, single = t["fast"], t["single"]
    assert row.pct_sub_30s_trades == 0.25 and row.pct_sub_minute_trades == 0.75
    assert row.lot_zscore_max == 0 and row.std_lot_size == 0 and row.trades_per_day == 4.0
    assert single.std_pnl == 0 and single.max_single_win == -3.0 and single.instrument_entropy == 0


def test_zero_pnl_breaks_a_streak(t):
    assert t["streak"].consecutive_wins_max == 3


def test_weekend_ratio(t):
    assert t["weekend"].weekend_trade_ratio == round(2 / 7, 4)


@pytest.mark.parametrize("rows_per_part", [3, 1_000_000])
def test_streaks_of_a_heavy_user(trades, rows_per_part):
    rng = random.Random(5)
    rows = [{"user_id": u, "pnl": rng.choice([-1.0, 1.0, 1.0, 1.0]),
             "open_ts": at(minutes=rng.randrange(0, 900))} for u in ["H"] * 120 + ["a", "b"]]
    df = trades(rows)
    want = {}
    for u in ("H", "a", "b"):
        run = best = 0
        for r in sorted((r for r in df.collect() if r.user_id == u), key=lambda r: (r.open_ts, r.trade_id)):
            run = run + 1 if r.pnl > 0 else 0
            best = max(best, run)
        want[u] = best
    got = {r.user_id: r.consecutive_wins_max for r in win_streaks(df, rows_per_part).collect()}
    assert got == want


def test_heavy_users_are_split_without_changing_results(portal, trades):
    rng = random.Random(3)
    kinds = ["login", "deposit", "withdrawal", "kyc_change", "support_ticket"]
    events = portal([{"user_id": "H" if i % 3 else f"u{i % 7}", "event_type": rng.choice(kinds),
                      "timestamp": at(minutes=rng.randrange(20000)), "ip_address": str(rng.randrange(9)),
                      "amount": round(rng.random() * 900, 2)} for i in range(400)])
    assert portal_features(events, rows_per_part=10).exceptAll(portal_features(events.repartition(7))).isEmpty()
    deals = trades([{"user_id": "H" if i % 3 else f"u{i % 7}", "pnl": round(rng.random() - 0.4, 2),
                     "open_ts": at(minutes=rng.randrange(20000))} for i in range(400)])
    assert trading_features(deals, rows_per_part=10).exceptAll(trading_features(deals.repartition(7))).isEmpty()


def test_burst_counts_equal_a_range_join(portal):
    rng = random.Random(11)
    df = portal([{"user_id": rng.choice("abc"), "timestamp": at(seconds=rng.randrange(0, 20000)),
                  "ip_address": rng.choice([None, "1", "2", "3", "4"])} for _ in range(300)]
                + [{"user_id": "a"}] * 30)
    rows, want = df.collect(), defaultdict(set)
    for r in rows:
        want[(r.user_id, r.timestamp)] = {q.ip_address for q in rows if q.user_id == r.user_id and q.ip_address
                                          and r.timestamp <= q.timestamp <= r.timestamp + timedelta(minutes=60)}
    got = {(r.user_id, r.at_us): r.n for r in login_bursts(df).collect()}
    assert sorted(got.values()) == sorted(len(v) for v in want.values()) and len(got) == len(want)


def test_store_joins_both_sides(portal, trades):
    p = portal_features(portal([{"user_id": "p"}, {"user_id": "both"}]))
    t = trading_features(trades([{"user_id": "t", "anomaly_flag": True}, {"user_id": "both"}]))
    store = feature_store(p, t)
    assert len(feature_columns(store)) == 56 == len(PORTAL_FEATURES) + len(TRADE_FEATURES)
    assert feature_columns(store) == STORE_FEATURES
    assert feature_counts(store) == {"total": 56, "portal": 27, "trading": 29}
    rows = {r.user_id: r for r in store.collect()}
    assert rows["p"].t_total_trades == 0 and rows["t"].p_total_logins is None
    assert rows["t"].is_anomalous and not rows["p"].is_anomalous and not rows["both"].is_anomalous
    filled = {r.user_id: r for r in imputed(store).collect()}
    assert filled["t"].p_total_logins == 1.0
    assert {r.user_id: r.p_total_logins for r in imputed(store, "zero").collect()}["t"] == 0.0


def test_users_without_times_stay(portal, trades):
    """A user whose times are all null has features; recent counts are 0."""
    events = portal([{"user_id": "a"}, {"user_id": "b", "timestamp": None}, {"user_id": None}])
    got = {r.user_id: r for r in portal_features(events).collect()}
    assert set(got) == {"a", "b"} and got["b"].total_logins == 1 and got["b"].rolling_7d_logins == 0
    made = trades([{"user_id": "a"}, {"user_id": "b", "open_ts": None, "close_ts": None}])
    got = {r.user_id: r for r in trading_features(made).collect()}
    assert set(got) == {"a", "b"} and got["b"].total_trades == 1 and got["b"].rolling_7d_trades == 0


def test_login_gaps_skip_null_times(portal):
    events = portal([{"timestamp": BASE}, {"timestamp": BASE + timedelta(minutes=10)}, {"timestamp": None}])
    assert one(portal_features(events)).inter_login_min == 10.0


def test_csv_columns_go_by_name(spark, portal, tmp_path):
    rows = portal([{"user_id": "u1", "amount": 5.5}, {"user_id": "u2"}])
    rows.select(*reversed(rows.columns)).coalesce(1).write.option("header", True).csv(str(tmp_path / "p"))
    got = read_portal(spark, str(tmp_path / "p"))
    assert got.columns == rows.columns and sorted(map(str, got.collect())) == sorted(map(str, rows.collect()))


def test_rounding_without_decimals_gives_the_decimal_result(spark):
    rng = random.Random(7)
    values = [None, math.nan, math.inf, -math.inf, -0.0, 0.0, -1e-12, 5e-324, 1e308, 0.5, -0.5, 1.5, 2.5, 0.00005, -0.00005,
              1.00000000005, 1e15 + 0.5, 99999999999.5, 1.005, 2.675, 1234.56785]
    values += [k * 0.00005 for k in range(-300, 300)] + [rng.uniform(-1, 1) * 10 ** rng.uniform(-8, 18) for _ in range(2000)]
    df, v = spark.createDataFrame([(x,) for x in values], "v double"), F.col("v")
    pairs = {f"d{d}": (rounded(v, d), F.bround(F.round(v, 10), d)) for d in (0, 2, 4, 6, 8)}
    small = F.when(F.abs(v) < 1e18, v)  # a bigint holds no more
    pairs["whole"] = (whole(small), F.round(small).cast("bigint"))
    got = df.select(*[c.cast("string").alias(f"{n}_{k}") for n, two in pairs.items() for k, c in zip("ab", two)]).collect()
    for n in pairs:
        assert [r[f"{n}_a"] for r in got] == [r[f"{n}_b"] for r in got]
    assert "rint" in str(rounded(v, 6)).lower() and "rint" not in str(rounded(v, 8)).lower()
