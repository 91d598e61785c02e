"""Table schemas and the feature lists whose order is part of the model contract."""

from __future__ import annotations

from pyspark.sql import types as T

#: Names a row while models score it; users may have several rows.
ROW = "_row"
KEY = "user_id"
LABEL = "is_anomalous"


def portal_schema(key_type: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("event_id", T.StringType()),
        T.StructField(KEY, key_type),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("anomaly_flag", T.BooleanType()),
        T.StructField("anomaly_type", T.StringType()),
    ])


def trade_schema(key_type: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        T.StructField("trade_id", T.StringType()),
        T.StructField(KEY, key_type),
        T.StructField("instrument", T.StringType()),
        T.StructField("direction", T.StringType()),
        T.StructField("lot_size", T.DoubleType()),
        T.StructField("open_ts", T.TimestampType()),
        T.StructField("close_ts", T.TimestampType()),
        T.StructField("duration_min", T.DoubleType()),
        T.StructField("pnl", T.DoubleType()),
        T.StructField("margin_used", T.DoubleType()),
        T.StructField("anomaly_flag", T.BooleanType()),
        T.StructField("anomaly_type", T.StringType()),
    ])


# Names and order of the feature columns.
PORTAL_FEATURES = [
    "total_logins", "failed_login_ratio", "unique_ips", "unique_devices",
    "unique_countries", "ip_entropy", "login_hour_mean", "login_hour_std",
    "pct_night_logins", "max_ips_in_1h", "inter_login_min",
    "total_deposits", "total_withdrawals", "deposit_count", "withdrawal_count",
    "mean_deposit_amt", "mean_withdrawal_amt", "max_deposit_amt", "max_withdrawal_amt",
    "deposit_withdraw_ratio", "structuring_score", "kyc_change_count",
    "kyc_before_withdrawal", "rolling_7d_logins", "rolling_7d_deposits",
    "rolling_7d_withdrawals", "support_ticket_count",
]
TRADE_FEATURES = [
    "total_trades", "total_lot_size", "mean_lot_size", "std_lot_size",
    "max_lot_size", "lot_zscore_max", "trades_per_day",
    "total_pnl", "mean_pnl", "std_pnl", "pnl_volatility",
    "win_rate", "max_single_win", "max_single_loss", "consecutive_wins_max",
    "mean_duration_min", "std_duration_min", "pct_sub_minute_trades", "pct_sub_30s_trades",
    "unique_instruments", "top_instrument_concentration", "instrument_entropy",
    "mean_margin_used", "max_margin_used",
    "rolling_7d_trades", "rolling_7d_pnl", "rolling_7d_lot_size",
    "trade_hour_std", "weekend_trade_ratio",
]

STORE_FEATURES = [f"p_{c}" for c in PORTAL_FEATURES] + [f"t_{c}" for c in TRADE_FEATURES]

# The features a stream buffer supports; all others stay 0 there.
QUICK_PORTAL = [
    "total_logins", "failed_login_ratio", "unique_ips", "unique_countries", "pct_night_logins",
    "deposit_count", "withdrawal_count", "deposit_withdraw_ratio", "structuring_score",
    "kyc_change_count",
]
QUICK_TRADE = [
    "total_trades", "mean_lot_size", "max_lot_size", "pnl_volatility", "win_rate",
    "top_instrument_concentration", "pct_sub_30s_trades",
]

# Topic names of the event bus.
PORTAL_TOPIC = "forex.portal.events"
TRADE_TOPIC = "forex.trading.events"
ALERT_TOPIC = "forex.alerts"

ALERT_SCHEMA = T.StructType([
    T.StructField("alert_id", T.StringType()),
    T.StructField(KEY, T.StringType()),
    T.StructField("generated_at", T.StringType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("final_score", T.DoubleType()),
    T.StructField("if_score", T.DoubleType()),
    T.StructField("ae_score", T.DoubleType()),
    T.StructField("summary", T.StringType()),
    T.StructField("findings", T.ArrayType(T.StringType())),
    T.StructField("recommended_action", T.StringType()),
    T.StructField("top_features", T.ArrayType(T.StringType())),
    T.StructField("portal_event_count", T.LongType()),
    T.StructField("trading_event_count", T.LongType()),
])
