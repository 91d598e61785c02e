"""The 29 trading features per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import DAY_US, MINUTE_US, holds, or_zero, rounded, shannon, share
from ..operators.skew import ROWS_PER_PART, heavy_keys
from ..operators.sliced import longest_run
from ..schemas import KEY, LABEL, TRADE_FEATURES
from .portal import last_seen, recent_days


def lot() -> Column:
    return F.col("lot_size")


def pnl() -> Column:
    return F.col("pnl")


def minutes() -> Column:
    return F.col("duration_min")


def opened() -> Column:
    return F.col("open_ts")

STREAK_SLICE_US = 60 * MINUTE_US


def base_aggregates() -> dict:
    """Unrounded one-pass aggregates; batch and stream features are built from these."""
    lot_sd, pnl_sd = or_zero(F.stddev_samp(lot())), or_zero(F.stddev_samp(pnl()))
    at = F.unix_micros(opened())
    days = F.greatest(F.floor((F.max(at) - F.min(at)) / DAY_US), F.lit(1))
    return {
        "total_trades": F.count(F.lit(1)),
        "total_lot_size": or_zero(F.sum(lot())),
        "mean_lot_size": F.avg(lot()),
        "std_lot_size": lot_sd,
        "max_lot_size": F.max(lot()),
        "lot_zscore_max": F.when(lot_sd > 0, (F.max(lot()) - F.avg(lot())) / lot_sd).otherwise(0.0),
        "trades_per_day": F.count(F.lit(1)) / days,
        "total_pnl": or_zero(F.sum(pnl())),
        "mean_pnl": F.avg(pnl()),
        "std_pnl": pnl_sd,
        "pnl_volatility": pnl_sd / (F.abs(F.avg(pnl())) + 1.0),
        "win_rate": share(pnl() > 0),
        "max_single_win": F.max(pnl()),
        "max_single_loss": F.min(pnl()),
        "mean_duration_min": F.avg(minutes()),
        "std_duration_min": or_zero(F.stddev_samp(minutes())),
        "pct_sub_minute_trades": share(minutes() < 1.0),
        "pct_sub_30s_trades": share(minutes() < 0.5),
        "mean_margin_used": F.avg("margin_used"),
        "max_margin_used": F.max("margin_used"),
        "trade_hour_std": or_zero(F.stddev_samp(F.hour(opened()))),
        "weekend_trade_ratio": share(F.dayofweek(opened()).isin(1, 7)),
    }


DIGITS = {
    "total_lot_size": 2, "mean_lot_size": 4, "std_lot_size": 4, "max_lot_size": 2,
    "lot_zscore_max": 4, "trades_per_day": 4, "total_pnl": 2, "mean_pnl": 4, "std_pnl": 4,
    "pnl_volatility": 4, "win_rate": 4, "max_single_win": 2, "max_single_loss": 2,
    "mean_duration_min": 4, "std_duration_min": 4, "pct_sub_minute_trades": 4,
    "pct_sub_30s_trades": 4, "top_instrument_concentration": 4, "instrument_entropy": 4,
    "mean_margin_used": 2, "max_margin_used": 2, "rolling_7d_pnl": 2, "rolling_7d_lot_size": 2,
    "trade_hour_std": 4, "weekend_trade_ratio": 4,
}


def instrument_mix(trades: DataFrame) -> DataFrame:
    """Distinct instruments, largest share and its name, and entropy per user."""
    counts = (trades.where(F.col("instrument").isNotNull())
              .groupBy(KEY, "instrument").agg(F.count("*").alias("c")))
    total = F.sum("c")
    return counts.groupBy(KEY).agg(
        F.count("*").alias("unique_instruments"),
        (F.max("c") / total).alias("top_instrument_concentration"),
        F.max(F.struct("c", "instrument"))["instrument"].alias("top_instrument"),
        shannon(total, F.sum(F.col("c") * F.ln("c")), F.count("*")).alias("instrument_entropy"))


def win_streaks(trades: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Longest run of winning trades per user in the order (open_ts, trade_id)."""
    heavy = heavy_keys(last_seen(trades, "open_ts"), KEY, "n_events", rows_per_part)
    return (longest_run(trades, KEY, "open_ts", ["trade_id"], pnl() > 0, STREAK_SLICE_US, heavy)
            .withColumnRenamed("longest", "consecutive_wins_max"))


def trading_features(trades: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """One row per user with the 29 features and the label."""
    base = (trades.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(
        *[c.alias(n) for n, c in base_aggregates().items()],
        F.bool_or(holds(F.col("anomaly_flag"))).alias(LABEL)))
    # only what the last days need goes through a join with the trades
    rolling = (recent_days(trades, "open_ts", "trade_id", ["lot_size", "pnl"], rows_per_part=rows_per_part)
               .where("recent").groupBy(KEY).agg(
                   F.count("*").alias("rolling_7d_trades"),
                   F.sum(pnl()).alias("rolling_7d_pnl"),
                   F.sum(lot()).alias("rolling_7d_lot_size")))
    joined = (base.join(rolling, KEY, "left").join(instrument_mix(trades), KEY, "left")
              .join(win_streaks(trades, rows_per_part), KEY, "left"))
    return joined.select(KEY, *[_finished(c) for c in TRADE_FEATURES], LABEL)


def _finished(name: str):
    if name in DIGITS:
        return rounded(or_zero(F.col(name)), DIGITS[name]).alias(name)
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)
