"""The 27 portal features per user, and the statistics the portal rules read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import DAY_US, MINUTE_US, holds, or_zero, rounded, shannon, share
from ..operators.skew import ROWS_PER_PART, attach_per_key
from ..operators.sliced import count_behind, distinct_ahead
from ..schemas import KEY, LABEL, PORTAL_FEATURES

BURST_MINUTES = 60
KYC_HOURS = 4
SMALL_DEPOSIT = 500.0


def _kind(name: str) -> Column:
    return F.col("event_type") == name


def login() -> Column:
    return _kind("login")


def deposit() -> Column:
    return _kind("deposit")


def withdrawal() -> Column:
    return _kind("withdrawal")


def kyc_change() -> Column:
    return _kind("kyc_change")


def ticket() -> Column:
    return _kind("support_ticket")


def amount() -> Column:
    return F.col("amount")


def hour() -> Column:
    return F.hour("timestamp")



def base_aggregates() -> dict:
    """Unrounded one-pass aggregates; batch and stream features are built from these."""
    n = F.greatest(F.count_if(login()), F.lit(1))
    deposited, withdrawn = F.when(deposit(), amount()), F.when(withdrawal(), amount())
    at = F.when(login(), F.unix_micros("timestamp"))
    span_min = (F.max(at) - F.min(at)) / MINUTE_US
    return {
        "total_logins": F.count_if(login()),
        "failed_login_ratio": F.count_if(login() & (F.col("status") == "failed")) / n,
        "login_hour_mean": or_zero(F.avg(F.when(login(), hour()))),
        "login_hour_std": or_zero(F.stddev_samp(F.when(login(), hour()))),
        "pct_night_logins": or_zero(share(hour().between(0, 5), login())),
        "inter_login_min": or_zero(F.when(F.count(at) > 1, span_min / (F.count(at) - 1))),
        "total_deposits": or_zero(F.sum(deposited)),
        "total_withdrawals": or_zero(F.sum(withdrawn)),
        "deposit_count": F.count(deposited),
        "withdrawal_count": F.count(withdrawn),
        "mean_deposit_amt": or_zero(F.avg(deposited)),
        "mean_withdrawal_amt": or_zero(F.avg(withdrawn)),
        "max_deposit_amt": or_zero(F.max(deposited)),
        "max_withdrawal_amt": or_zero(F.max(withdrawn)),
        "deposit_withdraw_ratio": or_zero(F.sum(withdrawn))
                                  / F.greatest(or_zero(F.sum(deposited)), F.lit(1.0)),
        "structuring_score": F.count_if(deposit() & (amount() < SMALL_DEPOSIT)),
        "kyc_change_count": F.count_if(kyc_change()),
        "support_ticket_count": F.count_if(ticket()),
    }


# Digits each feature is rounded to; features not named are whole numbers.
DIGITS = {
    "failed_login_ratio": 4, "ip_entropy": 4, "login_hour_mean": 2, "login_hour_std": 2,
    "pct_night_logins": 4, "inter_login_min": 2, "total_deposits": 2, "total_withdrawals": 2,
    "mean_deposit_amt": 2, "mean_withdrawal_amt": 2, "max_deposit_amt": 2,
    "max_withdrawal_amt": 2, "deposit_withdraw_ratio": 4,
}


def last_seen(events: DataFrame, ts: str) -> DataFrame:
    """(user, n_events, last_us): one narrow aggregate, merged before the shuffle."""
    return events.groupBy(KEY).agg(F.count("*").alias("n_events"),
                                   F.max(F.unix_micros(ts)).alias("last_us"))


def recent_days(events: DataFrame, ts: str, row_id: str, kept: list[str], days: int = 7,
                rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Events with `recent`: within `days` days before the user's own last event, inclusive.

    Heavy users are spread by `row_id`: times and values alone may repeat too often for that.
    """
    return (attach_per_key(events.select(KEY, ts, row_id, *kept), last_seen(events, ts), KEY, "n_events",
                           [row_id], rows_per_part)
            .drop(row_id).withColumn("recent", F.unix_micros(ts) >= F.col("last_us") - F.lit(days * DAY_US)))


def diversity(events: DataFrame) -> DataFrame:
    """Distinct counts of IPs, devices and countries of logins, and the IP entropy."""
    dims = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(c).alias("v"))
                     for d, c in (("ip", "ip_address"), ("dev", "device_id"), ("geo", "country"))])
    counts = (events.where(login()).select(KEY, F.explode(dims).alias("d"))
              .select(KEY, "d.dim", "d.v").where(F.col("v").isNotNull())
              .groupBy(KEY, "dim", "v").agg(F.count("*").alias("c")))
    ip = F.col("dim") == "ip"
    return counts.groupBy(KEY).agg(
        F.count_if(ip).alias("unique_ips"),
        F.count_if(F.col("dim") == "dev").alias("unique_devices"),
        F.count_if(F.col("dim") == "geo").alias("unique_countries"),
        shannon(F.sum(F.when(ip, F.col("c"))), F.sum(F.when(ip, F.col("c") * F.ln("c"))),
                F.count_if(ip)).alias("ip_entropy"))


def login_bursts(events: DataFrame, window_minutes: int = BURST_MINUTES) -> DataFrame:
    """(user, at_us, n): distinct IPs in the window that starts at each login."""
    return distinct_ahead(events.where(login()), KEY, "timestamp", "ip_address",
                          window_minutes * MINUTE_US)


def kyc_before_withdrawals(events: DataFrame, window_hours: int = KYC_HOURS) -> DataFrame:
    """(user, at_us, n, payload): KYC changes in the window that ends at each withdrawal."""
    return count_behind(events, KEY, "timestamp", holds(kyc_change()), holds(withdrawal()),
                        window_hours * 60 * MINUTE_US,
                        F.struct(F.col("event_id"), amount().alias("amount")))


def portal_features(events: DataFrame, burst_minutes: int = BURST_MINUTES,
                    kyc_hours: int = KYC_HOURS, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """One row per user with the 27 features and the label."""
    base = (events.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(
        *[c.alias(n) for n, c in base_aggregates().items()],
        F.bool_or(holds(F.col("anomaly_flag"))).alias(LABEL)))
    # only what the last days need goes through a join with the events
    rolling = (recent_days(events, "timestamp", "event_id", ["event_type"], rows_per_part=rows_per_part)
               .where("recent").groupBy(KEY).agg(
                   F.count_if(login()).alias("rolling_7d_logins"),
                   F.count_if(deposit()).alias("rolling_7d_deposits"),
                   F.count_if(withdrawal()).alias("rolling_7d_withdrawals")))
    burst = (login_bursts(events, burst_minutes).groupBy(KEY)
             .agg(F.greatest(F.max("n"), F.lit(1)).alias("max_ips_in_1h")))
    kyc = (kyc_before_withdrawals(events, kyc_hours).groupBy(KEY)
           .agg(F.max((F.col("n") >= 3).cast("int")).alias("kyc_before_withdrawal")))
    joined = (base.join(rolling, KEY, "left").join(diversity(events), KEY, "left").join(burst, KEY, "left")
              .join(kyc, KEY, "left"))
    return joined.select(KEY, *[_finished(c) for c in PORTAL_FEATURES], LABEL)


def _finished(name: str):
    if name in DIGITS:
        return rounded(or_zero(F.col(name)), DIGITS[name]).alias(name)
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)
