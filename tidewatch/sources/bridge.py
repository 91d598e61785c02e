"""The driver's star-schema tables seen as portal events and trades.

Plain projections (and one star join), so filters and column pruning reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import whole


def portal_columns(events: DataFrame) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    k = F.get_json_object("props", "$.k").cast("int")
    mapped = (F.when(kind.isin("view", "error"), "login").when(kind == "purchase", "deposit")
              .when((kind == "click") & (value >= 1), "withdrawal")
              .when(kind == "click", "support_ticket").when(kind == "signup", "kyc_change"))
    return events.select(
        F.col("event_id").cast("string").alias("event_id"), "user_id",
        mapped.alias("event_type"), F.col("ts").cast("timestamp").alias("timestamp"),
        k.cast("string").alias("ip_address"), (k % 20).cast("string").alias("device_id"),
        (k % 10).cast("string").alias("country"),
        F.when(mapped.isin("deposit", "withdrawal"), value).alias("amount"),
        F.when(kind == "error", "failed").otherwise("success").alias("status"),
        ((kind == "error") & (value > 260)).alias("anomaly_flag"),
        F.when((kind == "error") & (value > 260), "error_spike").alias("anomaly_type"))


def trade_columns(lineitem: DataFrame, orders: DataFrame, part: DataFrame, by_user: bool = False) -> DataFrame:
    """Trades; with `by_user` the joined rows are brought together by user before the texts are made of them."""
    price, minutes = F.col("l_extendedprice"), 10 * F.col("l_tax") * F.col("l_linenumber")
    flagged = (F.col("l_quantity") > 49) & (F.col("l_discount") > 0.09)
    opened = F.col("l_shipdate").cast("timestamp")
    joined = (lineitem.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
              .join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")))
    return ((joined.hint("rebalance", "o_custkey") if by_user else joined)
            .select(
                F.concat_ws("-", *[F.col(c).cast("string") for c in
                                   ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                            whole(price * 100).cast("string")).alias("trade_id"),
                F.col("o_custkey").alias("user_id"), F.col("p_type").alias("instrument"),
                F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy").alias("direction"),
                F.col("l_quantity").alias("lot_size"), opened.alias("open_ts"),
                F.timestamp_micros(F.unix_micros(opened) + (minutes * 60_000_000).cast("bigint"))
                .alias("close_ts"),
                minutes.alias("duration_min"), (price * (F.col("l_discount") - 0.05)).alias("pnl"),
                (price * F.col("l_tax")).alias("margin_used"), flagged.alias("anomaly_flag"),
                F.when(flagged, "lot_spike").alias("anomaly_type")))


def portal_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portal_columns(spark.read.parquet(f"{sf_dir}/events.parquet"))


def trade_view(spark: SparkSession, sf_dir: str, by_user: bool = False) -> DataFrame:
    read = spark.read.parquet
    return trade_columns(read(f"{sf_dir}/lineitem.parquet"), read(f"{sf_dir}/orders.parquet"),
                         read(f"{sf_dir}/part.parquet"), by_user)
