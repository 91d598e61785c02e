"""Lookup of a list of users in a per-user table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import KEY

MAX_IDS = 100


def wanted_users(spark, user_ids: list, limit: int = MAX_IDS) -> DataFrame:
    """The ids of one request as a table; more than `limit` ids are refused."""
    if len(user_ids) > limit:
        raise ValueError(f"Max {limit} users per batch request")
    kind = "string" if not user_ids or isinstance(user_ids[0], str) else "bigint"
    return spark.createDataFrame([(u,) for u in user_ids], f"{KEY} {kind}")


def hits(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted users, once per request of the id. Spark picks the join by size."""
    return table.join(wanted, KEY, "inner")


def misses(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """(user_id, error) for wanted users the table does not have."""
    return (wanted.join(table.select(KEY), KEY, "left_anti")
            .select(KEY, F.concat(F.lit("User '"), F.col(KEY).cast("string"),
                                  F.lit("' not found in feature store")).alias("error")))
