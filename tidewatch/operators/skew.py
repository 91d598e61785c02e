"""Work per key on a large event table, safe for a key that holds most of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_PART = 1_000_000


def heavy_keys(per_key: DataFrame, key: str, count: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """(key, _parts) of the keys above `rows_per_part` rows.

    The list cannot be longer than rows / rows_per_part, so it is broadcast: left to the planner, which knows
    nothing of the count, a join with it shuffles all events.
    """
    parts = F.ceil(F.col(count) / F.lit(rows_per_part)).cast("int")
    return F.broadcast(per_key.where(F.col(key).isNotNull() & (F.col(count) > rows_per_part)).select(key, parts.alias("_parts")))


def attach_per_key(events: DataFrame, per_key: DataFrame, key: str, count: str, spread: list[str],
                   rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Inner join of `events` with `per_key` (unique on `key`, with the key's row `count`).

    Heavy keys are spread over as many parts as their count asks for, by a hash of `spread`.
    """
    parts = F.ceil(F.col(count) / F.lit(rows_per_part)).cast("int")
    salted = (events.join(heavy_keys(per_key, key, count, rows_per_part), key, "left")
              .withColumn("_salt", F.pmod(F.xxhash64(*spread), F.coalesce("_parts", F.lit(1)))
                          .cast("int"))
              .drop("_parts"))
    copies = per_key.where(F.col(key).isNotNull()).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return salted.join(copies, [key, "_salt"], "inner").drop("_salt")

