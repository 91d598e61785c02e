"""Tables behind the exploratory report: counts, rates and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import KEY, LABEL


def value_counts(df: DataFrame, column: str, where=None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return (rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), column))


def event_summary(df: DataFrame) -> DataFrame:
    """Rows, users and share of flagged rows."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(KEY).alias("n_users"),
                  F.avg(F.col("anomaly_flag").cast("double")).alias("anomaly_rate"))


def store_summary(store: DataFrame) -> DataFrame:
    return store.agg(F.count("*").alias("n_users"), F.count_if(LABEL).alias("n_anomalous"))


def histograms(df: DataFrame, columns: list[str], label: str = LABEL, bins: int = 30) -> DataFrame:
    """(feature, label, bin, n): equal-width bins over each label's own value range.

    The last bin is closed on the right; a constant column falls into a range of width 1.
    """
    each = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v"))
                     for c in columns])
    values = (df.select(F.col(label).alias("label"), F.explode(each).alias("e"))
              .select("label", "e.feature", "e.v").where(F.col("v").isNotNull()))
    ranges = values.groupBy("feature", "label").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    low = F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo"))
    width = F.when(F.col("lo") == F.col("hi"), F.lit(1.0)).otherwise(F.col("hi") - F.col("lo"))
    spot = F.least(F.floor((F.col("v") - low) / width * bins), F.lit(bins - 1)).cast("int")
    # One range per feature and label: a fixed, small number of rows.
    return (values.join(F.broadcast(ranges), ["feature", "label"])
            .groupBy("feature", "label", spot.alias("bin")).agg(F.count("*").alias("n")))
