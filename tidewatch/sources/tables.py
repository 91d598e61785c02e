"""Table readers and writers, with explicit schemas for event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.store import feature_columns
from ..schemas import portal_schema, trade_schema


def read_events(spark: SparkSession, path: str, schema: T.StructType, format: str = "csv") -> DataFrame:
    """Events with the columns of `schema`. CSV columns are found by the names in the header, in any order;
    files whose headers differ, missing columns and values that do not parse raise an error."""
    if format != "csv":
        return spark.read.schema(schema).format(format).load(path)
    text = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def read_portal(spark: SparkSession, path: str, format: str = "csv",
                key_type: T.DataType = T.StringType()) -> DataFrame:
    return read_events(spark, path, portal_schema(key_type), format)


def read_trades(spark: SparkSession, path: str, format: str = "csv",
                key_type: T.DataType = T.StringType()) -> DataFrame:
    return read_events(spark, path, trade_schema(key_type), format)


def read_store(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """The feature store with nulls as 0, and its feature columns in order."""
    store = spark.read.parquet(path)
    names = feature_columns(store)
    return store.na.fill(0.0, names), names


def write_table(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table. As CSV, arrays become JSON text."""
    if format == "csv":
        df = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c)
                         for c, t in df.dtypes])
        df.write.mode(mode).option("header", True).csv(path)
    else:
        df.write.mode(mode).format(format).save(path)
