"""Session helpers: a tuned local/cluster session and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    if not is_local(spark.sparkContext.master):
        ship_package(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return re.fullmatch(r"local(\[[\d*, ]+\])?", master) is not None


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, which run its Arrow functions."""
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / "tidewatch.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only in a local session that names none (a test run) is a fresh temporary folder made and
    recorded, so that every later call finds the same one. On a cluster each executor would see
    a folder of its own, so a cluster without the setting is refused.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not named:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            named = jvm_dir.get()
        elif is_local(spark.sparkContext.master):
            named = tempfile.mkdtemp(prefix="tidewatch-")
        else:
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        spark.conf.set(CHECKPOINT_CONF, named)
    return named


def shared_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses, inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The plan after this point starts at the written table, so a lost executor costs a
    re-read and not a recomputation of everything before it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, key: str, name: str = "clustered") -> DataFrame:
    """Write `df` once with the rows of a key together, and read it back.

    Aggregates by the key then merge before their shuffle. Rebalancing splits a key that fills
    more than one partition, so a heavy key costs more files and not a longer task.
    """
    return cut_lineage(df.hint("rebalance", key), name)
