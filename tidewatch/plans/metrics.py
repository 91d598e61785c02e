"""Quality metrics of scores against labels. Nothing here sorts a table in one task."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import running_totals


def long_scores(df: DataFrame, models: Sequence[tuple[str, str, Column]], label: Column) -> DataFrame:
    """(model, score, label, predicted): one row per input row and model."""
    each = F.array(*[F.struct(F.lit(name).alias("model"),
                              F.col(score).cast("double").alias("score"),
                              predicted.cast("int").alias("predicted"))
                     for name, score, predicted in models])
    return (df.select(label.cast("int").alias("label"), F.explode(each).alias("s"))
            .select("s.model", "s.score", "label", "s.predicted"))


def curve(scored: DataFrame) -> DataFrame:
    """Per model and distinct score, from the highest down: counts and running counts."""
    steps = scored.groupBy("model", "score").agg(
        F.sum("label").cast("bigint").alias("tp"), F.sum(1 - F.col("label")).cast("bigint").alias("fp"))
    return running_totals(steps, ["model"], "score", {"tp": F.col("tp"), "fp": F.col("fp")}, ["tp", "fp"])


def binary_metrics(scored: DataFrame) -> DataFrame:
    """AUC (ties by average rank), average precision, precision, recall and F1 per model."""
    tp, fp, ctp, cfp = (F.col(c) for c in ("tp", "fp", "cum_tp", "cum_fp"))
    ranked = curve(scored).groupBy("model").agg(
        F.sum("tp").alias("p"), F.sum("fp").alias("n"),
        F.sum(fp * (2 * ctp - tp)).alias("area2"), F.sum(tp * ctp / (ctp + cfp)).alias("ap"))
    hit, pos = F.col("predicted") == 1, F.col("label") == 1
    counts = scored.groupBy("model").agg(
        F.count_if(hit & pos).alias("hits"), F.count_if(hit).alias("flagged"),
        F.count_if(pos).alias("positives"))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    return ranked.join(counts, "model").select(
        "model",
        F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("area2") / 2 / F.col("p") / F.col("n")).alias("auc"),
        F.when(F.col("p") > 0, F.col("ap") / F.col("p")).alias("ap"),
        ratio(F.col("hits"), F.col("flagged")).alias("precision"),
        ratio(F.col("hits"), F.col("positives")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("flagged") + F.col("positives")).alias("f1"))


def roc_points(scored: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """(model, threshold, fpr, tpr). The point (0, 0) has the threshold infinity.

    With `drop_intermediate`, points on a straight line between their neighbours are left out.
    """
    points = curve(scored)
    sums = scored.groupBy("model").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
    if drop_intermediate:
        same = (F.col("tp") == F.col("next_tp")) & (F.col("fp") == F.col("next_fp"))
        points = points.where(~F.coalesce(same, F.lit(False)))
    rows = points.select("model", F.col("score").alias("threshold"), "cum_fp", "cum_tp")
    origin = sums.select("model", F.lit(float("inf")).alias("threshold"),
                         F.lit(0).cast("bigint").alias("cum_fp"), F.lit(0).cast("bigint").alias("cum_tp"))
    return (rows.unionByName(origin).join(sums, "model")
            .select("model", "threshold",
                    F.when(F.col("n") > 0, F.col("cum_fp") / F.col("n")).alias("fpr"),
                    F.when(F.col("p") > 0, F.col("cum_tp") / F.col("p")).alias("tpr")))


def model_comparison(baseline: DataFrame, autoencoder: DataFrame, key: str = "user_id",
                     label: str = "is_anomalous") -> DataFrame:
    """AUC, AP and F1 of the forest, LOF, their ensemble and the autoencoder."""
    joined = baseline.join(autoencoder.select(key, "lstm_score", "lstm_anomaly"), key)
    return binary_metrics(long_scores(joined, [
        ("Isolation Forest", "if_score", F.col("if_anomaly") == -1),
        ("LOF", "lof_score", F.col("lof_anomaly") == -1),
        ("IF+LOF Ensemble", "ensemble_score", F.col("ensemble_score") >= 0.5),
        ("MLP Autoencoder", "lstm_score", F.col("lstm_anomaly") == 1)], F.col(label)))


def run_record(metrics: DataFrame, run_name: str, params: dict, as_of: datetime) -> DataFrame:
    """One row per training run: (run_name, run_ts, params, metrics)."""
    names = ["auc", "ap", "precision", "recall", "f1"]
    entries = F.flatten(F.collect_list(F.array(*[
        F.struct(F.concat_ws("_", F.col("model"), F.lit(n)).alias("key"), F.col(n).alias("value"))
        for n in names])))
    settings = F.create_map(*[F.lit(str(x)) for kv in params.items() for x in kv]) if params \
        else F.create_map().cast("map<string,string>")
    return (metrics.agg(F.map_from_entries(entries).alias("metrics"))
            .select(F.lit(run_name).alias("run_name"), F.lit(as_of).alias("run_ts"),
                    settings.alias("params"), "metrics"))
