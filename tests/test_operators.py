import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import nearest as nearest_module
from tidewatch.operators.nearest import nearest
from tidewatch.operators.ordered import exact_quantiles, running_totals
from tidewatch.operators.skew import attach_per_key
from tidewatch.plans import explore, metrics
from tidewatch.session import cut_lineage


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(1)
    cols = {"a": rng.normal(size=3001), "b": rng.integers(0, 4, 3001).astype(float), "c": np.ones(3001)}
    rows = [(float(a), float(b), float(c), float(a) if i < 37 else None)
            for i, (a, b, c) in enumerate(zip(*cols.values()))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    got = exact_quantiles(df, ["a", "b", "c", "d"], [0.0, 0.1, 0.25, 0.5, 0.75, 1.0], accuracy=50)
    cols["d"] = cols["a"][:37]
    for name, values in cols.items():
        assert got[name] == pytest.approx(np.percentile(values, [0, 10, 25, 50, 75, 100]).tolist(), abs=1e-12)


def test_running_totals_over_buckets(spark):
    rows = [(g, float(i), i % 5) for g in "ab" for i in random.Random(2).sample(range(1000), 300)]
    df = spark.createDataFrame(rows, "g string, s double, v long").repartition(6)
    got = {(r.g, r.s): (r.cum_v, r.next_v) for r in
           running_totals(df, ["g"], "s", {"v": F.col("v")}, ["v"], buckets=16).collect()}
    for g in "ab":
        total, ordered = 0, sorted((r for r in rows if r[0] == g), key=lambda r: -r[1])
        for i, r in enumerate(ordered):
            total += r[2]
            assert got[(g, r[1])] == (total, ordered[i + 1][2] if i + 1 < len(ordered) else None)


def test_attach_splits_only_heavy_keys(spark):
    events = spark.createDataFrame([("h", i) for i in range(50)] + [("x", 1), ("y", 2)], "k string, v long")
    per_key = events.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m"))
    got = attach_per_key(events, per_key, "k", "n", ["v"], rows_per_part=7)
    assert got.count() == 52 and got.where("k = 'h' and m = 49").count() == 50


def test_the_list_of_heavy_keys_is_broadcast(spark):
    """Left to the planner, the join with the short list shuffles all events."""
    events = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    per_key = events.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = attach_per_key(events, per_key, "k", "n", ["v"], rows_per_part=142)
        assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("options", [{}, {"block_rows": 20, "stripe_rows": 40, "cells": 30}])
def test_nearest_equals_brute_force(spark, options):
    rng = np.random.default_rng(4)
    ref = np.concatenate([rng.normal(size=(500, 6)), rng.normal(size=(300, 6)) * 0.01 + 5, np.zeros((3, 6))])
    query = np.concatenate([rng.normal(size=(60, 6)), rng.normal(size=(30, 6)) + 5, np.zeros((1, 6))])
    refs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(ref)], "id long, x array<double>")
    queries = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(query)], "id string, x array<double>")
    got = {}
    for r in nearest(queries, refs, 4, 6, **options).orderBy("qid", "dist", "rid").collect():
        got.setdefault(r.qid, []).append(r.rid)
    for i, q in enumerate(query):
        dist = np.sqrt(((ref - q) ** 2).sum(1))
        assert got[f"q{i}"] == sorted(range(len(ref)), key=lambda j: (dist[j], j))[:4]


def test_nearest_writes_each_query_once(spark, monkeypatch):
    """Rows without clusters visit nearly every cell: what is written must not be one row per query and cell."""
    written = {}

    def counted(df, name="stage"):
        out = cut_lineage(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr("tidewatch.operators.nearest.cut_lineage", counted)
    x = np.random.default_rng(7).normal(size=(1500, 20))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    got = {}
    for r in nearest(rows, rows, 3, 20, skip_same=True, block_rows=400, stripe_rows=200, cells=60).orderBy("qid", "dist", "rid").collect():
        got.setdefault(r.qid, []).append(r.rid)
    assert written["nn-visits"] == 1500
    for i in range(0, 1500, 50):
        dist = np.sqrt(((x - x[i]) ** 2).sum(1))
        assert got[i] == [j for j in sorted(range(1500), key=lambda j: (dist[j], j)) if j != i][:3]


@pytest.mark.parametrize("shape", ["spread", "far and near", "clusters far off", "queries apart", "broken"])
def test_few_pairs_of_a_unit_are_compared_in_full(monkeypatch, shape):
    """All pairs are ruled out or compared exactly: the answer is brute force's, with few full distances."""
    rng = np.random.default_rng(12)
    y = rng.normal(size=(6000, 12)) @ rng.normal(size=(12, 40)) + rng.normal(size=(6000, 40)) * 0.05
    if shape == "far and near":
        y[::10, :5] += rng.normal(size=(600, 5)) * 3000
    elif shape == "clusters far off":
        y = y * 1e-4 + rng.normal(size=(8, 40))[np.arange(6000) % 8] * 1e5
    x = np.concatenate([y[:700], y[:100] + 30.0]) if shape == "queries apart" else y[:800].copy()
    if shape == "broken":
        x[3], y[5, 7] = np.nan, np.inf
    full = []
    measured = nearest_module._Best._distances
    monkeypatch.setattr(nearest_module._Best, "_distances", lambda self, a, b: full.append(len(a)) or measured(self, a, b))
    for known in (False, True):
        dist = np.sqrt(((x[:, None, :] - y[None]) ** 2).sum(2))
        d = np.sort(np.nan_to_num(dist, nan=np.inf), axis=1)[:, 9] if known else np.full(len(x), np.inf)
        best = nearest_module._Best(x, y, np.arange(6000), None, 10, d)
        best.search()
        for i in range(len(x)):
            wanted = [] if np.isnan(x[i]).any() else np.lexsort((np.arange(6000), dist[i]))[:10].tolist()
            assert best.ref[i][best.ref[i] >= 0].tolist() == wanted
    if shape in ("spread", "far and near"):
        assert sum(full) < 0.1 * 2 * len(x) * len(y)


def test_a_crowded_cell_is_cut_into_stripes(spark):
    """Equal ids with differing vectors, a cell above a stripe, and queries in several blocks."""
    x = np.concatenate([np.random.default_rng(8).normal(size=(400, 4)) * 1e-3, np.random.default_rng(9).normal(size=(30, 4)) + 9])
    rows = spark.createDataFrame([(f"r{i // 2}", v.tolist()) for i, v in enumerate(x)], "id string, x array<double>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    got = {}
    for r in nearest(asked, rows, 2, 4, block_rows=64, stripe_rows=50, cells=5).orderBy("qid", "dist", "rid").collect():
        got.setdefault(r.qid, []).append(r.rid)
    for i in range(len(x)):
        dist = np.sqrt(((x - x[i]) ** 2).sum(1))
        assert got[i] == [f"r{j // 2}" for j in sorted(range(len(x)), key=lambda j: (dist[j], f"r{j // 2}"))[:2]]


def test_binary_metrics(spark):
    rng = random.Random(9)
    data = [(round(rng.random(), 1), rng.random() < 0.3) for _ in range(400)]
    df = spark.createDataFrame(data, "s double, y boolean")
    row = metrics.binary_metrics(metrics.long_scores(df, [("m", "s", F.col("s") >= 0.5)], F.col("y"))).first()
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    ap, seen = 0.0, 0
    for s in sorted({s for s, _ in data}, reverse=True):
        hits, total = sum(p >= s for p in pos), sum(x >= s for x, _ in data)
        ap += (hits - seen) / len(pos) * hits / total
        seen = hits
    tp, flagged = sum(p >= 0.5 for p in pos), sum(s >= 0.5 for s, _ in data)
    assert row.auc == pytest.approx(auc) and row.ap == pytest.approx(ap)
    assert row.precision == pytest.approx(tp / flagged) and row.recall == pytest.approx(tp / len(pos))
    assert row.f1 == pytest.approx(2 * tp / (flagged + len(pos)))


def test_metrics_without_positive_predictions(spark):
    df = spark.createDataFrame([(0.1, True), (0.2, False)], "s double, y boolean")
    row = metrics.binary_metrics(metrics.long_scores(df, [("m", "s", F.lit(False))], F.col("y"))).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_roc_points(spark):
    data = [(0.9, True), (0.8, True), (0.7, False), (0.6, True), (0.5, False), (0.4, False), (0.3, False)]
    scored = metrics.long_scores(spark.createDataFrame(data, "s double, y boolean"), [("m", "s", F.lit(True))], F.col("y"))
    full = metrics.roc_points(scored, drop_intermediate=False).orderBy(F.desc("threshold")).collect()
    assert [(r.fpr, r.tpr) for r in full][:3] == [(0.0, 0.0), (0.0, 1 / 3), (0.0, 2 / 3)] and len(full) == 8
    kept = metrics.roc_points(scored).orderBy(F.desc("threshold")).collect()
    assert [r.threshold for r in kept] == [float("inf"), 0.8, 0.7, 0.6, 0.3]
    area = sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(kept, kept[1:]))
    row = metrics.binary_metrics(scored).first()
    assert area == pytest.approx(row.auc)


def test_histograms_use_each_labels_range(spark):
    values = [(float(v), v % 2 == 0) for v in range(101)] + [(7.0, None)]
    df = spark.createDataFrame([(v, y, 3.0) for v, y in values if y is not None], "a double, is_anomalous boolean, b double")
    got = {(r.feature, r.label, r.bin): r.n for r in explore.histograms(df, ["a", "b"]).collect()}
    for label in (True, False):
        want, _ = np.histogram([v for v, y in values if y is label], bins=30)
        assert [got.get(("a", label, i), 0) for i in range(30)] == want.tolist()
        assert got[("b", label, 15)] == sum(want)


def test_counts(spark, portal):
    df = portal([{}, {}, {"event_type": "deposit", "user_id": "b", "anomaly_flag": True, "anomaly_type": "x"}])
    assert [tuple(r) for r in explore.value_counts(df, "event_type").collect()] == [("login", 2), ("deposit", 1)]
    assert [tuple(r) for r in explore.value_counts(df, "anomaly_type", F.col("anomaly_flag")).collect()] == [("x", 1)]
    assert tuple(explore.event_summary(df).first()) == (3, 2, pytest.approx(1 / 3))
