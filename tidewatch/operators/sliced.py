"""Time-framed counts per key that stay small per task.

A range-framed window over one key puts the whole key into one task and recounts the frame
for every row. Here the key's time line is cut into slices as wide as the frame. A frame
then touches two slices at most, so every slice is counted on its own with one running sum:
each event opens an interval of times that count it (+1 at the start, -1 behind the end).
Copies and simultaneous events are merged before any of it is shuffled by slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import micros, slice_of


def _running(points: DataFrame, key: str, kept: list[str]) -> DataFrame:
    """Sum of `delta` over all points up to and including each asked point."""
    frame = (Window.partitionBy(key, "cell").orderBy("p")
             .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (points.withColumn("n", F.sum("delta").over(frame))
            .where("asked").select(key, F.col("p").alias("at_us"), "n", *kept))


def distinct_ahead(events: DataFrame, key: str, ts: str, value: str, width_us: int) -> DataFrame:
    """For every event time t: distinct non-null `value`s in [t, t + width], both ends included.

    Returns (key, at_us, n); a time may appear once per value seen at it.
    """
    width = F.lit(width_us)
    seen = (events.select(key, F.col(value).alias("v"), micros(ts).alias("t"))
            .where(F.col("t").isNotNull())
            .withColumn("slice", slice_of(F.col("t"), width_us))
            .groupBy(key, "slice", "v", "t").agg(F.lit(1).alias("one")))
    # A cell asks at the times of its own slice and looks ahead into the next one.
    cells = (seen.select(key, "v", "t", F.explode(F.array(
                F.struct(F.col("slice").alias("cell"), F.lit(True).alias("own")),
                F.struct((F.col("slice") - 1).alias("cell"), F.lit(False).alias("own")))).alias("c"))
             .select(key, "v", "t", "c.cell", "c.own")
             .repartition(key, "cell"))
    previous = F.lag("t").over(Window.partitionBy(key, "cell", "v").orderBy("t"))
    t, own, known = F.col("t"), F.col("own"), F.col("v").isNotNull()
    opens = F.greatest(t - width, F.coalesce(previous + 1, t - width))
    end = (F.col("cell") + 1) * width
    points = (cells.withColumn("opens", opens)
              .select(key, "cell", F.explode(F.filter(F.array(
                  F.struct(F.col("opens").alias("p"), known.cast("int").alias("delta"),
                           F.lit(False).alias("asked")),
                  F.struct(t.alias("p"), F.lit(0).alias("delta"), own.alias("asked")),
                  F.struct((t + 1).alias("p"), (-known.cast("int")).alias("delta"),
                           F.lit(False).alias("asked"))),
                  lambda s: (s["asked"] | (s["delta"] != 0)) & (s["p"] < end))).alias("s"))
              .select(key, "cell", "s.p", "s.delta", "s.asked"))
    return _running(points, key, [])


def count_behind(events: DataFrame, key: str, ts: str, counted: Column, asked: Column,
                 width_us: int, payload: Column) -> DataFrame:
    """For every time t of an `asked` event: `counted` events in [t - width, t], both ends included.

    Returns (key, at_us, n, payload); payload is the least one among the asked events at t.
    """
    width = F.lit(width_us)
    merged = (events.where(counted | asked)
              .select(key, micros(ts).alias("t"), counted.alias("is_counted"),
                      asked.alias("is_asked"), payload.alias("payload"))
              .where(F.col("t").isNotNull())
              .withColumn("slice", slice_of(F.col("t"), width_us))
              .groupBy(key, "slice", "t")
              .agg(F.count_if("is_counted").alias("w"),
                   F.bool_or("is_asked").alias("asked"),
                   F.min(F.when(F.col("is_asked"), F.col("payload"))).alias("payload")))
    t, w, none = F.col("t"), F.col("w"), F.lit(None)
    following = (F.col("slice") + 1) * width
    points = (merged.select(key, "payload", F.explode(F.filter(F.array(
                  F.struct(F.col("slice").alias("cell"), t.alias("p"), w.alias("delta"),
                           F.col("asked").alias("asked")),
                  F.struct((F.col("slice") + 1).alias("cell"), following.alias("p"), w.alias("delta"),
                           F.lit(False).alias("asked")),
                  F.struct((F.col("slice") + 1).alias("cell"), (t + width + 1).alias("p"),
                           (-w).alias("delta"), F.lit(False).alias("asked"))),
                  lambda s: s["asked"] | (s["delta"] != 0))).alias("s"))
              .select(key, "s.cell", "s.p", "s.delta", "s.asked",
                      F.when(F.col("s.asked"), F.col("payload")).alias("payload")))
    return _running(points, key, ["payload"])


def longest_run(events: DataFrame, key: str, ts: str, order: list[str], hit: Column,
                width_us: int, heavy: DataFrame) -> DataFrame:
    """Longest run of consecutive `hit` rows per key, in the order (ts, *order).

    The keys listed in `heavy` are cut into time slices, all others are one slice. Runs are
    found inside slices; only the run at either edge of a slice can go on in a neighbour, so
    the second step sees one row per slice and never the events.
    """
    order_cols = ["t", *order]
    rows = (events.select(key, micros(ts).alias("t"), *order,
                          F.coalesce(hit, F.lit(False)).alias("hit"))
            .join(heavy, key, "left")
            .withColumn("slice", F.when(F.col("_parts").isNull(), F.lit(0))
                        .otherwise(slice_of(F.col("t"), width_us))))
    breaks = F.sum((~F.col("hit")).cast("long")).over(
        Window.partitionBy(key, "slice").orderBy(*order_cols)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = (rows.withColumn("run", breaks)
            .groupBy(key, "slice", "run").agg(F.count_if("hit").alias("len")))
    edges = (runs.groupBy(key, "slice")
             .agg(F.max("run").alias("breaks"), F.max("len").alias("inner"),
                  F.max(F.when(F.col("run") == 0, F.col("len"))).alias("head"),
                  F.max_by("len", "run").alias("tail")))
    before = F.coalesce(F.sum("breaks").over(
        Window.partitionBy(key).orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = (edges.withColumn("before", before)
              .select(key, "inner", F.explode(F.filter(F.array(
                  F.struct(F.col("before").alias("run"), F.coalesce("head", F.lit(0)).alias("len")),
                  F.struct(F.when(F.col("breaks") > 0, F.col("before") + F.col("breaks")).alias("run"),
                           F.col("tail").alias("len"))),
                  lambda s: s["run"].isNotNull())).alias("s"))
              .select(key, "inner", "s.run", "s.len"))
    joined = pieces.groupBy(key, "run").agg(F.sum("len").alias("len"), F.max("inner").alias("inner"))
    return joined.groupBy(key).agg(F.greatest(F.max("len"), F.max("inner")).alias("longest"))
