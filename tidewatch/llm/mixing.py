"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A source whose target is r times its size takes floor(r) whole copies of each of its documents. The
rest of the target is a sample without replacement: document k has inclusion probability
p_k = r - floor(r) and rank (u / (1 - u)) / (p_k / (1 - p_k)), u being a random number fixed by the
document; documents are taken in rank order until the words left over are used up. The sample is of
a fixed size in words. The document that would exceed it is passed over, and the gap it leaves is
filled with at most one further document for each power of two, large ones first.

A source may hold a third of all rows: its ranks are never sorted as a whole. Words are summed in
RANK_BINS bins of the rank, and only the bin in which the target falls is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
RANK_BINS = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_key(doc_id: Column, text: Column) -> Column:
    """What the random number of a document depends on: its id and text, nothing else."""
    return F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def uniform(key: Column) -> Column:
    """52 bits of the key as a number strictly between 0 and 1."""
    return (F.conv(F.substring(key, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size): shares by weight, none above `most_copies` sizes.

    Sources in code point order, null last, take the weights in turn. Sharing the excess again until
    no target is too large fills the sources to one level: target = min(cap, level * weight). The
    level is found by going through the sources by cap / weight. One row per source is sorted here.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int") + 1).cast("long")
    per = per.withColumn("weight", weight).withColumn("cap", F.lit(most_copies) * F.col("source_size"))
    per = per.withColumn("full_at", F.col("cap") / F.col("weight"))
    everything = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    per = per.withColumn("place", F.row_number().over(everything))
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    after = everything.rowsBetween(0, Window.unboundedFollowing)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    per = per.withColumn("level", left / F.sum("weight").over(after))
    first = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("place", "level"))).over(whole)
    per = per.withColumn("first", first)
    target = F.when(F.col("place") < F.col("first.place"), F.col("cap").cast("double")).otherwise(F.col("first.level") * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def _ranked(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows (source, size, key, ...) with their source's copies and their own rank in (0, 1)."""
    t = targets.select(F.col("source").alias("target_source"), "source_size", "target",
                       F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("copies"),
                       F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("times"))
    t = t.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")).withColumn("p", F.col("times") - F.col("copies"))
    joined = rows.join(t, rows["source"].eqNullSafe(t["target_source"])).drop("target_source", "times")
    u = uniform(F.col("key"))
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    rank = F.when(F.col("p") > 0, odds / (1 + odds))
    return joined.withColumn("rank", rank).withColumn("bin", F.floor(F.col("rank") * RANK_BINS))


def sampling_plan(sizes: DataFrame, weights=WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """One row per source: its target, whole copies, where its sample ends, and the keys that fill the gap."""
    targets = cut_lineage(source_targets(sizes, weights, most_copies), "targets")
    ranked = _ranked(sizes, targets).where("rank is not null")
    bins = ranked.groupBy("source", "bin", "rest").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bin")
    bins = bins.withColumn("end", F.sum("words").over(upto)).where("end > rest")
    last = bins.groupBy("source").agg(F.min(F.struct("bin", (F.col("end") - F.col("words")).alias("before"))).alias("last"))
    last = cut_lineage(last.select(F.col("source").alias("s"), F.col("last.bin").alias("last_bin"), F.col("last.before").alias("before")), "last-bins")
    in_last = ranked.join(last, ranked["source"].eqNullSafe(last["s"]) & (ranked["bin"] == last["last_bin"]))
    # rows of equal key are copies of one row; the frame takes them together
    in_last = in_last.withColumn("end", F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("rank", "key")))
    cut = in_last.where("end <= rest").groupBy("source").agg(F.max(F.struct("end", "rank", "key")).alias("cut"))
    cut = cut.select(F.col("source").alias("c"), "cut")
    ends = last.join(cut, last["s"].eqNullSafe(cut["c"]), "left").select(
        "s", "last_bin", F.coalesce("cut.end", "before").alias("sampled"), F.col("cut.rank").alias("cut_rank"), F.col("cut.key").alias("cut_key"))
    ends = cut_lineage(ends, "sample-ends")
    gap = F.col("rest") - F.col("sampled")
    left_out = ranked.join(ends, ranked["source"].eqNullSafe(ends["s"])).where(~_in_sample() & (F.col("size") > 0) & (F.col("size") <= gap))
    fills = (left_out.groupBy("source", F.floor(F.log2("size")).alias("class")).agg(F.max(F.struct("size", "key")).alias("f"), F.min(gap).alias("gap"))
             .groupBy("source").agg(F.sort_array(F.collect_list("f"), asc=False).alias("f"), F.min("gap").alias("gap")))
    start = F.struct(F.col("gap").alias("gap"), F.array().cast("array<string>").alias("keys"))
    filled = F.aggregate("f", start, lambda state, f: F.when(
        f["size"] <= state["gap"], F.struct((state["gap"] - f["size"]).alias("gap"), F.array_append(state["keys"], f["key"]).alias("keys"))).otherwise(state))
    fills = fills.select(F.col("source").alias("f_s"), filled["keys"].alias("fills"))
    plan = targets.join(ends, targets["source"].eqNullSafe(ends["s"]), "left")
    plan = plan.join(fills, plan["source"].eqNullSafe(fills["f_s"]), "left")
    return cut_lineage(plan.drop("s", "f_s").withColumnRenamed("source", "plan_source"), "mixing-plan")


def _in_sample() -> Column:
    in_order = (F.col("rank") < F.col("cut_rank")) | ((F.col("rank") == F.col("cut_rank")) & (F.col("key") <= F.col("cut_key")))
    return (F.col("last_bin").isNull() | (F.col("bin") < F.col("last_bin"))
            | ((F.col("bin") == F.col("last_bin")) & F.coalesce(in_order, F.lit(False))))


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with source_size, target and `times`, the number of copies the mix takes."""
    targets = plan.select(F.col("plan_source").alias("source"), "source_size", "target")
    ranked = _ranked(rows, targets)
    ends = plan.select("plan_source", "last_bin", "cut_rank", "cut_key", "fills")
    joined = ranked.join(ends, ranked["source"].eqNullSafe(ends["plan_source"]))
    extra = F.col("rank").isNotNull() & (_in_sample() | F.coalesce(F.array_contains("fills", F.col("key")), F.lit(False)))
    return joined.withColumn("times", F.col("copies") + extra.cast("long"))


def sizes_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    return docs.select(id_.cast("long").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                       word_count(text).alias("size"), draw_key(id_, text).alias("key"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights=WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, copies), one row per row of `docs`.

    size counts runs without white space (0 for null and empty texts). Null is a source like any
    other, the last one. A source without words has target 0. Rows that agree in id and text have
    one random number and are taken together. The same rows give the same mix in every run and in
    any partitioning. An empty table gives an empty result.
    """
    sizes = cut_lineage(sizes_of(docs, id_col, text_col, source_col), "sizes")
    return _taken(sizes, sampling_plan(sizes, weights, most_copies)).select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "source",
        F.col("times").alias("copies"))


def mix_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """The rows of `docs`, all columns, each as often as the mix takes it (not at all for 0)."""
    sizes = cut_lineage(sizes_of(docs, id_col, text_col, source_col), "sizes")
    plan = sampling_plan(sizes, weights, most_copies)
    id_, text = F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`").cast("string")
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col(f"row.`{source_col}`").cast("string").alias("source"), word_count(text).alias("size"), draw_key(id_, text).alias("key"))
    return (_taken(rows, plan).where("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
            .select("row.*"))


ORACLE = r"""
with sizes as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))) as key from documents),
per as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][1 + (row_number() over (order by source asc nulls last) - 1) % 3]::bigint as weight from sizes group by source),
caps as (select *, 3 * source_size as cap, (3 * source_size)::double / weight as full_at from per),
levels as (
  select *, row_number() over o as place,
         ((sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))::double)
           / (sum(weight) over (o rows between current row and unbounded following))::double as level
  from caps window o as (order by full_at, source asc nulls last)),
found as (select min(place) as p from levels where level <= full_at),
targets as (
  select source, source_size, case when place < p then cap::double
           else (select level from levels, found where place = p) * weight end as target from levels, found),
ranked as (
  select s.*, source_size, target, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as copies,
         case when source_size > 0 then target / source_size else 0.0 end as r,
         ((('0x' || substr(key, 1, 13))::bigint)::double + 0.5) / 4503599627370496.0 as u
  from sizes s join targets t on s.source is not distinct from t.source),
odds as (
  select *, target - copies * source_size as rest, r - copies as p,
         case when r - copies > 0 then (u / (1 - u)) / ((r - copies) / (1 - (r - copies))) end as o from ranked),
placed as (
  select *, o / (1 + o) as rank from odds),
summed as (
  select *, sum(size) over (partition by source order by rank, key) as upto from placed where rank is not null),
-- ranks are cut where the running words first exceed the rest
cut as (select source, min(rank) as over_rank from summed where upto > rest group by source),
marked as (
  select s.*, over_rank is null or s.upto <= rest and (s.rank < over_rank or s.rank = over_rank) as sampled
  from summed s left join cut c on s.source is not distinct from c.source),
gaps as (select source, min(rest) - coalesce(sum(case when sampled then size end), 0) as gap from marked group by source),
classes as (
  select m.source, gap, max({'size': m.size, 'key': m.key}) as f
  from marked m join gaps g on m.source is not distinct from g.source
  where not sampled and m.size > 0 and m.size <= gap group by m.source, gap, floor(log2(m.size))),
listed as (select source, gap, list(f order by f desc) as fs from classes group by source, gap),
recursive_fill as (
  with recursive go(source, gap, fs, i, keys) as (
    select source, gap::double, fs, 1, []::varchar[] from listed
    union all
    select source, case when fs[i].size <= gap then gap - fs[i].size else gap end, fs, i + 1,
           case when fs[i].size <= gap then list_append(keys, fs[i].key) else keys end
    from go where i <= len(fs))
  select source, keys from go where i = len(fs) + 1)
select p.doc_id, p.size, p.source_size, p.target,
       (p.copies + case when coalesce(m.sampled, false) or coalesce(list_contains(f.keys, p.key), false) then 1 else 0 end) * p.size as taken
from placed p
left join (select distinct source, key, sampled from marked) m on p.source is not distinct from m.source and p.key = m.key
left join recursive_fill f on p.source is not distinct from f.source
"""
