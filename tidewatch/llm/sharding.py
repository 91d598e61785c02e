"""Sharding by a permutation-filled lookup table, in DataFrame operations only.

Every shard has a preference order over the slots of a table of prime size, a permutation fixed by
two hashes of its name. The shards take turns; in its turn a shard claims the free slot that it
ranks first. All shards so get equally many slots (give or take one), and when a shard is added or
goes, few slots change hands. A document's slot is a hash of its id, its shard what the table says.

The table has SLOTS rows, a parameter that does not depend on the data; that is what is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage

SHARDS = 16
#: A prime, over a hundred times the number of shards.
SLOTS = 2053


def _number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def lookup_table(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard), one row per slot.

    Slot c is number (c - offset) * stride mod slots in a shard's order. As slots is prime, every
    stride from 1 to slots - 1 makes this a permutation.
    """
    if shards < 1 or slots <= shards or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime above the number of shards")
    names = F.sequence(F.lit(0), F.lit(shards - 1))
    orders = F.transform(names, lambda s: F.struct(
        (_number(F.concat(F.lit("offset:"), s.cast("string")), 8) % slots).alias("offset"),
        (1 + _number(F.concat(F.lit("stride:"), s.cast("string")), 8) % (slots - 1)).alias("stride")))

    def turn(state: Column, t: Column) -> Column:
        first = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)  # noqa: E731  computes value once
        rank = lambda o: F.transform(state["free"], lambda c: (c + slots - o["offset"]) * o["stride"] % slots * slots + c)
        pick = first(F.element_at("orders", (t % shards + 1).cast("int")), lambda o: F.array_min(rank(o)) % slots)
        return first(pick, lambda c: F.struct(F.array_remove(state["free"], c).alias("free"), F.array_append(state["picks"], c).alias("picks")))

    all_slots = F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))
    start = F.struct(all_slots.alias("free"), F.array().cast("array<bigint>").alias("picks"))
    filled = spark.range(1).select(orders.alias("orders")).select(F.aggregate(F.sequence(F.lit(0), F.lit(slots - 1)), start, turn)["picks"].alias("picks"))
    turns = filled.select(F.posexplode("picks").alias("turn", "slot"))
    return cut_lineage(turns.select("slot", (F.col("turn") % shards).alias("shard")), "slots")


def slot_of(doc_id: Column, slots: int = SLOTS) -> Column:
    return _number(F.coalesce(doc_id.cast("string"), F.lit("")), 13) % slots


def placed(docs: DataFrame, id_col: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """All rows and columns of `docs` with `slot` and `shard` (replacing columns of these names).

    A row's place depends on its id alone: repeated ids meet in one shard, null ids share the slot of
    the empty text. Texts do not matter. An empty table gives an empty result.
    """
    table = F.broadcast(lookup_table(docs.sparkSession, shards, slots).withColumnRenamed("slot", "table_slot"))
    keep = [c for c in docs.columns if c not in ("slot", "shard")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), slot_of(F.col(f"`{id_col}`"), slots).alias("slot"))
    return rows.join(table, F.col("slot") == F.col("table_slot")).select("row.*", "slot", "shard")


ORACLE = f"""
with recursive prefs as (
  select s as shard, (('0x' || substr(md5('offset:' || s::varchar), 1, 8))::bigint) % {SLOTS} as off,
         1 + (('0x' || substr(md5('stride:' || s::varchar), 1, 8))::bigint) % ({SLOTS} - 1) as stride
  from range({SHARDS}) t(s)),
fill(t, free, pick) as (
  select 0::bigint, range({SLOTS}), null::bigint
  union all
  select t + 1, list_filter(free, lambda c: c != b), b
  from (select t, free, list_min(list_transform(free, lambda c: ((c + {SLOTS} - off) * stride % {SLOTS}) * {SLOTS} + c)) % {SLOTS} as b
        from fill join prefs on prefs.shard = t % {SHARDS} where t < {SLOTS})),
slots as (select pick as slot, (t - 1) % {SHARDS} as shard from fill where pick is not null)
select doc_id, slots.slot, shard
from (select doc_id, (('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 13))::bigint) % {SLOTS} as slot from documents) d
join slots on d.slot = slots.slot
"""
