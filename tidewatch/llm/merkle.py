"""Merkle manifest of a document table: leaves, per-source subroots, one root, and a proof per row.

    manifest(documents)         doc_id, leaf, subroot, root, proof_sha256, folded_root, verified

H is the lowercase hex sha256 of its inputs concatenated (digests as hex text). A leaf is H of doc_id,
source, lang, n_chars and text, each written `-` if null, else as its UTF-8 byte count, `:`, value.

Rollup by rank digits: each row gets its rank r within its source (ascending doc_id, then leaf, nulls
first) from a range-partitioned sort with per-partition offsets, so a source of a third of all rows is
spread over many tasks. Level L+1 groups away the lowest base-FANOUT digit of the level-L rank: the
group (source, r >> 4) nests its at most FANOUT children as structs (position, digest) and becomes
their H. A source stops when one node remains (its subroot; a lone leaf is its own subroot). Subroots,
ordered by source (null first, bytewise), roll up the same way to the root.

Proofs: every group row emits, by transform and explode, each child's siblings (left and right of it).
These sibling entries are carried down level by level with one key join each (child rank >> 4 to its
parent's rank): each join meets at most FANOUT children per parent, and the levels shrink by FANOUT.
A leaf's path is its entries bottom-up, then its source's entries in the tree of subroots. What a source
hands to all its leaves (those entries and the subroot) joins its top node, one row, and goes down with the
entries, so no join of all leaves is by source.
proof_sha256 is H of all siblings in that order; folded_root folds the tampered leaf with the original
siblings; verified compares it with the root.

Tampering (the check of the proofs): where FANOUT_TAMPER divides crc32 of the decimal doc_id, text has
its A-Z lower-cased; other rows, null texts and null ids are unchanged.

Defined cases: nulls in any column are written `-` and sort first; an empty table gives no rows;
repeated rows are separate leaves with equal digests; a table of one row has root = leaf and the proof
H of the empty string. Only the five fields are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage

FANOUT = 16
FANOUT_TAMPER = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SHIFT = FANOUT.bit_length() - 1  # FANOUT is a power of two
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _h(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return _h(*[_field(c) for c in (doc_id, source, lang, n_chars, text)])


def _ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """df with r (0-based rank within `group` by `order`, nulls first) and c (group size).

    Sorted by range partitions; each task numbers its own rows, and the small table of (partition,
    group) counts gives every run its offset, so no group is gathered into one task.
    """
    keys = [F.col(group).asc_nulls_first()] + [F.col(o).asc_nulls_first() for o in order]
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = (df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
            .withColumn("_p", F.spark_partition_id())
            .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    laid = cut_lineage(laid, "merkle-laid")
    runs = laid.groupBy("_p", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    w = Window.partitionBy(group).orderBy("_p")
    runs = (runs.withColumn("_before", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("c", F.sum("_n").over(Window.partitionBy(group))))
    joined = laid.join(runs.withColumnRenamed(group, "_g"), (laid["_p"] == runs["_p"]) & laid[group].eqNullSafe(F.col("_g")))
    return joined.select(*[laid[c] for c in df.columns],
                         (F.col("_before") + laid["_pos"] - F.col("_first")).alias("r"), F.col("c"))


def _levels(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Group rows of every level (g, pr, kids, digest, c) and the tops (g, digest, depth: at which level), from (g, r, digest, c)."""
    levels, tops = [], []
    nodes = cut_lineage(nodes, f"{name}-0")
    while True:
        tops.append(nodes.where(F.col("c") == 1).select("g", "digest", F.lit(len(levels)).alias("depth")))
        active = nodes.where(F.col("c") > 1)
        if active.isEmpty():
            break
        grouped = (active.groupBy("g", F.shiftright("r", _SHIFT).alias("pr"))
                   .agg(F.array_sort(F.collect_list(F.struct(F.col("r").bitwiseAND(FANOUT - 1).alias("pos"), "digest"))).alias("kids"),
                        F.first("c").alias("child_c")))
        grouped = grouped.select("g", "pr", "kids",
                                 F.sha2(F.concat_ws("", F.transform("kids", lambda k: k["digest"])), 256).alias("digest"),
                                 F.floor((F.col("child_c") + FANOUT - 1) / FANOUT).cast("long").alias("c"))
        grouped = cut_lineage(grouped, f"{name}-{len(levels) + 1}")
        levels.append(grouped)
        nodes = grouped.select("g", F.col("pr").alias("r"), "digest", "c")
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return levels, top


def _siblings(level: DataFrame) -> DataFrame:
    """(g, r, left, right) of every child of a level's groups: the digests before and after it."""
    digests = F.transform("kids", lambda k: k["digest"])
    entry = F.transform("kids", lambda k, i: F.struct(
        k["pos"].alias("pos"),
        F.concat_ws("", F.slice(digests, 1, i)).alias("left"),
        F.concat_ws("", F.slice(digests, i + 2, F.size("kids") - i - 1)).alias("right")))
    return (level.select("g", "pr", F.explode(entry).alias("e"))
            .select("g", (F.shiftleft("pr", _SHIFT) + F.col("e.pos")).alias("r"), "e.left", "e.right"))


def _upper_paths(levels: list[DataFrame], anchors: DataFrame, depth: int, name: str) -> DataFrame:
    """(g, r, path, subroot) of the nodes at level `depth`: sibling entries bottom-up to the group's top, then the anchor's.

    An anchor (g, depth, path, subroot) says at which level a group's top is and what follows there; it goes down
    with the paths. Tables shrink by FANOUT a level, so the joins are cheap.
    """
    tops = lambda at: anchors.where(F.col("depth") == at).select("g", F.lit(0).cast("long").alias("r"), "path", "subroot")
    up = tops(len(levels))
    for at in range(len(levels) - 1, depth - 1, -1):
        here = _siblings(levels[at]).select("g", "r", F.array(F.struct("left", "right")).alias("own"))
        parent = up.select(F.col("g").alias("_g"), F.col("r").alias("_r"), F.col("path").alias("_up"), "subroot")
        here = (here.join(parent, here["g"].eqNullSafe(parent["_g"]) & (F.shiftright(here["r"], _SHIFT) == parent["_r"]))
                .select("g", "r", F.concat("own", "_up").alias("path"), "subroot"))
        up = cut_lineage(here.unionByName(tops(at)), f"{name}-path-{at}")
    return up


def _own_siblings(kids: str, pos: Column) -> Column:
    """struct(left, right): the digests of a group's children before and after position `pos`."""
    digests = F.transform(kids, lambda k: k["digest"])
    return F.struct(F.concat_ws("", F.slice(digests, 1, pos)).alias("left"),
                    F.concat_ws("", F.slice(digests, pos + 2, F.size(kids) - pos - 1)).alias("right"))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of `docs`."""
    cols = [F.col(f) for f in FIELDS]
    text = F.col("text")
    tamper = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % FANOUT_TAMPER == 0)
    leaves = docs.select(*cols).select(
        F.col("doc_id"), F.col("source").alias("g"),
        leaf_digest(*cols).alias("digest"),
        leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"),
                    F.when(tamper, F.translate(text, _UPPER, _LOWER)).otherwise(text)).alias("tampered"))
    ranked = _ranked(cut_lineage(leaves, "merkle-leaves"), "g", ["doc_id", "digest"])
    levels, subroots = _levels(ranked.select("g", "r", "digest", "c"), "merkle")
    # the tree of subroots: one group, ranked by source
    sub = subroots.select(F.lit(0).alias("one"), F.col("g").alias("src"), "digest", "depth")
    src_ranked = _ranked(sub, "one", ["src"])
    src_levels, top = _levels(src_ranked.select(F.col("one").alias("g"), "r", "digest", "c"), "merkle-src")
    root_rows = top.select("digest").collect()  # one row at most: the root
    if not root_rows:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                "folded_root string, verified boolean")
    root = root_rows[0]["digest"]
    empty_path = F.array().cast("array<struct<left:string,right:string>>")
    above = docs.sparkSession.range(1).select(  # above the tree of subroots nothing follows
        F.lit(0).alias("g"), F.lit(len(src_levels)).alias("depth"), empty_path.alias("path"), F.lit(root).alias("subroot"))
    src_paths = _upper_paths(src_levels, above, 0, "merkle-src").select(F.col("r").alias("_r"), "path")
    anchors = cut_lineage(src_ranked.join(src_paths, F.col("r") == F.col("_r"))
                          .select(F.col("src").alias("g"), "depth", "path", F.col("digest").alias("subroot")), "merkle-anchors")
    # a leaf's own siblings come from its parent's children in the only join of all leaves; what follows above them, to
    # the root, is written for the parents (FANOUT times fewer rows), never one of every leaf
    rows = ranked.select("doc_id", "g", "r", F.col("digest").alias("leaf"), "tampered")
    lone = anchors.where(F.col("depth") == 0).select("g", F.lit(0).cast("long").alias("pr"), "path", "subroot")
    if levels:
        upper = _upper_paths(levels, anchors, 1, "merkle").select(F.col("g").alias("_ug"), F.col("r").alias("_ur"), "path", "subroot")
        parents = (levels[0].join(upper, levels[0]["g"].eqNullSafe(F.col("_ug")) & (F.col("pr") == F.col("_ur")))
                   .select("g", "pr", "kids", "path", "subroot").unionByName(lone, allowMissingColumns=True))
    else:
        parents = lone.withColumn("kids", F.lit(None).cast("array<struct<pos:bigint,digest:string>>"))
    parents = parents.withColumnsRenamed({"g": "_g", "pr": "_pr"})
    rows = rows.join(parents, rows["g"].eqNullSafe(parents["_g"]) & (F.shiftright(rows["r"], _SHIFT) == parents["_pr"]))
    own = F.array(_own_siblings("kids", F.col("r").bitwiseAND(FANOUT - 1).cast("int")))
    path = F.when(F.col("kids").isNull(), F.col("path")).otherwise(F.concat(own, "path"))
    proof = F.sha2(F.concat_ws("", F.transform(path, lambda p: F.concat(p["left"], p["right"]))), 256)
    folded = F.aggregate(path, F.col("tampered"), lambda acc, p: F.sha2(F.concat(p["left"], acc, p["right"]), 256))
    return rows.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), proof.alias("proof_sha256"),
                       folded.alias("folded_root"), (folded == F.lit(root)).alias("verified"))
