"""Hierarchical multi-length packing of tokenised documents into sequences of at most CONTEXT ids.

    packed(documents)           one row per piece: doc_id, start, length, ids_crc32, doc_tokens,
                                sequence_id, offset, tier, padded, step

A document's ids are those of a public byte-level BPE vocabulary (its path is a parameter; no special
tokens added; the rank file of the same vocabulary, which gives the ids of its tokenizers file) followed by END_ID. Routing by length, in tiers of powers of two:
  * every whole CONTEXT ids of a document make one full sequence of the top tier (no padding);
  * a remainder above CONTEXT / 2 opens a long window of its own, whose gap (under CONTEXT / 2) is open;
  * shorter remainders keep their tier (the power of two that holds them) and are poured, larger tiers
    first, into the gaps of the long windows; a piece is cut where a gap ends;
  * what the gaps cannot take is packed tier after tier into fresh sequences of CONTEXT, cut at their ends.
Pouring is exact and linear: gaps and short pieces get positions from prefix sums (range-partitioned
sort, one partial sum per task, offsets from the small table of task totals); each piece part then finds
its gap by an as-of lookup inside blocks of BLOCK positions (each block starts with the gap and the piece
that cover it), so no group is larger than a block.
A sequence is padded to the power of two that holds it (`padded`; CONTEXT for all but the last fresh one
and unfilled windows' tiers). Step groups: sequences dealt snake-wise by their length over groups of
STEP sequences, so that every step holds about the same number of ids.

Defined cases: null text is empty and gives the single id END_ID; very long texts are cut into as many full
sequences as they fill; repeated rows are separate documents (with equal doc_id); an empty table gives no
rows; only doc_id and text are read, so other columns cannot clash. Each id lies in exactly one piece.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidewatch.session import cut_lineage

CONTEXT = 1024
END_ID = 0
BLOCK = 1024
STEP = 8
#: Characters of text tokenised at once in a task, so that its memory is bounded whatever the batch.
CHUNK_CHARS = 1_000_000
VOCABULARY = "byte_bpe_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _encoder(ranks_path: str):
    """The byte-level BPE of the vocabulary as tiktoken ranks: the same ids as the tokenizers file, about four
    times less CPU (README has the figures); special tokens are not recognised, so their text is ordinary text."""
    import base64

    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _tokenised(docs: DataFrame, ranks_path: str) -> DataFrame:
    """(rk, doc_id, n, full_crcs, rest_crc, tail) per row; rk numbers the rows of the scan.

    n counts the ids with END_ID. The pieces of whole contexts and the remainder are known here, so their
    checksums are made here; only a short remainder (at most CONTEXT / 2 ids, cut later) keeps its ids.
    """
    def encode(batches):
        enc = _encoder(ranks_path)
        for b in batches:
            texts = b.column("text").to_pylist()
            sizes = np.cumsum([len(t or "") for t in texts])
            lo = 0
            while lo < len(texts):  # pieces of about CHUNK_CHARS characters, at least one text
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + CHUNK_CHARS, "right")))
                n, full, rest, tails = [], [], [], []
                for e in enc.encode_ordinary_batch([t or "" for t in texts[lo:hi]], num_threads=1):
                    ids = np.empty(len(e) + 1, "<u4")
                    ids[:-1] = e
                    ids[-1] = END_ID
                    q = len(ids) // CONTEXT
                    n.append(len(ids))
                    full.append([zlib.crc32(ids[k * CONTEXT:(k + 1) * CONTEXT].tobytes()) for k in range(q)])
                    tail = ids[q * CONTEXT:]
                    rest.append(zlib.crc32(tail.tobytes()) if len(tail) else None)
                    tails.append(tail.astype(np.int32) if 0 < len(tail) <= CONTEXT // 2 else None)
                yield pa.RecordBatch.from_arrays(
                    [b.column("rk").slice(lo, hi - lo), b.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()),
                     pa.array(full, pa.list_(pa.int64())), pa.array(rest, pa.int64()), pa.array(tails, pa.list_(pa.int32()))],
                    ["rk", "doc_id", "n", "full_crcs", "rest_crc", "tail"])
                lo = hi

    # the scan's partitions are the same in every attempt, so the row numbers are too
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                       F.monotonically_increasing_id().alias("rk"))
    return rows.mapInArrow(encode, "rk long, doc_id long, n long, full_crcs array<long>, rest_crc long, tail array<int>")


def _prefix(df: DataFrame, keys: list, value: str, name: str) -> DataFrame:
    """df with `_at`, the sum of `value` over all rows before it in `keys` order (exclusive)."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType(df.schema.fields + [StructField("_p", IntegerType()), StructField("_local", LongType())])

    def local(batches):
        from pyspark import TaskContext
        p, run = TaskContext.get().partitionId(), 0
        for b in batches:
            v = b.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            before = run + np.concatenate([[0], np.cumsum(v)[:-1]]) if len(v) else v
            run += int(v.sum())
            yield pa.RecordBatch.from_arrays(b.columns + [pa.array(np.full(len(v), p, np.int32)), pa.array(before)],
                                             b.schema.names + ["_p", "_local"])

    laid = cut_lineage(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(local, schema), name)
    totals = laid.groupBy("_p").agg(F.sum(value).alias("_total"))
    offsets = totals.select("_p", F.coalesce(F.sum("_total").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    return laid.join(offsets, "_p").withColumn("_at", F.col("_offset") + F.col("_local")).drop("_p", "_local", "_offset")


def _tier(length) -> F.Column:
    """The smallest power of two that holds `length` ids (1 to CONTEXT), in integers."""
    out = F.lit(CONTEXT).cast("long")
    size = CONTEXT // 2
    while size >= 1:
        out = F.when(length <= size, F.lit(size).cast("long")).otherwise(out)
        size //= 2
    return out


def packed(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    tokens = cut_lineage(_tokenised(docs, vocabulary or vocabulary_path()), "pack-ids")
    counts = tokens.select("rk", "n", (F.col("n") / CONTEXT).cast("long").alias("q"),
                           (F.col("n") % CONTEXT).alias("m"), "full_crcs", "rest_crc")
    # full sequences: numbered by a prefix sum of whole contexts over the rows
    full_docs = _prefix(counts.where(F.col("q") > 0), [F.col("rk")], "q", "pack-full")
    full = full_docs.select("rk", F.posexplode("full_crcs").alias("k", "ids_crc32"), F.col("_at").alias("base")).select(
        "rk", (F.col("k") * CONTEXT).alias("start"), F.lit(CONTEXT).cast("long").alias("length"),
        (F.col("base") + F.col("k")).alias("seq"), F.lit(0).cast("long").alias("offset"), "ids_crc32")
    n_full = full_docs.agg(F.coalesce(F.sum("q"), F.lit(0))).first()[0]
    rest = counts.where(F.col("m") > 0).select("rk", (F.col("q") * CONTEXT).alias("start"), F.col("m").alias("length"),
                                               "rest_crc")
    # long windows: one sequence each, numbered after the full ones; gaps get positions in gap space
    long_ = _prefix(rest.where(F.col("length") > CONTEXT // 2).withColumn("_one", F.lit(1).cast("long")),
                    [F.col("rk")], "_one", "pack-long")
    long_ = cut_lineage(_prefix(long_.select("rk", "start", "length", "rest_crc", (F.col("_at") + n_full).alias("seq"),
                                             (CONTEXT - F.col("length")).alias("gap")),
                                [F.col("seq")], "gap", "pack-gaps"), "pack-long-at")
    windows = long_.select("rk", "start", "length", "seq", F.lit(0).cast("long").alias("offset"),
                           F.col("rest_crc").alias("ids_crc32"))
    n_long, gaps = long_.agg(F.count(F.lit(1)), F.coalesce(F.sum("gap"), F.lit(0))).first()
    # short pieces, larger tiers first, get positions in the poured stream
    short = rest.where(F.col("length") <= CONTEXT // 2).drop("rest_crc").withColumn("tier", _tier(F.col("length")))
    short = cut_lineage(_prefix(short, [F.col("tier").desc(), F.xxhash64("rk"), F.col("rk")], "length", "pack-short"),
                        "pack-short-at")
    filled = _poured(long_, short, min(gaps, short.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]))
    leftover = _leftover(short, gaps, n_full + n_long)
    parts = _checksums(filled.unionByName(leftover), tokens)
    pieces = cut_lineage(full.unionByName(windows).unionByName(parts), "pack-pieces")
    return _finish(pieces, tokens)


def _split(parts: DataFrame, pos: str, length: str, width: int) -> DataFrame:
    """Rows of parts (at most `width` long) cut where they cross a multiple of `width`: `pos`, `length` adjusted."""
    first = F.least(F.col(length), F.lit(width) - F.col(pos) % width)
    return parts.select("*", F.explode(F.array(
        F.struct(F.lit(0).cast("long").alias("_skip"), first.alias("_len")),
        F.struct(first.alias("_skip"), (F.col(length) - first).alias("_len")))).alias("_c")
    ).where(F.col("_c._len") > 0)


def _poured(long_: DataFrame, short: DataFrame, end: int) -> DataFrame:
    """Parts of short pieces in the gaps of long windows: an as-of lookup of the gap at each part's start.

    `end` is where pouring stops: the smaller of the gaps' and the short pieces' totals.
    """
    gap_ev = _split(long_.select("seq", F.col("_at").alias("pos"), F.col("gap").alias("len"),
                                 F.col("length").alias("base")).where(F.col("pos") < end), "pos", "len", BLOCK).select(
        (F.col("pos") + F.col("_c._skip")).alias("pos"), F.lit(0).alias("kind"), "seq",
        (F.col("base") + F.col("_c._skip")).alias("g_off"), F.lit(None).cast("long").alias("rk"),
        F.lit(None).cast("long").alias("d_start"))
    in_gaps = short.where(F.col("_at") < end).select(
        "rk", "start", F.col("_at").alias("pos"), F.least(F.col("length"), F.lit(end) - F.col("_at")).alias("len"))
    piece_ev = _split(in_gaps, "pos", "len", BLOCK).select(
        (F.col("pos") + F.col("_c._skip")).alias("pos"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("seq"),
        F.lit(None).cast("long").alias("g_off"), "rk", (F.col("start") + F.col("_c._skip")).alias("d_start"))
    ev = gap_ev.unionByName(piece_ev).where(F.col("pos") < end).withColumn("block", (F.col("pos") / BLOCK).cast("long"))
    w = Window.partitionBy("block").orderBy("pos", "kind")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    block_end = F.least((F.col("block") + 1) * BLOCK, F.lit(end))
    ev = (ev.withColumn("nxt", F.coalesce(F.lead("pos").over(w), block_end))
          .withColumn("g_pos", F.last(F.when(F.col("kind") == 0, F.col("pos")), True).over(upto))
          .withColumn("g_seq", F.last("seq", True).over(upto))
          .withColumn("g_base", F.last("g_off", True).over(upto))
          .withColumn("p_pos", F.last(F.when(F.col("kind") == 1, F.col("pos")), True).over(upto))
          .withColumn("p_rk", F.last("rk", True).over(upto))
          .withColumn("p_start", F.last("d_start", True).over(upto)))
    return ev.where(F.col("nxt") > F.col("pos")).select(
        F.col("p_rk").alias("rk"), (F.col("p_start") + F.col("pos") - F.col("p_pos")).alias("start"),
        (F.col("nxt") - F.col("pos")).alias("length"), F.col("g_seq").alias("seq"),
        (F.col("g_base") + F.col("pos") - F.col("g_pos")).alias("offset"))


def _leftover(short: DataFrame, gaps: int, first_seq: int) -> DataFrame:
    """What the gaps cannot take, packed in order into fresh sequences of CONTEXT."""
    over = short.where(F.col("_at") + F.col("length") > gaps).select(
        "rk", F.greatest(F.col("_at"), F.lit(gaps)).alias("pos"),
        (F.col("start") + F.greatest(F.lit(0), F.lit(gaps) - F.col("_at"))).alias("d_start"),
        (F.col("_at") + F.col("length") - F.greatest(F.col("_at"), F.lit(gaps))).alias("len"))
    over = over.withColumn("pos", F.col("pos") - gaps)
    return _split(over, "pos", "len", CONTEXT).select(
        "rk", (F.col("d_start") + F.col("_c._skip")).alias("start"), F.col("_c._len").alias("length"),
        (F.lit(first_seq) + ((F.col("pos") + F.col("_c._skip")) / CONTEXT).cast("long")).alias("seq"),
        ((F.col("pos") + F.col("_c._skip")) % CONTEXT).alias("offset"))


def _checksums(parts: DataFrame, tokens: DataFrame) -> DataFrame:
    """Parts of short remainders with the checksum of their ids, read from the remainder's own ids."""
    def checksum(batches):
        for b in batches:
            tail = b.column("tail")
            bounds, values = tail.offsets.to_numpy(), tail.values.to_numpy(zero_copy_only=False).astype("<u4")
            at = (b.column("start").to_numpy() - b.column("base").to_numpy())
            length = b.column("length").to_numpy()
            crc = [zlib.crc32(values[bounds[i] + at[i]:bounds[i] + at[i] + length[i]].tobytes()) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("rk", "start", "length", "seq", "offset")]
                                             + [pa.array(crc, pa.int64())],
                                             ["rk", "start", "length", "seq", "offset", "ids_crc32"])

    tails = tokens.where(F.col("tail").isNotNull()).select(
        "rk", "tail", ((F.col("n") / CONTEXT).cast("long") * CONTEXT).alias("base"))
    return parts.join(tails, "rk").select("rk", "start", "length", "seq", "offset", "tail", "base").mapInArrow(
        checksum, "rk long, start long, length long, seq long, offset long, ids_crc32 long")


def _finish(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pieces with their ids' checksum, the document's size, the sequence's padding and step group."""
    seqs = pieces.groupBy("seq").agg(F.sum("length").alias("used"))
    ranked = _prefix(seqs.withColumn("_one", F.lit(1).cast("long")), [F.col("used").desc(), F.col("seq")], "_one",
                     "pack-seqs")
    groups = max(1, -(-ranked.count() // STEP))
    lap, at = (F.col("_at") / groups).cast("long"), F.col("_at") % groups
    seq_info = ranked.select("seq", _tier(F.col("used")).alias("padded"),
                             F.when(lap % 2 == 0, at).otherwise(groups - 1 - at).alias("step"))

    docs = tokens.select("rk", "doc_id", F.col("n").alias("doc_tokens"))
    return (pieces.join(docs, "rk").join(seq_info, "seq")
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("seq").alias("sequence_id"),
                    "offset", _tier(F.col("length")).alias("tier"), "padded", "step"))
