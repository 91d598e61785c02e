"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix.

1. Every distinct n-gram set becomes a row of the matrix; documents with the same set share it.
2. The matrix is cut into column blocks (ranges of the n-gram hash). A block drops the columns that
   one row alone has and returns the rest, with the number of rows in each column.
3. A row links with another only if their overlap reaches t * max(sizes), so a row with fewer shared
   columns goes. Of the rest, the rarest columns are its prefix: two linked rows meet in a column of
   both prefixes. All other columns can make no new pair.
4. Rows that meet are first compared with the most central rows of each column (linear in the
   column's rows), in two turns. Pairs inside a component found so are settled; the other pairs are all compared. Pairs whose
   places in their prefixes leave too little for the bound on their sizes are discarded unseen; the
   rest by the exact overlap of both rows.

No column is capped: a large group of near copies collapses onto its hubs, and what remains are
pairs that no link settles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm import text as T
from tidewatch.llm.graph import components
from tidewatch.session import cut_lineage

N = 5
#: Links need PER_CENT * union <= 100 * overlap.
PER_CENT = 75
#: Entries of a column block; a task holds one block, about 24 bytes an entry.
BLOCK_ENTRIES = 2_000_000
#: Turns of comparing with hubs, and how many hubs a column has in each.
HUB_TURNS = (1, 8)



def _sets(texts: list[bytes | None], n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; fewer words count as one n-gram."""
    w = T.words(texts, T.NOT_SPACE, lower=True)
    hashes = w.hashes()
    counts = w.counts
    starts = T.window_starts(w.first, n)
    grams = T.sequence_hashes(hashes, starts, starts + n)
    at = np.searchsorted(starts, w.first)
    for j, count in enumerate(counts):
        if count >= n:
            yield np.unique(grams[at[j]:at[j + 1]])
        elif count:
            s, e = w.first[j:j + 1], w.first[j + 1:j + 2]
            yield T.sequence_hashes(hashes, s, e)
        else:
            yield np.zeros(0, np.uint64)


def _set_id(grams: np.ndarray) -> int:
    """A 63-bit name of a set of n-grams."""
    total = T.mix(np.array([grams.sum(dtype=np.uint64), np.bitwise_xor.reduce(T.mix(grams)), len(grams)], np.uint64))
    return int(T.mix(total[:1] * np.uint64(31) + total[1:2] * np.uint64(17) + total[2:])[0] >> np.uint64(1))


def document_sets(docs: DataFrame, n: int = N) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_id) of every keyed row; set_id is null where the set is empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64())])

    def run(batches):
        for batch in batches:
            for at, texts in T.chunks(batch.column(1)):
                sets = [(len(g), _set_id(g) if len(g) else None) for g in _sets(texts, n)]
                yield T.arrow_batch(schema, {"doc_id": batch.column(0).slice(at, len(texts)), "n_shingles": [s[0] for s in sets],
                                             "text_key": batch.column(2).slice(at, len(texts)), "set_id": [s[1] for s in sets]})

    return docs.select("doc_id", "text", "text_key").mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_id long")


def _incidence(docs: DataFrame, blocks: int, n: int) -> DataFrame:
    """The matrix by column block: rows (name and size) of a piece of the table, and its entries."""
    schema = pa.schema([("block", pa.int64()), ("sets", pa.binary()), ("sizes", pa.binary()), ("row", pa.binary()),
                        ("gram", pa.binary())])

    def run(batches):
        for batch in batches:
            for _, texts in T.chunks(batch.column(1)):
                rows = {}
                for grams in _sets(texts, n):
                    if len(grams):
                        rows.setdefault(_set_id(grams), grams)
                if not rows:
                    continue
                names = np.fromiter(rows, np.int64, len(rows))
                sizes = np.fromiter(map(len, rows.values()), np.int64, len(rows))
                grams = np.concatenate(list(rows.values()))
                row = np.repeat(np.arange(len(rows), dtype=np.uint16), sizes)
                block = (grams >> np.uint64(20)) % np.uint64(blocks)
                order = np.argsort(block, kind="stable")
                cut = np.searchsorted(block[order], np.arange(blocks + 1, dtype=np.uint64))
                out = {f.name: [] for f in schema}
                for b in np.flatnonzero(np.diff(cut)):
                    own = order[cut[b]:cut[b + 1]]
                    used, at = np.unique(row[own], return_inverse=True)
                    out["block"].append(b)
                    out["sets"].append(names[used].tobytes())
                    out["sizes"].append(sizes[used].tobytes())
                    out["row"].append(at.astype(np.uint16).tobytes())
                    out["gram"].append(grams[own].tobytes())
                yield T.arrow_batch(schema, out)

    return docs.mapInArrow(run, "block long, sets binary, sizes binary, row binary, gram binary")


def _pieces(table: pa.Table, *dtypes) -> list[list[np.ndarray]]:
    return [[np.frombuffer(v, d) for v in table.column(name).to_pylist()] for name, d in dtypes]


def _shared_columns(incidence: DataFrame, groups: int) -> DataFrame:
    """The entries of columns that two rows or more have, dealt out by row."""
    schema = pa.schema([("part", pa.int64()), ("set_id", pa.binary()), ("size", pa.binary()), ("gram", pa.binary()),
                        ("rows", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        names, sizes, rows, grams = _pieces(table, ("sets", np.int64), ("sizes", np.int64), ("row", np.uint16),
                                            ("gram", np.uint64))
        gram = np.concatenate(grams)
        name = np.concatenate([s[r] for s, r in zip(names, rows)])
        size = np.concatenate([s[r] for s, r in zip(sizes, rows)])
        order = np.lexsort((name, gram))
        gram, name, size = gram[order], name[order], size[order]
        new = np.r_[True, (gram[1:] != gram[:-1]) | (name[1:] != name[:-1])]  # equal sets count once
        gram, name, size = gram[new], name[new], size[new]
        begin = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        count = np.repeat(np.diff(np.r_[begin, len(gram)]), np.diff(np.r_[begin, len(gram)]))
        keep = count > 1
        gram, name, size, count = gram[keep], name[keep], size[keep], count[keep]
        part = name % groups
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(groups + 1))
        out = {f.name: [] for f in schema}
        for p in np.flatnonzero(np.diff(cut)):
            own = order[cut[p]:cut[p + 1]]
            for key, values in (("set_id", name), ("size", size), ("gram", gram), ("rows", count.astype(np.int64))):
                out[key].append(values[own].tobytes())
            out["part"].append(p)
        return pa.Table.from_batches([T.arrow_batch(schema, out)])

    return incidence.groupBy("block").applyInArrow(run, "part long, set_id binary, size binary, gram binary, rows binary")


def _rows(shared: DataFrame, per_cent: int) -> DataFrame:
    """Rows with enough shared columns: (set_id, size, grams, prefix, before); grams are the shared ones, sorted,
    prefix the rarest of them, before the number of columns the row alone has."""
    schema = pa.schema([("set_id", pa.int64()), ("size", pa.int64()), ("grams", pa.binary()), ("prefix", pa.list_(pa.int64())),
                        ("before", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        names, sizes, grams, counts = (np.concatenate(x) for x in _pieces(
            table, ("set_id", np.int64), ("size", np.int64), ("gram", np.uint64), ("rows", np.int64)))
        order = np.lexsort((grams, counts, names))
        names, sizes, grams = names[order], sizes[order], grams[order]
        begin = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
        out = {f.name: [] for f in schema}
        for s, e in zip(begin, np.r_[begin[1:], len(names)]):
            size = int(sizes[s])
            least = -(-per_cent * size // 100)  # of columns shared with any partner
            if e - s < least:
                continue
            out["set_id"].append(int(names[s]))
            out["size"].append(size)
            out["grams"].append(np.sort(grams[s:e]).tobytes())
            out["prefix"].append(grams[s:s + (e - s) - least + 1].view(np.int64))
            out["before"].append(size - (e - s))
        return pa.Table.from_batches([T.arrow_batch(schema, out)])

    return shared.groupBy("part").applyInArrow(run, "set_id long, size long, grams binary, prefix array<long>, before long")


def _linked(pairs: DataFrame, rows: DataFrame, per_cent: int) -> DataFrame:
    """Those of the pairs (a, b) whose exact overlap reaches the bound."""
    side = lambda x: rows.select(F.col("set_id").alias(x), F.col("size").alias(f"size_{x}"), F.col("grams").alias(f"grams_{x}"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            a, b, size_a, size_b = (batch.column(c).to_numpy() for c in ("a", "b", "size_a", "size_b"))
            keep = np.zeros(len(a), bool)
            last, left = None, None
            for i, (x, y) in enumerate(zip(batch.column("grams_a"), batch.column("grams_b"))):
                if a[i] != last:
                    last, left = a[i], np.frombuffer(x.as_buffer(), np.uint64)
                right = np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(left, right)
                overlap = int((left[np.minimum(at, len(left) - 1)] == right).sum())
                keep[i] = 100 * overlap >= per_cent * (size_a[i] + size_b[i] - overlap)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], schema=schema)

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a long, b long")


def _can_link(per_cent: int):
    """A pair meeting at these places has at most the columns from there on in common, if it has none before;
    a linked pair passes where it first meets. Also implies the bound on the sizes alone."""
    rest = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    return (100 + per_cent) * rest >= per_cent * (F.col("size_a") + F.col("size_b"))


def _side(entries: DataFrame, x: str) -> DataFrame:
    return entries.select("gram", *[F.col(c).alias(f"{n}_{x}") for c, n in (
        ("set_id", "set"), ("size", "size"), ("at", "at"), ("home", "home"), ("home_centre", "centre"))])


def _towards_hubs(entries: DataFrame, rows: DataFrame, hubs: int, per_cent: int) -> DataFrame:
    """(home, to): homes that a link with a hub joins to another home. The hubs of a column are its most central rows.

    Homes move only to more central ones, so moves cannot go round in a circle.
    """
    first = Window.partitionBy("gram").orderBy(F.desc("centre"), F.desc("set_id"))
    chosen = entries.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= hubs)
    onward = F.struct("centre_a", "home_a") > F.struct("centre_b", "home_b")
    tried = (_side(entries, "b").join(_side(chosen, "a"), "gram").where(onward & _can_link(per_cent))
             .groupBy("set_a", "set_b", "home_a", "home_b", "centre_a").agg(F.count("*").alias("n")))
    if hubs == 1:
        tried = tried.groupBy("set_b").agg(F.max_by(F.struct("set_a", "home_a", "home_b", "centre_a"), F.struct("n", "set_a")).alias("to")).select("set_b", "to.*")
    tried = cut_lineage(tried.select(F.col("set_a").alias("a"), F.col("set_b").alias("b"), "home_a", "home_b", "centre_a"), "hub-pairs")
    linked = _linked(tried.select("a", "b"), rows, per_cent)
    moves = linked.join(tried, ["a", "b"]).groupBy(F.col("home_b").alias("home")).agg(F.max(F.struct("centre_a", "home_a")).alias("to"))
    return cut_lineage(moves.select("home", F.col("to.home_a").alias("to"), F.col("to.centre_a").alias("to_centre")), "moves")


def known_components(rows: DataFrame, per_cent: int = PER_CENT, hub_turns=HUB_TURNS) -> DataFrame:
    """(set_id, component) of the rows that meet another in a prefix; component is one of their names.

    home is a component known so far, named by its most central row. Central rows are those with the
    most rows in the columns of their prefix, such as the original of a group of copies.
    """
    entries = cut_lineage(rows.select(F.posexplode("prefix").alias("at", "gram"), "set_id", "size", "before")
                          .select("gram", "set_id", "size", (F.col("at") + F.col("before")).alias("at")), "prefixes")
    meet = entries.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    entries = cut_lineage(entries.join(meet, "gram"), "meeting")
    centre = entries.groupBy("set_id").agg(F.sum("n").alias("centre")).withColumnRenamed("set_id", "c_id")
    entries = cut_lineage(entries.join(centre, F.col("set_id") == F.col("c_id")).select(
        "gram", "set_id", "size", "at", "centre", F.col("set_id").alias("home"), F.col("centre").alias("home_centre")), "central")
    homes = entries.select("set_id", "home", "home_centre").distinct()
    left = entries
    for hubs in hub_turns:
        moves = _towards_hubs(left, rows, hubs, per_cent)
        next_ = moves.select(F.col("home").alias("to"), F.col("to").alias("to_2"), F.col("to_centre").alias("centre_2"))
        moves = moves.join(next_, "to", "left").select("home", F.coalesce("to_2", "to").alias("to"), F.coalesce("centre_2", "to_centre").alias("to_centre"))
        homes = cut_lineage(homes.join(moves, "home", "left").select(
            "set_id", F.coalesce("to", "home").alias("home"), F.coalesce("to_centre", "home_centre").alias("home_centre")), "homes")
        left = left.drop("home", "home_centre").join(homes, "set_id")
        mixed = left.groupBy("gram").agg(F.min("home").alias("lo"), F.max("home").alias("hi")).where("lo < hi").select("gram")
        left = cut_lineage(left.join(mixed, "gram"), "open")
    rest = (_side(left, "a").join(_side(left, "b"), "gram").where((F.col("home_a") < F.col("home_b")) & _can_link(per_cent))
            .groupBy(F.col("set_a").alias("a"), F.col("set_b").alias("b")).agg(F.first("home_a").alias("home_a"), F.first("home_b").alias("home_b")))
    rest = cut_lineage(rest, "rest")
    linked = _linked(rest.select("a", "b"), rows, per_cent).join(rest, ["a", "b"])
    joined = components(linked.select(F.col("home_a").alias("a"), F.col("home_b").alias("b")).distinct())
    return homes.join(joined, homes["home"] == joined["id"], "left").select("set_id", F.coalesce("component", "home").alias("component"))


def document_components(docs: DataFrame, n: int = N, per_cent: int = PER_CENT) -> DataFrame:
    """(doc_id, text_key, n_shingles, component, component_id) of keyed rows; component is null where the set is empty."""
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = cut_lineage(document_sets(docs, n), "sets")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    blocks = max(shuffles, -(-total // BLOCK_ENTRIES))
    shared = _shared_columns(_incidence(docs, blocks, n), blocks)
    rows = cut_lineage(_rows(shared, per_cent), "rows")
    joined = known_components(rows, per_cent).withColumnRenamed("set_id", "id")
    # one row per set and per component; the rows of a set merge before the shuffle
    least = sets.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    least = least.join(joined, least["set_id"] == joined["id"], "left").select("set_id", "least", F.coalesce("component", "set_id").alias("component"))
    least = cut_lineage(least, "classes")
    best = least.groupBy("component").agg(F.min("least").alias("component_id"))
    named = least.join(best, "component").select("set_id", "component", "component_id")
    return sets.join(named, "set_id", "left").select("doc_id", "text_key", "n_shingles", "component",
                                                     F.coalesce("component_id", "doc_id").alias("component_id"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
                       per_cent: int = PER_CENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of `docs`.

    Words are runs without white space, A-Z lower-cased. Null or empty texts have n_shingles 0 and
    are alone, as are all rows without a partner: component_id is then their own doc_id (null for a
    null id). Rows that repeat an id or a text are all kept; component_id is the smallest non-null
    doc_id among the documents reachable by links. An empty table gives an empty result.
    """
    found = document_components(T.keyed(T.narrow(docs, id_col, text_col)), n, per_cent)
    return found.select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, per_cent: int = PER_CENT) -> DataFrame:
    """The rows of `docs`, all columns, of which each component of linked texts has one: that of the
    smallest id (null last), then of the smallest text hash. Of rows that agree in id and text one
    stays. Texts without words are linked with nothing and all stay."""
    found = document_components(T.keyed(T.narrow(docs, id_col, text_col)), n, per_cent)
    stays = found.where("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("stay"))
    name = lambda a, b: F.xxhash64(F.coalesce(a, F.lit(-1)), b).alias("name")
    stays = stays.select(name(F.col("stay.doc_id"), F.col("stay.text_key")), F.col("stay.doc_id").alias("stay_id"), F.col("stay.text_key").alias("stay_key"))
    rows = T.keyed(docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                               F.col(f"`{text_col}`").cast("string").alias("text")))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    worded = rows.where(has_words).withColumn("name", name(F.col("doc_id"), F.col("text_key")))
    # the join and the removal of repeated rows share one exchange, by name
    kept = (worded.join(stays, "name").where(F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("text_key") == F.col("stay_key")))
            .dropDuplicates(["name", "doc_id", "text_key"]))
    return kept.select("row.*").unionByName(rows.where(~has_words).select("row.*"))
