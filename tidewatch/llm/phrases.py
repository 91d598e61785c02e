"""Benchmark decontamination with a distributed positional inverted index.

The index holds postings (term, document, positions) of the terms that searches start from. A search
term list is a window of `size` consecutive item words. Its two rarest terms, by counts over the
whole corpus, are looked up; their position lists, each shifted by the term's place in the window,
are intersected (exact phrases) or matched within `slack` words (proximity). What remains are places
in few documents, where the other terms are compared word by word.

Test items are taken in blocks of at most BLOCK_ITEMS rows and BLOCK_WORDS words, so what is
broadcast has a fixed bound however large the test sets are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import text as T
from tidewatch.session import cut_lineage

SIZE = 10
#: A near match: the two rarest terms are at most SLACK words off their places, and so many of the
#: window's words stand between the places SLACK words before and after it.
SLACK = 3
NEAR_WORDS = 8
BLOCK_WORDS = 400_000


class Windows:
    """The windows of a block of items, as hashes of words, with the items that have each."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        w = T.words([t for _, t in items], T.LETTERS, lower=True)
        hashes = w.hashes()
        self.items = [i for i, _ in items]
        found: dict[tuple, list[int]] = {}
        for j in range(len(items)):
            own = hashes[w.first[j]:w.first[j + 1]].tolist()
            for s in range(max(len(own) - size, 0) + 1):
                key = tuple(own[s:s + size])
                if key and (not found.get(key) or found[key][-1] != j):
                    found.setdefault(key, []).append(j)
        self.words = list(found)
        self.owners = list(found.values())
        self.terms = np.unique(np.array([t for k in found for t in k], np.uint64))


def _items(items: DataFrame, block_words: int) -> list[list[tuple[str, bytes]]]:
    """Blocks of (item id, text), in id order. Only one block is held at a time by whoever iterates."""
    rows, held, block = items.orderBy("item_id", "text").toLocalIterator(), 0, []
    for row in rows:
        text = (row["text"] or "").encode()
        if block and held + len(text) // 2 > block_words:
            yield block
            block, held = [], 0
        block.append((row["item_id"], text))
        held += len(text) // 2
    if block:
        yield block


def _term_counts(docs: DataFrame, terms) -> dict[int, int]:
    """How often each of the block's terms occurs in the corpus."""
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def run(batches):
        wanted = terms.value
        total = np.zeros(len(wanted) + 1, np.int64)
        for batch in batches:
            for _, texts in T.chunks(batch.column(0)):
                hashes = T.words(texts, T.LETTERS, lower=True).hashes()
                at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                total += np.bincount(np.where(wanted[at] == hashes, at, len(wanted)), minlength=len(wanted) + 1)
        has = np.flatnonzero(total[:-1])
        yield T.arrow_batch(schema, {"term": has, "n": total[has]})

    counts = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in counts.collect()}  # at most the block's terms


def _postings(docs: DataFrame, chosen) -> DataFrame:
    """The index: (doc_id, text_key, term, positions) of the chosen terms."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("term", pa.int64()), ("positions", pa.list_(pa.int64()))])

    def run(batches):
        wanted = chosen.value
        for batch in batches:
            for at, texts in T.chunks(batch.column(1)):
                w = T.words(texts, T.LETTERS, lower=True)
                hashes = w.hashes()
                spot = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                hit = np.flatnonzero(wanted[spot] == hashes)
                doc, term = w.text_of_word()[hit], spot[hit]
                order = np.lexsort((hit, term, doc))
                doc, term, hit = doc[order], term[order], hit[order]
                new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])]) if len(hit) else hit
                rows = pa.array(doc[new] + at)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[new, len(hit)].astype(np.int32)), pa.array(hit - w.first[doc]))
                yield T.arrow_batch(schema, {"doc_id": batch.column(0).take(rows), "text_key": batch.column(2).take(rows),
                                             "term": wanted[term[new]].view(np.int64), "positions": lists})

    return docs.select("doc_id", "text", "text_key").mapInArrow(
        run, "doc_id long, text_key long, term long, positions array<long>")


def _places(index: DataFrame, starts: DataFrame, slack: int) -> DataFrame:
    """(doc_id, text_key, places): where windows may begin, from the lists of their two rarest terms."""
    shifted = lambda name, by: F.transform(name, lambda p: p - F.col(by))
    first = index.join(starts, index["term"] == starts["term_1"])
    first = first.select("doc_id", "text_key", "window", "place_2", "term_2", shifted("positions", "place_1").alias("at_1"))
    second = index.select(F.col("doc_id").alias("id_2"), F.col("text_key").alias("key_2"), F.col("term").alias("t_2"),
                          F.col("positions").alias("p_2"))
    both = first.join(second, F.col("doc_id").eqNullSafe(F.col("id_2")) & (F.col("text_key") == F.col("key_2"))
                      & (F.col("term_2") == F.col("t_2")))
    at_2 = shifted("p_2", "place_2")
    near = F.filter("at_1", lambda a: F.exists(at_2, lambda b: F.abs(a - b) <= slack))
    found = both.select("doc_id", "text_key", "window", near.alias("at")).where(F.size("at") > 0)
    return found.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("window", "at")).alias("places"))


def phrase_matches(docs: DataFrame, items: DataFrame, size: int = SIZE, slack: int = SLACK,
                   near_words: int = NEAR_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text_key, hits, items, near_items) of keyed documents in which a window of an item occurs.

    hits are the covered word positions, items the ids of exactly matching items, near_items those
    of items with a proximity match.
    """
    spark = docs.sparkSession
    schema = "doc_id long, text_key long, hits array<long>, items array<string>, near_items array<string>"
    found = None
    for block in _items(items, block_words):
        windows = Windows(block, size)
        if not windows.words:
            continue
        counts = _term_counts(docs, spark.sparkContext.broadcast(windows.terms))
        count_of = {int(t): counts.get(i, 0) for i, t in enumerate(windows.terms)}
        starts = []
        for i, key in enumerate(windows.words):
            order = sorted(range(len(key)), key=lambda p: (count_of[key[p]], p))
            a = order[0]
            b = next((p for p in order if key[p] != key[a]), a)
            if count_of[key[a]]:
                starts.append((i, a, b, int(np.uint64(key[a]).view(np.int64)), int(np.uint64(key[b]).view(np.int64))))
        if not starts:
            continue
        chosen = np.unique(np.array([s[3:] for s in starts], np.int64).view(np.uint64))
        index = cut_lineage(_postings(docs, spark.sparkContext.broadcast(chosen)), "postings")
        table = spark.createDataFrame(starts, "window long, place_1 long, place_2 long, term_1 long, term_2 long")
        places = _places(index, table, slack)
        held = spark.sparkContext.broadcast(windows)
        joined = docs.join(places, T.same_document(docs, places)).select(
            docs["doc_id"], docs["text_key"], "text", "places").dropDuplicates(["doc_id", "text_key"])
        matched = cut_lineage(joined.mapInArrow(_verifier(held, slack, near_words), schema), "matches")
        found = matched if found is None else found.unionByName(matched)
    if found is None:
        return spark.createDataFrame([], schema)
    merged = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return found.groupBy("doc_id", "text_key").agg(merged("hits"), merged("items"), merged("near_items"))


def _verifier(held, slack: int, near_words: int):
    kinds = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("hits", pa.list_(pa.int64())),
                       ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])

    def run(batches):
        windows = held.value
        for batch in batches:
            places = batch.column(3)
            for row, texts in T.chunks(batch.column(2)):
                out = {"hits": [], "items": [], "near_items": []}
                w = T.words(texts, T.LETTERS, lower=True)
                hashes = w.hashes()
                for j in range(len(texts)):
                    own = hashes[w.first[j]:w.first[j + 1]].tolist()
                    hits, exact, near = set(), set(), set()
                    for place in places[row + j].as_py():
                        key = windows.words[place["window"]]
                        for at in place["at"]:
                            if at >= 0 and tuple(own[at:at + len(key)]) == key:
                                hits.update(range(at, at + len(key)))
                                exact.update(windows.owners[place["window"]])
                            else:
                                around = set(own[max(at - slack, 0):max(at + len(key) + slack, 0)])
                                if len(set(key) & around) >= min(near_words, len(set(key))):
                                    near.update(windows.owners[place["window"]])
                    name = lambda owners: sorted({windows.items[i] for i in owners if windows.items[i] is not None})
                    out["hits"].append(sorted(hits))
                    out["items"].append(name(exact))
                    out["near_items"].append(name(near | exact))
                yield T.arrow_batch(kinds, out | {c: batch.column(c).slice(row, len(texts)) for c in ("doc_id", "text_key")})

    return run


def word_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_words) of keyed documents."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64())])

    def run(batches):
        for batch in batches:
            for at, texts in T.chunks(batch.column(1)):
                counts = T.words(texts, T.LETTERS, lower=True).counts
                yield T.arrow_batch(schema, {"doc_id": batch.column(0).slice(at, len(texts)),
                                             "text_key": batch.column(2).slice(at, len(texts)), "n_words": counts})

    return docs.select("doc_id", "text", "text_key").mapInArrow(run, "doc_id long, text_key long, n_words long")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", size: int = SIZE) -> DataFrame:
    """(doc_id, n_words, hits, items, near_items), one row per row of `docs`.

    Words are runs of digits, a-z (A-Z lower-cased) and characters outside ASCII. Null and empty
    texts have no words and no hits; items without words match nothing, an item of fewer than `size`
    words is one window. A null item id matches like any other but is not listed. Repeated rows each
    get the same result. Empty tables give empty lists or an empty result.
    """
    docs = T.keyed(T.narrow(docs, id_col, text_col))
    items = items.select(F.col(f"`{item_id}`").cast("string").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    found = phrase_matches(docs, items, size)
    counts = word_counts(docs)
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return counts.join(found, T.same_document(counts, found), "left").select(
        counts["doc_id"], counts["text_key"], "n_words", none("hits", "array<long>"), none("items", "array<string>"),
        none("near_items", "array<string>"))


def uncontaminated_rows(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """The rows of `docs`, all columns, in which no window of an item occurs word by word."""
    narrow = T.keyed(T.narrow(docs, id_col, text_col))
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = phrase_matches(narrow, items, size).where(F.size("hits") > 0).select("doc_id", "text_key")
    rows = T.keyed(docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                               F.col(f"`{text_col}`").cast("string").alias("text")))
    return rows.join(found, T.same_document(rows, found), "left_anti").select("row.*")
