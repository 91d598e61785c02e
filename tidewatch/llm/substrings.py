"""Substring dedup by suffix automata of reference shards.

A window is `span` consecutive words of one document; a word goes if a window that covers it also
starts anywhere else. The words that could match are gathered as references, split into shards, and
every shard gets a suffix automaton with occurrence counts. Text streams through the automaton of
its shard; where the matching statistic reaches `span` and the matched string occurs twice, the
window goes.

Sending all shards to all text would cost the square of the corpus, so references and text meet by
content instead. Each window names an anchor, its `GRAM`-word gram of least hash (the leftmost of
equal ones). Equal windows have equal anchors, so a run of windows with one anchor (a piece) needs
only the shard of that anchor, and pieces whose anchor occurs once in the corpus need none. Equal
pieces enter an automaton once, with their number. A shard holds a bounded number of words: the
pieces of a frequent anchor are cut into single windows and dealt out by window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import text as T
from tidewatch.session import cut_lineage

SPAN = 35
GRAM = 8
#: Words of the automata a task builds at a time, and from which the pieces of an anchor are cut up.
SHARD_WORDS = 40_000
HOT_WORDS = 20_000


def _pieces(w: T.Words, hashes: np.ndarray, span: int):
    """(document, first window, last window, anchor hash, piece hash) of every piece; windows count from the text's start."""
    gram = min(GRAM, span)
    n = len(w)
    begin = T.window_starts(w.first, span)
    if not len(begin):
        return [np.zeros(0, np.int64)] * 5
    grams = T.sequence_hashes(hashes, np.arange(n - gram + 1), np.arange(gram, n + 1))
    # the leftmost least gram among the `width` that start in a window, by doubling
    width = span - gram + 1
    best, reach = np.arange(len(grams)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(grams[left] <= grams[right], left, right)
        reach += step
    anchor = best[begin]
    doc = w.text_of_word()[begin]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]
    lo = begin[new]
    hi = begin[np.r_[np.flatnonzero(new)[1:] - 1, len(begin) - 1]]
    at, doc = anchor[new], doc[new]
    whole = T.sequence_hashes(hashes, lo, hi + span)
    piece = T.mix(whole * np.uint64(3) + (at - lo).astype(np.uint64))
    base = w.first[doc]
    return doc, lo - base, hi - base, grams[at].view(np.int64), piece.view(np.int64)


def _anchors(docs: DataFrame, span: int) -> DataFrame:
    """(anchor, n): how often each anchor occurs, counted per piece of the table (1 or 2: more than one)."""
    schema = pa.schema([("anchor", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            for _, texts in T.chunks(batch.column(0)):
                w = T.words(texts)
                found, n = np.unique(_pieces(w, w.hashes(), span)[3], return_counts=True)
                yield T.arrow_batch(schema, {"anchor": found, "n": n})

    return docs.select("text").mapInArrow(run, "anchor long, n long")


def _occurrences(docs: DataFrame, span: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()),
                        ("anchor", pa.int64()), ("piece", pa.int64())])

    def run(batches):
        for batch in batches:
            for at, texts in T.chunks(batch.column(1)):
                w = T.words(texts)
                doc, lo, hi, anchor, piece = _pieces(w, w.hashes(), span)
                rows = pa.array(doc + at)
                yield T.arrow_batch(schema, {"doc_id": batch.column(0).take(rows), "text_key": batch.column(2).take(rows),
                                             "lo": lo, "hi": hi, "anchor": anchor, "piece": piece})

    return docs.select("doc_id", "text", "text_key").mapInArrow(
        run, "doc_id long, text_key long, lo long, hi long, anchor long, piece long")


def _references(docs: DataFrame, wanted: DataFrame, shards: int, span: int) -> DataFrame:
    """The words (as hashes) of each wanted piece, with its shard; those of hot anchors window by window."""
    schema = pa.schema([("shard", pa.int64()), ("anchor", pa.int64()), ("piece", pa.int64()), ("at", pa.int64()),
                        ("n", pa.int64()), ("words", pa.binary())])

    def run(batches):
        for batch in batches:
            wants = batch.column(1).to_pylist()
            for at, texts in T.chunks(batch.column(0)):
                w = T.words(texts)
                hashes = w.hashes()
                out = {f.name: [] for f in schema}
                for j in range(len(texts)):
                    base = int(w.first[j])
                    for want in wants[at + j]:
                        lo, hi = base + want["lo"], base + want["hi"]
                        cuts = [(lo, hi)]
                        if want["hot"]:
                            cuts = [(s, s) for s in range(lo, hi + 1)]
                            key = T.sequence_hashes(hashes, np.arange(lo, hi + 1), np.arange(lo, hi + 1) + span)
                        else:
                            key = T.mix(np.array([want["anchor"]]).view(np.uint64))
                        for (s, e), k in zip(cuts, key):
                            out["shard"].append(int(k % np.uint64(shards)))
                            out["at"].append(s - lo)
                            out["words"].append(hashes[s:e + span].tobytes())
                        out["n"] += [want["n"]] * len(cuts)
                        out["anchor"] += [want["anchor"]] * len(cuts)
                        out["piece"] += [want["piece"]] * len(cuts)
                if out["n"]:
                    yield T.arrow_batch(schema, out)

    joined = docs.join(wanted, T.same_document(docs, wanted)).select("text", "wants")
    return joined.mapInArrow(run, "shard long, anchor long, piece long, at long, n long, words binary")


class SuffixAutomaton:
    """All substrings of some word sequences, each with the number of places it occurs at."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _clone(self, p: int, q: int, c) -> int:
        """A copy of q for the shorter strings that end in p's strings and c."""
        clone = len(self.length)
        self.next.append(self.next[q].copy())
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, sequence, n: int) -> None:
        """Add a sequence that occurs n times."""
        nexts, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for c in sequence:
            p, q = last, nexts[last].get(c)
            if q is not None:
                last = q if length[q] == length[p] + 1 else self._clone(p, q, c)
            else:
                last = len(length)
                nexts.append({})
                length.append(length[p] + 1)
                count.append(0)
                link.append(0)
                while p >= 0 and c not in nexts[p]:
                    nexts[p][c] = last
                    p = link[p]
                if p >= 0:
                    q = nexts[p][c]
                    link[last] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
            count[last] += n

    def close(self) -> None:
        """Sum the counts from long strings to their suffixes; nothing is added afterwards."""
        for v in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.count[self.link[v]] += self.count[v]

    def repeated(self, sequence, span: int) -> list[tuple[int, int]]:
        """Ranges (first, last) of the starts whose `span` words occur more than once, by matching statistics."""
        nexts, link, length, count = self.next, self.link, self.length, self.count
        out: list[tuple[int, int]] = []
        state, matched = 0, 0
        for i, c in enumerate(sequence):
            while state and c not in nexts[state]:
                state = link[state]
                matched = length[state]
            if c in nexts[state]:
                state, matched = nexts[state][c], matched + 1
            while state and length[link[state]] >= span:
                state = link[state]
                matched = length[state]
            if matched >= span and count[state] > 1:
                start = i - span + 1
                if out and out[-1][1] == start - 1:
                    out[-1] = (out[-1][0], start)
                else:
                    out.append((start, start))
        return out


def _judged(references: DataFrame, span: int) -> DataFrame:
    """(anchor, piece, lo, hi): ranges of windows, from the piece's first, that occur more than once."""
    schema = pa.schema([("anchor", pa.int64()), ("piece", pa.int64()), ("from", pa.int64()), ("to", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        rows = {}
        for anchor, piece, at, n, words in zip(*(table.column(c).to_pylist() for c in ("anchor", "piece", "at", "n", "words"))):
            rows[anchor, piece, at] = (n, words)  # identical rows of the table ask for a piece twice
        by_anchor: dict = {}
        for key, value in sorted(rows.items(), key=lambda x: (x[1][1], x[0])):
            by_anchor.setdefault(key[0], []).append((key, value))
        groups, held = [[]], 0
        for group in by_anchor.values():
            groups[-1].append(group)
            held += sum(len(v[1]) for _, v in group) // 8
            if held > SHARD_WORDS:
                groups.append([])
                held = 0
        out = {f.name: [] for f in schema}
        for group in groups:
            names: dict = {}
            automaton = SuffixAutomaton()
            stream = []
            for (anchor, piece, at), (n, words) in (x for g in group for x in g):
                sequence = [names.setdefault(v, len(names)) for v in np.frombuffer(words, np.int64).tolist()]
                automaton.add(sequence, n)
                stream.append((anchor, piece, at, sequence))
            automaton.close()
            for anchor, piece, at, sequence in stream:
                for s, e in automaton.repeated(sequence, span):
                    for name, v in zip(out, (anchor, piece, at + s, at + e)):
                        out[name].append(v)
        return pa.Table.from_batches([T.arrow_batch(schema, out)])

    return references.groupBy("shard").applyInArrow(run, "anchor long, piece long, `from` long, `to` long")


def repeated_spans(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, text_key, spans): word ranges (start, end exclusive) of keyed documents that repeated windows cover."""
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = _anchors(docs, span).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    seen = cut_lineage(_occurrences(docs, span).join(counts, "anchor", "left_semi"), "pieces")
    distinct = seen.groupBy("anchor", "piece").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key", "lo", "hi")).alias("of"))
    distinct = cut_lineage(distinct, "distinct")
    size = F.col("of.hi") - F.col("of.lo") + span
    weight = distinct.groupBy("anchor").agg(F.sum(size).alias("words"))
    total = weight.agg(F.sum("words")).first()[0] or 0
    shards = max(shuffles, -(-total // SHARD_WORDS))
    heavy = weight.where(F.col("words") > HOT_WORDS).select("anchor", F.lit(True).alias("hot"))
    wants = distinct.join(heavy, "anchor", "left").select(
        "of.doc_id", "of.text_key",
        F.struct("of.lo", "of.hi", "anchor", "piece", "n", F.coalesce("hot", F.lit(False)).alias("hot")).alias("want"))
    wants = wants.groupBy("doc_id", "text_key").agg(F.collect_list("want").alias("wants"))
    judged = _judged(_references(docs, wants, shards, span), span)
    marks = judged.groupBy("anchor", "piece").agg(F.collect_set(F.struct("from", "to")).alias("marks"))
    spans = (seen.join(marks, ["anchor", "piece"])
             .select("doc_id", "text_key", F.explode("marks").alias("m"), "lo")
             .select("doc_id", "text_key", F.struct((F.col("lo") + F.col("m.from")).alias("start"),
                                                    (F.col("lo") + F.col("m.to") + span).alias("end")).alias("span")))
    return spans.groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text), one row per row of `docs`.

    Words are runs without white space, compared unchanged. Texts of fewer than `span` words lose
    nothing; null and empty texts have no words and an empty kept_text. Rows that repeat another
    (id or text or both) are documents of their own, so each repeats the other. A text that is one
    long repetition loses all its windows. An empty table gives an empty result.
    """
    docs = T.keyed(T.narrow(docs, id_col, text_col))
    spans = repeated_spans(docs, span)
    joined = docs.join(spans, T.same_document(docs, spans), "left").select(docs["doc_id"], "text", "spans")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches):
        for batch in batches:
            marks = batch.column(2)
            for at, texts in T.chunks(batch.column(1)):
                out = {"n_words": [], "n_removed": [], "kept_text": []}
                for j, value in enumerate(texts):
                    parts = (value or b"").split()
                    total = len(parts)
                    if marks[at + j].is_valid:
                        gone = np.zeros(total + 1, np.int64)
                        for m in marks[at + j].as_py():
                            gone[m["start"]] += 1
                            gone[m["end"]] -= 1
                        parts = [parts[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                    out["n_words"].append(total)
                    out["n_removed"].append(total - len(parts))
                    out["kept_text"].append(b" ".join(parts).decode())
                yield T.arrow_batch(schema, out | {"doc_id": batch.column(0).slice(at, len(texts))})

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")
