"""What both text classifiers share: a bounded labelled sample, hashed character n-grams, and scoring by word.

A linear score over n-grams of words is a sum over words, so a batch of texts is scored by its
distinct words: each gets the sum of its n-gram weights once, and texts add up their words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import text as T

_BASE = 0xA0761D6478BD642F
#: The sample is turned into features in pieces of about so many bytes, which bounds the memory of a fit.
SAMPLE_BYTES = 300_000


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def held_out(doc_id: Column, modulus: int, part: int) -> Column:
    return F.coalesce(remainder(doc_id, modulus) == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, part: int, per_class: int, most_chars: int) -> DataFrame:
    """(doc_id, label, text) of at most `per_class` labelled documents of each class, none held out.

    The sample goes by a hash of the id. An id with several labels has the largest; of an id with
    several texts, the least by hash is used. Texts above `most_chars` are not learned from, which
    bounds the sample in bytes; they are scored like all others.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (remainder(F.col("doc_id"), modulus) != part))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    chosen = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "labelled_id")
    found = docs.where(F.length("text") <= most_chars).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


@dataclass
class WordGrams:
    """The distinct words of some texts and their n-gram buckets: gram i is of word `word[i]`."""

    texts: T.Words
    distinct: np.ndarray  # of each word of the texts, its number among the distinct words
    n_distinct: int
    bucket: np.ndarray
    word: np.ndarray


def word_grams(texts: list[bytes | None], sizes: tuple[int, ...], buckets: int, lower: bool, whole_words: bool = False) -> WordGrams:
    """Character n-grams of the words, each between two blanks; whole_words adds the word as a feature of its own."""
    w = T.words(texts)
    hashes = w.hashes()
    _, at, distinct = np.unique(hashes, return_index=True, return_inverse=True)
    if not len(at):
        return WordGrams(w, distinct, 0, np.zeros(0, np.int64), np.zeros(0, np.int64))
    joined = " " + " ".join(w.data[s:e].decode() for s, e in zip(w.start[at].tolist(), w.end[at].tolist())) + " "
    if lower:
        joined = joined.lower()
    chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    blank = np.flatnonzero(chars == 32)
    first, last = blank[:-1], blank[1:]  # the blanks around each word
    length = last - first + 1
    found, words = [], []
    values = chars.astype(np.uint64) + np.uint64(1)
    for n in sizes:
        count = np.maximum(length - n + 1, 0)
        word = np.repeat(np.arange(len(first)), count)
        start = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        found.append(T._ranges(values, _BASE, start, start + n))
        words.append(word)
    if whole_words:
        found.append(T.mix(T._ranges(values, _BASE, first, last + 1) + np.uint64(1)))
        words.append(np.arange(len(first)))
    bucket = (np.concatenate(found) % np.uint64(buckets)).astype(np.int64)
    return WordGrams(w, distinct, len(first), bucket, np.concatenate(words))


def text_words(g: WordGrams, once: bool) -> tuple[np.ndarray, np.ndarray]:
    """(text, distinct word) of every word of the texts, or with `once` of each text's distinct words."""
    text = g.texts.text_of_word()
    if not once:
        return text, g.distinct
    pair = np.unique(text * max(g.n_distinct, 1) + g.distinct)
    return pair // max(g.n_distinct, 1), pair % max(g.n_distinct, 1)


def text_features(g: WordGrams, once: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of the texts' n-grams, by text and bucket."""
    text, word = text_words(g, once)
    order = np.argsort(g.word, kind="stable")
    begin = np.searchsorted(g.word[order], np.arange(g.n_distinct + 1))
    count = np.diff(begin)[word]
    at = np.repeat(begin[:-1][word], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    width = int(g.bucket.max(initial=0)) + 1
    pair, n = np.unique(np.repeat(text, count) * width + g.bucket[order][at], return_counts=True)
    return pair // width, pair % width, n


def repeated_words(g: WordGrams) -> np.ndarray:
    """How many words of each text equal the word before."""
    text = g.texts.text_of_word()
    same = (g.distinct[1:] == g.distinct[:-1]) & (text[1:] == text[:-1])
    return np.bincount(text[1:][same], minlength=len(g.texts.first) - 1)


def sample_matrix(texts: list[str | None], **how) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, bucket, count, words): features of text i at first[i]:first[i + 1], and the number of its words counted.
    With repeat_weight, the pair of a word with itself is a feature of its own, in the bucket after the last."""
    once, weight = how.pop("once"), how.pop("repeat_weight", 0)
    sizes, totals, buckets, counts = [], [], bytearray(), bytearray()  # these two grow in place: no second copy, no holes
    for _, part in T.chunks(pa.array(texts, pa.string()), SAMPLE_BYTES):
        g = word_grams(part, **how)
        row, bucket, n = text_features(g, once)
        if weight:
            again = repeated_words(g)
            row, bucket, n = (np.r_[row, np.flatnonzero(again)], np.r_[bucket, np.full((again > 0).sum(), how["buckets"])],
                              np.r_[n, weight * again[again > 0]])
            order = np.argsort(row, kind="stable")
            row, bucket, n = row[order], bucket[order], n[order]
        sizes.append(np.bincount(row, minlength=len(part)))
        buckets += bucket.astype(np.int32).tobytes()
        counts += n.astype(np.float32).tobytes()
        totals.append(np.bincount(text_words(g, once)[0], minlength=len(part)))
    none = np.zeros(0, np.int64)
    return (np.r_[0, np.cumsum(np.concatenate(sizes or [none]))], np.frombuffer(buckets, np.int32), np.frombuffer(counts, np.float32),
            np.concatenate(totals or [none]))


def text_blocks(first: np.ndarray, entries: int) -> list[tuple[int, int]]:
    """Ranges of whole texts that cover all of them, each of `entries` features at most or one text."""
    cuts = [0]
    while cuts[-1] < len(first) - 1:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(first, first[cuts[-1]] + entries, "right")) - 1))
    return list(zip(cuts, cuts[1:]))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def scored(docs: DataFrame, model, score, modulus: int, part: int, at_least: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) of narrow docs; score(model, texts) gives one number a text."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        held = model.value
        for batch in batches:
            for at, texts in T.chunks(batch.column(1)):
                yield T.arrow_batch(schema, {"doc_id": batch.column(0).slice(at, len(texts)), "score": score(held, texts)})

    return docs.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id"), modulus, part).alias("held_out"), "score",
        (F.col("score") >= at_least).cast("int").alias("predicted"))
