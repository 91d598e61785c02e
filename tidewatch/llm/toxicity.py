"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Each n-gram f gets r_f = log of (its share among n-grams of toxic texts / its share among those of
clean texts), smoothed, from whether texts have it. Logistic regression is then trained on features
scaled by r. An n-gram counts once for each distinct word of a text that has it.

Learning uses a bounded labelled sample (PER_CLASS texts of each class) in one task; scoring sends
the weights to the executors (8 bytes a bucket) and reads every whole text once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import ngrams as G
from tidewatch.llm import text as T

SIZES = (3, 4, 5)
BUCKETS = 1 << 19
PER_CLASS = 1500
MOST_CHARS = 100_000
MODULUS, HELD_OUT = 3, 1
AT_LEAST = 0.7
SMOOTHING = 1.0
#: N-grams of fewer sample texts tell nothing about other texts.
LEAST_TEXTS = 4
PENALTY = 1e-4
STEPS = 250
#: A fit works on so many features at a time, which bounds its memory beside the features themselves (8 bytes each).
BLOCK_ENTRIES = 1 << 18
FORM = {"sizes": SIZES, "buckets": BUCKETS, "lower": True}


def fit(labels: np.ndarray, texts: list[str]) -> tuple[np.ndarray, float]:
    """(weight of each bucket, intercept)."""
    first, bucket, value, words = G.sample_matrix(texts, once=True, **FORM)
    toxic = labels == 1
    if toxic.all() or not toxic.any():  # nothing to tell apart: the share of toxic texts, whatever the text
        return np.zeros(BUCKETS), 6.0 if len(labels) and toxic.all() else -6.0
    have = np.zeros((2, BUCKETS), np.int64)
    for a, b in G.text_blocks(first, BLOCK_ENTRIES):
        own = np.repeat(toxic[a:b], np.diff(first[a:b + 1]))
        for have_t, t in zip(have, (True, False)):
            np.add.at(have_t, bucket[first[a]:first[b]][own == t], 1)
    share = [(h + SMOOTHING) / (h + SMOOTHING).sum() for h in have]
    ratio = np.where(have[0] + have[1] >= LEAST_TEXTS, np.log(share[0] / share[1]), 0.0)
    kept = np.flatnonzero((ratio != 0) & (have.sum(0) > 0))
    place = np.zeros(BUCKETS, np.int32)
    place[kept] = np.arange(len(kept))
    # counts become scaled values and n-grams that tell nothing go, in the arrays' own memory: what stays moves forward
    scale, root, end, first_kept = ratio.astype(np.float32), np.sqrt(np.maximum(words, 1)).astype(np.float32), 0, [0]
    for a, b in G.text_blocks(first, BLOCK_ENTRIES):
        at, row = bucket[first[a]:first[b]], np.repeat(np.arange(a, b), np.diff(first[a:b + 1]))
        used = ratio[at] != 0
        at, row, n = at[used], row[used], value[first[a]:first[b]][used]
        bucket[end:end + len(at)], value[end:end + len(at)] = place[at], scale[at] * n / root[row]
        first_kept.extend(end + np.cumsum(np.bincount(row - a, minlength=b - a)))
        end += len(at)
    first, ratio = np.array(first_kept), ratio[kept]
    blocks = G.text_blocks(first, BLOCK_ENTRIES)
    del have, share, place, scale, root
    # both classes weigh the same; full-batch steps with momentum and a step size for each weight, the last one's being the intercept
    balance = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    weight, side, speed, slope = (np.zeros(len(kept) + 1) for _ in range(4))
    error = np.zeros(len(texts))
    for step in range(1, STEPS + 1):
        slope[:] = 0
        for a, b in blocks:
            at, part = bucket[first[a]:first[b]], value[first[a]:first[b]]
            row = np.repeat(np.arange(b - a), np.diff(first[a:b + 1]))
            logit = np.bincount(row, part * weight[at], minlength=b - a) + weight[-1]
            error[a:b] = (G.sigmoid(logit) - toxic[a:b]) * balance[a:b]
            np.add.at(slope, at, part * error[a:b][row])
        slope[:-1] += PENALTY * weight[:-1]
        slope[-1] = error.sum()
        side, speed = 0.9 * side + 0.1 * slope, 0.99 * speed + 0.01 * slope ** 2
        weight -= 0.05 * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step) * side / (np.sqrt(speed) + 1e-9)
    weights = np.zeros(BUCKETS)
    weights[kept] = weight[:-1] * ratio
    return weights, float(weight[-1])


def score(model: tuple[np.ndarray, float], texts: list[bytes | None]) -> np.ndarray:
    weights, intercept = model
    g = G.word_grams(texts, **FORM)
    of_word = np.bincount(g.word, weights[g.bucket], minlength=g.n_distinct)
    text, word = G.text_words(g, once=True)
    n = np.bincount(text, minlength=len(texts))
    total = np.bincount(text, of_word[word], minlength=len(texts)) if len(text) else np.zeros(len(texts))
    return G.sigmoid(total / np.sqrt(np.maximum(n, 1)) + intercept)


def train(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Fit on (label, text) rows, a sample of bounded size, in one task; an empty sample gives a model that rejects nothing."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        weights, intercept = fit(table.column("label").to_numpy(), table.column("text").to_pylist())
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary()), "intercept": [intercept]})

    made = sample.groupBy().applyInArrow(run, "weights binary, intercept double").first()
    if made is None:
        return np.zeros(BUCKETS), -6.0
    return np.frombuffer(bytes(made["weights"]), np.float64), made["intercept"]


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of `docs`.

    Nothing but the text enters a score. Null and empty texts have no words and get the score of the
    intercept; a null id is not held out. Equal texts get equal scores. Without labels of both classes
    all scores are near 0 (or 1, if all labels are 1). An empty table gives an empty result.
    """
    docs = T.narrow(docs, id_col, text_col)
    model = train(G.labelled_sample(docs, labels, label, MODULUS, HELD_OUT, PER_CLASS, MOST_CHARS))
    return G.scored(docs, docs.sparkSession.sparkContext.broadcast(model), score, MODULUS, HELD_OUT, AT_LEAST)


def clean_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> DataFrame:
    """The rows of `docs`, all columns, that are not predicted to be toxic."""
    narrow = T.narrow(docs, id_col, text_col)
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(G.labelled_sample(narrow, labels, label, MODULUS, HELD_OUT, PER_CLASS, MOST_CHARS)))
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("scored_text"), F.struct("*").alias("row"))

    def run(batches):
        held = model.value
        for batch in batches:
            for at, texts in T.chunks(batch.column(0)):
                keep = pa.array(score(held, texts) < AT_LEAST)
                yield batch.slice(at, len(texts)).filter(keep).select(["row"])

    return rows.mapInArrow(run, rows.select("row").schema).select("row.*")
