"""Quality: supervised subword embeddings, averaged per document, with a softmax output.

Every word and every character n-gram of a word has a learned vector (hashed to a bucket), and so has
the pair of a word with itself, whichever word it is. A document is the mean of the vectors of all its
words and n-grams; a softmax over its product with two output vectors gives the classes. Both are
trained by numpy stochastic gradient descent with a step size per vector that shrinks with its past
gradients.

Learning uses a bounded labelled sample in one task. For scoring, each bucket's vector is reduced to
its part of the logit, one number, so that the executors get 8 bytes a bucket and add up words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm import ngrams as G
from tidewatch.llm import text as T

SIZES = (1, 2, 3)
BUCKETS = 1 << 18
DIMENSIONS = 8
PER_CLASS = 1200
MOST_CHARS = 100_000
MODULUS, HELD_OUT = 4, 2
AT_LEAST = 0.7
EPOCHS = 6
BATCH = 32
RATE = 0.3
FORM = {"sizes": SIZES, "buckets": BUCKETS, "lower": False, "whole_words": True}
#: A repeated word counts like so many n-grams, about as many as a word has.
REPEAT_WEIGHT = 10


def fit(labels: np.ndarray, texts: list[str]) -> tuple[np.ndarray, float]:
    """(logit part of each bucket, intercept)."""
    good = labels == 1
    if not len(labels) or good.all() or not good.any():
        return np.zeros(BUCKETS + 1), 0.0 if not len(labels) else 6.0 if good.all() else -6.0
    first, bucket, count, _ = G.sample_matrix(texts, once=False, repeat_weight=REPEAT_WEIGHT, **FORM)
    random = np.random.default_rng(7)
    embedding = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + 1, DIMENSIONS))
    output, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    e_past, o_past, b_past = np.full(BUCKETS + 1, 1e-8), np.full((DIMENSIONS, 2), 1e-8), np.full(2, 1e-8)
    truth = np.stack([~good, good], axis=1).astype(float)
    balance = np.where(good, 0.5 / good.mean(), 0.5 / (~good).mean())
    total = np.maximum(np.add.reduceat(np.r_[count, 0], np.minimum(first[:-1], len(count))) * (np.diff(first) > 0), 1)
    for _ in range(EPOCHS):
        shuffled = random.permutation(len(texts))
        for s in range(0, len(texts), BATCH):
            docs = shuffled[s:s + BATCH]
            n = np.diff(first)[docs]
            at = np.repeat(first[docs], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            doc = np.repeat(np.arange(len(docs)), n)
            part = count[at] / total[docs][doc]
            ids, local = np.unique(bucket[at], return_inverse=True)
            vectors = embedding[ids]
            hidden = np.stack([np.bincount(doc, part * vectors[local, k], minlength=len(docs)) for k in range(DIMENSIONS)], axis=1)
            logits = hidden @ output + bias
            soft = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (soft / soft.sum(axis=1, keepdims=True) - truth[docs]) * balance[docs][:, None] / len(docs)
            back = error @ output.T
            o_slope, b_slope = hidden.T @ error, error.sum(axis=0)
            e_slope = np.stack([np.bincount(local, part * back[doc, k], minlength=len(ids)) for k in range(DIMENSIONS)], axis=1)
            o_past += o_slope ** 2
            b_past += b_slope ** 2
            e_past[ids] += (e_slope ** 2).mean(axis=1)
            output -= RATE * o_slope / np.sqrt(o_past)
            bias -= RATE * b_slope / np.sqrt(b_past)
            embedding[ids] -= RATE * e_slope / np.sqrt(e_past[ids])[:, None]
    return embedding @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0])


def score(model: tuple[np.ndarray, float], texts: list[bytes | None]) -> np.ndarray:
    parts, intercept = model
    g = G.word_grams(texts, **FORM)
    of_word = np.bincount(g.word, parts[g.bucket], minlength=g.n_distinct)
    grams = np.bincount(g.word, minlength=g.n_distinct)
    text, word = G.text_words(g, once=False)
    if not len(text):
        return np.full(len(texts), G.sigmoid(np.array(intercept)))
    total, n = (np.bincount(text, v[word], minlength=len(texts)) for v in (of_word, grams))
    again = REPEAT_WEIGHT * G.repeated_words(g)
    return G.sigmoid((total + again * parts[BUCKETS]) / np.maximum(n + again, 1) + intercept)


def train(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Fit on (doc_id, label, text) rows, a sample of bounded size, in one task."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        parts, intercept = fit(table.column("label").to_numpy(), table.column("text").to_pylist())
        return pa.table({"parts": pa.array([parts.tobytes()], pa.binary()), "intercept": [intercept]})

    made = sample.groupBy().applyInArrow(run, "parts binary, intercept double").first()
    return (np.zeros(BUCKETS + 1), 0.0) if made is None else (np.frombuffer(bytes(made["parts"]), np.float64), made["intercept"])


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of `docs`.

    Nothing but the text enters a score. Null and empty texts have no words and get the score of the
    intercept; a null id is not held out. Equal texts get equal scores. Without labels of both classes
    all scores are alike: near the only class, or 0.5 without labels. An empty table gives an empty result.
    """
    docs = T.narrow(docs, id_col, text_col)
    model = train(G.labelled_sample(docs, labels, label, MODULUS, HELD_OUT, PER_CLASS, MOST_CHARS))
    return G.scored(docs, docs.sparkSession.sparkContext.broadcast(model), score, MODULUS, HELD_OUT, AT_LEAST)
