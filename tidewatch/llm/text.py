"""Words and their hashes for whole batches of texts, computed with numpy on the bytes of the batch.

A word's hash is a 64-bit polynomial over its bytes; the hash of k words is a polynomial over the
word hashes. Both come out of one running sum, so the cost does not depend on k. Two different word
sequences get the same hash with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts are handled in pieces of about so many bytes; one longer text is a piece of its own.
CHUNK_BYTES = 2_000_000
CHUNK_TEXTS = 50_000

_U = np.uint64
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _table(keep) -> np.ndarray:
    return np.array([bool(keep(b)) for b in range(256)])


#: `[^\x20\x09-\x0D]` and `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` on UTF-8 bytes.
NOT_SPACE = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
LETTERS = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _power_table(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < size."""
    have = _powers.get(base)
    if have is None or len(have[0]) < size:
        size = max(size, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        have = tuple(np.cumprod(np.r_[_U(1), np.full(size - 1, b, _U)], dtype=_U) for b in (base, inverse))
        if size <= 4 * CHUNK_BYTES:  # those of one huge text are not kept
            _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each value (a bijection on 64 bits)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _ranges(values: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial hash of values[start:end] for each pair."""
    up, down = _power_table(base, len(values) + 1)
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U) * _U(0xC2B2AE3D27D4EB4F))


@dataclass
class Words:
    """The words of some texts: word i is data[start[i]:end[i]]; text j has words first[j] to first[j + 1]."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return _ranges(np.frombuffer(self.data, np.uint8).astype(_U) + _U(1), _BYTE_BASE, self.start, self.end)


def words(texts: list[bytes | None], letters: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    parts = [b"" if t is None else t for t in texts]
    data = b" " + b" ".join(parts) + b" "
    if lower:
        data = data.translate(LOWER)
    inside = letters[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edges[0::2], edges[1::2]
    begins = 1 + np.r_[0, np.cumsum([len(p) + 1 for p in parts])].astype(np.int64)
    return Words(data, start, end, np.searchsorted(start, begins))


def sequence_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each run values[start:end] of word hashes."""
    return _ranges(values, _WORD_BASE, start, end)


def window_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Every position from which k words follow inside one text."""
    n = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return np.flatnonzero(left >= k)


def chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts as UTF-8) pieces of about `limit` bytes, covering the column in order."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    at, size, held = 0, 0, []
    for value in texts.cast(pa.large_binary()):
        value = value.as_py()
        if held and (size + len(value or b"") > limit or len(held) == CHUNK_TEXTS):
            yield at, held
            at, size, held = at + len(held), 0, []
        held.append(value)
        size += len(value or b"")
    if held:
        yield at, held


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; whatever else the table has cannot clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """Add `text_key`. (doc_id, text_key) names a document even where ids are null or repeated:
    rows that agree in both are copies of one row and get equal results."""
    return docs.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()))


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def arrow_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
