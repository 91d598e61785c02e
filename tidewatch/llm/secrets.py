"""Secret scans: fixed patterns, and strings that a byte-pair vocabulary cannot shorten.

Words of a language merge into few tokens; random strings do not. A string without white space whose
characters per token fall below TOKEN_RATIO is reported as kind `token`, unless it has the form of a
known digest or identifier, which look random and are no secrets. Names and paths count as such only
if the vocabulary knows their words: separators and numbers make their tokens short, not the words.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from itertools import chain
from pathlib import Path

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from tidewatch.llm import text as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
TOKEN_RATIO = 2.1
KINDS = ("assign", "access", "hex", "token")

# The patterns of the base kinds, and the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
#: Runs of `[0-9a-f]+`; one that is too short fails as a whole, so only long ones are looked for.
HEX = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{HEX_LEAST},}}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WORD = "(?:[A-Z]?[a-z]+|[A-Z]+)"
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
KNOWN = (
    re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}\Z"),  # universally unique identifiers
    re.compile(r"[0-9_/=+-]+\Z"),  # numbers, dates, rules
)
NAME = re.compile(rf"(?:{WORD}[0-9]{{0,4}}[-_/+]+)*{WORD}[0-9]{{0,4}}[-_/+=]*\Z")
#: Words of so many letters must reach the ratio each; shorter ones do so together with the others.
LONG_WORD = 5
PIECES = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"


@lru_cache(maxsize=2)
def _encoding(ranks: bytes) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("scan", pat_str=PIECES, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def _is_known(s: str) -> bool:
    return any(p.match(s) for p in KNOWN) or len(s) in DIGEST_LENGTHS and DIGEST.match(s) is not None


def _is_name(s: str, encoding: tiktoken.Encoding, ratio: float) -> bool:
    """Whether a string under the ratio is a name or path whose words alone are not."""
    if not NAME.match(s):
        return False
    sizes = [(len(w), len(encoding.encode_ordinary(w))) for w in re.findall(WORD, s)]
    return (sum(n for n, _ in sizes) >= ratio * sum(t for _, t in sizes)
            and all(n >= ratio * t for n, t in sizes if n >= LONG_WORD))


def base_spans(s: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points, leftmost and without overlap within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(s) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(s) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(s)]
    return sorted(found)


def token_spans(s: str, encoding: tiktoken.Encoding, ratio: float) -> list[tuple[int, int, int]]:
    found = []
    for m in CANDIDATE.finditer(s):
        part = m.group()
        if not _is_known(part) and len(part) < ratio * len(encoding.encode_ordinary(part)) and not _is_name(part, encoding, ratio):
            found.append((m.start(), 3, m.end()))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 ratio: float = TOKEN_RATIO) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_token, base, spans), one row per row of `docs`.

    base and spans list kind:start:end in code points, end exclusive, by start and then kind, joined
    by commas: base those of the fixed patterns, spans also those of kind token. Null and empty texts
    have none. Repeated rows and ids each get their own row. An empty table gives an empty result.
    The vocabulary file is read on the driver and sent to the executors (under 1 MB).
    """
    docs = T.narrow(docs, id_col, text_col)
    ranks = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    names = ("n_assign", "n_access", "n_hex", "n_token")
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in names], ("base", pa.string()), ("spans", pa.string())])

    def run(batches):
        encoding = _encoding(ranks.value)
        for batch in batches:
            for at, texts in T.chunks(batch.column(1)):
                out = {name: [] for name in (*names, "base", "spans")}
                for value in texts:
                    s = (value or b"").decode()
                    base = base_spans(s)
                    more = token_spans(s, encoding, ratio)
                    kinds = [k for _, k, _ in chain(base, more)]
                    for k, name in enumerate(names):
                        out[name].append(kinds.count(k))
                    out["base"].append(_joined(base))
                    out["spans"].append(_joined(sorted(base + more)))
                yield T.arrow_batch(schema, out | {"doc_id": batch.column(0).slice(at, len(texts))})

    return docs.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_token long, base string, spans string")
