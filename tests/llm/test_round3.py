"""Whitening (op11) and the Merkle manifest (op12) against plain numpy and Python."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.llm import brute_merkle
from tidewatch.llm import merkle, packing, whitening

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EMB = "vec_id long, embedding array<float>, label int"


def _whiten_brute(rows, k=4):
    keep = [(i, np.array(v, dtype=np.float64)) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    lengths = pd.Series([len(v) for _, v in keep]).value_counts()
    d = max(lengths[lengths == lengths.max()].index)
    keep = [(i, np.floor(v * 256).astype(np.int64)) for i, v in keep if len(v) == d]
    fit = np.unique(np.stack([x for _, x in keep]), axis=0)
    n, s = len(fit), fit.sum(0)
    cov = np.cov(fit.T, bias=True)
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:k], vec[:, ::-1][:, :k]
    return n, s, e, vec, np.trace(cov), keep


def test_whitening_against_eigh(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 12)) * np.linspace(0.05, 0.6, 12)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000, None), (1001, [None] * 12), (1002, [float("nan")] + [0.1] * 11), (1003, [float("inf")] * 12),
             (1004, [0.1] * 5), (1005, rows[0][1]), (1005, rows[0][1]), (1006, rows[1][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("component", F.lit(1))
    out = whitening.whitened(df).toPandas()
    n, s, e, vec, trace, keep = _whiten_brute([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows])
    assert set(out.vec_id) == {i for i, _ in keep} and len(out) == 4 * len(keep)
    assert (out.n == n).all() and out.identity_error.iloc[0] <= 1e-4
    xs = dict(keep)
    for c in range(4):
        part = out[out.component == c + 1]
        assert np.allclose(part.explained, e[c] / trace, rtol=1e-4)
        got = part.whitened.to_numpy()
        want = np.array([(xs[i] - s / n) @ vec[:, c] / np.sqrt(e[c]) for i in part.vec_id])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
        sign = np.sign(got[0] * want[0])
        assert np.allclose(got, sign * want, atol=1e-8)  # one sign for all rows
    dev = {i: int(((n * x - s) ** 2).sum()) for i, x in keep}
    assert all(dev[r.vec_id] == r.deviation for r in out.itertuples())


def test_whitening_edge_tables(spark):
    assert whitening.whitened(spark.createDataFrame([], EMB)).count() == 0
    one = spark.createDataFrame([(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0), (3, None, 1)], EMB)
    assert whitening.whitened(one).count() == 0  # one distinct vector: no spread, no component
    line = spark.createDataFrame([(i, [i / 8, 2 * i / 8], 0) for i in range(5)], EMB)
    out = whitening.whitened(line).toPandas()  # rank one: a single component
    assert set(out.component) == {1} and np.allclose(out.explained, 1.0) and out.identity_error.iloc[0] < 1e-6


def _docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def _compare(spark, rows):
    got = merkle.manifest(_docs(spark, rows)).toPandas()
    want = pd.DataFrame(brute_merkle.manifest([dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r)) for r in rows]))
    key = ["doc_id", "leaf", "proof_sha256"]
    got = got.sort_values(key, na_position="first").reset_index(drop=True)
    want = want.sort_values(key, na_position="first").reset_index(drop=True)
    assert len(got) == len(want)
    got, want = got.fillna({"doc_id": -1}), want.fillna({"doc_id": -1})
    for c in want.columns:
        assert list(got[c]) == list(want[c]), c
    return got


def test_merkle_against_loops(spark):
    rows = [(i, f"Text {i} ÄB Cd" * (i % 3), "en" if i % 4 else None, f"s{i % 3}" if i % 7 else None, i * 3)
            for i in range(300)]
    rows += [(5, "Repeated ROW", "en", "s1", 12), (5, "Repeated ROW", "en", "s1", 12), (None, "NO ID", "de", "s1", None),
             (400, None, None, None, None), (401, "", "", "", 0), (402, "x" * 20000, "en", "ß-source", 20000)]
    rows += [(1000 + i, "Big Source TEXT", "en", "big", 15) for i in range(600)]  # three levels in one source
    got = _compare(spark, rows)
    assert got.root.nunique() == 1 and got.verified.any()
    tampered = [r for r in rows if r[0] is not None and r[1] and any("A" <= ch <= "Z" for ch in r[1])
                and brute_merkle.zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert (~got.verified).sum() == len(tampered) > 0


def test_merkle_small_tables(spark):
    assert merkle.manifest(_docs(spark, [])).count() == 0
    one = _compare(spark, [(7, "Only ONE", "en", "s", 8)])
    assert one.root[0] == one.leaf[0] == one.subroot[0] and one.proof_sha256[0] == brute_merkle.H("")
    _compare(spark, [(i, "t", "en", None, 1) for i in range(17)])  # a run of one at the end
    clash = _docs(spark, [(1, "a", "en", "s", 1), (2, "b", "en", "t", 1)]).withColumn("leaf", F.lit(1))
    assert merkle.manifest(clash.withColumn("root", clash.doc_id)).count() == 2


def test_merkle_joins_all_leaves_by_parent_only(spark):
    rows = [(i, f"Text {i}", "en", f"s{i % 40}", 5) for i in range(900)]  # two levels in a source, two above them
    assert _compare(spark, rows).root.nunique() == 1
    plan = merkle.manifest(_docs(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert "_pr" in joins[0] and not any("src" in line for line in joins)  # what a source hands on came down with the parents


def _pack_check(out, texts):
    """Every id in exactly one piece, checksums right, sequences within the context and gapless."""
    from tokenizers import Tokenizer
    import zlib
    tok = Tokenizer.from_file(packing.vocabulary_path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts}
    assert set(out.doc_id) == set(ids)
    for i, g in out.groupby("doc_id"):
        g = g.sort_values("start")
        assert list(g.start) == [0] + list(np.cumsum(g.length)[:-1]) and g.length.sum() == len(ids[i])
        assert (g.doc_tokens == len(ids[i])).all()
        for r in g.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[i][r.start:r.start + r.length], dtype="<u4").tobytes())
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0] + list(np.cumsum(g.length)[:-1]) and g.length.sum() <= packing.CONTEXT
        assert g.padded.nunique() == 1 and g.padded.iloc[0] >= g.length.sum()
    return ids


def test_packing_covers_every_id(spark):
    rng = np.random.default_rng(5)
    words = ["alpha", "Beta", "gamma", "δέλτα", "ωμέγα", "42", "x", "!"]
    texts = [(i, " ".join(rng.choice(words, int(n)))) for i, n in enumerate(rng.integers(1, 900, 120))]
    texts += [(500, None), (501, ""), (502, " ".join(["word"] * 5000)), (503, "<|endoftext|> as text")]
    rows = [(i, t, "en", "s", 0) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS).withColumn("sequence_id", F.lit(9)).withColumn("offset", F.lit("x"))
    out = packing.packed(df).toPandas()
    ids = _pack_check(out, texts)
    used = out.groupby("sequence_id").length.sum()
    assert used.sum() == sum(len(v) for v in ids.values())
    assert (used < packing.CONTEXT).sum() <= 1 + (out.tier == packing.CONTEXT).sum()  # only the last or unfilled ones
    assert out[out.doc_id == 502].length.max() == packing.CONTEXT


def test_packing_small_tables(spark):
    assert packing.packed(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, "same text", "en", "s", 1), (1, "same text", "en", "s", 1), (2, None, None, None, None)]
    out = packing.packed(spark.createDataFrame(rows, DOCS)).toPandas()
    assert len(out) == 3 and out.sequence_id.nunique() == 1 and out.length.sum() == out.groupby("doc_id").doc_tokens.first().sum() + out[out.doc_id == 1].doc_tokens.iloc[0]
    assert out[out.doc_id == 2].length.tolist() == [1]
