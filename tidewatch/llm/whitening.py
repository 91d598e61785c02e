"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation over distributed rows.

    whitened(embeddings)        one row per kept vector and component (up to COMPONENTS)

Entries are quantised to integers x = floor(SCALE * c). The fit list is every distinct x vector once
(duplicates merge map-side before their shuffle, so a hot vector costs nothing), written to the shared
folder. Its moments (n, sums S and sums of squares, all exact longs) come from one aggregate.

The centred fit rows X (x - S/n) are never gathered: every Lanczos step is one Spark pass in which each
task computes X h for its rows (the Xv product) and sums (X h)_i x_i (the Xᵀu product), so a pass
returns the d numbers of Xᵀ X h. The left vectors u live only as coefficient vectors g with u = X g;
because Xᵀ X is linear, Xᵀ X g and every inner product u·u' = g·(Xᵀ X g') follow on the driver from
what the passes returned. Both sides are reorthogonalised fully (twice, classical Gram-Schmidt). Steps go
on until the residuals of the leading COMPONENTS Ritz pairs are below TOLERANCE of the largest singular
value, or the Krylov space is exhausted (d steps: then the decomposition is exact). The small upper
bidiagonal B = P Σ Qᵀ gives the components V Q, with eigenvalues e = σ² / n of the covariance.

Defined cases: null vectors, null or non-finite entries: the row is dropped. Rows whose length is not
the table's dimension (the most common length among kept rows, the larger on ties) are dropped as well.
Components with e = 0 (no spread left, for instance one distinct vector) are not returned. An empty
table gives no rows. Equal vectors and repeated rows each get their own output rows; the fit counts a
vector once. Columns of the input other than the id and the vector are not read, so names cannot clash.
The sign of a component is fixed so that its entry of largest magnitude is positive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage

SCALE = 256
COMPONENTS = 4
TOLERANCE = 1e-13
_SEED = 11


def _valid(emb: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v: array<double>) of rows whose vector is whole and finite."""
    v = F.col(vec_col)
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return (emb.select(F.col(id_col).alias("_id"), v.cast("array<double>").alias("_v"))
            .where(F.col("_v").isNotNull() & whole))


def _dimension(valid: DataFrame) -> int | None:
    """The most common vector length (the larger on ties), from one small aggregate."""
    counts = valid.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return counts[0]["d"] if counts else None


def _quantised(valid: DataFrame, d: int) -> DataFrame:
    x = F.transform("_v", lambda c: F.floor(c * SCALE).cast("long"))
    return valid.where(F.size("_v") == d).select("_id", x.alias("x"))


def _moments(fit: DataFrame, d: int) -> tuple[int, list[int], list[int]]:
    """n, per-dimension sums and sums of squares of the fit list, exact."""
    n = fit.count()
    rows = (fit.select(F.posexplode("x").alias("j", "a"))
            .groupBy("j").agg(F.sum("a").alias("s"), F.sum(F.col("a") * F.col("a")).alias("q")).collect())
    s, q = [0] * d, [0] * d
    for r in rows:
        s[r["j"]], q[r["j"]] = int(r["s"]), int(r["q"])
    return n, s, q


def _gram_products(fit: DataFrame, mean: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Xᵀ X h for the centred fit rows X, summed from one partial per task; h may be (d,) or (d, m)."""
    d = len(mean)
    hm = h.reshape(d, -1)
    width = hm.shape[1]

    def partial(batches):
        z = np.zeros((d, width))
        for b in batches:
            if b.num_rows:
                flat = b.column(0).flatten().to_numpy(zero_copy_only=False)
                xc = flat.reshape(-1, d).astype(np.float64) - mean
                z += xc.T @ (xc @ hm)
        yield pa.RecordBatch.from_arrays([pa.array([z.ravel().tolist()], pa.list_(pa.float64()))], ["z"])

    summed = (fit.select("x").mapInArrow(partial, "z array<double>")
              .select(F.posexplode("z").alias("j", "z")).groupBy("j").agg(F.sum("z").alias("z")).collect())
    z = np.zeros(d * width)
    for r in summed:
        z[r["j"]] = r["z"]
    return z.reshape(d, width) if h.ndim == 2 else z


def _orthogonalise(vec: np.ndarray, basis: list[np.ndarray], inner) -> tuple[np.ndarray, list[float]]:
    """vec minus its parts along an orthonormal basis, twice; returns the coefficients removed."""
    total = [0.0] * len(basis)
    for _ in range(2):
        for k, b in enumerate(basis):
            c = inner(vec, b, k)
            vec = vec - c * b
            total[k] += c
    return vec, total


def lanczos(fit: DataFrame, mean: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading singular values σ and right singular vectors (d, k) of the centred fit rows."""
    d = len(mean)
    rng = np.random.default_rng(_SEED)
    v = rng.standard_normal(d)
    v /= np.linalg.norm(v)
    vs, gs, zs, alphas, betas = [], [], [], [], []
    beta, g_prev = 0.0, np.zeros(d)
    scale = None
    while len(vs) < d:
        vs.append(v)
        h = v - beta * g_prev
        z = _gram_products(fit, mean, h)  # Xᵀ X h: one pass over the rows
        # u = X h; reorthogonalise against earlier u = X g_k, with u·u_k = h·(Xᵀ X g_k)
        g, z_g = h, z
        for _ in range(2):
            for k in range(len(gs)):
                c = float(g @ zs[k])
                g, z_g = g - c * gs[k], z_g - c * zs[k]
        alpha = float(np.sqrt(max(g @ z_g, 0.0)))
        scale = max(scale or 0.0, alpha)
        if alpha <= 1e-14 * max(scale, 1e-300):
            alpha, g, z_g = 0.0, np.zeros(d), np.zeros(d)
        else:
            g, z_g = g / alpha, z_g / alpha
        gs.append(g)
        zs.append(z_g)
        alphas.append(alpha)
        nxt = z_g - alpha * v  # Xᵀ u - α v
        nxt, _ = _orthogonalise(nxt, vs, lambda a, b, k: float(a @ b))
        beta = float(np.linalg.norm(nxt))
        if len(vs) == d:
            betas.append(beta)
            break
        if beta <= 1e-12 * max(scale, 1e-300):
            # invariant subspace: continue from a fresh direction orthogonal to all v so far
            beta = 0.0
            fresh, _ = _orthogonalise(rng.standard_normal(d), vs, lambda a, b, k: float(a @ b))
            nxt = fresh / np.linalg.norm(fresh)
        else:
            nxt = nxt / beta
        betas.append(beta)
        g_prev, v = g, nxt
        if len(vs) >= wanted:
            sigma, residual = _ritz(alphas, betas)
            top = min(wanted, len(sigma))
            if sigma[0] > 0 and np.all(residual[:top] <= TOLERANCE * sigma[0]):
                break
    k = len(alphas)
    b = np.diag(alphas) + np.diag(betas[:k - 1], 1)
    _, sigma, qt = np.linalg.svd(b)
    return sigma, np.column_stack(vs[:k]) @ qt.T


def _ritz(alphas: list[float], betas: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of the current bidiagonal and the residual bound of each Ritz pair."""
    k = len(alphas)
    b = np.diag(alphas) + np.diag(betas[:k - 1], 1)
    p, sigma, _ = np.linalg.svd(b)
    return sigma, np.abs(betas[k - 1] * p[k - 1, :])


def fit_components(fit: DataFrame, d: int, wanted: int = COMPONENTS) -> dict:
    """n, sums, trace and the leading components (unit, fixed sign) with their eigenvalues."""
    n, s, q = _moments(fit, d)
    if n == 0:
        return {"n": 0, "s": s, "trace": 0.0, "values": np.zeros(0), "vectors": np.zeros((d, 0))}
    trace = float(sum(n * qq - ss * ss for ss, qq in zip(s, q))) / (float(n) ** 2)
    mean = np.array(s, dtype=np.float64) / n
    sigma, vectors = lanczos(fit, mean, min(wanted, d))
    values = sigma ** 2 / n
    keep = [i for i in range(min(wanted, len(values))) if values[i] > 1e-12 * max(trace, 1e-300)]
    vectors = vectors[:, keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))])
    return {"n": n, "s": s, "trace": trace, "values": values[keep], "vectors": vectors * signs, "mean": mean}


def _identity_error(fit: DataFrame, model: dict) -> float:
    """Largest |entry| of the whitened fit rows' covariance minus the identity, from one pass."""
    k = len(model["values"])
    if k == 0:
        return 0.0
    w = model["vectors"] / np.sqrt(model["values"])
    cov = w.T @ _gram_products(fit, model["mean"], w) / model["n"]
    return float(np.abs(cov - np.eye(k)).max())


def whitened(emb: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per kept row and component."""
    spark = emb.sparkSession
    valid = _valid(emb, id_col, vec_col)
    d = _dimension(valid)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    if d is None:
        return spark.createDataFrame([], schema)
    rows = cut_lineage(_quantised(valid, d), "whiten-rows")
    fit = cut_lineage(rows.select("x").distinct(), "whiten-fit")
    model = fit_components(fit, d, components)
    k = len(model["values"])
    if k == 0:
        return spark.createDataFrame([], schema)
    error = _identity_error(fit, model)
    n, s = model["n"], model["s"]
    y = F.zip_with("x", F.array(*[F.lit(v) for v in s]), lambda a, b: a * F.lit(n) - b)  # n x - S, exact
    deviation = F.aggregate("y", F.lit(0).cast("decimal(38,0)"),
                            lambda acc, a: acc + a.cast("decimal(38,0)") * a.cast("decimal(38,0)"))
    parts = []
    for i in range(k):
        comp = F.array(*[F.lit(float(c)) for c in model["vectors"][:, i]])
        dot = F.aggregate(F.zip_with("y", comp, lambda a, c: a.cast("double") / F.lit(float(n)) * c),
                          F.lit(0.0), lambda acc, a: acc + a)
        parts.append(F.struct(F.lit(i + 1).alias("component"),
                              (dot / F.lit(float(np.sqrt(model["values"][i])))).alias("whitened"),
                              F.lit(float(model["values"][i] / model["trace"])).alias("explained")))
    return (rows.select(F.col("_id").alias("vec_id"), y.alias("y"))
            .select("vec_id", deviation.cast("long").alias("deviation"), F.explode(F.array(*parts)).alias("c"))
            .select("vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened",
                    "c.explained", F.lit(error).alias("identity_error")))
