"""n x n pixel grids.

Images are rows with a row-major ``array<double>`` of n*n pixels (p = r*n + c). Every
per-image operator here is an array expression, so it runs as a projection: no shuffle,
however many images there are. Small closed-form matrices are built with numpy on the driver;
their size depends on the resolution only. Transforms and systems are in ``spectral.py``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _arr(col) -> str:
    return f"`{col}`" if isinstance(col, str) else col


# ---- grid graphs as tables ----------------------------------------------------------------
def grid_edges(spark: SparkSession, n: int) -> DataFrame:
    """(src, dst, axis): neighbour pairs; axis 0 = down (p, p+n), axis 1 = across (p, p+1)."""
    p = spark.range(n * n).select(F.col("id").cast("int").alias("src"))
    down = p.where(F.col("src") < n * (n - 1)).select("src", (F.col("src") + n).alias("dst"),
                                                      F.lit(0).alias("axis"))
    across = p.where(F.col("src") % n != n - 1).select("src", (F.col("src") + 1).alias("dst"),
                                                       F.lit(1).alias("axis"))
    return down.unionByName(across)


def path_eigenvalues(n: int) -> np.ndarray:
    """Eigenvalues of the path-graph Laplacian, ascending: 2 - 2 cos(pi k / n)."""
    return 2.0 - 2.0 * np.cos(np.pi * np.arange(n) / n)


def cosine_basis(n: int) -> np.ndarray:
    """Orthonormal DCT-II matrix C (row k = k-th path-Laplacian eigenvector, first entry > 0)."""
    k = np.arange(n)[:, None]
    j = np.arange(n)[None, :]
    c = np.cos(np.pi * k * (2 * j + 1) / (2 * n)) * math.sqrt(2.0 / n)
    c[0, :] = math.sqrt(1.0 / n)
    return c


def grid_spectrum(spark: SparkSession, n: int) -> DataFrame:
    """(a, b, eig): eigenvalues of the n x n grid Laplacian, eig = l_a + l_b."""
    lam = lambda c: F.lit(2.0) - F.lit(2.0) * F.cos(F.lit(math.pi) * c / F.lit(n))
    g = spark.range(n).select(F.col("id").cast("int").alias("a"),
                              F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("b"))
    return g.select("a", "b", (lam(F.col("a")) + lam(F.col("b"))).alias("eig"))


def smoothest_modes(spark: SparkSession, n: int, dim: int) -> DataFrame:
    """(a, b, eig): the ``dim`` grid modes of smallest eigenvalue; ties by (a, b)."""
    return grid_spectrum(spark, n).orderBy(F.round("eig", 12), "a", "b").limit(dim)


def smoothest_mode_pairs(n: int, dim: int) -> list[tuple[int, int]]:
    """Driver-side twin of ``smoothest_modes``: the (a, b) pairs in order."""
    lam = path_eigenvalues(n)
    pairs = [(round(lam[a] + lam[b], 12), a, b) for a in range(n) for b in range(n)]
    pairs.sort()
    return [(a, b) for _, a, b in pairs[:dim]]


def mode_vectors(n: int, dim: int) -> np.ndarray:
    """dim x n^2: kron of the path eigenvectors of the ``dim`` smoothest modes."""
    c = cosine_basis(n)
    return np.stack([np.kron(c[a], c[b]) for a, b in smoothest_mode_pairs(n, dim)])


def diff_matrix(n: int) -> np.ndarray:
    """Dense D (2n(n-1) x n^2): down differences (row i*n+j), then across (row i*(n-1)+j)."""
    d = np.zeros((n - 1, n))
    d[np.arange(n - 1), np.arange(n - 1)] = -1.0
    d[np.arange(n - 1), np.arange(1, n)] = 1.0
    eye = np.eye(n)
    return np.vstack([np.kron(d, eye), np.kron(eye, d)])


def laplacian_matrix(n: int) -> np.ndarray:
    return diff_matrix(n).T @ diff_matrix(n)


def dct2_matrix(n: int) -> np.ndarray:
    """n^2 x n^2 matrix of the orthonormal 2-D DCT on row-major images."""
    c = cosine_basis(n)
    return np.kron(c, c)


# ---- per-image array expressions ----------------------------------------------------------
def grid_diff_expr(x, n: int) -> Column:
    """D x for each image: n(n-1) down differences, then n(n-1) across differences."""
    a, m = _arr(x), n * (n - 1)
    down = f"transform(sequence(0, {m - 1}), k -> {a}[k + {n}] - {a}[k])"
    across = (f"transform(sequence(0, {m - 1}), k -> {a}[(k div {n - 1}) * {n} + k % {n - 1} + 1]"
              f" - {a}[(k div {n - 1}) * {n} + k % {n - 1}])")
    return F.expr(f"concat({down}, {across})")


def laplacian_apply_expr(x, n: int) -> Column:
    """L y for each image: degree * v minus the sum of the in-grid neighbours."""
    a = _arr(x)
    return F.expr(
        f"transform(sequence(0, {n * n - 1}), p -> "
        f"IF(p div {n} > 0, {a}[p] - {a}[p - {n}], 0D) + IF(p div {n} < {n - 1}, {a}[p] - {a}[p + {n}], 0D)"
        f" + IF(p % {n} > 0, {a}[p] - {a}[p - 1], 0D) + IF(p % {n} < {n - 1}, {a}[p] - {a}[p + 1], 0D))")


def max_pool_expr(x, n: int) -> Column:
    """2 x 2 maximum pooling, stride 2; an odd edge pools the smaller block."""
    a, m = _arr(x), (n + 1) // 2
    r = f"(2 * (q div {m}) + t div 2)"
    c = f"(2 * (q % {m}) + t % 2)"
    return F.expr(
        f"transform(sequence(0, {m * m - 1}), q -> array_max(transform("
        f"filter(array(0, 1, 2, 3), t -> {r} < {n} AND {c} < {n}), t -> {a}[{r} * {n} + {c}])))")


def convolve_expr(x, n: int, kernel) -> Column:
    """Moving-window weighted sum, stride 1, zero edges, no kernel flip.

    Padding as 'SAME' convolutions do it: (k-1) // 2 rows before, the rest after.
    """
    w = np.asarray(kernel, dtype=float)
    kh, kw = w.shape
    ph, pw = (kh - 1) // 2, (kw - 1) // 2
    taps = [(i - ph, j - pw, float(w[i, j])) for i in range(kh) for j in range(kw) if w[i, j] != 0.0]
    if not taps:
        return F.expr(f"array_repeat(0D, {n * n})")
    a = _arr(x)
    # Taps are unrolled into one arithmetic expression per pixel (no inner lambda).
    terms = []
    for dr, dc, wt in taps:
        rr, cc = f"(p div {n} + {dr})", f"(p % {n} + {dc})"
        terms.append(f"IF({rr} >= 0 AND {rr} < {n} AND {cc} >= 0 AND {cc} < {n}, "
                     f"{wt!r}D * {a}[p + {dr * n + dc}], 0D)")
    return F.expr(f"transform(sequence(0, {n * n - 1}), p -> {' + '.join(terms)})")
