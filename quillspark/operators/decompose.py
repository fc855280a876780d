"""Decompositions whose matrices need not fit the driver: tall-skinny QR, Lanczos on tiles."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators import matrix as MX
from quillspark.session import checkpointed, ship_package

#: Rows factored together inside a task.
BLOCK_ROWS = 4096


def _r_factor(x: np.ndarray) -> np.ndarray:
    return np.linalg.qr(x, mode="r")


def tall_qr(df: DataFrame, d: int, x_col: str = "x") -> np.ndarray:
    """The R factor (at most d x d) of the table's rows, up to the signs of its rows.

    Every task reduces its rows to one triangle, block by block, and triangles are stacked and
    reduced again in a tree of two shuffles. Unlike X^T X, which squares the singular values, R
    has those of X itself, so small ones are kept to full precision.
    """
    MX.check_cells((d, d), "a collected factor")
    ship_package(df.sparkSession)
    src = df.where(F.col(x_col).isNotNull()).select(F.col(x_col).cast("array<double>").alias("x"))

    def run(batches):
        r = np.zeros((0, d))
        for b in batches:
            if b.num_rows:
                x = MX.column_matrix(b.column(0))
                for at in range(0, len(x), BLOCK_ROWS):
                    r = _r_factor(np.vstack([r, x[at:at + BLOCK_ROWS]]))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([r.ravel()])], names=["k", "r"])

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _r_factor(np.concatenate([a, b]).reshape(-1, d)).ravel()

    found = MX.add_packed(src.mapInArrow(run, "k int, r array<double>"), ["k"], "r", merge).collect()
    return np.array(found[0]["r"]).reshape(-1, d) if found else np.zeros((0, d))


def right_singular(df: DataFrame, d: int, x_col: str = "x") -> tuple[np.ndarray, np.ndarray]:
    """(singular values, descending, d of them; right singular vectors as columns) of the rows."""
    r = tall_qr(df, d, x_col)
    _, s, vt = np.linalg.svd(np.vstack([r, np.zeros((max(0, d - len(r)), d))]))
    return s, vt.T


# ---- Lanczos --------------------------------------------------------------------------------------
def affinity_tiles(df: DataFrame, gamma: float, d: int, x_col: str = "x") -> DataFrame:
    """(ti, tj, width, tile): RBF affinities between the features as stored tiles on and above
    the diagonal, self-affinities 0; what reaches the driver is the Gram matrix's diagonal."""
    ship_package(df.sparkSession)
    tiles = checkpointed(MX.product_tiles(df, x_col))
    own = np.zeros(d)
    step = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.get("tile", i * F.col("width") + i))
    for r in tiles.where("ti = tj").select("ti", step.alias("own")).toLocalIterator():
        own[r["ti"] * MX.TILE:r["ti"] * MX.TILE + len(r["own"])] = r["own"]
    shared = df.sparkSession.sparkContext.broadcast(own)

    def run(batches):
        g = shared.value
        for b in batches:
            out = []
            for ti, tj, width, flat in zip(*(c.to_pylist() for c in b.columns[:3]), b.column(3)):
                t = flat.values.to_numpy().reshape(-1, width)
                i, j = ti * MX.TILE, tj * MX.TILE
                a = np.exp(-gamma * np.maximum(g[i:i + len(t), None] + g[None, j:j + width] - 2 * t, 0.0))
                if ti == tj:
                    np.fill_diagonal(a, 0.0)
                out.append(a.ravel())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.list_(pa.float64()))],
                                             names=["ti", "tj", "width", "tile"])

    return checkpointed(tiles.mapInArrow(run, tiles.schema))


def tiles_times(tiles: DataFrame, x: np.ndarray) -> np.ndarray:
    """Symmetric matrix, given by its tiles on and above the diagonal, times a vector: one job,
    whose tasks send one packed piece of the product a row of tiles."""
    shared = tiles.sparkSession.sparkContext.broadcast(x)

    def run(batches):
        v, out = shared.value, {}
        for b in batches:
            for ti, tj, width, flat in zip(*(c.to_pylist() for c in b.columns[:3]), b.column(3)):
                t = flat.values.to_numpy().reshape(-1, width)
                i, j = ti * MX.TILE, tj * MX.TILE
                out[ti] = out.get(ti, 0.0) + t @ v[j:j + width]
                if ti != tj:
                    out[tj] = out.get(tj, 0.0) + v[i:i + len(t)] @ t
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array(list(out.values()))], names=["t", "y"])

    y = np.zeros(len(x))
    for r in MX.add_packed(tiles.mapInArrow(run, "t int, y array<double>"), ["t"], "y").collect():
        y[r["t"] * MX.TILE:r["t"] * MX.TILE + len(r["y"])] = r["y"]
    return y


def leading_vectors(times: Callable[[np.ndarray], np.ndarray], n: int, k: int, known: np.ndarray,
                    tolerance: float = 1e-10) -> np.ndarray:
    """n x k: eigenvectors of the k largest eigenvalues of a symmetric operator, among the vectors
    orthogonal to the ``known`` eigenvector (Lanczos, fully reorthogonalised).

    The driver holds one vector of n numbers a round. A start vector that lies within an invariant
    subspace is followed by another one, so that equal eigenvalues are all found; at most n - 1
    rounds are made, when the result is that of the dense solver whatever the spectrum.
    """
    known = known / np.linalg.norm(known)
    k = min(k, n - 1)
    rng = np.random.default_rng(0)
    basis, products = [], []

    def next_start() -> np.ndarray | None:
        for _ in range(5):
            q = rng.normal(size=n)
            for _ in range(2):
                for b in (known, *basis):
                    q -= (q @ b) * b
            size = np.linalg.norm(q)
            if size > 1e-8:
                return q / size
        return None

    q = next_start() if n > 1 else None
    while q is not None:
        basis.append(q)
        y = times(q)
        products.append(y - (y @ known) * known)
        b, p = np.array(basis), np.array(products)
        small = b @ p.T
        w, v = np.linalg.eigh((small + small.T) / 2)
        if len(basis) >= n - 1:
            break
        rest = products[-1].copy()
        for _ in range(2):
            for x in (known, *basis):
                rest -= (rest @ x) * x
        size = np.linalg.norm(rest)
        if size > 1e-9:
            q = rest / size
            if len(basis) >= k + 1:
                top = v[:, ::-1][:, :k]
                if np.abs(p.T @ top - b.T @ top * w[::-1][:k]).max() < tolerance:
                    break
        else:
            q = next_start()
    return (np.array(basis).T @ v[:, ::-1])[:, :k] if basis else np.zeros((n, 0))
