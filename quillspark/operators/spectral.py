"""Separable work on stacks of n x n images: cosine transforms, differences, Laplacian systems.

A 2-D cosine transform is a transform of the rows and then of the columns, so the only matrix
that is broadcast is the n x n basis, and an image costs 2 n^3 multiplications instead of n^4
(images of at most KRONECKER_SIDE aside). The grid Laplacian L = D^T D is diagonal in that basis; D itself is applied by
subtracting neighbours. The numpy functions take and return stacks of flattened images
(rows x n^2) and are used inside Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame

from quillspark.operators import grid as GR
from quillspark.operators import matrix as MX

#: Values that one block of images may hold at a time.
BLOCK_VALUES = 1 << 20


def blocks(rows: int, width: int) -> Iterator[slice]:
    """Slices of rows whose images of ``width`` values are worked on together."""
    step = max(1, BLOCK_VALUES // max(1, width))
    for at in range(0, rows, step):
        yield slice(at, at + step)


#: Up to this side an image's transform is one product with the small Kronecker matrix, which
#: costs more multiplications but fewer calls.
KRONECKER_SIDE = 12


def dct2(y: np.ndarray, basis: np.ndarray) -> np.ndarray:
    n = len(basis)
    if n <= KRONECKER_SIDE:
        return y @ np.kron(basis, basis).T
    return (basis @ y.reshape(-1, n, n) @ basis.T).reshape(-1, n * n)


def idct2(y: np.ndarray, basis: np.ndarray) -> np.ndarray:
    return dct2(y, basis.T)


def grid_eigenvalues(n: int) -> np.ndarray:
    """Eigenvalues of the n x n grid Laplacian in the order of ``dct2``'s coefficients."""
    lam = GR.path_eigenvalues(n)
    return (lam[:, None] + lam[None, :]).reshape(-1)


def differences(y: np.ndarray, n: int) -> np.ndarray:
    """D y: the down differences of every image, then the across ones (``grid.diff_matrix``)."""
    t = y.reshape(-1, n, n)
    m = n * (n - 1)
    return np.concatenate([(t[:, 1:] - t[:, :-1]).reshape(-1, m), (t[:, :, 1:] - t[:, :, :-1]).reshape(-1, m)], axis=1)


def differences_adjoint(d: np.ndarray, n: int) -> np.ndarray:
    """D^T d."""
    m = n * (n - 1)
    down, across = d[:, :m].reshape(-1, n - 1, n), d[:, m:].reshape(-1, n, n - 1)
    out = np.zeros((len(d), n, n))
    out[:, 1:] += down
    out[:, :-1] -= down
    out[:, :, 1:] += across
    out[:, :, :-1] -= across
    return out.reshape(-1, n * n)


class TvSystem:
    """(gam L + f^T f)^-1 in the cosine basis, for an embedding f (d x n^2).

    ``f_hat`` is f in that basis. If f's rows are an orthonormal set over exactly d modes (the
    principal-axis embedding, the cosine basis itself), f^T f is a 0/1 diagonal there and the
    system is one division per mode. Any other f is a change of rank d: a d x d system
    (Woodbury) on top of the division. Nothing of n^2 x n^2 is formed.
    """

    def __init__(self, f: np.ndarray, n: int, gam: float) -> None:
        self.n = n
        self.f_hat = dct2(np.asarray(f, float), GR.cosine_basis(n))
        diagonal = gam * grid_eigenvalues(n)
        d = len(self.f_hat)
        size = np.abs(self.f_hat).max(axis=0, initial=0.0)
        used = size > 1e-10 * max(size.max(initial=0.0), 1e-300)
        own = self.f_hat[:, used]
        self.left = self.inner = None
        if own.shape[1] == d and np.allclose(own.T @ own, np.eye(d), atol=1e-9):
            diagonal = diagonal + used
            if not used[0]:
                diagonal[0] = 1.0  # nothing asks for a mean: it stays zero
            self.inverse = 1.0 / diagonal
            return
        # The constant mode has no eigenvalue of its own: add one, and take it off again unless
        # f leaves the mode alone.
        diagonal[0] += 1.0
        self.inverse = 1.0 / diagonal
        rows, signs = self.f_hat, np.ones(d)
        if used[0]:
            rows, signs = np.vstack([rows, np.eye(1, n * n)]), np.append(signs, -1.0)
        self.left = rows
        self.inner = np.linalg.inv(np.diag(signs) + (rows * self.inverse) @ rows.T)

    def solve(self, right_hat: np.ndarray) -> np.ndarray:
        """Solutions for rows of right-hand sides, all in the cosine basis."""
        out = right_hat * self.inverse
        if self.left is not None:
            out = out - ((out @ self.left.T) @ self.inner) @ (self.left * self.inverse)
        return out


# ---- DataFrame operators ----------------------------------------------------------------------
def cosine_transform(df: DataFrame, n: int, x_col: str = "x", out_col: str = "y",
                     keep: Sequence[str] | None = None, inverse: bool = False) -> DataFrame:
    """The orthonormal 2-D cosine transform (or its inverse) of every n x n image."""
    c = GR.cosine_basis(n)
    shared = MX.broadcast_matrix(df.sparkSession, c.T if inverse else c)

    def run(y: np.ndarray) -> np.ndarray:
        return np.concatenate([dct2(y[s], shared.value) for s in blocks(len(y), n * n)])

    return MX.map_rows(df, run, x_col, out_col, keep)


def laplacian_solve(df: DataFrame, n: int, lam: float, gam: float, x_col: str = "x", out_col: str = "y",
                    keep: Sequence[str] | None = None) -> DataFrame:
    """y with (lam L + gam I) y = x for every n x n image."""
    shared = MX.broadcast_matrix(df.sparkSession, GR.cosine_basis(n))
    scale = 1.0 / (lam * grid_eigenvalues(n) + gam)

    def run(y: np.ndarray) -> np.ndarray:
        c = shared.value
        return np.concatenate([idct2(dct2(y[s], c) * scale, c) for s in blocks(len(y), n * n)])

    return MX.map_rows(df, run, x_col, out_col, keep)
