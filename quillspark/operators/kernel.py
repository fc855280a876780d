"""RBF kernels against landmark rows and kernel principal coordinates (Nystroem form).

Landmarks are the m rows first in md5(id) order, so the choice is reproducible and spread
over the table. Only m x d landmarks and m x m matrices reach the driver; the N x N
kernel is never built. With m = N the coordinates equal full kernel PCA up to sign.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from quillspark.operators import matrix as MX
from quillspark.session import ship_package


def landmarks(df: DataFrame, m: int, x_col: str = "x") -> tuple[list[int], np.ndarray]:
    """Ids and vectors of the m rows smallest by md5 of the id text (a top-m, not a sample)."""
    rows = (df.select("vec_id", x_col)
            .orderBy(F.md5(F.col("vec_id").cast("string")), "vec_id").limit(m).collect())
    return [r[0] for r in rows], np.array([r[1] for r in rows], dtype=float)


def _sqdist(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.maximum(d, 0.0)


def rbf_pairs(df: DataFrame, lm: np.ndarray, gamma: float, x_col: str = "x",
              out_col: str = "k") -> DataFrame:
    """(vec_id, k): k[j] = exp(-gamma |x - landmark_j|^2) for every row."""
    b = MX.broadcast_matrix(df.sparkSession, lm)
    schema = StructType([StructField("vec_id", LongType()), StructField(out_col, ArrayType(DoubleType()))])

    def run(batches):
        L = b.value
        for pdf in batches:
            if pdf.empty:
                continue
            x = MX._stack(pdf[x_col])
            # |x - l|^2 = |x|^2 + |l|^2 - 2 x.l: memory batch x m, never batch x m x d.
            k = np.exp(-gamma * _sqdist(x, L))
            yield pd.DataFrame({"vec_id": pdf["vec_id"].astype("int64"), out_col: list(k)})

    return df.select("vec_id", x_col).mapInPandas(run, schema)


def kernel_pca(df: DataFrame, m: int, n_components: int | None, gamma: float | None = None,
               x_col: str = "x", out_col: str = "z") -> DataFrame:
    """(vec_id, z): RBF kernel principal coordinates, fitted on every row through m landmarks.

    A row's features are its kernel values against the landmarks times K_mm^(-1/2); their inner
    products approximate the kernel. Mean and covariance of the features are sums over all rows
    (one Gram pass), and the axes are the covariance's leading eigenvectors: m x m numbers on
    the driver, whatever the row count. ``m`` must exceed ``n_components`` (None: all);
    components without variance are dropped.
    """
    if n_components is not None and m <= n_components:
        raise ValueError(f"{n_components} components need more than {m} landmarks")
    _, lm = landmarks(df, m, x_col)
    gamma = gamma if gamma is not None else 1.0 / lm.shape[1]
    w, v = np.linalg.eigh(np.exp(-gamma * _sqdist(lm, lm)))
    keep = w > max(w[-1], 0.0) * 1e-12
    half = np.ascontiguousarray(v[:, keep] / np.sqrt(w[keep]))
    d = half.shape[1]
    MX.check_cells((lm.shape[0], lm.shape[1] + d), "the broadcast landmarks")
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((lm, half))

    def features(x: np.ndarray) -> np.ndarray:
        at, to = shared.value
        # A constant feature makes the Gram matrix carry the sums and the row count too.
        return np.hstack([np.exp(-gamma * _sqdist(x, at)) @ to, np.ones((len(x), 1))])

    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), x_col)
    # One Python worker a task from a row to its share of the sums, and a block's kernel values
    # at a time: memory follows neither the rows nor the number of steps.
    g = MX.product_array(rows, (d + 1, d + 1), x_col, fn=features)
    mean = g[:d, d] / g[d, d]
    lam, axes = np.linalg.eigh(g[:d, :d] - g[d, d] * np.outer(mean, mean))
    lam, axes = lam[::-1][:n_components], axes[:, ::-1][:, :n_components]
    axes = axes[:, lam > max(lam[0], 0.0) * 1e-10]
    idx = np.argmax(np.abs(axes), axis=0)
    axes = axes * np.sign(axes[idx, np.arange(axes.shape[1])])
    last = MX.broadcast_matrix(df.sparkSession, np.vstack([axes, -(mean @ axes)[None, :]]))
    z = MX.map_rows(rows, lambda x: np.concatenate([features(x[s]) @ last.value for s in MX.row_blocks(len(x))]),
                    x_col, out_col, keep=["vec_id"])
    return z.select("vec_id", out_col)
