"""Fixed small inputs used with the feature table (F7 of FIXTURES.md).

Fixed values: a 3 x 64 matrix m[k][p] = ((k*64 + p*7) % 13 - 6) / 10; a 4 x 4 kernel
w[i][j] = (i - 2*j + 1) / 8; eight centres (k/8, ((3*k) % 8)/8) with sigma 0.05;
landmarks = the 32 rows smallest by md5 of the id text.
"""

from __future__ import annotations

import numpy as np

RES = 8            # 64 = 8 x 8 pixels per embedding
N_CENTRES = 64
SIGMA = 0.05
N_LANDMARKS = 32
N_FIT_LANDMARKS = 96


def score_matrix(k: int = 3, d: int = 64) -> np.ndarray:
    """k x d matrix m."""
    kk, pp = np.indices((k, d))
    return (((kk * 64 + pp * 7) % 13) - 6) / 10.0


def conv_kernel() -> np.ndarray:
    i, j = np.indices((4, 4))
    return (i - 2 * j + 1) / 8.0


def centres() -> np.ndarray:
    k = np.arange(N_CENTRES)
    return np.stack([(k % 8) / 8.0, ((3 * k + k // 8) % 8) / 8.0], axis=1)
