"""Grid operators (array expressions) against dense NumPy."""

import numpy as np
from pyspark.sql import functions as F

from quillspark.operators import grid as GR
from quillspark.operators import images as IM
from quillspark.operators import matrix as MX
from quillspark.operators import spectral as SP


def _imgs(spark, n, k=6, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(k, n * n))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, x array<double>")
    return x, df


def _col(df, name):
    return np.array([r[name] for r in df.orderBy("vec_id").collect()])


def test_grid_edges_match_difference_matrix(spark):
    n = 5
    e = {(r.src, r.dst, r.axis) for r in GR.grid_edges(spark, n).collect()}
    d = GR.diff_matrix(n)
    want = set()
    for k, row in enumerate(d):
        a, b = np.flatnonzero(row == -1)[0], np.flatnonzero(row == 1)[0]
        want.add((int(a), int(b), 0 if k < n * (n - 1) else 1))
    assert e == want


def test_spectrum_and_modes(spark):
    n = 6
    spec = {(r.a, r.b): r.eig for r in GR.grid_spectrum(spark, n).collect()}
    assert np.allclose(sorted(spec.values()), np.linalg.eigvalsh(GR.laplacian_matrix(n)))
    modes = [(r.a, r.b) for r in GR.smoothest_modes(spark, n, 7).collect()]
    assert modes == GR.smoothest_mode_pairs(n, 7)
    c = GR.cosine_basis(n)
    a = np.eye(n, k=1)[: n - 1] - np.eye(n)[: n - 1]   # 1-D path differences
    lap1 = a.T @ a
    assert np.allclose(c @ c.T, np.eye(n))
    assert np.allclose(c @ lap1 @ c.T, np.diag(GR.path_eigenvalues(n)))


def test_diff_laplacian_match_matrices(spark):
    n = 5
    x, df = _imgs(spark, n)
    out = df.select("vec_id", GR.grid_diff_expr("x", n).alias("d"), GR.laplacian_apply_expr("x", n).alias("l"))
    assert np.allclose(_col(out, "d"), x @ GR.diff_matrix(n).T)
    assert np.allclose(_col(out, "l"), x @ GR.laplacian_matrix(n))


def test_max_pool_odd_grid(spark):
    n = 5
    x, df = _imgs(spark, n)
    got = _col(df.select("vec_id", GR.max_pool_expr("x", n).alias("m")), "m")
    want = []
    for row in x:
        im = row.reshape(n, n)
        want.append([im[r:r + 2, c:c + 2].max() for r in range(0, n, 2) for c in range(0, n, 2)])
    assert np.allclose(got, want)


def test_convolve_same_padding(spark):
    n = 6
    x, df = _imgs(spark, n)
    w = np.arange(16, dtype=float).reshape(4, 4) / 10 - 0.7
    got = _col(df.select("vec_id", GR.convolve_expr("x", n, w).alias("c")), "c")
    want = []
    for row in x:
        im = np.pad(row.reshape(n, n), ((1, 2), (1, 2)))
        want.append([(im[r:r + 4, c:c + 4] * w).sum() for r in range(n) for c in range(n)])
    assert np.allclose(got, want)


def test_laplacian_solve_solves_the_system(spark):
    n, lam, gam = 5, 0.3, 0.2
    x, df = _imgs(spark, n)
    y = _col(SP.laplacian_solve(df, n, lam, gam), "y")
    a = lam * GR.laplacian_matrix(n) + gam * np.eye(n * n)
    assert np.allclose(y @ a.T, x)


def test_gaussian_basis_frame_matches_numpy(spark):
    c = np.array([[0.1, 0.9], [0.5, 0.25], [0.0, 0.0]])
    b = IM.gaussian_basis(5, c, 0.05)
    got = {(r.p, r.k): r.w for r in IM.gaussian_basis_frame(spark, 5, c, 0.05).collect()}
    assert np.allclose([got[(p, k)] for p in range(25) for k in range(3)], b.reshape(-1))
    # pixel (r=0, c=4) is the point (1, 0): the x coordinate runs along columns
    assert np.isclose(b[4, 2], np.exp(-1.0 / 0.05))


def test_project_rows_keeps_nulls(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "vec_id long, x array<double>")
    got = {r.vec_id: r.y for r in MX.project_rows(df, np.array([[1.0], [10.0]])).collect()}
    assert got == {1: [21.0], 2: None}


def test_gram_and_cross_product(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(37, 4))
    y = rng.normal(size=(37, 2))
    df = spark.createDataFrame([(i, [float(v) for v in a], [float(v) for v in b]) for i, (a, b) in enumerate(zip(x, y))],
                               "vec_id long, x array<double>, y array<double>").repartition(3)
    assert np.allclose(MX.collect_matrix(MX.gram_matrix(df), (4, 4)), x.T @ x)
    assert np.allclose(MX.collect_matrix(MX.cross_product(df), (4, 2)), x.T @ y)
    assert MX.gram_matrix(df).where(F.col("i") == 3).count() == 4
