"""Image jobs: invariants and equality with dense NumPy on small inputs."""

import numpy as np
import pytest

from quillspark.operators import grid as GR
from quillspark.operators import images as IM
from quillspark.operators import kernel as KN
from quillspark.operators import matrix as MX


def _frame(spark, x, labels=None):
    labels = labels if labels is not None else [0] * len(x)
    return spark.createDataFrame([(i, [float(v) for v in r], int(l)) for i, (r, l) in enumerate(zip(x, labels))],
                                 "vec_id long, x array<double>, label int")


def _col(df, name):
    return np.array([r[name] for r in df.orderBy("vec_id").collect()])


def _variation(x, f, res):
    return float(np.sum((x.T @ x @ f) * (f @ GR.laplacian_matrix(res))))


def test_image_embedding_orthonormal_and_smoothest(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 9)) * np.arange(1, 10)
    f = IM.image_embedding(_frame(spark, x), 4)
    assert f.shape == (9, 16)
    assert np.allclose(f @ f.T, np.eye(9))
    best = _variation(x, f, 4)
    for _ in range(50):
        q, _ = np.linalg.qr(rng.normal(size=(16, 9)))
        assert best <= _variation(x, q.T, 4) + 1e-9
    imgs = _col(IM.embed_images(_frame(spark, x), f), "img")
    assert np.allclose(np.linalg.norm(imgs, axis=1), np.linalg.norm(x, axis=1))


def test_embedding_variation_equals_sum_of_squared_differences(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 16))
    f = GR.dct2_matrix(4)
    y = x @ f
    assert np.isclose(_variation(x, f, 4), np.sum((y @ GR.diff_matrix(4).T) ** 2))


def _tv_dual(res, h, lam, steps=4000):
    """argmin over y of |y - h|^2 / 2 + lam |D y|_1 by projected gradient on the dual:
    y = h - D'u, where u minimises |h - D'u|^2 / 2 over the box |u| <= lam."""
    d = GR.diff_matrix(res)
    u = np.zeros(d.shape[0])
    rate = 1 / np.linalg.norm(d, 2) ** 2
    for _ in range(steps):
        u = np.clip(u + rate * d @ (h - d.T @ u), -lam, lam)
    return h - d.T @ u


def test_tv_smooth_images_converges_to_the_minimum(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6, 16))
    f = IM.image_embedding(_frame(spark, x), 4)
    sm = IM.tv_smooth_images(_frame(spark, x).repartition(3), f, 4, lam=0.3, gam=0.5, rounds=600)
    want = np.stack([_tv_dual(4, h, 0.3) for h in x @ f])
    assert np.allclose(_col(sm, "img"), want, atol=1e-4)


def test_tv_fit_error_is_the_distance_to_the_rows(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(8, 16))
    f = IM.image_embedding(_frame(spark, x), 4)
    sm = IM.tv_smooth_images(_frame(spark, x), f, 4, lam=0.3, gam=0.5, rounds=5)
    err = {r["round"]: r.err for r in IM.tv_fit_error(sm).collect()}
    assert sorted(err) == list(range(5))
    assert np.isclose(err[4], np.linalg.norm(_col(sm, "img") @ f.T - x))


def test_tv_image_embedding_keeps_orthonormal_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 9))
    df = _frame(spark, x)
    f0 = IM.image_embedding(df, 4)
    f, obj = IM.tv_image_embedding(df, f0, 4, lam=0.1, gam=0.1, rounds=3)
    assert np.allclose(f @ f.T, np.eye(9))
    assert len(obj) == 3 and all(np.isfinite(obj))


def test_tv_objective_matches_formula(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(10, 16))
    f = GR.dct2_matrix(4)
    y = x @ f + 0.01 * rng.normal(size=(10, 16))
    df = spark.createDataFrame([(i, [float(v) for v in a], [float(v) for v in b]) for i, (a, b) in enumerate(zip(x, y))],
                               "vec_id long, x array<double>, y array<double>")
    got = IM.tv_objective(df, f, 4, lam=0.1, gam=0.2).first().objective
    dy = y @ GR.diff_matrix(4).T
    z = np.sign(dy) * np.maximum(np.abs(dy) - 0.1, 0)
    want = np.abs(z).sum() + 0.05 * ((z - dy) ** 2).sum() + 0.1 * ((y - x @ f) ** 2).sum()
    assert np.isclose(got, want)


def test_kernel_pca_all_rows_equals_dense(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(25, 4))
    g = 0.3
    z = _col(KN.kernel_pca(_frame(spark, x), 25, 5, g), "z")
    assert z.shape == (25, 5)
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    k = np.exp(-g * d2)
    one = np.full((25, 25), 1 / 25)
    kc = k - one @ k - k @ one + one @ k @ one
    w, v = np.linalg.eigh(kc)
    w, v = w[::-1][:5], v[:, ::-1][:, :5]
    dense = v * np.sqrt(w)
    assert np.allclose(z @ z.T, dense @ dense.T, atol=1e-8)
    assert np.allclose(np.abs(z), np.abs(dense), atol=1e-8)


def test_rbf_pairs(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(12, 3))
    lm = x[:4]
    k = _col(KN.rbf_pairs(_frame(spark, x), lm, 0.5), "k")
    assert np.allclose(k, np.exp(-0.5 * ((x[:, None] - lm[None]) ** 2).sum(-1)))


def test_feature_layout_is_a_rank_permutation(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(50, 10)) @ rng.normal(size=(10, 10))
    lay = IM.feature_layout(_frame(spark, x), 0.01)
    for k in range(2):
        assert sorted(lay[:, k] * 10) == list(range(10))


def test_splat_images_equal_numpy(spark):
    rng = np.random.default_rng(8)
    n, d, res = 30, 6, 5
    x = rng.normal(size=(n, d))
    got = _col(IM.splat_images(_frame(spark, x), res, sigma=0.05, gamma=0.01), "img")
    r = np.empty_like(x)
    for j in range(d):
        r[np.lexsort((np.arange(n), x[:, j])), j] = np.arange(n)
    r /= n
    d2 = ((r[:, :, None] - r[:, None, :]) ** 2).sum(0)
    emb = IM.spectral_layout(np.exp(-0.01 * d2))
    lay = np.zeros_like(emb)
    for k in range(2):
        lay[np.argsort(emb[:, k], kind="stable"), k] = np.arange(d)
    want = r @ IM.gaussian_basis(res, lay / d, 0.05).T
    assert np.allclose(got, want)


def test_collect_matrix_shape(spark):
    m = np.arange(6.0).reshape(2, 3)
    assert np.allclose(MX.collect_matrix(MX.matrix_frame(spark, m)), m)


def test_objective_table(spark):
    t = IM.objective_table(spark, [3.0, 2.5])
    assert [tuple(r) for r in t.orderBy("round").collect()] == [(0, 3.0), (1, 2.5)]


def test_kernel_pca_gives_the_components_asked_and_every_row_has_a_say(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 16))
    assert _col(KN.kernel_pca(_frame(spark, x), 64, 32, 0.1), "z").shape == (200, 32)
    ids, _ = KN.landmarks(_frame(spark, x), 12)
    other = next(i for i in range(200) if i not in ids)
    y = x.copy()
    y[other] *= 5
    a, b = (_col(KN.kernel_pca(_frame(spark, m), 12, 5, 0.1), "z") for m in (x, y))
    first = next(i for i in range(200) if i != other)
    assert not np.allclose(np.abs(a[first]), np.abs(b[first]), atol=1e-9)
    with pytest.raises(ValueError):
        KN.kernel_pca(_frame(spark, x), 5, 5, 0.1)


def test_raster_wants_a_gaussian_for_every_feature(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=(4, 3))
    c = rng.random((3, 2))
    assert np.allclose(_col(IM.gaussian_raster(_frame(spark, x), 4, c, 0.05), "img"), x @ IM.gaussian_basis(4, c, 0.05).T)
    with pytest.raises(Exception, match="3 features for 2 Gaussians"):
        IM.gaussian_raster(_frame(spark, x), 4, c[:2], 0.05).collect()


def test_matrices_beyond_the_bound_are_refused(spark, monkeypatch):
    monkeypatch.setattr(MX, "MAX_CELLS", 5)
    with pytest.raises(ValueError, match="over 5 cells"):
        MX.broadcast_matrix(spark, np.zeros((2, 3)))
    with pytest.raises(ValueError, match="over 5 cells"):
        MX.collect_matrix(MX.matrix_frame(spark, np.zeros((2, 3))))
