"""Packed sums, separable transforms, TV systems and the one training loop against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import decompose as DC
from quillspark.operators import evaluate as E
from quillspark.operators import grid as GR
from quillspark.operators import images as IM
from quillspark.operators import kernel as KN
from quillspark.operators import logistic as LG
from quillspark.operators import matrix as MX
from quillspark.operators import spectral as SP


def _frame(spark, x, labels=None, parts=3):
    labels = labels if labels is not None else [0] * len(x)
    return spark.createDataFrame([(i, [float(v) for v in r], int(l)) for i, (r, l) in enumerate(zip(x, labels))],
                                 "vec_id long, x array<double>, label int").repartition(parts)


def _col(df, name):
    return np.array([r[name] for r in df.orderBy("vec_id").collect()])


# ---- packed sums ------------------------------------------------------------------------------
def test_packed_sums_add_element_by_element(spark, monkeypatch):
    monkeypatch.setattr(MX, "FAN_IN", 2)
    df = spark.range(0, 700, 1, 7).select((F.col("id") % 3).cast("int").alias("k"),
                                          F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    got = {r.k: list(r.v) for r in MX.add_packed(df, ["k"], "v").collect()}
    assert got == {k: [float(sum(range(k, 700, 3))), float(len(range(k, 700, 3)))] for k in range(3)}


@pytest.mark.parametrize("fan_in, rows_a_key", [(64, 7), (3, 3), (2, 1)])
def test_packed_sums_that_the_driver_ends(spark, monkeypatch, fan_in, rows_a_key):
    """Up to FAN_IN partials a key come to the driver; more are added in tasks before."""
    monkeypatch.setattr(MX, "FAN_IN", fan_in)
    df = spark.range(0, 14, 1, 7).select((F.col("id") % 2).cast("int").alias("k"),
                                         F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    sums = MX.add_packed(df, ["k"], "v", np.add, 7)
    assert sums.count() <= 2 * rows_a_key
    assert {k: list(v) for k, v in MX.collect_packed(sums).items()} == {(0,): [42.0, 7.0], (1,): [49.0, 7.0]}


@pytest.mark.parametrize("tile", [2, 3, 64])
def test_products_over_several_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(MX, "TILE", tile)
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(41, 7)), rng.normal(size=(41, 5))
    df = spark.createDataFrame([(list(map(float, a)), list(map(float, b))) for a, b in zip(x, y)] + [(None, [1.0] * 5)],
                               "x array<double>, y array<double>").repartition(4)
    assert np.allclose(MX.product_array(df, (7, 7)), x.T @ x)
    assert np.allclose(MX.product_array(df, (7, 5), "x", "y"), x.T @ y)
    g = MX.gram_matrix(df)
    assert g.count() == 49 and np.allclose(MX.collect_matrix(g, (7, 7)), x.T @ x)
    assert np.allclose(MX.collect_matrix(MX.cross_product(df), (7, 5)), x.T @ y)


def test_a_partition_sends_tiles_not_cells(spark):
    """Rows below the first shuffle: partitions x tiles (70 features: 3 tiles of the triangle)."""
    x = np.random.default_rng(1).normal(size=(40, 70))
    src = _frame(spark, x, parts=5).select("x")
    sent = []
    add = MX.add_packed
    MX.add_packed = lambda partials, keys, packed: sent.append(partials.count()) or add(partials, keys, packed)
    try:
        assert np.allclose(MX.product_array(src, (70, 70)), x.T @ x)
    finally:
        MX.add_packed = add
    assert sent[0] <= 5 * 3


def test_products_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x array<double>")
    assert MX.gram_matrix(df).collect() == []
    assert np.array_equal(MX.product_array(df, (2, 2)), np.zeros((2, 2)))


def test_map_rows_keeps_columns_and_null_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, None, "b"), (3, [3.0, 4.0], None)], "vec_id long, x array<double>, s string")
    got = {r.vec_id: (r.s, r.y) for r in MX.map_rows(df, lambda x: x.sum(axis=1, keepdims=True)).collect()}
    assert got == {1: ("a", [3.0]), 2: ("b", None), 3: (None, [7.0])}
    all_null = MX.map_rows(df.where("vec_id = 2"), lambda x: x).collect()
    assert [r.y for r in all_null] == [None]
    with pytest.raises(Exception, match="equally long"):
        MX.map_rows(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "x array<double>").coalesce(1), lambda x: x).collect()


# ---- separable transforms ------------------------------------------------------------------------
@pytest.mark.parametrize("side", [12, 0])
@pytest.mark.parametrize("n", [2, 5, 8])
def test_separable_functions_equal_the_dense_matrices(n, side, monkeypatch):
    monkeypatch.setattr(SP, "KRONECKER_SIDE", side)
    rng = np.random.default_rng(n)
    y, c = rng.normal(size=(6, n * n)), GR.cosine_basis(n)
    assert np.allclose(SP.dct2(y, c), y @ GR.dct2_matrix(n).T)
    assert np.allclose(SP.idct2(SP.dct2(y, c), c), y)
    assert np.allclose(SP.differences(y, n), y @ GR.diff_matrix(n).T)
    d = rng.normal(size=(6, 2 * n * (n - 1)))
    assert np.allclose(SP.differences_adjoint(d, n), d @ GR.diff_matrix(n))
    lap = GR.laplacian_matrix(n)
    assert np.allclose(SP.dct2(y @ lap, c), SP.dct2(y, c) * SP.grid_eigenvalues(n))


def test_cosine_transform_of_a_table_and_back(spark, monkeypatch):
    monkeypatch.setattr(SP, "BLOCK_VALUES", 100)
    x = np.random.default_rng(2).normal(size=(9, 36))
    y = SP.cosine_transform(_frame(spark, x), 6, keep=["vec_id"])
    assert np.allclose(_col(y, "y"), x @ GR.dct2_matrix(6).T)
    assert np.allclose(_col(SP.cosine_transform(y, 6, "y", "z", inverse=True), "z"), x)


@pytest.mark.parametrize("kind", ["square", "modes", "mixed modes", "any", "no mean"])
def test_tv_system_equals_the_dense_inverse(kind):
    n, gam, rng = 4, 0.7, np.random.default_rng(3)
    f = {"square": lambda: np.linalg.qr(rng.normal(size=(16, 16)))[0],
         "modes": lambda: GR.mode_vectors(n, 6),
         "mixed modes": lambda: np.linalg.qr(rng.normal(size=(6, 6)))[0] @ GR.mode_vectors(n, 6),
         "any": lambda: rng.normal(size=(5, 16)),
         "no mean": lambda: rng.normal(size=(5, 16)) @ (np.eye(16) - np.full((16, 16), 1 / 16))}[kind]()
    system, c = SP.TvSystem(f, n, gam), GR.cosine_basis(n)
    assert (system.left is None) == (kind in ("square", "modes", "mixed modes"))
    right = rng.normal(size=(7, 16))
    if kind == "no mean":
        right -= right.mean(axis=1, keepdims=True)
    phi = SP.idct2(system.solve(SP.dct2(right, c)), c)
    assert np.allclose(phi @ (gam * GR.laplacian_matrix(n) + f.T @ f), right, atol=1e-8)


def _dense_tv(x, f, res, lam, gam, rounds):
    """Split Bregman with dense matrices."""
    d = GR.diff_matrix(res)
    a = np.linalg.inv(gam * d.T @ d + f.T @ f)
    h = x @ f
    q = b = np.zeros((len(x), len(d)))
    for _ in range(rounds):
        phi = (h + gam * (q - b) @ d) @ a
        step = b + phi @ d.T
        q = np.sign(step) * np.maximum(np.abs(step) - lam / gam, 0)
        b = step - q
    return phi


@pytest.mark.parametrize("orthonormal", [True, False])
def test_tv_rounds_equal_the_dense_ones(spark, orthonormal):
    rng = np.random.default_rng(4)
    f = GR.mode_vectors(5, 9) if orthonormal else rng.normal(size=(9, 25))
    x = rng.normal(size=(7, 9))
    sm = IM.tv_smooth_images(_frame(spark, x), f, 5, lam=0.3, gam=0.5, rounds=20)
    assert np.allclose(_col(sm, "img"), _dense_tv(x, f, 5, 0.3, 0.5, 20))


def test_resolution_128_runs_on_thin_broadcasts(spark, monkeypatch):
    """No res^2 x res^2 matrix (268 M cells here) is broadcast or formed."""
    res, d = 128, 3
    monkeypatch.setattr(MX, "MAX_CELLS", 2 * res * res * d)
    f = np.stack([np.kron(GR.cosine_basis(res)[a], GR.cosine_basis(res)[b]) for a, b in GR.smoothest_mode_pairs(res, d)])
    x = np.random.default_rng(5).normal(size=(3, d))
    df = _frame(spark, x)
    img = _col(IM.embed_images(df, f), "img")
    sm = _col(IM.tv_smooth_images(df, f, res, lam=0.05, gam=0.5, rounds=4, errors=False), "img")
    assert sm.shape == (3, res * res)
    assert np.abs(SP.differences(sm, res)).sum() <= np.abs(SP.differences(img, res)).sum()
    wide = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(img)], "vec_id long, x array<double>")
    y = _col(SP.laplacian_solve(wide, res, 0.3, 0.2), "y")
    back = 0.3 * SP.differences_adjoint(SP.differences(y, res), res) + 0.2 * y
    assert np.allclose(back, img)


def test_raster_at_res_32_equals_numpy(spark):
    rng = np.random.default_rng(6)
    x, c = rng.random((5, 30)), rng.random((30, 2))
    got = _col(IM.gaussian_raster(_frame(spark, x), 32, c, 0.01), "img")
    assert np.allclose(got, x @ IM.gaussian_basis(32, c, 0.01).T)


# ---- one training loop ---------------------------------------------------------------------------
def _noisy(n=400, d=5, k=2, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    scores = x @ rng.normal(size=(d, k)) + rng.gumbel(size=(n, k))
    return x, scores.argmax(axis=1)


def _mllib_accuracy(data, reps):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    rows = data.select("role", array_to_vector("x").alias("features"), F.col("label").cast("double").alias("label"))
    out = {}
    for i, rep in enumerate(reps):
        m = LogisticRegression(family="multinomial", maxIter=200, tol=1e-9).fit(rows.where(F.get("role", F.lit(i)) == 1))
        p = m.transform(rows.where(F.get("role", F.lit(i)) == 0))
        out[rep] = p.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    return out


@pytest.mark.parametrize("k", [2, 3])
def test_accuracy_equals_separate_fits(spark, k):
    x, y = _noisy(k=k)
    df = _frame(spark, x, y)
    split = E.holdout_split(df, 3, 70)
    got = {r.rep: r.accuracy for r in E.train_logistic(df, split).collect()}
    want = _mllib_accuracy(*LG.split_table(df, split))
    assert sorted(got) == [0, 1, 2]
    for rep in want:
        assert abs(got[rep] - want[rep]) <= 0.0085  # one of 120 test rows at most


def test_moments_of_the_optimum(spark):
    """At the optimum the expected sums equal those of the class's rows."""
    x, y = _noisy(k=3, seed=1)
    df = _frame(spark, x, y)
    data, reps = LG.split_table(df, E.holdout_split(df, 2, 60))
    w = LG.fit_logistic(data, len(reps))
    got = {(r.rep, r.cls, r.feature): r.expected for r in LG.fitted_moments(data, reps, w).collect()}
    rows = {r.vec_id: r.role for r in data.collect()}
    for i, rep in enumerate(reps):
        train = np.array([rows[v][i] == 1 for v in range(len(x))])
        for c in (1, 2):
            mine = np.append(x, np.ones((len(x), 1)), axis=1)[train & (y == c)].sum(axis=0)
            assert np.allclose([got[rep, c, j] for j in range(6)], mine, atol=1e-3)


def test_jobs_do_not_follow_the_repeats(spark, monkeypatch):
    x, y = _noisy(n=120, d=3)
    df = _frame(spark, x, y)
    rounds = []
    add = MX.add_packed
    monkeypatch.setattr(MX, "add_packed", lambda *a: rounds.append(1) or add(*a))
    counts = []
    for repeats in (1, 12):
        data, reps = LG.split_table(df, E.holdout_split(df, repeats, 70))
        assert data.count() == 120  # every row once
        rounds.clear()
        LG.fit_logistic(data, len(reps))
        counts.append(len(rounds))
    assert counts[1] <= counts[0] + 3


def test_classes_that_a_plane_parts_and_single_classes(spark):
    x, _ = _noisy(n=150, d=3)
    parted = E.train_logistic(_frame(spark, x, x[:, 0] > 0), E.holdout_split(_frame(spark, x), 2, 70)).collect()
    assert all(r.accuracy > 0.9 for r in parted)
    one = E.train_logistic(_frame(spark, x), E.holdout_split(_frame(spark, x), 2, 70)).collect()
    assert [r.accuracy for r in one] == [1.0, 1.0]


def test_empty_tables_and_splits_without_test_rows(spark):
    empty = _frame(spark, np.zeros((2, 2))).where("vec_id < 0")
    split = E.holdout_split(empty, 2, 70)
    assert E.train_logistic(empty, split).collect() == []
    assert E.compare_classifiers(empty, split).collect() == []
    x, y = _noisy(n=30, d=2)
    df = _frame(spark, x, y)
    got = E.train_logistic(df, E.holdout_split(df, 1, 100)).collect()
    assert len(got) == 1 and np.isnan(got[0].accuracy)


# ---- decompositions ---------------------------------------------------------------------------------
def _graded(n=300, d=6, worst=1e-9):
    """Rows with singular values from 1 down to ``worst``."""
    rng = np.random.default_rng(7)
    u = np.linalg.qr(rng.normal(size=(n, d)))[0]
    v = np.linalg.qr(rng.normal(size=(d, d)))[0]
    return (u * np.geomspace(1, worst, d)) @ v.T, v


def test_qr_tree_keeps_small_singular_values(spark, monkeypatch):
    monkeypatch.setattr(MX, "FAN_IN", 2)
    x, v = _graded()
    df = _frame(spark, x, parts=7)
    s, own = DC.right_singular(df, 6)
    assert np.allclose(s, np.linalg.svd(x)[1], rtol=1e-5, atol=0)
    assert np.allclose(np.abs(own.T @ v), np.eye(6), atol=1e-5)
    squared, _ = np.linalg.eigh(MX.product_array(df, (6, 6)))
    assert not np.allclose(np.sqrt(np.maximum(squared[::-1], 0)), s, rtol=1e-2, atol=0)  # the Gram route


def test_principal_axes_and_embedding_at_condition_1e9(spark):
    x, v = _graded()
    w, axes = IM.principal_axes(_frame(spark, x, parts=4))
    assert np.allclose(np.abs(axes.T @ v), np.eye(6), atol=1e-5) and (np.diff(w) < 0).all()
    f = IM.image_embedding(_frame(spark, x), 3)
    assert np.allclose(f @ f.T, np.eye(6))


def test_qr_of_few_rows_and_of_none(spark):
    x = np.random.default_rng(8).normal(size=(2, 5))
    s, v = DC.right_singular(_frame(spark, x), 5)
    assert np.allclose(s[:2], np.linalg.svd(x)[1]) and np.allclose(s[2:], 0) and np.allclose(v.T @ v, np.eye(5))
    assert DC.tall_qr(_frame(spark, x).where("vec_id < 0"), 5).shape == (0, 5)


def test_lanczos_equals_the_dense_solver():
    rng = np.random.default_rng(9)
    for n in (3, 12, 40):
        q = np.linalg.qr(rng.normal(size=(n, n)))[0]
        w = np.append(np.sort(rng.normal(size=n - 1)), 5.0)
        a = (q * w) @ q.T
        got = DC.leading_vectors(lambda x: a @ x, n, 2, q[:, -1])
        want = q[:, ::-1][:, 1:3]
        assert np.allclose(np.abs((got * want).sum(axis=0)), 1.0, atol=1e-7)
    same = DC.leading_vectors(lambda x: np.zeros(6), 6, 2, np.ones(6))  # all eigenvalues equal
    assert np.allclose(same.T @ same, np.eye(2)) and np.allclose(same.sum(axis=0), 0)
    assert DC.leading_vectors(lambda x: x, 1, 2, np.ones(1)).shape == (1, 0)


def test_layout_by_lanczos_has_the_dense_ranks(spark, monkeypatch):
    """70 features: several tiles; the affinities never fit the (lowered) bounds of the driver."""
    rng = np.random.default_rng(10)
    x = rng.random((40, 70)) * np.linspace(0.2, 1.5, 70) + rng.random((40, 1)) * np.linspace(-1, 2, 70) ** 2
    df = _frame(spark, x, parts=4)
    dense = IM.feature_layout(df, 0.05)
    monkeypatch.setattr(IM, "MAX_DENSE_CELLS", 70 * 70 - 1)
    tiles = DC.affinity_tiles(df, 0.05, 70)
    a = np.exp(-0.05 * ((x[:, :, None] - x[:, None, :]) ** 2).sum(0))
    np.fill_diagonal(a, 0)
    y = rng.normal(size=70)
    assert np.allclose(DC.tiles_times(tiles, y), a @ y)
    monkeypatch.setattr(MX, "MAX_CELLS", 70 * 70 - 1)
    assert np.array_equal(IM.feature_layout(df, 0.05), dense)


# ---- the TV embedding ---------------------------------------------------------------------------
def _dense_tv_embedding(x, f0, res, lam, gam, rounds):
    """The alternating updates with dense matrices: (f, objective per round)."""
    d = GR.diff_matrix(res)
    a = np.linalg.inv(lam * d.T @ d + gam * np.eye(res * res))
    y, f, out = x @ f0, f0, []
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(x.T @ y, full_matrices=False)
        f = u @ vt
        z = np.sign(y @ d.T) * np.maximum(np.abs(y @ d.T) - lam, 0)
        y = (lam * z @ d + gam * x @ f) @ a
        out.append(np.abs(z).sum() + lam / 2 * ((z - y @ d.T) ** 2).sum() + gam / 2 * ((y - x @ f) ** 2).sum())
    return f, out


@pytest.mark.parametrize("replayed", [16, 2, 1])
def test_tv_embedding_rounds_equal_the_dense_ones(spark, monkeypatch, replayed):
    monkeypatch.setattr(IM, "REPLAYED_ROUNDS", replayed)
    stored = []
    keep = IM.checkpointed
    monkeypatch.setattr(IM, "checkpointed", lambda df: stored.append(df.columns) or keep(df))
    x = np.random.default_rng(11).normal(size=(30, 6)) * np.arange(1, 7)
    df = _frame(spark, x)
    f0 = IM.image_embedding(df, 3)
    stored.clear()
    f, objective = IM.tv_image_embedding(df, f0, 3, 0.1, 0.2, 5)
    want, values = _dense_tv_embedding(x, f0, 3, 0.1, 0.2, 5)
    assert np.allclose(f, want) and np.allclose(objective, values)
    assert (np.diff(objective) <= 1e-9).all()
    assert len(stored) == {16: 1, 2: 3, 1: 5}[replayed]  # x is written once while rounds are replayed
    assert IM.tv_image_embedding(df, f0, 3, 0.1, 0.2, 0)[1] == []


# ---- work of a round over many tasks, one worker a task -------------------------------------------
def test_training_rows_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(LG, "ROWS_PER_TRAIN_TASK", 10)
    rows = [(i % 90, [float(i), 1.0], i % 2) for i in range(95)]  # five ids come twice
    df = spark.createDataFrame(rows, "vec_id long, x array<double>, label int").coalesce(1)
    split = spark.range(90).selectExpr("0 AS rep", "id AS vec_id", "id % 3 > 0 AS is_train")
    data, reps = LG.split_table(df, split)
    sizes = data.rdd.glom().map(len).collect()
    assert reps == [0] and len(sizes) == 10 and max(sizes) <= 14
    got = sorted((r.vec_id, r.x[0], r.label, list(r.role)) for r in data.collect())
    assert got == sorted((i, x[0], y, [int(i % 3 > 0)]) for i, x, y in rows)


def test_kernel_coordinates_take_one_worker_a_task_and_equal_numpy(spark):
    x = np.random.default_rng(5).normal(size=(5000, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, x array<double>").coalesce(1)
    z = KN.kernel_pca(df, 20, None, 0.25)
    assert z._jdf.queryExecution().executedPlan().toString().count("MapIn") == 1
    got = np.array([r.z for r in z.orderBy("vec_id").collect()])
    _, lm = KN.landmarks(df, 20)
    w, v = np.linalg.eigh(np.exp(-0.25 * KN._sqdist(lm, lm)))
    phi = np.exp(-0.25 * KN._sqdist(x, lm)) @ (v / np.sqrt(w))
    phi -= phi.mean(axis=0)
    assert got.shape[0] == 5000
    assert np.allclose(got[::100] @ got[::100].T, phi[::100] @ phi[::100].T, atol=1e-8)
