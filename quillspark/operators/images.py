"""Rows of a numeric table turned into small images, and the smoothing jobs on them.

Pattern throughout: statistics that sum over rows (X^T X, X^T Y) are distributed
aggregations; the small matrices they produce (d x d, d x n^2) are decomposed on the driver; the
result is broadcast back and applied to every row in Arrow batches. Nothing that grows with the
number of rows reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from quillspark.functions.arrays import explode_rows
from quillspark.functions.numeric import soft_threshold_array
from quillspark.operators import decompose as DC
from quillspark.operators import grid as GR
from quillspark.operators import matrix as MX
from quillspark.operators import spectral as SP
from quillspark.operators.features import rank_normalize_wide
from quillspark.session import checkpointed, ship_package


def _sign_fix(v: np.ndarray) -> np.ndarray:
    """Make the largest-magnitude entry of every column positive."""
    idx = np.argmax(np.abs(v), axis=0)
    s = np.sign(v[idx, np.arange(v.shape[1])])
    s[s == 0] = 1.0
    return v * s


def _shrink(x: np.ndarray, l: float) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - l, 0.0)


# ---- embedding matrices ----------------------------------------------------------------------
def principal_axes(df: DataFrame, x_col: str = "x") -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (descending) and eigenvectors (columns) of X^T X, from the R factor of X."""
    s, v = DC.right_singular(df, MX.dim_of(df, x_col), x_col)
    return s ** 2, _sign_fix(v)


def image_embedding(df: DataFrame, res: int, x_col: str = "x") -> np.ndarray:
    """d x res^2 matrix: principal axis j of X is drawn as the j-th smoothest grid mode."""
    _, v = principal_axes(df, x_col)
    d = v.shape[0]
    if d > res * res:
        raise ValueError(f"{d} features do not fit {res}x{res} pixels")
    return v @ GR.mode_vectors(res, d)


def embedding_frame(spark: SparkSession, f: np.ndarray) -> DataFrame:
    return MX.matrix_frame(spark, f, "feature", "p", "w")


def embed_images(df: DataFrame, f: np.ndarray, x_col: str = "x", out_col: str = "img") -> DataFrame:
    return MX.project_rows(df, f, x_col, out_col)


# ---- total-variation smoothing of every image (split Bregman) -------------------------------
_TV_SCHEMA = StructType([StructField("vec_id", LongType()),
                         StructField("img", ArrayType(DoubleType())),
                         StructField("sq_err", ArrayType(DoubleType()))])


def tv_smooth_images(df: DataFrame, f: np.ndarray, res: int, lam: float, gam: float,
                     rounds: int, x_col: str = "x", errors: bool = True) -> DataFrame:
    """(vec_id, img, sq_err): images minimising |D phi|_1 + fidelity to x, T rounds each.

    Images are independent, so all rounds run inside one pass over row batches. A round works in
    the cosine basis, where the system gam D^T D + f^T f is a division per mode (for an f that is
    no orthonormal set of modes, with a d x d correction); see ``spectral.TvSystem``. What is
    broadcast is f itself and the res x res basis.
    ``sq_err[t]`` is the row's squared rebuild error after round t (empty without ``errors``,
    which saves a product every round).
    """
    spark = df.sparkSession
    ship_package(spark)
    MX.check_cells(f.shape, "a broadcast matrix")
    shared = spark.sparkContext.broadcast((SP.TvSystem(f, res, gam), GR.cosine_basis(res)))

    def smooth(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        system, c = shared.value
        h = x @ system.f_hat
        phi_hat, phi = h, SP.idct2(h, c)
        q = b = np.zeros((len(x), 2 * res * (res - 1)))
        errs = np.zeros((len(x), rounds if errors else 0))
        for t in range(rounds):
            phi_hat = system.solve(h + gam * SP.dct2(SP.differences_adjoint(q - b, res), c))
            phi = SP.idct2(phi_hat, c)
            dphi = SP.differences(phi, res)
            q = _shrink(b + dphi, lam / gam)
            b = b + dphi - q
            if errors:
                errs[:, t] = ((phi_hat @ system.f_hat.T - x) ** 2).sum(axis=1)
        return phi, errs

    def run(batches):
        for b in batches:
            x = MX.column_matrix(b.column(1)) if b.num_rows else np.zeros((0, len(f)))
            for s in SP.blocks(len(x), 4 * res * res):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s.start, s.stop - s.start),
                                                  *map(MX.list_column, smooth(x[s]))], names=["vec_id", "img", "sq_err"])

    src = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(x_col).cast("array<double>").alias(x_col))
    return src.mapInArrow(run, _TV_SCHEMA)


def tv_fit_error(smoothed: DataFrame) -> DataFrame:
    """(round, err): Frobenius rebuild error of all images after each round."""
    return (explode_rows(smoothed, "sq_err", [], "e", "round")
            .groupBy("round").agg(F.sqrt(F.sum("e")).alias("err")))


def tv_objective(df: DataFrame, f: np.ndarray, res: int, lam: float, gam: float,
                 x_col: str = "x", y_col: str = "y") -> DataFrame:
    """One row: sum|z| + lam/2 |z - D y|^2 + gam/2 |y - x f|^2, z = shrink(D y, lam)."""
    xf = MX.project_rows(df, f, x_col, "_xf", keep=[x_col, y_col])
    dy = GR.grid_diff_expr(y_col, res)
    t = xf.select(dy.alias("_dy"), y_col, "_xf").withColumn("_z", soft_threshold_array("_dy", lam))
    tot = lambda arr: F.aggregate(arr, F.lit(0.0), lambda s, v: s + v)
    per = t.select(
        tot(F.transform("_z", lambda v: F.abs(v))).alias("l1"),
        tot(F.zip_with("_z", "_dy", lambda a, b: (a - b) * (a - b))).alias("fit_d"),
        tot(F.zip_with(y_col, "_xf", lambda a, b: (a - b) * (a - b))).alias("fit_x"))
    return per.agg((F.sum("l1") + F.lit(0.5 * lam) * F.sum("fit_d")
                    + F.lit(0.5 * gam) * F.sum("fit_x")).alias("objective"))


def objective_table(spark: SparkSession, objectives: list[float]) -> DataFrame:
    """(round, objective): the per-round values of ``tv_image_embedding`` as a table."""
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(objectives)],
                                 "round int, objective double")


#: Rounds of the TV embedding that are replayed from stored rows before the rows are stored anew.
REPLAYED_ROUNDS = 16


def tv_image_embedding(df: DataFrame, f0: np.ndarray, res: int, lam: float, gam: float,
                       rounds: int, x_col: str = "x") -> tuple[np.ndarray, list[float]]:
    """Embedding matrix under a TV penalty by alternating updates, and the objective per round.

    Per round: f = U V^T from the SVD of X^T Y (distributed sum, d x n^2 on the driver);
    z = shrink(Y D^T, lam) and Y = (lam L + gam I)^-1 (lam z D + gam X f) per row, solved in the
    cosine basis. A row's y follows from its x and the embeddings so far, so a round is one job
    that replays the rounds before it and sums X^T Y and the objective; the table is stored once
    and nothing is written between rounds. Every REPLAYED_ROUNDS rounds y is stored with x, which
    bounds the replay.
    """
    spark = df.sparkSession
    ship_package(spark)
    d, size = f0.shape
    scale, basis = 1.0 / (lam * SP.grid_eigenvalues(res) + gam), GR.cosine_basis(res)

    def step(x: np.ndarray, y: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, float]:
        z, xf = _shrink(SP.differences(y, res), lam), x @ f
        new = SP.idct2(SP.dct2(lam * SP.differences_adjoint(z, res) + gam * xf, basis) * scale, basis)
        objective = (np.abs(z).sum() + 0.5 * lam * ((z - SP.differences(new, res)) ** 2).sum()
                     + 0.5 * gam * ((new - xf) ** 2).sum())
        return new, objective

    def job(rows: DataFrame, fs: list[np.ndarray], what: str):
        """Rows (x, y) after the rounds ``fs``, or the tiles of X^T Y beside one of the objective."""
        MX.check_cells((len(fs), d, size), "the broadcast embeddings")
        shared = spark.sparkContext.broadcast(fs)

        def run(batches):
            total, objective = np.zeros((d, size)), 0.0
            for b in batches:
                xs, ys = MX.column_matrix(b.column(0)), MX.column_matrix(b.column(1))
                for s in SP.blocks(len(xs), 4 * size):
                    x, y, last = xs[s], ys[s], 0.0
                    for f in shared.value:
                        y, last = step(x, y, f)
                    if what == "rows":
                        yield pa.RecordBatch.from_arrays([pa.array(list(x)), pa.array(list(y))], names=["x", "y"])
                        continue
                    total += x.T @ y
                    objective += last
            if what == "sums":
                yield from MX.packed_tiles(total)
                yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([-1], pa.int32()), pa.array([1], pa.int32()),
                                                  pa.array([[objective]])], names=["ti", "tj", "width", "tile"])

        if what == "rows":
            return checkpointed(rows.mapInArrow(run, "x array<double>, y array<double>"))
        found = list(MX.add_tiles(rows.mapInArrow(run, MX.TILES)).toLocalIterator())  # d x n^2 cells
        return (MX.collect_tiles((r for r in found if r["ti"] >= 0), (d, size)),
                sum(r["tile"][0] for r in found if r["ti"] < 0))

    there = df.where(F.col(x_col).isNotNull()).select(F.col(x_col).cast("array<double>").alias("x"))
    rows = checkpointed(MX.project_rows(there, f0, "x", "y"))
    fs, f, objectives = [], f0, []
    for no in range(rounds):
        xty, objective = job(rows, fs, "sums")
        if no:
            objectives.append(float(objective))
        if len(fs) == REPLAYED_ROUNDS:
            rows, fs = job(rows, fs, "rows"), []
        u, _, vt = np.linalg.svd(xty, full_matrices=False)
        f = u @ vt
        fs.append(f)
    if rounds:
        objectives.append(float(job(rows, fs, "sums")[1]))
    return f, objectives


# ---- Gaussian splats ----------------------------------------------------------------------------
def gaussian_basis(res: int, centres: np.ndarray, sigma: float) -> np.ndarray:
    """res^2 x k: exp(-|centre - pixel|^2 / sigma); pixel (r, c) sits at (c, r) / (res - 1)."""
    p = np.arange(res * res)
    px = (p % res) / (res - 1)
    py = (p // res) / (res - 1)
    c = np.asarray(centres, dtype=float)
    d2 = (c[None, :, 0] - px[:, None]) ** 2 + (c[None, :, 1] - py[:, None]) ** 2
    return np.exp(-d2 / sigma)


def gaussian_basis_frame(spark: SparkSession, res: int, centres: np.ndarray, sigma: float) -> DataFrame:
    """(p, k, w) built by Spark from the pixel range and the centre list."""
    c = np.asarray(centres, dtype=float)
    cx = F.array(*[F.lit(float(v)) for v in c[:, 0]])
    cy = F.array(*[F.lit(float(v)) for v in c[:, 1]])
    px = spark.range(res * res).select(F.col("id").cast("int").alias("p"))
    g = px.select("p", F.explode(F.sequence(F.lit(0), F.lit(len(c) - 1))).alias("k"))
    x = (F.col("p") % res) / F.lit(res - 1)
    y = (F.col("p") / res).cast("int") / F.lit(res - 1)
    d2 = F.pow(F.get(cx, F.col("k")) - x, 2) + F.pow(F.get(cy, F.col("k")) - y, 2)
    return g.select("p", "k", F.exp(-d2 / F.lit(sigma)).alias("w"))


def gaussian_factors(res: int, centres: np.ndarray, sigma: float) -> tuple[np.ndarray, np.ndarray]:
    """(down, across), both res x k: a Gaussian of the plane is the product of its two axes'."""
    at = np.arange(res) / (res - 1)
    c = np.asarray(centres, dtype=float)
    return tuple(np.exp(-(c[None, :, axis] - at[:, None]) ** 2 / sigma) for axis in (1, 0))


def gaussian_raster(df: DataFrame, res: int, centres: np.ndarray, sigma: float, x_col: str = "x",
                    out_col: str = "img") -> DataFrame:
    """Image of a row = sum over features of value x that feature's Gaussian; a row whose
    number of features is not the number of Gaussians is an error.

    The Gaussians are separable, so an image is one product of two thin factors, the first
    scaled by the row: 2 x res x k numbers are broadcast instead of the res^2 x k basis.
    """
    k = len(centres)
    fits = F.size(x_col) == k
    wrong = F.raise_error(F.format_string(f"a row has %d features for {k} Gaussians", F.size(x_col)))
    src = df.withColumn("_xk", F.when(fits, F.col(x_col)).otherwise(wrong.cast("array<double>")))
    MX.check_cells((2, res, k), "the broadcast factors")
    shared = df.sparkSession.sparkContext.broadcast(gaussian_factors(res, centres, sigma))

    def paint(x: np.ndarray) -> np.ndarray:
        down, across = shared.value
        out = np.empty((len(x), res * res))
        for s in SP.blocks(len(x), res * max(res, k)):
            out[s] = ((x[s][:, None, :] * down) @ across.T).reshape(-1, res * res)
        return out

    return MX.map_rows(src, paint, "_xk", out_col).drop("_xk")


def feature_affinity(df: DataFrame, gamma: float, x_col: str = "x") -> DataFrame:
    """(i, j, a): RBF affinity between feature columns, d2 = G_ii + G_jj - 2 G_ij."""
    g = MX.gram_matrix(df, x_col)
    # one row per feature, as many as a row has values: no job needed to count them
    diag = F.broadcast(g.where(F.col("i") == F.col("j")).select(F.col("i").alias("_k"), F.col("g").alias("_d")))
    di = diag.select(F.col("_k").alias("i"), F.col("_d").alias("gi"))
    dj = diag.select(F.col("_k").alias("j"), F.col("_d").alias("gj"))
    t = g.join(di, "i").join(dj, "j")
    d2 = F.greatest(F.col("gi") + F.col("gj") - F.lit(2.0) * F.col("g"), F.lit(0.0))
    return t.select("i", "j", F.exp(F.lit(-gamma) * d2).alias("a"))


def spectral_layout(affinity: np.ndarray) -> np.ndarray:
    """d x 2: the two smoothest non-constant eigenvectors of the normalised Laplacian.

    Self-affinities are ignored; vectors are divided by sqrt(degree) and signed so their
    largest entry is positive.
    """
    a = np.array(affinity, dtype=float)
    np.fill_diagonal(a, 0.0)
    deg = a.sum(axis=0)
    s = np.sqrt(deg)
    s[s == 0] = 1.0
    lap = np.eye(len(a)) - a / s[:, None] / s[None, :]
    _, v = np.linalg.eigh(lap)
    emb = v[:, :3] / s[:, None]
    emb = _sign_fix(emb)
    return emb[:, 1:3]


#: Cells of an affinity matrix that the driver decomposes itself (2,048 features); beyond,
#: the same vectors come from products on the executors.
MAX_DENSE_CELLS = 1 << 22


def feature_layout(df: DataFrame, gamma: float, x_col: str = "x") -> np.ndarray:
    """d x 2 plane positions of the features: spectral layout, coordinates -> rank / d.

    With more than MAX_DENSE_CELLS affinities these stay on the executors, in tiles, and the
    layout's two vectors are found by Lanczos rounds; only vectors reach the driver.
    """
    d = MX.dim_of(df, x_col)
    if d * d <= min(MAX_DENSE_CELLS, MX.MAX_CELLS):
        emb = spectral_layout(MX.collect_matrix(feature_affinity(df, gamma, x_col)
                                                .select("i", "j", F.col("a").alias("g")), (d, d)))
    else:
        emb = tiled_layout(DC.affinity_tiles(df, gamma, d, x_col), d)
    out = np.zeros_like(emb)
    for k in range(emb.shape[1]):
        out[np.argsort(emb[:, k], kind="stable"), k] = np.arange(d)
    return out / max(d, 1)


def tiled_layout(tiles: DataFrame, d: int) -> np.ndarray:
    """``spectral_layout`` of an affinity matrix in tiles. The constant vector of the normalised
    Laplacian is known, sqrt(degree); the two smoothest others are the leading vectors of the
    scaled affinities beside it."""
    degree = DC.tiles_times(tiles, np.ones(d))
    s = np.sqrt(degree)
    s[s == 0] = 1.0
    v = DC.leading_vectors(lambda x: DC.tiles_times(tiles, x / s) / s, d, 2, np.sqrt(degree))
    return _sign_fix(v / s[:, None])


def splat_images(df: DataFrame, res: int, sigma: float, gamma: float,
                 layout: np.ndarray | None = None) -> DataFrame:
    """(vec_id, img, label): rank-normalise, lay features out on the plane, paint each row
    as a sum of Gaussians at its features' positions (``layout``: positions given, d x 2)."""
    ranked = checkpointed(rank_normalize_wide(df))
    if layout is None:
        layout = feature_layout(ranked, gamma)
    return gaussian_raster(ranked, res, layout, sigma)
