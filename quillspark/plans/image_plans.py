"""Image jobs, kernels and classifier evaluation on the feature table (F6-F9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import numeric as N
from quillspark.functions.arrays import explode_rows
from quillspark.operators import evaluate as E
from quillspark.operators import features as FT
from quillspark.operators import images as IM
from quillspark.operators import kernel as KN
from quillspark.operators import logistic as LG
from quillspark.operators import matrix as MX
from quillspark.plans.feature_plans import feats
from quillspark.plans.registry import register
from quillspark.session import checkpointed
from quillspark.sources import constants as K

n = K.RES
_LONG = """SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS p,
CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings"""


def _explode(df, col, idx="p", val="v", digits=6):
    return explode_rows(df, col, ["vec_id"], val, idx).select("vec_id", idx, F.round(val, digits).alias(val))


# ---- kernels and affinities ----------------------------------------------------------------------
@register("feature_affinity", f"""
WITH l AS ({_LONG})
SELECT a.p AS i, b.p AS j, round(exp(-0.01 * sum((a.v - b.v) * (a.v - b.v))), 6) AS a
FROM l a JOIN l b ON a.vec_id = b.vec_id GROUP BY 1, 2""")
def feature_affinity(spark, sf):
    return IM.feature_affinity(feats(spark, sf), 0.01).select("i", "j", F.round("a", 6).alias("a"))


@register("rbf_pairs", f"""
WITH l AS ({_LONG}),
lm AS (SELECT vec_id FROM embeddings ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id LIMIT {K.N_LANDMARKS}),
b AS (SELECT l.* FROM l JOIN lm ON l.vec_id = lm.vec_id)
SELECT a.vec_id, b.vec_id AS lm, round(exp(-sum((a.v - b.v) * (a.v - b.v)) / 64), 6) AS k
FROM l a JOIN b ON a.p = b.p GROUP BY 1, 2""")
def rbf_pairs(spark, sf):
    x = feats(spark, sf)
    ids, lm = KN.landmarks(x, K.N_LANDMARKS)
    k = KN.rbf_pairs(x, lm, 1.0 / 64)
    ids_arr = F.array(*[F.lit(int(i)).cast("bigint") for i in ids])
    return explode_rows(k, "k", ["vec_id"], "k", "_j") \
        .select("vec_id", F.get(ids_arr, F.col("_j")).alias("lm"), F.round("k", 6).alias("k"))


@register("gaussian_raster", f"""
WITH l AS ({_LONG}),
c AS (SELECT CAST(range AS INTEGER) AS k, (range % 8) / 8 AS cx,
  ((3 * range + range // 8) % 8) / 8 AS cy FROM range({K.N_CENTRES})),
px AS (SELECT CAST(range AS INTEGER) AS p, (range % {n}) / {n - 1} AS x, (range // {n}) / {n - 1} AS y
       FROM range({n * n}))
SELECT l.vec_id, px.p, round(sum(l.v * exp(-((c.cx - px.x) ^ 2 + (c.cy - px.y) ^ 2) / {K.SIGMA})), 6) AS v
FROM l JOIN c ON l.p = c.k CROSS JOIN px GROUP BY 1, 2""")
def gaussian_raster(spark, sf):
    """All features painted as Gaussians at the fixed centres (sigma 0.05)."""
    return _explode(IM.gaussian_raster(feats(spark, sf), n, K.centres(), K.SIGMA), "img")


# The next jobs rest on eigenvectors, which SQL cannot compute. A query with SQL returns what
# follows from the data whatever solver was used (distances, reconstructions, pixels with a closed
# form); the query beside it without SQL returns the job's own result, which tests/ compare with
# NumPy.
_PAIRS = f"""WITH l AS ({_LONG}),
lm AS (SELECT vec_id FROM embeddings ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id LIMIT {K.N_LANDMARKS}),
b AS (SELECT l.* FROM l JOIN lm ON l.vec_id = lm.vec_id)"""
# Products of rows that follow each other by id.
_NEIGHBOURS = f"""WITH l AS ({_LONG})
SELECT a.vec_id, round(sum(a.v * b.v), 6) AS dot
FROM l a JOIN l b ON b.vec_id = a.vec_id + 1 AND b.p = a.p GROUP BY a.vec_id"""


def _neighbour_products(images):
    """(vec_id, dot): inner products of the images of rows that follow each other by id."""
    after = images.select((F.col("vec_id") - 1).alias("vec_id"), F.col("img").alias("_next"))
    dot = F.aggregate(F.zip_with("img", "_next", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return images.join(after, "vec_id").select("vec_id", (F.round(dot, 6) + 0.0).alias("dot"))


@register("kernel_pca", f"""{_PAIRS}
SELECT a.vec_id AS i, c.vec_id AS j, round(2 - 2 * exp(-sum((a.v - c.v) * (a.v - c.v)) / 64), 6) AS d2
FROM b a JOIN b c ON a.p = c.p AND a.vec_id < c.vec_id GROUP BY 1, 2""")
def kernel_pca(spark, sf):
    """(i, j, d2): squared distances of the first landmarks in the RBF kernel's principal
    coordinates (all components, fitted on all rows, gamma 1/64). There the landmarks lie as the
    kernel says: d2 = 2 - 2 k."""
    x = feats(spark, sf)
    ids, _ = KN.landmarks(x, K.N_LANDMARKS)
    z = KN.kernel_pca(x, K.N_FIT_LANDMARKS, None, 1.0 / 64).where(F.col("vec_id").isin([int(i) for i in ids]))
    z = checkpointed(z)
    other = F.broadcast(z.select(F.col("vec_id").alias("j"), F.col("z").alias("zj")))  # N_LANDMARKS rows
    d2 = F.aggregate(F.zip_with("z", "zj", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    return z.join(other, F.col("vec_id") < F.col("j")).select(F.col("vec_id").alias("i"), "j", F.round(d2, 6).alias("d2"))


@register("kernel_coordinates")
def kernel_coordinates(spark, sf):
    """(vec_id, component, z): the 32 leading RBF kernel principal coordinates of every row."""
    return _explode(KN.kernel_pca(feats(spark, sf), K.N_FIT_LANDMARKS, 32, 1.0 / 64), "z", "component", "z")


# ---- image embeddings -----------------------------------------------------------------------------
@register("image_embedding", f"""
WITH l AS ({_LONG})
SELECT a.p AS i, b.p AS j, round(sum(a.v * b.v), 6) AS g
FROM l a JOIN l b ON a.vec_id = b.vec_id GROUP BY 1, 2""")
def image_embedding(spark, sf):
    """(i, j, g): X^T X rebuilt from the embedding. Its coefficients on the smoothest 8 x 8 grid
    modes are the axes, and the energy of the images on a mode is that axis's eigenvalue; both
    are right only if together they give the table's own X^T X."""
    x = feats(spark, sf)
    axes = IM.image_embedding(x, n) @ IM.GR.mode_vectors(n, 64).T
    on_modes = MX.project_rows(x, axes, keep=["vec_id"])
    energy = MX.product_array(on_modes, (64, 64), "y").diagonal()
    return MX.matrix_frame(spark, (axes * energy) @ axes.T).select("i", "j", (F.round("g", 6) + 0.0).alias("g"))


@register("image_embedding_weights")
def image_embedding_weights(spark, sf):
    """(feature, p, w): the embedding matrix, principal axes drawn as the smoothest grid modes."""
    return IM.embedding_frame(spark, IM.image_embedding(feats(spark, sf), n))


@register("embed_images", f"""
SELECT vec_id, round(sqrt(sum(v * v)), 6) AS norm FROM ({_LONG}) GROUP BY vec_id""")
def embed_images(spark, sf):
    """The norm of every row's image, which is the norm of the row."""
    x = feats(spark, sf)
    img = IM.embed_images(x, IM.image_embedding(x, n))
    square = F.aggregate("img", F.lit(0.0), lambda s, v: s + v * v)
    return img.select("vec_id", F.round(F.sqrt(square), 6).alias("norm"))


@register("embedded_images")
def embedded_images(spark, sf):
    """(vec_id, p, v): the pixels of every row's image under the principal-axis embedding."""
    x = feats(spark, sf)
    return _explode(IM.embed_images(x, IM.image_embedding(x, n)), "img")


# While no gradient sum has reached lam / gam (100 here, on values of order 1), a round divides
# the coefficient of a mode by 1 + gam * eigenvalue, so that rounds have a closed form; tests
# compare rounds that do shrink with dense NumPy.
_SMOOTHED = f"""WITH l AS ({_LONG}),
c AS (SELECT CAST(k.range AS INTEGER) AS k, CAST(j.range AS INTEGER) AS j,
  CASE WHEN k.range = 0 THEN sqrt(1.0 / {n}) ELSE sqrt(2.0 / {n}) END
    * cos(pi() * k.range * (2 * j.range + 1) / (2.0 * {n})) AS c FROM range({n}) k, range({n}) j),
m AS (SELECT CAST(range AS INTEGER) AS p, 1 + 0.1 * ((2 - 2 * cos(pi() * (range // {n}) / {n}))
  + (2 - 2 * cos(pi() * (range % {n}) / {n}))) AS grow FROM range({n * n}))"""


def _smoothed(spark, sf, errors):
    return IM.tv_smooth_images(feats(spark, sf), IM.GR.dct2_matrix(n), n, lam=10.0, gam=0.1, rounds=100, errors=errors)


@register("tv_smooth_images", f"""{_SMOOTHED}
SELECT l.vec_id, a.j * {n} + b.j AS p, round(sum(l.v / m.grow ** 100 * a.c * b.c), 6) AS v
FROM l JOIN m ON l.p = m.p JOIN c a ON a.k = l.p // {n} JOIN c b ON b.k = l.p % {n} GROUP BY 1, 2""")
def tv_smooth_images(spark, sf):
    """(vec_id, p, v): the images of the cosine embedding after 100 rounds of split-Bregman TV
    smoothing, lam 10, gam 0.1."""
    return _explode(_smoothed(spark, sf, False), "img")


@register("tv_fit_error", f"""{_SMOOTHED}
SELECT CAST(t.range AS INTEGER) AS "round", round(sqrt(sum((l.v / m.grow ** (t.range + 1) - l.v) ** 2)), 6) AS err
FROM l JOIN m ON l.p = m.p, range(100) t GROUP BY 1""")
def tv_fit_error(spark, sf):
    """(round, err): distance between the rows and their rebuild from the smoothed images."""
    return IM.tv_fit_error(_smoothed(spark, sf, True)).select("round", F.round("err", 6).alias("err"))


def _tv_embedding(spark, sf):
    x = feats(spark, sf)
    return IM.tv_image_embedding(x, IM.image_embedding(x, n), n, lam=0.1, gam=0.1, rounds=10)


@register("tv_image_embedding", _NEIGHBOURS)
def tv_image_embedding(spark, sf):
    """(vec_id, dot): products of the images of neighbouring rows under the embedding after 10
    alternating TV rounds (lam = gam = 0.1) from the principal-axis embedding. Its rows stay
    orthonormal, so the products are those of the rows."""
    f, _ = _tv_embedding(spark, sf)
    return _neighbour_products(IM.embed_images(feats(spark, sf).select("vec_id", "x"), f))


@register("tv_embedding_objective")
def tv_embedding_objective(spark, sf):
    """(round, objective) of those rounds."""
    return IM.objective_table(spark, _tv_embedding(spark, sf)[1])


def _layout(spark, sf):
    from quillspark.operators.features import rank_normalize_wide
    return IM.feature_layout(rank_normalize_wide(feats(spark, sf)), 0.01)


@register("feature_layout", """
SELECT CAST(a.range AS INTEGER) AS axis, d.range / (SELECT max(len(embedding)) FROM embeddings) AS v
FROM range(2) a, range((SELECT max(len(embedding)) FROM embeddings)) d""")
def feature_layout(spark, sf):
    """Features of the rank-normalised table on the plane, gamma 0.01: (axis, v) positions,
    which are the ranks / d on either axis."""
    return MX.matrix_frame(spark, _layout(spark, sf), "feature", "axis", "v").select("axis", "v")


@register("feature_positions")
def feature_positions(spark, sf):
    """(feature, axis, v): which feature has which of those positions."""
    return MX.matrix_frame(spark, _layout(spark, sf), "feature", "axis", "v")


@register("splat_images", f"""
WITH l AS ({_LONG}),
r AS (SELECT vec_id, p, (row_number() OVER (PARTITION BY p ORDER BY v, vec_id) - 1)
        / (count(*) OVER (PARTITION BY p))::DOUBLE AS r FROM l),
c AS (SELECT CAST(range AS INTEGER) AS k, (range % 8) / 8 AS cx,
  ((3 * range + range // 8) % 8) / 8 AS cy FROM range({K.N_CENTRES})),
px AS (SELECT CAST(range AS INTEGER) AS p, (range % {n}) / {n - 1} AS x, (range // {n}) / {n - 1} AS y
       FROM range({n * n}))
SELECT r.vec_id, px.p, round(sum(r.r * exp(-((c.cx - px.x) ^ 2 + (c.cy - px.y) ^ 2) / 0.01)), 6) AS v
FROM r JOIN c ON r.p = c.k CROSS JOIN px GROUP BY 1, 2""")
def splat_images(spark, sf):
    """Rank-normalise and paint each row with sigma 0.01 Gaussians (8 x 8) on the fixed layout."""
    return _explode(IM.splat_images(feats(spark, sf), n, sigma=0.01, gamma=0.01, layout=K.centres()), "img")


# The splat chain: splats, values clipped to [0, 98th percentile], the first 36 images of every
# class, and both classifiers compared on the clipped images.
def _clipped_splats(spark, sf, layout=None):
    img = IM.splat_images(_learnable(spark, sf), n, sigma=0.01, gamma=0.01, layout=layout)
    img = checkpointed(img.select("vec_id", F.col("img").alias("x"), "label"))
    return FT.clip_range(img, None, 0.98)


def _gallery(images):
    top = FT.top_n_per_class(images, 36)
    return explode_rows(top, "x", ["vec_id", "label", "pos"], "v", "p") \
        .select("vec_id", "label", "pos", "p", F.round("v", 6).alias("v"))


@register("splat_gallery", f"""
WITH l AS ({_LONG}),
r AS (SELECT vec_id, p, (row_number() OVER (PARTITION BY p ORDER BY v, vec_id) - 1)
        / (count(*) OVER (PARTITION BY p))::DOUBLE AS r FROM l),
c AS (SELECT CAST(range AS INTEGER) AS k, (range % 8) / 8 AS cx,
  ((3 * range + range // 8) % 8) / 8 AS cy FROM range({K.N_CENTRES})),
px AS (SELECT CAST(range AS INTEGER) AS p, (range % {n}) / {n - 1} AS x, (range // {n}) / {n - 1} AS y
       FROM range({n * n})),
s AS (SELECT r.vec_id, px.p, sum(r.r * exp(-((c.cx - px.x) ^ 2 + (c.cy - px.y) ^ 2) / 0.01)) AS v
      FROM r JOIN c ON r.p = c.k CROSS JOIN px GROUP BY 1, 2),
top AS (SELECT * FROM (
  SELECT vec_id, CAST(embedding[1] > 0 AS INTEGER) AS label,
    CAST(row_number() OVER (PARTITION BY embedding[1] > 0 ORDER BY vec_id) - 1 AS BIGINT) AS pos FROM embeddings)
  WHERE pos < 36)
SELECT s.vec_id, label, pos, p, round(least(greatest(v, 0), (SELECT quantile_cont(v, 0.98) FROM s)), 6) AS v
FROM s JOIN top ON s.vec_id = top.vec_id""")
def splat_gallery(spark, sf):
    """(vec_id, label, pos, p, v): the clipped splat images of the first 36 rows of every class,
    on the fixed layout."""
    return _gallery(_clipped_splats(spark, sf, K.centres()))


@register("splat_gallery_spectral")
def splat_gallery_spectral(spark, sf):
    """The same on the layout that the features' affinities give."""
    return _gallery(_clipped_splats(spark, sf))


# A classifier's accuracy is its own result and has no SQL. The SQL counts are of the stored
# predictions: every test row of a repeat is predicted once by every model, with its own label.
_COUNTS = """
WITH s AS (
  SELECT rep, vec_id, pos, n FROM (SELECT rep, vec_id,
    row_number() OVER (PARTITION BY rep ORDER BY md5(CAST(vec_id AS VARCHAR) || ':' || CAST(rep AS VARCHAR)), vec_id) - 1 AS pos,
    count(*) OVER (PARTITION BY rep) AS n
  FROM embeddings, (SELECT CAST(range AS INTEGER) AS rep FROM range(9)))),
t AS (SELECT s.rep, CAST(e.embedding[1] > 0 AS INTEGER) AS label FROM s JOIN embeddings e ON e.vec_id = s.vec_id
      WHERE s.pos >= (s.n * 70) // 100)
SELECT rep, m.model, label, count(*) AS n_test FROM t, (VALUES ('logistic'), ('mlp')) m(model) GROUP BY 1, 2, 3"""


def _predictions(images):
    split = E.holdout_split(images, repeats=9, train_pct=70)
    return E.classifier_predictions(images, split, hidden=(16,), max_iter=100)[0]


def _test_counts(found):
    return found.groupBy("rep", "model", "label").agg(F.count(F.lit(1)).alias("n_test"))


def _confusion(found):
    """(rep, model, label, pred, n): the confusion counts of every repeat."""
    return found.groupBy("rep", "model", "label", "pred").agg(F.count(F.lit(1)).alias("n"))


def _scores_by_rep(found):
    return found.groupBy("rep", "model").agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"))


@register("splat_comparison", _COUNTS)
def splat_comparison(spark, sf):
    """9 repeats of both classifiers on the clipped splat images: test rows predicted, by class."""
    return _test_counts(_predictions(_clipped_splats(spark, sf)))


@register("splat_comparison_scores")
def splat_comparison_scores(spark, sf):
    """(rep, model, label, pred, n): confusion counts of those predictions."""
    return _confusion(_predictions(_clipped_splats(spark, sf)))


@register("splat_comparison_boxplot")
def splat_comparison_boxplot(spark, sf):
    """Box plot figures of both models' accuracies over the 9 repeats."""
    return E.boxplot_stats(_scores_by_rep(_predictions(_clipped_splats(spark, sf))), "accuracy", "model")


@register("splat_comparison_sorted")
def splat_comparison_sorted(spark, sf):
    """The accuracies of both models side by side per repeat, in the order of the perceptron's."""
    return E.sort_scores(_scores_by_rep(_predictions(_clipped_splats(spark, sf))), by_model="mlp", other_model="logistic")


# The other chain: robust scale -> kernel coordinates -> robust scale -> embedding -> smoothing ->
# comparison, on 32 coordinates drawn as 8 x 8 images.
def _embedded_chain(spark, sf):
    x = _learnable(spark, sf)
    z = KN.kernel_pca(FT.robust_scale(x), K.N_FIT_LANDMARKS, 32, 1.0 / 64)
    z = z.withColumnRenamed("z", "x").join(x.select("vec_id", "label"), "vec_id")
    tasks = -(-x.count() // LG.ROWS_PER_TRAIN_TASK)
    z = FT.robust_scale(checkpointed(z.repartition(tasks) if tasks > 1 else z))  # 100 rounds a row follow
    f = IM.image_embedding(z, n)
    smooth = IM.tv_smooth_images(z, f, n, lam=10.0, gam=0.1, rounds=100, errors=False)
    return checkpointed(smooth.select("vec_id", F.col("img").alias("x")).join(x.select("vec_id", "label"), "vec_id"))


@register("embedding_comparison", _COUNTS)
def embedding_comparison(spark, sf):
    """9 repeats of both classifiers on the smoothed kernel images: test rows predicted, by class."""
    return _test_counts(_predictions(_embedded_chain(spark, sf)))


@register("embedding_comparison_scores")
def embedding_comparison_scores(spark, sf):
    """(rep, model, label, pred, n): confusion counts of those predictions."""
    return _confusion(_predictions(_embedded_chain(spark, sf)))


@register("embedding_gallery")
def embedding_gallery(spark, sf):
    """(vec_id, label, pos, p, v): the smoothed kernel images of the first 36 rows of every
    class, clipped to their 1st and 99th percentile."""
    return _gallery(FT.clip_range(_embedded_chain(spark, sf), 0.01, 0.99))


# ---- class scores (F8) ------------------------------------------------------------------------------
_MAT = """SELECT CAST(k.range AS INTEGER) AS k, CAST(p.range AS INTEGER) AS p,
((k.range * 64 + p.range * 7) % 13 - 6) / 10 AS w FROM range(3) k, range(64) p"""
_SCORES = f"""SELECT l.vec_id, m.k, sum(l.v * m.w) AS s, l.vec_id % 3 AS label
FROM ({_LONG}) l JOIN ({_MAT}) m ON l.p = m.p GROUP BY l.vec_id, m.k"""


def _scores(spark, sf):
    x = feats(spark, sf).withColumn("label", (F.col("vec_id") % 3).cast("int"))
    return MX.project_rows(x, K.score_matrix().T, "x", "s", keep=["vec_id", "label"])


@register("softmax_scores", f"""
WITH s AS ({_SCORES}), m AS (SELECT vec_id, max(s) AS mx FROM s GROUP BY vec_id),
e AS (SELECT s.vec_id, s.k, exp(s.s - m.mx) AS e FROM s JOIN m ON s.vec_id = m.vec_id)
SELECT vec_id, k AS cls, round(e / sum(e) OVER (PARTITION BY vec_id), 6) AS prob FROM e""")
def softmax_scores(spark, sf):
    return _explode(_scores(spark, sf).withColumn("prob", N.softmax("s")), "prob", idx="cls", val="prob")


_PRED = f"""SELECT vec_id, label, k AS pred FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, k) AS rn FROM ({_SCORES})) WHERE rn = 1"""


@register("argmax_predict", f"SELECT vec_id, pred FROM ({_PRED})")
def argmax_predict(spark, sf):
    return _scores(spark, sf).select("vec_id", N.argmax("s").alias("pred"))


@register("accuracy", f"SELECT round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM ({_PRED})")
def accuracy(spark, sf):
    p = _scores(spark, sf).withColumn("pred", N.argmax("s"))
    return E.accuracy(p).select(F.round("accuracy", 6).alias("accuracy"))


@register("cross_entropy", f"""
WITH s AS ({_SCORES}),
m AS (SELECT vec_id, max(s) AS mx FROM s GROUP BY vec_id),
lse AS (SELECT s.vec_id, m.mx + ln(sum(exp(s.s - m.mx))) AS lse FROM s JOIN m ON s.vec_id = m.vec_id GROUP BY s.vec_id, m.mx)
SELECT round(avg(lse.lse - s.s), 6) AS cross_entropy
FROM lse JOIN s ON lse.vec_id = s.vec_id AND s.k = s.label""")
def cross_entropy(spark, sf):
    return E.cross_entropy(_scores(spark, sf)).select(F.round("cross_entropy", 6).alias("cross_entropy"))


# ---- model scores (F9) -------------------------------------------------------------------------------
_F9 = """SELECT CAST(vec_id % 25 AS INTEGER) AS rep, CAST(vec_id % 2 AS INTEGER) AS model,
avg(CASE WHEN embedding[1] > 0 THEN 1.0 ELSE 0.0 END) AS accuracy FROM embeddings GROUP BY 1, 2"""


def _model_scores(spark, sf):
    x = feats(spark, sf)
    return x.groupBy((F.col("vec_id") % 25).cast("int").alias("rep"),
                     (F.col("vec_id") % 2).cast("int").alias("model")) \
        .agg(F.avg((F.get("x", 0) > 0).cast("double")).alias("accuracy"))


@register("boxplot_stats", f"""
WITH s AS ({_F9}),
q AS (SELECT model, quantile_cont(accuracy, 0.25) AS q1, quantile_cont(accuracy, 0.5) AS median,
             quantile_cont(accuracy, 0.75) AS q3 FROM s GROUP BY model),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.model, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN accuracy >= lo THEN accuracy END), 6) AS whisker_lo,
  round(max(CASE WHEN accuracy <= hi THEN accuracy END), 6) AS whisker_hi,
  count(CASE WHEN accuracy < lo OR accuracy > hi THEN 1 END) AS n_outliers
FROM s JOIN f ON s.model = f.model GROUP BY f.model, q1, median, q3""")
def boxplot_stats(spark, sf):
    b = E.boxplot_stats(_model_scores(spark, sf), "accuracy", "model")
    return b.select("model", *[F.round(c, 6).alias(c) for c in
                               ("q1", "median", "q3", "whisker_lo", "whisker_hi")], "n_outliers")


@register("sort_scores", f"""
WITH s AS ({_F9}),
w AS (SELECT rep, max(CASE WHEN model = 0 THEN accuracy END) AS acc_a,
             max(CASE WHEN model = 1 THEN accuracy END) AS acc_b FROM s GROUP BY rep)
SELECT CAST(row_number() OVER (ORDER BY acc_b, rep) - 1 AS BIGINT) AS pos, rep,
       round(acc_a, 6) AS acc_a, round(acc_b, 6) AS acc_b FROM w""")
def sort_scores(spark, sf):
    s = E.sort_scores(_model_scores(spark, sf), by_model=1, other_model=0)
    return s.select("pos", "rep", F.round("acc_a", 6).alias("acc_a"), F.round("acc_b", 6).alias("acc_b"))


# ---- classifiers -------------------------------------------------------------------------------------
def _learnable(spark, sf):
    """F6 with the learnable label embedding[0] > 0 (the stored labels carry no signal)."""
    return feats(spark, sf).withColumn("label", (F.get("x", 0) > 0).cast("int"))


_REPEATS = 25


def _fitted(spark, sf):
    x = _learnable(spark, sf).withColumn("label", (F.get("x", 0) + F.get("x", 1) * F.get("x", 2) > 0).cast("int"))
    data, reps = LG.split_table(x, E.holdout_split(x, repeats=_REPEATS, train_pct=70))
    return data, reps, LG.fit_logistic(data, len(reps))


@register("train_logistic", f"""
WITH s AS (
  SELECT rep, vec_id, pos, n FROM (SELECT rep, vec_id,
    row_number() OVER (PARTITION BY rep ORDER BY md5(CAST(vec_id AS VARCHAR) || ':' || CAST(rep AS VARCHAR)), vec_id) - 1 AS pos,
    count(*) OVER (PARTITION BY rep) AS n
  FROM embeddings, (SELECT CAST(range AS INTEGER) AS rep FROM range({_REPEATS})))),
t AS (SELECT s.rep, e.embedding::DOUBLE[] || [1.0] AS x,
        e.embedding[1]::DOUBLE + e.embedding[2]::DOUBLE * e.embedding[3]::DOUBLE > 0 AS y
      FROM s JOIN embeddings e ON e.vec_id = s.vec_id WHERE s.pos < (s.n * 70) // 100)
SELECT rep, feature, round(sum(CASE WHEN y THEN v ELSE 0 END), 2) AS expected FROM (
  SELECT rep, y, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS feature, unnest(x) AS v FROM t) GROUP BY 1, 2""")
def train_logistic(spark, sf):
    """(rep, feature, expected): 25 fits of a noisy label; the sum of predicted probability times
    feature over the training rows. At the optimum, and only there, it is the sum over the rows
    of class 1 (the last feature is the constant 1)."""
    return LG.fitted_moments(*_fitted(spark, sf)).select("rep", "feature", (F.round("expected", 2) + 0.0).alias("expected"))


@register("train_logistic_scores")
def train_logistic_scores(spark, sf):
    """(rep, label, pred, n): confusion counts of those fits on the held-out rows."""
    found = LG.predict_test_rows(*_fitted(spark, sf))
    return found.groupBy("rep", "label", "pred").agg(F.count(F.lit(1)).alias("n"))


@register("compare_classifiers", _COUNTS)
def compare_classifiers(spark, sf):
    """9 repeats of both classifiers on the feature table: test rows predicted, by class."""
    return _test_counts(_predictions(_learnable(spark, sf)))


@register("compare_classifiers_scores")
def compare_classifiers_scores(spark, sf):
    """(rep, model, label, pred, n): confusion counts of those predictions."""
    return _confusion(_predictions(_learnable(spark, sf)))
