"""Grid and matrix queries on the feature table read as 8 x 8 images (F6, F7, F10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions.arrays import explode_rows
from quillspark.functions.numeric import soft_threshold_array
from quillspark.operators import grid as GR
from quillspark.operators import matrix as MX
from quillspark.operators import spectral as SP
from quillspark.plans.feature_plans import feats
from quillspark.plans.registry import register
from quillspark.sources import constants as K

n = K.RES
M = n * (n - 1)
_LONG = f"""SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS p,
CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings"""
# DuckDB: orthonormal DCT-II basis C[k][j] as a table.
_C = f"""SELECT CAST(k.range AS INTEGER) AS k, CAST(j.range AS INTEGER) AS j,
CASE WHEN k.range = 0 THEN sqrt(1.0 / {n}) ELSE sqrt(2.0 / {n}) END
  * cos(pi() * k.range * (2 * j.range + 1) / (2.0 * {n})) AS c
FROM range({n}) k, range({n}) j"""
# F10 f[p][q] = kron(C, C)[p][q] = C[p div n][q div n] * C[p mod n][q mod n]
_F = f"""SELECT a1.k * {n} + a2.k AS p, a1.j * {n} + a2.j AS q, a1.c * a2.c AS f
FROM ({_C}) a1, ({_C}) a2"""


def _explode(df, col, idx="p", val="v", digits=6):
    return explode_rows(df, col, ["vec_id"], val, idx).select("vec_id", idx, F.round(val, digits).alias(val))


@register("grid_diff", f"""
WITH l AS ({_LONG})
SELECT a.vec_id, 0 AS axis, a.p // {n} AS r, a.p % {n} AS c, round(b.v - a.v, 6) AS d
FROM l a JOIN l b ON a.vec_id = b.vec_id AND b.p = a.p + {n}
UNION ALL
SELECT a.vec_id, 1, a.p // {n}, a.p % {n}, round(b.v - a.v, 6)
FROM l a JOIN l b ON a.vec_id = b.vec_id AND b.p = a.p + 1 AND a.p % {n} <> {n - 1}""")
def grid_diff(spark, sf):
    d = feats(spark, sf).select("vec_id", GR.grid_diff_expr("x", n).alias("dx"))
    e = explode_rows(d, "dx", ["vec_id"], "d", "k")
    down = F.col("k") < M
    kk = F.col("k") - M
    return e.select("vec_id", F.when(down, 0).otherwise(1).alias("axis"),
                    F.when(down, F.col("k").cast("int") / n).otherwise(kk / (n - 1)).cast("int").alias("r"),
                    F.when(down, F.col("k") % n).otherwise(kk % (n - 1)).cast("int").alias("c"),
                    F.round("d", 6).alias("d"))


@register("stack_directions", f"""
WITH l AS ({_LONG})
SELECT a.vec_id, a.p AS k, round(b.v - a.v, 6) AS d
FROM l a JOIN l b ON a.vec_id = b.vec_id AND b.p = a.p + {n}
UNION ALL
SELECT a.vec_id, {M} + (a.p // {n}) * {n - 1} + a.p % {n}, round(b.v - a.v, 6)
FROM l a JOIN l b ON a.vec_id = b.vec_id AND b.p = a.p + 1 AND a.p % {n} <> {n - 1}""")
def stack_directions(spark, sf):
    """The down and across difference tables stacked as rows of one matrix D (bag union)."""
    d = feats(spark, sf).select("vec_id", GR.grid_diff_expr("x", n).alias("dx"))
    down = explode_rows(d, F.slice("dx", 1, M), ["vec_id"], "d", "k")
    across = explode_rows(d, F.slice("dx", M + 1, M), ["vec_id"], "d", "k").withColumn("k", F.col("k") + M)
    return down.unionByName(across).select("vec_id", "k", F.round("d", 6).alias("d"))


@register("grid_laplacian_apply", f"""
WITH l AS ({_LONG})
SELECT a.vec_id, a.p, round(sum(a.v - b.v), 6) AS v
FROM l a JOIN l b ON a.vec_id = b.vec_id AND (
  b.p = a.p + {n} OR b.p = a.p - {n} OR (b.p = a.p + 1 AND a.p % {n} <> {n - 1})
  OR (b.p = a.p - 1 AND a.p % {n} <> 0))
GROUP BY a.vec_id, a.p""")
def grid_laplacian_apply(spark, sf):
    y = feats(spark, sf).select("vec_id", GR.laplacian_apply_expr("x", n).alias("ly"))
    return _explode(y, "ly")


@register("grid_max_pool", f"""
SELECT vec_id, ((p // {n}) // 2) * {(n + 1) // 2} + (p % {n}) // 2 AS q, max(v) AS v
FROM ({_LONG}) GROUP BY 1, 2""")
def grid_max_pool(spark, sf):
    y = feats(spark, sf).select("vec_id", GR.max_pool_expr("x", n).alias("mp"))
    return explode_rows(y, "mp", ["vec_id"], "v", "q")


def _kernel_values():
    w = K.conv_kernel()
    return ", ".join(f"({i - 1}, {j - 1}, {float(w[i, j])!r})" for i in range(4) for j in range(4))


@register("grid_convolve", f"""
WITH l AS ({_LONG}), w(dr, dc, w) AS (VALUES {_kernel_values()})
SELECT l.vec_id, t.p, round(sum(CASE WHEN s.v IS NULL THEN 0 ELSE w.w * s.v END), 6) AS v
FROM (SELECT DISTINCT vec_id FROM l) l
CROSS JOIN (SELECT CAST(range AS INTEGER) AS p FROM range({n * n})) t
CROSS JOIN w
LEFT JOIN l s ON s.vec_id = l.vec_id AND t.p // {n} + w.dr BETWEEN 0 AND {n - 1}
  AND t.p % {n} + w.dc BETWEEN 0 AND {n - 1}
  AND s.p = (t.p // {n} + w.dr) * {n} + t.p % {n} + w.dc
GROUP BY l.vec_id, t.p""")
def grid_convolve(spark, sf):
    y = feats(spark, sf).select("vec_id", GR.convolve_expr("x", n, K.conv_kernel()).alias("cv"))
    return _explode(y, "cv")


@register("cosine_transform_2d", f"""
WITH l AS ({_LONG}), c AS ({_C})
SELECT l.vec_id, c1.k * {n} + c2.k AS p, round(sum(c1.c * c2.c * l.v), 6) AS v
FROM l JOIN c c1 ON c1.j = l.p // {n} JOIN c c2 ON c2.j = l.p % {n}
GROUP BY 1, 2""")
def cosine_transform_2d(spark, sf):
    return _explode(SP.cosine_transform(feats(spark, sf), n, keep=["vec_id"]), "y")


_LAM, _GAM = 0.1, 0.1


@register("laplacian_solve", f"""
WITH l AS ({_LONG}), c AS ({_C}),
fwd AS (
  SELECT l.vec_id, c1.k AS a, c2.k AS b, sum(c1.c * c2.c * l.v) AS w
  FROM l JOIN c c1 ON c1.j = l.p // {n} JOIN c c2 ON c2.j = l.p % {n} GROUP BY 1, 2, 3),
scaled AS (
  SELECT vec_id, a, b, w / ({_LAM} * ((2 - 2 * cos(pi() * a / {n})) + (2 - 2 * cos(pi() * b / {n}))) + {_GAM}) AS w
  FROM fwd)
SELECT s.vec_id, c1.j * {n} + c2.j AS p, round(sum(c1.c * c2.c * s.w), 6) AS v
FROM scaled s JOIN c c1 ON c1.k = s.a JOIN c c2 ON c2.k = s.b
GROUP BY 1, 2""")
def laplacian_solve(spark, sf):
    """y with (lam L + gam I) y = x for every image, lam = gam = 0.1."""
    return _explode(SP.laplacian_solve(feats(spark, sf), n, _LAM, _GAM, keep=["vec_id"]), "y")


_MAT = """SELECT CAST(k.range AS INTEGER) AS k, CAST(p.range AS INTEGER) AS p,
((k.range * 64 + p.range * 7) % 13 - 6) / 10 AS w FROM range(3) k, range(64) p"""


@register("project_rows", f"""
SELECT l.vec_id, m.k, round(sum(l.v * m.w), 6) AS v
FROM ({_LONG}) l JOIN ({_MAT}) m ON l.p = m.p GROUP BY 1, 2""")
def project_rows(spark, sf):
    y = MX.project_rows(feats(spark, sf), K.score_matrix().T, "x", "s", keep=["vec_id"])
    return _explode(y, "s", idx="k")


@register("gram_matrix", f"""
WITH l AS ({_LONG})
SELECT a.p AS i, b.p AS j, round(sum(a.v * b.v), 6) AS g
FROM l a JOIN l b ON a.vec_id = b.vec_id GROUP BY 1, 2""")
def gram_matrix(spark, sf):
    g = MX.gram_matrix(feats(spark, sf))
    return g.select("i", "j", F.round("g", 6).alias("g"))


@register("cross_product", f"""
WITH l AS ({_LONG}),
y AS (SELECT l.vec_id, m.k, sum(l.v * m.w) AS v FROM l JOIN ({_MAT}) m ON l.p = m.p GROUP BY 1, 2)
SELECT l.p AS i, y.k AS j, round(sum(l.v * y.v), 6) AS g
FROM l JOIN y ON l.vec_id = y.vec_id GROUP BY 1, 2""")
def cross_product(spark, sf):
    y = MX.project_rows(feats(spark, sf), K.score_matrix().T, "x", "y", keep=["vec_id", "x"])
    return MX.cross_product(y, "x", "y").select("i", "j", F.round("g", 6).alias("g"))


_IMG = f"""SELECT l.vec_id, f.q AS p, sum(l.v * f.f) AS v FROM ({_LONG}) l JOIN ({_F}) f ON l.p = f.p
GROUP BY 1, 2"""
_DIFFS = f"""
SELECT a.vec_id, a.p AS k, b.v - a.v AS d FROM y a JOIN y b ON a.vec_id = b.vec_id AND b.p = a.p + {n}
UNION ALL
SELECT a.vec_id, {M} + (a.p // {n}) * {n - 1} + a.p % {n}, b.v - a.v
FROM y a JOIN y b ON a.vec_id = b.vec_id AND b.p = a.p + 1 AND a.p % {n} <> {n - 1}"""


def _images_f10(spark, sf):
    """images y = x f with f the 64 x 64 orthonormal cosine basis."""
    return SP.cosine_transform(feats(spark, sf), n, keep=["vec_id", "x"], inverse=True)


@register("embedding_variation", f"""
WITH y AS ({_IMG}) SELECT round(sum(d * d), 6) AS variation FROM ({_DIFFS})""")
def embedding_variation(spark, sf):
    """Sum over images x f of squared neighbour differences (= sum((X^T X f) * (f L)))."""
    y = _images_f10(spark, sf).select(GR.grid_diff_expr("y", n).alias("d"))
    per = y.select(F.aggregate("d", F.lit(0.0), lambda a, v: a + v * v).alias("s"))
    return per.agg(F.round(F.sum("s"), 6).alias("variation"))


@register("fit_residual", f"""
WITH y AS ({_IMG}),
z AS (SELECT vec_id, p, sign(v) * greatest(abs(v) - 0.1, 0) AS v FROM y),
r AS (SELECT z.vec_id, f.p, sum(z.v * f.f) AS v FROM z JOIN ({_F}) f ON z.p = f.q GROUP BY 1, 2)
SELECT round(sqrt(sum((r.v - l.v) * (r.v - l.v))), 6) AS residual
FROM r JOIN ({_LONG}) l ON r.vec_id = l.vec_id AND r.p = l.p""")
def fit_residual(spark, sf):
    """Frobenius distance between the rows and their rebuild from shrunk coefficients."""
    y = _images_f10(spark, sf).withColumn("y", soft_threshold_array("y", 0.1))
    back = SP.cosine_transform(y, n, "y", "xr", keep=["vec_id", "x"])
    sq = back.select(F.aggregate(F.zip_with("xr", "x", lambda a, b: (a - b) * (a - b)),
                                 F.lit(0.0), lambda s, v: s + v).alias("s"))
    return sq.agg(F.round(F.sqrt(F.sum("s")), 6).alias("residual"))


@register("tv_objective", f"""
WITH y AS ({_IMG}), dd AS ({_DIFFS}),
z AS (SELECT vec_id, k, d, sign(d) * greatest(abs(d) - 0.1, 0) AS z FROM dd)
SELECT round(sum(abs(z)) + 0.5 * 0.1 * sum((z - d) * (z - d)), 6) AS objective FROM z""")
def tv_objective(spark, sf):
    """sum|z| + lam/2 |z - D y|^2 + gam/2 |y - x f|^2 with y = x f, z = shrink(D y, lam)."""
    from quillspark.operators.images import tv_objective as objective
    y = _images_f10(spark, sf)
    return objective(y, GR.dct2_matrix(n), n, lam=0.1, gam=0.1) \
        .select(F.round("objective", 6).alias("objective"))
