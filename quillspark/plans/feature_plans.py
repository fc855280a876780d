"""Queries over the feature table (``embeddings`` as F6 of FIXTURES.md).

Float outputs are rounded to 6 places at the end on both sides; arrays are exploded to
(vec_id, p, v) rows for comparison.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import numeric as N
from quillspark.functions.arrays import explode_rows
from quillspark.functions.registry import register_functions as bind_sql_functions
from quillspark.operators import evaluate as E
from quillspark.operators import features as X
from quillspark.operators.ranking import global_rank as rank_op
from quillspark.plans.registry import register
from quillspark.sources.tables import table

_LONG = """SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS p,
CAST(unnest(embedding) AS DOUBLE) AS v, label FROM embeddings"""


def feats(spark, sf):
    return X.feature_matrix(table(spark, sf, "embeddings"))


def _long_rounded(df, digits=6):
    lf = X.long_form(df)
    return lf.select("vec_id", "p", F.round("v", digits).alias("v"))


@register("scan_feature_matrix", f"""
SELECT vec_id, p, v FROM ({_LONG}) WHERE p < 30
AND vec_id IN (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 10000)""")
def scan_feature_matrix(spark, sf):
    """Like the slice ``data[:10000, :30]``: first 10,000 rows by id, first 30 features."""
    return X.long_form(X.scan_feature_matrix(table(spark, sf, "embeddings"), dim=30, num_rows=10000))


@register("limit_rows", "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 100")
def limit_rows(spark, sf):
    return X.limit_rows(feats(spark, sf), 100).select("vec_id", "label")


@register("filter_by_class", "SELECT vec_id, label FROM embeddings WHERE label = 0")
def filter_by_class(spark, sf):
    return X.filter_by_class(feats(spark, sf), 0).select("vec_id", "label")


@register("class_count", "SELECT count(DISTINCT label) AS n_classes FROM embeddings")
def class_count(spark, sf):
    return X.class_count(feats(spark, sf))


@register("one_hot", """
SELECT vec_id, CAST(c AS INTEGER) AS cls, CAST(label = c AS INTEGER) AS ind
FROM embeddings, range(0, (SELECT max(label) + 1 FROM embeddings)) t(c)""")
def one_hot(spark, sf):
    oh = X.one_hot(feats(spark, sf))
    return explode_rows(oh, "y", ["vec_id"], "ind", "cls")


@register("top_n_per_class", """
SELECT vec_id, label, pos FROM (
  SELECT vec_id, label, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS BIGINT) AS pos
  FROM embeddings) WHERE pos < 36""")
def top_n_per_class(spark, sf):
    return X.top_n_per_class(feats(spark, sf), 36).select("vec_id", "label", "pos")


@register("feature_quantiles", f"""
SELECT p AS feature, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
       round(quantile_cont(v, 0.75), 6) AS q75
FROM ({_LONG}) GROUP BY p""")
def feature_quantiles(spark, sf):
    q = X.feature_quantiles(feats(spark, sf))
    return q.select("feature", *[F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")])


@register("robust_scale", f"""
WITH l AS ({_LONG}),
s AS (SELECT p, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr
      FROM l GROUP BY p)
SELECT vec_id, l.p, round((v - med) / CASE WHEN iqr = 0 THEN 1 ELSE iqr END, 6) AS v
FROM l JOIN s ON l.p = s.p""")
def robust_scale(spark, sf):
    return _long_rounded(X.robust_scale(feats(spark, sf)))


@register("rank_normalize", f"""
SELECT vec_id, p, (row_number() OVER (PARTITION BY p ORDER BY v, vec_id) - 1)
       / count(*) OVER (PARTITION BY p) AS r
FROM ({_LONG})""")
def rank_normalize(spark, sf):
    return X.rank_normalize(feats(spark, sf))


@register("global_rank", f"""
SELECT vec_id, p, CAST(row_number() OVER (ORDER BY v, vec_id, p) - 1 AS BIGINT) AS pos FROM ({_LONG})""")
def global_rank(spark, sf):
    lf = X.long_form(feats(spark, sf))
    return rank_op(lf, ["v", "vec_id", "p"]).select("vec_id", "p", "pos")


@register("pixel_percentiles", f"""
WITH l AS ({_LONG})
SELECT 0.01::DOUBLE AS q, round(quantile_cont(v, 0.01), 6) AS value FROM l
UNION ALL SELECT 0.98::DOUBLE, round(quantile_cont(v, 0.98), 6) FROM l
UNION ALL SELECT 0.99::DOUBLE, round(quantile_cont(v, 0.99), 6) FROM l""")
def pixel_percentiles(spark, sf):
    pp = X.pixel_percentiles(feats(spark, sf), (0.01, 0.98, 0.99))
    return pp.select("q", F.round("value", 6).alias("value"))


@register("clip_range", f"""
WITH l AS ({_LONG}), b AS (SELECT quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM l)
SELECT vec_id, p, round(least(greatest(v, lo), hi), 6) AS v FROM l, b""")
def clip_range(spark, sf):
    return _long_rounded(X.clip_range(feats(spark, sf), 0.01, 0.99))


@register("soft_threshold", f"""
SELECT vec_id, p, round(sign(v) * greatest(abs(v) - 0.1, 0), 6) + 0.0 AS v FROM ({_LONG})""")
def soft_threshold(spark, sf):
    lf = X.long_form(feats(spark, sf))
    return lf.select("vec_id", "p", (F.round(N.soft_threshold("v", 0.1), 6) + F.lit(0.0)).alias("v"))


@register("relu", f"SELECT vec_id, p, round(greatest(v, 0), 6) AS v FROM ({_LONG})")
def relu(spark, sf):
    lf = X.long_form(feats(spark, sf))
    return lf.select("vec_id", "p", F.round(N.relu("v"), 6).alias("v"))


@register("register_functions", f"""
SELECT vec_id, p, round(sign(v) * greatest(abs(v) - 0.1, 0), 6) + 0.0 AS st,
       round(greatest(v, 0), 6) AS rl FROM ({_LONG})""")
def register_functions(spark, sf):
    bind_sql_functions(spark)
    X.long_form(feats(spark, sf)).createOrReplaceTempView("quill_feature_values")
    return spark.sql("""SELECT vec_id, p, round(soft_threshold(v, 0.1), 6) + 0D AS st,
                        round(relu(v), 6) AS rl FROM quill_feature_values""")


_SPLIT_SQL = """
SELECT rep, vec_id, pos, pos < (n * 70) // 100 AS is_train FROM (
  SELECT rep, vec_id,
    CAST(row_number() OVER (PARTITION BY rep ORDER BY md5(CAST(vec_id AS VARCHAR) || ':' || CAST(rep AS VARCHAR)), vec_id) - 1 AS BIGINT) AS pos,
    count(*) OVER (PARTITION BY rep) AS n
  FROM embeddings, (SELECT CAST(range AS INTEGER) AS rep FROM range(0, 3)))"""


@register("holdout_split", _SPLIT_SQL)
def holdout_split(spark, sf):
    return E.holdout_split(feats(spark, sf), repeats=3, train_pct=70).drop("n_train")


@register("assign_batches", f"""
WITH s AS ({_SPLIT_SQL}), t AS (SELECT * FROM s WHERE is_train),
c AS (SELECT rep, count(*) AS nt FROM t GROUP BY rep)
SELECT t.rep, t.pos // 50 AS batch, t.vec_id FROM t JOIN c ON t.rep = c.rep
WHERE t.pos < (c.nt // 50) * 50""")
def assign_batches(spark, sf):
    split = E.holdout_split(feats(spark, sf), repeats=3, train_pct=70)
    return E.assign_batches(split, 50)
