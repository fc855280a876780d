"""Tables of numeric feature vectors: (id, x array<double>, label).

Wide form keeps one row per example (per-row work is a projection, no shuffle); long
form (id, p, v) is used where a statistic runs per feature or over all values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions.arrays import explode_rows
from quillspark.functions.numeric import const_array, one_hot as one_hot_expr
from quillspark.operators import ranking
from quillspark.operators.ranking import exact_quantiles, rank_within
from quillspark.operators.selection import array_quantiles


def feature_matrix(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """(vec_id, x array<double>, label): floats widened to double before any arithmetic."""
    return embeddings.select(F.col(id_col).alias("vec_id"),
                             F.col(vec_col).cast("array<double>").alias("x"),
                             F.col(label_col).alias("label"))


def scan_feature_matrix(embeddings: DataFrame, dim: int | None = None,
                        num_rows: int | None = None) -> DataFrame:
    """First ``dim`` features of the first ``num_rows`` rows by id, like the slice
    ``data[:num_rows, :dim]``; the row limit is a top-k by id, not a sample."""
    df = feature_matrix(embeddings)
    if dim is not None:
        df = df.withColumn("x", F.slice("x", 1, dim))
    return limit_rows(df, num_rows) if num_rows is not None else df


def long_form(df: DataFrame, x_col: str = "x", keep: Sequence[str] = ("vec_id",)) -> DataFrame:
    """(keep..., p int, v double): one row per value."""
    return explode_rows(df, x_col, list(keep), "v", "p")


def feature_quantiles(df: DataFrame, qs: Sequence[float] = (0.25, 0.5, 0.75),
                      names: Sequence[str] = ("q25", "q50", "q75")) -> DataFrame:
    """(feature, q...) exact per-feature quantiles with linear interpolation.

    A feature has at most as many values as the table has rows, so the rows alone decide the
    plan: Spark's ``percentile`` while they fit a task, counted bits of the arrays beyond.
    """
    if df.count() > ranking.MAX_GROUP_IN_TASK:
        return array_quantiles(df, "x", qs, names)
    lf = long_form(df).withColumnRenamed("p", "feature")
    return exact_quantiles(lf, "v", qs, ["feature"], names, biggest=0)


def robust_scale(df: DataFrame) -> DataFrame:
    """x -> (x - median) / (q75 - q25) per feature; a zero range divides by 1.

    The 2 x d statistics are collected (bounded by the feature count) and applied as
    constant arrays, so the scaling is one projection.
    """
    q = feature_quantiles(df).collect()
    stats = {r["feature"]: r for r in q}
    d = max(stats) + 1 if stats else 0
    med = [stats[i]["q50"] for i in range(d)]
    scale = [(stats[i]["q75"] - stats[i]["q25"]) or 1.0 for i in range(d)]
    m, s = const_array(med), const_array(scale)
    return df.withColumn("x", F.transform("x", lambda v, i: (v - F.get(m, i)) / F.get(s, i)))


def rank_normalize(df: DataFrame, keep: Sequence[str] = ("vec_id",)) -> DataFrame:
    """(vec_id, p, r): each feature replaced by its 0-based rank / N; ties by id."""
    lf = long_form(df, keep=keep)
    ranked = rank_within(lf, [F.col("v"), F.col("vec_id")], ["p"])
    return ranked.select(*keep, "p", (F.col("pos") / F.col("group_n")).alias("r"))


def rank_normalize_wide(df: DataFrame) -> DataFrame:
    """Wide form of ``rank_normalize``: (vec_id, x = ranks / N, label).

    The label rides along in the long form, so regrouping by row needs no join back;
    each group holds one row's d values.
    """
    r = rank_normalize(df, keep=("vec_id", "label"))
    wide = r.groupBy("vec_id", "label").agg(F.sort_array(F.collect_list(F.struct("p", "r"))).alias("_s"))
    return wide.select("vec_id", F.transform("_s", lambda s: s["r"]).alias("x"), "label")


def pixel_percentiles(df: DataFrame, qs: Sequence[float] = (0.01, 0.98, 0.99)) -> DataFrame:
    """(q, value): exact percentiles over every value of every row (plans as in
    ``feature_quantiles``, by the number of values)."""
    names = [f"p{i}" for i in range(len(qs))]
    values = df.agg(F.sum(F.greatest(F.size("x"), F.lit(0)).cast("bigint"))).first()[0] or 0
    if values > ranking.MAX_GROUP_IN_TASK:
        one = array_quantiles(df, "x", qs, names, by_position=False)
    else:
        one = exact_quantiles(long_form(df), "v", qs, [], names, biggest=0)
    return one.select(F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), F.col(n).alias("value"))
                                          for q, n in zip(qs, names)])).alias("s")).select("s.*")


def clip_range(df: DataFrame, lo_q: float | None = 0.01, hi_q: float = 0.99, low: float = 0.0) -> DataFrame:
    """Clamp every value into [percentile lo_q, percentile hi_q] of all values; without
    ``lo_q``, into [``low``, percentile hi_q]."""
    qs = (hi_q,) if lo_q is None else (lo_q, hi_q)
    lims = {r["q"]: r["value"] for r in pixel_percentiles(df, qs).collect()}
    lo, hi = F.lit(low if lo_q is None else lims[float(lo_q)]), F.lit(lims[float(hi_q)])
    return df.withColumn("x", F.transform("x", lambda v: F.least(F.greatest(v, lo), hi)))


def filter_by_class(df: DataFrame, k: int) -> DataFrame:
    return df.where(F.col("label") == k)


def class_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("label").alias("n_classes"))


def num_classes(df: DataFrame) -> int:
    """k for labels 0..k-1; raises when the labels are not exactly that range."""
    r = df.agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
               F.count_distinct("label").alias("n")).first()
    if r["n"] == 0:
        return 0
    if r["lo"] != 0 or r["hi"] != r["n"] - 1:
        raise ValueError(f"labels must be 0..k-1, got min {r['lo']} max {r['hi']} distinct {r['n']}")
    return int(r["n"])


def one_hot(df: DataFrame, k: int | None = None) -> DataFrame:
    k = num_classes(df) if k is None else k
    return df.withColumn("y", one_hot_expr("label", k))


def top_n_per_class(df: DataFrame, n: int) -> DataFrame:
    """First n rows of every class by id (WindowGroupLimit prunes before the shuffle)."""
    w = Window.partitionBy("label").orderBy("vec_id")
    return (df.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n)
            .withColumn("pos", (F.col("pos") - 1).cast("bigint")))


# Largest n served by a single-task top-n (TakeOrderedAndProject keeps n rows per task).
MAX_TOP_ROWS = 100_000


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    """First n rows by id, in id order (ids are unique).

    Beyond MAX_TOP_ROWS the ids alone are ranked and the n-th one becomes a filter, so no task
    holds n rows and the wide rows are not ranked; rows and order are the same either way.
    """
    if n <= MAX_TOP_ROWS:
        return df.orderBy("vec_id").limit(n)
    cut = rank_within(df.select("vec_id"), [F.col("vec_id")], []).where(F.col("pos") == n - 1).first()
    return (df if cut is None else df.where(F.col("vec_id") <= cut["vec_id"])).orderBy("vec_id")
