"""Repeated hold-out splits, batches, scores and classifier comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators import logistic as LG
from quillspark.operators import perceptron as PC
from quillspark.operators import rounds as RD
from quillspark.operators.ranking import rank_within
from quillspark.session import bounded_broadcast, checkpointed


def holdout_split(df: DataFrame, repeats: int, train_pct: int) -> DataFrame:
    """(rep, vec_id, pos, is_train, n_train): per repeat a hash order of the rows; the first
    ``n_train = n * train_pct // 100`` are training rows.

    The order is md5(id:rep), tie-broken by id: reproducible without a seed and the
    same on any engine. Positions come from ``rank_within``: a repeat larger than one
    task's share goes through the range-partitioned ``global_rank``.
    """
    reps = df.select("vec_id", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("rep"))
    key = F.md5(F.concat_ws(":", F.col("vec_id").cast("string"), F.col("rep").cast("string")))
    ranked = rank_within(reps.withColumn("_h", key), [F.col("_h"), F.col("vec_id")], ["rep"])
    is_train = F.col("pos") < F.expr(f"group_n * {int(train_pct)} div 100")
    return ranked.select("rep", "vec_id", "pos", is_train.alias("is_train"),
                         F.expr(f"group_n * {int(train_pct)} div 100").cast("bigint").alias("n_train"))


def assign_batches(split: DataFrame, batch_size: int) -> DataFrame:
    """(rep, batch, vec_id): training rows cut into full batches in split order; step s
    of a training run uses batch s mod (n_train div batch_size)."""
    full = F.expr(f"(n_train div {int(batch_size)}) * {int(batch_size)}")
    return (split.where("is_train").where(F.col("pos") < full)
            .select("rep", F.expr(f"pos div {int(batch_size)}").alias("batch"), "vec_id"))


# ---- scores ------------------------------------------------------------------------------------
def accuracy(df: DataFrame, pred: str = "pred", label: str = "label") -> DataFrame:
    return df.agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"))


def cross_entropy(df: DataFrame, scores: str = "s", label: str = "label") -> DataFrame:
    """Mean of log(sum exp(s)) - s[label] (softmax cross-entropy on logits)."""
    from quillspark.functions.numeric import log_sum_exp
    per = log_sum_exp(scores) - F.get(F.col(scores), F.col(label))
    return df.agg(F.avg(per).alias("cross_entropy"))


def boxplot_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme values inside the fences) and outlier
    count per group."""
    from quillspark.operators.ranking import exact_quantiles
    df = checkpointed(df.select(group, value))  # read three times: sizes, quantiles, whiskers
    q = exact_quantiles(df, value, (0.25, 0.5, 0.75), [group], ("q1", "median", "q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - F.lit(1.5) * F.col("iqr")
    hi = F.col("q3") + F.lit(1.5) * F.col("iqr")
    v = F.col(value)
    t = df.join(bounded_broadcast(q, 1_000_000), group)   # one row per group
    return t.groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(v >= lo, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi, v)).alias("whisker_hi"),
        F.count(F.when((v < lo) | (v > hi), 1)).alias("n_outliers"))


def sort_scores(scores: DataFrame, by_model, other_model) -> DataFrame:
    """(pos, rep, acc_a, acc_b): the two models side by side per repeat, ordered by
    model ``by_model``'s accuracy (ties by repeat). One row per repeat."""
    from pyspark.sql import Window
    wide = scores.groupBy("rep").agg(
        F.max(F.when(F.col("model") == F.lit(other_model), F.col("accuracy"))).alias("acc_a"),
        F.max(F.when(F.col("model") == F.lit(by_model), F.col("accuracy"))).alias("acc_b"))
    w = Window.orderBy("acc_b", "rep")  # rows = repeats (a small parameter)
    return wide.select((F.row_number().over(w) - 1).cast("bigint").alias("pos"), "rep", "acc_a", "acc_b")


# ---- classifiers ---------------------------------------------------------------------------------
def _accuracies(predictions: DataFrame, wanted: list[tuple], *by: str) -> DataFrame:
    """(by..., accuracy) for the ``wanted`` combinations (repeats x models); NaN without test rows."""
    hit = F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy")
    found = {tuple(r[:-1]): r["accuracy"] for r in predictions.groupBy(*by).agg(hit).collect()}
    schema = ", ".join({"rep": "rep int", "model": "model string"}[b] for b in by)
    rows = [(*w, found.get(w, float("nan"))) for w in wanted]
    return predictions.sparkSession.createDataFrame(rows, f"{schema}, accuracy double")


def train_logistic(df: DataFrame, split: DataFrame, max_iter: int = 100, x_col: str = "x",
                   label_col: str = "label") -> DataFrame:
    """(rep, accuracy): multinomial logistic regression per repeat, test accuracy. One training
    loop for all repeats (``operators/logistic.py``)."""
    data, reps = LG.split_table(df, split, x_col, label_col)
    weights = LG.fit_logistic(data, len(reps), max_iter)
    return _accuracies(LG.predict_test_rows(data, reps, weights), [(r,) for r in reps], "rep")


def classifier_predictions(df: DataFrame, split: DataFrame, hidden: tuple[int, ...] = (16,), max_iter: int = 100,
                           x_col: str = "x", label_col: str = "label", seed: int = 7) -> tuple[DataFrame, list[int]]:
    """((rep, model, vec_id, label, pred), repeats): the stored predictions of logistic
    regression and a multilayer perceptron for the test rows of every repeat, both trained on
    the same rows. They read one stored table, whose rows know their role in every repeat, and
    all repeats of both are trained in one loop. An empty table gives none."""
    data, reps = LG.split_table(df, split, x_col, label_col)
    d, k = LG.shape_of(data)
    if not d:
        return df.sparkSession.createDataFrame([], "rep int, model string, vec_id long, label int, pred int"), []
    layers = [d, *hidden, max(k, 2)]
    fits = [LG.logistic_fit(len(reps), (d, k), max_iter),
            PC.perceptron_fit(df.sparkSession, len(reps), layers, max_iter, seed)]
    weights, nets = RD.train(LG.packed_rows(data), LG.blocks_of, fits)
    models = {"logistic": LG.predict_test_rows(data, reps, weights),
              "mlp": LG.predict_test_rows(data, reps, nets, PC.classifier(layers))}
    named = [p.select("rep", F.lit(name).alias("model"), "vec_id", "label", "pred") for name, p in models.items()]
    return checkpointed(named[0].unionAll(named[1])), reps


def compare_classifiers(df: DataFrame, split: DataFrame, hidden: tuple[int, ...] = (16,),
                        max_iter: int = 100, x_col: str = "x", label_col: str = "label",
                        seed: int = 7) -> DataFrame:
    """(rep, model, accuracy) of ``classifier_predictions``; NaN without test rows."""
    found, reps = classifier_predictions(df, split, hidden, max_iter, x_col, label_col, seed)
    return _accuracies(found, [(r, m) for r in reps for m in ("logistic", "mlp")], "rep", "model")
