"""Scores, box plots, classifier runs."""

import numpy as np
import pytest
from quillspark.functions import numeric as N
from quillspark.operators import evaluate as E


def test_softmax_argmax_cross_entropy(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0, 3.0], 2), (2, [1000.0, 0.0, -5.0], 0)], "vec_id long, s array<double>, label int")
    r = df.select("vec_id", N.softmax("s").alias("p"), N.argmax("s").alias("pred")).orderBy("vec_id").collect()
    assert np.isclose(sum(r[0].p), 1.0) and r[0].pred == 1          # first maximum wins
    assert r[1].p[0] == 1.0 and r[1].pred == 0                       # no overflow
    ce = E.cross_entropy(df).first().cross_entropy
    s = np.array([[1.0, 3.0, 3.0], [1000.0, 0.0, -5.0]])
    lse = s.max(1) + np.log(np.exp(s - s.max(1, keepdims=True)).sum(1))
    assert np.isclose(ce, np.mean(lse - s[[0, 1], [2, 0]]))
    acc = E.accuracy(df.withColumn("pred", N.argmax("s"))).first().accuracy
    assert acc == 0.5


def test_boxplot_stats_with_outlier(spark):
    vals = [0.5, 0.52, 0.53, 0.55, 0.56, 0.58, 0.1]
    df = spark.createDataFrame([(0, v) for v in vals], "model int, accuracy double")
    r = E.boxplot_stats(df, "accuracy", "model").first()
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert np.allclose([r.q1, r.median, r.q3], [q1, med, q3])
    assert r.whisker_lo == 0.5 and r.whisker_hi == 0.58 and r.n_outliers == 1


def test_sort_scores(spark):
    df = spark.createDataFrame([(0, "a", 0.9), (0, "b", 0.7), (1, "a", 0.6), (1, "b", 0.8)], "rep int, model string, accuracy double")
    got = [tuple(r) for r in E.sort_scores(df, by_model="b", other_model="a").collect()]
    assert got == [(0, 0, 0.9, 0.7), (1, 1, 0.6, 0.8)]


def _learnable(spark, sf):
    from quillspark.plans.image_plans import _learnable as L
    return L(spark, sf)


def test_train_logistic_learns(spark):
    from helpers import SF_MID
    x = _learnable(spark, SF_MID)
    split = E.holdout_split(x, 2, 70)
    acc = [r.accuracy for r in E.train_logistic(x, split, max_iter=50).collect()]
    assert len(acc) == 2 and min(acc) > 0.8


def test_compare_classifiers_shape(spark):
    from helpers import SF_SMALL
    x = _learnable(spark, SF_SMALL)
    split = E.holdout_split(x, 2, 70)
    res = E.compare_classifiers(x, split, max_iter=30).collect()
    assert len(res) == 4
    assert {r.model for r in res} == {"logistic", "mlp"}
    assert all(0.0 <= r.accuracy <= 1.0 for r in res)
    assert res[0].rep == res[1].rep


@pytest.mark.parametrize("k, hidden, max_iter", [(2, (5,), 25), (3, (4, 3), 15)])
def test_perceptrons_of_all_repeats_equal_separate_fits(spark, monkeypatch, k, hidden, max_iter):
    """One loop gives the weights and classes of Spark ML's fits, a job for all repeats."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F
    from quillspark.operators import logistic as LG
    from quillspark.operators import perceptron as PC
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 4))
    y = (x @ rng.normal(size=(4, k)) + rng.gumbel(size=(700, k))).argmax(axis=1)
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))],
                               "vec_id long, x array<double>, label int")
    split = E.holdout_split(df, 3, 70)
    data, reps = LG.split_table(df, split)
    jobs, add = [], PC.MX.add_packed
    monkeypatch.setattr(PC.MX, "add_packed", lambda *a: jobs.append(1) or add(*a))
    layers = [4, *hidden, k]
    got = PC.fit_perceptrons(LG.packed_rows(data), len(reps), layers, max_iter, seed=7)
    assert max_iter <= len(jobs) < 2 * max_iter  # separate fits look at three times as many points
    pred = {(r.rep, r.vec_id): r.pred for r in LG.predict_test_rows(data, reps, got, PC.classifier(layers)).collect()}
    assert len(pred) == 3 * 210
    rows = data.select("vec_id", "role", array_to_vector("x").alias("features"), F.col("label").cast("double").alias("label"))
    mlp = MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=7)
    for i, rep in enumerate(reps):
        m = mlp.fit(rows.where(F.get("role", F.lit(i)) == 1))
        assert np.allclose(got[i], m.weights.toArray(), rtol=1e-6, atol=1e-6)
        for r in m.transform(rows.where(F.get("role", F.lit(i)) == 0)).collect():
            assert pred[rep, r.vec_id] == r.prediction


def test_perceptron_without_training_rows_keeps_its_first_weights(spark):
    from quillspark.operators import logistic as LG
    from quillspark.operators import perceptron as PC
    df = spark.createDataFrame([(i, [float(i % 3), 1.0], i % 2) for i in range(20)], "vec_id long, x array<double>, label int")
    split = spark.range(20).selectExpr("explode(array(0, 1)) AS rep", "id AS vec_id").selectExpr("rep", "vec_id", "rep = 1 AS is_train")
    data, reps = LG.split_table(df, split)
    got = PC.fit_perceptrons(LG.packed_rows(data), len(reps), [2, 3, 2], 5)
    first = PC.first_weights(spark, [2, 3, 2], 7)
    assert (got[0] == first).all() and not np.allclose(got[1], first)


def test_both_classifiers_share_the_jobs_of_their_rounds(spark, monkeypatch):
    """A round is one job without a shuffle for all repeats of both, over no more tasks than slots."""
    from quillspark.operators import logistic as LG
    from quillspark.operators import matrix as MX
    from quillspark.operators import perceptron as PC
    monkeypatch.setattr(LG, "ROWS_PER_TRAIN_TASK", 20)
    monkeypatch.setattr(LG, "PACKED_ROWS", 4)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + rng.logistic(size=400) > 0).astype(int)
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))],
                               "vec_id long, x array<double>, label int")
    split = E.holdout_split(df, 2, 70)
    data, reps = LG.split_table(df, split)
    packed = LG.packed_rows(data)
    slots = spark.sparkContext.defaultParallelism
    assert data.rdd.getNumPartitions() == 20 and packed.rdd.getNumPartitions() == min(20, slots)
    sizes = packed.rdd.map(lambda r: len(r.label) // 4).collect()
    assert sum(sizes) == 400 and max(sizes) == 4
    rounds, add = [], MX.add_packed

    def counted(partials, *a):
        out = add(partials, *a)
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        rounds.append(1)
        return out

    monkeypatch.setattr(MX, "add_packed", counted)
    weights = LG.fit_logistic(data, len(reps), 12)
    of_logistic = len(rounds)
    nets = PC.fit_perceptrons(packed, len(reps), [3, 4, 2], 12)
    of_nets = len(rounds) - of_logistic
    rounds.clear()
    found, _ = E.classifier_predictions(df, split, hidden=(4,), max_iter=12)
    assert len(rounds) == max(of_logistic, of_nets)
    apart = {"logistic": LG.predict_test_rows(data, reps, weights), "mlp": LG.predict_test_rows(data, reps, nets, PC.classifier([3, 4, 2]))}
    for model, want in apart.items():
        got = {(r.rep, r.vec_id): r.pred for r in found.where(found.model == model).collect()}
        assert len(got) == 240 and got == {(r.rep, r.vec_id): r.pred for r in want.collect()}


def test_tasks_of_a_round(spark):
    from quillspark.operators import rounds as RD
    slots = spark.sparkContext.defaultParallelism
    assert RD.round_tasks(spark, 1, 650_000) == 1
    assert RD.round_tasks(spark, 5 * slots, 650_000) == slots           # one wave, not five
    assert RD.round_tasks(spark, 5 * slots, RD.TASK_CELLS // 2) == 3 * slots
    assert RD.round_tasks(spark, 5 * slots, 2 * RD.TASK_CELLS) == 5 * slots
