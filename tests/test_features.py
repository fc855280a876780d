"""Feature-table operators against NumPy: quantiles, ranks with ties, scaling, splits."""

import numpy as np
import pytest

from quillspark.operators import evaluate as E
from quillspark.operators import features as X
from quillspark.operators.ranking import exact_quantiles, global_rank


def _frame(spark, mat, labels=None):
    labels = labels if labels is not None else [0] * len(mat)
    rows = [(i, [float(v) for v in row], int(l)) for i, (row, l) in enumerate(zip(mat, labels))]
    return spark.createDataFrame(rows, "vec_id long, x array<double>, label int")


@pytest.mark.parametrize("max_in_task", [0, None])
def test_exact_quantiles_match_numpy(spark, max_in_task):
    """Both plans (range-partitioned ranks and the in-task percentile) are exact."""
    rng = np.random.default_rng(1)
    vals = rng.normal(size=(101, 3))
    vals[:, 2] = np.round(vals[:, 2])          # many duplicates
    lf = X.long_form(_frame(spark, vals))
    q = exact_quantiles(lf, "v", (0.25, 0.5, 0.75), ["p"], ("a", "b", "c"), max_in_task=max_in_task)
    got = {r.p: (r.a, r.b, r.c) for r in q.collect()}
    for j in range(3):
        assert np.allclose(got[j], np.percentile(vals[:, j], [25, 50, 75]), atol=1e-12)


@pytest.mark.parametrize("max_in_task", [0, None])
def test_rank_within_both_plans(spark, max_in_task):
    from quillspark.operators.ranking import rank_within
    df = spark.createDataFrame([(i, i % 3, (i * 7) % 5) for i in range(40)], "id long, g int, v int")
    got = {r.id: (r.pos, r.group_n) for r in rank_within(df, ["v", "id"], ["g"], max_in_task=max_in_task).collect()}
    for g in range(3):
        ids = sorted((v, i) for i, gg, v in [(i, i % 3, (i * 7) % 5) for i in range(40)] if gg == g)
        for pos, (_, i) in enumerate(ids):
            assert got[i] == (pos, len(ids))


def test_median_of_even_count_interpolates(spark):
    df = _frame(spark, [[1.0], [2.0], [4.0], [10.0]])
    assert X.feature_quantiles(df).first().q50 == 3.0


def test_robust_scale_constant_feature_divides_by_one(spark):
    df = _frame(spark, [[5.0, 1.0], [5.0, 2.0], [5.0, 3.0]])
    got = sorted(tuple(r.x) for r in X.robust_scale(df).collect())
    assert got == [(0.0, -1.0), (0.0, 0.0), (0.0, 1.0)]


def test_rank_normalize_ties_broken_by_id(spark):
    df = _frame(spark, [[3.0], [1.0], [3.0], [2.0]])
    got = {r.vec_id: r.r for r in X.rank_normalize(df).collect()}
    assert got == {1: 0.0, 3: 0.25, 0: 0.5, 2: 0.75}


def test_global_rank_spans_partitions_and_groups(spark):
    rng = np.random.default_rng(2)
    n = 3000
    g = rng.integers(0, 3, n)
    g[: n // 2] = 0                            # one hot group with over half the rows
    v = rng.integers(0, 50, n)
    df = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(g, v))], "id long, g int, v int")
    ranked = global_rank(df.repartition(7), ["v", "id"], ["g"], num_partitions=6).collect()
    for grp in range(3):
        mine = sorted((r.pos, r.v, r.id) for r in ranked if r.g == grp)
        want = sorted((v[i], i) for i in range(n) if g[i] == grp)
        assert [(p, vv, i) for p, (vv, i) in enumerate(want)] == mine
        assert all(r.group_n == len(want) for r in ranked if r.g == grp)


def test_pixel_percentiles_and_clip(spark):
    rng = np.random.default_rng(3)
    vals = rng.normal(size=(40, 5))
    df = _frame(spark, vals)
    pp = {r.q: r.value for r in X.pixel_percentiles(df, (0.01, 0.98, 0.99)).collect()}
    assert np.allclose([pp[0.01], pp[0.98], pp[0.99]], np.percentile(vals, [1, 98, 99]))
    clipped = np.array([r.x for r in X.clip_range(df).orderBy("vec_id").collect()])
    assert np.allclose(clipped, np.clip(vals, *np.percentile(vals, [1, 99])))


def test_one_hot_checks_labels(spark):
    good = _frame(spark, [[0.0]] * 3, [0, 2, 1])
    assert sorted(tuple(r.y) for r in X.one_hot(good).collect()) == [(0, 0, 1), (0, 1, 0), (1, 0, 0)]
    with pytest.raises(ValueError):
        X.one_hot(_frame(spark, [[0.0]] * 2, [1, 3]))


def test_top_n_per_class_and_class_count(spark):
    df = _frame(spark, [[0.0]] * 7, [0, 1, 0, 1, 0, 2, 0])
    got = sorted((r.label, r.pos, r.vec_id) for r in X.top_n_per_class(df, 2).collect())
    assert got == [(0, 0, 0), (0, 1, 2), (1, 0, 1), (1, 1, 3), (2, 0, 5)]
    assert X.class_count(df).first().n_classes == 3


def test_holdout_split_is_reproducible_and_sized(spark):
    df = _frame(spark, [[0.0]] * 23)
    a = E.holdout_split(df, 4, 70).collect()
    b = E.holdout_split(df.repartition(3), 4, 70).collect()
    assert sorted(map(tuple, a), key=lambda t: (t[0], t[1])) == sorted(map(tuple, b), key=lambda t: (t[0], t[1]))
    for rep in range(4):
        rows = [r for r in a if r.rep == rep]
        assert sorted(r.pos for r in rows) == list(range(23))
        assert sum(r.is_train for r in rows) == 23 * 70 // 100
    orders = {rep: [r.vec_id for r in sorted((r for r in a if r.rep == rep), key=lambda r: r.pos)] for rep in range(4)}
    assert len({tuple(o) for o in orders.values()}) > 1     # repeats differ


def test_assign_batches_full_batches_only(spark):
    df = _frame(spark, [[0.0]] * 30)
    split = E.holdout_split(df, 2, 70)                      # 21 training rows
    b = E.assign_batches(split, 5).collect()
    for rep in range(2):
        mine = [r for r in b if r.rep == rep]
        assert len(mine) == 20 and sorted({r.batch for r in mine}) == [0, 1, 2, 3]


def test_exact_quantiles_grouped(spark):
    df = spark.createDataFrame([(g, float(v)) for g in range(2) for v in range(g * 10, g * 10 + 5)], "g int, v double")
    got = {r.g: r.q0 for r in exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {0: 2.0, 1: 12.0}


def test_limit_rows_large_n_uses_positions(spark, monkeypatch):
    df = _frame(spark, [[float(i)] for i in range(50)])
    monkeypatch.setattr(X, "MAX_TOP_ROWS", 5)
    got = sorted(r.vec_id for r in X.limit_rows(df.repartition(4), 17).collect())
    assert got == list(range(17))
