"""Exact quantiles by counted bits: equal to percentile, no sort or range exchange, hot values."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import plan_text
from quillspark.operators import features as X
from quillspark.operators import ranking as RK
from quillspark.operators import selection as S

QS = (0.0, 0.01, 0.25, 0.5, 0.98, 1.0)


def _wide(spark, mat):
    return spark.createDataFrame([(i, [None if v is None else float(v) for v in r]) for i, r in enumerate(mat)],
                                 "vec_id long, x array<double>").repartition(3)


@given(st.lists(st.floats(allow_nan=True, allow_infinity=True), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_codes_sort_like_doubles_and_come_back(values):
    v = np.array(values)
    codes = S.ordered_codes(v)
    back = S.code_values(codes)
    assert np.array_equal(back, v + 0.0, equal_nan=True)
    order = np.argsort(codes, kind="stable")
    assert np.array_equal(v[order] + 0.0, np.sort(v) + 0.0, equal_nan=True)


def test_tally_merges_without_loss(monkeypatch):
    monkeypatch.setattr(S, "MERGE_AT", 10)
    rng = np.random.default_rng(0)
    t, seen = S.Tally(), []
    for _ in range(30):
        k = rng.integers(0, 25, 40)
        t.add(k)
        seen.append(k)
    keys, n = t.items()
    want = np.unique(np.concatenate(seen), return_counts=True)
    assert np.array_equal(keys, want[0]) and np.array_equal(n, want[1])


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(600, 4)) * [1, 1e-8, 1e12, 1]
    v[:, 3] = 0.0                                     # one value in all rows
    v[::3, 0] = 0.0
    v[5:400, 1] = 1.25                                # a hot value
    return v


def test_arrays_by_position_equal_numpy(spark, values):
    got = {r.feature: [r[f"q{i}"] for i in range(len(QS))] for r in S.array_quantiles(_wide(spark, values), "x", QS).collect()}
    assert sorted(got) == [0, 1, 2, 3]
    for j in range(4):
        assert np.allclose(got[j], np.percentile(values[:, j], [100 * q for q in QS]), rtol=1e-13, atol=0)


def test_all_elements_equal_numpy(spark, values):
    got = S.array_quantiles(_wide(spark, values), "x", QS, by_position=False).collect()
    assert len(got) == 1
    assert np.allclose(list(got[0]), np.percentile(values, [100 * q for q in QS]), rtol=1e-13, atol=0)


@pytest.mark.parametrize("max_in_task", [0, None])
def test_long_tables_equal_percentile_with_groups_and_nulls(spark, max_in_task):
    rows = [(g, float(v) if v % 7 else None) for g in ("a", "b", None) for v in range(50 if g else 3)]
    rows += [("only nulls", None), ("nan", float("nan")), ("nan", 1.0), ("inf", float("inf")), ("inf", float("inf"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = RK.exact_quantiles(df, "v", QS, ["g"], max_in_task=max_in_task).collect()
    want = RK.exact_quantiles(df, "v", QS, ["g"], biggest=0).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 5


def test_missing_elements_ragged_rows_and_nulls(spark):
    df = spark.createDataFrame([(0, [1.0, None]), (1, [2.0]), (2, None), (3, []), (4, [4.0, 10.0])], "vec_id long, x array<double>")
    got = {r.feature: r.q0 for r in S.array_quantiles(df, "x", [0.5]).collect()}
    assert got == {0: 2.0, 1: 10.0}
    assert S.array_quantiles(df, "x", [0.5], by_position=False).first().q0 == 3.0
    none = df.where("vec_id = 2")
    assert S.array_quantiles(none, "x", [0.5]).collect() == []
    assert S.array_quantiles(none, "x", [0.5], by_position=False).first().q0 is None
    assert S.radix_quantiles(none.select(F.lit(None).cast("double").alias("v")), "v", [0.5]).first().q0 is None


def test_feature_operators_agree_on_both_plans(spark, values, monkeypatch):
    df = _wide(spark, values)
    calls = (lambda: X.feature_quantiles(df), lambda: X.pixel_percentiles(df), lambda: X.robust_scale(df), lambda: X.clip_range(df))
    small = [sorted(map(str, c().collect())) for c in calls]
    monkeypatch.setattr(RK, "MAX_GROUP_IN_TASK", 0)
    assert [sorted(map(str, c().collect())) for c in calls] == small


def test_rows_are_neither_sorted_nor_moved(spark, values, monkeypatch):
    """A pass shuffles counts alone, at most a row a task, feature and distinct prefix."""
    monkeypatch.setattr(RK, "MAX_GROUP_IN_TASK", 0)
    seen = []
    checkpointed = S.checkpointed
    monkeypatch.setattr(S, "checkpointed", lambda df: seen.append(plan_text(df)) or checkpointed(df))
    X.feature_quantiles(_wide(spark, values).coalesce(2)).collect()
    assert len(seen) == 4
    for plan in seen:
        assert "rangepartitioning" not in plan and "Generate posexplode" not in plan
        assert "HashAggregate" in plan


def test_hot_value_is_a_row_a_task(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 10 < 9, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("v")).repartition(6)
    got = S.radix_quantiles(df, "v", [0.5, 0.9, 0.95]).first()
    v = np.where(np.arange(60_000) % 10 < 9, 7.0, np.arange(60_000))
    assert np.allclose(list(got), np.percentile(v, [50, 90, 95]), rtol=1e-13)
