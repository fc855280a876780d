"""Physical plan shapes: top-k without a global sort, broadcast block joins, no
row-at-a-time Python, filters and columns reaching the scan."""

import pytest

import __spark_entry__ as E
from quillspark.plans import catalog
from helpers import SF_SMALL, plan_text

SLOW = {"train_logistic", "compare_classifiers", "tv_image_embedding", "kernel_pca",
        "image_embedding", "embed_images", "tv_smooth_images", "feature_layout", "splat_images",
        "splat_gallery", "splat_comparison", "kernel_coordinates", "image_embedding_weights",
        "embedded_images", "tv_fit_error", "tv_embedding_objective", "feature_positions",
        "splat_gallery_spectral", "splat_comparison_scores", "splat_comparison_boxplot",
        "splat_comparison_sorted", "embedding_comparison", "embedding_comparison_scores",
        "embedding_gallery", "train_logistic_scores", "compare_classifiers_scores"}


def test_topk_uses_take_ordered(spark):
    for k in ("wordcount_top20", "wordcount_top40_clean", "top_pages", "topk_by_count"):
        p = plan_text(E.queries()[k](spark, SF_SMALL))
        assert "TakeOrderedAndProject" in p, k


def test_geolocation_broadcasts_blocks(spark):
    p = plan_text(E.queries()["geolocate_ip"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


@pytest.mark.parametrize("key", sorted(set(catalog.queries()) - SLOW))
def test_no_row_at_a_time_python(spark, key):
    p = plan_text(E.queries()[key](spark, SF_SMALL))
    assert "BatchEvalPython" not in p


def test_scan_prunes_columns(spark):
    from quillspark.operators.weblog import top_pages, parse_access_log
    from quillspark.sources.derived import access_log_lines
    from quillspark.sources.tables import table
    df = top_pages(parse_access_log(access_log_lines(table(spark, SF_SMALL, "events"))))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "value" not in p.split("ReadSchema:")[1].split("\n")[0]
    assert "props" not in p


def test_top_n_per_class_prunes_before_shuffle(spark):
    p = plan_text(E.queries()["top_n_per_class"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p
