"""Hot keys: one key holding a third (or more) of all rows keeps results whole."""

from pyspark.sql import functions as F

from quillspark.operators import features as X
from quillspark.operators import geo as G
from quillspark.operators import wordcount as W
from quillspark.operators.ranking import exact_quantiles
from helpers import plan_text


def test_hot_host_country_counts(spark):
    blocks = spark.createDataFrame([("10.1.0.0/16", 2, "Mid"), ("10.2.0.0/16", 3, "Other")],
                                   "network string, geoname_id int, country_name string")
    hosts = [("10.1.0.1",)] * 300 + [(f"10.2.0.{i % 250}",) for i in range(600)]
    parsed = spark.createDataFrame(hosts, "host string").repartition(6)
    got = {r.country_name: r.n for r in G.hits_by_country(parsed, blocks).collect()}
    assert got == {"Mid": 300, "Other": 600}
    assert "SortMergeJoin" not in plan_text(G.hits_by_country(parsed, blocks))


def test_hot_word_counts(spark):
    text = [(i, "the " * 50 + f"w{i}") for i in range(60)]
    df = spark.createDataFrame(text, "doc_id long, text string").repartition(5)
    top = W.wordcount_top(df, 2).collect()
    assert (top[0].word, top[0].n) == ("the", 3000) and top[1].n == 1


def test_hot_group_quantiles_on_range_plan(spark):
    rows = [(0, float(i)) for i in range(900)] + [(1, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(4)
    got = {r.g: r.q0 for r in exact_quantiles(df, "v", [0.5], ["g"], max_in_task=100).collect()}
    assert got == {0: 449.5, 1: 4.5}


def test_hot_class_top_n(spark):
    rows = [(i, [0.0], 0 if i % 10 else 1) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, x array<double>, label int").repartition(4)
    got = X.top_n_per_class(df, 3).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.label: r.n for r in got} == {0: 3, 1: 3}


def test_hot_value_is_spread_over_the_ranges(spark):
    """Four fifths of all values are zero; no range partition gets much above its share."""
    from pyspark.sql import functions as F
    from quillspark.operators import ranking as RK
    n = 40_000
    df = spark.range(n).select((F.when(F.col("id") % 5 == 0, F.col("id")).otherwise(0)).cast("double").alias("v"))
    df = df.withColumn("_tie", F.monotonically_increasing_id())
    ranked = RK.global_rank(df, [F.col("v"), F.col("_tie")], num_partitions=8)
    sizes = ranked.select(F.floor(F.col("pos") / (n / 8)).alias("p")).groupBy("p").count().collect()
    assert len(sizes) == 8
    parts = df.repartitionByRange(8, "v", "_tie").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 2 * n / 8
    got = RK.exact_quantiles(df.select("v"), "v", [0.5, 0.9], max_in_task=100).first()
    assert got.q0 == 0.0 and got.q1 > 0
