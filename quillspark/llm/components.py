"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b long).

    Alternates the large-star and small-star steps (Kiveris et al., "Connected components in
    MapReduce and beyond"): every round is two grouped minima, edges never leave the cluster,
    and the number of rounds is logarithmic in the longest path. A round's edges are written
    to the shared folder; the driver sees one count per round.
    """
    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        if not large:
            both = both.filter("v < u")
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        joined = both.join(low, F.col("u") == F.col("n"))
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = (joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
                   .unionAll(low.select(F.col("n").alias("a"), F.col("m").alias("b"))))
        return out.filter("a <> b").distinct()

    def flat(links: DataFrame) -> bool:
        """Every node has one edge, and it leads to a node that has none to a smaller one."""
        nodes = links.select("a").distinct().withColumnRenamed("a", "c")
        per_node = links.groupBy("a").count().filter("count > 1").limit(1).count()
        return per_node == 0 and links.join(nodes, F.col("b") == F.col("c"), "left_semi").limit(1).count() == 0

    links = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                                 F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(max_rounds):
        if flat(links):
            break
        links = stored(star(star(links, True), False), "links")
    else:
        raise RuntimeError("connected components did not settle")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
