"""Mixing sources to target weights by Poisson replication.

Every document is repeated a Poisson number of times whose mean is the repetition rate its
source needs: ``rate = weight share * total size / source size``. The Poisson draw inverts
the distribution at a uniform number taken from a hash of (seed, doc_id, text), so the same
input gives the same copies wherever it runs, and rows without an id draw apart. Rows that agree
in both, told by one aggregation, add the place of their row, so they draw apart as well. The
copies are then dealt and sorted by a hash of the same and the copy's number: a global shuffle.

DataFrame functions only. Sources: sizes come from one aggregation with map-side sums, so a
source holding a third of all rows costs one row per task. The table of rates is broadcast
while its measured number of cells is within ``MAX_BROADCAST_CELLS``; beyond, documents are
salted and joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import stored

MAX_BROADCAST_CELLS = 1_000_000
SALTS = 64
#: 13 hex digits are 52 bits, which a double holds exactly.
_STEPS = float(1 << 52)


def row_name(doc_id: Column, text: Column) -> Column:
    """doc_id:md5(text); a null id is "null", a null text is empty."""
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"),
                    F.md5(F.coalesce(text.cast("binary"), F.lit("").cast("binary"))))


def named_rows(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with a column ``__name`` that no other row has: ``row_name``, and for rows that
    are equal in it the place of the row in its task's input. Without equal rows, the usual case,
    nothing is joined; their names are broadcast within ``MAX_BROADCAST_CELLS``."""
    base = docs.select(*names, row_name(F.col("doc_id"), F.col("text")).alias("__name"))
    twice = stored(base.groupBy("__name").count().filter("count > 1").select(F.col("__name").alias("__twice")), "mix-repeats")
    n = twice.count()
    if not n:
        return base
    base = base.withColumn("__place", F.monotonically_increasing_id())
    if n <= MAX_BROADCAST_CELLS:
        joined = base.join(F.broadcast(twice), F.col("__name") == F.col("__twice"), "left")
    else:
        salted = twice.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = base.join(salted, (F.col("__name") == F.col("__twice"))
                           & (F.pmod("__place", F.lit(SALTS)) == F.col("__salt")), "left")
    place = F.when(F.col("__twice").isNull(), F.lit("")).otherwise(F.concat(F.lit(":"), F.col("__place").cast("string")))
    return joined.select(*names, F.concat("__name", place).alias("__name"))


def uniform(seed: str, name: Column) -> Column:
    """A number strictly between 0 and 1 from md5(seed:name)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), name))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(_STEPS)


def source_rates(docs: DataFrame, weights: dict[str, float], default_weight: float,
                 epochs: float) -> DataFrame:
    """(mix_source, rate, cdf): the repetition rate of each source and the cumulative Poisson
    probabilities of 0, 1, 2, ... repetitions, up to ten deviations above the mean.

    Sizes are code points of the texts; a source without text or weight gets rate 0.
    """
    weight = F.lit(float(default_weight))
    for name, w in weights.items():
        weight = F.when(F.col("mix_source") == name, F.lit(float(w))).otherwise(weight)
    sizes = (docs.groupBy(F.col("source").alias("mix_source"))
             .agg(F.sum(F.coalesce(F.char_length("text"), F.lit(0)).cast("long")).alias("size"))
             .withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(F.lit(0.0))))
    sizes = stored(sizes, "mix-sizes")
    total = sizes.agg(F.sum("size"), F.sum("weight")).first()
    size, mass = float(total[0] or 0), float(total[1] or 0)
    rate = (F.when((F.col("size") > 0) & (F.col("weight") > 0),
                   F.col("weight") * F.lit(size * epochs) / (F.lit(mass or 1.0) * F.col("size")))
            .otherwise(F.lit(0.0)))
    rates = sizes.withColumn("rate", rate)
    grid = rates.withColumn("k", F.explode(F.sequence(
        F.lit(0), F.ceil(F.col("rate") + 10 * F.sqrt("rate") + 20).cast("int"))))
    upto = Window.partitionBy("mix_source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    grid = grid.withColumn("log_fact", F.sum(F.when(F.col("k") > 0, F.log(F.col("k").cast("double")))
                                             .otherwise(0.0)).over(upto))
    pmf = (F.when(F.col("rate") > 0, F.exp(F.col("k") * F.log("rate") - F.col("rate") - F.col("log_fact")))
           .otherwise(F.when(F.col("k") == 0, 1.0).otherwise(0.0)))
    grid = grid.withColumn("p", pmf).withColumn("c", F.sum("p").over(upto))
    return (grid.groupBy("mix_source", "rate")
            .agg(F.array_sort(F.collect_list(F.struct("k", "c"))).alias("steps"))
            .select("mix_source", "rate", F.col("steps.c").alias("cdf")))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, default_weight: float = 1.0,
                epochs: float = 1.0, seed: str = "mix") -> DataFrame:
    """Repeat documents so that each source's expected share of the output's code points is
    its share of the weights, and shuffle the copies globally.

    Returns all columns of ``docs`` plus ``copy`` (int, from 0) and ``shuffle_key`` (string);
    columns of those names in the input are replaced. ``epochs`` scales the expected output
    size against the input size.

    Edge cases: a null source is a source of its own (with ``default_weight``, or the weight
    given for no name); a source whose texts are all empty or null, or whose weight is 0,
    yields no rows; every row draws on its own, also rows that share a doc_id, have none or
    repeat whole; null and empty texts are equal; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    rates = stored(source_rates(docs, weights or {}, default_weight, epochs), "mix-rates")
    rows, cells = rates.agg(F.count("*"), F.coalesce(F.sum(F.size("cdf")), F.lit(0))).first()
    base = named_rows(docs, names).withColumn("__u", uniform(seed, F.col("__name")))
    if rows + cells <= MAX_BROADCAST_CELLS:
        joined = base.join(F.broadcast(rates), F.col("source").eqNullSafe(F.col("mix_source")))
    else:
        salted = rates.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (base.withColumn("__s", F.pmod(F.xxhash64("__name"), F.lit(SALTS)).cast("int"))
                  .join(salted, F.col("source").eqNullSafe(F.col("mix_source"))
                        & (F.col("__s") == F.col("__salt"))))
    n = F.size(F.filter("cdf", lambda c: c < F.col("__u")))
    copies = (joined.withColumn("__n", n).filter("__n > 0")
              .select(*names, "__name", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("copy")))
    key = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("copy").cast("string"), F.lit(":"), F.col("__name"))), 1, 16)
    return (copies.withColumn("shuffle_key", key).drop("__name")
            .repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key"))
