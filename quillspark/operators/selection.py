"""Exact order statistics by counting the ordered bits of doubles.

A double's 64 bits, the lower ones inverted below zero, sort like the double itself. Four passes
of 16 bits each find the value at a wanted position: a pass counts, for every group, how many
values share each next prefix of the prefix found so far, and the running count tells which
longer prefix holds the position. Counts are summed in the tasks before they are shuffled, so a
value that fills most rows is one number a task; rows are never sorted, moved or stored. Between
passes only (group, target, prefix, position left) is kept, two targets a quantile.

``array_quantiles`` counts the elements of an array column by numpy, all positions of the array
(features) at once and without exploding rows; ``radix_quantiles`` works on any long table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quillspark.session import bounded_broadcast, checkpointed, ship_package

#: Bits of a pass, and passes.
DIGIT, PASSES = 16, 4
#: Wanted prefixes (groups x targets) that may be broadcast; more are joined by shuffle.
MAX_BROADCAST_PREFIXES = 1_000_000
#: Distinct counted prefixes that a task holds before it merges them.
MERGE_AT = 1 << 20
_LOW63 = np.int64(0x7FFF_FFFF_FFFF_FFFF)


def ordered_codes(values: np.ndarray) -> np.ndarray:
    """Longs that sort like the doubles: -0.0 equals 0.0, NaN comes last."""
    v = np.asarray(values, dtype=np.float64) + 0.0
    v[np.isnan(v)] = np.nan
    bits = v.view(np.int64)
    return bits ^ ((bits >> np.int64(63)) & _LOW63)


def code_values(codes: np.ndarray) -> np.ndarray:
    """The doubles of ``ordered_codes``."""
    codes = np.asarray(codes, dtype=np.int64)
    return (codes ^ ((codes >> np.int64(63)) & _LOW63)).view(np.float64)


class Tally:
    """key -> count for whole arrays of keys."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        k, n = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(n)
        self.size += len(k)
        if self.size > MERGE_AT:
            k, n = self.items()
            self.keys, self.counts, self.size = [k], [n], len(k) // 2  # half: merging stays rare

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        k, inverse = np.unique(np.concatenate(self.keys), return_inverse=True)
        return k, np.bincount(inverse, np.concatenate(self.counts)).astype(np.int64)


def _same(a: DataFrame, b: DataFrame, names: Sequence[str]):
    """Join condition: equal columns, null equal to null."""
    cond = F.lit(True)
    for c in names:
        cond = cond & a[c].eqNullSafe(b[f"_{c}"])
    return cond


def _selected(counts_of: Callable[[int, DataFrame | None], DataFrame], qs: Sequence[float], group: list[str],
              names: Sequence[str]) -> DataFrame:
    """(group..., names...): ``counts_of(pass, wanted)`` gives (group..., prefix, n), for passes
    after the first only below the wanted (group..., prefix)."""
    targets = []
    for i, q in enumerate(qs):
        at = F.lit(float(q)) * (F.col("total") - 1)
        targets += [F.struct(F.lit(2 * i).alias("t"), F.floor(at).alias("left"), (F.ceil(at) - at).alias("part")),
                    F.struct(F.lit(2 * i + 1).alias("t"), F.ceil(at).alias("left"), (at - F.floor(at)).alias("part"))]
    within = [*group] if group else [F.lit(0)]
    c = counts_of(1, None)
    upto = Window.partitionBy(*within).orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(Window.partitionBy(*within)))
    hit = (F.col("left") < F.col("upto")) & (F.col("left") >= F.col("upto") - F.col("n"))
    left = (F.col("left") - (F.col("upto") - F.col("n"))).alias("left")
    state = c.select(*group, "prefix", "n", "upto", F.explode(F.array(*targets)).alias("s")) \
        .select(*group, "prefix", "n", "upto", "s.*").where(hit).select(*group, "t", "part", "prefix", left)
    for no in range(2, PASSES + 1):
        state = checkpointed(state)  # two rows a quantile and group
        c = counts_of(no, state).withColumn("above", F.shiftright("prefix", DIGIT))
        upto = Window.partitionBy(*group, "above").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
        c = c.withColumn("upto", F.sum("n").over(upto))
        s = state.select(*[F.col(g).alias(f"_{g}") for g in group], "t", "part", "left", F.col("prefix").alias("_above"))
        state = c.join(s, _same(c, s, [*group, "above"])).where(hit).select(*group, "t", "part", "prefix", left)

    ship_package(state.sparkSession)

    def values(batches):  # by Arrow: pandas would turn NaN into NULL
        for b in batches:
            v = code_values(b.column(b.num_columns - 1).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(v)], names=[*b.schema.names[:-1], "v"])

    schema = StructType([*(state.schema[c] for c in (*group, "t", "part")), StructField("v", DoubleType())])
    state = checkpointed(state.select(*group, "t", "part", "prefix").mapInArrow(values, schema))
    pick = lambda t, col: F.max(F.when(F.col("t") == t, F.col(col)))
    wide = state.groupBy(*group).agg(*[pick(t, c).alias(f"_{c}{t}") for t in range(2 * len(qs)) for c in ("v", "part")])
    outs = []
    for i, name in enumerate(names):
        (lo, a), (hi, b) = ((F.col(f"_v{t}"), F.col(f"_part{t}")) for t in (2 * i, 2 * i + 1))
        outs.append(F.when(lo == hi, lo).otherwise(a * lo + b * hi).alias(name))  # as ``percentile`` weighs them
    return wide.select(*group, *outs)


def radix_quantiles(df: DataFrame, value: str, qs: Sequence[float], group: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """(group..., q...) of a long table: linear interpolation, NULL values left out. A group
    without values has no row (without ``group``: one row of NULLs)."""
    group = list(group)
    names = list(names or [f"q{i}" for i in range(len(qs))])
    ship_package(df.sparkSession)

    @F.pandas_udf("long")
    def code_of(v: pd.Series) -> pd.Series:
        return pd.Series(ordered_codes(v.to_numpy(np.float64)))

    src = df.where(F.col(value).isNotNull()).select(*group, code_of(F.col(value).cast("double")).alias("_code"))

    def counts_of(no: int, wanted: DataFrame | None) -> DataFrame:
        rows = src.select(*group, F.shiftright("_code", 64 - DIGIT * no).alias("prefix"))
        if wanted is not None:
            w = wanted.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("prefix").alias("_above")).distinct()
            rows = rows.withColumn("above", F.shiftright("prefix", DIGIT))
            w = bounded_broadcast(w, MAX_BROADCAST_PREFIXES)
            rows = rows.join(w, _same(rows, w, [*group, "above"]), "left_semi")
        return rows.groupBy(*group, "prefix").agg(F.count(F.lit(1)).alias("n"))

    return _selected(counts_of, qs, group, names)


def array_quantiles(df: DataFrame, x_col: str, qs: Sequence[float], names: Sequence[str] | None = None,
                    by_position: bool = True) -> DataFrame:
    """Quantiles over the elements of an array column, NULL elements left out: (feature, q...)
    per position of the array, or one row (q...) over all elements."""
    names = list(names or [f"q{i}" for i in range(len(qs))])
    group = ["feature"] if by_position else []
    ship_package(df.sparkSession)
    rows = df.select(F.col(x_col).cast("array<double>").alias("x"))

    def counts_of(no: int, wanted: DataFrame | None) -> DataFrame:
        # One array of wanted prefixes by feature and target: as many numbers as the result has.
        slots, shift = None, np.int64(64 - DIGIT * no)
        if wanted is not None:
            found = wanted.select(F.col("feature") if by_position else F.lit(0).alias("feature"), "t", "prefix").toPandas()
            slots = np.zeros((2 * len(qs), int(found["feature"].max()) + 1 if len(found) else 0), np.int64)
            known = np.zeros(slots.shape, bool)
            slots[found["t"], found["feature"]] = found["prefix"]
            known[found["t"], found["feature"]] = True

        def run(batches):
            tally = Tally()
            for b in batches:
                lists = b.column(0)
                flat = lists.flatten()
                if not len(flat):
                    continue
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                first = np.cumsum(sizes) - sizes
                feature = np.arange(len(flat)) - np.repeat(first, sizes) if by_position else np.zeros(len(flat), np.int64)
                codes = ordered_codes(flat.to_numpy(zero_copy_only=False))
                if flat.null_count:
                    there = flat.is_valid().to_numpy(zero_copy_only=False)
                    feature, codes = feature[there], codes[there]
                prefix = codes >> shift
                if slots is None:
                    tally.add((feature << np.int64(DIGIT)) + (prefix + (1 << (DIGIT - 1))))
                    continue
                if not slots.shape[1]:
                    continue
                above, seen = prefix >> np.int64(DIGIT), np.zeros(len(prefix), bool)
                inside = feature < slots.shape[1]
                place = np.where(inside, feature, 0)
                for t in range(len(slots)):
                    here = (above == slots[t][place]) & known[t][place] & inside & ~seen
                    if here.any():
                        seen |= here
                        tally.add(((t * slots.shape[1] + feature[here]) << np.int64(DIGIT)) + (prefix[here] & 0xFFFF))
            keys, n = tally.items()
            digit = keys & np.int64(0xFFFF)
            if slots is None:
                feature, prefix = keys >> np.int64(DIGIT), digit - (1 << (DIGIT - 1))
            elif len(keys):
                t, feature = np.divmod(keys >> np.int64(DIGIT), slots.shape[1])
                prefix = (slots[t, feature] << np.int64(DIGIT)) + digit
            else:
                feature, prefix = keys, keys
            yield pa.RecordBatch.from_arrays([pa.array(feature.astype(np.int32)), pa.array(prefix), pa.array(n)],
                                             names=["feature", "prefix", "n"])

        found = rows.mapInArrow(run, "feature int, prefix long, n long")
        return found.groupBy(*group, "prefix").agg(F.sum("n").alias("n"))

    return _selected(counts_of, qs, group, names)
