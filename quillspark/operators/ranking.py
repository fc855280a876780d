"""Exact positions and quantiles without a one-task window.

``global_rank`` range-partitions on (group, order), sorts inside partitions and numbers
rows with ``monotonically_increasing_id`` (partition id in the high bits, row index in the
low 33 bits). A small table of (partition, group) -> count, first index turns those local
numbers into positions inside each group. A group holding a third of all rows is spread
over many range partitions, so no task ever sees a whole group.

The sorted frame is checkpointed (reliable, in the shared checkpoint folder) so the
count pass and the numbering pass see the same partitioning even after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import bounded_broadcast, checkpointed

_LOW_BITS = (1 << 33) - 1
# One row per (range partition, group) pair: at most partitions + groups - 1 rows.
MAX_BROADCAST_CHUNKS = 2_000_000
# Largest group a single task may hold (window / exact percentile buffers). Above it the
# range-partitioned path is used, which never puts a whole group in one task.
MAX_GROUP_IN_TASK = 1_000_000
# Rows of a range partition: their number follows the table, whatever the session's default.
ROWS_PER_RANGE = 5_000_000


def group_sizes(df: DataFrame, group: Sequence[str]) -> tuple[int, int, int]:
    """(rows in the biggest group, number of groups, rows) in one small aggregation job."""
    if not group:
        n = int(df.count())
        return n, 1, n
    r = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")) \
        .agg(F.max("_n").alias("mx"), F.count(F.lit(1)).alias("g"), F.sum("_n").alias("n")).first()
    return int(r["mx"] or 0), int(r["g"] or 0), int(r["n"] or 0)


def global_rank(df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (),
                num_partitions: int | None = None, pos_col: str = "pos",
                n_col: str = "group_n", n_groups: int | None = None,
                n_rows: int | None = None) -> DataFrame:
    """Add ``pos`` (0-based position inside its group by ``order``) and ``group_n``.

    Give ``order`` a unique tiebreak (an id) when positions must be reproducible.
    ``n_groups``, when known, bounds the offset table (partitions + groups rows) and
    saves the job that would otherwise check its size before broadcasting it; ``n_rows``,
    when known, sets the number of range partitions (else it is counted).
    """
    spark = df.sparkSession
    group = list(group)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              -(-(df.count() if n_rows is None else n_rows) // ROWS_PER_RANGE))
    keys = [F.col(g) for g in group] + order
    s = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = checkpointed(s)
    s = s.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_loc", F.col("_mid").bitwiseAND(_LOW_BITS))
    chunk = (s.groupBy("_pid", *group)
             .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_loc").alias("_first")))
    w = Window.partitionBy(*group).orderBy("_pid") if group else Window.orderBy("_pid")
    wall = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    chunk = chunk.select(
        "_pid", *group, "_first",
        (F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
        F.sum("_cnt").over(wall).alias(n_col))
    chunk = chunk.fillna(0, subset=["_off"])
    if n_groups is not None and n + n_groups <= MAX_BROADCAST_CHUNKS:
        side = F.broadcast(chunk)
    else:
        side = bounded_broadcast(chunk, MAX_BROADCAST_CHUNKS)
    out = s.join(side, ["_pid", *group])
    return out.withColumn(pos_col, (F.col("_off") + F.col("_loc") - F.col("_first")).cast("bigint")) \
        .drop("_mid", "_pid", "_loc", "_first", "_off")


def rank_within(df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (),
                max_in_task: int | None = None, pos_col: str = "pos",
                n_col: str = "group_n") -> DataFrame:
    """``global_rank`` semantics, choosing the plan by the measured largest group.

    Groups that fit one task: ``row_number`` over a window partitioned by the group (one
    shuffle, no checkpoint). Any larger group: the range-partitioned ``global_rank``.
    """
    group = list(group)
    limit = MAX_GROUP_IN_TASK if max_in_task is None else max_in_task
    biggest, n_groups, n_rows = group_sizes(df, group)
    if not group or biggest > limit:
        return global_rank(df, order, group, pos_col=pos_col, n_col=n_col, n_groups=n_groups, n_rows=n_rows)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(pos_col, (F.row_number().over(w) - 1).cast("bigint"))
            .withColumn(n_col, F.count(F.lit(1)).over(Window.partitionBy(*group))))


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], group: Sequence[str] = (),
                    names: Sequence[str] | None = None, max_in_task: int | None = None,
                    biggest: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles (numpy's default, SQL ``percentile_cont``) per group.

    Groups that fit one task use Spark's exact ``percentile`` aggregate. Larger groups are
    selected by counted bits (``selection.radix_quantiles``): four scans, no sort, no row moved.
    ``biggest``: an upper bound of the group sizes, when known, saves the job that counts them.
    """
    from quillspark.operators.selection import radix_quantiles
    group = list(group)
    names = list(names or [f"q{i}" for i in range(len(qs))])
    src = df.where(F.col(value).isNotNull())
    limit = MAX_GROUP_IN_TASK if max_in_task is None else max_in_task
    if (group_sizes(src, group)[0] if biggest is None else biggest) > limit:
        return radix_quantiles(src, value, qs, group, names)
    pc = F.percentile(F.col(value), F.array(*[F.lit(float(q)) for q in qs]))
    g = src.groupBy(*group).agg(pc.alias("_qs"))
    return g.select(*group, *[F.get("_qs", i).alias(nm) for i, nm in enumerate(names)])
