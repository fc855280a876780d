"""Training loops whose rounds are jobs: one job a round for all models of all fits.

A fit is a ``Fit``: what a task adds up over its rows for a point of every model, and a generator
that yields the points (model -> weights) and is sent their sums (model -> array). A round asks
every fit that is not done, so fits trained together share a round's job, the reading of the rows
and the start of its Python workers. That start costs more than the rows of a small task, so the
tasks are no more than the cluster's slots while they stay within TASK_CELLS, and the few partials
that tasks send are added by the driver, always in the order of the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.operators import matrix as MX
from quillspark.session import ship_package

#: Values of a task's rows (64 MB): beyond, a round has more tasks than slots.
TASK_CELLS = 1 << 23


@dataclass
class Fit:
    """``sums(x, label, share, models, weights)``: an array (models x ``cells``) of a block of rows."""

    steps: Generator[dict[int, np.ndarray], dict[int, np.ndarray], Any]
    sums: Callable[[np.ndarray, np.ndarray, np.ndarray, Sequence[int], np.ndarray], np.ndarray]
    cells: int


def round_tasks(spark, parts: int, part_cells: int) -> int:
    """Tasks of a round over ``parts`` stored parts of ``part_cells`` values each: whole waves of the
    cluster's slots, as few as TASK_CELLS allows; never more than the parts."""
    slots = spark.sparkContext.defaultParallelism
    waves = -(-parts // (slots * max(1, TASK_CELLS // max(1, part_cells))))
    return min(parts, slots * waves)


def train(packed: DataFrame, blocks_of: Callable, fits: Sequence[Fit]) -> list:
    """What the steps of every fit return, trained on the blocks of rows of ``packed``."""
    spark = packed.sparkSession
    ship_package(spark)
    tasks = packed.rdd.getNumPartitions()
    sums_of, cells = [f.sums for f in fits], [f.cells for f in fits]
    done: list = [None] * len(fits)
    asked: dict[int, dict[int, np.ndarray]] = {}

    def proceed(no: int, found: dict[int, np.ndarray] | None) -> None:
        try:
            asked[no] = fits[no].steps.send(found)
        except StopIteration as end:
            done[no] = end.value

    for no in range(len(fits)):
        proceed(no, None)
    while asked:
        work = [(no, list(points), np.stack(list(points.values()))) for no, points in asked.items()]
        shared = spark.sparkContext.broadcast(work)

        def run(batches, shared=shared):
            totals = [np.zeros((len(models), cells[no])) for no, models, _ in shared.value]
            for b in batches:
                for x, label, share in blocks_of(b):
                    for total, (no, models, weights) in zip(totals, shared.value):
                        total += sums_of[no](x, label, share, models, weights)
            for total, (no, models, _) in zip(totals, shared.value):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([no] * len(models), pa.int32()), pa.array(models, pa.int32()), MX.list_column(total)],
                    names=["fit", "model", "sums"])

        sums = packed.mapInArrow(run, "fit int, model int, sums array<double>")
        found = MX.collect_packed(MX.add_packed(sums, ["fit", "model"], "sums", np.add, tasks))
        shared.unpersist()
        asked = {}
        for no, *_ in work:
            proceed(no, {model: total for (fit, model), total in found.items() if fit == no})
    return done
