"""Multinomial logistic regression of all repeats of a hold-out in one training loop.

The feature table is stored once, each row with its role in every repeat (train, test, neither).
A round of Newton's method is one job for all repeats: a task adds up loss, gradient and Hessian
of every model over its rows, as one packed partial a repeat, and the sums (parameters squared
a repeat, whatever the number of rows) are solved on the driver. The number of jobs is the
number of rounds and does not depend on the number of repeats. What a round reads is stored once
as packed blocks of rows (``packed_rows``), which reach the tasks' NumPy without a copy of every
value; the perceptrons (``operators/perceptron.py``) read the same blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators import matrix as MX
from quillspark.operators import rounds as RD
from quillspark.session import checkpointed, ship_package

#: Rows of feature vectors per training task: a round is one job, so a small table spread over
#: many tasks pays the scheduling cost every round, while a few wide tasks leave cores idle in
#: every round of either classifier.
ROWS_PER_TRAIN_TASK = 10_000
#: Rows worked on together inside a task, and how many values they may have (8 MB).
BLOCK_ROWS, BLOCK_CELLS = 4096, 1 << 20
#: Rows of a packed block: a round's sums work on a block that stays in a processor's cache, and
#: blocks this small share out evenly among a round's tasks.
PACKED_ROWS = 1024
#: Training rows that share a mean in a perceptron's loss (the block size of Spark ML's).
MEAN_ROWS = 128
#: A model is done when a Newton step would lessen its mean loss by less than this, or when its
#: mean loss is below it (classes that a plane parts have no finite optimum).
TOLERANCE = 1e-9


def split_table(df: DataFrame, split: DataFrame, x_col: str = "x", label_col: str = "label"
                ) -> tuple[DataFrame, list[int]]:
    """((vec_id, x, label int, role array<tinyint>), repeats): every row once, with its role per
    repeat: 1 train, 0 test, -1 neither. Rows without vector or label are left out."""
    reps = sorted(r[0] for r in split.select("rep").distinct().collect())
    held = split.groupBy("vec_id").agg(F.collect_set(F.struct("rep", "is_train")).alias("s"))
    is_in = lambda r, train: F.exists("s", lambda s: (s["rep"] == r) & (s["is_train"] == train))
    role = F.transform(F.array(*[F.lit(r) for r in reps]).cast("array<int>"),
                       lambda r: F.when(is_in(r, True), 1).when(is_in(r, False), 0).otherwise(-1).cast("tinyint"))
    rows = df.where(F.col(x_col).isNotNull() & F.col(label_col).isNotNull()) \
        .select("vec_id", F.col(x_col).cast("array<double>").alias("x"), F.col(label_col).cast("int").alias("label"))
    found = rows.join(held, "vec_id").select("vec_id", "x", "label", role.alias("role"))
    want = max(1, math.ceil(rows.count() / ROWS_PER_TRAIN_TASK))
    if want > 1:  # dealt anew: the join's partitions follow bytes, keys and the session
        return checkpointed(found.repartition(want)), reps
    data = checkpointed(found)
    return (data.coalesce(want) if want < data.rdd.getNumPartitions() else data), reps


def shape_of(data: DataFrame) -> tuple[int, int]:
    """(features, classes) of a split table; (0, 0) of an empty one."""
    r = data.agg(F.max(F.size("x")).alias("d"), F.max("label").alias("k")).first()
    return (0, 0) if r["d"] is None else (int(r["d"]), int(r["k"]) + 1)


def _batch(b: pa.RecordBatch, rows: int = BLOCK_ROWS):
    """(rows x (features + 1), labels, rows x repeats roles), a block of rows at a time."""
    x = MX.column_matrix(b.column(0))
    label = b.column(1).to_numpy(zero_copy_only=False)
    role = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    size = max(1, min(rows, BLOCK_CELLS // x.shape[1]))
    for at in range(0, len(x), size):
        s = slice(at, at + size)
        yield x[s], label[s], role[s]


def packed_rows(data: DataFrame) -> DataFrame:
    """(x, label, share) binary, stored: the rows of a split table as blocks of one partition's rows,
    dealt over the tasks of a round (``rounds.round_tasks``). ``x`` are the features and a constant
    1 (float64), ``label`` the classes (int32), ``share`` (rows x repeats, uint8) says by how many
    rows a training row's mean is shared: MEAN_ROWS, fewer for the last training rows of a
    partition of ``data``, 0 for other rows."""
    ship_package(data.sparkSession)

    def run(batches):
        blocks = [block for b in batches if b.num_rows for block in _batch(b, PACKED_ROWS)]  # ROWS_PER_TRAIN_TASK rows
        if not blocks:
            return
        train = np.concatenate([role for _, _, role in blocks]) == 1
        before, n = np.cumsum(train, axis=0) - train, train.sum(axis=0)
        share = np.where(train, np.minimum(MEAN_ROWS, n - before // MEAN_ROWS * MEAN_ROWS), 0).astype(np.uint8)
        at = 0
        for x, label, _ in blocks:
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.ascontiguousarray(m, t).tobytes()], pa.binary()) for m, t in
                 ((x, np.float64), (label, np.int32), (share[at:at + len(x)], np.uint8))], names=["x", "label", "share"])
            at += len(x)

    blocks = data.select("x", "label", "role").mapInArrow(run, "x binary, label binary, share binary")
    parts = data.rdd.getNumPartitions()
    if parts == 1:
        return checkpointed(blocks)
    d = MX.dim_of(data)
    return checkpointed(blocks.repartition(RD.round_tasks(data.sparkSession, parts, ROWS_PER_TRAIN_TASK * (d + 1))))


def blocks_of(b: pa.RecordBatch):
    """(rows x (features + 1), labels, rows x repeats shares) of every block of ``packed_rows``."""
    for x, label, share in zip(*(b.column(i) for i in range(3))):
        label = np.frombuffer(label.as_buffer(), np.int32)
        yield (np.frombuffer(x.as_buffer()).reshape(len(label), -1), label,
               np.frombuffer(share.as_buffer(), np.uint8).reshape(len(label), -1))


def _scores(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Log probabilities (rows x classes) of one model; class 0 has score 0."""
    s = np.concatenate([np.zeros((len(x), 1)), x @ w.T], axis=1)
    s -= s.max(axis=1, keepdims=True)
    return s - np.log(np.exp(s).sum(axis=1, keepdims=True))


def _sums(x: np.ndarray, label: np.ndarray, w: np.ndarray) -> np.ndarray:
    """[loss, rows, gradient, Hessian] of one model over its training rows, flattened."""
    k1, p = w.shape
    logp = _scores(x, w)
    prob = np.exp(logp)
    wrong = prob.copy()
    wrong[np.arange(len(x)), label] -= 1.0
    gradient = wrong[:, 1:].T @ x
    hessian = np.empty((k1, p, k1, p))
    for a in range(k1):
        for b in range(a, k1):
            curve = prob[:, a + 1] * ((a == b) - prob[:, b + 1])
            block = (x * curve[:, None]).T @ x
            hessian[a, :, b, :] = hessian[b, :, a, :] = block
    return np.concatenate([[-logp[np.arange(len(x)), label].sum(), len(x)], gradient.ravel(), hessian.ravel()])


def _model_sums(x: np.ndarray, label: np.ndarray, share: np.ndarray, reps: Sequence[int], weights: np.ndarray) -> np.ndarray:
    """``_sums`` of the models of some repeats, a row each."""
    out = []
    for rep, w in zip(reps, weights):
        train = share[:, rep] > 0
        out.append(_sums(x[train], label[train], w))
    return np.stack(out)


def _newton(n_reps: int, k: int, p: int, rounds: int):
    """Steps of ``logistic_fit``."""
    size = (k - 1) * p
    best = np.zeros((n_reps, k - 1, p))
    step, loss = np.zeros_like(best), np.full(n_reps, np.inf)
    trial, active = best.copy(), np.ones(n_reps, bool)
    for _ in range(rounds):
        if k < 2 or not active.any():
            break
        found = yield {int(i): trial[i] for i in np.flatnonzero(active)}
        for i, sums in found.items():
            if not sums[1]:  # no training rows
                active[i] = False
                continue
            mean = sums[0] / sums[1]
            if not mean <= loss[i] + 1e-12:  # too far: go back half the way
                step[i] /= 2
                trial[i] = best[i] + step[i]
                active[i] = np.abs(step[i]).max() > 1e-12
                continue
            best[i], loss[i] = trial[i], mean
            gradient, hessian = sums[2:2 + size] / sums[1], sums[2 + size:].reshape(size, size) / sums[1]
            ridge = 1e-12 * max(np.trace(hessian) / size, 1e-300)
            move = np.linalg.lstsq(hessian + ridge * np.eye(size), -gradient, rcond=1e-14)[0]
            step[i] = move.reshape(k - 1, p)
            if mean < TOLERANCE or -(gradient @ move) / 2 < TOLERANCE:
                active[i] = False
                if mean >= TOLERANCE:  # this close, the step squares what error is left
                    best[i] += step[i]
                continue
            trial[i] = best[i] + step[i]
    return best


def logistic_fit(n_reps: int, shape: tuple[int, int], rounds: int = 100) -> RD.Fit:
    """Weights (repeats x (classes - 1) x (features + 1), the intercept last) of the unregularised
    multinomial models, class 0 as the base. ``shape``: the table's ``shape_of``."""
    d, k = shape
    size = max(k - 1, 0) * (d + 1)
    MX.check_cells((n_reps, 2 + size + size * size), "the sums of all models")
    return RD.Fit(_newton(n_reps, max(k, 1), d + 1, rounds), _model_sums, 2 + size + size * size)


def fit_logistic(data: DataFrame, n_reps: int, rounds: int = 100) -> np.ndarray:
    """The weights of ``logistic_fit`` on a split table."""
    shape = shape_of(data)
    if not shape[0] or shape[1] < 2:
        return np.zeros((n_reps, max(shape[1] - 1, 0), shape[0] + 1))
    return RD.train(packed_rows(data), blocks_of, [logistic_fit(n_reps, shape, rounds)])[0]


def _classes(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _scores(x, w).argmax(axis=1) if len(w) else np.zeros(len(x), int)


def predict_test_rows(data: DataFrame, reps: list[int], weights: np.ndarray,
                      classify: Callable[[np.ndarray, np.ndarray], np.ndarray] = _classes) -> DataFrame:
    """(rep, vec_id, label, pred): the class of every test row of every repeat, as ``classify``
    predicts it from rows (the last feature is the constant 1) and a repeat's weights."""
    spark = data.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(weights)

    def run(batches):
        w = shared.value
        for b in batches:
            at = 0
            ids = b.column(3).to_numpy(zero_copy_only=False)
            for x, label, role in _batch(b):
                for i, rep in enumerate(reps):
                    test = role[:, i] == 0
                    pred = classify(x[test], w[i])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rep] * len(pred), pa.int32()), pa.array(ids[at:at + len(x)][test], pa.int64()),
                         pa.array(label[test], pa.int32()), pa.array(pred, pa.int32())],
                        names=["rep", "vec_id", "label", "pred"])
                at += len(x)

    return data.select("x", "label", "role", F.col("vec_id").cast("long")) \
        .mapInArrow(run, "rep int, vec_id long, label int, pred int")


def fitted_moments(data: DataFrame, reps: list[int], weights: np.ndarray) -> DataFrame:
    """(rep, cls, feature, expected): sums over the training rows of predicted probability times
    feature (the last feature is the constant 1). At the optimum they equal the sums over the
    rows of that class."""
    spark = data.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(weights)
    k1, p = weights.shape[1:]

    def run(batches):
        w = shared.value
        total = np.zeros((len(reps), k1 * p))
        for b in batches:
            for x, _, role in _batch(b):
                for i in range(len(reps)):
                    train = x[role[:, i] == 1]
                    total[i] += (np.exp(_scores(train, w[i]))[:, 1:].T @ train).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int32()), pa.array(list(total))], names=["rep", "sums"])

    sums = MX.add_packed(data.select("x", "label", "role").mapInArrow(run, "rep int, sums array<double>"), ["rep"], "sums")
    return sums.select("rep", F.posexplode("sums").alias("pos", "expected")) \
        .select("rep", (F.col("pos") / p + 1).cast("int").alias("cls"), (F.col("pos") % p).alias("feature"), "expected")
