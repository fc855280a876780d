"""Multilayer perceptrons of all repeats of a hold-out in one training loop.

The models are those of Spark ML's ``MultilayerPerceptronClassifier``: sigmoid layers, softmax with
cross-entropy on top, its first weights, means over blocks of rows, trained by limited-memory BFGS
with a strong Wolfe line search. One of its fits is a job for every point it looks at, each
reading the rows of its repeat; here every repeat keeps its own search, and a job gives all of them
the loss and gradient at the point each waits for. The number of jobs is that of the longest search
and does not depend on the number of repeats; only weights and gradients reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from quillspark.operators import logistic as LG
from quillspark.operators import matrix as MX
from quillspark.operators import rounds as RD

#: Steps remembered by a search, values that must differ for it to go on, and its tolerance.
MEMORY, LAST_VALUES, TOLERANCE = 10, 20, 1e-6
#: Points tried along a direction, and in an interval that holds a minimum.
MAX_TRIALS = 10
#: Rows whose activations in all models are held at once: they fit a processor's cache.
STEP_ROWS = 1024
#: The sufficient decrease and the curvature that a step has to meet.
DECREASE, CURVATURE = 1e-4, 0.9


class SearchFailed(Exception):
    """No step along a direction meets the conditions."""


# ---- one search ------------------------------------------------------------------------------------
# A search is a generator: it yields the points whose loss and gradient it needs, and is sent them.
Search = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


def _between(left: tuple, right: tuple) -> float:
    """Minimum of the cubic through two (step, value, slope), kept off both ends."""
    (a, fa, da), (b, fb, db) = left, right
    d1 = da + db - 3 * (fa - fb) / (a - b)
    d2 = np.sqrt(d1 * d1 - da * db)
    t = b - (b - a) * (db + d2 - d1) / (db - da + 2 * d2)
    low, high = a + 0.1 * (b - a), a + 0.9 * (b - a)
    return low if t < low else high if t > high else t


def _line_search(x: np.ndarray, way: np.ndarray, value: float, gradient: np.ndarray, step: float):
    """(step, value, gradient) there, a step along ``way`` that meets the strong Wolfe conditions."""
    slope = gradient @ way
    if slope > 0:
        raise SearchFailed("not a way down")

    def at(t):
        v, g = yield x + way * t
        return (t, v, g @ way), g

    def zoom(low, high):
        for _ in range(MAX_TRIALS):
            c, g = yield from at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if c[1] > value + DECREASE * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= CURVATURE * abs(slope):
                return c[0], c[1], g
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise SearchFailed("no step in the interval")

    low, t = (0.0, value, slope), step
    for i in range(MAX_TRIALS):
        c, g = yield from at(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + DECREASE * t * slope or (c[1] >= low[1] and i):
            return (yield from zoom(low, c))
        if abs(c[2]) <= CURVATURE * abs(slope):
            return t, c[1], g
        if c[2] >= 0:
            return (yield from zoom(c, low))
        low, t = c, t * 1.5
    raise SearchFailed("no step along the way")


def _direction(gradient: np.ndarray, moves: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The gradient, turned by the last steps (newest first) and the gradient's changes over them."""
    way, parts = gradient.copy(), []
    for s, y in moves:
        parts.append((s @ way) / (s @ y))
        if np.isnan(parts[-1]):
            raise SearchFailed("the last steps do not give a direction")
        way -= parts[-1] * y
    if moves:
        s, y = moves[0]
        if not s @ y >= 0:
            raise SearchFailed("the last step turned the gradient back")
        way *= (s @ y) / (y @ y)
    for (s, y), part in zip(reversed(moves), reversed(parts)):
        way += (part - (y @ way) / (s @ y)) * s
    return -way


def search(x: np.ndarray, max_iter: int, tolerance: float = TOLERANCE) -> Search:
    """Minimum by limited-memory BFGS from ``x``. It ends after ``max_iter`` steps, when the last
    values or the gradient are within the tolerance, or when two searches along a line fail."""
    value, gradient = yield x
    first, last, moves, steps, failed = value, [np.inf], [], 0, False
    while steps < max_iter:
        if len(last) >= 2 and abs(value - max(last)) <= tolerance * first:
            break
        if np.linalg.norm(gradient) <= max(tolerance * value, 1e-8):
            break
        try:
            way = _direction(gradient, moves)
            step = 1.0 if steps else 1.0 / np.linalg.norm(way)
            step, new_value, new = yield from _line_search(x, way, value, gradient, step)
            if step * np.linalg.norm(gradient) < 1e-10:
                raise SearchFailed("the step vanishes")
        except SearchFailed:
            if failed:
                break
            failed, moves = True, []
            continue
        there = x + way * step
        moves = [(there - x, new - gradient), *moves][:MEMORY]
        x, value, gradient, steps, failed = there, new_value, new, steps + 1, False
        last = [*last, value][-LAST_VALUES:]
    return x


# ---- loss and gradient of all models ---------------------------------------------------------------
def _layers(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """((models, out, in) weights, (models, out, 1) biases) of every layer, from flat weights."""
    out, at = [], 0
    for a, b in zip(layers[:-1], layers[1:]):
        out.append((weights[:, at:at + a * b].reshape(-1, a, b).transpose(0, 2, 1), weights[:, at + a * b:at + a * b + b, None]))
        at += a * b + b
    return out


def _outputs(x: np.ndarray, nets: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """(models, units, rows) of every layer, those of the last before the softmax. The first layer of
    all models is one product."""
    w, bias = nets[0]
    outs = [(w.reshape(-1, w.shape[2]) @ x.T).reshape(len(w), w.shape[1], -1) + bias]
    for w, bias in nets[1:]:
        z = outs[-1]  # the sigmoid, in place
        np.negative(z, out=z)
        np.exp(z, out=z)
        z += 1.0
        np.reciprocal(z, out=z)
        outs.append(w @ z + bias)
    return outs


def _sums(x: np.ndarray, label: np.ndarray, share: np.ndarray, weights: np.ndarray, layers: Sequence[int]) -> np.ndarray:
    """[loss, means, gradient] of all models (a row each) over their training rows (share > 0)."""
    nets = _layers(weights, layers)
    outs = _outputs(x, nets)
    part = np.divide(1.0, share.T, out=np.zeros(share.T.shape), where=share.T > 0)  # models x rows
    z, rows = outs.pop(), np.arange(len(x))
    z -= z.max(axis=1, keepdims=True)
    log_sum = np.log(np.exp(z).sum(axis=1))
    loss = np.where(part > 0, (log_sum - z[:, label, rows]) * part, 0.0).sum(axis=1)
    delta = np.exp(z - log_sum[:, None, :])
    delta[:, label, rows] -= 1.0
    delta *= part[:, None, :]
    delta[np.broadcast_to((part == 0)[:, None, :], delta.shape)] = 0.0
    gradient = []
    for i in range(len(nets) - 1, -1, -1):
        gradient.append(delta.sum(axis=2))
        if i:
            gradient.append((outs[i - 1] @ delta.transpose(0, 2, 1)).reshape(len(weights), -1))
            delta = nets[i][0].transpose(0, 2, 1) @ delta
            delta *= outs[i - 1]
            delta *= 1.0 - outs[i - 1]
        else:
            m, units, n = delta.shape
            gradient.append((delta.reshape(-1, n) @ x).reshape(m, units, -1).transpose(0, 2, 1).reshape(m, -1))
    return np.concatenate([loss[:, None], part.sum(axis=1)[:, None], *reversed(gradient)], axis=1)


def first_weights(spark: SparkSession, layers: Sequence[int], seed: int) -> np.ndarray:
    """The weights that Spark ML's perceptron begins with: those of a fit without a step."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.linalg import Vectors
    row = spark.createDataFrame([(Vectors.sparse(layers[0], []), 0.0)], ["features", "label"])
    return MultilayerPerceptronClassifier(layers=list(layers), maxIter=0, seed=seed).fit(row).weights.toArray()


def _descend(best: np.ndarray, max_iter: int):
    """Steps of ``perceptron_fit`` from first weights a repeat."""
    searches = {i: search(best[i], max_iter) for i in range(len(best))}
    points = {i: next(s) for i, s in searches.items()}
    while points:
        found, points = (yield points), {}
        for i, sums in found.items():
            if not sums[1]:  # no training rows
                continue
            try:
                with np.errstate(all="ignore"):
                    points[i] = searches[i].send((sums[0] / sums[1], sums[2:] / sums[1]))
            except StopIteration as done:
                best[i] = done.value
    return best


def perceptron_fit(spark: SparkSession, n_reps: int, layers: Sequence[int], max_iter: int = 100, seed: int = 7) -> RD.Fit:
    """Flat weights (repeats x weights, in Spark ML's order) of a perceptron a repeat. ``layers``:
    features, hidden units, classes. A repeat without training rows keeps the first weights."""
    layers = [int(n) for n in layers]
    size = sum((a + 1) * b for a, b in zip(layers[:-1], layers[1:]))
    MX.check_cells((n_reps, 2 + size), "the sums of all models")

    def sums(x, label, share, reps, weights):
        total = np.zeros((len(reps), 2 + size))
        for at in range(0, len(x), STEP_ROWS):
            s = slice(at, at + STEP_ROWS)
            total += _sums(x[s, :-1], label[s], share[s][:, reps], weights, layers)
        return total

    return RD.Fit(_descend(np.tile(first_weights(spark, layers, seed), (n_reps, 1)), max_iter), sums, 2 + size)


def fit_perceptrons(packed: DataFrame, n_reps: int, layers: Sequence[int], max_iter: int = 100,
                    seed: int = 7) -> np.ndarray:
    """The weights of ``perceptron_fit`` on the ``logistic.packed_rows`` of a split table."""
    fit = perceptron_fit(packed.sparkSession, n_reps, layers, max_iter, seed)
    return RD.train(packed, LG.blocks_of, [fit])[0]


def classifier(layers: Sequence[int]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Classes of rows (the last feature is the constant 1) by the flat weights of a model."""
    return lambda x, w: _outputs(x[:, :-1], _layers(w[None, :], layers))[-1][0].argmax(axis=0)
