"""Distributed fit of Spark ML's multilayer perceptron classifier.

The estimator, its starting weights, objective, optimiser and model are Spark ML's: the mean over stacks of
``blockSize`` rows of a task of the stack's mean cross entropy, minimised by L-BFGS (10 corrections, strong Wolfe
line search, the estimator's ``maxIter`` and ``tol``). Only the passes differ. The rows are cached once as
blocks of doubles, and a task computes the loss and gradient of its blocks as numpy matrix products (README has
the figures). The driver holds the weights and a gradient a task, never rows.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_STACKS = 8            # stacks of rows in a cached block
CORRECTIONS = 10            # of L-BFGS, as Spark ML's
SEARCH_STEPS = 10           # of the line search and of its zoom
LAST_VALUES = 20            # of the convergence check


def _layers(weights: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(matrix, intercepts) of each layer: views of Spark's weight vector."""
    out, at = [], 0
    for i, o in zip(sizes, sizes[1:]):
        out.append((weights[at:at + i * o].reshape(i, o), weights[at + i * o:at + i * o + o]))
        at += i * o + o
    return out


def add_gradient(x: np.ndarray, y: np.ndarray, layers, into, share: float) -> float:
    """Adds ``share`` times the summed gradient of the rows to ``into``; the rows' loss times ``share``."""
    values = [x]
    for k, (w, b) in enumerate(layers):
        z = values[-1] @ w
        z += b
        if k + 1 < len(layers):                                  # sigmoid
            np.negative(z, out=z)
            np.exp(z, out=z)
            z += 1.0
            np.reciprocal(z, out=z)
        else:                                                    # softmax
            z -= z.max(axis=1, keepdims=True)
            np.exp(z, out=z)
            z /= z.sum(axis=1, keepdims=True)
        values.append(z)
    target = np.eye(values[-1].shape[1])[y]
    loss = -share * float((target * np.log(values[-1])).sum())
    delta = (values[-1] - target) * share
    for k in range(len(layers) - 1, -1, -1):
        into[k][0][...] += values[k].T @ delta
        into[k][1][...] += delta.sum(axis=0)
        if k:
            delta = delta @ layers[k][0].T
            delta *= values[k]
            delta *= 1.0 - values[k]
    return loss


def cached_blocks(df: DataFrame, features: str, label: str, width: int, rows: int):
    """RDD of (matrix of doubles, labels), ``rows`` rows of a task each, its last rows one smaller block."""
    def run(batches):
        xs, ys, held = [], [], 0

        def block(x, y):
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["x", "y"])
        for b in batches:
            xs.append(b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width))
            ys.append(b.column(1).to_numpy(zero_copy_only=False))
            held += b.num_rows
            if held >= rows:
                x, y = np.concatenate(xs), np.concatenate(ys)
                full = held - held % rows
                for i in range(0, full, rows):
                    yield block(x[i:i + rows], y[i:i + rows])
                xs, ys, held = [x[full:]], [y[full:]], held - full
        if held:
            yield block(np.concatenate(xs), np.concatenate(ys))
    slim = df.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"))
    return (slim.mapInArrow(run, "x binary, y binary").rdd
            .map(lambda r: (np.frombuffer(r[0]).reshape(-1, width), np.frombuffer(r[1], np.int32)))
            .persist(StorageLevel.MEMORY_AND_DISK))


def objective(blocks, sizes: list[int], stack: int):
    """weights -> (loss, gradient), by one pass over the cached blocks."""
    sc = blocks.context

    def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
        sent = sc.broadcast(weights)

        def run(part):
            layers, total = _layers(sent.value, sizes), np.zeros_like(sent.value)
            into, loss, stacks = _layers(total, sizes), 0.0, 0
            with np.errstate(all="ignore"):                      # steps that overflow are refused by the line search
                for x, y in part:
                    full = len(y) - len(y) % stack
                    for low, high, n in ((0, full, stack), (full, len(y), len(y) - full)):
                        if high > low:
                            loss += add_gradient(x[low:high], y[low:high], layers, into, 1.0 / n)
                            stacks += -(-(high - low) // stack)
            yield loss, total, stacks
        parts = blocks.mapPartitions(run).collect()              # added in the order of the tasks, so reruns agree
        sent.destroy()
        stacks = sum(p[2] for p in parts)
        if not stacks:
            raise ValueError("the perceptron has no rows to be fitted on")
        return sum(p[0] for p in parts) / stacks, sum(p[1] for p in parts) / stacks
    return evaluate


# ------------------------------------------------------------------ L-BFGS
class SearchFailed(Exception):
    pass


def _interpolated(left, right) -> float:
    """The minimum of the cubic through two (step, slope, value), kept off the ends."""
    d1 = left[1] + right[1] - 3 * (left[2] - right[2]) / (left[0] - right[0])
    root = d1 * d1 - left[1] * right[1]
    d2 = math.sqrt(root) if root >= 0 else math.nan
    wide = right[0] - left[0]
    bottom = right[1] - left[1] + 2 * d2
    t = right[0] - wide * (right[1] + d2 - d1) / bottom if bottom else math.nan
    low, high = left[0] + 0.1 * wide, left[0] + 0.9 * wide
    return low if t < low else high if t > high else t


def wolfe_step(phi, first: float) -> float:
    """A step that meets the strong Wolfe conditions; ``phi(step)`` gives (step, slope, value)."""
    low = start = phi(0.0)
    _, slope, value = start
    if slope > 0:
        raise SearchFailed("not a direction of descent")

    def zoom(low, high):
        for _ in range(SEARCH_STEPS):
            c = phi(_interpolated(high, low) if low[0] > high[0] else _interpolated(low, high))
            if c[2] > value + 1e-4 * c[0] * slope or c[2] >= low[2]:
                high = c
            else:
                if abs(c[1]) <= 0.9 * abs(slope):
                    return c[0]
                if c[1] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise SearchFailed("no step in the bracket")
    t = first
    for i in range(SEARCH_STEPS):
        c = phi(t)
        if not math.isfinite(c[2]):
            t /= 2
            continue
        if c[2] > value + 1e-4 * t * slope or (c[2] >= low[2] and i > 0):
            return zoom(low, c)
        if abs(c[1]) <= 0.9 * abs(slope):
            return t
        if c[1] >= 0:
            return zoom(c, low)
        low, t = c, 1.5 * t
    raise SearchFailed("no step")


def _direction(gradient: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the gradient times the inverse Hessian of the (step, gradient change) pairs, newest first."""
    out, alphas, scale = gradient.copy(), [], 1.0
    if history:
        s, g = history[0]
        sy = float(s @ g)
        if not sy >= 0:
            raise SearchFailed("negative curvature")
        scale = np.divide(sy, g @ g)
    for s, g in history:
        alphas.append(np.divide(s @ out, s @ g))
        if np.isnan(alphas[-1]):
            raise SearchFailed("no curvature")
        out -= alphas[-1] * g
    out *= scale
    for (s, g), a in reversed(list(zip(history, alphas))):
        out += (a - np.divide(g @ out, s @ g)) * s
    return -out


def minimised(evaluate, start: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """L-BFGS with Spark ML's steps and stopping rules."""
    last: list = [None, None]

    def f(w):
        if last[0] is None or not np.array_equal(last[0], w):
            last[:] = w, evaluate(w)
        return last[1]
    x, (value, gradient) = start, f(start)
    first, seen, history, done, failed = value, [math.inf], [], 0, False
    while done < max_iter:
        if len(seen) >= 2 and abs(value - max(seen)) <= tol * abs(first):
            break
        if np.linalg.norm(gradient) <= max(tol * abs(value), 1e-8):
            break
        try:
            with np.errstate(all="ignore"):
                way = _direction(gradient, history)

            def phi(t):
                v, g = f(x + way * t)
                return t, float(g @ way), v
            step = wolfe_step(phi, 1.0 if done else 1.0 / float(np.linalg.norm(way)))
            if step * np.linalg.norm(gradient) < 1e-10:
                raise SearchFailed("step too small")
        except SearchFailed:
            if failed:
                break
            failed, history = True, []
            continue
        new = x + way * step
        new_value, new_gradient = f(new)
        history = [(new - x, new_gradient - gradient), *history][:CORRECTIONS]
        x, value, gradient, done, failed = new, new_value, new_gradient, done + 1, False
        seen = [*seen, value][-LAST_VALUES:]
    return x


def fit_perceptron(estimator: MultilayerPerceptronClassifier, df: DataFrame) -> MultilayerPerceptronClassificationModel:
    """The estimator fitted on all rows of ``df``, dealt as its partitions are."""
    sizes, stack = estimator.getLayers(), estimator.getBlockSize()
    # no iteration, on one row of zeros a class: Spark's starting weights, and later its model of given weights
    still = estimator.copy({estimator.maxIter: 0})
    zeros = df.sparkSession.createDataFrame([(float(c), Vectors.dense([0.0] * sizes[0])) for c in range(sizes[-1])],
                                            [estimator.getLabelCol(), estimator.getFeaturesCol()])
    start = still.fit(zeros).weights.toArray()
    blocks = cached_blocks(df, estimator.getFeaturesCol(), estimator.getLabelCol(), sizes[0], BLOCK_STACKS * stack)
    try:
        weights = minimised(objective(blocks, sizes, stack), start, estimator.getMaxIter(), estimator.getTol())
    finally:
        blocks.unpersist()
    return still.copy({still.initialWeights: Vectors.dense(weights)}).fit(zeros)
