"""Many logistic regressions in shared scans.

A search fits the same learner on many subsets of the same rows: folds, nested
training sizes, grid points.  Here a model is a row mask and a penalty, and every
Newton step of all models is one aggregate over the data: each task adds up, for
each model, the loss, the gradient and the normal matrix of its rows under the
mask; the steps themselves, with the elastic net, are small systems (one per
model, features squared) that the driver solves.  A search takes as many scans
as its slowest model takes steps, whatever the number of folds and points.

The objective is that of ``LogisticRegression``: mean weighted log loss plus
regParam * (elasticNetParam * |b|_1 + (1 - elasticNetParam) / 2 * |b|^2) on
coefficients of features with unit deviation (weighted, of the model's own
rows), the intercept free.  Class weights are those of the model's own rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

SLOTS = 16                     # partial sums of a model that reach the driver
TOL = 1e-9                     # largest change of a coefficient (unit deviation) at the end
STEPS = 100


class Linear(NamedTuple):
    """Coefficients on the original scale of the features."""
    coefficients: np.ndarray
    intercept: float


class _State:
    """One model between two scans."""

    def __init__(self, mask: int, reg: float, alpha: float, deviation: np.ndarray, weights: np.ndarray, total: float) -> None:
        self.mask, self.weights, self.total = mask, weights, total
        self.l1, self.l2 = reg * alpha * deviation, reg * (1 - alpha) * deviation ** 2
        self.active = np.append(deviation > 0, True)       # the last entry is the intercept
        self.now = self.next = np.zeros(len(deviation) + 1)
        self.value, self.step, self.share, self.done = np.inf, None, 1.0, False

    def penalty(self, b: np.ndarray) -> float:
        return float(np.abs(b[:-1]) @ self.l1 + (b[:-1] ** 2) @ self.l2 / 2)

    def advance(self, loss: float, gradient: np.ndarray, normal: np.ndarray) -> None:
        """Take in the sums at ``next``; choose the point of the next scan."""
        value = loss / self.total + self.penalty(self.next)
        if value > self.value + 1e-12 * max(1.0, abs(self.value)) and self.share > 1e-6:
            self.share /= 2                                # overshot: half the step
            self.next = self.now + self.share * self.step
            return
        moved = np.abs(self.next - self.now).max() if self.step is not None else np.inf
        still = self.value - value <= 1e-14 * max(1.0, abs(value)) and moved <= 1e3 * TOL
        if moved <= TOL * max(1.0, np.abs(self.next).max()) or still:
            self.done = True
        self.now, self.value, self.share = self.next, value, 1.0
        self.step = self._newton(gradient / self.total, normal / self.total)
        self.next = self.now + self.step

    def _newton(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Minimiser of the quadratic model plus the penalty."""
        at = np.flatnonzero(self.active)
        l2, l1 = np.append(self.l2, 0.0)[at], np.append(self.l1, 0.0)[at]
        b, step = self.now[at], np.zeros(len(self.now))
        a = h[np.ix_(at, at)] + np.diag(l2) + 1e-14 * np.eye(len(at))
        r = g[at] + l2 * b
        if not l1.any():
            step[at] = -np.linalg.lstsq(a, r, rcond=None)[0]
            return step
        step[at] = _lasso_minimum(a, r - a @ b, l1, b) - b
        return step


def _lasso_minimum(a: np.ndarray, c: np.ndarray, l1: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Minimiser of u'au/2 + c'u + l1|u| from a start: sweeps over coordinates
    find the signs, and the linear system of the non-zero ones goes the rest."""
    u, slope = u.copy(), a @ u + c
    for _ in range(200):
        for _ in range(3):
            for j in np.flatnonzero(np.diag(a) > 0):
                x = u[j] - slope[j] / a[j, j]
                x = np.sign(x) * max(abs(x) - l1[j] / a[j, j], 0.0)
                if x != u[j]:
                    slope += a[:, j] * (x - u[j])
                    u[j] = x
        s, sign = np.flatnonzero((u != 0) | (l1 == 0)), np.sign(u)
        v = np.linalg.lstsq(a[np.ix_(s, s)], -(c[s] + l1[s] * sign[s]), rcond=None)[0]
        turned = (l1[s] > 0) & (np.sign(v) != sign[s])
        share = 1.0
        if turned.any():                                   # up to the first one that turns
            share = (u[s][turned] / (u[s][turned] - v[turned])).min()
        u[s] += share * (v - u[s])
        if turned.any():
            u[s[turned][np.argmin(np.abs(u[s[turned]]))]] = 0.0
        slope = a @ u + c
        excess = np.where(u != 0, np.abs(slope + l1 * np.sign(u)), np.maximum(np.abs(slope) - l1, 0.0))
        if excess.max(initial=0.0) <= 1e-13 * max(1.0, np.abs(c).max(initial=0.0)):
            break
    return u


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _rows(rb, mean, scale):
    x = (_matrix(rb.column("x")) - mean) * scale
    inside = np.array(_matrix(rb.column("inside")), bool)
    return np.hstack([x, np.ones((len(x), 1))]), rb.column("y").to_numpy(), inside


def _partial(sums: dict) -> pa.RecordBatch:
    slot = TaskContext.get().partitionId() % SLOTS
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([slot] * len(sums), pa.int32()),
                                       pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["model", "slot", "sums"])


def _add_up(batches):
    """Rows sorted by (model, slot) -> their sums, one row at a time."""
    key, total = None, None
    for rb in batches:
        for model, slot, raw in zip(*(rb.column(c) for c in ("model", "slot", "sums"))):
            now, v = (model.as_py(), slot.as_py()), np.frombuffer(raw.as_buffer(), "<f8")
            if now == key:
                total = total + v
                continue
            if key is not None:
                yield pa.RecordBatch.from_pydict({"model": pa.array([key[0]], pa.int32()), "slot": pa.array([key[1]], pa.int32()), "sums": [total.tobytes()]})
            key, total = now, v
    if key is not None:
        yield pa.RecordBatch.from_pydict({"model": pa.array([key[0]], pa.int32()), "slot": pa.array([key[1]], pa.int32()), "sums": [total.tobytes()]})


SUMS = "model int, slot int, sums binary"


def _summed(data: DataFrame, function) -> dict[int, np.ndarray]:
    """Sums by model over all tasks; at most models x ``SLOTS`` rows reach the
    driver."""
    parts = data.mapInArrow(function, SUMS)
    if data.rdd.getNumPartitions() > SLOTS:
        parts = parts.repartition("model", "slot").sortWithinPartitions("model", "slot").mapInArrow(_add_up, SUMS)
    out: dict[int, np.ndarray] = {}
    for r in sorted(parts.collect(), key=lambda r: (r["model"], r["slot"], bytes(r["sums"]))):   # in one order: same sums each time
        v = np.frombuffer(bytes(r["sums"]), "<f8")
        out[r["model"]] = out[r["model"]] + v if r["model"] in out else v
    return out


def _moment_pass(mean, scale, masks, weights):
    def run(batches):
        sums = {m: 0.0 for m in range(masks)}
        for rb in batches:
            if not rb.num_rows:
                continue
            x, y, inside = _rows(rb, mean, scale)
            for m in range(masks):
                w = weights[m][y.astype(int)] * inside[:, m]
                sums[m] = sums[m] + np.concatenate([[w.sum(), (w * w).sum()], w @ x[:, :-1], w @ x[:, :-1] ** 2])
        yield _partial({m: v for m, v in sums.items() if not np.isscalar(v)})
    return run


def _newton_pass(mean, scale, models):
    """``models``: {model: (mask, class weights, point)}."""
    def run(batches):
        sums: dict = {}
        for rb in batches:
            if not rb.num_rows:
                continue
            x, y, inside = _rows(rb, mean, scale)
            of_mask: dict = {}
            for name, (mask, weights, point) in models.items():
                of_mask.setdefault(mask, []).append((name, weights, point))
            for mask, some in of_mask.items():
                at = np.flatnonzero(inside[:, mask])
                if not len(at):
                    continue
                z, label = x[at], y[at]                    # once for all points of a mask
                for name, weights, point in some:
                    w, margin = weights[label.astype(int)], z @ point
                    p = 0.5 * (1 + np.tanh(margin / 2))
                    loss = (w * (np.logaddexp(0, margin) - label * margin)).sum()
                    half = z * np.sqrt(w * p * (1 - p))[:, None]
                    part = np.concatenate([[loss], (w * (p - label)) @ z, (half.T @ half).ravel()])   # a matrix by itself: half the work
                    sums[name] = sums[name] + part if name in sums else part
        yield _partial(sums)
    return run


def fit_logistic(data: DataFrame, masks: Sequence[Column], points: Sequence[Mapping[str, float]], label: str = "y",
                 features: str = "features", balanced: bool = True) -> dict[tuple[int, int], Linear]:
    """{(mask, point): model} for every mask (a condition that a training row
    meets) and every point (``regParam``, ``elasticNetParam``).  Rows without a
    label are left out.  ``data`` is read once a step: hand over a written
    table."""
    ship_package(data.sparkSession)
    base = data.where(F.col(label).isNotNull())
    rows = base.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"),
                       F.array(*[F.coalesce(m, F.lit(False)) for m in masks]).alias("inside"))
    scale = base.select(Summarizer.metrics("mean", "std").summary(F.col(features)).alias("s")).select("s.mean", "s.std").first()
    mean, std = scale["mean"].toArray(), scale["std"].toArray()
    inverse = np.divide(1.0, std, out=np.zeros(len(std)), where=std > 0)
    counts = rows.groupBy("y").agg(*[F.sum(F.col("inside")[m].cast("long")).alias(str(m)) for m in range(len(masks))]).collect()
    n = np.zeros((len(masks), 2))
    for r in counts:
        n[:, int(r["y"])] = [r[str(m)] for m in range(len(masks))]
    weights = np.ones((len(masks), 2))
    if balanced:
        weights = np.divide(n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True) * n, out=weights, where=n > 0)
    moments = _summed(rows, _moment_pass(mean, inverse, len(masks), weights))
    states: dict[tuple[int, int], _State] = {}
    d = len(mean)
    for m, v in moments.items():
        total, squares, first, second = v[0], v[1], v[2:2 + d], v[2 + d:]
        if total <= 0:
            continue
        free = total - squares / total                     # of an unbiased weighted variance
        spread = np.maximum(second - first ** 2 / total, 0.0) / free if free > 0 else np.zeros(d)
        deviation = np.where(spread > 1e-18, np.sqrt(spread), 0.0)
        for p, point in enumerate(points):
            states[m, p] = _State(m, float(point.get("regParam", 0.0)), float(point.get("elasticNetParam", 0.0)), deviation, weights[m], total)
    names = list(states)
    for _ in range(STEPS):
        left = {i: (states[k].mask, states[k].weights, states[k].next) for i, k in enumerate(names) if not states[k].done}
        if not left:
            break
        for i, v in _summed(rows, _newton_pass(mean, inverse, left)).items():
            states[names[i]].advance(v[0], v[1:d + 2], v[d + 2:].reshape(d + 1, d + 1))
    return {k: Linear(s.now[:-1] * inverse, float(s.now[-1] - (s.now[:-1] * inverse) @ mean)) for k, s in states.items()}


def score_many(data: DataFrame, models: Sequence[Linear], wanted: Column, keep: Sequence[str], features: str = "features",
               name: str = "score") -> DataFrame:
    """(keep..., model, score): the probability of class 1 under each model whose
    number is in the array ``wanted`` of the row, in one scan."""
    ship_package(data.sparkSession)
    weights = np.array([m.coefficients for m in models]).reshape(len(models), -1)
    free = np.array([m.intercept for m in models])

    def run(batches):
        for rb in batches:
            x = _matrix(rb.column("_x"))
            if not len(x):
                continue
            every = rb.column("_wanted")
            row = np.repeat(np.arange(len(x)), every.value_lengths().to_numpy(zero_copy_only=False))
            model = every.flatten().to_numpy(zero_copy_only=False)
            margin = x @ weights.T + free
            p = 0.5 * (1 + np.tanh(margin[row, model] / 2))
            yield pa.RecordBatch.from_arrays([*(rb.column(c).take(pa.array(row)) for c in keep), pa.array(model, pa.int32()), pa.array(p)],
                                             [*keep, "model", name])
    rows = data.select(*keep, vector_to_array(features).alias("_x"), wanted.cast("array<int>").alias("_wanted"))
    kinds = {f.name: f.dataType.simpleString() for f in data.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return rows.mapInArrow(run, f"{schema}, model int, `{name}` double")
