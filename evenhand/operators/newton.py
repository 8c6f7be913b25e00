"""Weighted logistic regression by Newton steps: each step is one aggregation of the rows.

A step needs the loss, its gradient and its curvature, which are sums over rows. It can start from the coefficients of a
similar problem, and then two or three steps do, where a fit from nothing takes about ten.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
MAX_STEPS = 60
HALVINGS = 30
#: Partial sums of up to this many tasks are added on the driver; those of more tasks are added by Spark first.
FEW_TASKS = 256


def _sums(df: DataFrame, names: list[str], point: np.ndarray, tasks: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature at ``point`` (coefficients, then intercept), summed over rows (features, __y, __w).

    Coefficients change with every step. As literals they would have every step compiled anew, so tasks add up their batches
    with matrix products.
    """
    k = len(point)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, slope, curve = 0.0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            x = np.column_stack([*[batch[c].to_numpy(zero_copy_only=False) for c in names], np.ones(batch.num_rows)])
            y, w = (batch[c].to_numpy(zero_copy_only=False) for c in ("__y", "__w"))
            z = x @ point
            p = 0.5 * (1.0 + np.tanh(0.5 * z))
            loss += float((w * (np.logaddexp(0.0, z) - y * z)).sum())
            slope += x.T @ (w * (p - y))
            curve += (x.T * (w * p * (1.0 - p))) @ x
        yield pa.record_batch({"sums": pa.array([[loss, *slope, *curve.ravel()]], pa.list_(pa.float64()))})

    parts = df.mapInArrow(partial, "sums array<double>")
    if tasks > FEW_TASKS:
        added = parts.select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
        values = np.array([r["v"] for r in sorted(added, key=lambda r: r["i"])])
    else:
        values = np.sum([r["sums"] for r in parts.collect()], axis=0)
    return float(values[0]), values[1 : k + 1], values[k + 1 :].reshape(k, k)


class Fit(NamedTuple):
    """Coefficients, and whether no part of the gradient of the penalised loss exceeds the tolerance; ``gradient`` is its largest part."""

    intercept: float
    coefficients: tuple[float, ...]
    converged: bool
    gradient: float


def penalised_gradient(df: DataFrame, names: list[str], label: Column, weight: Column, total: float, penalty: float, point: np.ndarray) -> float:
    """Largest part of the gradient of mean loss plus ``penalty / 2`` times the squared coefficients at ``point``: one aggregation."""
    rows = df.select(*names, label.cast("double").alias("__y"), weight.cast("double").alias("__w"))
    slope = _sums(rows, names, point, rows.rdd.getNumPartitions())[1] / total
    slope[:-1] += penalty * point[:-1]
    return float(np.abs(slope).max())


def fit_newton(
    df: DataFrame,
    names: list[str],
    label: Column,
    weight: Column,
    total: float,
    penalty: float,
    start: np.ndarray | None = None,
    tol: float = 1e-6,
) -> Fit:
    """The least of mean loss plus ``penalty / 2`` times the squared coefficients; the intercept is not penalised.

    ``df`` should be persisted: each step reads it once. A step that would raise the loss is halved. The fit has converged when no part
    of the gradient exceeds ``tol``.
    """
    rows = df.select(*names, label.cast("double").alias("__y"), weight.cast("double").alias("__w"))
    tasks = rows.rdd.getNumPartitions()
    k = len(names) + 1
    ridge = np.full(k, penalty)
    ridge[-1] = 0.0
    point = np.zeros(k) if start is None else np.array(start, float)

    def at(where: np.ndarray):
        loss, slope, curve = _sums(rows, names, where, tasks)
        return loss / total + 0.5 * (ridge * where**2).sum(), slope / total + ridge * where, curve / total + np.diag(ridge)

    loss, slope, curve = at(point)
    converged = False
    for _ in range(MAX_STEPS):
        converged = bool(np.abs(slope).max() <= tol)
        if converged:
            break
        # a flat direction has nothing to gain
        move = np.linalg.lstsq(curve + np.eye(k) * 1e-12, slope, rcond=1e-14)[0]
        for _ in range(HALVINGS):
            after = at(point - move)
            if after[0] <= loss + 1e-12:
                break
            move = move / 2
        else:
            break
        point = point - move
        loss, slope, curve = after
    converged = converged or bool(np.abs(slope).max() <= tol)
    if not converged:
        log.warning("the gradient is still %.2g", float(np.abs(slope).max()))
    return Fit(float(point[-1]), tuple(float(w) for w in point[:-1]), converged, float(np.abs(slope).max()))
