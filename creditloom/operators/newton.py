"""Logistic regression by Newton steps: one pass over the rows per step."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators.quality import QualityError


@dataclass
class Totals:
    """Sums over all rows at given coefficients; the constant column is the last."""

    loss: float
    gradient: np.ndarray
    table: np.ndarray
    size: float


@dataclass
class Fit:
    coefficients: np.ndarray
    intercept: float
    information: np.ndarray
    passes: int


def totals(df: DataFrame, x: str, y: str, beta: np.ndarray, places: Sequence[int] | None = None, weight: str | None = None) -> Totals:
    """Loss, gradient and curvature of the likelihood, from one pass.

    ``x``: an array column, of which ``places`` are used; the coefficients of ``beta`` end with the intercept. Each task
    adds its rows up to one square table, and those add up by cell. Rows without an outcome are an error.
    """
    beta, k = np.asarray(beta, float), len(beta)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k + 1, k + 1))
        size, lost = 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            design = np.column_stack([rows if places is None else rows[:, list(places)], np.ones(len(rows))])
            outcome, w = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (1, 2))
            lost += int(np.isnan(outcome).sum())
            z = design @ beta
            tail = np.exp(-np.abs(z))
            p = np.where(z >= 0, 1.0, tail) / (1.0 + tail)
            sums[:k, :k] += design.T @ (design * (w * p * (1.0 - p))[:, None])
            sums[k, :k] += design.T @ (w * (p - outcome))
            sums[k, k] += float((w * (np.log1p(tail) + np.maximum(z, 0.0) - outcome * z)).sum())
            size += float(w.sum())
        i, j = np.indices(sums.shape)
        i, j, value = (np.append(a.ravel(), b) for a, b in ((i, [-1, -2]), (j, [-1, -2]), (sums, [size, lost])))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(value)], ["i", "j", "value"])

    rows = df.select(F.col(x).alias("x"), F.col(y).cast("double").alias("y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("w"))
    parts = rows.mapInArrow(add_up, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    sums, rest = np.zeros((k + 1, k + 1)), {-1: 0.0, -2: 0.0}
    for i, j, value in parts.collect():
        if i < 0:
            rest[i] = value
        else:
            sums[i, j] = value
    if rest[-2]:
        raise QualityError(f"{int(rest[-2])} rows have no observed outcome in {y}")
    return Totals(sums[k, k], sums[k, :k], sums[:k, :k], rest[-1])


def step_from(at: Totals, beta: np.ndarray, penalty: float) -> np.ndarray:
    """The Newton step; the penalty holds for all but the intercept."""
    held = np.append(np.full(len(beta) - 1, penalty), 0.0)
    return np.linalg.lstsq(at.table + np.diag(held), -(at.gradient + held * beta), rcond=1e-14)[0]


def newton(
    df: DataFrame, x: str, y: str, *, weight: str | None = None, penalty: float = 0.0, places: Sequence[int] | None = None,
    start: np.ndarray | None = None, size: int | None = None, tolerance: float = 1e-9, most: int = 100,
) -> Fit:
    """Coefficients that minimise the loss plus ``penalty`` / 2 times their squares.

    ``start`` (with the intercept last) saves passes; else ``size`` coefficients start at 0. A step that makes things worse is halved.
    """
    beta = np.zeros((len(places) if places is not None else size) + 1) if start is None else np.asarray(start, float)

    def worth(at: Totals, b: np.ndarray) -> float:
        return at.loss + penalty / 2 * float((b[:-1] ** 2).sum())

    at, passes = totals(df, x, y, beta, places, weight), 1
    while passes < most:
        step = step_from(at, beta, penalty)
        if np.abs(step).max() <= tolerance * (1.0 + np.abs(beta).max()):
            beta = beta + step
            break
        tried = totals(df, x, y, beta + step, places, weight)
        passes += 1
        while worth(tried, beta + step) > worth(at, beta) * (1 + 1e-12) and passes < most:
            step = step / 2
            tried = totals(df, x, y, beta + step, places, weight)
            passes += 1
        beta, at = beta + step, tried
    return Fit(beta[:-1], float(beta[-1]), at.table, passes)
