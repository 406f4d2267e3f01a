"""Isotonic calibration: the best non-decreasing step function of a score, by pooling adjacent violators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.expr import present, with_bins
from creditloom.functions.ordering import bucket_count, splitters
from creditloom.operators.quality import require_outcomes
from creditloom.sources.staging import stage

#: Neighbouring groups that are pooled together in a round.
FAN_IN = 16
_BLOCKS = "g long, low double, high double, n double, bads double"


def pooled(blocks: Iterator[tuple], stack: list[list] | None = None) -> list[list]:
    """Blocks (low, high, n, bads) in score order, joined until rates rise strictly."""
    stack = [] if stack is None else stack
    for low, high, n, bads in blocks:
        stack.append([low, high, n, bads])
        while len(stack) > 1 and stack[-2][3] * stack[-1][2] >= stack[-1][3] * stack[-2][2]:
            low_, high_, n_, bads_ = stack.pop()
            stack[-1][1:] = [high_, stack[-1][2] + n_, stack[-1][3] + bads_]
    return stack


def _pool(blocks: DataFrame) -> DataFrame:
    """Pool the blocks of every group ``g``; groups stream, a task holds the pooled blocks of one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, stack = None, []

        def out() -> pd.DataFrame:
            return pd.DataFrame([(here, *b) for b in stack], columns=["g", "low", "high", "n", "bads"])

        for batch in batches:
            g = batch["g"].to_numpy()
            turns = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else []
            for a, b in zip(turns, [*turns[1:], len(g)]):
                if g[a] != here:
                    if stack:
                        yield out()
                    here, stack = g[a], []
                pooled(batch[["low", "high", "n", "bads"]].iloc[a:b].itertuples(index=False), stack)
        if stack:
            yield out()

    return blocks.repartition("g").sortWithinPartitions("g", "low").mapInPandas(run, _BLOCKS)


def isotonic_steps(df: DataFrame, p: str, y: str) -> DataFrame:
    """step, low, high, n, bads, rate: scores ``low`` to ``high`` share a rate, and rates rise from step to step.

    Rows collapse to scores, scores are cut into buckets, and violators are pooled inside buckets first. Then
    the blocks of neighbouring buckets meet, ``FAN_IN`` groups at a time: pooling a part first never
    changes the whole, and what is left is about the cube root of the rows. Rows without a score take no part.
    """
    rows = require_outcomes(df.where(present(p)), y)
    cells = rows.groupBy(F.col(p).cast("double").alias("s")).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(y).cast("double").alias("bads"))
    groups = bucket_count(df.sparkSession)
    cuts = splitters(cells, ["s"], groups)
    placed = with_bins(cells, cuts)
    blocks = placed.select(F.col("_bin_s").cast("long").alias("g"), F.col("s").alias("low"), F.col("s").alias("high"), "n", "bads")
    groups = len(cuts["s"]) + 1
    blocks = stage(_pool(blocks), "pooled")
    while groups > 1:
        groups = -(-groups // FAN_IN)
        blocks = stage(_pool(blocks.withColumn("g", F.expr(f"g div {FAN_IN}"))), "pooled")
    number = F.row_number().over(Window.orderBy("low")) - 1  # one row per step
    return blocks.select(
        number.alias("step"), "low", "high", F.col("n").cast("long").alias("n"), F.col("bads").cast("long").alias("bads"), (F.col("bads") / F.col("n")).alias("rate")
    )


def calibrated(df: DataFrame, p: str, steps: list[tuple[float, float]], name: str = "calibrated") -> DataFrame:
    """``df`` with the rate of the step that a score falls on; ``steps``: (high, rate), ascending.

    Between two steps the upper one holds, above the last the last. A missing score stays missing.
    """
    edges = [high for high, _ in steps[:-1]]
    rates: Column = F.array(*[F.lit(float(rate)) for _, rate in steps])
    return with_bins(df, {p: edges}).withColumn(name, F.get(rates, F.col(f"_bin_{p}"))).drop(f"_bin_{p}")
