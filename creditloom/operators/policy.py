"""Cut-off economics, fairness, reject inference, recalibration and reason codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.config import (
    DISPARATE_IMPACT_FLOOR,
    ECONOMICS,
    EQUAL_OPPORTUNITY_TOLERANCE,
    Economics,
)
from creditloom.functions.expr import log_odds, sigmoid
from creditloom.operators.newton import newton
from creditloom.operators.quality import require_outcomes
from creditloom.operators.woe import Binning


def profit_curve(df: DataFrame, score: str, y: str, economics: Economics = ECONOMICS) -> DataFrame:
    """Goods, bads and profit if everyone at or above a score is approved.

    Integer scores collapse to at most one row per score point before the ordered window.
    """
    cells = df.groupBy(score).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).cast("bigint").alias("bads")
    )
    best_first = Window.partitionBy(F.lit(0)).orderBy(F.desc(score))
    bads = F.sum("bads").over(best_first)
    goods = F.sum(F.col("n") - F.col("bads")).over(best_first)
    everyone = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return cells.select(
        F.col(score).alias("cutoff"),
        goods.alias("goods"),
        bads.alias("bads"),
        ((goods + bads) / everyone).alias("approval_rate"),
        (goods * economics.revenue_per_good - bads * economics.loss_per_bad).alias("profit"),
    )


def best_cutoff(curve: DataFrame) -> DataFrame:
    """The row of the curve with the largest profit; of equal ones the highest cut-off."""
    best = F.max_by(F.struct("*"), F.struct("profit", "cutoff"))
    return curve.agg(best.alias("best")).select("best.*")


def fairness(
    df: DataFrame, attributes: Sequence[str], approved: str, good: Column
) -> DataFrame:
    """Approval rates per protected group against the best group of the attribute."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("level"))
            for a in attributes
        ]
    )
    rows = df.select(F.col(approved).alias("_a"), good.alias("_good"), F.inline(cells))
    rates = rows.groupBy("attribute", "level").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_a").alias("approval_rate"),
        F.avg(F.when(F.col("_good"), F.col("_a"))).alias("good_approval_rate"),
    )
    peers = Window.partitionBy("attribute")
    impact = F.try_divide(F.col("approval_rate"), F.max("approval_rate").over(peers))
    gap = F.max("good_approval_rate").over(peers) - F.col("good_approval_rate")
    return rates.select(
        "*",
        impact.alias("disparate_impact"),
        (impact >= DISPARATE_IMPACT_FLOOR).alias("impact_ok"),
        gap.alias("opportunity_gap"),
        (gap <= EQUAL_OPPORTUNITY_TOLERANCE).alias("opportunity_ok"),
    )


def fuzzy_augment(df: DataFrame, p: str, approved: str, y: str) -> DataFrame:
    """Rejects enter twice, as bad with weight p and as good with weight 1 - p."""
    bad = F.col(p)
    copies = F.when(
        F.col(approved) == 1,
        F.array(F.struct(F.col(y).cast("double").alias("_y"), F.lit(1.0).alias("_w"))),
    ).otherwise(
        F.array(
            F.struct(F.lit(1.0).alias("_y"), bad.alias("_w")),
            F.struct(F.lit(0.0).alias("_y"), (1.0 - bad).alias("_w")),
        )
    )
    wide = df.withColumn("_copies", copies).drop(y)
    return wide.select("*", F.inline("_copies").alias(y, "weight")).drop("_copies")


def reject_inference(
    df: DataFrame, features: Sequence[str], p: str, approved: str, y: str
) -> tuple[dict[str, float], float]:
    """Refit on the augmented book; returns coefficients and intercept. Approved rows need an outcome."""
    require_outcomes(df.where(F.col(approved) == 1), y)
    book = fuzzy_augment(df, p, approved, y)
    rows = book.select(F.array(*[F.col(f).cast("double") for f in features]).alias("_x"), y, "weight")
    fit = newton(rows, "_x", y, weight="weight", size=len(features))
    return dict(zip(features, fit.coefficients.tolist(), strict=True)), fit.intercept


def recalibrate(df: DataFrame, p: str, y: str) -> tuple[float, float]:
    """Platt scaling: slope and intercept on the log-odds, fitted on a validation split, from the identity on."""
    rows = df.select(F.array(log_odds(F.col(p), 1e-10)).alias("_z"), F.col(y).alias("_y"))
    fit = newton(rows, "_z", "_y", start=[1.0, 0.0])
    return float(fit.coefficients[0]), fit.intercept


def apply_recalibration(p: Column, slope: float, intercept: float) -> Column:
    return sigmoid(F.lit(slope) * log_odds(p, 1e-10) + F.lit(intercept))


def reason_codes(
    df: DataFrame, binning: Binning, coefficients: Mapping[str, float], factor: float, top: int = 3
) -> Column:
    """The features that cost a row the most points against their best bin, worst first."""
    losses = []
    for f, coef in coefficients.items():
        best = max(-coef * b["woe"] for b in binning.of(f))
        lost = F.lit(factor) * (F.lit(best) + F.lit(coef) * F.col(f"woe_{f}"))
        losses.append(F.struct((-lost).alias("key"), F.lit(f).alias("feature")))
    ranked = F.slice(F.array_sort(F.array(*losses)), 1, top)
    return F.transform(ranked, lambda r: r["feature"])
