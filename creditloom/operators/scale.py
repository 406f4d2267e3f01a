"""Probability to score and back, policy bands, unit economics, and the rule policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.config import APPROVAL_RATE, BANDS, SCALE, Scale
from creditloom.functions.expr import log_odds, sigmoid
from creditloom.functions.ordering import quantiles

FLOOR = 1e-9


def probability_to_score(p: Column, scale: Scale = SCALE) -> Column:
    raw = F.lit(scale.offset) - F.lit(scale.factor) * log_odds(p, FLOOR)
    bounded = F.least(F.greatest(F.rint(raw), F.lit(float(scale.low))), F.lit(float(scale.high)))
    return F.when(p.isNotNull(), bounded).cast("int")


def score_to_probability(score: Column, scale: Scale = SCALE) -> Column:
    return sigmoid((F.lit(scale.offset) - score) / F.lit(scale.factor))


def band_table(spark: SparkSession, scale: Scale = SCALE) -> DataFrame:
    """The five policy bands with the probability at each band's midpoint."""
    bands = spark.createDataFrame(list(BANDS), "band string, min_score int, max_score int")
    middle = (F.col("min_score") + F.col("max_score")) / 2.0
    return bands.withColumn("indicative_pd", F.round(score_to_probability(middle, scale), 4))


def rule_score(
    tenure: Column,
    inflow: Column,
    ontime: Column,
    worst_dpd: Column,
    betting: Column,
    zero_days: Column,
    salary: Column,
    lenders: Column,
) -> Column:
    """Hand-weighted eligibility rules; a missing value takes its rule's default."""

    def point(weight: float, met: Column) -> Column:
        return F.when(met, weight).otherwise(0.0)

    # fixed values: weights, cut points and defaults
    return (
        point(1.10, tenure > 180)
        + point(0.95, inflow > 15_000)
        + 1.10 * F.coalesce(ontime, F.lit(0.35))
        - point(1.30, F.coalesce(worst_dpd, F.lit(0.0)) > 30)
        - point(0.75, betting > 12)
        - point(0.85, zero_days > 12)
        + 0.60 * salary
        - point(0.55, lenders >= 3)
    )


def approve_top(df: DataFrame, score: str, rate: float = APPROVAL_RATE) -> DataFrame:
    """Add ``cutoff`` and ``approved``: the given share of rows with the highest scores."""
    cutoff = quantiles(df, [score], [1 - rate])[score][0]
    return df.withColumn("cutoff", F.lit(cutoff)).withColumn(
        "approved", F.when(F.col(score) >= F.lit(cutoff), 1).otherwise(0)
    )
