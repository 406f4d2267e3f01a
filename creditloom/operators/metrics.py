"""Discrimination, rank ordering and calibration, for every split in one job.

Rows whose score or outcome is missing (null or NaN) take no part in any measure; ``n`` counts
the rows that do. A null group is a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.expr import present
from creditloom.functions.ordering import band_limits, group_sizes, one_task_rows, running_totals, with_band, with_bucket

EPS = 1e-10
BANDS = 10


def _floor(x: Column) -> Column:
    return F.greatest(x.cast("double"), F.lit(EPS))


def score_cells(df: DataFrame, score: str, y: str, by: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Rows collapsed to (group, score) with counts of goods and bads.

    Equal scores fold on the map side; nothing after this sees a row again.
    """
    placed = with_bucket(df.select(*by, score, y).where(present(score, y)), score, rows)
    cells = placed.groupBy(*by, "_bucket", score).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).cast("double").alias("bads")
    )
    return cells.withColumn("goods", F.col("n") - F.col("bads"))


def discrimination(df: DataFrame, score: str, y: str, by: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """AUC (ties count half), Gini and KS per group; a higher score means riskier."""
    cells = score_cells(df, score, y, by, rows)
    placed = running_totals(cells, by, score, ["bads", "goods"])
    pairs = F.col("bads") * (F.col("goods_before") + F.col("goods") / 2.0)
    gap = F.abs(
        (F.col("bads_before") + F.col("bads")) / _floor(F.col("bads_total"))
        - (F.col("goods_before") + F.col("goods")) / _floor(F.col("goods_total"))
    )
    grouped = placed.groupBy(*by).agg(
        F.sum(pairs).alias("_pairs"),
        F.max(gap).alias("ks"),
        F.sum("n").alias("n"),
        F.sum("bads").alias("_bads"),
        F.sum("goods").alias("_goods"),
    )
    auc = F.try_divide(F.col("_pairs"), F.col("_bads") * F.col("_goods"))
    return grouped.select(
        *by,
        auc.alias("auc"),
        (2.0 * auc - 1.0).alias("gini"),
        "ks",
        "n",
        F.try_divide("_bads", "n").alias("bad_rate"),
    )


def rank_ordering(
    df: DataFrame,
    score: str,
    y: str,
    tie: str,
    *,
    bands: int = BANDS,
    by: str | None = None,
    ascending: bool = False,
    totals: dict | None = None,
    limits: dict | None = None,
) -> DataFrame:
    """Equal-frequency bands in score order, riskiest first unless ``ascending``."""
    key = F.col(score) if ascending else -F.col(score)
    rows = df.select(*([by] if by else []), tie, score, y, key.alias("_key"))
    rows = rows.where(present(score, y))
    banded = with_band(rows, "_key", tie, bands, by, totals=totals, limits=limits)
    groups = [by] if by else []
    table = banded.groupBy(*groups, "band").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(y).cast("double").alias("bads"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
    # windows below run over the bands of a group
    group = Window.partitionBy(*(groups or [F.lit(0)]))
    upto = group.orderBy("band")
    all_bads = _floor(F.sum("bads").over(group))
    everyone = _floor(F.sum("count").over(group))
    rate = F.col("bads") / F.col("count")
    return table.select(
        *groups,
        "band",
        "count",
        "bads",
        "min_score",
        "max_score",
        (F.col("count") - F.col("bads")).alias("goods"),
        rate.alias("bad_rate"),
        (F.sum("bads").over(upto) / all_bads).alias("cum_bad_capture"),
        (F.sum("count").over(upto) / everyone).alias("cum_population"),
        (rate / (all_bads / everyone)).alias("lift"),
    )


def is_rank_ordered(table: DataFrame, by: str | None = None, tolerance: float = 0.0) -> DataFrame:
    """Does the bad rate never rise from one band to the next?"""
    groups = [by] if by else []
    order = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("band")
    rise = F.col("bad_rate") - F.lag("bad_rate").over(order)
    return (
        table.select(*groups, F.coalesce(rise <= tolerance, F.lit(True)).alias("_ok"))
        .groupBy(*groups)
        .agg(F.bool_and("_ok").alias("rank_ordered"))
    )


def _clipped(p: str) -> Column:
    return F.least(F.greatest(F.col(p), F.lit(EPS)), F.lit(1.0 - EPS))


def calibration(
    df: DataFrame, p: str, y: str, tie: str, *, bins: int = BANDS, by: str | None = None, totals: dict | None = None,
    limits: dict | None = None,
) -> DataFrame:
    """Brier score, log loss, expected and observed bad rate, their ratio, and the ECE."""
    groups = [by] if by else []
    seen = df.where(present(p, y))
    rows = seen.select(*groups, tie, F.col(y).alias("_y"), _clipped(p).alias("_p"))
    banded = with_band(rows, "_p", tie, bins, by, totals=totals, limits=limits)
    good = 1.0 - F.col("_y")
    loss = -(F.col("_y") * F.ln("_p") + good * F.ln(1.0 - F.col("_p")))
    per_bin = banded.groupBy(*groups, "band").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("_y").alias("y"),
        F.sum("_p").alias("p"),
        F.sum(F.pow(F.col("_y") - F.col("_p"), 2)).alias("sq"),
        F.sum(loss).alias("loss"),
    )
    total = F.sum("n")
    return per_bin.groupBy(*groups).agg(
        (F.sum("sq") / total).alias("brier"),
        (F.sum("loss") / total).alias("log_loss"),
        (F.sum("p") / total).alias("expected_bad_rate"),
        (F.sum("y") / total).alias("observed_bad_rate"),
        (F.sum("p") / total / _floor(F.sum("y") / total)).alias("calibration_ratio"),
        (F.sum(F.abs(F.col("y") - F.col("p"))) / total).alias("expected_calibration_error"),
    )


def calibration_table(
    df: DataFrame, p: str, y: str, tie: str, *, bins: int = BANDS, by: str | None = None
) -> DataFrame:
    """Mean prediction against observed rate per equal-frequency bin (not clipped)."""
    groups = [by] if by else []
    rows = df.select(*groups, tie, p, y).where(present(p, y))
    banded = with_band(rows, p, tie, bins, by, name="bin")
    return (
        banded.groupBy(*groups, "bin")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg(p).alias("predicted"),
            F.avg(y).alias("observed"),
        )
        .withColumn("gap", F.col("observed") - F.col("predicted"))
    )


def evaluate(
    df: DataFrame, p: str, y: str, tie: str, *, bands: int = BANDS, by: str = "split"
) -> DataFrame:
    """One row per split: discrimination, calibration and rank ordering together.

    Pass a staged frame; the three parts each read their few columns of it. Rows are counted once, for all three, and of
    many rows the ends of both kinds of bands are found in the same passes.
    """
    totals = {g: n for g, n in group_sizes(df, [p, y], by).items() if n}
    limits: dict = {}
    if sum(totals.values()) > one_task_rows(df.sparkSession):
        keys = df.where(present(p, y)).select(by, tie, _clipped(p).alias("_p"), (-F.col(p)).alias("_key"))
        limits = band_limits(keys, ["_p", "_key"], tie, bands, totals, by)
    power = discrimination(df, p, y, [by], sum(totals.values()))
    fit = calibration(df, p, y, tie, bins=bands, by=by, totals=totals, limits=limits.get("_p"))
    table = rank_ordering(df, p, y, tie, bands=bands, by=by, totals=totals, limits=limits.get("_key"))
    ordered = is_rank_ordered(table, by)
    for part in (fit, ordered):
        other = part.withColumnRenamed(by, "_by")
        power = power.join(other, power[by].eqNullSafe(other["_by"])).drop("_by")
    return power
