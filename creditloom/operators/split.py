"""Time split of the book and summaries per split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import contract
from creditloom.config import OOT_START_MONTH, SEED, VALIDATION_FRACTION


def held_out(key: str, fraction: float, seed: int) -> Column:
    """Seeded membership test on the key: the same row falls the same way in every plan and engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % 10_000 < int(round(fraction * 10_000))


def time_split(
    df: DataFrame,
    *,
    oot_start_month: int = OOT_START_MONTH,
    validation_fraction: float = VALIDATION_FRACTION,
    approved_only: bool = True,
    seed: int = SEED,
    key: str = contract.ID,
    month: str = contract.MONTH,
    valid_when: Column | None = None,
) -> DataFrame:
    """Add ``split``: out of time by month, validation and train within the earlier window.

    ``valid_when`` replaces the seeded sample, e.g. by a date rule. One narrow projection.
    """
    book = df.where(F.col(contract.APPROVED) == 1) if approved_only else df
    valid = held_out(key, validation_fraction, seed) if valid_when is None else valid_when
    split = (
        F.when(F.col(month) >= oot_start_month, "oot").when(valid, "valid").otherwise("train")
    )
    return book.withColumn("split", split)


def describe_splits(
    df: DataFrame, *, y: str = contract.TARGET, date: str = contract.DATE, split: str = "split"
) -> DataFrame:
    """Rows, rows with outcome, bad rate and date range of each split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(y).alias("with_outcome"),
        F.avg(y).alias("bad_rate"),
        F.to_date(F.min(date)).alias("date_from"),
        F.to_date(F.max(date)).alias("date_to"),
    )


def book_summary(
    df: DataFrame,
    *,
    outcome: str,
    thin_file: Column,
    oot_start_month: int = OOT_START_MONTH,
    approved: str = contract.APPROVED,
    month: str = contract.MONTH,
) -> DataFrame:
    """Approval rate, bad rates by decision, thin-file and out-of-time shares, in one pass.

    ``outcome`` is the counterfactual outcome, known for every row.
    """
    yes = F.col(approved) == 1
    share = lambda c: F.avg(c.cast("double"))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        share(yes).alias("approval_rate"),
        F.avg(F.when(yes, F.col(outcome))).alias("bad_rate_approved"),
        F.avg(F.when(~yes, F.col(outcome))).alias("bad_rate_rejected"),
        F.avg(outcome).alias("bad_rate_all"),
        share(thin_file).alias("thin_file_share"),
        share(F.col(month) >= oot_start_month).alias("oot_share"),
        F.count_if(F.col(month) >= oot_start_month).alias("oot_rows"),
    )
