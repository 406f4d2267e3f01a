"""Contract and data-quality checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class QualityError(ValueError):
    """A table breaks its contract."""


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Schema check; runs no job."""
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        raise QualityError(f"columns declared but not present: {absent}")
    return df


def floating(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def quality_counts(df: DataFrame, columns: Sequence[str], y: str) -> DataFrame:
    """Rows, rows without outcome, and infinite values over ``columns``, in one pass."""
    infinite = sum(
        (F.count_if(F.abs(F.col(c).cast("double")) == float("inf")) for c in columns), F.lit(0)
    )
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(y).isNull() | F.isnan(F.col(y).cast("double"))).alias("without_outcome"),
        infinite.cast("bigint").alias("infinite_values"),
    )


def require_finite(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns if columns is not None else floating(df))
    if not columns:
        return df
    bad = df.agg(*[F.max(F.abs(F.col(c).cast("double")) == float("inf")).alias(c) for c in columns])
    found = [c for c, v in bad.first().asDict().items() if v]
    if found:
        raise QualityError(f"infinite values in {found}")
    return df


def require_outcomes(df: DataFrame, y: str) -> DataFrame:
    missing = df.agg(F.count_if(F.col(y).isNull() | F.isnan(F.col(y).cast("double")))).first()[0]
    if missing:
        raise QualityError(f"{missing} rows have no observed outcome in {y}")
    return df


def missing_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of missing values per feature, NaN included, positive only, highest first."""
    numbers = set(floating(df))
    lost = {c: F.col(c).isNull() | F.isnan(c) if c in numbers else F.col(c).isNull() for c in columns}
    wide = df.agg(*[F.avg(gone.cast("double")).alias(c) for c, gone in lost.items()])
    long = wide.unpivot([], list(columns), "feature", "missing_rate")
    return long.where("missing_rate > 0").orderBy(F.desc("missing_rate"), "feature")


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Raise if any key occurs twice (hot keys collapse before the shuffle)."""
    twice = df.groupBy(key).count().where("count > 1").limit(1).collect()
    if twice:
        raise QualityError(f"{key} is not unique, e.g. {twice[0][0]!r}")
    return df


def join_one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on a key that has to be unique on both sides, in one shuffle.

    Both sides are tagged, put together and folded by key: the fold joins and counts at once. A key that occurs twice on a
    side ends the query that runs the join with an error; rows of such a key collapse before they move.
    """

    def tagged(df: DataFrame, name: str) -> DataFrame:
        own = [F.col(c) for c in df.columns if c != key]
        return df.select(F.col(key).alias("_key"), F.struct(F.lit(1).alias("_there"), *own).alias(name))

    both = tagged(left, "_left").unionByName(tagged(right, "_right"), allowMissingColumns=True)
    sides = both.groupBy("_key").agg(
        F.first("_left", ignorenulls=True).alias("_left"), F.count("_left").alias("_left_n"),
        F.first("_right", ignorenulls=True).alias("_right"), F.count("_right").alias("_right_n"),
    )
    again = (F.col("_left_n") > 1) | (F.col("_right_n") > 1)
    error = F.raise_error(F.concat(F.lit(f"{key} is not unique, e.g. "), F.coalesce(F.col("_key").cast("string"), F.lit("null"))))
    both_there = (F.col("_left_n") == 1) & (F.col("_right_n") == 1) & F.col("_key").isNotNull()
    values = [F.col(side)[c].alias(c) for side, df in (("_left", left), ("_right", right)) for c in df.columns if c != key]
    return sides.where(F.when(again, error.cast("boolean")).otherwise(both_there)).select(F.col("_key").alias(key), *values)


def attach_oracle(df: DataFrame, oracle: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Counterfactual columns beside the book; every book row stays."""
    return df.join(oracle.select(key, *columns), key, "left")
