"""Readers and writers for the book, the modelling views, metrics and fitted artefacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import contract
from creditloom.functions.expr import normalise_missing
from creditloom.sources.staging import stage


def read_applications(spark: SparkSession, path: str) -> DataFrame:
    """The through-the-door book; Spark raises PATH_NOT_FOUND if it is absent."""
    return normalise_missing(spark.read.schema(contract.APPLICATION_SCHEMA).parquet(path))


def read_oracle(spark: SparkSession, path: str) -> DataFrame:
    """Counterfactual outcomes: for evaluation jobs only, never for a fit."""
    return spark.read.schema(contract.ORACLE_SCHEMA).parquet(path)


def write_book(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_view(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    """A modelling view, one directory per split so that readers prune by path."""
    df.write.mode(mode).partitionBy(split).parquet(path)


def read_view(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A modelling view, or one split of it (a partition filter, not a scan)."""
    view = spark.read.parquet(path)
    return view if split is None else view.where(F.col("split") == split)


#: Levels of a column that a plan carries as a set; columns with more are joined.
LISTED_LEVELS = 1000


def align_levels(
    df: DataFrame, columns: Sequence[str], split: str = "split", train: str = "train"
) -> DataFrame:
    """Levels the train split never showed become null in every split.

    One pass finds the train levels of all columns, folded on the map side. A column of few levels then needs neither
    join nor shuffle of rows; one of many is joined to its level table.
    """
    shown = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns])
    levels = stage(df.where(F.col(split) == train).select(F.inline(shown)).where("level IS NOT NULL").distinct(), "levels")
    sizes = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    listed: dict[str, list[str]] = {c: [] for c in columns if sizes.get(c, 0) <= LISTED_LEVELS}
    for r in levels.where(F.col("column").isin(list(listed))).collect():  # at most LISTED_LEVELS a column
        listed[r["column"]].append(r["level"])
    out = df.withColumns({c: F.when(F.col(c).cast("string").isin(known), F.col(c)) for c, known in listed.items()})
    for c in columns:
        if c not in listed:
            own = levels.where(F.col("column") == c).select(F.col("level").alias("_level"))
            out = out.join(own, out[c].cast("string") == F.col("_level"), "left")
            out = out.withColumn(c, F.when(F.col("_level").isNotNull(), F.col(c))).drop("_level")
    return out.select(*df.columns)


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A metric record, or an empty frame of the same schema where none was written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def nested_bins(bins: DataFrame) -> DataFrame:
    """One row per feature with its bins as an ordered array, and the same as JSON text."""
    row = F.struct(
        "bin_index", "label", "lower", "upper", "is_missing", "count", "bads", "event_rate", "woe", "iv"
    )
    nested = bins.groupBy("feature", "kind").agg(
        F.sum("iv").alias("iv"), F.array_sort(F.collect_list(row)).alias("bins")
    )
    return nested.withColumn("json", F.to_json(F.struct("feature", "kind", "iv", "bins")))
