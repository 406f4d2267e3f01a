"""Build the modelling views: derive, split, fit bins on train, write raw and weighted views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import contract
from creditloom.functions.expr import short_methods
from creditloom.operators.derive import add_derived
from creditloom.operators.quality import require_columns, require_finite
from creditloom.operators.split import time_split
from creditloom.operators.woe import Binning, fit_bins
from creditloom.sources.io import write_view


def build_matrices(book: DataFrame) -> tuple[DataFrame, Binning]:
    """The split book with derived features, and bins fitted on its train rows only."""
    require_columns(book, contract.RAW)
    split = time_split(add_derived(book))
    train = split.where(F.col("split") == "train")
    binning = fit_bins(
        train,
        contract.TARGET,
        numeric=contract.NUMERIC,
        categorical=contract.CATEGORICAL,
        priors=contract.PRIORS,
    )
    return split, binning


def build_features(spark: SparkSession, book: DataFrame, out: str) -> Binning:
    """The whole stage. Writes ``raw``, ``woe_bins``, ``woe_features`` and ``woe`` under ``out``."""
    require_columns(book, contract.RAW)
    split = time_split(add_derived(book))
    carry = [*contract.CARRY, "split"]
    with short_methods(spark):
        write_view(split.select(*carry, *contract.PROTECTED, *contract.MODELLED), f"{out}/raw")

    # later passes read the written view, column by column, instead of deriving it again
    raw = spark.read.parquet(f"{out}/raw")
    require_finite(raw, contract.DERIVED)
    binning = fit_bins(
        raw.where(F.col("split") == "train"),
        contract.TARGET,
        numeric=contract.NUMERIC,
        categorical=contract.CATEGORICAL,
        priors=contract.PRIORS,
    )
    binning.save(spark, out)
    with short_methods(spark):
        write_view(binning.transform(raw, carry), f"{out}/woe")
    return binning
