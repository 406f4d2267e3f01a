"""Paired bootstrap of the Gini gap between two models scored on the same rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.config import SEED
from creditloom.functions.expr import present, with_bins
from creditloom.functions.ordering import bucket_count, splitters
from creditloom.operators.metrics import discrimination


#: Cells whose weights are drawn and added up at a time.
BLOCK = 256
#: Tasks that may share the cells of one score.
SALTS = 64


# ---- fixed values of the counter-based draws (a 64-bit mixer), shared with the SQL ----
STEP = 0x9E3779B97F4A7C15
MIXERS = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))
LAST_SHIFT = 31
#: Cells of more rows draw from the normal curve, with a term for the skew of the Poisson distribution.
TABLE_ROWS = 512
# ---- end of fixed values ----


def cell_key(a: str, b: str, y: str, seed: int) -> Column:
    """60 bits of a digest of a cell's scores, to nine places, its outcome and the seed."""
    parts = [F.round(F.col(c) * 1e9).cast("decimal(38,0)").cast("string") for c in (a, b)]
    text = F.concat_ws(":", *parts, F.col(y).cast("int").cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def uniforms(keys: np.ndarray, replicates: int, lane: int = 0) -> np.ndarray:
    """(cells x replicates) numbers in (0, 1), each a mix of its cell's key and the replicate's number."""
    counter = np.arange(1, replicates + 1, dtype=np.uint64) + np.uint64(lane * (1 << 32))
    x = keys.astype(np.uint64)[:, None] + counter[None, :] * np.uint64(STEP)
    for shift, factor in MIXERS:
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(LAST_SHIFT)
    return ((x >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def poisson_table(n: int) -> np.ndarray:
    """Cumulative probabilities of a Poisson count of mean n, as far as doubles tell them from 1."""
    k = np.arange(int(n + 12 * np.sqrt(n) + 30))
    logs = np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
    return np.cumsum(np.exp(k * np.log(n) - n - logs))


def _draws(keys: np.ndarray, counts: np.ndarray, replicates: int) -> np.ndarray:
    """(cells x replicates) Poisson weights by inversion; a cell's draws depend on nothing but its key and size."""
    out = uniforms(keys, replicates)
    for n in np.unique(counts):
        rows = np.flatnonzero(counts == n)
        if n <= TABLE_ROWS:
            out[rows] = np.searchsorted(poisson_table(int(n)), out[rows], side="right")
        else:
            angle = 2 * np.pi * uniforms(keys[rows], replicates, 1)
            z = np.sqrt(-2.0 * np.log(out[rows])) * np.cos(angle)
            out[rows] = np.maximum(np.floor(n + np.sqrt(n) * z + (z * z - 1) / 6 + 0.5), 0)
    return out


class _Running:
    """Totals per replicate of one stretch of cells in score order; the last score is still open."""

    def __init__(self, replicates: int):
        self.bads, self.goods, self.pairs = (np.zeros(replicates) for _ in range(3))
        self.tied_bad, self.tied_good = np.zeros((1, replicates)), np.zeros((1, replicates))
        self.at = None

    def add(self, score: np.ndarray, bad: np.ndarray, weights: np.ndarray) -> None:
        starts = np.flatnonzero(np.r_[True, score[1:] != score[:-1]])
        bads = np.add.reduceat(weights * bad[:, None], starts)
        goods = np.add.reduceat(weights * ~bad[:, None], starts)
        if score[0] == self.at:
            bads[0] += self.tied_bad[0]
            goods[0] += self.tied_good[0]
        else:
            self._close(self.tied_bad, self.tied_good)
        self._close(bads[:-1], goods[:-1])
        self.tied_bad, self.tied_good, self.at = bads[-1:], goods[-1:], score[-1]

    def _close(self, bads: np.ndarray, goods: np.ndarray) -> None:
        """Each bad outranks the goods of all lower scores; ties count half."""
        below = self.goods + np.cumsum(goods, axis=0) - goods
        self.pairs = self.pairs + (bads * (below + goods / 2.0)).sum(axis=0)
        self.bads, self.goods = self.bads + bads.sum(axis=0), self.goods + goods.sum(axis=0)

    def report(self, bucket: int) -> pd.DataFrame:
        self._close(self.tied_bad, self.tied_good)
        pairs = 0.0 if bucket % 2 else self.pairs  # one score alone: settled once its parts are together
        return pd.DataFrame(
            {
                "bucket": np.int32(bucket),
                "replicate": np.arange(len(self.bads), dtype=np.int32),
                "bads": self.bads,
                "goods": self.goods,
                "pairs": pairs,
            }
        )


def placed_cells(cells: DataFrame, score: str) -> DataFrame:
    """Cells by (bucket, salt) in score order: even buckets hold the scores between two cut points.

    A score that many cells share is a cut point. Every cut point is an odd bucket of its own, whose
    cells need no order and are therefore spread over several tasks.
    """
    buckets = bucket_count(cells.sparkSession)
    edges = splitters(cells, [score], buckets)
    binned = with_bins(cells.withColumn(score, F.col(score).cast("double")), edges)
    place = F.col(f"_bin_{score}")
    cuts = edges[score]
    alone = F.coalesce(F.get(F.lit(cuts), place) == F.col(score), F.lit(False)) if cuts else F.lit(False)
    salt = F.when(alone, F.pmod("key", F.lit(min(buckets, SALTS)))).otherwise(0).cast("int")
    return (
        binned.select(
            (2 * place + alone.cast("int")).cast("int").alias("bucket"),
            salt.alias("salt"),
            F.col(score).alias("s"),
            "y",
            "n",
            "key",
        )
        .repartition("bucket", "salt")
        .sortWithinPartitions("bucket", "salt", "s")
    )


def _replicate_sums(
    cells: DataFrame, score: str, replicates: int, model: str
) -> DataFrame:
    """Per (bucket, replicate): weighted bads, goods, and concordant pairs inside the bucket.

    Cells stream through a task a block at a time against one running total per replicate; rows
    are never multiplied by the number of replicates.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, running = None, None
        for batch in batches:
            for first in range(0, len(batch), BLOCK):
                block = batch.iloc[first : first + BLOCK]
                weights = _draws(block["key"].to_numpy(), block["n"].to_numpy(), replicates)
                places = block[["bucket", "salt"]].to_numpy()
                score_, bad = block["s"].to_numpy(), block["y"].to_numpy() != 0
                turns = np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1
                for rows in np.split(np.arange(len(block)), turns):
                    place = tuple(places[rows[0]])
                    if place != here:
                        if running is not None:
                            yield running.report(int(here[0]))
                        here, running = place, _Running(replicates)
                    running.add(score_[rows], bad[rows], weights[rows])
        if running is not None:
            yield running.report(int(here[0]))

    schema = "bucket int, replicate int, bads double, goods double, pairs double"
    parts = placed_cells(cells, score).mapInPandas(sums, schema)
    whole = parts.groupBy("bucket", "replicate").agg(
        F.sum("bads").alias("bads"), F.sum("goods").alias("goods"), F.sum("pairs").alias("pairs")
    )
    tied = F.when(F.col("bucket") % 2 == 1, F.col("bads") * F.col("goods") / 2.0).otherwise(F.col("pairs"))
    return whole.withColumn("pairs", tied).withColumn("model", F.lit(model))


def replicate_ginis(
    df: DataFrame, a: str, b: str, y: str, *, replicates: int = 2000, seed: int = SEED
) -> DataFrame:
    """(replicate, gini_a, gini_b) with the same Poisson row weights for both models.

    Rows with equal scores and outcome share a cell; a cell of n rows draws Poisson(n) per
    replicate, by inversion of a number that is a mix of the cell's key and the replicate, so both orderings, any
    partitioning and any engine see the same weights. Cells that agree to nine places share their numbers.
    """
    seen = df.where(present(a, b, y))
    cells = seen.groupBy(F.col(a).alias("a"), F.col(b).alias("b"), F.col(y).alias("y")).agg(
        F.count(F.lit(1)).alias("n")
    )
    cells = cells.withColumn("key", cell_key("a", "b", "y", seed))
    sums = _replicate_sums(cells, "a", replicates, "a").unionByName(
        _replicate_sums(cells, "b", replicates, "b")
    )
    # one row per bucket and replicate from here on
    ahead = (
        Window.partitionBy("model", "replicate")
        .orderBy("bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    pairs = F.col("pairs") + F.col("bads") * F.coalesce(F.sum("goods").over(ahead), F.lit(0.0))
    per_model = (
        sums.withColumn("_p", pairs)
        .groupBy("replicate", "model")
        .agg(F.sum("_p").alias("p"), F.sum("bads").alias("bads"), F.sum("goods").alias("goods"))
        .withColumn("gini", 2.0 * F.try_divide("p", F.col("bads") * F.col("goods")) - 1.0)
    )
    return (
        per_model.groupBy("replicate")
        .agg(
            F.max(F.when(F.col("model") == "a", F.col("gini"))).alias("gini_a"),
            F.max(F.when(F.col("model") == "b", F.col("gini"))).alias("gini_b"),
        )
        .where("gini_a IS NOT NULL AND gini_b IS NOT NULL")
    )


def gini_difference(
    df: DataFrame, a: str, b: str, y: str, *, replicates: int = 2000, seed: int = SEED
) -> DataFrame:
    """Observed Ginis and their gap with a percentile interval and two-sided p; one row.

    Both models are judged on the rows that have both scores and an outcome.
    """
    df = df.where(present(a, b, y))
    one = F.lit(1).alias("_one")
    observed_a = discrimination(df, a, y).select(F.col("gini").alias("gini_a"), one)
    observed_b = discrimination(df, b, y).select(F.col("gini").alias("gini_b"), one)
    draws = replicate_ginis(df, a, b, y, replicates=replicates, seed=seed).select(
        (F.col("gini_a") - F.col("gini_b")).alias("d")
    )
    spread = draws.agg(
        F.percentile("d", [0.025, 0.975]).alias("q"),
        F.avg((F.col("d") <= 0).cast("double")).alias("below"),
        F.avg((F.col("d") >= 0).cast("double")).alias("above"),
        F.count(F.lit(1)).alias("n_resamples"),
    ).select("*", one)
    joined = observed_a.join(observed_b, "_one").join(spread, "_one")
    low, high = F.col("q")[0], F.col("q")[1]
    return joined.select(
        "gini_a",
        "gini_b",
        (F.col("gini_a") - F.col("gini_b")).alias("difference"),
        low.alias("ci_low"),
        high.alias("ci_high"),
        F.least(2.0 * F.least("below", "above"), F.lit(1.0)).alias("p_two_sided"),
        (~((low <= 0) & (high >= 0))).alias("significant_at_95"),
        "n_resamples",
    )
