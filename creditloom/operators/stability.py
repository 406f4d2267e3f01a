"""Population and characteristic stability.

Every requested feature (and, for drift, every group of current rows) comes out. A numeric
feature with no value on one side, or on both, counts as unmoved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.expr import in_chunks, psi_verdict, union_all, with_bins
from creditloom.functions.ordering import quantiles

EPS = 1e-10


def stability_edges(reference: DataFrame, columns: Sequence[str], n_bins: int = 10) -> dict[str, list[float]]:
    """Unique inner quantiles of the reference sample."""
    probs = np.linspace(0.0, 1.0, n_bins + 1)[1:-1].tolist()
    return {c: sorted(set(q)) for c, q in quantiles(reference, columns, probs).items()}


def _share(part: Column, whole: Column) -> Column:
    return F.greatest(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), F.lit(EPS))


def _term(e: Column, a: Column) -> Column:
    return (a - e) * F.ln(a / e)


def _cells(
    df: DataFrame, keep: Sequence[str], edges: Mapping[str, Sequence[float]], levels: Sequence[str] = ()
) -> DataFrame:
    """(feature, place, numeric) rows; missing numbers get no place, missing levels one."""
    parts = []
    for chunk in in_chunks(edges):
        cells = ", ".join(
            f"named_struct('feature', '{c}', 'place', CAST(`_bin_{c}` AS STRING), 'numeric', true)"
            for c in chunk
        )
        placed = with_bins(df.select(*keep, *chunk), {c: edges[c] for c in chunk})
        parts.append(placed.select(*keep, F.expr(f"inline(array({cells}))")).where("place IS NOT NULL"))
    for chunk in in_chunks(levels):
        cells = ", ".join(
            f"named_struct('feature', '{c}', 'place', coalesce(CAST(`{c}` AS STRING), 'None'), 'numeric', false)"
            for c in chunk
        )
        parts.append(df.select(*keep, F.expr(f"inline(array({cells}))")))
    return union_all(parts)


def _names(features: Sequence[str]) -> Column:
    """One array with the requested features, to explode beside each group."""
    return F.explode(F.array(*[F.lit(c) for c in features]))


def stability(
    df: DataFrame,
    is_reference: Column,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    *,
    n_bins: int = 10,
    edges: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """PSI of every feature between the reference rows and the others, highest first.

    Both samples are counted in one aggregation, which is also the outer alignment of levels.
    """
    marked = df.withColumn("_ref", is_reference)
    if edges is None:
        edges = stability_edges(marked.where("_ref"), numeric, n_bins)
    rows = _cells(marked, ["_ref"], edges, categorical)
    counts = rows.groupBy("feature", "numeric", "place").agg(
        F.count_if("_ref").alias("e"), F.count_if(~F.col("_ref")).alias("a")
    )
    whole = Window.partitionBy("feature")
    all_e, all_a = F.sum("e").over(whole), F.sum("a").over(whole)
    term = _term(_share(F.col("e"), all_e), _share(F.col("a"), all_a))
    # a numeric sample with no values on one side counts as unmoved
    empty = F.col("numeric") & ((all_e == 0) | (all_a == 0))
    terms = counts.select("feature", F.when(empty, F.lit(0.0)).otherwise(term).alias("_t"))
    names = df.sparkSession.range(1).select(_names([*edges, *categorical]).alias("feature"))
    value = names.join(terms, "feature", "left").groupBy("feature").agg(
        F.coalesce(F.sum("_t"), F.lit(0.0)).alias("psi")
    )
    return value.withColumn("verdict", psi_verdict(F.col("psi"))).orderBy(F.desc("psi"), "feature")


def characteristic_stability(
    df: DataFrame,
    is_reference: Column,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    *,
    n_bins: int = 10,
) -> DataFrame:
    """The published form: four places, verdict taken before rounding."""
    found = stability(df, is_reference, numeric, categorical, n_bins=n_bins)
    return found.select("feature", F.round("psi", 4).alias("csi"), "verdict").orderBy(
        F.desc("csi"), "feature"
    )


def drift(
    df: DataFrame,
    is_reference: Column,
    numeric: Sequence[str],
    by: str,
    *,
    n_bins: int = 10,
    edges: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """PSI of every (feature, ``by``) group of current rows against the reference rows."""
    marked = df.withColumn("_ref", is_reference)
    if edges is None:
        edges = stability_edges(marked.where("_ref"), numeric, n_bins)
    rows = _cells(marked, ["_ref", by], edges)
    counts = rows.groupBy("feature", "place", "_ref", by).agg(F.count(F.lit(1)).alias("n"))
    expected = (
        counts.where("_ref")
        .groupBy("feature", "place")
        .agg(F.sum("n").alias("n"))
        .withColumn("e", _share(F.col("n"), F.sum("n").over(Window.partitionBy("feature"))))
        .drop("n")
    )
    found = drift_against(counts.where("NOT _ref"), expected, by)
    found = found.select(F.col("feature").alias("_f"), F.col(by).alias("_g"), "psi")
    asked = marked.where("NOT _ref").select(by).distinct().select(_names(list(edges)).alias("feature"), by)
    same = (F.col("feature") == F.col("_f")) & F.col(by).eqNullSafe(F.col("_g"))
    value = asked.join(found, same, "left").select(
        "feature", by, F.coalesce("psi", F.lit(0.0)).alias("psi")
    )
    return value.withColumn("verdict", psi_verdict(F.col("psi")))


def drift_against(counts: DataFrame, expected: DataFrame, by: str) -> DataFrame:
    """PSI per (feature, ``by``) from counts (feature, place, by, n) and shares (feature, place, e).

    A group that misses a bin still pays for it: start from the sum over all reference bins as
    if the group had none, then correct the bins it has.
    """
    nothing = F.sum(_term(F.col("e"), F.lit(EPS))).alias("base")
    base = expected.groupBy("feature").agg(nothing)
    share = _share(F.col("n"), F.sum("n").over(Window.partitionBy("feature", by)))
    actual = counts.withColumn("a", share).join(expected, ["feature", "place"], "left")
    e = F.coalesce(F.col("e"), F.lit(EPS))
    gain = _term(e, F.col("a")) - F.when(F.col("e").isNull(), 0.0).otherwise(_term(e, F.lit(EPS)))
    summed = actual.groupBy("feature", by).agg(F.sum(gain).alias("gain"))
    value = summed.join(base, "feature").select(
        "feature", by, F.greatest(F.col("gain") + F.col("base"), F.lit(0.0)).alias("psi")
    )
    return value.withColumn("verdict", psi_verdict(F.col("psi")))
