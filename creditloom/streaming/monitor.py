"""Drift of a stream against a fixed reference, per event day or per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from creditloom.functions.expr import from_epoch_micros
from creditloom.operators.stability import EPS, _cells, drift_against, stability_edges


def reference_shares(
    reference: DataFrame, columns: Sequence[str], n_bins: int = 10
) -> tuple[dict[str, list[float]], DataFrame]:
    """Edges and reference shares per (feature, place): a few rows per feature."""
    edges = stability_edges(reference, columns, n_bins)
    counts = _cells(reference, [], edges).groupBy("feature", "place").agg(F.count(F.lit(1)).alias("n"))
    held = counts.collect()  # at most features x bins rows
    totals: dict[str, int] = {}
    for r in held:
        totals[r["feature"]] = totals.get(r["feature"], 0) + r["n"]
    rows = [(r["feature"], r["place"], max(r["n"] / totals[r["feature"]], EPS)) for r in held]
    shares = reference.sparkSession.createDataFrame(rows, "feature string, place string, e double")
    return edges, shares


def daily_cells(
    stream: DataFrame, edges: Mapping[str, Sequence[float]], *, ts: str = "ts", lateness: str = "1 day"
) -> DataFrame:
    """(feature, place, day, n) of every UTC event day that the watermark has closed.

    State is one row per open day, feature and bin, whatever the triggers were.
    """
    rows = _cells(stream.withWatermark(ts, lateness), [ts], edges)
    counts = rows.groupBy("feature", "place", F.window(ts, "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    day = F.to_date(from_epoch_micros(F.unix_micros("w.start")))
    return counts.select("feature", "place", day.alias("day"), "n")


def batch_drift(
    batch: DataFrame, edges: Mapping[str, Sequence[float]], shares: DataFrame, batch_id: int
) -> DataFrame:
    """PSI of one batch per feature."""
    counts = _cells(batch, [], edges).groupBy("feature", "place").agg(F.count(F.lit(1)).alias("n"))
    return drift_against(counts.withColumn("batch", F.lit(batch_id).cast("bigint")), shares, "batch")


def watch(
    stream: DataFrame,
    edges: Mapping[str, Sequence[float]],
    shares: DataFrame,
    sink: Callable[[DataFrame, int], None],
    *,
    checkpoint: str,
) -> StreamingQuery:
    """Run :func:`batch_drift` on each micro-batch. ``sink`` should be idempotent per batch id."""

    def each(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        local = session.createDataFrame(shares.collect(), shares.schema)
        sink(batch_drift(batch, edges, local, batch_id), batch_id)

    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
