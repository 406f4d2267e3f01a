"""Streaming forms of the windowed transaction features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.expr import epoch_micros, from_epoch_micros

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def read_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The event log as a stream of transactions.

    Watermarks need an instant, so the zone-free event time is read as UTC whatever the zone of
    the session; the hour of day is taken from the original.

    A trigger takes all files there are, so that a backlog gives the same result in any number
    and order of files. A cap bounds a trigger, but then events more than the lateness behind
    an earlier trigger are too late: set one only where files arrive in order of event time.
    """
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    raw = reader.parquet(path)
    return raw.select(
        "user_id",
        F.timestamp_micros(epoch_micros("ts")).alias("ts"),
        F.hour("ts").alias("hour"),
        F.col("event_type").alias("type"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").alias("party"),
    )


def _bounds() -> list[Column]:
    return [from_epoch_micros(F.unix_micros(f"w.{side}")).alias(side) for side in ("start", "end")]


def windowed_activity(
    events: DataFrame, *, lateness: str = "1 day", size: str = "7 days", slide: str | None = None
) -> DataFrame:
    """Counts, amounts and night share per user and tumbling or sliding window.

    State is one row per user and open window; the watermark closes and evicts windows.
    """
    night = (F.col("hour") >= 22) | (F.col("hour") < 4)
    span = F.window("ts", size, slide) if slide else F.window("ts", size)
    return (
        events.withWatermark("ts", lateness)
        .groupBy("user_id", span.alias("w"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("amount").alias("amount"),
            F.count_if(F.col("type") == "error").alias("failed"),
            F.avg(night.cast("double")).alias("night_share"),
        )
        .select("user_id", *_bounds(), "events", "amount", "failed", "night_share")
    )


def sessions(events: DataFrame, *, lateness: str = "1 day", gap: str = "12 hours") -> DataFrame:
    """Bursts of activity per user, closed after a silence."""
    return (
        events.withWatermark("ts", lateness)
        .groupBy("user_id", F.session_window("ts", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("events"), F.sum("amount").alias("amount"))
        .select("user_id", *_bounds(), "events", "amount")
    )
