"""Tables written on the way, and shuffle files given back as soon as they are not needed."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame

from ..sources.staging import stage


def written(df: DataFrame, label: str, release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Spark deletes the shuffle files of finished work when the driver collects garbage, which it may
    not do for long; ``release`` asks for it, so that disks hold one step's shuffles and not all.
    """
    out = stage(df, label)
    if release:
        released(df)
    return out


def released(df: DataFrame) -> None:
    """Ask twice: what the first collection makes unreachable goes in the second, and Spark's cleaner works beside us."""
    for _ in range(2):
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(0.5)
