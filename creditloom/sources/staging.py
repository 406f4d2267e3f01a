"""Written intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; local sessions may get one of their own."""
    folder = spark.conf.get(KEY, None) or spark.sparkContext.getConf().get(KEY)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{KEY} must name a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="creditloom-")
    return _local[app]


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    Several passes over a derived frame then cost a pruned column scan each, and a lost
    executor costs a re-read instead of the joins upstream.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/creditloom/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Empty the files of a table from ``stage`` that nothing will read again, so that disks hold one step and not all."""
    spark = staged.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        spark.createDataFrame([], staged.schema).write.mode("overwrite").parquet(folder)
