"""Shared parts of the passage operators: keys of documents, routing of windows, joining spans back.

A document is known by its id and 32 bits of a hash of its text, so rows that share an id but not a
text stay apart; a null id ranks after all others. A window goes to the bucket of its smallest gram
hash, so that equal windows meet and neighbours mostly travel together. Grams that are frequent
in a share of the documents are listed once (a bounded list); windows under such a gram go to the bucket of their own
hash instead, which spreads them. The list steers routing only: every window is compared either way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import mix, slices, utf8

LAST_ID = (1 << 63) - 1
#: Bytes of text whose windows are compared before anything is sent on.
PART_BYTES = 8 << 20


def buckets(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def keyed(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """_id, _digest, _text, and ``keep`` columns as one struct _row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
        F.xxhash64(text).bitwiseAND(0xFFFFFFFF).alias("_digest"),
        text.alias("_text"),
        *([F.struct(*keep).alias("_row")] if keep else []),
    )


def parts(batch: pa.RecordBatch, limit: int = PART_BYTES):
    """(ids, digests, bytes, offsets) of row ranges of about ``limit`` bytes."""
    ids, digests = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint32)
    data, offsets = utf8(batch.column(2))
    for lo, hi in slices(offsets, limit):
        yield ids[lo:hi], digests[lo:hi], data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def frequent_grams(rows: DataFrame, keys_of, share: int = 16, least: int = 64, limit: int | None = None) -> np.ndarray:
    """Sorted gram hashes that head most runs of windows in one of ``share`` documents: ``limit``, or
    8 per bucket, at most."""

    def count(batches):
        for batch in batches:
            for _, _, data, offsets in parts(batch):
                keys, n = np.unique(keys_of(data, offsets), return_counts=True)
                some = n > 1
                yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(n[some])], ["key", "n"])

    top = (
        rows.where(F.pmod(F.xxhash64("_id", "_digest"), F.lit(share)) == 0)
        .select("_id", "_digest", "_text").mapInArrow(count, "key long, n long")
        .groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        .orderBy(F.desc("n"), "key").limit(limit or 8 * buckets(rows))
    )
    return np.sort(np.array([r.key for r in top.collect()], np.int64).view(np.uint64))


def runs(row: np.ndarray, pos: np.ndarray, key: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First entry and length of each run of consecutive windows of one row under one key; ``alone``
    windows are runs of their own."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = (row[1:] != row[:-1]) | (pos[1:] != pos[:-1] + 1) | (key[1:] != key[:-1]) | alone[1:] | alone[:-1]
    first = np.concatenate([[0], np.flatnonzero(cut) + 1])
    return first, np.diff(np.append(first, len(row)))


def listed(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted table."""
    if not len(table):
        return np.zeros(len(keys), bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(n)).astype(np.int64)


def attach(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Every keyed row with the array ``spans`` of (start, n) of its document, or null."""
    grouped = spans.groupBy("_id", "_digest").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return rows.join(grouped, ["_id", "_digest"], "left")


def covered(size: int, spans: list[dict] | None, tail: int) -> np.ndarray | None:
    """Mask of the positions under windows start .. start + n - 1, each ``tail`` + 1 long; None: none."""
    if not spans:
        return None
    steps = np.zeros(size + 1, np.int32)
    start = np.array([s["start"] for s in spans])
    np.add.at(steps, start, 1)
    np.add.at(steps, start + np.array([s["n"] for s in spans]) + tail, -1)
    return np.cumsum(steps[:-1]) > 0
