"""Exact top-k inner products by an impact-ordered index, scored a level at a time.

Components are integers. A block of candidates is indexed by impact: each component belongs to the
segment of its dimension and of its magnitude, quantised in steps. For a block of queries, segments
are scored from the highest impact down, with the quantised value, while a bound is kept on what
quantisation and unread segments can still add. Candidates whose upper bound is below the k-th best
lower bound (or the k-th exact score so far) are out by proof; reading stops when few are left, or
at the last segment, and those left are scored exactly. Each task keeps the k best for each query;
a window ranks what the tasks return.

Queries are taken ``query_rows`` at a time, so what is broadcast is bounded; blocks of candidates
bound the memory of a task. Vectors that are null or hold a null or non-finite component take no
part. Shorter vectors count as padded with zeros. Rows whose id is null are candidates of no query and
no query; repeated query ids are one query (its smallest vector), and a query's own id is no
candidate. Ties go to the smaller id. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STEPS = 16


def _matrix(lists: pa.ListArray, width: int = 0) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class Block:
    """Impact-ordered segments of one block of candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        size = np.abs(vectors)
        self.step = max(1, -(-(int(size.max(initial=0)) + 1) // STEPS))
        self.level = size // self.step
        self.half = (self.step - 1) / 2
        self.value = np.sign(vectors) * (self.level * self.step + self.half)

    def members(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, candidate) positions that may be among the k best; all others are proven not to be."""
        scores = np.zeros((len(queries), len(self.ids)))
        weight = np.abs(queries).astype(float)
        outside = own[:, None] == self.ids[None, :]
        for level in range(STEPS - 1, -1, -1):
            scores += queries @ np.where(self.level == level, self.value, 0).T
            slack = weight @ np.where(self.level >= level, self.half, level * self.step - 1).T if level else weight.sum(1)[:, None] * self.half
            low, high = scores - slack, scores + slack
            low[outside] = -np.inf
            high[outside] = -np.inf
            if len(self.ids) > k:
                best = np.partition(low, len(self.ids) - k, axis=1)[:, len(self.ids) - k]
            else:
                best = np.full(len(queries), -np.inf)
            may = (high >= np.maximum(best, floor)[:, None]) & ~outside
            if may.sum() <= 8 * k * len(queries):
                break
        return np.nonzero(may)

    def exact(self, queries: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        out = np.empty(len(at[0]), np.int64)
        for lo in range(0, len(out), 100_000):
            s = slice(lo, lo + 100_000)
            out[s] = np.einsum("ij,ij->i", queries[at[0][s]], self.vectors[at[1][s]])
        return out


def _best(q: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((ids, -score, q))
    q, score, ids = q[order], score[order], ids[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    return q[rank < k], score[rank < k], ids[rank < k]


def _search(rows: DataFrame, queries: list, k: int, block_rows: int) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(
        (np.array([r[0] for r in queries], np.int64), [np.array(r[1], np.int64) for r in queries])
    )

    def search(batches):
        own, lists = held.value
        width = max((len(v) for v in lists), default=0)
        q = s = i = np.zeros(0, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, block_rows):
                part = batch.slice(lo, block_rows)
                vectors = _matrix(part.column(1), width)
                block = Block(part.column(0).to_numpy(), vectors)
                asked = np.zeros((len(lists), vectors.shape[1]), np.int64)
                for n, v in enumerate(lists):
                    asked[n, : len(v)] = v
                for at in range(0, len(lists), 512):
                    floor = np.full(len(asked[at : at + 512]), -np.inf)
                    full = np.flatnonzero(np.bincount(q, minlength=len(lists))[at : at + 512] >= k)
                    if len(full):
                        floor[full] = s[np.searchsorted(q, full + at, side="right") - 1]
                    found = block.members(asked[at : at + 512], own[at : at + 512], floor, k)
                    score = block.exact(asked[at : at + 512], found)
                    q, s, i = _best(
                        np.concatenate([q, found[0] + at]), np.concatenate([s, score]),
                        np.concatenate([i, block.ids[found[1]]]), k,
                    )
        yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(i), pa.array(s)], ["query_id", "vec_id", "score"])

    return rows.mapInArrow(search, "query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_rows: int = 4096,
    block_rows: int = 2048,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows by inner product of floor(scale * x)."""
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vector_col, lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("v"),
    )
    asked = rows.where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("v").alias("v"))
    parts = max(1, -(-asked.count() // query_rows))
    found = None
    for part in range(parts):
        chunk = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part) if parts > 1 else asked
        some = _search(rows, chunk.orderBy("vec_id").collect(), k, block_rows)
        found = some if found is None else found.unionByName(some)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same for DuckDB.
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
