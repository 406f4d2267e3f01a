"""Quality classifier: a factorisation machine over hashed words, structure statistics and size.

Inputs of a score: words and word endings (lower-cased, hashed, log counts scaled to unit length)
and standardised statistics of the text (length, case, digits, punctuation, lines, repetition).
Pairwise interactions have rank ``rank`` and cost linear time: half of (sum v x)^2 - sum (v x)^2.

The machine is fitted with Adagrad on at most ``max_rows`` labelled rows that are not held out,
those whose id hashes lowest; scoring covers every row. Ids whose crc32 modulo 5 is 0 are held out.
Label, language, source and id are never inputs. Null and empty texts are scored as texts without
words. Without usable labels every score is 0.5, with labels of one kind their smoothed share.
Labels given several times for an id count once, by their mean, ties up; of
several documents with one id the smallest text is learnt from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, U64, lean, slices, span_hashes, utf8, words

STATS = 15
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = 1  # capitals
_CLASS[48:58] = 2  # digits
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 3  # punctuation
_CLASS[128:] = 4  # beyond ASCII
_CLASS[[9, 10, 11, 12, 13, 32]] = 5


@dataclass
class Rows:
    """Sparse rows: feature numbers and values, with offsets."""

    index: np.ndarray
    value: np.ndarray
    offsets: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[Rows, np.ndarray]:
    """Hashed words and endings of each text, and its statistics (not yet standardised)."""
    n = len(offsets) - 1
    starts, ends, at = words(data, offsets)
    lower = LOWER[data]
    row = np.repeat(np.arange(n), np.diff(at))
    whole = span_hashes(lower, starts, ends)
    ending = span_hashes(lower, np.maximum(starts, ends - 3), ends)
    shift = U64(64 - bits)
    slot = np.concatenate([whole >> shift, (ending >> shift) ^ U64(1 << (bits - 1))]).astype(np.int64)
    key, counts = np.unique((np.concatenate([row, row]) << bits) | slot, return_counts=True)
    at_row = key >> bits
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(at_row, value**2, n))
    value /= np.maximum(norm, 1e-12)[at_row]
    index = (key & ((1 << bits) - 1)).astype(np.int32)
    sparse = Rows(index, value.astype(np.float32), np.searchsorted(at_row, np.arange(n + 1)))

    size, n_words = np.diff(offsets), np.diff(at)
    kinds = _CLASS[data]
    text_of = np.repeat(np.arange(n), size)
    share = np.bincount(text_of * 6 + kinds, minlength=6 * n).reshape(n, 6) / np.maximum(size, 1)[:, None]
    lines = np.bincount(text_of, data == 10, n)
    marks = np.stack([np.bincount(text_of, data == ord(c), n) for c in "|!.,"], 1) / np.maximum(size, 1)[:, None]
    distinct = np.bincount(np.unique((row << 40) | (whole >> U64(24)).astype(np.int64)) >> 40, minlength=n)
    length = np.bincount(row, ends - starts, n)
    stats = np.column_stack([
        np.log1p(size), np.log1p(n_words), share[:, 1:], lines / np.maximum(n_words, 1), marks,
        distinct / np.maximum(n_words, 1), length / np.maximum(n_words, 1),
        np.sqrt(np.bincount(row, (ends - starts) ** 2.0, n) / np.maximum(n_words, 1)),
    ])
    return sparse, np.nan_to_num(stats)


@dataclass
class Machine:
    """Bias, linear weights and factors; statistics stand behind the hashed features."""

    bits: int
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def join(self, sparse: Rows, stats: np.ndarray) -> Rows:
        """Hashed features and standardised statistics as one sparse matrix."""
        n = len(stats)
        z = np.clip((stats - self.mean) / self.scale, -4, 4).astype(np.float32) / 4
        counts = np.diff(sparse.offsets)
        offsets = np.concatenate([[0], np.cumsum(counts + STATS)])
        index = np.empty(offsets[-1], np.int32)
        value = np.empty(offsets[-1], np.float32)
        tail = offsets[1:, None] - STATS + np.arange(STATS)
        mask = np.ones(offsets[-1], bool)
        mask[tail.ravel()] = False
        index[mask], value[mask] = sparse.index, sparse.value
        index[tail.ravel()] = np.tile((1 << self.bits) + np.arange(STATS), n)
        value[tail.ravel()] = z.ravel()
        return Rows(index, value, offsets)

    def margins(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Log odds, and the sums of factors that the gradient needs."""
        first = rows.offsets[:-1]
        linear = np.add.reduceat(self.linear[rows.index] * rows.value, first)
        vx = self.factors[rows.index] * rows.value[:, None]
        sums = np.add.reduceat(vx, first)
        pairs = 0.5 * (sums**2 - np.add.reduceat(vx**2, first)).sum(1)
        return self.bias + linear + pairs, sums


def take(rows: Rows, some: np.ndarray) -> Rows:
    counts = np.diff(rows.offsets)[some]
    offsets = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(offsets[-1]) + np.repeat(rows.offsets[:-1][some] - offsets[:-1], counts)
    return Rows(rows.index[at], rows.value[at], offsets)


def fit(sparse: Rows, stats: np.ndarray, y: np.ndarray, bits: int, rank: int, epochs: int, rate: float) -> Machine:
    size = (1 << bits) + STATS
    rng = np.random.Generator(np.random.PCG64(11))
    scale = stats.std(0) if len(y) else np.ones(STATS)
    machine = Machine(
        bits, 0.0, np.zeros(size, np.float32), rng.normal(0, 0.02, (size, rank)).astype(np.float32),
        stats.mean(0) if len(y) else np.zeros(STATS), np.where(scale > 1e-9, scale, 1.0),
    )
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        machine.bias, machine.factors[:] = float(np.log(p / (1 - p))), 0
        return machine
    rows = machine.join(sparse, stats)
    machine.bias = float(np.log(y.mean() / (1 - y.mean())))
    g_bias, g_linear, g_factors = 1e-6, np.full(size, 1e-6, np.float32), np.full((size, rank), 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 64):
            some = order[lo : lo + 64]
            batch = take(rows, some)
            z, sums = machine.margins(batch)
            err = ((1 / (1 + np.exp(-z)) - y[some]) / len(some)).astype(np.float32)
            of = np.repeat(np.arange(len(some)), np.diff(batch.offsets))
            x, e = batch.value, err[of]
            used, where = np.unique(batch.index, return_inverse=True)
            grad = np.bincount(where, e * x).astype(np.float32) + 1e-5 * machine.linear[used]
            g_linear[used] += grad**2
            machine.linear[used] -= rate * grad / np.sqrt(g_linear[used])
            v = machine.factors[batch.index]
            each = (e * x)[:, None] * (sums[of] - v * x[:, None])
            grads = np.stack([np.bincount(where, each[:, f]) for f in range(rank)], 1).astype(np.float32)
            grads += 1e-5 * machine.factors[used]
            g_factors[used] += grads**2
            machine.factors[used] -= 0.5 * rate * grads / np.sqrt(g_factors[used])
            g_bias += float(err.sum()) ** 2
            machine.bias -= rate * float(err.sum()) / g_bias**0.5
    return machine


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 5 == 0


def train(
    docs: DataFrame, labels: DataFrame, bits: int = 16, rank: int = 8, max_rows: int = 6000, epochs: int = 6,
    rate: float = 0.1, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Machine:
    """Fit on at most ``max_rows`` labelled documents that are not held out."""
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    rows = rows.groupBy("_id", "_y").agg(F.min("_text").alias("_text"))

    def extract(batches):
        for b in batches:
            data, offsets = utf8(b.column(1))
            for lo, hi in slices(offsets):
                sparse, stats = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], bits)
                cut = lambda a: [a[i:j].tobytes() for i, j in zip(sparse.offsets, sparse.offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(cut(sparse.index), pa.binary()),
                     pa.array(cut(sparse.value), pa.binary()), pa.array([s.tobytes() for s in stats], pa.binary())],
                    ["id", "y", "index", "value", "stats"],
                )

    got = rows.select("_id", "_text", "_y").mapInArrow(
        lean(extract), "id long, y int, index binary, value binary, stats binary"
    ).collect()
    got.sort(key=lambda r: r.id)
    sparse = Rows(
        np.frombuffer(b"".join(r["index"] for r in got), np.int32),
        np.frombuffer(b"".join(r.value for r in got), np.float32),
        np.concatenate([[0], np.cumsum([len(r["index"]) // 4 for r in got], dtype=np.int64)]),
    )
    stats = np.frombuffer(b"".join(r.stats for r in got), np.float64).reshape(len(got), STATS)
    return fit(sparse, stats, np.array([r.y for r in got], np.float64), bits, rank, epochs, rate)


def score(
    docs: DataFrame, machine: Machine, keep: list[str] | None = None, text_col: str = "text", score_col: str = "score"
) -> DataFrame:
    """Columns ``keep`` and the score of every row."""
    held = docs.sparkSession.sparkContext.broadcast(machine)
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"))

    def run(batches):
        m = held.value
        for b in batches:
            data, offsets = utf8(b.column(1))
            out = []
            for lo, hi in slices(offsets):
                got = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], m.bits)
                out.append(1 / (1 + np.exp(-np.clip(m.margins(m.join(*got))[0].astype(float), -40, 40))))
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(out))], ["row", score_col])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"row {kind}, `{score_col}` double").select("row.*", score_col)
