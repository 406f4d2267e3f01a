"""Fingerprints of Lempel-Ziv phrases, compared by minimum-hash signatures.

A text's bytes are parsed into the shortest phrases not met before in the text; the set of phrases
says what a compressor would learn from it. Each phrase is hashed; the hash's low bits choose one of ``bins``
bins and each bin keeps its smallest 32-bit value. Likeness of two signatures: equal bins over bins
that either has filled, an estimate of the Jaccard similarity of the phrase sets. Two texts without
phrases are alike (1), one without and one with are not (0).

For the edited text the parse of the shared first half is taken over, not repeated. Neighbours in id
order come from range cells: each cell also receives the first document of the next one, so only
those are moved twice. Null ids come first, equal ids in the order of their texts, null text counts
as empty; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import span_hashes

EMPTY = np.uint32(0xFFFFFFFF)


def parse(data: bytes, start: int = 0, known: list[bytes] | None = None) -> tuple[list[int], list[bytes]]:
    """Ends of the phrases of data[start:] and all phrases, ``known`` ones first.

    Phrases grow by one byte from earlier phrases, so all prefixes of a phrase are phrases: the length
    of the next one can be found from any guess by stepping up or down.
    """
    phrases = list(known or ())
    seen = set(phrases)
    ends, n, size = [], len(data), 1
    add, keep, cut = seen.add, phrases.append, ends.append
    while start < n:
        end = min(start + size, n)
        part = data[start:end]
        if part in seen:
            while part in seen and end < n:
                end += 1
                part = data[start:end]
            if end >= n and part in seen:
                cut(n)  # the last phrase may be an old one
                break
        else:
            while end - start > 1 and (less := data[start : end - 1]) not in seen:
                end -= 1
                part = less
        add(part)
        keep(part)
        size = len(part)
        start += size
        cut(start)
    return ends, phrases


def signatures(spans: list[tuple[bytes, list[int]]], bins: int) -> np.ndarray:
    """Signature rows of texts given with the ends of their phrases."""
    out = np.full((len(spans), bins), EMPTY, np.uint32)
    data = np.frombuffer(b"".join(d for d, _ in spans), np.uint8)
    if not len(data):
        return out
    counts = np.array([len(e) for _, e in spans])
    base = np.cumsum([0] + [len(d) for d, _ in spans[:-1]])
    ends = np.fromiter((x for _, e in spans for x in e), np.int64, counts.sum()) + np.repeat(base, counts)
    starts = np.concatenate([[0], ends[:-1]])
    h = span_hashes(data, starts, ends)
    at = np.repeat(np.arange(len(spans)), counts) * bins + (h % np.uint64(bins)).astype(np.int64)
    np.minimum.at(out.reshape(-1), at, np.minimum((h >> np.uint64(32)).astype(np.uint32), EMPTY - np.uint32(1)))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    filled = ((a != EMPTY) | (b != EMPTY)).sum(1)
    same = ((a == b) & (a != EMPTY)).sum(1)
    return np.where(filled == 0, 1.0, same / np.maximum(filled, 1))


def _texts(sig: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in sig]


def _edited(text: str, follower: str) -> tuple[str, str]:
    half = len(text) // 2
    return text[: len(text) - half], follower[:half]


def _chunk(rows: list[tuple], bins: int) -> pa.RecordBatch:
    """Results of all rows but the last; each row's follower is the next one."""
    plain, ends, known = [], [], []
    for *_, text in rows:
        data = text.encode()
        e, p = parse(data)
        plain.append((data, e))
        known.append(p)
        ends.append(e)
    own = [n for n, (_, extra, _, _) in enumerate(rows[:-1]) if not extra]
    edited, spans = [], []
    for n in own:
        first, second = _edited(rows[n][3], rows[n + 1][3])
        head = len(first.encode())
        data = (first + second).encode()
        shared = min(bisect_right(ends[n], head), len(known[n]))
        begin = ends[n][shared - 1] if shared else 0
        more, _ = parse(data, begin, known[n][:shared])
        edited.append(data)
        spans.append((data, ends[n][:shared] + more))
    sig, sig2 = signatures(plain, bins), signatures(spans, bins)
    at = np.array(own, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[n][2] for n in own], pa.int64()),
            pa.array([len(rows[n][3]) for n in own], pa.int64()),
            pa.array([hashlib.sha256(d).hexdigest() for d in edited], pa.string()),
            pa.array(_texts(sig[at]), pa.string()),
            pa.array(_texts(sig2), pa.string()),
            pa.array(likeness(sig[at], sig2), pa.float64()),
            pa.array(likeness(sig[at], sig[at + 1]), pa.float64()),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def fingerprints(
    docs: DataFrame, bins: int = 128, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 1 << 19
) -> DataFrame:
    """Fingerprint of each text, of its edited text, and likeness to that and to the next document."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    cuts = rows.agg(
        F.percentile_approx("doc_id", F.array(*[F.lit(i / (4 * parts)) for i in range(1, 4 * parts)]), 20_000)
    ).first()[0]
    cuts = sorted(set(cuts or ()))
    edges = F.array(*[F.lit(c).cast("long") for c in cuts])
    cell = F.size(F.filter(edges, lambda e: e <= F.col("doc_id"))) if cuts else F.lit(0)
    rows = rows.withColumn("cell", F.when(F.col("doc_id").isNull(), 0).otherwise(cell).cast("int"))
    firsts = rows.groupBy("cell").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    cells = sorted(r.cell for r in rows.select("cell").distinct().collect())
    if not cells:
        cells = [0]
    to = F.create_map(*[F.lit(x) for c, p in zip(cells, cells[-1:] + cells[:-1]) for x in (c, p)])
    extra = firsts.select("first.*", F.element_at(to, F.col("cell")).alias("cell"), F.lit(True).alias("extra"))
    every = rows.withColumn("extra", F.lit(False)).unionByName(extra).select("cell", "extra", "doc_id", "text")

    def run(batches):
        held, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.append(row)
                size += len(row[3])
                if size >= chunk_bytes and len(held) > 1:
                    yield _chunk(held, bins)
                    held, size = held[-1:], len(row[3])
        if len(held) > 1:
            yield _chunk(held, bins)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return (
        every.repartition(parts, "cell")
        .sortWithinPartitions("cell", "extra", "doc_id", "text")
        .mapInArrow(run, schema)
    )
