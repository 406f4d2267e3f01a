"""Substring deduplication by relative Lempel-Ziv parsing.

A word is removed if a window of ``window`` consecutive words that covers it also starts in a document
with a smaller id; windows are judged on the input. Reference blocks are buckets of windows: every
window of the corpus is in the block of its smallest gram, with the windows next to it that share
that gram, and each block is indexed by window hash to the occurrence with the smallest id. Each
document's runs of windows are factored greedily against their block: from a window found
in an earlier document, the factor is the longest common extension with the indexed occurrence.
Parsing goes on with the window that straddles the factor's end, so boundaries lose nothing, and
factors of ``window`` words or more become spans. Windows that an earlier document of
the same few megabytes already holds are resolved before anything is sent.

Words are runs without ASCII white space, windows are compared by 64-bit hashes. Null text has no
words; documents without words or shorter than a window lose nothing; a null id ranks last;
repeated rows are copies of one document and never remove each other's words.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import gram_hashes, lean, ranges, sliding_min, span_hashes, words
from .spans import attach, bucket_of, buckets, covered, frequent_grams, keyed, listed, parts, runs
from .written import written

#: Bytes of text whose windows are compared before anything is sent on; a window takes some 100 bytes meanwhile.
PART_BYTES = 2 << 20
_SENT = "bucket int, runs binary, lengths binary, hashes binary"
_RUN = np.dtype([("id", "<i8"), ("digest", "<u4"), ("start", "<u4")])
_SPANS = "_id long, _digest long, start int, n int"


def windows(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, position, smallest gram and hash of each window, in text order."""
    starts, ends, at = words(data, offsets)
    h = span_hashes(data, starts, ends)
    whole = gram_hashes(h, window)
    least = sliding_min(gram_hashes(h, gram), window - gram + 1)
    n = np.maximum(np.diff(at) - window + 1, 0)
    here = ranges(at[:-1], n)
    row = np.repeat(np.arange(len(n), dtype=np.int32), n)
    return row, (here - at[:-1][row]).astype(np.int32), least[here], whole[here]


def _span_batch(ids: np.ndarray, digests: np.ndarray, starts: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(digests.astype(np.int64)), pa.array(starts.astype(np.int32)), pa.array(n.astype(np.int32))],
        ["_id", "_digest", "start", "n"],
    )


def repeats(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which windows an entry with a smaller id has too."""
    order = np.lexsort((ids, hashes))
    hashes, ids = hashes[order], ids[order]
    new = np.ones(len(order), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    out = np.empty(len(order), bool)
    out[order] = ids > ids[new][np.cumsum(new, dtype=np.int32) - 1]
    return out


def factors(ids: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Run, first window and number of windows of each factor of a block's runs against the block."""
    none = np.zeros(0, np.int64)
    if not len(hashes):
        return none, none, none
    run = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    end = (begin + lengths)[run]
    doc = ids[run]
    order = np.lexsort((doc, hashes))
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    index = np.empty(len(order), np.int64)
    index[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]  # the occurrence with the smallest id
    hit = doc[index] < doc
    follow = np.where(hit, np.arange(len(hit)), len(hit))
    follow = np.append(np.minimum.accumulate(follow[::-1])[::-1], len(hit))  # the next window that can open a factor
    at = np.unique(follow[begin])
    at = at[at < len(hit)]
    out = []
    while len(at):
        size, live = np.ones(len(at), np.int64), np.arange(len(at))
        ref = index[at]
        while len(live):
            p, r = at[live] + size[live], ref[live] + size[live]
            ok = (p < end[at[live]]) & (r < end[ref[live]])
            ok[ok] = hashes[p[ok]] == hashes[r[ok]]
            live = live[ok]
            size[live] += 1
        out.append((at, size))
        following = follow[at + size]
        at = following[(following < len(hit)) & (following < end[at])]
    p, n = (np.concatenate(x) for x in zip(*out)) if out else (none, none)
    return run[p], p - begin[run[p]], n


def duplicate_spans(rows: DataFrame, window: int = 13, gram: int = 5) -> DataFrame:
    """_id, _digest, start, n: windows start .. start + n - 1 of a document begin in one with a smaller id too."""
    tasks = buckets(rows)
    count = 4 * tasks  # blocks are smaller than tasks, which index one after the other

    def heads(data, offsets):
        row, pos, key, _ = windows(data, offsets, window, gram)
        first, _ = runs(row, pos, key, np.zeros(len(row), bool))
        return key[first]

    held = rows.sparkSession.sparkContext.broadcast(frequent_grams(rows, heads))

    def send(batches):
        table, turn = held.value, 0
        for batch in batches:
            for ids, digests, data, offsets in parts(batch, PART_BYTES):
                row, pos, key, whole = windows(data, offsets, window, gram)
                if not len(row):
                    continue
                known = repeats(ids[row], whole)
                quiet = np.zeros(len(row), bool)
                turn += 1
                if known.any():
                    first, n = runs(row[known], pos[known], np.zeros(known.sum(), np.uint64), quiet[known])
                    r, p = row[known][first], pos[known][first]
                    sent = np.rec.fromarrays([ids[r], digests[r], p], dtype=_RUN)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([turn % count], pa.int32()), pa.array([sent.tobytes()], pa.binary()),
                         pa.array([n.astype("<u4").tobytes()], pa.binary()), pa.array([None], pa.binary())],
                        ["bucket", "runs", "lengths", "hashes"],
                    )
                row, pos, key, whole = (x[~known] for x in (row, pos, key, whole))
                frequent = listed(key, table)
                first, n = runs(row, pos, key, frequent)
                to = bucket_of(np.where(frequent[first], whole[first], key[first]), count)
                by = np.argsort(to, kind="stable")
                first, n, to = first[by], n[by], to[by]
                sent = np.rec.fromarrays([ids[row[first]], digests[row[first]], pos[first]], dtype=_RUN)
                whole = whole[ranges(first, n)]
                edge = np.searchsorted(to, np.arange(count + 1))
                flat = np.concatenate([[0], np.cumsum(n)])[edge]
                n = n.astype("<u4")
                some = [b for b in range(count) if edge[b] < edge[b + 1]]
                cut = lambda a, e: pa.array([a[e[b] : e[b + 1]].tobytes() for b in some], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), cut(sent, edge), cut(n, edge), cut(whole, flat)],
                    ["bucket", "runs", "lengths", "hashes"],
                )

    def receive(batches):
        bucket, held = None, []
        for batch in batches:
            for b, r, n, h in zip(*(c.to_pylist() for c in batch.columns)):
                r, n = np.frombuffer(r, _RUN), np.frombuffer(n, "<u4").astype(np.int64)
                if h is None:
                    yield _span_batch(r["id"], r["digest"], r["start"], n)
                    continue
                if b != bucket and held:
                    yield parse(held)
                    held = []
                bucket = b
                held.append((r, n, np.frombuffer(h, np.uint64)))
        if held:
            yield parse(held)

    def parse(held):
        sent, lengths, hashes = (np.concatenate(x) for x in zip(*held))
        run, first, n = factors(sent["id"], lengths, hashes)
        return _span_batch(sent["id"][run], sent["digest"][run], sent["start"][run] + first, n)

    sent = rows.select("_id", "_digest", "_text").mapInArrow(lean(send), _SENT)
    found = sent.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(receive), _SPANS)
    return written(found, "spans", release=True)


def remove_duplicates(
    docs: DataFrame, window: int = 13, gram: int = 5, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",), with_text: bool = True,
) -> DataFrame:
    """``keep`` columns, n_words, n_removed, kept_sha256 and, if asked for, the kept words as text.

    Kept words are joined by one space. ``kept`` is null where nothing was removed.
    """
    out = _reduced(docs, window, gram, id_col, text_col, keep, with_text)
    return out.select(*(F.col("_row")[c].alias(c) for c in keep), *out.columns[1:])


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All documents; texts that lose words become their kept words, joined by one space."""
    out = _reduced(docs, 13, 5, id_col, text_col, tuple(docs.columns), True)
    new = {text_col: F.col("kept"), length_col: F.length("kept")}
    kinds = dict(docs.dtypes)
    return out.select(
        *(F.when(F.col("kept").isNull(), F.col("_row")[c]).otherwise(new[c].cast(kinds[c])).alias(c) if c in new else F.col("_row")[c].alias(c)
          for c in docs.columns)
    )


def _reduced(docs, window, gram, id_col, text_col, keep, with_text) -> DataFrame:
    """The columns of remove_duplicates, with ``keep`` as one struct _row."""
    rows = keyed(docs, id_col, text_col, keep)
    joined = attach(rows, duplicate_spans(rows, window, gram)).select("_row", "_text", "spans")

    def cut(batches):
        for batch in batches:
            sizes, lost, digests, kept = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                own, spans = text.as_py().encode().split(), spans.as_py()
                gone = covered(len(own), spans, window - 1)
                left = own if gone is None else list(compress(own, ~gone))
                out = b" ".join(left)
                sizes.append(len(own))
                lost.append(len(own) - len(left))
                digests.append(hashlib.sha256(out).hexdigest())
                kept.append(out.decode() if with_text and gone is not None else None)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(lost, pa.int64()), pa.array(digests, pa.string())]
            names = ["_row", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array(kept, pa.string()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = joined.schema["_row"].dataType.simpleString()
    schema = f"_row {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    return joined.mapInArrow(lean(cut), schema)


#: The same for DuckDB, for the columns that SQL can give on whole tables.
SQL = r"""
WITH w AS (
  SELECT doc_id, string_split_regex(regexp_replace(coalesce(text, ''), '^[\t-\r ]+|[\t-\r ]+$', '', 'g'), '[\t-\r ]+') AS ws FROM documents),
d AS (SELECT doc_id, CASE WHEN ws = [''] THEN [] ELSE ws END AS ws FROM w),
p AS (SELECT doc_id, i, sha256(array_to_string(ws[i : i + 12], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)),
f AS (SELECT h, min(doc_id) AS first_id FROM p GROUP BY h),
m AS (SELECT doc_id, list(DISTINCT i + j) AS gone FROM p JOIN f USING (h), (SELECT unnest(range(13)) AS j) WHERE first_id < doc_id GROUP BY doc_id),
k AS (SELECT d.doc_id, ws, coalesce(gone, []) AS gone FROM d LEFT JOIN m ON d.doc_id = m.doc_id),
t AS (SELECT doc_id, ws, CAST(len(gone) AS BIGINT) AS n_removed,
  CASE WHEN len(gone) = 0 THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(gone, i)) END AS kept FROM k)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM t
"""
