"""Repeated byte passages by a run-length index (run-compressed Burrows-Wheeler transform).

A byte is removed if a ``length``-byte string that covers it also starts anywhere else in the corpus,
same document included; matches stay inside documents. Every window of ``length`` bytes travels with the smallest
gram hash inside it, as a context: the run of windows that share that gram. Contexts that occur twice
as a whole are settled by their hash; contexts whose gram stands nowhere else are unique. The rest, the
edges of repeated passages, are cut from the texts and indexed bucket by bucket:

- suffixes of the bucket's contexts are sorted, and their preceding bytes form the transform;
- only its run heads and run ends keep a sample, a text position with the length of its match to the
  neighbouring suffix; within a run, a position's match is its predecessor's less one byte;
- so one pass over the text streams the matching statistics (the longest match of each position to any
  other place), and positions that reach ``length`` bytes are marked.

Windows under a gram that many documents share are settled one by one, by their own hash, so a common
line has no bucket of its own. They travel with their neighbours, by the gram and its rough place in them, and what is
settled goes on as joined spans, so rows follow passages and not windows. Hashes have 64 bits. Null text is empty; short texts lose nothing;
repeated rows are documents of their own, so each loses what it shares.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Prefixes, byte_grams, eights, lean, mix, ranges, slices, sliding_min, span_hashes
from .spans import attach, bucket_of, buckets, covered, frequent_grams, keyed, listed, parts, runs
from .written import written

#: A context as it is sent. known: bit 0, a copy was met before; bit 1, its gram stands in it twice.
_RUN = np.dtype([("id", "<i8"), ("digest", "<u4"), ("start", "<u4"), ("n", "<u4"), ("known", "<u4"), ("key", "<u8"), ("whole", "<u8")])
_NOTE = "_id long, _digest long, start int, n int, key long, ask boolean"
_SPANS = "_id long, _digest long, start int, n int"
_CONTEXT = "bucket int, key long, _id long, _digest long, start int, n int, ask boolean, data binary"
#: Bytes that two suffixes are compared by directly before hashes take over.
DIRECT_BYTES = 512
#: Bytes of contexts that are indexed together.
BLOCK_BYTES = 2 << 20


def heads(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, position and smallest gram of each window; then the hashes of all grams."""
    grams = byte_grams(data, gram)
    least = sliding_min(grams, length - gram + 1)
    n = np.maximum(np.diff(offsets) - length + 1, 0)
    here = ranges(offsets[:-1], n)
    row = np.repeat(np.arange(len(n), dtype=np.int32), n)
    return row, here - offsets[:-1][row], least[here], grams


def meets_itself(grams: np.ndarray, begin: np.ndarray, n: np.ndarray, key: np.ndarray, width: int) -> np.ndarray:
    """Whether a run's gram stands in it more than once: only then can the run repeat its own windows."""
    if not len(begin):
        return np.zeros(0, bool)
    view = np.lib.stride_tricks.sliding_window_view(grams, width)
    first = (view[begin] == key[:, None]).argmax(1) + begin
    last = begin + n - 2 + width - (view[begin + n - 1] == key[:, None])[:, ::-1].argmax(1)
    return first != last


def stretch_of(grams: np.ndarray, table: np.ndarray, at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For windows that start at ``at`` under listed grams ``key``: the gram and, in steps of 16, how far into the window it
    first stands. Equal windows agree on it, and neighbours mostly do."""
    places = np.flatnonzero(listed(grams, table))
    i = np.searchsorted(places, at)
    while (other := grams[places[i]] != key).any():
        i[other] += 1
    return mix(key ^ ((places[i] - at) // 16 + 1).astype(np.uint64))


def joined_spans(sent: np.ndarray) -> np.ndarray:
    """Windows of one document that follow each other, as one span each."""
    if not len(sent):
        return sent
    sent = sent[np.lexsort((sent["start"], sent["digest"], sent["id"]))]
    new = np.ones(len(sent), bool)
    new[1:] = (sent["id"][1:] != sent["id"][:-1]) | (sent["digest"][1:] != sent["digest"][:-1])
    new[1:] |= sent["start"][1:].astype(np.int64) > sent["start"][:-1].astype(np.int64) + sent["n"][:-1]
    first = np.flatnonzero(new)
    end = np.maximum.reduceat(sent["start"].astype(np.int64) + sent["n"], first)
    out = sent[first].copy()
    out["n"] = end - out["start"]
    return out


def suffix_order(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Suffix array of contexts: suffixes stop at the end of their context, equal ones keep text order."""
    n = len(data)
    at = np.arange(n)
    padded = np.concatenate([data.astype(np.int64) + 1, np.zeros(8, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = (key << 9) | np.where(at + i < end, padded[i : n + i], 0)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    h = 7
    while True:
        alone = new & np.append(new[1:], True)
        slot = np.flatnonzero(~alone)
        if not len(slot):
            return order
        some = order[slot]
        ahead = some + h
        second = np.where(ahead < end[some], rank[np.minimum(ahead, n - 1)], some - n)
        by = np.lexsort((second, rank[some]))
        some, second = some[by], second[by]
        head = np.ones(len(some), bool)
        head[1:] = (rank[some[1:]] != rank[some[:-1]]) | (second[1:] != second[:-1])
        order[slot], new[slot] = some, head
        rank[some] = slot[np.flatnonzero(head)[np.cumsum(head) - 1]]
        h *= 2


class RunIndex:
    """Run-compressed transform of a block of contexts, with samples at run heads and ends."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray):
        self.data, self.begin = data, np.cumsum(sizes) - sizes
        self.end = np.repeat(self.begin + sizes, sizes)
        order = suffix_order(data, self.end)
        before = data[order - 1].astype(np.int64)
        first = np.zeros(len(data), bool)
        first[self.begin[sizes > 0]] = True
        before = np.where(first[order], 256 + np.arange(len(order)), before)
        head = np.ones(len(order), bool)
        head[1:] = before[1:] != before[:-1]
        tail = np.append(head[1:], True)
        self.eights = eights(data)
        at = np.flatnonzero(head)
        self.heads = order[at], self._common(order[at], order[at - 1], at > 0)
        at = np.flatnonzero(tail)
        nxt = np.minimum(at + 1, len(order) - 1)
        self.tails = order[at], self._common(order[at], order[nxt], at + 1 < len(order))

    def _common(self, a: np.ndarray, b: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b: eight bytes at a time, and by bisection over
        prefix hashes for those that go on for long."""
        most = np.where(real, np.minimum(self.end[a] - a, self.end[b] - b), 0)
        out, live, at = np.zeros(len(a), np.int64), np.flatnonzero(most), 0
        while len(live) and at < DIRECT_BYTES:
            differ = self.eights[a[live] + at] ^ self.eights[b[live] + at]
            ends = differ != 0
            lowest = differ[ends] & (~differ[ends] + np.uint64(1))
            out[live[ends]] = at + np.log2(lowest.astype(float)).astype(np.int64) // 8
            live, at = live[~ends], at + 8
            out[live] = at
            live = live[most[live] > at]
        if len(live):
            prefixes, low, high = Prefixes(self.data), out[live], most[live]
            x, y = a[live], b[live]
            while (open_ := low < high).any():
                mid = (low + high + 1) // 2
                same = prefixes.same(x, y, mid)
                low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
            out[live] = low
        return np.minimum(out, most)

    def statistics(self) -> np.ndarray:
        """For each text position, the length of its longest match to any other position."""
        n = len(self.data)
        out = np.zeros(n, np.int64)
        for where, size in (self.heads, self.tails):
            sample, value = np.zeros(n, np.int64), np.zeros(n, np.int64)
            sample[where], value[where] = where, size
            last = np.maximum.accumulate(sample)
            out = np.maximum(out, value[last] - (np.arange(n) - last))
        return out


def _block_spans(held: list[tuple], length: int):
    """Spans of the asked contexts of one block: (id, digest, start, n)."""
    sizes = np.array([len(c[-1]) for c in held])
    match = RunIndex(np.frombuffer(b"".join(c[-1] for c in held), np.uint8), sizes).statistics()
    begin = np.cumsum(sizes) - sizes
    for (_, doc, digest, start, n, ask, _), b in zip(held, begin):
        if not ask:
            continue
        steps = np.diff(np.concatenate([[0], (match[b : b + n] >= length).astype(np.int8), [0]]))
        for i, j in zip(np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)):
            yield doc, digest, start + int(i), int(j - i)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[t]) for c, t in zip(columns, types)], names)


def _settle(sent: np.ndarray) -> pa.RecordBatch | None:
    """Notes on a bucket's contexts: repeated wholes as spans; those that share a gram only, as requests."""
    sent = sent[np.lexsort((sent["whole"], sent["key"]))]
    key, whole = sent["key"], sent["whole"]
    new_key, new = np.ones(len(sent), bool), np.ones(len(sent), bool)
    new_key[1:] = key[1:] != key[:-1]
    new[1:] = new_key[1:] | (whole[1:] != whole[:-1])
    of = np.cumsum(new) - 1
    known, own = sent["known"] & 1, sent["known"] & 2
    twice = (np.bincount(of) > 1) | (np.bincount(of, known) > 0)
    contexts = np.bincount((np.cumsum(new_key) - 1)[new])  # different contexts under each gram
    span = twice[of] & (known == 0)
    ask = new & ((contexts > 1)[np.cumsum(new_key) - 1] | ((own > 0) & ~twice[of]))
    spans, asked = joined_spans(sent[span]), np.flatnonzero(ask)
    got = np.concatenate([spans, sent[asked]])
    if not len(got):
        return None
    plain = np.arange(len(got)) < len(spans)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(got["id"]), pa.array(got["digest"].astype(np.int64)), pa.array(got["start"].astype(np.int32)),
            pa.array(got["n"].astype(np.int32)), pa.array(got["key"].view(np.int64), mask=plain), pa.array(np.concatenate([np.zeros(len(spans), bool), ~twice[of[asked]]])),
        ],
        ["_id", "_digest", "start", "n", "key", "ask"],
    )


def repeated_spans(rows: DataFrame, length: int = 200, gram: int = 32) -> DataFrame:
    """_id, _digest, start, n: windows start .. start + n - 1 occur elsewhere too."""
    count = buckets(rows)

    def keys_of(data, offsets):
        out = []
        for lo, hi in slices(offsets):
            row, pos, key, _ = heads(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], length, gram)
            out.append(key[runs(row, pos, key, np.zeros(len(row), bool))[0]])
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    held = rows.sparkSession.sparkContext.broadcast(frequent_grams(rows, keys_of))

    def contexts(ids, digests, data, offsets):
        """All runs of a part as records, and what deals them out."""
        for lo, hi in slices(offsets):
            some, offs = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            row, pos, key, grams = heads(some, offs, length, gram)
            frequent = listed(key, held.value)
            first, n = runs(row, pos, key, frequent)
            r, p = row[first], pos[first]
            begin = offs[:-1][r] + p
            whole = span_hashes(some, begin, begin + n + length - 1)
            own = meets_itself(grams, begin, n, key[first], length - gram + 1) & ~frequent[first]
            alone = frequent[first]
            route = key[first]
            route[alone] = stretch_of(grams, held.value, begin[alone], route[alone])
            key = np.where(alone, whole, key[first])
            yield np.rec.fromarrays([ids[lo:hi][r], digests[lo:hi][r], p, n, 2 * own, key, whole], dtype=_RUN), route

    def send(batches):
        for batch in batches:
            for part in parts(batch):
                found = list(contexts(*part))
                sent, route = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, _RUN), None)
                if not len(sent):
                    continue
                by = np.argsort(sent["whole"], kind="stable")
                sent, route = sent[by], route[by]
                new = np.ones(len(sent), bool)
                new[1:] = sent["whole"][1:] != sent["whole"][:-1]
                of = np.cumsum(new) - 1
                again = np.bincount(of)[of] > 1
                out = []
                if again.any():  # contexts met twice here: settled, one goes on as a reference
                    copies = joined_spans(sent[again])
                    copies["key"] = copies["whole"] = 0
                    out.append((int(bucket_of(copies["id"][:1].view(np.uint64), count)[0]), True, copies))
                sent, route = sent[new].copy(), route[new]
                sent["known"] |= again[new]
                to = bucket_of(route, count)
                by = np.argsort(to, kind="stable")
                sent, edge = sent[by], np.searchsorted(to[by], np.arange(count + 1))
                out += [(b, False, sent[edge[b] : edge[b + 1]]) for b in range(count) if edge[b] < edge[b + 1]]
                yield _table([(b, done, x.tobytes()) for b, done, x in out], "bucket int, done boolean, runs binary")

    def settle(batches):
        sent = []
        for batch in batches:
            for _, done, data in zip(*(c.to_pylist() for c in batch.columns)):
                got = np.frombuffer(data, _RUN)
                if not done:
                    sent.append(got)
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got["id"]), pa.array(got["digest"].astype(np.int64)), pa.array(got["start"].astype(np.int32)),
                     pa.array(got["n"].astype(np.int32)), pa.nulls(len(got), pa.int64()), pa.nulls(len(got), pa.bool_())],
                    ["_id", "_digest", "start", "n", "key", "ask"],
                )
        if sent and (notes := _settle(np.concatenate(sent))) is not None:
            yield notes

    text = rows.select("_id", "_digest", "_text")
    routed = text.mapInArrow(lean(send), "bucket int, done boolean, runs binary").repartitionById(count, "bucket")
    notes = written(routed.mapInArrow(lean(settle), _NOTE), "passages", release=True)
    wanted = (
        notes.where("key is not null").groupBy("_id", "_digest")
        .agg(F.collect_list(F.struct("start", "n", "key", "ask")).alias("wanted"))
    )

    def cut(batches):
        for batch in batches:
            out, size = [], 0
            for doc, digest, body, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                body = body.encode()
                for w in wanted:
                    piece = body[w["start"] : w["start"] + w["n"] + length - 1]
                    out.append((0, w["key"], doc, digest, w["start"], w["n"], w["ask"], piece))
                    size += len(piece)
                if size > BLOCK_BYTES:
                    yield contexts_table(out)
                    out, size = [], 0
            if out:
                yield contexts_table(out)

    def contexts_table(out):
        to = bucket_of(np.array([r[1] for r in out], np.int64).view(np.uint64), count).tolist()
        return _table([(b, *r[1:]) for b, r in zip(to, out)], _CONTEXT)

    def index(batches):
        held, size = [], 0
        for batch in batches:
            for _, key, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if size > BLOCK_BYTES and key != held[-1][0]:
                    yield _table(list(_block_spans(held, length)), _SPANS)
                    held, size = [], 0
                held.append((key, *rest))
                size += len(rest[-1])
        if held:
            yield _table(list(_block_spans(held, length)), _SPANS)

    edges = (
        text.join(wanted, ["_id", "_digest"]).mapInArrow(lean(cut), _CONTEXT)
        .repartition(count, "bucket").sortWithinPartitions("key").mapInArrow(lean(index), _SPANS)
    )
    edges = written(edges, "spans", release=True)
    return notes.where("key is null").select("_id", "_digest", "start", "n").unionByName(edges)


def remove_repeats(
    docs: DataFrame, length: int = 200, gram: int = 32, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",), with_bytes: bool = True,
) -> DataFrame:
    """``keep`` columns, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes."""
    rows = keyed(docs, id_col, text_col, keep)
    joined = attach(rows, repeated_spans(rows, length, gram)).select("_row", "_text", "spans")

    def drop(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode()
                gone = covered(len(data), spans, length - 1)
                left, n = data, 0
                if gone is not None:
                    left = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    n = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(data), len(data) - len(left), n, hashlib.sha256(left).hexdigest(), left))
            sizes, lost, n, digests, kept = zip(*out) if out else [()] * 5
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, lost, n)), pa.array(digests, pa.string())]
            names = ["_row", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = joined.schema["_row"].dataType.simpleString()
    schema = f"_row {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    out = joined.mapInArrow(lean(drop), schema)
    return out.select("_row.*", *out.columns[1:])
