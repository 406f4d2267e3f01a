"""Byte-level BPE by prefix dynamic programming, and decoding.

The encoding of a byte string ends with one token; cut that token off and what is left is the
encoding of a shorter prefix. So it is enough to store, for each prefix, its one valid last
token: a token t may end a prefix if t itself is what the merges make of its bytes, and the last
token of the prefix before it and t stay apart when merged together. Appending bytes extends the
table and changes nothing before; after an edit only pieces near it are computed anew.

Texts are cut by the vocabulary's pattern first, each match encoded alone. A match that is a
token as a whole is that token. Null and empty texts give no tokens. Null ids and repeated rows
pass through; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

_ready: dict[tuple, Vocabulary] = {}


class Vocabulary:
    """Ranks of byte strings, and what has been learnt about tokens so far (bounded)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, room: int = 400_000):
        self.ranks, self.pattern, self.room = ranks, regex.compile(pattern), room
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        self.apart: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.pieces = _Pieces(self)

    def merges(self, data: bytes) -> list[bytes]:
        """The parts that remain when the lowest-ranked neighbours merge again and again."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            pairs = [(self.ranks.get(a + b, -1), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            pairs = [p for p in pairs if p[0] >= 0]
            if not pairs:
                break
            at = min(pairs)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, last: int | None, token: int) -> bool:
        """Whether ``token`` may come after ``last`` (None: at the start)."""
        if last is None:
            known = self.whole.get(token)
            if known is None:
                known = self.whole[token] = len(self.merges(self.bytes_of[token])) == 1
            return known
        known = self.apart.get((last, token))
        if known is None:
            if len(self.apart) > 2 * self.room:
                self.apart.clear()
            a, b = self.bytes_of[last], self.bytes_of[token]
            known = self.apart[last, token] = self.merges(a + b) == [a, b]
        return known


class PrefixTable:
    """Last token of every prefix of a growing piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        begin, self.data = len(self.data), self.data + more
        v, data, last = self.vocabulary, self.data, self.last
        for end in range(begin + 1, len(data) + 1):
            for start in range(max(0, end - v.longest), end):
                token = v.ranks.get(data[start:end])
                if token is not None and v.follows(last[start - 1] if start else None, token):
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {data[end - 1]:#x}")

    def cut(self, length: int) -> None:
        """Back to the first ``length`` bytes."""
        self.data, self.last = self.data[:length], self.last[:length]

    def ids(self) -> list[int]:
        whole = self.vocabulary.ranks.get(self.data)
        if whole is not None:
            return [whole]
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.bytes_of[out[-1]])
        return out[::-1]


class _Pieces(dict):
    """Piece to its ids as little-endian 32-bit integers; forgotten when full."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        if len(self) > self.vocabulary.room:
            self.clear()
        ids = PrefixTable(self.vocabulary, piece.encode()).ids()
        packed = np.array(ids, "<u4").tobytes()
        if len(piece) < 256:
            self[piece] = packed
        return packed


def load(path: str, pattern: str, room: int = 400_000) -> Vocabulary:
    """Read a rank file (base64 token and rank on each line); kept for later tasks of the worker."""
    key = (path, pattern, room)
    if key not in _ready:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        _ready[key] = Vocabulary(ranks, pattern, room)
    return _ready[key]


def encode(v: Vocabulary, text: str | None) -> bytes:
    """Ids of a text, packed as little-endian unsigned 32-bit integers."""
    return b"".join(map(v.pieces.__getitem__, v.pattern.findall(text))) if text else b""


def decode(v: Vocabulary, ids: bytes) -> bytes:
    return b"".join(map(v.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def edit(v: Vocabulary, text: str, ids: bytes, start: int, stop: int, new: str) -> tuple[str, bytes]:
    """Text and ids after text[start:stop] became ``new``; only pieces near the edit are encoded.

    Pieces that end two or more code points before the edit stay (the pattern looks one code
    point ahead). Behind the edit, the old ids are taken up again as soon as an old piece begins
    where a new one would: the pattern never looks back.
    """
    changed = text[:start] + new + text[stop:]
    shift, out, keep = len(changed) - len(text), [], 0
    old = {m.start(): m for m in v.pattern.finditer(text)}
    begins = {}
    at = 0
    for begin, m in old.items():
        begins[begin] = at
        size = len(v.pieces[m.group()])
        if m.end() <= start - 2:
            keep = m.end()
            out = [ids[: at + size]]
        at += size
    pos = keep
    while pos < len(changed):
        if pos - shift >= stop + 1 and pos - shift in begins:
            out.append(ids[begins[pos - shift] :])
            break
        m = v.pattern.match(changed, pos)
        out.append(v.pieces[m.group()])
        pos = m.end()
    return changed, b"".join(out)


def byte_bpe(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    room: int = 400_000,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """id, n_tokens, ids (array, if asked for), hashes of the packed ids and of the decoded bytes; ``keep`` columns as they are."""

    def run(batches):
        v = load(path, pattern, room)
        for b in batches:
            packed = [encode(v, t) for t in b.column(1).to_pylist()]
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            columns = [
                b.column(0),
                pa.array(sizes),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                pa.array([hashlib.sha256(decode(v, p)).hexdigest() for p in packed]),
            ]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                names.append("ids")
            columns += [b.column(2 + i) for i in range(len(keep))]
            names += keep
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.select(id_col).dtypes[0][1]
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + "".join(f", `{c}` {kind}" for c, kind in docs.select(*keep).dtypes)
    return docs.select(id_col, text_col, *keep).mapInArrow(run, schema)
