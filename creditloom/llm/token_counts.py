"""Token counts by a SentencePiece BPE model without moving any pre-token.

A piece of such a model never continues over a space mark or a line feed, so a text falls into
pre-tokens (a run of spaces with the word after it) whose lengths add up. Tier one is a table of
the lengths of frequent pre-tokens, found by one pass over a share of the documents, at most
``table_size`` entries, and broadcast. Tier two is a cache in each worker that encodes misses
once. Both hold what the model itself returns, so they decide speed only.

Null and empty texts have 0 tokens. Null ids and repeated rows pass through; other columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_RUN = re.compile(r" +[^ ]*|[^ ]+")
_ready: dict[tuple, tuple[Lengths, Lengths]] = {}


class Lengths(dict):
    """Pre-token to token count: the broadcast tier, then misses, forgotten beyond ``room``."""

    def __init__(self, encode, first: dict[str, int], room: int):
        super().__init__(first)
        self.encode, self.first, self.room = encode, first, room

    def __missing__(self, word: str) -> int:
        if len(self) > len(self.first) + self.room:
            self.clear()
            self.update(self.first)
        self[word] = n = self.encode(word)
        return n


def _counters(model: str, frequent: dict[str, int], room: int) -> tuple[Lengths, Lengths]:
    """For pre-tokens after a space (that space cut off), and for words that begin a later line."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    line = len(sp.encode("\n"))
    after_space = Lengths(lambda w: len(sp.encode(w, num_threads=1)) if w else 1, frequent, room)
    at_line = Lengths(lambda w: len(sp.encode("\n" + w, num_threads=1)) - line, {}, room // 4)
    at_line.line = line - 1
    return after_space, at_line


def pieces(text: str) -> Iterator[tuple[str, list[str]]]:
    """For each line: the word it begins with (none on the first) and pre-tokens after a space."""
    for i, line in enumerate(text.replace(MARK, " ").split("\n")):
        parts = (line if i else " " + line).split(" ")
        first, rest = parts[0], parts[1:]
        if "" in rest:
            runs = _RUN.findall(line if i else " " + line)
            rest = [r[1:] for r in runs if r[0] == " "]
        yield first, rest


def count_tokens(text: str | None, after_space: Lengths, at_line: Lengths) -> int:
    if not text:
        return 0
    n, look = -at_line.line, after_space.__getitem__
    for first, rest in pieces(text):
        n += at_line.line + sum(map(look, rest))
        if first:
            n += at_line[first]
    return n


def frequent_lengths(
    docs: DataFrame, model: str, id_col: str, text_col: str, table_size: int, share: int
) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of one in ``share`` documents, chosen by id hash.

    Each task names its own ``table_size`` // 8 most frequent ones; only those lists are summed.
    """

    def tops(batches):
        seen = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                for _, rest in pieces(text or ""):
                    seen.update(rest)
            if len(seen) > 1_000_000:
                seen = Counter(dict(seen.most_common(table_size)))
        best = seen.most_common(table_size // 8)
        if best:
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in best]), pa.array([n for _, n in best], pa.int64())], ["word", "n"]
            )

    some = docs.where(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % share == 0)
    top = (
        some.select(text_col).mapInArrow(tops, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word").limit(table_size)
    )
    chosen = [r.word for r in top.collect()]
    after_space, _ = _counters(model, {}, table_size)
    return {w: after_space[w] for w in chosen}


def token_counts(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_size: int = 32_768,
    share: int = 64,
    room: int = 400_000,
    limit: int = 4096,
) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row."""
    frequent = frequent_lengths(docs, model, id_col, text_col, table_size, share)
    table = docs.sparkSession.sparkContext.broadcast(frequent)
    run = uuid.uuid4().hex

    def count(batches):
        key = (model, room, run)
        if key not in _ready:
            _ready.clear()
            _ready[key] = _counters(model, table.value, room)
        tiers = _ready[key]
        for b in batches:
            text = b.column(1)
            n = pa.array([count_tokens(t, *tiers) for t in text.to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(text).cast(pa.int64()), 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), size, n, pc.greater(n, limit)], [id_col, "n_bytes", "n_tokens", "over_limit"]
            )

    kind = docs.select(id_col).dtypes[0][1]
    schema = f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select(id_col, text_col).mapInArrow(count, schema)
