"""Language-model scores by a hierarchical Pitman-Yor model.

Each token sits in the restaurant of its context: the word before it, whatever its frequency, or the
start of the text. All context restaurants share
one parent, whose customers are their tables; the parent's own tables serve each word once, and its
chance of a new table is the chance of a word never seen. So p(w | u) = (c_uw - d t_uw) / (a + c_u)
+ (a + d t_u) / (a + c_u) * p(w), and p(w) likewise from the tables, with p(unknown) the mass left.

Seating is sampled by Gibbs: given the parent's predictive, the customers of each (context, word) are
seated anew, one by one for the first 32 and in growing groups after that, whose customers share one chance; mean
tables of ``samples`` turns after ``burn`` are kept, and scores are computed once from these means. Pairs (context, word) are counted on the map side and lie in the
bucket of their word; those of the ``frequent`` words in the bucket of their context, or of the pair if the context is frequent
too, so that no word and no context has a task of its own. Totals of frequent contexts are broadcast, others are added up where they lie;
only a pair of a rare word after a rare context lies apart from its context's bucket: it sends its counts there, a row for each
context, and gets totals back if it needs them. So messages grow with the pairs, not with the buckets. Totals per context, and the
parent's customers of frequent words, are fixed during a sweep. Discounts come from the numbers of pairs and words seen once and twice.

Scoring: the ``near`` most frequent pairs are looked up in a broadcast of that bounded table; other tokens travel to their
pair's bucket, packed by batch. A pair never seen there needs only its context's totals besides the word: where neither
word nor context is frequent, they are asked in the context's bucket, a row for each token. Sums per document come back.
No key is hot in either direction.

Null and empty texts consist of the end token. Documents without id count as not held out, repeated rows each count. Without
training documents every probability is 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import discard
from .arrays import LOWER, U64, lean, mix, slices, span_hashes, utf8, words
from .spans import bucket_of, buckets
from .written import written

END, START = U64(0x1F83D9ABFB41BD6B), U64(0x5BE0CD19137E2179)
_WORD = np.dtype([("w", "<u8"), ("c", "<u8"), ("n", "<f4"), ("k", "<u4")])
_PAIR = np.dtype([("u", "<u8"), ("c", "<u8"), ("t", "<f4")])
_ABOUT = np.dtype([("u", "<u8"), ("c", "<f8"), ("t", "<f8")])
_NEAR = np.dtype([("key", "<u8"), ("base", "<f8"), ("score", "<f8")])
_ASK = np.dtype([("w", "<u8"), ("m", "<u4")])
_SUM = np.dtype([("doc", "<u4"), ("known", "<u4"), ("base", "<f8"), ("score", "<f8")])
_DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("held", "u1"), ("tokens", "<u4"), ("known", "<u4"), ("base", "<f8"), ("score", "<f8")])
_MODEL = "bucket int, words binary, pairs binary, counts binary"
_MESSAGE = "bucket int, kind int, u long, c double, t double, about binary"
_PLAIN = (("u", "<i8"), ("c", "<f8"), ("t", "<f8"))
#: Bytes of text that are turned into tokens at a time; a token takes some 100 bytes meanwhile.
PART_BYTES = 4 << 20
#: Pairs that a task counts before it sends them on.
TASK_PAIRS = 1 << 20


def _buckets(df: DataFrame) -> int:
    """Two for each shuffle partition, as a task holds a bucket's pairs with all that seating them takes."""
    return 2 * buckets(df)


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 5 == 1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, token and token before it, with an end token for each row."""
    rows, found, before = [], [], []
    for lo, hi in slices(offsets):
        lower = LOWER[data[offsets[lo] : offsets[hi]]]
        starts, ends, at = words(lower, offsets[lo : hi + 1] - offsets[lo])
        n = np.diff(at) + 1
        row = np.repeat(np.arange(lo, hi), n)
        last = np.cumsum(n) - 1
        token = np.empty(len(row), U64)
        inner = np.ones(len(row), bool)
        inner[last] = False
        token[inner], token[last] = span_hashes(lower, starts, ends), END
        prev = np.concatenate([[START], token[:-1]])
        prev[last - n + 1] = START
        rows.append(row)
        found.append(token)
        before.append(prev)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(before)


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def pair_key(word: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each (word, context)."""
    return mix(word + mix(ctx ^ U64(0x2545F4914F6CDD1D)))


def route(word: np.ndarray, ctx: np.ndarray, top: np.ndarray, count: int) -> np.ndarray:
    """Bucket of each pair: that of its word; if the word is frequent that of the context, and of the pair if both are."""
    to = bucket_of(word, count)
    hot = find(top, word) >= 0
    both = np.flatnonzero(hot)
    often = (find(top, ctx[both]) >= 0) | (ctx[both] == START)
    lone, both = both[~often], both[often]
    to[lone] = bucket_of(ctx[lone], count)
    to[both] = bucket_of(pair_key(word[both], ctx[both]), count)
    return to


def by_bucket(to: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Order by bucket, and by word but for its last 16 bits: a word may then come in more than one run."""
    return np.argsort((to.astype(U64) << U64(48)) | (word >> U64(16)))


def count_pairs(word: np.ndarray, ctx: np.ndarray, count: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct (word, context) with their counts."""
    key = pair_key(word, ctx)
    order = np.argsort(key)
    at = np.flatnonzero(_new(key[order]))
    ones = np.ones(len(word), np.int64) if count is None else count[order].astype(np.int64)
    return word[order[at]], ctx[order[at]], np.add.reduceat(ones, at) if len(at) else ones


def _new(values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def flat(table: np.ndarray) -> bytes:
    """Records column by column: small numbers then compress, beside hashes that do not."""
    return b"".join(table[name].tobytes() for name in table.dtype.names)


def records(blob: bytes, kind: np.dtype) -> np.ndarray:
    """What ``flat`` has written."""
    n, at = len(blob) // kind.itemsize, 0
    out = np.empty(n, kind)
    for name in kind.names:
        out[name] = np.frombuffer(blob, kind[name], n, at)
        at += n * kind[name].itemsize
    return out


def pack_places(doc: np.ndarray, ctx: np.ndarray) -> bytes:
    """Documents and contexts of tokens: each context once, and numbers as narrow as they can be."""
    own, at = np.unique(ctx, return_inverse=True)
    columns = [own, *(x.astype(np.min_scalar_type(int(x.max()))) for x in (at, doc))]
    head = np.array([len(own), len(doc), *(c.itemsize for c in columns[1:])], "<u4")
    return b"".join(c.tobytes() for c in (head, *columns))


def unpack_places(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, each once, and place among them and document of each token."""
    n_own, n, *sizes = np.frombuffer(blob, "<u4", 4).tolist()
    own = np.frombuffer(blob, U64, n_own, 16)
    start, found = 16 + 8 * n_own, []
    for size in sizes:
        found.append(np.frombuffer(blob, f"<u{size}", n, start))
        start += size * n
    return own, *found


def pack(word: np.ndarray, ctx: np.ndarray, count: np.ndarray, tables=None) -> tuple[bytes, bytes]:
    """Pairs sorted by word as one record per word and one per pair."""
    first = np.flatnonzero(_new(word))
    head, pairs = np.zeros(len(first), _WORD), np.zeros(len(word), _PAIR)
    pairs["u"], pairs["c"], pairs["t"] = ctx, count, 1 if tables is None else tables
    head["w"], head["k"] = word[first], np.diff(np.append(first, len(word)))
    if len(first):
        head["c"] = np.add.reduceat(pairs["c"], first)
        head["n"] = np.add.reduceat(pairs["t"].astype(float), first)
    return flat(head), flat(pairs)


def unpack(words_blob: bytes, pairs_blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    return records(words_blob, _WORD), records(pairs_blob, _PAIR)


def add_up(about: np.ndarray) -> np.ndarray:
    """One record of totals per context, sorted."""
    about = about[np.argsort(about["u"])]
    at = np.flatnonzero(_new(about["u"]))
    out = about[at]
    if len(at):
        out["c"], out["t"] = np.add.reduceat(about["c"], at), np.add.reduceat(about["t"], at)
    return out


def context_sums(pairs: np.ndarray) -> np.ndarray:
    about = np.zeros(len(pairs), _ABOUT)
    for name in ("u", "c", "t"):
        about[name] = pairs[name]
    return add_up(about)


def seat(rng, count: np.ndarray, fresh: np.ndarray, discount: float) -> np.ndarray:
    """Tables that ``count`` customers of one dish take, seated one after another.

    ``fresh``: weight of a new table, (a + d * tables of the restaurant) * parent's predictive.
    """
    tables = np.ones(len(count))
    live = np.flatnonzero(count > 1)
    j = 1
    while len(live):
        size = np.minimum(max(1, j // 16), count[live] - j)
        chance = fresh[live] / (fresh[live] + np.maximum(j + (size - 1) / 2 - discount * tables[live], 1e-9))
        tables[live] += rng.binomial(size, chance)
        j += max(1, j // 16)
        live = live[count[live] > j]
    return tables


@dataclass
class Model:
    """What every task knows: discounts, and totals of frequent words, contexts and pairs (bounded tables)."""

    contexts: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    discount: float
    top_discount: float
    strength: float
    n: int
    v: int
    all_tables: float
    words: np.ndarray
    near: np.ndarray

    def parent(self, mean: np.ndarray) -> np.ndarray:
        """Predictive of the shared parent; a word without tables there is unknown."""
        total = self.all_tables + self.strength
        return np.where(mean > 0, np.maximum(mean - self.top_discount, 1e-9), self.strength + self.top_discount * self.v) / total

    def fresh(self, tables: np.ndarray) -> np.ndarray:
        """Weight of a new table in restaurants with so many."""
        return self.strength + self.discount * tables

    def base(self, seen: np.ndarray) -> np.ndarray:
        return np.log10((seen + 0.5) / (self.n + 0.5 * (self.v + 1)))

    def chance(self, parent, own, tables, customers) -> np.ndarray:
        p = (np.maximum(own, 0) + self.fresh(tables) * parent) / (self.strength + customers)
        return np.log10(np.maximum(p, 1e-300))

    def wide(self) -> np.ndarray:
        """Totals of the broadcast contexts as records."""
        out = np.zeros(len(self.contexts), _ABOUT)
        out["u"], out["c"], out["t"] = self.contexts, self.customers, self.tables
        return out

    def _words(self, words_: np.ndarray, at: np.ndarray, token: np.ndarray):
        """Count and mean customers of words at ``at`` (-1: not there) of a word table; frequent ones have theirs from the model."""
        safe, hot = np.maximum(at, 0), find(self.words["w"], token)
        out = []
        for name in ("c", "n"):
            x = np.where(at >= 0, words_[name][safe], 0).astype(float) if len(words_) else np.zeros(len(at))
            out.append(np.where(hot >= 0, self.words[name][hot], x) if len(self.words) else x)
        return *out, hot >= 0

    def scores(self, words_: np.ndarray, pairs: np.ndarray, at: np.ndarray, ctx: np.ndarray) -> tuple[np.ndarray, ...]:
        """log10 of base and model probability, and whether known, for records at ``at`` (-1: unknown) of a word table,
        after the broadcast contexts at ``ctx``. A frequent word has a record in each bucket with pairs of it; they
        share its chance by their tables.
        """
        row = np.repeat(np.arange(len(words_)), words_["k"])
        keys = pair_key(row.astype(U64), pairs["u"])
        order = np.argsort(keys)
        hit = find(keys[order], pair_key(at.astype(U64), self.contexts[ctx]))
        own = np.zeros(len(at))
        got = order[hit[hit >= 0]]
        own[hit >= 0] = pairs["c"][got] - self.discount * pairs["t"][got].astype(float)
        token = np.where(at >= 0, words_["w"][np.maximum(at, 0)], 0).astype(U64) if len(words_) else np.zeros(len(at), U64)
        seen, mean, hot = self._words(words_, at, token)
        hot &= at >= 0
        share = np.ones(len(at))
        share[hot] = words_["n"][at[hot]] / mean[hot]
        return self.base(seen), self.chance(self.parent(mean) * share, own, self.tables[ctx], self.customers[ctx]), seen > 0

    def lookup(self, part: Part, word: np.ndarray, times: np.ndarray, ctx: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """log10 of base and model probability, whether known, and whether the totals of the context are missing here, for
        tokens whose pairs lie in this bucket: ``times`` tokens of each word, after the contexts ``ctx`` at ``at``."""
        seen, mean, _ = self._words(part.head, find(part.head["w"], word), word)
        hit = find(part.keys, pair_key(np.repeat(word, times), ctx[at]))
        own = np.zeros(len(at))
        got = part.order[hit[hit >= 0]]
        own[hit >= 0] = part.pairs["c"][got] - self.discount * part.pairs["t"][got].astype(float)
        place = find(part.about["u"], ctx)
        tables, customers = (np.where(place >= 0, part.about[x][place], 0) if len(part.about) else np.zeros(len(ctx)) for x in ("t", "c"))
        value = self.chance(np.repeat(self.parent(mean), times), own, tables[at], customers[at])
        return np.repeat(self.base(seen), times), value, np.repeat(seen > 0, times), (place < 0)[at]


@dataclass
class Part:
    """Pairs of one bucket, with totals of their contexts and of those that are broadcast."""

    head: np.ndarray
    pairs: np.ndarray
    about: np.ndarray
    keys: np.ndarray
    order: np.ndarray


def totals_of(pairs: np.ndarray, about: list[np.ndarray], model: Model) -> np.ndarray:
    """Totals of contexts: the model's, else those sent here, else what the pairs here add up to."""
    some = pairs[find(model.contexts, pairs["u"]) < 0]
    every = np.concatenate([model.wide(), *about, context_sums(some)])
    every = every[np.argsort(every["u"], kind="stable")]
    return every[_new(every["u"])]


def part_of(words_blob: bytes, pairs_blob: bytes, about: list[np.ndarray], model: Model) -> Part:
    head, pairs = unpack(words_blob, pairs_blob)
    keys = pair_key(np.repeat(head["w"], head["k"]), pairs["u"])
    order = np.argsort(keys)
    return Part(head, pairs, totals_of(pairs, about, model), keys[order], order)


def _parts(batch: pa.RecordBatch, column: int):
    data, offsets = utf8(batch.column(column))
    for lo, hi in slices(offsets, PART_BYTES):
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def frequent_words(train: DataFrame, n: int) -> np.ndarray:
    """The n most frequent tokens, most frequent first; each batch names its 2 * n most frequent."""

    def count(batches):
        for batch in batches:
            for _, _, data, offsets in _parts(batch, 0):
                w, c = np.unique(tokens(data, offsets)[1], return_counts=True)
                best = np.argsort(-c, kind="stable")[: 2 * n]
                yield pa.RecordBatch.from_arrays([pa.array(w[best].view(np.int64)), pa.array(c[best])], ["w", "c"])

    top = train.mapInArrow(lean(count), "w long, c long").groupBy("w").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "w").limit(n)
    return np.array([r.w for r in top.collect()], np.int64).view(U64)


def gather(train: DataFrame, top: np.ndarray, count: int) -> DataFrame:
    """Counts of (word, context) by bucket, with the numbers of customers and of pairs seen once and twice."""
    held = train.sparkSession.sparkContext.broadcast(top)

    def rows(word, ctx, n):
        to = route(word, ctx, held.value, count)
        by = by_bucket(to, word)
        word, ctx, n, edge = word[by], ctx[by], n[by], np.searchsorted(to[by], np.arange(count + 1))
        some = [b for b in range(count) if edge[b] < edge[b + 1]]
        packed = [pack(*(x[edge[b] : edge[b + 1]] for x in (word, ctx, n))) for b in some]
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([p[0] for p in packed], pa.binary()), pa.array([p[1] for p in packed], pa.binary())],
            ["bucket", "words", "pairs"],
        )

    def send(batches):
        kept, size = [], 0
        for batch in batches:
            for _, _, data, offsets in _parts(batch, 0):
                _, token, before = tokens(data, offsets)
                kept.append(count_pairs(token, before))
                size += len(kept[-1][0])
                if size > TASK_PAIRS:
                    yield rows(*count_pairs(*map(np.concatenate, zip(*kept))))
                    kept, size = [], 0
        if kept:
            yield rows(*count_pairs(*map(np.concatenate, zip(*kept))))

    def merge(batches):
        got = {}
        for batch in batches:
            for b, w, p in zip(*(c.to_pylist() for c in batch.columns)):
                got.setdefault(b, []).append(unpack(w, p))
        for b in list(got):
            some = got.pop(b)
            word = np.concatenate([np.repeat(w["w"], w["k"]) for w, _ in some])
            pairs = np.concatenate([p for _, p in some])
            word, ctx, c = count_pairs(word, pairs["u"], pairs["c"])
            by = np.argsort(word)
            yield _row(b, *pack(word[by], ctx[by], c[by]), np.array([c.sum(), (c == 1).sum(), (c == 2).sum()], "<i8").tobytes())

    sent = train.mapInArrow(lean(send), "bucket int, words binary, pairs binary")
    return sent.repartitionById(count, "bucket").mapInArrow(lean(merge), _MODEL)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _row(b: int, *blobs: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), *(pa.array([x], pa.binary()) for x in blobs)], _names(_MODEL))


def context_totals(table: DataFrame, model: Model, count: int, whole: bool = False) -> DataFrame:
    """Customers and tables of the contexts that are not broadcast, where they are not known from the pairs at hand: for the bucket of
    the context (kind 1), and for pairs of rare words that lie elsewhere (kind 2, a row for each context). With ``whole`` all
    contexts of each bucket too (kind 0); without it, only pairs of more than one customer are answered, as only they are seated.
    """
    held = table.sparkSession.sparkContext.broadcast((model.contexts, model.words["w"]))

    def send(batches):
        wide, top = held.value
        for batch in batches:
            for b, w, p in zip(*(c.to_pylist() for c in batch.columns)):
                head, pairs = unpack(w, p)
                away = np.repeat(find(top, head["w"]) < 0, head["k"])
                rare = find(wide, pairs["u"]) < 0
                yield _messages([b], [-1], blobs=[flat(context_sums(pairs[rare & ~away]))])
                pairs = pairs[rare & away]
                about = context_sums(pairs)
                back = np.full(len(about), b)
                if not whole:
                    back[find(np.unique(pairs["u"][pairs["c"] > 1]), about["u"]) < 0] = -1
                if len(about):
                    yield _messages(bucket_of(about["u"], count), back, about)

    def answer(batches):
        got = {}
        for batch in batches:
            for b, rows in _by_bucket(batch):
                back, about, blobs = _read(rows)
                kept = got.setdefault(b, [[], [], []])
                kept[0].append(back[len(blobs) :])
                kept[1].append(about)
                kept[2] += [records(x, _ABOUT) for x in blobs]
        for b in list(got):
            back, about, local = (np.concatenate(x) if x else np.zeros(0, _ABOUT) for x in got.pop(b))
            local = add_up(local)
            sums = add_up(np.concatenate([local, about]))
            if whole:
                yield _messages([b], [0], blobs=[flat(sums)])
            at = find(local["u"], sums["u"])
            same = at >= 0
            same[same] = (local["c"][at[same]] == sums["c"][same]) & (local["t"][at[same]] == sums["t"][same])
            yield _messages([b], [1], blobs=[flat(sums[~same])])
            back, about = back[back >= 0], about[back >= 0]
            full = sums[find(sums["u"], about["u"])]
            some = (full["c"] != about["c"]) | (full["t"] != about["t"])
            if some.any():
                yield _messages(back[some], np.full(some.sum(), 2), full[some])

    sent = table.select("bucket", "words", "pairs").mapInArrow(lean(send), _MESSAGE)
    return sent.repartitionById(count, "bucket").mapInArrow(lean(answer), _MESSAGE)


def _messages(bucket, kind, about: np.ndarray | None = None, blobs: list[bytes] | None = None) -> pa.RecordBatch:
    """Rows of single contexts, or of blobs."""
    n = len(bucket)
    about = np.zeros(n, _ABOUT) if about is None else about
    columns = [pa.array(np.asarray(bucket, np.int32)), pa.array(np.asarray(kind, np.int32)), *(pa.array(np.ascontiguousarray(about[x]).view(t)) for x, t in _PLAIN)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(blobs or [None] * n, pa.binary())], _names(_MESSAGE))


def _by_bucket(batch: pa.RecordBatch):
    """Each run of rows of one bucket."""
    bucket = batch.column(0).to_numpy()
    edge = np.append(np.flatnonzero(_new(bucket)), len(bucket))
    for lo, hi in zip(edge[:-1], edge[1:]):
        yield int(bucket[lo]), batch.slice(lo, hi - lo)


def _read(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Kinds, single contexts and blobs of message rows; blobs come first among the kinds."""
    single = rows.column(5).is_null().to_numpy(zero_copy_only=False)
    kind = rows.column(1).to_numpy()
    about = np.zeros(single.sum(), _ABOUT)
    for i, (name, t) in enumerate(_PLAIN):
        about[name] = rows.column(2 + i).to_numpy()[single].view(about.dtype[name])
    return np.concatenate([kind[~single], kind[single]]), about, [x for x in rows.column(5).to_pylist() if x is not None]


def _beside(table: DataFrame, totals: DataFrame) -> DataFrame:
    """Rows of the word table (kind 0) and of the totals of their contexts (kinds 1 and 2), by bucket."""
    none = F.lit(0.0)
    pairs = table.select("bucket", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("u"), none.alias("c"), none.alias("t"), F.col("pairs").alias("about"), "words")
    return pairs.unionByName(totals.where("kind > 0").withColumn("words", F.lit(None).cast("binary")))


def sweep(counts: DataFrame, model: Model, burn: int, samples: int, seed: int, count: int) -> DataFrame:
    """Seat every bucket's customers anew; mean tables of pairs, mean customers of words at the parent."""
    held = counts.sparkSession.sparkContext.broadcast(model)

    def seated(b, own, sent):
        m = held.value
        head, pairs = unpack(*own)
        about = totals_of(pairs, sent, m)
        of = np.repeat(np.arange(len(head)), head["k"])
        rng = np.random.Generator(np.random.PCG64([seed, b]))
        some = np.flatnonzero(pairs["c"] > 1)  # one customer has one table
        customers, word = pairs["c"][some].astype(np.int64), of[some]
        open_ = m.fresh(about["t"][find(about["u"], pairs["u"][some])])
        hot = find(m.words["w"], head["w"])
        alone = head["k"] - np.bincount(word, minlength=len(head))
        tables = pairs["t"][some].astype(float)
        total = np.zeros(len(some))
        for turn in range(burn + samples):
            mean = alone + np.bincount(word, tables, len(head))
            if len(m.words):
                mean = np.where(hot >= 0, m.words["n"][hot], mean)
            tables = seat(rng, customers, open_ * m.parent(mean)[word], m.discount)
            if turn >= burn:
                total += tables / samples
        all_ = np.ones(len(pairs))
        all_[some] = total
        return _row(b, *pack(head["w"][of], pairs["u"], pairs["c"], all_), b"")

    def run(batches):
        bucket, own, sent = None, None, []
        for batch in batches:
            for b, rows in _by_bucket(batch):
                if b != bucket:
                    if own is not None:
                        yield seated(bucket, own, sent)
                    bucket, own, sent = b, None, []
                own, rows = _table(rows, own)
                sent += _sent(rows)
        if own is not None:
            yield seated(bucket, own, sent)

    totals = context_totals(counts, model, count)
    rows = _beside(counts, totals).repartitionById(count, "bucket").sortWithinPartitions("bucket", "kind")
    return rows.mapInArrow(lean(run), _MODEL)


def _table(rows: pa.RecordBatch, own):
    """Words and pairs, if rows of a bucket begin with them, and the other rows."""
    if len(rows) and rows.column(1)[0].as_py() == 0:
        return (rows.column(6)[0].as_py(), rows.column(5)[0].as_py()), rows.slice(1)
    return own, rows


def _sent(rows: pa.RecordBatch) -> list[np.ndarray]:
    """Totals of contexts in message rows."""
    _, about, blobs = _read(rows)
    return [*(records(x, _ABOUT) for x in blobs), *([about] if len(about) else [])]


def _discount(once: float, twice: float) -> float:
    return float(np.clip(once / max(once + 2 * twice, 1), 0.05, 0.95))


def summary(table: DataFrame, top: np.ndarray, ctxs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The frequent words, added up over buckets; [customers, pairs seen once, twice, words, tables, words with
    one table, with two]; customers and tables of the broadcast contexts."""
    held = table.sparkSession.sparkContext.broadcast((top, ctxs))
    names = [f"x{i}" for i in range(7)]

    def read(batches):
        top, ctxs = held.value
        c, t, used = np.zeros(len(ctxs)), np.zeros(len(ctxs)), np.zeros(len(ctxs), bool)
        hc, hn, met = np.zeros(len(top)), np.zeros(len(top)), np.zeros(len(top), bool)
        rest = np.zeros(7)
        for batch in batches:
            for w, p, counts in zip(*(x.to_pylist() for x in batch.columns)):
                head, pairs = unpack(w, p)
                at = find(top, head["w"])
                n = head["n"][at < 0]
                rest += [*(np.frombuffer(counts, "<i8") if counts else np.zeros(3)), len(n), n.sum(dtype=float), (n < 1.5).sum(), ((n >= 1.5) & (n < 2.5)).sum()]
                some, at = head[at >= 0], at[at >= 0]
                if len(at):
                    met[at] = True
                    hc += np.bincount(at, some["c"], len(top))
                    hn += np.bincount(at, some["n"], len(top))
                at = find(ctxs, pairs["u"])
                some, at = pairs[at >= 0], at[at >= 0]
                if len(at):
                    used[at] = True
                    c += np.bincount(at, some["c"], len(ctxs))
                    t += np.bincount(at, some["t"], len(ctxs))
        key = np.concatenate([top[met], ctxs[used], np.zeros(1, U64)])
        kind = np.repeat(np.array([0, 2, 1], np.int32), [met.sum(), used.sum(), 1])
        cols = np.zeros((7, len(key)))
        cols[0, :-1], cols[1, :-1], cols[:, -1] = np.append(hc[met], c[used]), np.append(hn[met], t[used]), rest
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(kind), *(pa.array(x) for x in cols)], ["w", "kind", *names])

    got = table.select("words", "pairs", "counts").mapInArrow(lean(read), "w long, kind int, " + ", ".join(f"{x} double" for x in names))
    rows = got.groupBy("kind", "w").agg(*(F.sum(x).alias(x) for x in names)).toArrow().combine_chunks()
    kind, w = rows["kind"].to_numpy(), rows["w"].to_numpy().view(U64)
    sums = np.array([rows[x].to_numpy() for x in names])
    words_ = np.zeros((kind == 0).sum(), _WORD)
    words_["w"], words_["c"], words_["n"] = w[kind == 0], sums[0, kind == 0], sums[1, kind == 0]
    stats = sums[:, kind == 1].sum(axis=1)
    n = words_["n"].astype(float)
    stats[3:] += [len(n), n.sum(), (n < 1.5).sum(), ((n >= 1.5) & (n < 2.5)).sum()]
    about = np.zeros((2, len(ctxs)))
    about[:, find(ctxs, w[kind == 2])] = sums[:2, kind == 2]
    return words_[np.argsort(words_["w"])], stats, about


def fit(
    train: DataFrame, contexts: int = 32_768, frequent: int = 32_768, burn: int = 2, samples: int = 3,
    strength: float = 1.0, seed: int = 5, near: int = 1 << 19,
) -> tuple[Model, DataFrame]:
    """The model, and its word table by bucket. ``train`` has one column, the text.

    ``contexts``, ``frequent`` and ``near`` bound what is broadcast, not what is counted; frequent words are always among the
    contexts that are broadcast.
    """
    count = _buckets(train)
    first = frequent_words(train, max(frequent, contexts + 1))
    top, ctxs = np.sort(first[:frequent]), np.sort(np.append(first[first != END][: max(contexts, frequent)], START))
    counts = written(gather(train, top, count), "counts", release=True)
    words_, x, about = summary(counts, top, ctxs)
    model = Model(ctxs, *about, _discount(x[1], x[2]), _discount(x[5], x[6]), strength, int(x[0]), int(x[3]), x[4], words_, np.zeros(0, _NEAR))
    for turn, kept in enumerate((1, samples)):
        seated = written(sweep(counts, model, burn, kept, seed + turn, count), "seating", release=True)
        discard(counts)
        counts = seated
        model.words, x, (model.customers, model.tables) = summary(counts, top, ctxs)
        model.all_tables = x[4]
        if turn == 0:
            model.top_discount = _discount(x[5], x[6])
    model.near = _near(counts, model, near // count)
    return model, counts


def _near(table: DataFrame, model: Model, n: int) -> np.ndarray:
    """Scores of each bucket's n most frequent pairs among those whose contexts are broadcast."""
    held = table.sparkSession.sparkContext.broadcast(model)

    def pick(batches):
        m = held.value
        for batch in batches:
            for w, p in zip(*(c.to_pylist() for c in batch.columns)):
                head, pairs = unpack(w, p)
                some = np.flatnonzero((pairs["c"] > 1) & (find(m.contexts, pairs["u"]) >= 0))
                some = np.sort(some[np.argsort(-pairs["c"][some].astype(np.int64), kind="stable")[:n]])
                of = np.repeat(np.arange(len(head)), head["k"])[some]
                k = np.bincount(of, minlength=len(head))
                few = head[k > 0].copy()
                few["k"] = k[k > 0]
                part = part_of(flat(few), flat(pairs[some]), [], m)
                word, ctx = head["w"][of], pairs["u"][some]
                out = np.zeros(len(some), _NEAR)
                out["key"] = pair_key(word, ctx)
                out["base"], out["score"], _, _ = m.lookup(part, word, np.ones(len(word), int), ctx, np.arange(len(word)))
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["near"])

    got = table.select("words", "pairs").mapInArrow(pick, "near binary").collect()
    out = np.concatenate([np.zeros(0, _NEAR), *(np.frombuffer(r.near, _NEAR) for r in got)])
    return out[np.argsort(out["key"])]


def score(
    docs: DataFrame, model: Model, table: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Documents are scored in ``rounds`` shares, one after the other, so that disks hold the travelling tokens of one share.
    """
    count = _buckets(docs)
    held = docs.sparkSession.sparkContext.broadcast(model)
    wire = _MESSAGE + ", words binary"

    def ask(batches):
        m, turn, task = held.value, 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            for lo, hi, data, offsets in _parts(batch, 2):
                row, token, before = tokens(data, offsets)
                at = find(m.near["key"], pair_key(token, before))
                near = at >= 0
                base, value, known = m.near["base"][at[near]], m.near["score"][at[near]], np.ones(near.sum())
                ids = batch.column(0).slice(lo, hi - lo)
                out = np.zeros(hi - lo, _DOC)
                out["id"], out["null"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
                out["held"] = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                out["tokens"] = np.bincount(row, minlength=hi - lo)
                for name, x in (("known", known), ("base", base), ("score", value)):
                    out[name] = np.bincount(row[near], x, hi - lo)
                key = task + turn
                turn += 1
                sent = [(key % count, 3, key, 0.0, 0.0, out.tobytes(), b"")]
                row, token, ctx = row[~near], token[~near], before[~near]
                to = route(token, ctx, m.words["w"], count)
                by = by_bucket(to, token)
                row, token, ctx, edge = row[by], token[by], ctx[by], np.searchsorted(to[by], np.arange(count + 1))
                for b in range(count):
                    s = slice(edge[b], edge[b + 1])
                    if s.start < s.stop:
                        first = np.flatnonzero(_new(token[s]))
                        asked = np.zeros(len(first), _ASK)
                        asked["w"], asked["m"] = token[s][first], np.diff(np.append(first, s.stop - s.start))
                        sent.append((b, 4, key, 0.0, 0.0, pack_places(row[s], ctx[s]), flat(asked)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*sent), kinds)], _names(wire))

    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]

    def answer(batches):
        m, bucket, own, sent, part = held.value, None, None, [], None
        for batch in batches:
            for b, rows in _by_bucket(batch):
                if b != bucket:
                    bucket, own, sent, part = b, None, [], None
                own, rows = _table(rows, own)
                edge = int(np.searchsorted(rows.column(1).to_numpy(), 3))
                sent += _sent(rows.slice(0, edge))
                out = []
                for kind, key, p, w in zip(*(rows.slice(edge).column(i).to_pylist() for i in (1, 2, 5, 6))):
                    if kind == 3:
                        out.append((0, key, 1, 0, 0, p))
                        continue
                    if part is None:
                        part = part_of(*(own or (b"", b"")), sent, m)
                        own, sent = None, []
                    asked, (ctx, at, doc) = records(w, _ASK), unpack_places(p)
                    base, value, known, left = m.lookup(part, asked["w"], asked["m"], ctx, at)
                    out.append((0, key, 2, 0, 0, sums_of(doc, known, base, value)))
                    home = bucket_of(ctx, count)[at]
                    left = np.flatnonzero(left & (home != b))
                    if len(left):
                        yield rests(home[left], key, doc[left], ctx[at[left]])
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), answered)], _names(reply))

    def rests(home, key, doc, ctx):
        n = len(home)
        columns = [home.astype(np.int32), np.full(n, key), np.full(n, 3, np.int32), doc.astype(np.int32), ctx.view(np.int64)]
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.nulls(n, pa.binary())], _names(reply))

    reply = "bucket int, batch long, kind int, doc int, u long, sums binary"
    answered = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def sums_of(doc, known, base, value):
        n = np.bincount(doc)
        sums = np.zeros((n > 0).sum(), _SUM)
        sums["doc"] = np.flatnonzero(n)
        for name, x in (("known", known), ("base", base), ("score", value)):
            sums[name] = np.bincount(doc, x)[sums["doc"]]
        return sums.tobytes()

    def finish(batches):
        """What the context's totals add to tokens whose pair was not seen, a row for each document in a batch."""
        m, bucket, about = held.value, None, np.zeros(0, _ABOUT)
        for batch in batches:
            for b, rows in _by_bucket(batch):
                if b != bucket:
                    bucket, about = b, np.zeros(0, _ABOUT)
                if rows.column(2)[0].as_py() == 0:
                    about, rows = records(rows.column(5)[0].as_py(), _ABOUT), rows.slice(1)
                if not len(rows):
                    continue
                key, doc, u = (rows.column(i).to_numpy() for i in (1, 3, 4))
                at = find(about["u"], u.view(U64))
                value = np.zeros(len(u))
                got = about[at[at >= 0]]
                value[at >= 0] = np.log10(m.fresh(got["t"]) / (m.strength + got["c"]))
                by = np.lexsort((doc, key))
                key, doc, value = key[by], doc[by], value[by]
                first = np.flatnonzero(_new(key) | _new(doc))
                sums = np.zeros(len(first), _SUM)
                sums["doc"], sums["score"] = doc[first], np.add.reduceat(value, first)
                blobs = pa.array([x.tobytes() for x in sums], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(np.full(len(first), 2, np.int32)), blobs], ["batch", "kind", "sums"])

    def total(batches):
        rows, last = None, None
        for batch in batches:
            for key, kind, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last and rows is not None:
                    yield result(rows)
                last = key
                if kind == 1:
                    rows = np.frombuffer(blob, _DOC).copy()
                else:
                    sums = np.frombuffer(blob, _SUM)
                    for name in ("known", "base", "score"):
                        rows[name][sums["doc"]] += sums[name]
        if rows is not None:
            yield result(rows)

    def result(rows):
        n = held.value.n
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["id"], mask=rows["null"] > 0), pa.array(rows["held"] > 0), pa.array(rows["tokens"].astype(np.int64)),
             pa.array(rows["known"].astype(np.int64)), pa.array(np.full(len(rows), n, np.int64)), pa.array(rows["base"]), pa.array(rows["score"])],
            [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    schema = f"`{id_col}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    totals = written(context_totals(table, model, count, whole=True), "contexts", release=True)
    known = _beside(table, totals)
    none = F.lit(0).cast("long")
    contexts = totals.where("kind = 0").select(
        "bucket", none.alias("batch"), "kind", F.lit(0).alias("doc"), none.alias("u"), F.col("about").alias("sums")
    )
    found = None
    for share in range(rounds):
        some = docs.where(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(rounds)) == share)
        asked = some.select(F.col(id_col).cast("long"), held_out(F.col(id_col)), text_col).mapInArrow(lean(ask), wire)
        answers = written(
            known.unionByName(asked).repartitionById(count, "bucket").sortWithinPartitions("bucket", "kind")
            .mapInArrow(lean(answer), reply), "answers", release=True,
        )
        rest = (
            contexts.unionByName(answers.where("kind = 3")).repartitionById(count, "bucket").sortWithinPartitions("bucket", "kind")
            .mapInArrow(lean(finish), "batch long, kind int, sums binary")
        )
        sums = answers.where("kind < 3").select("batch", "kind", "sums").unionByName(rest)
        scored = written(sums.repartition(count, "batch").sortWithinPartitions("batch", "kind").mapInArrow(lean(total), schema), "scores", release=True)
        discard(answers)
        found = scored if found is None else found.unionByName(scored)
    return found
