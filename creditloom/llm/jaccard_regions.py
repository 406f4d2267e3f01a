"""Exact Jaccard join of shingle sets as a metric-space join.

Jaccard distance is a metric; two documents link when it is at most ``1 - similarity`` (the radius).

First level. Every shingle is a pivot, the set of itself alone; a document is nearer than 1 to exactly
the pivots of its shingles. In one global order of pivots (frequent ones last, else by hash), linked
documents agree on at least t pivots among the first n - ceil(similarity * n) + t of each, so a document
is replicated into these regions only, and dropped if fewer than t of them hold anybody else.
Each document has one home region, the largest of those that are not unusually large for it, and home regions
are joined in full. What is left are pairs of different homes and components. The document of the smaller home
visits the larger one if its regions agree with t or more of those its members are in, and is compared with
all of them. So most links are found once, none is lost.

Inside a region the most shared document is the pivot. Its distance to all members gives its links, and, by
the triangle inequality, a window: members whose distances to the pivot differ by more than the
radius are not linked. All who are connected to the pivot are one component and need no comparison with each other.
The others stay open: they go to new regions, one for each band of distances as wide as the radius, into which
members of the band and of the next lower one are replicated. After ``depth`` such levels, every open one is
compared with all members of its regions, in blocks of bounded size, by exact intersection counts.

A hot region is spread by joins on its key, which adaptive execution splits, and by blocks; no task gathers it.
Equal sets are one class throughout. Null text, or text without words, has an empty set and is linked with nothing.
Rows with one id are one document; a null id ranks last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import LOWER, U64, gram_hashes, lean, mix, ranges, slices, span_hashes, words
from .components import components
from .spans import LAST_ID, bucket_of, buckets, frequent_grams, keyed, listed, parts
from .written import written

_TOP = U64(1 << 63)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every shingle of each text, repeats included, by row."""
    lower = LOWER[data]
    starts, ends, at = words(lower, offsets)
    h = span_hashes(lower, starts, ends)
    counts = np.diff(at)
    row = [np.repeat(np.arange(len(counts)), np.maximum(counts - size + 1, 0))]
    found = [gram_hashes(h, size)[ranges(at[:-1], np.maximum(counts - size + 1, 0))]]
    for short in range(1, size):
        rows = np.flatnonzero(counts == short)
        if len(rows):
            row.append(rows)
            found.append(mix(gram_hashes(h, short)[at[:-1][rows]] ^ U64(short)))
    return np.concatenate(row), np.concatenate(found) >> U64(1)


def sets(data: np.ndarray, offsets: np.ndarray, size: int, frequent: np.ndarray | None = None):
    """Row and hash of the distinct shingles, ordered by row, then frequent ones last, then hash."""
    row, h = shingles(data, offsets, size)
    if frequent is not None and len(frequent):
        h = np.where(listed(h, frequent), h | _TOP, h)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def _signatures(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and hash of each row's set."""
    counts = np.bincount(row, minlength=n)
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(h & ~_TOP))])
    edge = np.concatenate([[0], np.cumsum(counts)])
    return counts, mix((sums[edge[1:]] - sums[edge[:-1]]) ^ counts.astype(U64)).view(np.int64)


def signatures(rows: DataFrame, size: int) -> DataFrame:
    """_id, _digest, n, class of every keyed row."""

    def run(batches):
        for batch in batches:
            for ids, digests, data, offsets in parts(batch):
                for lo, hi in slices(offsets):
                    row, h = sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], size)
                    n, cls = _signatures(row, h, hi - lo)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[lo:hi]), pa.array(digests[lo:hi].astype(np.int64)), pa.array(n), pa.array(cls)],
                        ["_id", "_digest", "n", "class"],
                    )

    return rows.select("_id", "_digest", "_text").mapInArrow(lean(run), "_id long, _digest long, n long, class long")


def shared_pivots(rows: DataFrame, size: int, percent: int, slack: float) -> DataFrame:
    """key, class, m: first-level regions, among those a class is replicated to, that hold m > 1 classes."""
    count = buckets(rows)

    def all_keys(data, offsets):
        return np.concatenate(
            [sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)[1] for a, b in slices(offsets)]
        )

    frequent = frequent_grams(rows, all_keys, least=8, limit=131_072)
    held = rows.sparkSession.sparkContext.broadcast(frequent)

    def send(batches):
        for batch in batches:
            for _, _, data, offsets in parts(batch):
                keys, classes = [], []
                for lo, hi in slices(offsets):
                    row, h = sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], size, held.value)
                    n, cls = _signatures(row, h, hi - lo)
                    first = np.cumsum(n) - n
                    take = n - (n * percent + 99) // 100 + 1 + np.floor(slack * n).astype(np.int64)
                    take = np.minimum(take, n)
                    keys.append(h[ranges(first, take)])
                    classes.append(np.repeat(cls, take))
                key, cls = np.concatenate(keys), np.concatenate(classes)
                if not len(key):
                    continue
                order = np.lexsort((cls, key))
                key, cls = key[order], cls[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
                key, cls = key[new], cls[new]
                to = bucket_of(key, count)
                by = np.argsort(to, kind="stable")
                key, cls, edge = key[by], cls[by], np.searchsorted(to[by], np.arange(count + 1))
                some = [b for b in range(count) if edge[b] < edge[b + 1]]
                cut = lambda a: pa.array([a[edge[b] : edge[b + 1]].tobytes() for b in some], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), cut(key), cut(cls)], ["bucket", "keys", "classes"]
                )

    def meet(batches):
        keys, classes = [], []
        for batch in batches:
            keys += [np.frombuffer(x, U64) for x in batch.column(1).to_pylist()]
            classes += [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
        if not keys:
            return
        key, cls = np.concatenate(keys), np.concatenate(classes)
        order = np.lexsort((cls, key))
        key, cls = key[order], cls[order]
        new_key, new = np.ones(len(key), bool), np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new[1:] = new_key[1:] | (cls[1:] != cls[:-1])
        group = np.cumsum(new_key) - 1
        m = np.bincount(group, new).astype(np.int64)[group]
        several = new & (m > 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[several].view(np.int64)), pa.array(cls[several]), pa.array(m[several])], ["key", "class", "m"]
        )

    sent = rows.select("_id", "_digest", "_text").mapInArrow(lean(send), "bucket int, keys binary, classes binary")
    return sent.repartition(count, "bucket").mapInArrow(lean(meet), "key long, class long, m long")


def _compare(a: bytes, b: bytes) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    x, y = np.frombuffer(a, U64), np.frombuffer(b, U64)
    both = np.concatenate([x, y])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return same, len(both) - same


def _distances(pairs: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """Columns of ``pairs``, with the distance of classes ``a`` and ``b`` and whether they are linked."""

    def run(batches):
        for batch in batches:
            got = [_compare(a, b) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([1 - i / u for i, u in got], pa.float64()),
                 pa.array([100 * i >= percent * u for i, u in got], pa.bool_())],
                ["row", "distance", "linked"],
            )

    rows = pairs.select("b", F.struct(*pairs.columns).alias("row"))
    rows = rows.join(contents.select(F.col("class").alias("b"), F.col("words").alias("other")), "b").drop("b")
    rows = rows.withColumn("a", F.col("row.a")).join(contents.select(F.col("class").alias("a"), "words"), "a")
    kind = rows.schema["row"].dataType.simpleString()
    rows = rows.select("row", "words", "other").mapInArrow(lean(run), f"row {kind}, distance double, linked boolean")
    return rows.select("row.*", "distance", "linked")


def region_links(members: DataFrame, contents: DataFrame, percent: int, depth: int) -> list[DataFrame]:
    """Edge tables (a, b) that connect what is linked across components inside each region.

    ``members``: key, class, comp, rank (higher: a better pivot), n; ``contents``: class, words.
    """
    radius = 1 - percent / 100
    mixed = F.min("comp") != F.max("comp")
    rows = written(members.withColumn("open", F.lit(True)), "regions")
    edges = []
    for level in range(depth):
        best = F.struct("open", "rank", (-F.col("class")).alias("tie"))
        pivot = rows.groupBy("key").agg(F.max_by(F.struct("class", "comp"), best).alias("p"), mixed.alias("mixed"))
        pivot = pivot.where("mixed").select("key", F.col("p.class").alias("b"), F.col("p.comp").alias("pivot_comp"))
        met = rows.withColumnRenamed("class", "a").join(pivot, "key").where("a <> b")
        met = written(_distances(met, contents, percent), "regions", release=level == 0)
        edges.append(met.where("linked").select("a", "b"))
        core = F.col("linked") | (F.col("comp") == F.col("pivot_comp"))
        left = met.select(
            F.col("key").alias("was"), F.col("a").alias("class"), F.when(core, F.col("pivot_comp")).otherwise(F.col("comp")).alias("comp"),
            "rank", "n", (F.col("open") & ~core).alias("open"), F.floor(F.col("distance") / (radius + 1e-9)).cast("int").alias("band"),
        )
        left = left.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
        left = left.withColumn("key", F.xxhash64("was", "band", F.lit(level))).drop("was", "band")
        live = left.groupBy("key").agg(F.max("open").alias("any"), mixed.alias("mixed")).where("any and mixed").select("key")
        rows = written(left.join(live, "key", "left_semi"), "regions")
        if rows.isEmpty():
            return edges
    return [*edges, block_links(rows.where("open"), rows, contents, percent)]


def _block(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links that connect components of a block: (class, comp, open, words), each open one against all."""
    rows.sort()
    sizes = np.array([len(r[3]) // 8 for r in rows])
    _, codes = np.unique(np.frombuffer(b"".join(r[3] for r in rows), U64), return_inverse=True)
    start = np.cumsum(sizes) - sizes
    _, root = np.unique([r[1] for r in rows], return_inverse=True)
    mark, out = np.zeros(len(codes), bool), []
    for i, (cls, _, open_, _) in enumerate(rows):
        if not open_ or (root == root[i]).all():
            continue
        own = codes[start[i] : start[i] + sizes[i]]
        mark[own] = True
        same = np.add.reduceat(mark[codes], start, dtype=np.int64)
        mark[own] = False
        linked = (100 * same >= percent * (sizes + sizes[i] - same)) & (root != root[i])
        for r, j in zip(*np.unique(root[linked], return_index=True)):
            out.append((cls, rows[np.flatnonzero(linked)[j]][0]))
            root[root == r] = root[i]
    return out


def block_links(
    open_rows: DataFrame, members: DataFrame, contents: DataFrame, percent: int, opens: int = 256, others: int = 1024
) -> DataFrame:
    """Links (a, b) between components, of every open row with every member of its region (key, class, comp).

    Regions are cut into blocks of about ``opens`` open rows against ``others`` members, one group each.
    """
    n_open = open_rows.groupBy("key").agg(F.ceil(F.count("*") / opens).cast("int").alias("rows"))
    n_other = members.groupBy("key").agg(F.ceil(F.count("*") / others).cast("int").alias("columns"))
    cuts = n_open.join(n_other, "key")
    cell = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = open_rows.join(cuts, "key").select("key", "class", "comp", F.lit(True).alias("open"), cell("rows").alias("i"), every("columns").alias("j"))
    two = members.join(cuts, "key").select("key", "class", "comp", F.lit(False).alias("open"), cell("columns").alias("j"), every("rows").alias("i"))
    cells = one.unionByName(two).groupBy(F.xxhash64("key", "i", "j").alias("block"), "class").agg(
        F.min("comp").alias("comp"), F.max("open").alias("open")
    )

    def run(batches):
        block, held = None, []
        for batch in batches:
            for b, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if b != block and held:
                    yield table(_block(held, percent))
                    held = []
                block = b
                held.append(tuple(row))
        if held:
            yield table(_block(held, percent))

    def table(links):
        a, b = zip(*links) if links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    filled = cells.join(contents, "class").select("block", "class", "comp", "open", "words")
    filled = filled.repartition(buckets(members), "block").sortWithinPartitions("block")
    return written(filled.mapInArrow(lean(run), "a long, b long"), "links", release=True)


def linked_classes(
    rows: DataFrame, size: int = 5, percent: int = 80, slack: float = 0.03, depth: int = 1
) -> tuple[DataFrame, DataFrame]:
    """_id, _digest, n, class of keyed rows; class, first (its first document), lowest (its component's)."""
    own = written(signatures(rows, size), "sets")
    classes = own.where("n > 0").groupBy("class").agg(
        F.min(F.struct("_id", "_digest")).alias("first"), F.min("n").alias("n")
    )
    shared = written(shared_pivots(rows, size, percent, slack), "shared", release=True)
    needed = F.floor(F.lit(slack * percent / 100) * F.col("n")) + 1
    own_keys = shared.groupBy("class").agg(
        F.collect_list(F.struct("m", "key")).alias("at"), F.percentile_approx("m", 0.5).alias("usual")
    ).join(classes, "class")
    table = own_keys.where(F.size("at") >= needed).select(
        "class", "first", "n", (F.size("at") / F.col("n")).alias("rank"),
        F.expr("array_max(filter(at, x -> x.m <= 2 * usual)).key").alias("home"), F.expr("transform(at, x -> x.key)").alias("keys"),
    )
    table = written(table, "homes", release=True)
    texts = rows.join(table.select("class", "first.*"), ["_id", "_digest"]).select("class", "_digest", "_text")

    def extract(batches):
        for batch in batches:
            for cls, _, data, offsets in parts(batch):
                for lo, hi in slices(offsets):
                    row, h = sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], size)
                    edge = np.searchsorted(row, np.arange(hi - lo + 1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cls[lo:hi]), pa.array([h[i:j].tobytes() for i, j in zip(edge, edge[1:])], pa.binary())],
                        ["class", "words"],
                    )

    contents = texts.mapInArrow(lean(extract), "class long, words binary").groupBy("class").agg(F.first("words").alias("words"))
    contents = written(contents, "contents", release=True)

    members = table.select(F.col("home").alias("key"), "class", F.col("class").alias("comp"), "rank", "n")
    full = members.groupBy("key").count().where("count > 1").select("key")
    edges = None
    for more in region_links(members.join(full, "key", "left_semi"), contents, percent, depth):
        edges = more if edges is None else edges.unionByName(more)
    edges = written(edges, "links", release=True)
    labels = components(edges)

    sizes = table.groupBy("home").agg(F.count("*").alias("size"))
    named = table.join(labels.withColumnRenamed("node", "class"), "class", "left").join(sizes, "home")
    named = written(named.select("class", "n", "home", "size", F.coalesce("label", "class").alias("comp"), "keys"), "across")
    spread = named.select(F.explode("keys").alias("key"), "class", "n", "home", "size", "comp")
    homes = spread.groupBy("key", "home", "size").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    across = homes.groupBy("key").agg(F.min("low").alias("least"), F.max("high").alias("most"), F.count("*").alias("homes"))
    across = across.where("least <> most and homes > 1").select("key")
    hosts = homes.join(across, "key").select("key", F.struct("size", "home").alias("host"), "low", "high")
    visits = (
        spread.join(hosts, "key").where((F.struct("size", "home") < F.col("host")) & ((F.col("low") != F.col("comp")) | (F.col("high") != F.col("comp"))))
        .groupBy("class", F.col("host.home").alias("key")).agg(F.count("*").alias("keys"), F.first("n").alias("n"), F.first("comp").alias("comp"))
        .where(F.col("keys") >= needed).select("key", "class", "comp")
    )
    visits = written(visits, "visits", release=True)
    if not visits.isEmpty():
        hosts = named.select(F.col("home").alias("key"), "class", "comp").join(visits.select("key").distinct(), "key", "left_semi")
        edges = written(edges.unionByName(block_links(visits, hosts, contents, percent)), "links")
        labels = components(edges)

    reach = classes.select("class", "first").join(labels.withColumnRenamed("node", "class"), "class", "left")
    reach = reach.withColumn("label", F.coalesce("label", "class"))
    lowest = reach.groupBy("label").agg(F.min("first").alias("lowest"))
    return own, reach.join(lowest, "label").select("class", "first", "lowest")


def jaccard_components(
    docs: DataFrame, size: int = 5, percent: int = 80, slack: float = 0.03, depth: int = 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """id, n_shingles, component_id (smallest id that links reach) of every row."""
    own, reach = linked_classes(keyed(docs, id_col, text_col), size, percent, slack, depth)
    same = own.join(reach, "class", "left").select("_id", "n", F.coalesce("lowest._id", "_id").alias("component"))
    number = lambda c: F.when(F.col(c) < LAST_ID, F.col(c))
    return same.select(number("_id").alias(id_col), F.col("n").alias("n_shingles"), number("component").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the smallest id of each component, once; documents without words all stay."""
    rows = keyed(docs, id_col, text_col, tuple(docs.columns))
    own, reach = linked_classes(rows, **options)
    kept = own.where("n = 0").select("_id", "_digest").unionByName(reach.select("lowest").distinct().select("lowest.*"))
    kept = rows.join(kept.distinct(), ["_id", "_digest"], "left_semi").groupBy("_id", "_digest").agg(F.first("_row").alias("_row"))
    return kept.select(*(F.col("_row")[c].alias(c) for c in docs.columns))


#: The same for DuckDB.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '^[\t-\r ]+|[\t-\r ]+$', '', 'g'), '[\t-\r ]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN ws = [''] THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS hits FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * hits >= 80 * (x.n + y.n - hits)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(c.low, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN (SELECT a, min(b) AS low FROM r GROUP BY a) c ON w.doc_id = c.a
"""
