"""Prefix trie of conversations by fixed-length block hashing.

Every turn becomes a 128-bit digest of role and text before anything moves; the texts themselves never do. A
conversation's turns are chained into path digests and cut into blocks of ``block`` turns. Conversations are
grouped by block first: one row per distinct (path before the block, path after it), counted on the map side, so a
beginning that many share is one row. Where a path has one following block, its turns are nodes as they are.
Only where siblings diverge are their blocks opened and turns with equal paths merged.

Subtree sums come in two steps. The tree of blocks adds up by pointer doubling: after round j a block
start holds the sums of the next 2**j blocks below it, so the rounds are the logarithm of the longest conversation in blocks. Inside a
block each node adds to its at most ``block`` ancestors there.

Conversations are read as a stream sorted by (conversation, turn): a conversation of any length needs the memory of one
block. The hash of the conversations that end at a node runs over pieces of at most 4,096 ids, in order.

Turns are ordered by turn (null first), then role, then digest, so ties have one result; repeated rows are
turns of their own. Null role or text counts as empty. Rows without conv_id belong to no conversation and are left out.
A table without conversations has no nodes. Columns beside conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage
from .spans import buckets

ROOT = bytes(16)
#: Ids per piece of the list that a node's hash covers.
_PIECE_BITS = 12


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of SHA-256 of a turn; the length keeps role and text apart."""
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), digest and chars of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), turn_digest(role, text).alias("digest"), F.length(text).alias("chars")
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "digest", "chars")


def plain(conversations: DataFrame) -> DataFrame:
    """Conversations as they are, for ``trie``."""
    own = stage(turns(conversations), "turns")
    marks = own.where("pos = 0").select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("chars"))
    return marks.unionByName(own.withColumn("part", F.lit(1)))


def rebuilt(conversations: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversation c begins with the first h turns of conversation c - c % group instead of its own first h,
    where h is crc32 of its number modulo ``most``: conv_id, part, pos, digest, chars, and a mark (part -1) per conversation."""
    own = stage(turns(conversations), "turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = own.where("pos = 0").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    marks = convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("chars"))
    heads = own.where(F.col("pos") < most - 1).select(F.col("conv_id").alias("base"), "pos", "digest", "chars")
    lent = convs.join(heads, "base").where("pos < h").select("conv_id", F.lit(0).alias("part"), "pos", "digest", "chars")
    rest = own.where(F.col("pos") >= h).select("conv_id", F.lit(1).alias("part"), "pos", "digest", "chars")
    return marks.unionByName(lent).unionByName(rest)


_BLOCKS = "conv_id long, block int, prev binary, path array<binary>, chars array<int>, last boolean"
_KINDS = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.bool_()]


def blocks(rows: DataFrame, block: int) -> DataFrame:
    """Each conversation's blocks: path digest before it, path digest and length of each of its turns, and whether
    the conversation ends there. A conversation without turns is one empty block."""
    names = [x.split()[0] for x in _BLOCKS.split(", ")]

    def chain(batches):
        conv, number, prev, path, chars, some = None, 0, ROOT, [], [], False

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*found), _KINDS)], names)

        def end():
            return (conv, number, prev, path, chars, True)

        for batch in batches:
            found = []
            for c, digest, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if c != conv or not some:
                    if some:
                        found.append(end())
                    conv, number, prev, path, chars, some = c, 0, ROOT, [], [], True
                if digest is None:
                    continue
                if len(path) == block:  # the block is full and another turn follows
                    found.append((conv, number, prev, path, chars, False))
                    number, prev, path, chars = number + 1, path[-1], [], []
                path.append(hashlib.sha256((path[-1] if path else prev) + digest).digest()[:16])
                chars.append(n)
            if found:
                yield out(found)
        if some:
            yield out([end()])

    dealt = rows.repartition(buckets(rows), "conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return dealt.select("conv_id", "digest", "chars").mapInArrow(chain, _BLOCKS)


def _opened(groups: DataFrame, block: int) -> DataFrame:
    """A row per turn of each group of blocks; ``up``: the turn's ancestors inside the block."""
    turns = groups.select("*", F.posexplode(F.arrays_zip("path", "chars")).alias("i", "t"))
    return turns.select(
        F.col("t.path").alias("node"),
        F.when(F.col("i") == 0, F.col("prev")).otherwise(F.try_element_at("path", F.col("i"))).alias("parent"),
        (F.col("block") * block + F.col("i") + 1).alias("depth"),
        "prev", "low", "n", F.col("t.chars").alias("chars"), F.expr("slice(path, 1, i)").alias("up"),
    )


def _sums(of: DataFrame, key: str) -> DataFrame:
    return of.groupBy(key).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def below(starts: DataFrame) -> DataFrame:
    """id, leaves, saved with the sums of all block starts below added; ``above`` is a start's parent or null."""
    while not starts.where("above IS NOT NULL").isEmpty():
        more = _sums(starts.where("above IS NOT NULL"), "above").select(F.col("above").alias("id"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        jump = starts.where("above IS NOT NULL").select(F.col("id").alias("above"), F.col("above").alias("next"))
        starts = stage(
            starts.join(more, "id", "left").join(jump, "above", "left").select(
                "id", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), F.col("next").alias("above"),
            ), "trie-sums",
        )
    return starts.drop("above")


def _ends(found: DataFrame) -> DataFrame:
    """node, ends_sha256 of the ids of the conversations that end there, ascending."""
    piece = F.concat_ws(",", F.array_sort(F.collect_list("conv_id")).cast("array<string>"))
    pieces = found.groupBy("node", F.shiftright("conv_id", _PIECE_BITS).alias("piece")).agg(piece.alias("ids"))

    def digest(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for at, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    dealt = pieces.repartition(buckets(found), "node").sortWithinPartitions("node", "piece")
    return dealt.select("node", "ids").mapInArrow(digest, "node binary, ends_sha256 string")


def trie(rows: DataFrame, block: int = 8) -> DataFrame:
    """One row per node: smallest member, depth, the parent's smallest member, members, children, leaves and shared
    code points of the subtree, and a hash of the members that end there. ``rows`` as ``plain`` or ``rebuilt`` give them."""
    cut = stage(blocks(rows, block), "trie-blocks")
    end = F.coalesce(F.try_element_at("path", F.lit(-1)), F.col("prev"))
    groups = stage(
        cut.where(F.size("path") > 0).groupBy("block", "prev", end.alias("next"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.first("path").alias("path"), F.first("chars").alias("chars")),
        "trie-groups",
    )
    lone = stage(groups.groupBy("prev").agg(F.count(F.lit(1)).alias("k")).where("k = 1").select("prev"), "trie-lone")
    straight = _opened(groups.join(lone, "prev", "left_semi"), block)
    forked = _opened(groups.join(lone, "prev", "left_anti"), block).groupBy("node").agg(
        *(F.first(c).alias(c) for c in ("parent", "depth", "prev")), F.min("low").alias("low"), F.sum("n").alias("n"),
        *(F.first(c).alias(c) for c in ("chars", "up")),
    )
    root = cut.where("block = 0").agg(F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"), F.lit(None).cast("binary").alias("prev"),
        "low", "n", F.lit(0).alias("chars"), F.expr("cast(array() AS array<binary>)").alias("up"),
    )
    nodes = stage(straight.unionByName(forked).unionByName(root), "trie-nodes")
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(kids, "node", "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("chars")).alias("saved"),
    )
    nodes = stage(nodes, "trie-counted")
    above = nodes.where((F.col("depth") > 0) & (F.col("depth") % block == 0)).select(F.col("node").alias("id"), F.col("prev").alias("above"))
    starts = _sums(nodes.where("prev IS NOT NULL"), "prev").withColumnRenamed("prev", "id").join(above, "id", "left")
    whole = below(stage(starts.select("id", "leaves", "saved", "above"), "trie-starts"))
    own = nodes.join(whole.select(F.col("id").alias("node"), F.col("leaves").alias("l"), F.col("saved").alias("s")), "node", "left").select(
        F.explode(F.concat("up", F.array("node"))).alias("node"),
        (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
    )
    sums = stage(_sums(own, "node"), "trie-subtrees")
    ends = stage(_ends(cut.where("last").select(end.alias("node"), "conv_id")), "trie-ends")
    parents = nodes.select(F.col("node").alias("parent"), F.col("low").alias("parent_conv_id"))
    return (
        nodes.drop("leaves", "saved").join(parents, "parent", "left").join(sums, "node").join(ends, "node", "left")
        .select(
            F.col("low").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
            "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


#: Unsigned crc32 of a string of digits, bit by bit.
CRC32 = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b)] || CAST(range(8) AS BIGINT[]),
      lambda a, _: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)))"""

#: The same for DuckDB.
SQL = f"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text)) - 1 AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {CRC32.format("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = base WHERE pos < h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE pos >= h),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d, sha256(strlen(role) || ':' || role || text) AS tok, length(text) AS chars FROM r),
p AS (
  SELECT conv_id, d, string_agg(tok, '') OVER (PARTITION BY conv_id ORDER BY d) AS path, chars FROM o
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
e AS (SELECT arg_max(path, d) AS path, conv_id FROM p GROUP BY conv_id),
s AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256 FROM e GROUP BY path),
n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM p GROUP BY path, d),
k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n
  LEFT JOIN (SELECT left(path, 64 * (d - 1)) AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1) USING (path)),
a AS (SELECT left(path, 64 * i) AS path, CAST(sum(CAST(n_children = 0 AS INT)) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM k) GROUP BY 1)
SELECT k.conv_id, k.d AS depth, CASE WHEN k.d > 0 THEN up.conv_id END AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens,
  coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM k JOIN a ON a.path = k.path LEFT JOIN s ON s.path = k.path LEFT JOIN n up ON up.path = left(k.path, 64 * (k.d - 1)) AND up.d = k.d - 1
"""
