"""Mixing sources to target weights by Pfair scheduling, with DataFrame operations only.

Documents of a source, in the order of a hash of their id, form blocks of ``block_rows``. Weights are
integers; in a round, source i places m_i blocks (its weight, or what is left of it) and the round has
M = sum(m_i) slots. Block c of a source is released at floor(c * M / m_i) and due at
ceil((c + 1) * M / m_i); each slot goes to the released block that is due first. Unit blocks whose
rates sum to one always meet these windows, so at every slot each source is less than one block away
from its share. Rounds differ only where a source runs out, so at most 2 * sources + 1 kinds of
rounds are scheduled, whatever the number of rows; when a source is used up the others go on in
their own proportion. Every row is placed once.

With ``exact`` (the default for given targets) weights are not rounded to whole blocks a round but to 2**-30 of one:
source i has placed floor(r * w_i + f_i) blocks when r rounds are over, what is left of a block carries over, and each
round is scheduled by itself. The phases f_i, multiples of the golden ratio, keep sources of like weight from falling due in
one round: every source stays within two blocks of its unrounded share (the tests hold 2, 3 and 61 sources; without phases
the last drift by 38). Without it shares are those of the rounded weights, at least 1 of ``steps``.

Positions inside a source come from counts per (source, hash prefix): no source, however large, is
ordered in one task. Null sources are a source of their own; null ids hash as the empty text; equal
(source, id) rows are interchangeable and all placed. Clashing extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .spans import buckets, keyed

#: Rows that share a hash prefix within a source, on average at most.
CELL_ROWS = 4096
#: Parts of a block in which exact weights are counted.
UNIT = 1 << 30
GOLDEN = (5**0.5 - 1) / 2

_PICK = """array_min(transform(ms, (m, i) -> if(a.c[i] < m and (a.c[i] * total) div m <= t,
    named_struct('due', ((a.c[i] + 1) * total + m - 1) div m, 'i', i), null)))"""
_EDF = f"""aggregate(sequence(0L, total - 1),
    named_struct('c', transform(ms, m -> 0L), 'picks', cast(array() as array<int>)),
    (a, t) -> aggregate(array({_PICK}), a, (s, pick) -> named_struct(
        'c', transform(s.c, (v, i) -> if(i = pick.i, v + 1, v)), 'picks', array_append(s.picks, pick.i))),
    a -> a.picks)"""


def _weights(sizes: DataFrame, targets: dict[str | None, float] | None, power: float, steps: int, unit: int = 1) -> DataFrame:
    """Integer weight of each source, in parts of 1 / ``unit``: ``steps`` for the largest target, one part at least."""
    if targets is None:
        share = F.pow(F.col("n") / F.max("n").over(W.partitionBy()), F.lit(power))
        if power == 0.5:
            share = F.sqrt(F.col("n") / F.max("n").over(W.partitionBy()))
    else:
        top = max(targets.values())
        share = F.lit(min(targets.values()) / top)
        for name, value in targets.items():
            key = "n" if name is None else f"s{name}"
            share = F.when(F.col("_key") == key, F.lit(value / top)).otherwise(share)
    return sizes.withColumn("w", F.greatest(F.lit(1).cast("long"), F.round(steps * unit * share).cast("long")))


def schedule(weights: DataFrame) -> DataFrame:
    """_key, j, first, last, base, total, slot: place of a source's j-th block in rounds first .. last - 1.

    ``weights`` has a row for each source: _key, w (blocks in a full round), b (blocks in all).
    """
    rounds = F.expr("transform(all, x -> x.b div x.w)")
    starts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0).cast("long")), rounds, F.transform(rounds, lambda x: x + 1))))
    kinds = (
        weights.agg(F.array_sort(F.collect_list(F.struct("_key", "w", "b"))).alias("all"))
        .withColumn("starts", starts)
        .select("all", "starts", F.posexplode("starts").alias("at", "first"))
        .withColumn("last", F.expr("try_element_at(starts, at + 2)"))
        .withColumn("live", F.expr("""filter(transform(all, x -> named_struct('key', x._key, 'm',
            case when first < x.b div x.w then x.w when first = x.b div x.w then x.b % x.w else 0 end)), x -> x.m > 0)"""))
        .where(F.size("live") > 0)
        .select("first", "last", F.col("live.key").alias("keys"), F.col("live.m").alias("ms"))
        .withColumn("total", F.expr("aggregate(ms, 0L, (a, m) -> a + m)"))
    )
    before = W.orderBy("first").rowsBetween(W.unboundedPreceding, -1)
    kinds = kinds.withColumn("base", F.coalesce(F.sum(F.col("total") * (F.col("last") - F.col("first"))).over(before), F.lit(0)))
    slots = kinds.select("keys", "first", "last", "base", "total", F.posexplode(F.expr(_EDF)).alias("slot", "i"))
    j = F.row_number().over(W.partitionBy("first", "i").orderBy("slot")) - 1
    return slots.select(
        F.element_at("keys", F.col("i") + 1).alias("_key"), j.cast("long").alias("j"), "first", "last", "base", "total", "slot"
    )


def round_slots(cells: DataFrame, weights: DataFrame, block_rows: int) -> DataFrame:
    """_key, _round, j, at: place of a source's j-th block of a round, rounds scheduled one by one.

    ``cells`` counts rows (_key, _before, count, w, f) with weight ``w`` and phase ``f`` in parts of 1 / UNIT; a block belongs to the cell of its first row.
    """
    first = F.expr(f"(_before + {block_rows - 1}) div {block_rows}")
    last = F.expr(f"(_before + count - 1) div {block_rows}")
    blocks = cells.where(first <= last).select("_key", "w", "f", F.explode(F.sequence(first, last)).alias("_block"))
    rounds = (
        blocks.groupBy(_round().alias("_round"), "_key").agg(F.count(F.lit(1)).alias("m"))
        .groupBy("_round").agg(F.array_sort(F.collect_list(F.struct("_key", "m"))).alias("live"))
        .select("_round", F.col("live._key").alias("keys"), F.col("live.m").alias("ms"))
        .withColumn("total", F.expr("aggregate(ms, 0L, (a, m) -> a + m)"))
    )
    all_ = weights.agg(F.collect_list(F.struct("w", "b", "f")).alias("all"))
    placed = F.expr(f"aggregate(all, 0L, (a, x) -> a + least(x.b, (_round * x.w + x.f) div {UNIT}))")
    slots = rounds.crossJoin(F.broadcast(all_)).withColumn("base", placed).select("_round", "keys", "base", F.posexplode(F.expr(_EDF)).alias("slot", "i"))
    j = F.row_number().over(W.partitionBy("_round", "i").orderBy("slot")) - 1
    return slots.select(
        F.element_at("keys", F.col("i") + 1).alias("_key"), "_round", j.cast("long").alias("j"), (F.col("base") + F.col("slot")).alias("at")
    )


def _round() -> Column:
    """Round of a block: the first after which its source has placed it."""
    return F.expr(f"((_block + 1) * {UNIT} - f + w - 1) div w - 1")


def mix(
    docs: DataFrame,
    targets: dict[str | None, float] | None = None,
    block_rows: int = 16,
    power: float = 0.5,
    steps: int = 100,
    id_col: str = "doc_id",
    source_col: str = "source",
    exact: bool | None = None,
) -> DataFrame:
    """id, source, block (number within the source), slot (in the mix) and place (in the block) of every row.

    ``targets``: wanted share of each source; without it, source size to the power ``power``.
    Sources that ``targets`` does not name get its smallest share. ``exact``: do not round weights; by default only
    given targets are exact, and size-based weights are the rounded ones of ``SQL``.
    """
    rows = docs.select(id_col, source_col, F.struct(id_col, source_col).alias("_row"))
    return _placed(rows, targets, block_rows, power, steps, id_col, source_col, exact).select("_row.*", "block", "slot", "place")


def mixed(docs: DataFrame, targets=None, block_rows: int = 16, power: float = 0.5, steps: int = 100,
          id_col: str = "doc_id", source_col: str = "source", exact: bool | None = None, with_places: bool = False) -> DataFrame:
    """All documents in the order of the mix: files, and rows within files, follow slot and place.

    Readers of the files may take them in another order; ``with_places`` adds slot and place as columns.
    Places are found on narrow rows and join the texts once; repeated rows take their places in turn.
    """
    rows = keyed(docs.select(*docs.columns), id_col, "text", tuple(docs.columns))
    narrow = rows.select(F.col("_row")[id_col].alias("_rid"), F.col("_row")[source_col].alias("_src"), F.struct("_id", "_digest").alias("_row"))
    places = _placed(narrow, targets, block_rows, power, steps, "_rid", "_src", exact)
    places = places.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("slot", "place"))).alias("at"))
    places = places.select("_row.*", "at")
    copy = F.row_number().over(W.partitionBy("_id", "_digest").orderBy("_digest"))
    found = rows.withColumn("_copy", copy).join(places, ["_id", "_digest"])
    found = found.select(F.element_at("at", F.col("_copy")).alias("at"), "_row")
    found = found.repartitionByRange(buckets(docs), "at").sortWithinPartitions("at")
    added = ("slot", "place") if with_places else ()
    return found.select(*(F.col("_row")[c].alias(c) for c in docs.columns if c not in added), *(F.col("at")[c].alias(c) for c in added))


def _placed(docs, targets, block_rows, power, steps, id_col, source_col, exact=None) -> DataFrame:
    """Column _row of ``docs``, with block, slot and place."""
    exact = targets is not None if exact is None else exact
    n = docs.count()
    digits = max(0, math.ceil(math.log(max(1, n / CELL_ROWS), 16)))
    rows = docs.select(
        "_row",
        F.col(id_col).alias("_order"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("_key"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("_hash"),
    ).withColumn("_cell", F.substring("_hash", 1, digits))
    cells = rows.groupBy("_key", "_cell").count()
    sizes = cells.groupBy("_key").agg(F.sum("count").alias("n"))
    weights = _weights(sizes, targets, power, steps, UNIT if exact else 1).withColumn("b", F.expr(f"(n + {block_rows - 1}) div {block_rows}"))
    turn = F.row_number().over(W.orderBy("_key"))  # one row per source
    weights = weights.withColumn("f", F.floor(UNIT * F.pmod(turn * F.lit(GOLDEN), F.lit(1.0))) if exact else F.lit(0).cast("long"))
    before = W.partitionBy("_key").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0))).join(
        weights.select("_key", "w", "f"), "_key"
    )
    order = W.partitionBy("_key", "_cell").orderBy("_hash", "_order")
    placed = (
        rows.join(cells.select("_key", "_cell", "_before", "w", "f"), ["_key", "_cell"])
        .withColumn("_at", F.col("_before") + F.row_number().over(order) - 1)
        .withColumn("_block", F.expr(f"_at div {block_rows}"))
        .withColumn("_round", _round() if exact else F.expr("_block div w"))
        .withColumn("j", F.expr(f"_block - (_round * w + f) div {UNIT}") if exact else F.col("_block") % F.col("w"))
    )
    if exact:
        plan = round_slots(cells, weights, block_rows)
        return placed.join(plan, ["_key", "_round", "j"]).select(
            "_row", F.col("_block").alias("block"), F.col("at").alias("slot"), (F.col("_at") % block_rows).cast("int").alias("place")
        )
    plan = schedule(weights)
    here = (placed["_key"] == plan["_key"]) & (placed["j"] == plan["j"]) & (F.col("_round") >= F.col("first"))
    here &= F.col("last").isNull() | (F.col("_round") < F.col("last"))
    return placed.join(plan, here).select(
        "_row",
        F.col("_block").alias("block"),
        (F.col("base") + (F.col("_round") - F.col("first")) * F.col("total") + F.col("slot")).alias("slot"),
        (F.col("_at") % block_rows).cast("int").alias("place"),
    )


#: The same for DuckDB, with the defaults of ``mix``.
SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS k,
    row_number() OVER (PARTITION BY coalesce('s' || source, 'n') ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST) - 1 AS pos
  FROM documents),
s AS (SELECT k, count(*) AS n, (count(*) + 15) // 16 AS b FROM d GROUP BY k),
w AS (SELECT k, b, greatest(1, CAST(round(100 * sqrt(n / max(n) OVER ())) AS BIGINT)) AS w FROM s),
starts AS (SELECT DISTINCT x FROM (SELECT unnest([0, b // w, b // w + 1]) AS x FROM w)),
kinds AS (SELECT x AS first, lead(x) OVER (ORDER BY x) AS last FROM starts),
live AS (SELECT first, last, k, CASE WHEN first < b // w THEN w WHEN first = b // w THEN b % w ELSE 0 END AS m FROM kinds, w),
rounds AS (SELECT first, last, list(k ORDER BY k) AS ks, list(m ORDER BY k) AS ms, CAST(sum(m) AS BIGINT) AS total FROM live WHERE m > 0 GROUP BY first, last),
based AS (SELECT *, coalesce(CAST(sum(total * (last - first)) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS base FROM rounds),
edf AS (
  SELECT first, ms, total, CAST(0 AS BIGINT) AS t, [CAST(0 AS BIGINT) FOR m IN ms] AS cs, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS j FROM based
  UNION ALL
  SELECT first, ms, total, t + 1, list_transform(cs, lambda c, p: CASE WHEN p = pick.i THEN c + 1 ELSE c END), pick.i, cs[pick.i]
  FROM (SELECT *, list_min(list_filter(list_transform(ms, lambda m, p: CASE WHEN cs[p] < m AND (cs[p] * total) // m <= t
      THEN {'due': ((cs[p] + 1) * total + m - 1) // m, 'i': CAST(p AS BIGINT)} END), lambda x: x IS NOT NULL)) AS pick FROM edf WHERE t < total)),
plan AS (SELECT b.ks[e.i] AS k, e.j, b.first, b.last, b.base, b.total, e.t - 1 AS slot FROM edf e JOIN based b ON e.first = b.first WHERE e.t > 0),
placed AS (SELECT doc_id, source, k, pos, pos // 16 AS block, w FROM d JOIN w USING (k))
SELECT doc_id, source, block, CAST(base + (block // w - first) * total + slot AS BIGINT) AS slot, CAST(pos % 16 AS INTEGER) AS place
FROM placed JOIN plan ON placed.k = plan.k AND block % w = j AND block // w >= first AND (last IS NULL OR block // w < last)
"""
