"""Conversation structure repair by Wagner-Fischer alignment with the grammar (s?(ua)+)?.

Target strings of one length are unique, and the (ua) parts of all lengths are suffixes of one another, so one
table of (row, letters left) holds the alignments with every feasible length; a leading s is a kept system turn with
deletions before it. A linear pass that leaves the length open gives the incumbent cost and a bound for what lies in front of each
cell; Ukkonen's band keeps the cells that can still be on an alignment as cheap as the incumbent. Every length that
reaches it is traced back, taking the ASCII-least edit wherever costs agree, and the audits are compared.

Edits: keep K 0, rerole to user or assistant R 2, delete D 3 (required for blank and duplicate turns), insert an
empty user or assistant turn I 2; a truncated turn that stays adds 1.

Two streams sorted by (conversation, turn) do the work: one carries a few bytes a turn (initial, fault) and gives the
audit, the other applies the audit to the texts as they pass. No conversation is held as texts; the first
stream keeps one conversation's codes, and the table is as wide as there are cheapest alignments.

Rows are ordered by turn (null first), then original role, then digest, so ties have one result. Null role
or text is one space. Rows without conv_id belong to no conversation and are left out. Repeated rows are turns of
their own (and so duplicates). An initial other than s, u, a fits no letter. A conversation all of whose rows are gone has
zeros, an empty audit and no turns; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage
from .conversation_trie import CRC32, turn_digest
from .spans import buckets

_BLANKS = " \t\n\x0b\x0c\r"
_NEVER = 1 << 40
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2


def as_given(conversations: DataFrame) -> DataFrame:
    """Turns as they are: conv_id, turn, role, text; place columns _role, _tie, _copy; _lost for rows that are gone."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        role.alias("_role"), turn_digest(role, text).alias("_tie"), F.lit(0).alias("_copy"), F.lit(False).alias("_lost"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The same after planted damage, chosen by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its
    text, 2 removes the text's .!?, 3 repeats the row, 4 makes its role user."""
    rows = as_given(conversations)
    name = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("_k", F.crc32(name.cast("binary")) % 20)
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "_role", "_tie",
        F.explode(F.expr("sequence(0, if(_k = 3, 1, 0))")).alias("_copy"), (F.col("_k") == 0).alias("_lost"),
    )


def align(kinds: str, gone: list[bool], cut: list[bool]) -> tuple[int, str]:
    """Cost and ASCII-least audit of the cheapest edits. ``kinds``: initials of the turns; ``gone``: must be deleted;
    ``cut``: costs 1 if it stays."""
    n = len(kinds)
    stay = [[_NEVER if gone[i] else (KEEP if kinds[i] == letter else REROLE) + cut[i] for i in range(n)] for letter in "ua"]
    lead = [i for i in range(n) if kinds[i] == "s" and not gone[i]]
    leads = set(lead)
    front = [(0, INSERT)]  # cheapest way to have passed i rows with u, or a, as the next letter
    for i in range(n):
        u, a = front[i]
        to_u, to_a = min(u + DELETE, a + stay[1][i]), min(a + DELETE, u + stay[0][i])
        if i in leads:
            to_u = min(to_u, DELETE * i + cut[i])
        front.append((min(to_u, to_a + INSERT), min(to_a, to_u + INSERT)))
    best, u, a, pair = _NEVER, 0, INSERT, 2 * INSERT  # pair: u is next and at least one ua must follow
    for i in reversed(range(n)):
        if i in leads:
            best = min(best, DELETE * i + cut[i] + pair)
        to_u, to_a = min(u + DELETE, a + stay[0][i]), min(a + DELETE, u + stay[1][i])
        u_now, a_now = min(to_u, to_a + INSERT), min(to_a, to_u + INSERT)
        u, a, pair = u_now, a_now, min(pair + DELETE, a + stay[0][i], a_now + INSERT)
    best = min(best, u)

    def banded(i, lo, costs):
        ok = np.flatnonzero(np.array(front[i])[(lo + np.arange(len(costs))) % 2] + costs <= best)
        return (lo + int(ok[0]), costs[ok[0] : ok[-1] + 1]) if len(ok) else (0, costs[:0])

    table = [banded(n, 0, INSERT * np.arange(best // INSERT + 2))]  # from the last row: letters left, cost of the rest
    for i in reversed(range(n)):
        lo, after = table[-1]
        left = lo + np.arange(len(after) + 1)
        costs = np.full(len(left), _NEVER)
        costs[:-1] = after + DELETE
        costs[1:] = np.minimum(costs[1:], after + np.array([stay[0][i], stay[1][i]])[left[1:] % 2])
        slack = best - int((np.array(front[i])[left % 2] + costs).min())
        costs = np.append(costs, np.full(max(0, slack // INSERT) + 1, _NEVER))
        rise = INSERT * np.arange(len(costs))
        table.append(banded(i, lo, np.minimum.accumulate(costs - rise) + rise))
    table.reverse()

    def cost(i, left):
        lo, costs = table[i]
        return int(costs[left - lo]) if 0 <= left - lo < len(costs) else _NEVER

    def trace(i, left):
        out, now = [], cost(i, left)
        while i < n or left:
            if i < n and now == DELETE + cost(i + 1, left):
                edit, i, now = "D", i + 1, now - DELETE
            elif left and now == INSERT + cost(i, left - 1):
                edit, left, now = "I", left - 1, now - INSERT
            else:
                paid = stay[left % 2][i]
                edit, i, left, now = "K" if paid < REROLE else "R", i + 1, left - 1, now - paid
            out.append(edit)
        return "".join(out)

    found = [trace(0, left) for left in range(table[0][0], table[0][0] + len(table[0][1])) if left % 2 == 0 and cost(0, left) == best]
    for p in lead:
        lo, costs = table[p + 1]
        for left in range(max(2, lo + lo % 2), lo + len(costs), 2):
            if DELETE * p + cut[p] + cost(p + 1, left) == best:
                found.append("D" * p + "K" + trace(p + 1, left))
    return best, min(found)


_FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_NAMES = [x.split()[0] for x in _FOUND.split(", ")]
_LEGAL = {"su", "ua", "au"}


def _digest(turns: list[tuple], kinds: str, faults: str) -> tuple:
    """Numbers and audit of one conversation from its turns' numbers, initials and first faults."""
    known = [t for t in turns if t is not None]
    gaps = known[-1] - known[0] + 1 - len(set(known)) if known else 0
    cost, audit = align(kinds, [f in "bd" for f in faults], [f == "t" for f in faults])
    illegal = sum(a + b not in _LEGAL for a, b in zip(kinds, kinds[1:]))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit


def _order(*first: str) -> list:
    return [*first, F.col("turn").asc_nulls_first(), "_role", "_tie", "_copy"]


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation of ``as_given`` or ``damaged`` rows."""
    bare = F.rtrim(F.col("text"), F.lit(_BLANKS))
    first = F.substring("role", 1, 1)
    narrow = rows.select(
        "conv_id", "turn", "_role", "_tie", "_copy", "_lost", F.when(first.isin("s", "u", "a"), first).otherwise("?").alias("kind"),
        F.when(bare == "", "b").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "t").otherwise("-").alias("fault"),
        turn_digest(F.col("role"), F.col("text")).alias("same"),
    )
    seen = F.row_number().over(W.partitionBy("conv_id", "same", "_lost").orderBy(*_order()))
    fault = F.when((F.col("fault") != "b") & (seen > 1), "d").otherwise(F.col("fault"))
    coded = narrow.withColumn("fault", fault).withColumn("fault", F.when(~F.col("_lost"), F.col("fault")))

    def judge(batches):
        conv, turns, kinds, faults = None, [], [], []
        for batch in batches:
            out = []
            for c, t, k, f in zip(*(x.to_pylist() for x in batch.columns)):
                if c != conv:
                    if conv is not None:
                        out.append((conv, *_digest(turns, "".join(kinds), "".join(faults))))
                    conv, turns, kinds, faults = c, [], [], []
                if f is not None:
                    turns.append(t)
                    kinds.append(k)
                    faults.append(f)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], _NAMES)
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (conv, *_digest(turns, "".join(kinds), "".join(faults)))], _NAMES)

    dealt = coded.repartition(buckets(rows), "conv_id").sortWithinPartitions(*_order("conv_id"))
    return dealt.select("conv_id", "turn", "kind", "fault").mapInArrow(judge, _FOUND)


def _edits(audit: str):
    """(edit, role of the target) for every edit of an audit; no role where a turn goes or keeps its own."""
    at = 0 if sum(e != "D" for e in audit) % 2 == 0 else -1  # -1: a leading s
    for edit in audit:
        yield edit, None if edit in "DK" else ("user", "assistant")[at % 2]
        at += edit != "D"


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its turns in order, in one task's stream."""
    heads = found.select("conv_id", F.lit(0).alias("part"), *(F.lit(None).cast(dict(rows.dtypes)[c]).alias(c) for c in ("turn", "_role", "_tie", "_copy", "role", "text")), "audit")
    turns = rows.where(~F.col("_lost")).select("conv_id", F.lit(1).alias("part"), "turn", "_role", "_tie", "_copy", "role", "text", F.lit(None).cast("string").alias("audit"))
    both = heads.unionByName(turns).repartition(buckets(rows), "conv_id").sortWithinPartitions(*_order("conv_id", "part"))
    return both.select("conv_id", "audit", "role", "text")


def _turns(batches):
    """(conv_id, edit, role, text) of every edit in order, and (conv_id, None, None, None) before each conversation."""
    left = iter(())
    for batch in batches:
        found = []
        for conv, audit, role, text in zip(*(x.to_pylist() for x in batch.columns)):
            if audit is not None:
                left, now = _edits(audit), conv
                found.append((conv, None, None, None))
                ahead = []
                for edit, target in left:  # insertions before the first turn
                    if edit != "I":
                        ahead = [(edit, target)]
                        break
                    found.append((now, "I", target, ""))
                continue
            edit, target = ahead[0]
            found.append((conv, edit, target or role, text))
            for edit, target in left:
                if edit != "I":
                    ahead = [(edit, target)]
                    break
                found.append((conv, "I", target, ""))
        yield found


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place, edit, role, text of every turn that the repaired conversations have; edit K, R or I."""
    found = stage(audits(rows), "audits")

    def write(batches):
        place = 0
        for turns in _turns(batches):
            out = []
            for conv, edit, role, text in turns:
                if edit is None:
                    place = 0
                elif edit != "D":
                    out.append((conv, place, edit, role, text))
                    place += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["conv_id", "place", "edit", "role", "text"])

    return _with_audits(rows, found).mapInArrow(write, "conv_id long, place long, edit string, role string, text string")


def repair(rows: DataFrame) -> DataFrame:
    """Columns of ``audits`` and repaired_sha256, over ``role:text`` of the repaired turns joined by line feeds."""
    found = stage(audits(rows), "audits")

    def write(batches):
        conv, state = None, None
        for turns in _turns(batches):
            out = []
            for c, edit, role, text in turns:
                if edit is None:
                    if state is not None:
                        out.append((conv, state.hexdigest()))
                    conv, state, glue = c, hashlib.sha256(), b""
                elif edit != "D":
                    state.update(glue + f"{role}:{text}".encode())
                    glue = b"\n"
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["conv_id", "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    hashes = _with_audits(rows, found).mapInArrow(write, "conv_id long, repaired_sha256 string")
    return found.join(hashes, "conv_id")


#: The same for DuckDB: states of the grammar advance row by row, the least (cost, audit) of each state survives.
SQL = rf"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r0, coalesce(text, ' ') AS t0,
    {CRC32.format("conv_id || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k
  FROM conversations WHERE conv_id IS NOT NULL),
u AS (SELECT conv_id, turn, r0, sha256(strlen(r0) || ':' || r0 || t0) AS tie, unnest(CASE k WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy,
    CASE k WHEN 4 THEN 'user' ELSE r0 END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(t0, '[.!?]', '', 'g') ELSE t0 END AS text FROM t),
v AS (SELECT *, row_number() OVER w AS i, left(role, 1) AS ini, lag(left(role, 1)) OVER w AS was,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, r0, tie, copy) > 1 AS again,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r0, tie, copy)),
f AS (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault FROM v),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
    count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
    count(*) FILTER (WHERE was IS NOT NULL AND was || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
-- states: 0 empty, 1 s, 2 u is next after a pair, 3 a is next; up to two insertions before a row
ins(s, s2, cost, edits) AS (VALUES (0,0,0,''),(1,1,0,''),(2,2,0,''),(3,3,0,''),(0,3,2,'I'),(1,3,2,'I'),(2,3,2,'I'),(3,2,2,'I'),
  (0,2,4,'II'),(1,2,4,'II'),(2,2,4,'II'),(3,3,4,'II')),
step(s, kind, s2, cost, edit) AS (
  VALUES (0,'s',1,0,'K'),(0,'u',3,0,'K'),(0,'*',3,2,'R'),(1,'u',3,0,'K'),(1,'*',3,2,'R'),(2,'u',3,0,'K'),(2,'*',3,2,'R'),(3,'a',2,0,'K'),(3,'*',2,2,'R'),
    (0,'-',0,3,'D'),(1,'-',1,3,'D'),(2,'-',2,3,'D'),(3,'-',3,3,'D')),
p AS (
  SELECT conv_id, 0 AS i, 0 AS s, CAST(0 AS BIGINT) AS cost, '' AS audit FROM c
  UNION ALL
  SELECT conv_id, i, s, best.cost, best.audit FROM (
    SELECT p.conv_id, f.i, step.s2 AS s, min({{'cost': CAST(p.cost + ins.cost + step.cost + CASE WHEN fault = 't' AND edit <> 'D' THEN 1 ELSE 0 END AS BIGINT),
      'audit': p.audit || ins.edits || edit}}) AS best
    FROM p JOIN f ON f.conv_id = p.conv_id AND CAST(f.i AS INT) = p.i + 1 JOIN ins ON ins.s = p.s
      JOIN step ON step.s = ins.s2 AND (step.kind = '-' OR fault NOT IN ('b', 'd') AND step.kind IN (ini, '*'))
    GROUP BY p.conv_id, f.i, step.s2)),
z AS (SELECT c.conv_id, min({{'cost': p.cost + ins.cost, 'audit': audit || ins.edits}}) AS best
  FROM c JOIN p ON p.conv_id = c.conv_id AND p.i = c.n JOIN ins ON ins.s = p.s WHERE ins.s2 IN (0, 2) GROUP BY c.conv_id),
e AS (SELECT conv_id, best.audit AS audit, len(replace(best.audit, 'D', '')) % 2 AS odd, unnest(range(1, len(best.audit) + 1)) AS k FROM z),
x AS (SELECT *, audit[k] AS edit, len(replace(audit[1:k], 'I', '')) AS i, len(replace(audit[1:k-1], 'D', '')) - odd AS place FROM e),
y AS (SELECT x.conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS h
  FROM x LEFT JOIN f ON f.conv_id = x.conv_id AND f.i = x.i AND edit <> 'I' WHERE edit <> 'D' GROUP BY x.conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(z.best.cost, 0) AS cost, coalesce(z.best.audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM t) a LEFT JOIN c ON c.conv_id = a.conv_id LEFT JOIN z ON z.conv_id = a.conv_id LEFT JOIN y ON y.conv_id = a.conv_id
"""
