"""Line runs, conversation repair and the prefix trie against brute force, on odd rows and long conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from creditloom.llm import conversation_repair, conversation_trie, line_runs

BLANKS = " \t\n\x0b\x0c\r"
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
lower = lambda text: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---- lines ----


def documents():
    rng = random.Random(2)
    common = [f"Line number {i} that several documents share, É and all {'x' * i}" for i in range(12)]
    rows = []
    for d in range(60):
        own = [f"only in {d}: {rng.random():.12f} {'y' * 30}" for _ in range(rng.randrange(3))]
        shared = [rng.choice(common) for _ in range(rng.randrange(6))]
        shared = [rng.choice(["", " ", "\t", "\r", "\x0b "]) + (s.upper() if rng.random() < 0.2 else s.swapcase() if rng.random() < 0.1 else s) for s in shared]
        rows.append((d, "\n".join(rng.sample(own + shared + ["short", ""], len(own) + len(shared) + 2))))
    edge = ["a" * 39, "b" * 40, " " + "c" * 39 + "é ", "é" * 39]
    rows += [(100 + i, "\n".join(edge)) for i in range(4)] + [(104, "\n".join(edge[:2]))]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, common[0] + "\n"), (None, common[1] + "\nnull id"), (None, common[1] + "\n" + common[2])]
    rows += [(204, "\n".join([common[3]] * 3)), (204, "\n".join([common[3]] * 3)), (204, common[4] + "\nanother text"), (205, "\n".join([common[5]] * 20000 + ["end"]))]
    return rows + rows[:3]


def brute_lines(rows, least=5):
    key = lambda line: lower(line.strip(BLANKS))
    at = lambda d: -(1 << 63) if d is None else d
    holders = defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(at(d))
    common = {k: max(v) for k, v in holders.items() if len(v) >= least}
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if common.get(key(x), at(d)) == at(d)]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept)), "\n".join(kept)))
    return sorted(map(str, out))


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (7, 3)])
def test_line_runs_are_brute_force(spark, batches, fanout):
    rows = documents()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, hash string, gone int")
    got = line_runs.remove_lines(docs, batches=batches, fanout=fanout)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_lines(rows)
    assert got.agg(F.sum("n_dropped")).first()[0] > 50
    kept = line_runs.remove_lines(docs, keep=("doc_id", "hash", "gone"), with_text=False)
    assert kept.columns == ["doc_id", "hash", "gone", "n_lines", "n_dropped", "kept_sha256"] and kept.count() == len(rows)


def test_line_index_counts_every_batch_once(spark):
    index = line_runs.LineIndex(spark, min_docs=3, fanout=2)
    rng, counts, holder = random.Random(4), defaultdict(int), defaultdict(lambda: -1)
    for batch in range(5):
        ids = [i * 5 + batch for i in range(6)]
        rows = [(bytes([rng.randrange(6)]), d) for d in ids for _ in range(2)]
        for h, d in set(rows):
            counts[h] += 1
            holder[h] = max(holder[h], d)
        index.add(spark.createDataFrame(rows, "hash binary, _id long"))
        levels = [at for at, _ in index.runs]
        assert len(set(levels)) == len(levels)  # two runs of a level become one of the next
        got = {bytes(r.hash): r.holder for r in index.common().collect()}
        assert got == {h: holder[h] for h, n in counts.items() if n >= 3}
    names = [n for _, n in index.runs]
    index.close()
    assert not index.runs and not any(spark.catalog.tableExists(n) for n in names)


def test_no_lines(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert line_runs.remove_lines(none).count() == 0
    short = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert [tuple(r)[1:3] for r in line_runs.remove_lines(short).orderBy("doc_id").collect()] == [(1, 0), (1, 0)]


# ---- conversations ----


def talk():
    """conv_id, turn, role, text: nulls, repeated rows, ties, long, odd roles, a conversation that damage empties."""
    rng = random.Random(9)
    say = lambda: rng.choice(["Hello.", "So it is!", "no end", "Why?", " \t", "Hello.", "later. ", "x" * 30 + "."])
    rows = []
    for c in [*range(60), 100, 101, 150, 205, 299, 300, 301, -7]:
        n = rng.randrange(1, 9)
        rows += [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]) if t else rng.choice(["system", "user"]), say()) for t in range(n)]
    rows += [(7, None, None, None), (7, None, "user", None), (8, 2, None, "tie"), (8, 2, "user", "tie"), (9, 40, "", "a gap."), (None, 1, "user", "of none.")]
    rows += [(12, 3, "user", "Hello.")] * 3
    rows += [(77, t, ("user", "assistant")[t % 2] if rng.random() < 0.8 else "system", say()) for t in range(150)]
    lost = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows += [(lost, 1, "user", "only one.")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, n int")


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def cheapest(kinds, gone, cut):
    """Plain dynamic programming over every length of the target."""
    n, found = len(kinds), []
    for size in range(2 * n + 4):
        if size == 1:
            continue
        target = "s" * (size % 2) + "ua" * (size // 2)
        best = {}
        for i in range(n, -1, -1):
            for j in range(size, -1, -1):
                ways = [(0, "")] if i == n and j == size else []
                if i < n:
                    ways.append((best[i + 1, j][0] + 3, "D" + best[i + 1, j][1]))
                if j < size and target[j] != "s":
                    ways.append((best[i, j + 1][0] + 2, "I" + best[i, j + 1][1]))
                if i < n and j < size and not gone[i]:
                    rest = best[i + 1, j + 1]
                    if kinds[i] == target[j]:
                        ways.append((rest[0] + cut[i], "K" + rest[1]))
                    elif target[j] != "s":
                        ways.append((rest[0] + cut[i] + 2, "R" + rest[1]))
                best[i, j] = min(ways, default=(10**9, ""))
        found.append(best[0, 0])
    return min(found)


def test_alignment_is_brute_force():
    rng = random.Random(5)
    for round_ in range(1500):
        kinds = "".join(rng.choice("suuaa?" if round_ % 2 else "sua") for _ in range(rng.randrange(10)))
        gone = [rng.random() < 0.2 for _ in kinds]
        cut = [rng.random() < 0.3 and not g for g in gone]
        assert conversation_repair.align(kinds, gone, cut) == cheapest(kinds, gone, cut), (kinds, gone, cut)


def brute_repair(rows, planted):
    out, convs = {}, defaultdict(list)
    for c, t, role, text in rows:
        if c is None:
            continue
        role, text = (" " if x is None else x for x in (role, text))
        key = (t is not None, t or 0, role, digest(role, text))
        k = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20 if planted else 99
        text = "" if k == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if k == 2 else text
        convs[c] += [(key, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    for c, turns in convs.items():
        turns = sorted(turns, key=lambda x: x[0])
        seen, faults = set(), ""
        for _, _, role, text in turns:
            bare = text.rstrip(BLANKS)
            faults += "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-"
            seen.add((role, text))
        kinds = "".join(r[:1] if r[:1] in ("s", "u", "a") else "?" for _, _, r, _ in turns)
        cost, audit = cheapest(kinds, [f in "bd" for f in faults], [f == "t" for f in faults])
        size = len(audit) - audit.count("D")
        target, lines, i, j = "s" * (size % 2) + "ua" * (size // 2), [], 0, 0
        for e in audit:
            role = {"u": "user", "a": "assistant", "s": "system"}[target[j]] if e != "D" else None
            if e in "KR":
                lines.append(f"{turns[i][2] if e == 'K' else role}:{turns[i][3]}")
            if e == "I":
                lines.append(f"{role}:")
            i, j = i + (e != "I"), j + (e != "D")
        known = [t for _, t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        out[c] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha("\n".join(lines)), lines)
    return out


@pytest.mark.parametrize("planted", [True, False])
def test_repair_is_brute_force(spark, planted):
    rows = [r for r in talk() if r[0] != 77 or r[1] < 40]
    df = frame(spark, rows)
    turns = conversation_repair.damaged(df) if planted else conversation_repair.as_given(df)
    want = brute_repair(rows, planted)
    got = {r[0]: tuple(r)[1:] for r in conversation_repair.repair(turns).collect()}
    assert got == {c: w[:-1] for c, w in want.items()}
    lines = defaultdict(list)
    for r in conversation_repair.repaired_turns(turns).orderBy("conv_id", "place").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert lines == {c: w[-1] for c, w in want.items() if w[-1]}
    assert not planted or any(w[:-1] == (0, 0, 0, 0, 0, 0, "", sha("")) for w in want.values())


def test_long_conversation_is_aligned():
    rng = random.Random(1)
    kinds = "s" + "".join(k for k in "ua" * 1500 if rng.random() > 0.05)
    cost, audit = conversation_repair.align(kinds, [rng.random() < 0.05 for _ in kinds], [False] * len(kinds))
    assert cost == 3 * audit.count("D") + 2 * (audit.count("I") + audit.count("R")) and len(audit) - audit.count("I") == len(kinds)


def brute_trie(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((t is not None, t or 0, role, digest(role, text)), (role, text)))
    convs = {c: tuple(x for _, x in sorted(v)) for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = convs.get(base, ())[:h] + own[h:]
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = []
    for path, m in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:-1] == p for q in below if q)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(path)))
        out.append((min(m), len(path), min(members[path[:-1]]) if path else None, len(m), len(kids), len(leaves), saved, ends))
    return sorted(map(str, out)), built


@pytest.mark.parametrize("block", [1, 3, 8])
def test_trie_is_brute_force(spark, block):
    rows = [r for r in talk() if r[0] != 77 or r[1] < 30]
    rows += [(500 + c, t, "user", f"shared {t}") for c in range(40) for t in range(12 + c % 3)]  # one beginning that many share
    want, built = brute_trie(rows)
    got = conversation_trie.trie(conversation_trie.rebuilt(frame(spark, rows)), block)
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    assert any(not path for path in built.values())


def test_plain_trie_and_long_conversations(spark):
    rows = [(c, t, "user", f"turn {t if t < 299 else c}") for c in range(3) for t in range(300)]
    got = {(r.conv_id, r.depth): r for r in conversation_trie.trie(conversation_trie.plain(frame(spark, rows)), 4).collect()}
    assert len(got) == 1 + 299 + 3 and got[0, 0].n_leaves == 3 and got[0, 299].n_children == 3
    assert got[0, 0].saved_tokens == 2 * sum(len(f"turn {t}") for t in range(299))
    assert got[2, 300].parent_conv_id == 0 and got[2, 300].ends_sha256 == sha("2")


def test_no_conversations(spark):
    none = frame(spark, [])
    assert conversation_trie.trie(conversation_trie.rebuilt(none)).count() == 0
    assert conversation_repair.repair(conversation_repair.damaged(none)).count() == 0
    assert conversation_repair.repaired_turns(conversation_repair.damaged(none)).count() == 0
