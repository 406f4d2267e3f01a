"""Operators on odd rows, and against SQL or brute force on small tables."""

import hashlib
import os
import re
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.llm import (
    arrays, byte_bpe, jaccard_regions, mixing, phrase_fingerprint, pitman_yor, quality, queries, relative_lz, run_index, spans, vector_topk,
)

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd():
    """Rows with nulls, empty and long texts, copies, near copies, periodic text and shared passages."""
    rng = np.random.default_rng(3)
    vocab = ["".join(rng.choice(list("abcdeéß"), rng.integers(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocab, n))
    base, passage = prose(120), prose(60)
    near = [base.replace(" ", "  ", 3), *(" ".join(rng.choice(vocab) if rng.random() < p else w for w in base.split()) for p in (0.005, 0.01, 0.03, 0.05, 0.1))]
    texts = [
        base, base, *near, base.upper(), passage, prose(80) + " " + passage + "\n" + prose(30), passage + " " + prose(50),
        None, "", " \n\t ", "one", "One", "two words", "two  words", "a b c d", "ab " * 300, "x" * 900, "x" * 450, prose(6000),
        *(prose(int(n)) for n in rng.integers(1, 60, 12)), passage, passage,
    ]
    return [(i, t) for i, t in enumerate(texts)]


def frame(spark, rows, extra="kept"):
    return spark.createDataFrame([(*r, "x", f"s{r[0] % 3}" if r[0] else None, 1) for r in rows], f"doc_id long, text string, {extra} string, source string, n_chars int")


def passages(docs, units, size, smaller):
    """Positions under windows that occur elsewhere (``smaller``: in a document with a smaller id)."""
    first, seen = {}, Counter()
    for d, t in docs:
        for i in range(len(units(t)) - size + 1):
            w = units(t)[i : i + size]
            first.setdefault(w, d)
            seen[w] += 1
    out = {}
    for d, t in docs:
        u, gone = units(t), np.zeros(len(units(t)), bool)
        for i in range(len(u) - size + 1):
            w = u[i : i + size]
            if first[w] < d if smaller else seen[w] > 1:
                gone[i : i + size] = True
        out[d] = gone
    return out


@pytest.mark.parametrize("least", [64, 1])
def test_relative_lz_is_brute_force(spark, odd, least, monkeypatch):
    monkeypatch.setattr(relative_lz, "frequent_grams", lambda rows, keys: spans.frequent_grams(rows, keys, share=1, least=least, limit=10**6))
    units = lambda t: tuple(WORD.findall(t or ""))
    gone = passages(odd, units, 13, True)
    got = {r.doc_id: r for r in relative_lz.remove_duplicates(frame(spark, odd)).collect()}
    for d, t in odd:
        left = " ".join(w for w, g in zip(units(t), gone[d]) if not g)
        r = got[d]
        assert (r.n_words, r.n_removed) == (len(units(t)), gone[d].sum())
        assert r.kept_sha256 == hashlib.sha256(left.encode()).hexdigest()
        assert r.kept == (left if gone[d].any() else None)
    assert sum(r.n_removed for r in got.values()) > 500


@pytest.mark.parametrize("least", [64, 2, 1])
def test_run_index_is_brute_force(spark, odd, least, monkeypatch):
    """With ``least`` 2 or 1, most or all windows are settled by themselves."""
    monkeypatch.setattr(run_index, "frequent_grams", lambda rows, keys: spans.frequent_grams(rows, keys, share=1, least=least, limit=10**6))
    units = lambda t: (t or "").encode()
    gone = passages(odd, units, 200, False)
    got = {r.doc_id: r for r in run_index.remove_repeats(frame(spark, odd)).collect()}
    for d, t in odd:
        g, r = gone[d], got[d]
        left = bytes(b for b, x in zip(units(t), g) if not x)
        assert (r.n_bytes, r.n_removed, r.kept) == (len(units(t)), g.sum(), left)
        assert r.n_spans == (np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum()
        assert r.kept_sha256 == hashlib.sha256(left).hexdigest()
    assert got[[d for d, t in odd if t == "x" * 900][0]].n_removed == 900


def shingle_sets(docs):
    out = {}
    for d, t in docs:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out[d] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    return out


def brute_components(docs, percent=80):
    sets, low = shingle_sets(docs), {d: d for d, _ in docs}
    changed, links = True, [
        (a, b) for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return sets, low


def test_jaccard_is_brute_force(spark, odd):
    rng = np.random.default_rng(8)
    family = list(odd)
    for seed in range(4):  # chains of edits: similarities on both sides of the limit
        words = [f"w{seed}_{i}" for i in range(60)]
        for _ in range(25):
            words = [f"e{rng.integers(1e6)}" if rng.random() < 0.012 else w for w in words]
            family.append((len(family), " ".join(words)))
    sets, low = brute_components(family)
    got = {r.doc_id: r for r in jaccard_regions.jaccard_components(frame(spark, family, "component_id")).collect()}
    assert {d: got[d].component_id for d in low} == low
    assert {d: got[d].n_shingles for d in sets} == {d: len(s) for d, s in sets.items()}
    kept = sorted(r.doc_id for r in jaccard_regions.one_of_each(frame(spark, family, "n")).select("doc_id").collect())
    assert kept == sorted(d for d in low if low[d] == d)


def thue_morse(n, a, b):
    """Words that a polynomial hash modulo 2**64 maps to one value, whatever its base, from 1,024 letters on."""
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


def test_words_that_polynomial_hashes_confuse_stay_apart(spark):
    one, two = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    same = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{same} {one}"), (2, f"{same} {two}")]
    assert [r.n_removed for r in relative_lz.remove_duplicates(frame(spark, rows)).collect()] == [0, 0]
    got = jaccard_regions.jaccard_components(frame(spark, [(1, one), (2, two)])).collect()
    assert sorted(r.component_id for r in got) == [1, 2]
    shared = thue_morse(4096, "a", "b")
    rows = [(1, "x" + shared), (2, thue_morse(4096, "b", "a") + "y"), (3, "z" + shared[:1500])]
    gone = passages(rows, lambda t: t.encode(), 200, False)
    assert {r.doc_id: r.n_removed for r in run_index.remove_repeats(frame(spark, rows)).collect()} == {d: gone[d].sum() for d, _ in rows}


def test_hashes_tell_spans_and_grams_apart():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    starts = rng.integers(0, 2900, 9000)
    ends = starts + rng.integers(0, 70, 9000)
    spans = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    found = [(spans, arrays.span_hashes(data, starts, ends))]
    found += [([data[i : i + k].tobytes() for i in range(3001 - k)], arrays.byte_grams(data, k)) for k in (8, 13, 32, 37)]
    values = rng.integers(0, 3, 2000).astype(np.uint64)
    found += [([values[i : i + k].tobytes() for i in range(2001 - k)], arrays.gram_hashes(values, k)) for k in (1, 2, 5, 13)]
    for texts, hashes in found:
        assert len(texts) == len(hashes) and len(set(zip(texts, hashes.tolist()))) == len(set(texts)) == len(set(hashes.tolist()))
    a, b, n = rng.integers(0, 2900, 20000), rng.integers(0, 2900, 20000), rng.integers(0, 9, 20000)
    same = [data[i : i + k].tobytes() == data[j : j + k].tobytes() for i, j, k in zip(a, b, n)]
    assert arrays.Prefixes(data).same(a, b, n).tolist() == same


def test_settled_windows_of_a_common_passage_are_few_rows(spark):
    passage = "".join(f"{i:04d}" for i in range(160))
    rows = [(i, f"{i:07d} {passage} {i * 7919 % 10007:07d}") for i in range(600)]
    docs, gone = frame(spark, rows), passages(rows, lambda t: t.encode(), 200, False)
    found = run_index.repeated_spans(spans.keyed(docs, "doc_id", "text"))
    assert found.count() < 20 * 600  # the passage has 441 windows
    assert {r.doc_id: r.n_removed for r in run_index.remove_repeats(docs).collect()} == {d: gone[d].sum() for d, _ in rows}


def test_blocks_find_links_between_components():
    words = lambda *x: np.array(sorted(x), np.uint64).tobytes()
    rows = [(1, 1, True, words(*range(10))), (2, 2, False, words(*range(9))), (3, 2, False, words(*range(10, 20)))]
    assert jaccard_regions._block(rows, 80) == [(1, 2)]
    assert jaccard_regions._block([(1, 5, True, words(1)), (2, 5, False, words(1))], 80) == []


def test_mix_keeps_every_row_and_the_shares(spark, odd):
    rows = [(i, None if i % 50 == 0 else "big" if i % 3 else f"s{i % 5}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(docs, block_rows=1).toPandas().sort_values("slot")
    assert sorted(got.doc_id) == list(range(3000)) and got.slot.tolist() == list(range(3000))
    weights = mixing._weights(docs.groupBy("source").count().select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_key"), F.col("count").alias("n")), None, 0.5, 100)
    w = {r._key: r.w for r in weights.collect()}
    total, seen = sum(w.values()), Counter()
    keys = ["n" if s is None or s != s else f"s{s}" for s in got.source]
    live = min(n // w[k] for k, n in Counter(keys).items()) * total  # until the first source runs out
    for t, k in enumerate(keys[:live]):
        seen[k] += 1
        assert all(abs(seen[x] - (t + 1) * w[x] / total) < 1 for x in w)
    again = docs.unionByName(docs)
    assert mixing.mix(again).count() == 6000
    whole = frame(spark, odd, "slot").unionByName(frame(spark, odd[:5], "slot"))
    out = mixing.mixed(whole)
    assert out.columns == whole.columns and sorted(map(str, out.collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("targets", [{"a": 0.9951, "b": 0.0049}, {"a": 0.7, "b": 0.235, "c": 0.00007}, {"a": 1.0} | {f"s{i:02d}": 0.0099 for i in range(60)}])
def test_mix_follows_targets_that_are_no_whole_steps(spark, targets):
    sizes = {k: max(3, int(6000 * v)) for k, v in targets.items()}
    rows = [(i, k) for k, n in sizes.items() for i in range(n)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), targets, block_rows=1).toPandas().sort_values("slot")
    assert got.slot.tolist() == list(range(len(rows))) and sorted(zip(got.doc_id, got.source)) == sorted(rows)
    seen, total = Counter(), sum(targets.values())
    for t, k in enumerate(got.source):
        seen[k] += 1
        if any(seen[x] == sizes[x] for x in sizes):  # the first source has run out
            break
        assert all(abs(seen[x] - (t + 1) * v / total) < 2 for x, v in targets.items())
    assert t > 900


def test_mix_by_size_is_exact_on_demand(spark):
    rows = [(i, "big") for i in range(20000)] + [(i, "small") for i in range(2)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), block_rows=1, power=1.0, exact=True).toPandas()
    assert sorted(got.slot) == list(range(20002)) and min(got.slot[got.source == "small"]) > 5000  # rounding put both among the first 300


@needs_tables
def test_pipeline_result_carries_the_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = corpus_pipeline.stage(corpus_pipeline.mix_sources(spark, docs, SF), "mixed")
    got = {r.doc_id: (r.slot, r.place) for r in corpus_pipeline.encode(spark, mixed, SF).collect()}
    assert got == {r.doc_id: (r.slot, r.place) for r in mixing.mix(docs, exact=True).collect()}
    assert len(set(got.values())) == len(got) == docs.count()


def test_topk_is_brute_force(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(0, 1, (700, 9)).astype(np.float32)
    vectors[100:140] = vectors[3]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(700, None), (701, [1.0, None]), (702, [float("nan")] * 9), (703, [float("inf")] * 9), (704, [1.0]), (None, [1.0] * 9), (750, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    ints = {i: np.floor(256 * np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    full = {i: np.pad(v, (0, 9 - len(v))) for i, v in ints.items()}
    want = set()
    for q in (i for i in full if i % 50 == 0):
        best = sorted((-int(full[q] @ full[i]), i) for i in full if i != q)[:5]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    for block in (2048, 64):
        got = vector_topk.top_k(df, lambda c: c % 50 == 0, block_rows=block).collect()
        assert {tuple(r) for r in got} == want
    assert vector_topk.top_k(df, lambda c: c % 50 == 0, query_rows=4).count() == len(want)


def test_fingerprints(spark, odd):
    got = {r.doc_id: r for r in phrase_fingerprint.fingerprints(frame(spark, odd), chunk_bytes=500).collect()}
    for n, (d, t) in enumerate(odd):
        t, after = t or "", odd[(n + 1) % len(odd)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for text, found in ((t, r.fingerprint), (edited, r.edited_fingerprint)):
            data = text.encode()
            assert found == phrase_fingerprint._texts(phrase_fingerprint.signatures([(data, phrase_fingerprint.parse(data)[0])], 128))[0]
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0
    seen, phrase = set(), b""
    for c in odd[0][1].encode():  # the plain parse
        phrase += bytes([c])
        if phrase not in seen:
            seen.add(phrase)
            phrase = b""
    assert set(phrase_fingerprint.parse(odd[0][1].encode())[1]) == seen


def test_model_is_a_distribution_and_counts_are_exact(spark, odd):
    docs = frame(spark, odd, "score").unionByName(spark.createDataFrame([(None, "one", None, None, None)], "doc_id long, text string, score string, source string, n_chars int"))
    model, table = pitman_yor.fit(docs.where(~pitman_yor.held_out(F.col("doc_id"))).select("text"), contexts=8, frequent=40)
    got = pitman_yor.score(docs, model, table).collect()
    assert len(got) == len(odd) + 1
    words, pairs = (np.concatenate([pitman_yor.records(r[c], k) for r in table.collect()]) for c, k in (("words", pitman_yor._WORD), ("pairs", pitman_yor._PAIR)))
    for ctx in range(len(model.customers)):
        at = np.append(np.arange(len(words)), -1)
        p = 10 ** model.scores(words, pairs, at, np.full(len(at), ctx))[1]
        assert abs(p.sum() - 1) < 1e-4
    train = [WORD.findall((t or "").lower()) + [None] for d, t in odd if not __import__("zlib").crc32(str(d).encode()) % 5 == 1]
    train.append(["one", None])
    c = Counter(w for t in train for w in t)
    for r in got:
        assert r.train_tokens == sum(c.values())
        if r.doc_id is not None:
            t = WORD.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in odd[r.doc_id][1] or "")) + [None]
            base = sum(np.log10((c[w] + 0.5) / (sum(c.values()) + 0.5 * (len(c) + 1))) for w in t)
            assert (r.n_tokens, r.n_known) == (len(t), sum(c[w] > 0 for w in t)) and abs(r.base_score - base) < 1e-6
    empty, none = pitman_yor.fit(docs.limit(0).select("text"))
    assert {r.score for r in pitman_yor.score(docs.limit(3), empty, none).collect()} == {0.0}


def test_every_previous_word_has_its_own_restaurant(spark):
    rng = np.random.default_rng(6)
    vocab = [f"w{i}" for i in range(700)]
    texts = [" ".join(rng.choice(vocab, 40, p=np.arange(700, 0, -1) / 245350)) for _ in range(150)]
    docs = frame(spark, list(enumerate(texts)), "score")
    train = docs.where(~pitman_yor.held_out(F.col("doc_id")))
    want = Counter()
    for t in [r.text for r in train.collect()]:
        data = t.encode()
        _, token, before = pitman_yor.tokens(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        want.update(zip(token.tolist(), before.tolist()))
    found = []
    for bounds in ({"contexts": 3, "near": 0}, {"contexts": 19}):
        model, table = pitman_yor.fit(train.select("text"), frequent=20, **bounds)
        got = {}
        for r in table.collect():
            head, pairs = pitman_yor.unpack(r.words, r.pairs)
            got |= {(w, u): c for w, u, c in zip(np.repeat(head["w"], head["k"]).tolist(), pairs["u"].tolist(), pairs["c"].tolist())}
        assert got == want
        found.append({r.doc_id: r.score for r in pitman_yor.score(docs, model, table).collect()})
    assert len({u for _, u in want}) > 600 and found[0].keys() == found[1].keys()
    assert all(abs(found[0][d] - found[1][d]) < 1e-6 for d in found[0])


def test_messages_between_buckets_grow_with_pairs_and_lose_no_total(spark):
    rng = np.random.default_rng(8)
    vocab = [f"w{i}" for i in range(900)]
    chance = 1 / np.arange(3, 903)
    texts = [" ".join(rng.choice(vocab, 30, p=chance / chance.sum())) for _ in range(200)]
    docs = frame(spark, [*enumerate(texts), (200, "new words w7 w899 w898 w897"), (201, "w1 w1 W1")], "score")
    train = docs.where(~pitman_yor.held_out(F.col("doc_id")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        model, table = pitman_yor.fit(train.select("text"), contexts=3, frequent=600, near=16)
        rows = table.collect()
        word, pairs = [], []
        for r in rows:
            head, some = pitman_yor.unpack(r.words, r.pairs)
            word.append(np.repeat(head["w"], head["k"]))
            pairs.append(some)
        word, pairs = np.concatenate(word), np.concatenate(pairs)
        apart = (pitman_yor.find(model.words["w"], word) < 0) & (pitman_yor.find(model.contexts, pairs["u"]) < 0)
        messages = pitman_yor.context_totals(table, model, 24, whole=True).count()
        assert 0 < apart.sum() < 200 and messages <= apart.sum() + 2 * 24  # a message for each two buckets would be 576
        at_word, at_ctx, own = {}, {}, {}
        for w, u, c, t in zip(word.tolist(), pairs["u"].tolist(), pairs["c"].tolist(), pairs["t"].tolist()):
            own[w, u] = c - model.discount * t
            for found, key in ((at_word, w), (at_ctx, u)):
                x = found.setdefault(key, [0, 0])
                x[0], x[1] = x[0] + c, x[1] + t
        assert all(np.isclose([c, t], at_ctx.get(u, (0, 0))).all() for u, c, t in zip(model.contexts.tolist(), model.customers, model.tables))
        got = {r.doc_id: r for r in pitman_yor.score(docs, model, table).collect()}
        assert len(got) == 202
        for r in docs.collect():
            data = np.frombuffer(r.text.encode(), np.uint8)
            _, token, ctx = pitman_yor.tokens(data, np.array([0, len(data)]))
            want = 0.0
            for w, u in zip(token.tolist(), ctx.tolist()):
                parent = float(model.parent(np.array(at_word.get(w, (0, 0))[1], float)))
                c, t = at_ctx.get(u, (0, 0))
                want += np.log10((max(own.get((w, u), 0), 0) + model.fresh(t) * parent) / (model.strength + c))
            assert abs(got[r.doc_id].score - want) < 1e-4, r.doc_id
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_machine_formula_and_odd_labels(spark, odd):
    rng = np.random.default_rng(1)
    m = quality.Machine(4, 0.3, rng.normal(size=31), rng.normal(size=(31, 3)), np.zeros(15), np.ones(15))
    rows = quality.Rows(np.array([1, 5, 20]), np.array([0.5, 2.0, -1.0]), np.array([0, 3]))
    pairs = sum(m.factors[a] @ m.factors[b] * x * y for (a, x), (b, y) in combinations(zip(rows.index, rows.value), 2))
    assert np.isclose(m.margins(rows)[0][0], 0.3 + m.linear[rows.index] @ rows.value + pairs)
    docs = frame(spark, odd, "score")
    for labels in ([], [(1, 1), (2, 1)], [(1, 1), (2, 0), (2, None), (None, 1), (3, 1)]):
        got = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        out = quality.score(docs, got, ["doc_id"]).collect()
        assert len(out) == len(odd) and all(0 <= r.score <= 1 for r in out)


def test_empty_tables(spark, odd):
    none = frame(spark, odd).limit(0)
    assert relative_lz.remove_duplicates(none).count() == 0
    assert run_index.remove_repeats(none).count() == 0
    assert jaccard_regions.jaccard_components(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0
    assert phrase_fingerprint.fingerprints(none).count() == 0


@needs_tables
@pytest.mark.parametrize("name", sorted({**queries.SQL}))
def test_queries_equal_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = sorted(map(str, db.execute(f"SELECT {', '.join(cols)} FROM ({queries.SQL[name]})").fetchall()))
    assert sorted(str(tuple(r)) for r in df.select(*cols).collect()) == want


@needs_tables
def test_quality_on_held_out_rows(spark):
    folder = SF.replace("0.001", "0.01")
    got = queries.op10_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.85


@needs_tables
def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id: r.text for r in corpus_pipeline.keep_good(spark, docs, SF).collect()}
    _, low = brute_components(sorted(good.items()))
    rest = [(d, good[d]) for d in sorted(good) if low[d] == d]
    units = lambda t: tuple(WORD.findall(t or ""))
    gone = passages(rest, units, 13, True)
    v = byte_bpe.load(queries.public_tokenizers.path("byte_bpe_50k.tiktoken"), queries.public_tokenizers.PATTERN)
    want = {d: byte_bpe.encode(v, t if not gone[d].any() else " ".join(w for w, g in zip(units(t), gone[d]) if not g)) for d, t in rest}
    got = {r.doc_id: np.array(r.ids, "<u4").tobytes() for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
