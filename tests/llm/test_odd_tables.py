"""Empty tables, columns with the operators' own names, and very long texts, for operators and pipeline stages."""

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.llm import jaccard_regions, line_runs, mixing, phrase_fingerprint, pitman_yor, quality, run_index, vector_topk

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@needs_tables
def test_every_stage_passes_an_empty_table_on(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert out.count() == 0, name
        assert n >= 3 or out.columns == docs.columns
        docs = corpus_pipeline.stage(out, "empty")


def test_operators_on_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(none, quality.train(none, labels), ["doc_id"]).count() == 0
    assert vector_topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), lambda c: c % 50 == 0).count() == 0
    model, table = pitman_yor.fit(none.select("text"))
    assert pitman_yor.score(none, model, table).count() == 0
    assert line_runs.remove_lines(none).count() == 0


@needs_tables
def test_stages_keep_columns_that_carry_their_own_names(spark):
    names = ["score", "_score", "row", "_row", "at", "_at", "_copy", "kept", "doc", "hash", "gone", "_id", "_digest", "_text", "_key", "class"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id")).alias(c) for c in names])
    plain = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        own, plain = (corpus_pipeline.stage(stage(spark, d, SF), "own") for d in (own, plain))
        assert set(plain.columns) | set(names) == set(own.columns)
        assert sorted(map(tuple, own.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
        assert own.where(" OR ".join(f"`{c}` <> concat('{c}-', doc_id)" for c in names)).count() == 0
    got = mixing.mix(docs.withColumns({c: F.lit("x") for c in names}))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, mixing.mix(docs).collect()))
    got = phrase_fingerprint.fingerprints(docs.withColumns({c: F.lit("x") for c in names}))
    assert got.agg(F.count("fingerprint")).first()[0] == docs.count()


def test_very_long_texts(spark):
    rng = np.random.default_rng(7)
    vocab = np.array([f"word{i}" for i in range(5000)])
    long = " ".join(rng.choice(vocab, 250_000))
    rows = [(1, long), (2, long), (3, " ".join(rng.choice(vocab, 30)) + " " + long[:3000]), (4, "short text."), (5, "x" * 1_500_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    got = {r.doc_id: r for r in run_index.remove_repeats(docs).collect()}
    assert got[1].n_removed == got[2].n_removed == len(long) and got[4].n_removed == 0 and got[5].n_removed == 1_500_000
    assert 3000 <= got[3].n_removed < 3010
    near = {r.doc_id: r for r in jaccard_regions.jaccard_components(docs).collect()}
    assert near[1].component_id == near[2].component_id == 1 and near[3].component_id == 3 and near[5].n_shingles == 1
    model, table = pitman_yor.fit(docs.select("text"))
    scores = {r.doc_id: r for r in pitman_yor.score(docs, model, table).collect()}
    assert scores[1].score == pytest.approx(scores[2].score) and scores[1].n_tokens == scores[1].n_known == 250_001
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 6)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.score(docs, quality.train(docs, labels), ["doc_id"]).collect())
    lines = {r.doc_id: r for r in line_runs.remove_lines(docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 10)), min_docs=3).collect()}
    assert [lines[i].n_dropped for i in (1, 2, 11, 12)] == [1, 1, 1, 0]
    assert lines[12].kept_sha256 == hashlib.sha256(long.encode()).hexdigest()
