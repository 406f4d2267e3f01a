"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, conversation_trie, jaccard_regions, line_runs, mixing, pitman_yor, quality, relative_lz, run_index, vector_topk
from .byte_bpe import byte_bpe
from .phrase_fingerprint import fingerprints
from .token_counts import token_counts


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in a mix whose shares are square roots of the sources' sizes."""
    return mixing.mix(_documents(spark, sf_dir))


def op1_exact_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mix with shares that are not rounded to whole blocks a round."""
    return mixing.mix(_documents(spark, sf_dir), exact=True)


def op2_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without 200-byte strings that occur twice in the corpus."""
    return run_index.remove_repeats(_documents(spark, sf_dir), with_bytes=False)


def op3_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without 13-word passages that an earlier document has."""
    return relative_lz.remove_duplicates(_documents(spark, sf_dir), with_text=False)


def op4_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 5-word shingle sets that are 0.8 alike."""
    return jaccard_regions.jaccard_components(_documents(spark, sf_dir))


def op5_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products for each vector whose id is divisible by 50, against all rows."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vector_topk.top_k(vectors, lambda vec_id: vec_id % 50 == 0)


def op6_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return fingerprints(_documents(spark, sf_dir))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text with the 50k byte-level vocabulary."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe(_documents(spark, sf_dir), path, public_tokenizers.PATTERN, with_ids=False)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every text by the 32k piece model."""
    return token_counts(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and base log probability of every text; four of five documents are learnt from."""
    docs = _documents(spark, sf_dir)
    model, table = pitman_yor.fit(docs.where(~pitman_yor.held_out(F.col("doc_id"))).select("text"))
    return pitman_yor.score(docs, model, table)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text."""
    docs = _documents(spark, sf_dir)
    machine = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, machine, ["doc_id"]).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def op11_turn_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text of every conversation after planted damage."""
    return conversation_repair.repair(conversation_repair.damaged(_conversations(spark, sf_dir)))


def op12_block_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt to share their first turns."""
    return conversation_trie.trie(conversation_trie.rebuilt(_conversations(spark, sf_dir)))


def op13_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without long lines that at least five documents hold."""
    return line_runs.remove_lines(_documents(spark, sf_dir), with_text=False)


QUERIES = {
    "op1_source_mix": op1_source_mix,
    "op1_exact_mix": op1_exact_mix,
    "op2_run_index": op2_run_index,
    "op3_relative_lz": op3_relative_lz,
    "op4_jaccard_regions": op4_jaccard_regions,
    "op5_vector_topk": op5_vector_topk,
    "op6_phrase_fingerprint": op6_phrase_fingerprint,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_token_counts": op8_token_counts,
    "op9_pitman_yor": op9_pitman_yor,
    "op10_quality": op10_quality,
    "op11_turn_alignment": op11_turn_alignment,
    "op12_block_trie": op12_block_trie,
    "op13_line_runs": op13_line_runs,
}
SQL = {
    "op1_source_mix": mixing.SQL,
    "op3_relative_lz": relative_lz.SQL,
    "op4_jaccard_regions": jaccard_regions.SQL,
    "op5_vector_topk": vector_topk.SQL,
    "op11_turn_alignment": conversation_repair.SQL,
    "op12_block_trie": conversation_trie.SQL,
    "op13_line_runs": line_runs.SQL,
}
