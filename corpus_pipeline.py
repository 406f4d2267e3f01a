"""Corpus pipeline over ``documents``: stages, each written as Parquet and read by the next.

1. quality: documents that the classifier scores below 0.3 go.
2. near duplicates: of documents whose 5-word shingle sets are 0.8 alike or more, the one with the smallest id stays.
3. passages: words under 13-word windows that an earlier document has go; texts that lose words are
   their kept words joined by one space, with ``n_chars`` to match; all documents stay.
4. mix: all documents stay and get their ``slot`` and ``place``; in that order every stretch holds sources near
   their target shares until a source runs out. From there the others go on in their own proportion, and the end is the
   source that lasts longest alone.
5. encode: ids of the byte-level vocabulary, with hashes of the ids and of the decoded bytes, and slot and place: the
   order of the mix is that of these columns, not of files.

The first three return the columns of ``documents``, the fourth adds slot and place. An empty table passes through all stages; null
texts count as empty (see the operators for null ids, ties and repeated rows).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import byte_bpe, jaccard_regions, mixing, quality, relative_lz
from creditloom.sources.staging import stage

#: A document stays if its score reaches this.
QUALITY_LIMIT = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "text")  # no column of the documents meets the score
    return quality.score(rows, machine, ["doc"]).where(F.col("score") >= QUALITY_LIMIT).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_regions.one_of_each(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return relative_lz.without_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, exact=True, with_places=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.byte_bpe(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=("slot", "place"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", drop_passages),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]
#: SQL cannot express the classifier and the encoder; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, apply) in enumerate(STAGES):
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{n + 1}")
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
