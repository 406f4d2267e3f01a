"""Line deduplication over levelled sorted runs of line hashes, with DataFrame operations only.

A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. Keys of at least
``min_chars`` code points that at least ``min_docs`` documents hold lose their lines everywhere but in the
document with the largest id. Counts are taken over the input.

An index is a list of runs. A run is a table (hash, docs, holder) bucketed and sorted by hash. ``add`` reduces a
batch to one row per key, merge-anti-joins it with every run (a key that a run already settles, with enough
documents and a larger holder, adds nothing) and writes what is left as a run of level 0. When ``fanout`` runs
share a level they are merged into one run of the next. Runs are bucketed alike, so neither join nor merge
moves them: only the batch is shuffled, after a partial count per key. Batches hold disjoint ids; their
order does not change results. The query cuts the corpus into ranges of ids, largest first.

Keys meet by 128 bits of SHA-256. Null texts are one empty line. Rows that share an id are one
document (a line of theirs counts once, and the largest id keeps it in all its rows); null ids are one document that ranks
before all others. Documents without long lines keep everything; an empty table gives an empty result.
Columns of the input beside id and text are not read, unless asked for.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import shared_folder, stage
from .spans import buckets

#: The id of rows without one.
NO_ID = -(1 << 63)
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without outer ASCII white space, A-Z lower-cased; others, like É, stay."""
    bare = F.btrim(line, F.lit(_BLANKS))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def text_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _rows(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(text).alias("_digest"),
        text.alias("_text"),
        *([F.struct(*keep).alias("_row")] if keep else []),
    )


def long_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """_id, _digest, at (1-based line number) and hash of every line whose key is long enough."""
    lines = rows.select("_id", "_digest", F.posexplode(text_lines(F.col("_text"))).alias("at", "line"))
    keys = lines.where(F.length("line") >= min_chars).select("_id", "_digest", (F.col("at") + 1).alias("at"), line_key(F.col("line")).alias("key"))
    half = F.substring(F.unhex(F.sha2("key", 256)), 1, 16)
    return keys.where(F.length("key") >= min_chars).select("_id", "_digest", "at", half.alias("hash"))


@dataclass
class LineIndex:
    """Runs of (hash, docs, holder): in how many documents a key was seen, and the largest id of them."""

    spark: SparkSession
    min_docs: int = 5
    fanout: int = 2
    runs: list[tuple[int, str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = f"{shared_folder(self.spark)}/creditloom/line-runs-{uuid.uuid4().hex}"

    def add(self, lines: DataFrame) -> None:
        """A batch of rows (hash, _id) becomes a run; ids of different batches differ."""
        own = lines.groupBy("hash").agg(F.count_distinct("_id").alias("docs"), F.max("_id").alias("holder"))
        for _, name in self.runs:
            run = self.spark.table(name).where(F.col("docs") >= self.min_docs).select("hash", F.col("holder").alias("known"))
            own = own.alias("own").join(run.hint("merge").alias("run"), F.expr("own.hash = run.hash and run.known > own.holder"), "left_anti")
        self._write(own, 0)
        self._compact()

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.select("hash", "docs", "holder").write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash")
            .option("path", f"{self.folder}/{name}").saveAsTable(name)
        )
        self.runs.append((level, name))

    def _merged(self, names: list[str]) -> DataFrame:
        """One row per key of some runs: sorted runs merge pairwise, in place."""
        out = self.spark.table(names[0])
        for name in names[1:]:
            more = self.spark.table(name).select("hash", F.col("docs").alias("d"), F.col("holder").alias("h"))
            out = out.hint("merge").join(more, "hash", "full_outer").select(
                "hash", (F.coalesce("docs", F.lit(0)) + F.coalesce("d", F.lit(0))).alias("docs"), F.greatest("holder", "h").alias("holder")
            )
        return out

    def _compact(self) -> None:
        level = 0
        while len(names := [n for at, n in self.runs if at == level]) >= self.fanout:
            self._write(self._merged(names), level + 1)
            self._drop(names)
            level += 1

    def _drop(self, names: list[str]) -> None:
        for name in names:
            kind = self.spark.table(name).schema
            self.spark.sql(f"DROP TABLE {name}")
            self.spark.createDataFrame([], kind).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        self.runs = [r for r in self.runs if r[1] not in names]

    def common(self) -> DataFrame:
        """hash and holder of the keys that at least ``min_docs`` documents hold."""
        if not self.runs:
            return self.spark.createDataFrame([], "hash binary, holder long")
        return self._merged([n for _, n in self.runs]).where(F.col("docs") >= self.min_docs).select("hash", "holder")

    def close(self) -> None:
        self._drop([n for _, n in self.runs])


def dropped_lines(rows: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 2) -> DataFrame:
    """_id, _digest and gone: the sorted numbers of the lines that a text loses; texts that lose none are left out."""
    spark = rows.sparkSession
    cuts = rows.approxQuantile("_id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    cuts, batch = {int(cut) for cut in cuts}, F.lit(0)
    for cut in cuts:
        batch = batch + (F.col("_id") < cut).cast("int")
    path = f"{shared_folder(spark)}/creditloom/lines-{uuid.uuid4().hex}"
    lines = long_lines(rows, min_chars).withColumn("batch", batch)
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    index = LineIndex(spark, min_docs, fanout)
    for n in range(len(cuts) + 1):
        index.add(lines.where(F.col("batch") == n))
    common = stage(index.common(), "common-lines")
    gone = lines.join(common, "hash").where(F.col("_id") != F.col("holder"))
    gone = stage(gone.groupBy("_id", "_digest").agg(F.array_sort(F.collect_set("at")).alias("gone")), "dropped-lines")
    index.close()
    spark.createDataFrame([], lines.schema).write.mode("overwrite").parquet(path)
    return gone


def _kept(text: Column, gone: Column) -> Column:
    """The text without the lines numbered in ``gone``: the runs between them, joined."""
    at = lambda i: F.when(i == 0, 0).when(i > F.size(gone), F.size("_lines") + 1).otherwise(F.try_element_at(gone, i))
    runs = F.transform(F.sequence(F.lit(0), F.size(gone)), lambda i: F.slice("_lines", at(i) + 1, at(i + 1) - at(i) - 1))
    return F.when(gone.isNull(), text).otherwise(F.array_join(F.flatten(runs), "\n"))


def remove_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",), with_text: bool = True, batches: int = 4, fanout: int = 2,
) -> DataFrame:
    """``keep`` columns, n_lines, n_dropped, kept_sha256 and, if asked for, ``kept``: the text that stays."""
    rows = _rows(docs, id_col, text_col, keep)
    gone = dropped_lines(rows.select("_id", "_digest", "_text"), min_chars, min_docs, batches, fanout)
    out = rows.join(gone, ["_id", "_digest"], "left").withColumn("_lines", text_lines(F.col("_text")))
    out = out.withColumn("_kept", _kept(F.col("_text"), F.col("gone")))
    return out.select(
        *(F.col("_row")[c].alias(c) for c in keep),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2("_kept", 256).alias("kept_sha256"),
        *([F.col("_kept").alias("kept")] if with_text else []),
    )


#: The same for DuckDB.
SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, r, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
f AS (SELECT k.*, c.key IS NULL OR holder = doc_id AS stays FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE stays), '')) AS kept_sha256
FROM f GROUP BY doc_id, r
"""
