"""Exact ranks, quantiles and running totals without a one-task sort.

A window ordered over a whole table puts every row into one task. Beyond a checked row count
everything here instead cuts the order into buckets of about equal size, with bounds taken
from a mergeable KLL sketch. The sketch only balances the work: counts per bucket are exact,
so results do not depend on where the bounds fall. Equal values are collapsed before the
shuffle, so one value holding a third of all rows is one row by the time it moves.

A missing order value (null or NaN) has no place in an order: it is left out of ranks, buckets
and totals and gets no band, below the row count and above it. A null group is a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.functions.expr import in_chunks, present, union_all, with_bins

SALTS = 256
MAX_BUCKETS = 16384
ONE_TASK_KEY = "spark.creditloom.oneTaskRows"
INTEGRAL = ("bigint", "int", "smallint", "tinyint")


def one_task_rows(spark: SparkSession) -> int:
    """Row count up to which one task may sort a group; above it the order is bucketed."""
    return int(spark.conf.get(ONE_TASK_KEY, "1000000"))


def bucket_count(spark: SparkSession, columns: int = 1, rows: int = 0) -> int:
    """One bucket per shuffle partition, and more where ``rows`` would overfill one task's sort.

    Many columns at once share a limit on the number of cut points a plan has to carry; past
    the limits a bucket grows and its sort spills, the results stay.
    """
    full = -(-rows // max(one_task_rows(spark), 1))
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8, full)
    return min(wanted, MAX_BUCKETS, max(2 * MAX_BUCKETS // columns, 64))


def splitters(df: DataFrame, columns: Sequence[str], buckets: int) -> dict[str, list[float]]:
    """Approximate cut points per column.

    Sketches are built per salt and merged in a second step, so no single task merges the
    sketches of every input split.
    """
    probs = F.expr("array(" + ", ".join(f"{i / buckets!r}D" for i in range(1, buckets)) + ")")
    k = min(max(4 * buckets, 200), 8000)
    salted = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt")).agg(
        *[
            F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"_k{i}")
            for i, c in enumerate(columns)
        ]
    )
    merged = salted.agg(
        *[F.kll_merge_agg_double(f"_k{i}").alias(f"_k{i}") for i in range(len(columns))]
    )
    cuts = merged.select(
        *[
            F.when(
                F.kll_sketch_get_n_double(f"_k{i}") > 0,
                F.kll_sketch_get_quantile_double(f"_k{i}", probs),
            )
            for i in range(len(columns))
        ]
    ).first()
    return {c: sorted(set(cuts[i] or ())) for i, c in enumerate(columns)}


def _long(df: DataFrame, columns: Sequence[str], cuts: dict[str, list[float]]) -> DataFrame:
    """(which column, bucket, value) rows; missing values are left out."""
    types = dict(df.dtypes)
    target = "bigint" if all(types[c] in INTEGRAL for c in columns) else "double"
    parts = []
    for chunk in in_chunks(columns):
        cells = ", ".join(
            f"named_struct('k', {columns.index(c)}, 'b', `_bin_{c}`, 'v', CAST(`{c}` AS {target}))"
            for c in chunk
        )
        placed = with_bins(df.select(*chunk), {c: cuts[c] for c in chunk})
        parts.append(placed.select(F.expr(f"inline(array({cells}))")).where(present("v")))
    return union_all(parts)


def order_statistics(
    df: DataFrame, wanted: dict[str, Sequence[int]] | None = None, *, probs=None, columns=None
) -> dict[str, dict[int, float]]:
    """Exact values at 1-based ranks of each column, ``{column: {rank: value}}``.

    Rank 0 maps to the column's row count. ``wanted`` names the ranks; or ``probs`` and
    ``columns`` ask for the two neighbours that a linearly interpolated quantile needs. A large
    column is cut into buckets, counted, and only the buckets holding a wanted rank are sorted.
    """
    columns = list(columns or wanted)
    counts = df.agg(*[F.count_if(present(c)) for c in columns]).first()
    totals = dict(zip(columns, counts, strict=True))
    found = runs_at(df, wanted, totals, probs=probs)
    return {c: {0: totals[c], **{r: v for r, (v, _, _) in found[c].items()}} for c in columns}


def runs_at(
    df: DataFrame, wanted: dict[str, Sequence[int]] | None, totals: dict[str, int], *, probs=None
) -> dict[str, dict[int, tuple]]:
    """What ``order_statistics`` finds, with its run: ``{column: {rank: (value, rows below it, rows that share it)}}``.

    ``totals``: how many values each column has.
    """
    columns = list(totals)
    spark = df.sparkSession
    large = max(totals.values()) > one_task_rows(spark)
    if large:
        cuts = splitters(df, columns, bucket_count(spark, len(columns), max(totals.values())))
    else:
        cuts = {c: [] for c in columns}
    cells = _long(df, columns, cuts)
    if large:
        counted = cells.groupBy("k", "b").agg(F.count("*").alias("n")).collect()
        sizes = {(r["k"], r["b"]): r["n"] for r in counted}
    else:
        sizes = {(k, 0): totals[c] for k, c in enumerate(columns)}

    targets, ahead = [], {}
    for k, column in enumerate(columns):
        if probs is None:
            need = set(wanted[column])
        else:
            at = np.asarray(probs, dtype=float) * max(totals[column] - 1, 0)
            need = {int(f(x)) + 1 for x in at for f in (np.floor, np.ceil)}
        before = 0
        for b, n in sorted((b, n) for (kk, b), n in sizes.items() if kk == k):
            targets += [(k, b, r, r - before) for r in sorted(need) if before < r <= before + n]
            ahead[k, b] = before
            before += n
    out = {c: {} for c in columns}
    if not targets:
        return out

    # at most (columns x wanted ranks) rows, whatever the data size
    goals = F.broadcast(spark.createDataFrame(targets, "k int, b int, rank long, local long"))
    if large:
        spots = spark.createDataFrame(sorted({(t[0], t[1]) for t in targets}), "k int, b int")
        cells = cells.join(F.broadcast(spots), ["k", "b"], "left_semi")
    upto = F.sum("n").over(Window.partitionBy("k", "b").orderBy("v"))
    placed = cells.groupBy("k", "b", "v").agg(F.count("*").alias("n")).withColumn("upto", upto)
    hits = placed.join(goals, ["k", "b"]).where(
        (F.col("local") <= F.col("upto")) & (F.col("local") > F.col("upto") - F.col("n"))
    )
    for r in hits.select("k", "b", "rank", "v", "n", "upto").collect():
        out[columns[r["k"]]][r["rank"]] = (r["v"], ahead[r["k"], r["b"]] + r["upto"] - r["n"], r["n"])
    return out


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Exact quantiles with linear interpolation; an all-missing column has none."""
    if not columns:
        return {}
    found = order_statistics(df, probs=probs, columns=columns)
    result = {}
    for column, at in found.items():
        total, row = at[0], []
        for p in probs if total else ():
            position = float(p) * (total - 1)
            low, high = int(np.floor(position)), int(np.ceil(position))
            a, b = float(at[low + 1]), float(at[high + 1])
            row.append(a + (b - a) * (position - low))
        result[column] = row
    return result


def with_bucket(df: DataFrame, order: str, rows: int | None = None) -> DataFrame:
    """Add ``_bucket``: equal-sized slices of the order, never splitting equal values.

    A frame small enough for one task per group gets a single bucket. Rows without an order
    value are left out. ``rows``: how many there are, if the caller has counted them.
    """
    spark = df.sparkSession
    df = df.where(present(order))
    rows = df.count() if rows is None else rows
    if rows <= one_task_rows(spark):
        return df.withColumn("_bucket", F.lit(0))
    edges = splitters(df, [order], bucket_count(spark, rows=rows))
    return with_bins(df, edges, "_at_").withColumnRenamed(f"_at_{order}", "_bucket")


def running_totals(
    cells: DataFrame, by: Sequence[str], order: str, sums: Sequence[str]
) -> DataFrame:
    """Exclusive running totals and group totals of ``sums`` in ``order`` within ``by``.

    ``cells`` holds one row per (group, order value) and a ``_bucket`` column. Adds
    ``<s>_before`` and ``<s>_total``. Sorting is per (group, bucket); the window per group
    runs over bucket totals, whose number is bounded by the bucket count.
    """
    inside = Window.partitionBy(*by, "_bucket").orderBy(order)
    local = cells.select(
        "*", *[(F.sum(s).over(inside) - F.col(s)).alias(f"_{s}_in") for s in sums]
    )
    per_bucket = cells.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(s) for s in sums])
    group = Window.partitionBy(*(by or [F.lit(0)]))
    ahead = group.orderBy("_bucket")
    offsets = per_bucket.select(
        *[F.col(c).alias(f"_of_{c}") for c in [*by, "_bucket"]],
        *[(F.sum(s).over(ahead) - F.col(s)).alias(f"_{s}_off") for s in sums],
        *[F.sum(s).over(group).alias(f"{s}_total") for s in sums],
    )
    same = [local[c].eqNullSafe(offsets[f"_of_{c}"]) for c in [*by, "_bucket"]]
    return local.join(offsets, reduce(Column.__and__, same)).select(
        *cells.columns,
        *[(F.col(f"_{s}_in") + F.col(f"_{s}_off")).alias(f"{s}_before") for s in sums],
        *[f"{s}_total" for s in sums],
    )


def band_of_rank(rank: Column, total: Column, bands: int) -> Column:
    """Equal-frequency band of a 1-based rank, cut at interpolated quantiles of the rank."""
    inner = (F.lit(bands) * (rank - 1) + total - 2) / F.greatest(total - 1, F.lit(1))
    return F.greatest(F.lit(1), F.floor(inner)).cast("int")


def band_limits(
    df: DataFrame, keys: Sequence[str], tie: str, bands: int, totals: dict, by: str | None = None
) -> dict[str, dict[object, list[tuple]]]:
    """Last (key, tie) pair of each equal-frequency band but the last, per key and group.

    Band ``j`` ends at rank ``1 + floor(j * (n - 1) / bands)`` in (key, tie) order. The keys are
    located first, all in the same passes; only where a run of equal keys straddles a band end is the tie-break column
    searched too, among the rows of that run alone.
    """
    groups = [g for g, n in totals.items() if n]
    ends = [[1 + (j * (totals[g] - 1)) // bands for j in range(1, bands)] for g in groups]
    columns = {(key, i): f"k{k}g{i}" for k, key in enumerate(keys) for i in range(len(groups))}
    wide = df.select(
        tie,
        *[
            (F.col(key) if by is None else F.when(F.col(by).eqNullSafe(F.lit(groups[i])), F.col(key))).alias(c)
            for (key, i), c in columns.items()
        ],
    )
    wanted = {c: ends[i] for (_, i), c in columns.items()}
    at = runs_at(wide, wanted, {c: totals[groups[i]] for (_, i), c in columns.items()})

    straddled: dict[tuple, set[int]] = {}
    for c, ranks in wanted.items():
        for r in ranks:
            value, below, same = at[c][r]
            if r - below < same:
                straddled.setdefault((c, value, same), set()).add(r - below)
    ties = {}
    if straddled:
        names = {run: f"t{j}" for j, run in enumerate(straddled)}
        members = wide.select(
            *[F.when(F.col(c) == F.lit(v), F.col(tie)).alias(t) for (c, v, _), t in names.items()]
        )
        found = runs_at(members, {t: sorted(straddled[run]) for run, t in names.items()}, {t: run[2] for run, t in names.items()})
        ties = {run: found[t] for run, t in names.items()}

    limits: dict[str, dict[object, list[tuple]]] = {key: {} for key in keys}
    for (key, i), c in columns.items():
        limits[key][groups[i]] = [
            (value, ties.get((c, value, same), {}).get(r - below, (None,))[0]) for r in ends[i] for value, below, same in [at[c][r]]
        ]
    return limits


def _band_index(key: str, tie: str, limits: dict[object, list[tuple]], by: str | None) -> Column:
    """Band of a row from the limits: one projection, no shuffle."""

    def within(group: list[tuple]) -> Column:
        band = F.lit(1)
        for value, last in group:
            past = F.col(key) > F.lit(value)
            if last is not None:
                past = past | ((F.col(key) == F.lit(value)) & (F.col(tie) > F.lit(last)))
            band = band + F.when(past, 1).otherwise(0)
        return band

    if by is None:
        return F.when(present(key), within(limits[None]))
    chain = F
    for g, group in limits.items():
        chain = chain.when(present(key) & F.col(by).eqNullSafe(F.lit(g)), within(group))
    return chain


def group_sizes(df: DataFrame, needed: Sequence[str], by: str | None = None) -> dict:
    """Rows per group that have every needed number."""
    counted = (df.groupBy(by) if by else df.groupBy()).agg(F.count_if(present(*needed)).alias("n")).collect()
    return {(r[by] if by else None): r["n"] for r in counted}


def with_band(
    df: DataFrame, key: str, tie: str, bands: int = 10, by: str | None = None, name: str = "band",
    totals: dict | None = None, limits: dict | None = None,
) -> DataFrame:
    """Add the equal-frequency band of (key, tie) order, within each ``by`` group.

    ``by`` is a short list of groups such as splits. ``tie`` must be a unique integer. Rows
    without a key get no band and do not count. ``totals``: rows with a key per group, if the caller has counted them;
    ``limits``: of this key from ``band_limits``, if the caller has found them.
    """
    totals = group_sizes(df, [key], by) if totals is None else totals
    if sum(totals.values()) <= one_task_rows(df.sparkSession):
        ranked = present(key)
        group = Window.partitionBy(*([by] if by else []), ranked)
        rank = F.row_number().over(group.orderBy(key, tie))
        total = F.count(F.lit(1)).over(group)
        return df.withColumn(name, F.when(ranked, band_of_rank(rank, total, bands)))
    if limits is None:
        limits = band_limits(df, [key], tie, bands, totals, by)[key]
    return df.withColumn(name, _band_index(key, tie, limits, by))
