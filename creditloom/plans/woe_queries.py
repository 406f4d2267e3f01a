"""Registered queries of the binning stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.expr import iv_strength as strength
from creditloom.operators import woe
from creditloom.operators.quality import missing_rates
from creditloom.operators.scorecard import correlation_frame
from creditloom.plans.common import numeric_long, r, text_long, tidy
from creditloom.sources import io, views
from creditloom.sources.staging import shared_folder, stage
from creditloom.sources.views import (
    APP_CATEGORICAL,
    APP_NUMERIC,
    APPS_SQL,
    OOT_MONTH,
    SPLIT_SQL,
)

QUERIES = {}
SQL = {}
# priors for the merged fit: expected direction of risk
PRIORS = {"n_lines": -1, "mean_discount": -1, "acctbal": 1}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def staged_book(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """The approved book with its split, written once for the passes of a fit."""
    book = views.with_split(views.apps(spark, sf))
    return stage(
        book.select("id", "application_month", "split", "y", *APP_NUMERIC, *APP_CATEGORICAL, *more), "book"
    )


def train_of(book: DataFrame) -> DataFrame:
    return book.where("split = 'train'")


_PROBS = "[" + ", ".join(repr(p) for p in woe.prebin_probs()) + "]"

EDGES_SQL = (
    APPS_SQL
    + f""", book AS (SELECT *, {SPLIT_SQL} AS split FROM apps WHERE approved = 1),
    train AS (SELECT * FROM book WHERE split = 'train'),
    long AS ({numeric_long(APP_NUMERIC, 'train')}),
    levels AS (
      SELECT feature, list_sort(list(DISTINCT v)) AS l,
             list_sort(list_distinct(quantile_cont(v, {_PROBS}))) AS q
      FROM long WHERE v IS NOT NULL GROUP BY feature),
    edges AS (
      SELECT feature, CASE WHEN len(l) <= 8
               THEN list_transform(range(1, len(l)), lambda i: (l[i] + l[i + 1]) / 2.0::DOUBLE)
               ELSE q END AS e FROM levels)
    """
)
COUNTS_SQL = (
    EDGES_SQL
    + """, placed AS (
      SELECT id, feature, y, CASE WHEN v IS NULL THEN -1
             ELSE len(list_filter(e, lambda x: x < v)) END AS b
      FROM long JOIN edges USING (feature)),
    counts AS (
      SELECT feature, CAST(b AS INTEGER) AS bin_index, count(*) AS "count", CAST(sum(y) AS BIGINT) AS bads
      FROM placed GROUP BY feature, b)
    """
)
WEIGHT_SQL = """, shares AS (
      SELECT *, (bads + 0.5::DOUBLE) / sum(bads + 0.5::DOUBLE) OVER (PARTITION BY feature) AS bs,
             ("count" - bads + 0.5::DOUBLE) / sum("count" - bads + 0.5::DOUBLE) OVER (PARTITION BY feature) AS gs
      FROM {counts}),
    weighed AS (SELECT *, ln(gs / bs) AS woe, (gs - bs) * ln(gs / bs) AS iv FROM shares)
    """
WOE_SQL = COUNTS_SQL + WEIGHT_SQL.format(counts="counts")
STRENGTH_SQL = """CASE WHEN iv < 0.02 THEN 'unpredictive' WHEN iv < 0.10 THEN 'weak'
       WHEN iv < 0.30 THEN 'medium' WHEN iv < 0.50 THEN 'strong' ELSE 'suspiciously strong' END"""


def prebinned(spark: SparkSession, sf: str) -> tuple[DataFrame, dict, DataFrame]:
    """The staged book, pre-bin edges of its train part, and their weighed counts."""
    book = staged_book(spark, sf)
    edges = woe.prebin_edges(train_of(book), APP_NUMERIC)
    return book, edges, woe.woe_iv(woe.bin_counts(train_of(book), "y", edges))


@query(
    EDGES_SQL
    + f"""SELECT feature, CAST(i AS INTEGER) AS edge_index, {r('e[i + 1]')} AS edge
          FROM edges, unnest(range(0, len(e))) t(i)"""
)
def prebin_edges(spark: SparkSession, sf: str) -> DataFrame:
    book = staged_book(spark, sf)
    return tidy(woe.edge_frame(spark, woe.prebin_edges(train_of(book), APP_NUMERIC)))


@query(COUNTS_SQL + 'SELECT feature, bin_index, "count", bads FROM counts')
def bin_counts(spark: SparkSession, sf: str) -> DataFrame:
    book = staged_book(spark, sf)
    edges = woe.prebin_edges(train_of(book), APP_NUMERIC)
    return woe.bin_counts(train_of(book), "y", edges)


@query(
    WOE_SQL + f"""SELECT feature, bin_index, "count", bads, {r('woe')} AS woe, {r('iv')} AS iv FROM weighed"""
)
def woe_iv(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(prebinned(spark, sf)[2])


@query(
    WOE_SQL
    + f"""SELECT feature, {r('sum(iv)')} AS iv, count(*) AS bins, {STRENGTH_SQL.replace('iv <', 'sum(iv) <')}
          AS strength FROM weighed GROUP BY feature"""
)
def iv_table(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(woe.iv_table(prebinned(spark, sf)[2]))


@query(
    WOE_SQL
    + f""", ivs AS (SELECT feature, sum(iv) AS iv FROM weighed GROUP BY feature)
        SELECT {STRENGTH_SQL} AS strength, count(*) AS features, {r('max(iv)')} AS max_iv,
               {r('median(iv)')} AS median_iv FROM ivs GROUP BY 1"""
)
def iv_strength(spark: SparkSession, sf: str) -> DataFrame:
    ivs = prebinned(spark, sf)[2].groupBy("feature").agg(F.sum("iv").alias("iv"))
    grouped = ivs.groupBy(strength(F.col("iv")).alias("strength"))
    return tidy(
        grouped.agg(
            F.count(F.lit(1)).alias("features"),
            F.max("iv").alias("max_iv"),
            F.median("iv").alias("median_iv"),
        )
    )


@query(
    WOE_SQL
    + f"""SELECT feature, printf('IV %.4f below 0.1', sum(iv)) AS reason FROM weighed
          GROUP BY feature HAVING sum(iv) < 0.1"""
)
def weak_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features below medium strength, with the reason."""
    return woe.drop_reasons(woe.iv_table(prebinned(spark, sf)[2]), 0.1)


@query(
    WOE_SQL
    + f""", ivs AS (SELECT feature, sum(iv) AS iv FROM weighed GROUP BY feature),
        top AS (SELECT feature, iv, row_number() OVER (ORDER BY iv DESC, feature) AS rn FROM ivs)
        SELECT w.feature, CAST(rn AS INTEGER) AS rank, bin_index, "count",
               {r('"count" / sum("count") OVER (PARTITION BY w.feature)')} AS share, {r('woe')} AS woe
        FROM weighed w JOIN top t ON t.feature = w.feature AND rn <= 3"""
)
def top_feature_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Bins of the three strongest features, with their rank."""
    bins = prebinned(spark, sf)[2]
    top = woe.top_features(woe.iv_table(bins), 3).select("feature", "rank")
    joined = woe.bin_table(bins).join(top, "feature")
    return tidy(joined.select("feature", "rank", "bin_index", "count", "share", "woe"))


_LEVELS_SQL = (
    APPS_SQL
    + f""", train AS (SELECT * FROM apps WHERE approved = 1 AND {SPLIT_SQL} = 'train'),
    long AS ({text_long(APP_CATEGORICAL, 'train')}),
    lv AS (SELECT feature, coalesce(v, 'Missing') AS level, count(*) AS n, sum(y) AS b FROM long GROUP BY ALL),
    floor_ AS (SELECT greatest(CAST(floor(0.03::DOUBLE * count(*)) AS BIGINT), 25) AS least_rows FROM train),
    counts AS (
      SELECT feature, CASE WHEN n < least_rows THEN '__other__' ELSE level END AS label,
             CAST(sum(n) AS BIGINT) AS "count", CAST(sum(b) AS BIGINT) AS bads
      FROM lv, floor_ GROUP BY ALL)
    """
)


@query(
    _LEVELS_SQL
    + WEIGHT_SQL.format(counts="counts")
    + f"""SELECT feature, label, "count", bads, {r('woe')} AS woe, {r('iv')} AS iv FROM weighed"""
)
def woe_categorical(spark: SparkSession, sf: str) -> DataFrame:
    train = stage(
        train_of(views.with_split(views.apps(spark, sf, gap=False))).select("y", *APP_CATEGORICAL), "levels"
    )
    smallest = max(int(0.03 * train.count()), woe.SMALLEST_BIN)
    folded = woe.fold_rare(woe.level_counts(train, "y", APP_CATEGORICAL), smallest)
    return tidy(woe.woe_iv(folded))


@query(
    """WITH docs AS (
         SELECT d.doc_id AS id, CAST(greatest(toxic, 1 - quality) AS DOUBLE) AS y, lang, source
         FROM documents d JOIN labels l ON d.doc_id = l.doc_id), """
    + f"""long AS ({text_long(('lang', 'source'), 'docs')}),
    lv AS (SELECT feature, coalesce(v, 'Missing') AS level, count(*) AS n, sum(y) AS b FROM long GROUP BY ALL),
    floor_ AS (SELECT greatest(CAST(floor(0.03::DOUBLE * count(*)) AS BIGINT), 25) AS least_rows FROM docs),
    counts AS (
      SELECT feature, CASE WHEN n < least_rows THEN '__other__' ELSE level END AS label,
             CAST(sum(n) AS BIGINT) AS "count", CAST(sum(b) AS BIGINT) AS bads
      FROM lv, floor_ GROUP BY ALL)"""
    + WEIGHT_SQL.format(counts="counts")
    + f"""SELECT feature, label, "count", bads, {r('woe')} AS woe, {r('iv')} AS iv FROM weighed"""
)
def woe_text_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Language and source of labelled texts, rare levels folded."""
    book = stage(views.docs(spark, sf).where("approved = 1").select("y", "lang", "source"), "docs")
    smallest = max(int(0.03 * book.count()), woe.SMALLEST_BIN)
    return tidy(woe.woe_iv(woe.fold_rare(woe.level_counts(book, "y", ["lang", "source"]), smallest)))


def prebinning(spark: SparkSession, sf: str) -> tuple[DataFrame, woe.Binning]:
    """The whole book, and the unmerged bins of its train part as a fitted binning."""
    book, edges, weighed = prebinned(spark, sf)
    rows = []
    for b in weighed.collect():  # at most features x (pre-bins + 1) rows
        cuts, i = edges[b["feature"]], b["bin_index"]
        missing = i == -1
        rows.append(
            {
                "feature": b["feature"],
                "kind": "numeric",
                "bin_index": len(cuts) + 1 if missing else i,
                "label": woe.MISSING if missing else str(i),
                "lower": None if missing or i == 0 else cuts[i - 1],
                "upper": None if missing else (cuts[i] if i < len(cuts) else float("inf")),
                "is_missing": missing,
                "count": b["count"],
                "bads": b["bads"],
                "event_rate": b["bads"] / b["count"],
                "woe": b["woe"],
                "iv": b["iv"],
                "direction": 0,
            }
        )
    rows.sort(key=lambda b: (b["feature"], b["bin_index"]))
    return book, woe._summarise(rows, list(APP_NUMERIC))


_APPLIED_SQL = (
    WOE_SQL
    + f""", every AS ({numeric_long(APP_NUMERIC, 'book', 'id')}),
    spots AS (
      SELECT id, feature, CASE WHEN v IS NULL THEN -1
             ELSE len(list_filter(e, lambda x: x < v)) END AS b
      FROM every JOIN edges USING (feature)),
    lowest AS (SELECT feature, woe AS w0 FROM weighed WHERE bin_index = 0),
    applied AS (
      SELECT id, spots.feature, b, coalesce(woe, CASE WHEN b = -1 THEN w0 ELSE 0.0::DOUBLE END) AS w,
             CASE WHEN b = -1 THEN CASE WHEN woe IS NULL THEN '0' ELSE 'Missing' END
                  ELSE CAST(b AS VARCHAR) END AS label
      FROM spots JOIN lowest ON lowest.feature = spots.feature
              LEFT JOIN weighed ON weighed.feature = spots.feature AND bin_index = b)
    """
)


@query(
    _APPLIED_SQL
    + "SELECT id, "
    + ", ".join(f"{r(f'''max(w) FILTER (feature = '{f}')''')} AS woe_{f}" for f in APP_NUMERIC)
    + " FROM applied GROUP BY id"
)
def woe_transform(spark: SparkSession, sf: str) -> DataFrame:
    book, binning = prebinning(spark, sf)
    return tidy(binning.transform(book, ["id"]))


@query(
    _APPLIED_SQL
    + "SELECT id, "
    + ", ".join(f"max(label) FILTER (feature = '{f}') AS {f}" for f in APP_NUMERIC)
    + " FROM applied GROUP BY id"
)
def assign_bins(spark: SparkSession, sf: str) -> DataFrame:
    book, binning = prebinning(spark, sf)
    return binning.assign(book, ["id"])


_CORR_SQL = (
    _APPLIED_SQL.replace(numeric_long(APP_NUMERIC, "book", "id"), numeric_long(APP_NUMERIC, "apps", "id"))
    + f""", texts AS ({text_long(APP_CATEGORICAL, 'train')}),
    lv AS (SELECT feature, coalesce(v, 'Missing') AS level, count(*) AS n, sum(y) AS b FROM texts GROUP BY ALL),
    floor_ AS (SELECT greatest(CAST(floor(0.03::DOUBLE * count(*)) AS BIGINT), 25) AS least_rows FROM train),
    folded AS (SELECT feature, level, CASE WHEN n < least_rows THEN '__other__' ELSE level END AS label, n, b FROM lv, floor_),
    text_counts AS (SELECT feature, label, sum(n) AS n, sum(b) AS b FROM folded GROUP BY ALL),
    text_weights AS (
      SELECT feature, label, ln((n - b + 0.5::DOUBLE) / sum(n - b + 0.5::DOUBLE) OVER (PARTITION BY feature)
                                / ((b + 0.5::DOUBLE) / sum(b + 0.5::DOUBLE) OVER (PARTITION BY feature))) AS w FROM text_counts),
    every_text AS ({text_long(APP_CATEGORICAL, 'apps', 'id')}),
    whole AS (
      SELECT id, feature, w FROM applied UNION ALL
      SELECT id, e.feature, coalesce(k.w, o.w, 0.0::DOUBLE) AS w FROM every_text e
      LEFT JOIN folded f ON f.feature = e.feature AND f.level = coalesce(e.v, 'Missing')
      LEFT JOIN text_weights k ON k.feature = e.feature AND k.label = f.label
      LEFT JOIN text_weights o ON o.feature = e.feature AND o.label = '__other__')
    SELECT a.feature AS feature_a, b.feature AS feature_b, {r('corr(a.w, b.w)')} AS r
    FROM whole a JOIN whole b ON a.id = b.id GROUP BY 1, 2"""
)


@query(_CORR_SQL)
def woe_corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Correlations of the weights of all features over all applications; missing has a bin, so no row is dropped."""
    book, binning = prebinning(spark, sf)
    train = train_of(book)
    smallest = max(int(0.03 * train.count()), woe.SMALLEST_BIN)
    levels = woe.level_counts(train, "y", APP_CATEGORICAL)
    weights = {(b["feature"], b["label"]): b["woe"] for b in woe.woe_iv(woe.fold_rare(levels, smallest)).collect()}
    apps = binning.transform(stage(views.apps(spark, sf).select("id", *APP_NUMERIC, *APP_CATEGORICAL), "apps"), APP_CATEGORICAL)
    for f in APP_CATEGORICAL:
        level = F.coalesce(F.col(f).cast("string"), F.lit(woe.MISSING))
        weight = F.lit(weights.get((f, woe.OTHER), 0.0))
        for (feature, label), w in weights.items():
            if feature == f and label != woe.OTHER:
                weight = F.when(level == label, w).otherwise(weight)
        apps = apps.withColumn(f"woe_{f}", weight)
    names = (*APP_NUMERIC, *APP_CATEGORICAL)
    apps = stage(apps.select(*(F.col(f"woe_{f}").alias(f) for f in names)), "weights")
    return tidy(correlation_frame(apps, names))


def fitted(spark: SparkSession, sf: str) -> tuple[DataFrame, woe.Binning]:
    """The staged book and the merged bins of its train part."""
    book = staged_book(spark, sf)
    binning = woe.fit_bins(
        train_of(book), "y", numeric=APP_NUMERIC, categorical=APP_CATEGORICAL, priors=PRIORS
    )
    return book, binning


_ABSORB = "list_concat({0}[1:i], list_concat([{0}[i + 1] + {0}[i + 2]], {0}[i + 3:]))"
#: The merged fit: one round of the recursion merges one bin of every feature that is not done. Phases: 1 small bins,
#: 2 trend breaks, 3 too many bins, 4 done; i is the place (from 0) of the bin that joins its right neighbour.
MERGED_SQL = (
    COUNTS_SQL.replace("WITH items", "WITH RECURSIVE items", 1)
    + f""", least AS (SELECT greatest(CAST(floor(0.03::DOUBLE * count(*)) AS BIGINT), 25) AS smallest FROM train),
    slots AS (SELECT feature, e, i FROM edges, unnest(range(0, len(e) + 1)) t(i)),
    start AS (
      SELECT s.feature, list_append(first(e), 'inf'::DOUBLE) AS u, list(coalesce("count", 0) ORDER BY i) AS c, list(coalesce(bads, 0) ORDER BY i) AS b
      FROM slots s LEFT JOIN counts k ON k.feature = s.feature AND bin_index = i GROUP BY s.feature),
    merging AS (
      SELECT feature, 1 AS phase, CASE feature {' '.join(f"WHEN '{f}' THEN {d}" for f, d in PRIORS.items())} ELSE 0 END AS direction, u, c, b FROM start
      UNION ALL
      SELECT feature, CASE WHEN i IS NULL THEN phase + 1 ELSE phase END AS phase,
        CASE WHEN i IS NULL AND phase = 1 AND direction = 0 THEN trend ELSE direction END AS direction,
        CASE WHEN i IS NULL THEN u ELSE list_concat(u[1:i], u[i + 2:]) END AS u,
        CASE WHEN i IS NULL THEN c ELSE {_ABSORB.format('c')} END AS c, CASE WHEN i IS NULL THEN b ELSE {_ABSORB.format('b')} END AS b
      FROM (
        SELECT *, CASE
            WHEN phase = 1 AND n > 2 AND list_min(c) < smallest THEN least(list_position(c, list_min(c)) - 1, n - 2)
            WHEN phase = 2 AND n > 2 AND list_min(climb) < 0 THEN list_position(climb, list_min(climb)) - 1
            WHEN phase = 3 AND n > 8 THEN list_position(apart, list_min(apart)) - 1 END AS i,
          CASE WHEN n < 2 THEN 1 WHEN list_min(w) < list_max(w) AND list_sum(list_transform(w, lambda x, k: x * (k - 1 - (n - 1) / 2.0::DOUBLE))) >= 0
            THEN 1 ELSE -1 END AS trend
        FROM (
          SELECT *, list_transform(d, lambda x: x * direction) AS climb, list_transform(d, lambda x: abs(x)) AS apart
          FROM (
            SELECT *, list_transform(range(1, n), lambda k: w[k + 1] - w[k]) AS d
            FROM (SELECT *, len(c) AS n, list_transform(c, lambda x, k: ln((x - b[k] + 0.5::DOUBLE) / (b[k] + 0.5::DOUBLE))) AS w FROM merging WHERE phase < 4))),
        least)),
    ranges AS (SELECT feature, direction, unnest(u) AS upper, unnest(list_prepend('-inf'::DOUBLE, u[:-2])) AS lower, unnest(c) AS "count", unnest(b) AS bads,
        unnest(range(0, len(c))) AS place FROM merging WHERE phase = 4),
    texts AS ({text_long(APP_CATEGORICAL, 'train')}),
    lv AS (SELECT feature, coalesce(v, 'Missing') AS level, count(*) AS n, sum(y) AS b FROM texts GROUP BY ALL),
    every_bin AS (
      SELECT feature, 'numeric' AS kind, place, CASE WHEN false THEN '' END AS label, lower, upper, false AS is_missing, "count", bads, direction FROM ranges
      UNION ALL SELECT feature, 'numeric', 99, 'Missing', NULL, NULL, true, "count", bads, 0 FROM counts WHERE bin_index = -1
      UNION ALL SELECT feature, 'categorical', 0, label, NULL, NULL, label = 'Missing', CAST(sum(n) AS BIGINT), CAST(sum(b) AS BIGINT), 0
        FROM (SELECT feature, CASE WHEN n < smallest THEN '__other__' ELSE level END AS label, n, b FROM lv, least) GROUP BY feature, label)
    """
    + WEIGHT_SQL.format(counts="every_bin")
    + r""", sides AS (
      SELECT *, regexp_replace(format('{:.4g}', lower), '^(-?\d)(\d\d\d)$', '\1,\2') AS l, regexp_replace(format('{:.4g}', upper), '^(-?\d)(\d\d\d)$', '\1,\2') AS u FROM weighed),
    merged_bins AS (
      SELECT feature, kind, CAST(CASE kind WHEN 'numeric' THEN row_number() OVER (PARTITION BY feature ORDER BY place)
               ELSE row_number() OVER (PARTITION BY feature ORDER BY woe, label) END - 1 AS INTEGER) AS bin_index,
             coalesce(label, '(' || l || ', ' || u || ']') AS label, lower, upper, is_missing, "count", bads,
             CASE WHEN "count" > 0 THEN bads / "count"::DOUBLE ELSE 0 END AS event_rate, woe, iv, direction FROM sides),
    moves AS (SELECT *, (woe - lag(woe) OVER (PARTITION BY feature ORDER BY bin_index)) * direction AS climb FROM merged_bins WHERE NOT is_missing)
    """
)


@query(
    MERGED_SQL
    + f"""SELECT feature, kind, bin_index, label, {r('lower')} AS lower, {r('upper')} AS upper, is_missing, "count", bads,
          {r('event_rate')} AS event_rate, {r('woe')} AS woe, {r('iv')} AS iv, {r('"count" / sum("count") OVER (PARTITION BY feature)')} AS share
        FROM merged_bins"""
)
def woe_fit_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Merged, monotone bins of every feature."""
    _, binning = fitted(spark, sf)
    return tidy(woe.bin_table(binning.bin_frame(spark)))


@query(
    MERGED_SQL
    + f""", trends AS (SELECT feature, max(direction) + min(direction) AS twice, coalesce(bool_and(climb >= -1e-9), true) AS monotonic FROM moves GROUP BY feature),
      cuts AS (SELECT feature, string_agg(printf('%.6f', upper), ', ' ORDER BY bin_index) AS edges FROM merged_bins WHERE upper < 'inf'::DOUBLE GROUP BY feature)
      SELECT b.feature, b.kind, coalesce(first(edges), '') AS edges, {r('sum(iv)')} AS iv, first(monotonic) AS monotonic,
        CAST(coalesce(first(twice) // 2, 0) AS INTEGER) AS direction
      FROM merged_bins b LEFT JOIN trends t ON t.feature = b.feature LEFT JOIN cuts c ON c.feature = b.feature GROUP BY b.feature, b.kind"""
)
def woe_fit_features(spark: SparkSession, sf: str) -> DataFrame:
    """Edges (as text), information value and direction of every feature."""
    _, binning = fitted(spark, sf)
    edges = F.array_join(F.transform("edges", lambda e: F.format_string("%.6f", e)), ", ")
    return tidy(binning.feature_frame(spark).withColumn("edges", edges))


_MONOTONIC_SQL = ", trends AS (SELECT feature, coalesce(bool_and(climb >= -1e-9), true) AS monotonic FROM moves GROUP BY feature) "
_PLACED = ", ".join(r(f"max(w) FILTER (feature = '{f}')") + f" AS woe_{f}" for f in (*APP_NUMERIC, *APP_CATEGORICAL))


@query(
    MERGED_SQL
    + _MONOTONIC_SQL
    + f"""SELECT feature, round(iv, 6) AS iv, {STRENGTH_SQL} AS strength, bins, monotonic, kind FROM (
      SELECT b.feature, sum(iv) AS iv, count(*) AS bins, first(monotonic) AS monotonic, first(kind) AS kind
      FROM merged_bins b JOIN trends t ON t.feature = b.feature GROUP BY b.feature)"""
)
def iv_table_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Information value, strength, bins, monotony and kind of every fitted feature."""
    return tidy(fitted(spark, sf)[1].iv_frame(spark))


@query(
    MERGED_SQL
    + f""", nums AS ({numeric_long(APP_NUMERIC, 'book', 'id')}), words AS ({text_long(APP_CATEGORICAL, 'book', 'id')}),
    placed_rows AS (
      SELECT id, n.feature, coalesce(b.woe, l.woe) AS w FROM nums n
      LEFT JOIN merged_bins b ON b.feature = n.feature AND CASE WHEN n.v IS NULL THEN b.is_missing ELSE NOT b.is_missing AND n.v > b.lower AND n.v <= b.upper END
      JOIN merged_bins l ON l.feature = n.feature AND l.bin_index = 0
      UNION ALL
      SELECT id, e.feature, coalesce(k.woe, o.woe, 0.0::DOUBLE) FROM words e
      LEFT JOIN merged_bins k ON k.feature = e.feature AND k.label = coalesce(e.v, 'Missing')
      LEFT JOIN merged_bins o ON o.feature = e.feature AND o.label = '__other__')
    SELECT id, {_PLACED} FROM placed_rows GROUP BY id"""
)
def woe_fit_transform(spark: SparkSession, sf: str) -> DataFrame:
    """The book under its own merged bins, which were saved and loaded before use."""
    book, binning = fitted(spark, sf)
    path = f"{shared_folder(spark)}/creditloom/binner-{uuid.uuid4().hex}"
    binning.save(spark, path)
    return tidy(woe.Binning.load(spark, path).transform(book, ["id"]))


@query(
    MERGED_SQL
    + f"""SELECT feature, kind, {r('sum(iv)')} AS iv, CAST(to_json(list({{'label': label, 'count': "count", 'bads': bads,
          'woe': printf('%.6f', woe + 0.0)}} ORDER BY bin_index)) AS VARCHAR) AS json FROM merged_bins GROUP BY feature, kind"""
)
def woe_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted bins nested per feature, in order, and as JSON (weights as text of six places)."""
    _, binning = fitted(spark, sf)
    brief = F.transform("bins", lambda b: F.struct(b["label"].alias("label"), b["count"].alias("count"), b["bads"].alias("bads"),
                                                   F.format_string("%.6f", b["woe"]).alias("woe")))
    return tidy(io.nested_bins(binning.bin_frame(spark)).select("feature", "kind", "iv", F.to_json(brief).alias("json")))


_HOLES_SQL = (
    APPS_SQL
    + """, holes AS (SELECT CASE WHEN acctbal < 0 THEN NULL ELSE CAST(n_lines % 4 AS DOUBLE) END AS few,
                            CASE WHEN n_lines % 3 = 0 THEN NULL ELSE total_price END AS wide FROM apps)
    """
)


def _holes(spark: SparkSession, sf: str) -> DataFrame:
    """Two columns with missing values, some null and some NaN."""
    apps = views.apps(spark, sf, gap=False)
    lost = F.when(F.col("id") % 2 == 0, F.lit(float("nan")))
    few = F.when(F.col("acctbal") < 0, lost).otherwise((F.col("n_lines") % 4).cast("double"))
    wide = F.when(F.col("n_lines") % 3 == 0, lost).otherwise(F.col("total_price"))
    return stage(apps.select(few.alias("few"), wide.alias("wide")), "holes")


@query(
    _HOLES_SQL
    + f""", long AS (SELECT unnest(['few', 'wide']) AS feature, unnest([few, wide]) AS v FROM holes),
    levels AS (SELECT feature, list_sort(list(DISTINCT v)) AS l, list_sort(list_distinct(quantile_cont(v, {_PROBS}))) AS q FROM long WHERE v IS NOT NULL GROUP BY feature),
    edges AS (SELECT feature, CASE WHEN len(l) <= 8 THEN list_transform(range(1, len(l)), lambda i: (l[i] + l[i + 1]) / 2.0::DOUBLE) ELSE q END AS e FROM levels)
    SELECT feature, CAST(i AS INTEGER) AS edge_index, {r('e[i + 1]')} AS edge FROM edges, unnest(range(0, len(e))) t(i)"""
)
def prebin_edges_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Cut points of columns with null and NaN."""
    return tidy(woe.edge_frame(spark, woe.prebin_edges(_holes(spark, sf), ["few", "wide"])))


_RATE = r("avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)")


@query(_HOLES_SQL + " UNION ALL ".join(f"SELECT '{c}' AS feature, {_RATE.format(c=c)} AS missing_rate FROM holes" for c in ("few", "wide")))
def missing_rate_nan(spark: SparkSession, sf: str) -> DataFrame:
    """Missing rates where some missing values are NaN."""
    return tidy(missing_rates(_holes(spark, sf), ["few", "wide"]))
