"""Registered queries of the evaluation stage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.expr import union_all
from creditloom.operators import boost, metrics, stability
from creditloom.config import SEED
from creditloom.operators.bootstrap import LAST_SHIFT, MIXERS, STEP, TABLE_ROWS, gini_difference
from creditloom.operators.scorecard import pairwise_correlations
from creditloom.plans.common import numeric_long, r, text_long, tidy
from creditloom.sources import views
from creditloom.sources.staging import stage
from creditloom.sources.views import APP_CATEGORICAL, APP_NUMERIC, APPS_SQL, SCORED_SQL

QUERIES = {}
SQL = {}
PSI_MONTH = 40


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def staged_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the approved book: four narrow columns, written once for several passes."""
    return stage(views.scored(spark, sf).select("id", "split", "y", "p"), "scores")


SCORES_SQL = APPS_SQL + SCORED_SQL + ", s AS (SELECT id, split, y, p FROM scored WHERE approved = 1)\n"
CELLS_SQL = (
    SCORES_SQL
    + """, cells AS (SELECT split, p, count(*) AS n, sum(y) AS b, count(*) - sum(y) AS g FROM s GROUP BY split, p),
    run AS (
      SELECT *, sum(b) OVER w AS cb, sum(g) OVER w AS cg, sum(b) OVER (PARTITION BY split) AS tb,
             sum(g) OVER (PARTITION BY split) AS tg
      FROM cells WINDOW w AS (PARTITION BY split ORDER BY p)),
    power AS (
      SELECT split, sum(b * (cg - g / 2.0::DOUBLE)) / (any_value(tb) * any_value(tg)) AS auc,
             max(abs(cb / tb - cg / tg)) AS ks, CAST(sum(n) AS BIGINT) AS n,
             sum(b) / sum(n) AS bad_rate
      FROM run GROUP BY split)
    """
)


@query(
    CELLS_SQL
    + f"""SELECT split, {r('auc')} AS auc, {r('2.0::DOUBLE * auc - 1.0::DOUBLE')} AS gini, n,
          {r('bad_rate')} AS bad_rate FROM power"""
)
def auc_gini(spark: SparkSession, sf: str) -> DataFrame:
    found = metrics.discrimination(staged_scores(spark, sf), "p", "y", ["split"])
    return tidy(found.select("split", "auc", "gini", "n", "bad_rate"))


@query(CELLS_SQL + f"SELECT split, {r('ks')} AS ks FROM power")
def ks(spark: SparkSession, sf: str) -> DataFrame:
    found = metrics.discrimination(staged_scores(spark, sf), "p", "y", ["split"])
    return tidy(found.select("split", "ks"))


def bands_sql(key: str, source: str = "s") -> str:
    return f""", ranked AS (
      SELECT *, row_number() OVER (PARTITION BY split ORDER BY {key}, id) AS rn,
             count(*) OVER (PARTITION BY split) AS total FROM {source}),
    banded AS (SELECT *, CAST(greatest(1, (10 * (rn - 1) + total - 2) // greatest(total - 1, 1)) AS INTEGER)
               AS band FROM ranked)
    """


BAND_TABLE_SQL = (
    SCORES_SQL
    + bands_sql("-p")
    + """, agg AS (
      SELECT split, band, count(*) AS n, sum(y) AS bads, min(p) AS lo, max(p) AS hi
      FROM banded GROUP BY split, band),
    bands AS (
      SELECT *, bads / n AS rate, sum(bads) OVER w AS cb, sum(n) OVER w AS cn,
             sum(bads) OVER (PARTITION BY split) AS tb, sum(n) OVER (PARTITION BY split) AS tn
      FROM agg WINDOW w AS (PARTITION BY split ORDER BY band))
    """
)


@query(
    BAND_TABLE_SQL
    + f"""SELECT split, band, n AS "count", bads, {r('lo')} AS min_score, {r('hi')} AS max_score,
          n - bads AS goods, {r('rate')} AS bad_rate, {r('cb / tb')} AS cum_bad_capture,
          {r('cn / tn')} AS cum_population, {r('rate / (tb / tn)')} AS lift FROM bands"""
)
def rank_ordering(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.rank_ordering(staged_scores(spark, sf), "p", "y", "id", by="split"))


@query(
    BAND_TABLE_SQL
    + """SELECT split, bool_and(coalesce(rise <= 0, TRUE)) AS rank_ordered FROM (
          SELECT split, rate - lag(rate) OVER (PARTITION BY split ORDER BY band) AS rise FROM bands)
        GROUP BY split"""
)
def is_rank_ordered(spark: SparkSession, sf: str) -> DataFrame:
    table = metrics.rank_ordering(staged_scores(spark, sf), "p", "y", "id", by="split")
    return metrics.is_rank_ordered(table, "split")


CALIBRATION_SQL = (
    SCORES_SQL
    + bands_sql("p")
    + """, clipped AS (SELECT *, least(greatest(p, 1e-10::DOUBLE), 1.0::DOUBLE - 1e-10::DOUBLE) AS q FROM banded),
    bins AS (
      SELECT split, band, count(*) AS n, sum(y) AS sy, sum(q) AS sq, sum((y - q) * (y - q)) AS sse,
             sum(-(y * ln(q) + (1.0::DOUBLE - y) * ln(1.0::DOUBLE - q))) AS loss
      FROM clipped GROUP BY split, band),
    fit AS (
      SELECT split, sum(sse) / sum(n) AS brier, sum(loss) / sum(n) AS log_loss,
             sum(sq) / sum(n) AS expected_bad_rate, sum(sy) / sum(n) AS observed_bad_rate,
             (sum(sq) / sum(n)) / greatest(sum(sy) / sum(n), 1e-10::DOUBLE) AS calibration_ratio,
             sum(abs(sy - sq)) / sum(n) AS expected_calibration_error
      FROM bins GROUP BY split)
    """
)
_FIT = (
    "brier",
    "log_loss",
    "expected_bad_rate",
    "observed_bad_rate",
    "calibration_ratio",
    "expected_calibration_error",
)


@query(CALIBRATION_SQL + "SELECT split, " + ", ".join(f"{r(c)} AS {c}" for c in _FIT) + " FROM fit")
def calibration(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.calibration(staged_scores(spark, sf), "p", "y", "id", by="split"))


@query(
    SCORES_SQL
    + bands_sql("p")
    + f"""SELECT split, band AS bin, count(*) AS "count", {r('avg(p)')} AS predicted,
          {r('avg(y)')} AS observed, {r('avg(y) - avg(p)')} AS gap FROM banded GROUP BY split, band"""
)
def calibration_table(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.calibration_table(staged_scores(spark, sf), "p", "y", "id", by="split"))


@query(
    CELLS_SQL
    + bands_sql("-p").replace("ranked", "down").replace("banded", "down_bands")
    + bands_sql("p")
    + CALIBRATION_SQL[CALIBRATION_SQL.index(", clipped AS") :]
    + """, rates AS (SELECT split, band, sum(y) / count(*) AS rate FROM down_bands GROUP BY split, band),
    ordered AS (
      SELECT split, bool_and(coalesce(rise <= 0, TRUE)) AS rank_ordered FROM (
        SELECT split, rate - lag(rate) OVER (PARTITION BY split ORDER BY band) AS rise FROM rates)
      GROUP BY split)
    """
    + f"""SELECT split, {r('auc')} AS auc, {r('2.0::DOUBLE * auc - 1.0::DOUBLE')} AS gini, {r('ks')} AS ks,
          n, {r('bad_rate')} AS bad_rate, {', '.join(f'{r(c)} AS {c}' for c in _FIT)}, rank_ordered
          FROM power JOIN fit USING (split) JOIN ordered USING (split)"""
)
def evaluation(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.evaluate(staged_scores(spark, sf), "p", "y", "id", by="split"))


@query(SQL["evaluation"].replace("WHERE approved = 1)", "WHERE approved = 1 AND n_lines >= 2)"))
def evaluation_missing_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The evaluation where orders of fewer than two lines have no score (null or NaN)."""
    lost = F.when(F.col("n_lines") < 2, F.lit(float("nan")))
    p = F.when(F.col("n_lines") >= 2, F.col("p")).otherwise(lost)
    rows = stage(views.scored(spark, sf).select("id", "split", "y", p.alias("p")), "lost-scores")
    return tidy(metrics.evaluate(rows, "p", "y", "id", by="split"))


#: Fixed-weight scores that stand in for a card and two challengers, as SQL both engines read.
_RIVALS = {
    "scorecard": "p",
    "lines": "least(coalesce(n_lines, 0) / CAST(10 AS DOUBLE), CAST(1 AS DOUBLE))",
    "discount": "coalesce(mean_discount, CAST(0.05 AS DOUBLE)) * CAST(2 AS DOUBLE)",
}
_FIGURES = {
    "valid_auc": ("valid", "auc"),
    "oot_auc": ("oot", "auc"),
    "oot_gini": ("oot", "2.0::DOUBLE * auc - 1.0::DOUBLE"),
    "oot_ks": ("oot", "ks"),
    "oot_calibration_ratio": ("oot", "ratio"),
}


@query(
    APPS_SQL
    + SCORED_SQL
    + ", s AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS model, id, split, y, {score} AS p FROM scored WHERE approved = 1"
        for name, score in _RIVALS.items()
    )
    + f"""), cells AS (
      SELECT model, split, p, count(*) AS n, sum(y) AS b, count(*) - sum(y) AS g FROM s GROUP BY ALL),
    run AS (
      SELECT *, sum(b) OVER w AS cb, sum(g) OVER w AS cg, sum(b) OVER (PARTITION BY model, split) AS tb,
             sum(g) OVER (PARTITION BY model, split) AS tg
      FROM cells WINDOW w AS (PARTITION BY model, split ORDER BY p)),
    power AS (
      SELECT model, split, sum(b * (cg - g / 2.0::DOUBLE)) / (any_value(tb) * any_value(tg)) AS auc,
             max(abs(cb / tb - cg / tg)) AS ks FROM run GROUP BY model, split),
    fit AS (
      SELECT model, split, avg(least(greatest(p, 1e-10::DOUBLE), 1.0::DOUBLE - 1e-10::DOUBLE)) / avg(y) AS ratio
      FROM s GROUP BY model, split),
    wide AS (SELECT model, """
    + ", ".join(f"max({e}) FILTER (split = '{at}') AS {name}" for name, (at, e) in _FIGURES.items())
    + """ FROM power JOIN fit USING (model, split) GROUP BY model),
    best AS (SELECT model AS name FROM wide WHERE model <> 'scorecard' ORDER BY valid_auc DESC, model DESC LIMIT 1)
    SELECT model, """
    + ", ".join(f"{r(name)} AS {name}" for name in _FIGURES)
    + f""", model = (SELECT name FROM best) AS champion,
      CASE WHEN model = (SELECT name FROM best)
           THEN {r("oot_gini - (SELECT oot_gini FROM wide WHERE model = 'scorecard')")} END AS uplift
      FROM wide"""
)
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """One row per score; the champion among the challengers and its gain in Gini on the card."""
    book = views.scored(spark, sf)
    rows = stage(book.select("id", "split", "y", *[F.expr(e).alias(n) for n, e in _RIVALS.items()]), "rivals")
    parts = [boost.summary_row(metrics.evaluate(rows, n, "y", "id", by="split"), n) for n in _RIVALS]
    table = stage(union_all(parts), "rivals-compared")
    best = boost.champion(table, ["lines", "discount"]).first()["champion"]
    gain = boost.uplift(table, best, "scorecard").first()["uplift"]
    chosen = F.col("model") == best
    return tidy(table.select("*", chosen.alias("champion"), F.when(chosen, F.lit(gain)).alias("uplift")))


# --------------------------------------------------------------------- stability

_DECILES = "[" + ", ".join(repr(p) for p in np.linspace(0, 1, 11)[1:-1].tolist()) + "]"
_TERM = "(greatest(a, 1e-10::DOUBLE) - greatest(e, 1e-10::DOUBLE)) * ln(greatest(a, 1e-10::DOUBLE) / greatest(e, 1e-10::DOUBLE))"
_VERDICT = "CASE WHEN {v} < 0.10 THEN 'stable' WHEN {v} < 0.25 THEN 'investigate' ELSE 'unstable' END"

_PSI_SQL = (
    APPS_SQL
    + f""", long AS ({numeric_long(APP_NUMERIC, 'apps', 'id, application_month')}),
    edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {_DECILES}))) AS e
              FROM long WHERE v IS NOT NULL AND application_month < {PSI_MONTH} GROUP BY feature),
    placed AS (SELECT feature, application_month, len(list_filter(e, lambda x: x < v)) AS b
               FROM long JOIN edges USING (feature) WHERE v IS NOT NULL),
    """
)


def _sides(source: str, place: str) -> str:
    return f"""SELECT feature, {place} AS place,
             count(*) FILTER (application_month < {PSI_MONTH}) AS ne,
             count(*) FILTER (application_month >= {PSI_MONTH}) AS na FROM {source} GROUP BY ALL"""


_SUMMED = f"""shares AS (SELECT feature, ne / sum(ne) OVER (PARTITION BY feature) AS e,
               na / sum(na) OVER (PARTITION BY feature) AS a FROM sides),
    value AS (SELECT feature, sum({_TERM}) AS v FROM shares GROUP BY feature)
    """


def _early(df: DataFrame) -> DataFrame:
    return df.withColumn("early", F.col("application_month") < PSI_MONTH)


@query(
    _PSI_SQL
    + f"sides AS ({_sides('placed', 'b')}), "
    + _SUMMED
    + f"SELECT feature, {r('v')} AS psi, {_VERDICT.format(v='v')} AS verdict FROM value"
)
def psi(spark: SparkSession, sf: str) -> DataFrame:
    book = stage(views.apps(spark, sf).select("application_month", *APP_NUMERIC), "psi")
    return tidy(stability.stability(book, F.col("application_month") < PSI_MONTH, APP_NUMERIC))


_GAPS = ("total_price", "stopped", "never")


@query(
    APPS_SQL
    + f""", gaps AS (
      SELECT application_month, total_price, CAST(NULL AS DOUBLE) AS never,
             CASE WHEN application_month < {PSI_MONTH} THEN total_price END AS stopped FROM apps),
    long AS ({numeric_long(_GAPS, 'gaps', 'application_month')}),
    edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {_DECILES}))) AS e
              FROM long WHERE v IS NOT NULL AND application_month < {PSI_MONTH} GROUP BY feature),
    placed AS (SELECT feature, application_month, len(list_filter(e, lambda x: x < v)) AS b
               FROM long JOIN edges USING (feature) WHERE v IS NOT NULL),
    sides AS ({_sides('placed', 'b')}),
    {_SUMMED},
    known AS (SELECT feature FROM sides GROUP BY feature HAVING sum(ne) > 0 AND sum(na) > 0),
    asked AS (SELECT unnest({list(_GAPS)}) AS feature),
    filled AS (SELECT a.feature, CASE WHEN k.feature IS NULL THEN 0.0::DOUBLE ELSE w.v END AS v FROM asked a
               LEFT JOIN known k ON k.feature = a.feature LEFT JOIN value w ON w.feature = a.feature)
    SELECT feature, {r('v')} AS psi, {_VERDICT.format(v='v')} AS verdict FROM filled"""
)
def psi_missing_column(spark: SparkSession, sf: str) -> DataFrame:
    """A column that ends with the reference and one that is never filled: both come out, unmoved."""
    early = F.col("application_month") < PSI_MONTH
    book = views.apps(spark, sf).select(
        "application_month",
        "total_price",
        F.when(early, F.col("total_price")).alias("stopped"),
        F.lit(None).cast("double").alias("never"),
    )
    return tidy(stability.stability(stage(book, "psi-gaps"), early, _GAPS))


@query(
    _PSI_SQL
    + f"""words AS ({text_long(APP_CATEGORICAL, 'apps', 'id, application_month')}),
    sides AS ({_sides('placed', 'CAST(b AS VARCHAR)')} UNION ALL {_sides('words', "coalesce(v, 'None')")}), """
    + _SUMMED
    + f"SELECT feature, {r('v', 4)} AS csi, {_VERDICT.format(v='v')} AS verdict FROM value"
)
def csi(spark: SparkSession, sf: str) -> DataFrame:
    book = stage(
        views.apps(spark, sf).select("application_month", *APP_NUMERIC, *APP_CATEGORICAL), "csi"
    )
    return stability.characteristic_stability(
        book, F.col("application_month") < PSI_MONTH, APP_NUMERIC, APP_CATEGORICAL
    )


@query(
    _PSI_SQL
    + f"sides AS ({_sides('placed', 'b')}), "
    + _SUMMED
    + f"SELECT {_VERDICT.format(v='v')} AS verdict, count(*) AS features FROM value GROUP BY 1"
)
def psi_verdict(spark: SparkSession, sf: str) -> DataFrame:
    book = stage(views.apps(spark, sf).select("application_month", *APP_NUMERIC), "psi")
    found = stability.stability(book, F.col("application_month") < PSI_MONTH, APP_NUMERIC)
    return found.groupBy("verdict").agg(F.count(F.lit(1)).alias("features"))


@query(
    _PSI_SQL
    + f"""counts AS (SELECT feature, b, application_month, count(*) AS n FROM placed GROUP BY ALL),
    expected AS (
      SELECT feature, b, sum(n) / sum(sum(n)) OVER (PARTITION BY feature) AS e FROM counts
      WHERE application_month < {PSI_MONTH} GROUP BY feature, b),
    months AS (SELECT DISTINCT feature, application_month FROM counts WHERE application_month >= {PSI_MONTH}),
    grid AS (SELECT feature, b FROM edges, unnest(range(0, len(e) + 1)) t(b)),
    filled AS (
      SELECT m.feature, m.application_month, g.b, coalesce(e, 0.0::DOUBLE) AS e,
             coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY m.feature, m.application_month) AS a
      FROM months m JOIN grid g ON g.feature = m.feature
      LEFT JOIN expected x ON x.feature = m.feature AND x.b = g.b
      LEFT JOIN counts c ON c.feature = m.feature AND c.b = g.b AND c.application_month = m.application_month),
    value AS (SELECT feature, application_month, sum({_TERM}) AS v FROM filled GROUP BY ALL)
    """
    + f"""SELECT feature, application_month, {r('greatest(v, 0.0::DOUBLE)')} AS psi,
          {_VERDICT.format(v='v')} AS verdict FROM value"""
)
def drift_by_month(spark: SparkSession, sf: str) -> DataFrame:
    book = stage(views.apps(spark, sf).select("application_month", *APP_NUMERIC), "drift")
    early = F.col("application_month") < PSI_MONTH
    return tidy(stability.drift(book, early, APP_NUMERIC, "application_month"))


@query(
    APPS_SQL
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(f'corr({a}, {b})')} AS r FROM apps"
        for a in APP_NUMERIC
        for b in APP_NUMERIC
    )
)
def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Correlations of the raw features, each over all applications that have both."""
    return tidy(pairwise_correlations(views.apps(spark, sf), APP_NUMERIC))


_REPLICATES = 2000
_WRAP = "18446744073709551616::UHUGEINT"


def _uniform_sql(rows: str, lane: int) -> str:
    """``rows`` (with key and k) and u, the number of ``uniforms``."""
    out = f"(SELECT *, (key + (k + {1 + lane * (1 << 32)})::UHUGEINT * {STEP}::UHUGEINT) % {_WRAP} AS x FROM {rows})"
    for shift, factor in MIXERS:
        out = f"(SELECT * REPLACE ((xor(x, x >> {shift}) * {factor}::UHUGEINT) % {_WRAP} AS x) FROM {out})"
    return f"(SELECT * EXCLUDE (x), ((xor(x, x >> {LAST_SHIFT}) >> 11)::DOUBLE + 0.5) * {2.0**-53!r}::DOUBLE AS u FROM {out})"


#: Weighted ranks per replicate: each bad outranks the goods of all lower scores, ties count half.
_GINI_SQL = """(SELECT k, 2 * sum(b * (below + g / 2.0::DOUBLE)) / (sum(b) * sum(g)) - 1 AS gini FROM (
      SELECT k, b, g, sum(g) OVER (PARTITION BY k ORDER BY s) - g AS below FROM (
        SELECT k, {score} AS s, sum(CASE WHEN y = 1 THEN w ELSE 0 END) AS b, sum(CASE WHEN y = 1 THEN 0 ELSE w END) AS g FROM {rows} GROUP BY ALL))
      GROUP BY k)"""


@query(
    APPS_SQL
    + SCORED_SQL
    + f""", contest AS (SELECT y, p AS a, coalesce(n_lines, 0) / 10.0::DOUBLE AS b FROM scored WHERE split = 'oot' AND approved = 1),
    cells AS (
      SELECT a, b, y, CAST(count(*) AS DOUBLE) AS n, ('0x' || substr(md5(concat_ws(':', CAST(round(a * 1e9) AS HUGEINT), CAST(round(b * 1e9) AS HUGEINT),
        CAST(y AS INTEGER), '{SEED}')), 1, 15))::UBIGINT::UHUGEINT AS key
      FROM contest WHERE a IS NOT NULL AND y IS NOT NULL GROUP BY ALL),
    odds AS (SELECT n, list(exp(k * ln(n) - n - lgamma(k + 1.0::DOUBLE)) ORDER BY k) AS ps
             FROM (SELECT DISTINCT n FROM cells WHERE n <= {TABLE_ROWS}), unnest(range(0, CAST(floor(n + 12 * sqrt(n) + 30) AS BIGINT))) t(k) GROUP BY n),
    steps AS (SELECT n, list(total ORDER BY k) AS cdf FROM (
      SELECT n, k, sum(ps[k]) OVER (PARTITION BY n ORDER BY k) AS total FROM odds, unnest(range(1, len(ps) + 1)) t(k)) GROUP BY n),
    pairs AS (SELECT c.*, k FROM cells c, unnest(range(0, {_REPLICATES})) t(k)),
    few AS (SELECT k, a, b, y, CAST(len(list_filter(cdf, lambda x: x <= u)) AS DOUBLE) AS w FROM {_uniform_sql('pairs', 0)} JOIN steps USING (n)),
    curve AS (SELECT k, a, b, y, n, sqrt(-2 * ln(f.u)) * cos(2 * pi() * g.u) AS z
      FROM {_uniform_sql(f'(SELECT * FROM pairs WHERE n > {TABLE_ROWS})', 0)} f JOIN {_uniform_sql(f'(SELECT * FROM pairs WHERE n > {TABLE_ROWS})', 1)} g USING (k, a, b, y, n)),
    weighted AS (SELECT * FROM few UNION ALL SELECT k, a, b, y, greatest(floor(n + sqrt(n) * z + (z * z - 1) / 6 + 0.5), 0) FROM curve),
    spread AS (SELECT quantile_cont(x.gini - z.gini, [0.025, 0.975]) AS q, avg(CASE WHEN x.gini - z.gini <= 0 THEN 1 ELSE 0 END) AS below,
        avg(CASE WHEN x.gini - z.gini >= 0 THEN 1 ELSE 0 END) AS above, count(*) AS n_resamples
      FROM {_GINI_SQL.format(score='a', rows='weighted')} x JOIN {_GINI_SQL.format(score='b', rows='weighted')} z USING (k)),
    whole AS (SELECT 0 AS k, a, b, y, n AS w FROM cells)
    SELECT {r('x.gini')} AS gini_a, {r('z.gini')} AS gini_b, {r('x.gini - z.gini')} AS difference, {r('q[1]')} AS ci_low, {r('q[2]')} AS ci_high,
      {r('least(2.0::DOUBLE * least(below, above), 1.0::DOUBLE)')} AS p_two_sided, NOT (q[1] <= 0 AND q[2] >= 0) AS significant_at_95, n_resamples
    FROM spread, {_GINI_SQL.format(score='a', rows='whole')} x, {_GINI_SQL.format(score='b', rows='whole')} z"""
)
def bootstrap_gini(spark: SparkSession, sf: str) -> DataFrame:
    """The fixed-weight score against line count alone, out of time."""
    book = views.scored(spark, sf).where("split = 'oot'")
    rows = book.select("y", "p", (F.coalesce("n_lines", F.lit(0)) / 10.0).alias("q"))
    return tidy(gini_difference(stage(rows, "contest"), "p", "q", "y", replicates=_REPLICATES))
