"""Registered queries of the scorecard, scaling, policy and boosted-tree stages."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.config import ECONOMICS, SCALE
from creditloom.functions.expr import risk_band as band_of
from creditloom.operators import boost, isotonic, policy, scale, scorecard
from creditloom.operators.metrics import evaluate
from creditloom.operators.newton import newton
from creditloom.plans.common import r, tidy
from creditloom.plans.metric_queries import SCORES_SQL, bands_sql, staged_scores
from creditloom.plans.metric_queries import SQL as METRIC_SQL
from creditloom.plans.woe_queries import (
    WOE_SQL,
    _APPLIED_SQL,
    fitted,
    prebinned,
    prebinning,
    train_of,
)
from creditloom.sources import io, views
from creditloom.sources.staging import shared_folder, stage
from creditloom.sources.views import APPS_SQL, OUTCOMES_SQL, SCORED_SQL

QUERIES = {}
SQL = {}

# fixed coefficients for the queries that take a card as given
CARD = {"n_lines": -0.8, "mean_discount": -0.35, "mean_quantity": -0.3, "acctbal": -0.1}
INTERCEPT = -1.9


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def newton_sql(rows: str, k: int, *, penalty: float = 0.0, steps: int = 12) -> str:
    """Recursive CTEs ``newton`` (one row a step) and ``fit`` (the last) for a logistic fit of two or three coefficients.

    ``rows`` has x0 .. (the last is the constant 1), y and w; c0 .. are the coefficients, v0 .. their variances.
    """
    names = range(k)
    z = " + ".join(f"c{i} * x{i}" for i in names)
    sums = [f"sum(w * (y - p) * x{i}) AS g{i}" for i in names] + [f"sum(w * p * (1 - p) * x{i} * x{j}) AS h{i}{j}" for i in names for j in names if i <= j]
    h = lambda i, j: f"h{min(i, j)}{max(i, j)}" + (f" + {penalty!r}::DOUBLE" if penalty and i == j and i < k - 1 else "")
    g = [f"(g{i}" + (f" - {penalty!r}::DOUBLE * c{i}" if penalty and i < k - 1 else "") + ")" for i in names]

    def det(cells: list[list[str]]) -> str:
        if len(cells) == 1:
            return f"({cells[0][0]})"
        parts = [f"{'-' if j % 2 else '+'} ({a}) * {det([line[:j] + line[j + 1 :] for line in cells[1:]])}" for j, a in enumerate(cells[0])]
        return "(" + " ".join(parts) + ")"

    matrix = [[h(i, j) for j in names] for i in names]
    whole = det(matrix)
    moved = [det([[g[i] if j == c else matrix[i][j] for j in names] for i in names]) for c in names]
    free = [[f"h{min(i, j)}{max(i, j)}" for j in names] for i in names]  # tests rest on the curvature without the penalty
    minors = [det([[free[i][j] for j in names if j != c] for i in names if i != c]) for c in names]
    old = ", ".join(f"c{i}" for i in names)
    return f"""newton AS (
      SELECT 0 AS step, {", ".join(f"0.0::DOUBLE AS c{i}" for i in names)}, {", ".join(f"0.0::DOUBLE AS v{i}" for i in names)}
      UNION ALL
      SELECT step + 1, {", ".join(f"c{i} + {moved[i]} / {whole} AS c{i}" for i in names)}, {", ".join(f"{minors[i]} / {det(free)} AS v{i}" for i in names)} FROM (
        SELECT step, {old}, {", ".join(sums)} FROM (
          SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))) AS p FROM newton, {rows} WHERE step < {steps}) GROUP BY step, {old})),
    fit AS (SELECT * FROM newton WHERE step = {steps})
    """


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def score_sql(p: str) -> str:
    q = f"least(greatest({p}, 1e-9::DOUBLE), 1.0::DOUBLE - 1e-9::DOUBLE)"
    raw = f"{SCALE.offset!r}::DOUBLE - {SCALE.factor!r}::DOUBLE * ln({q} / (1.0::DOUBLE - {q}))"
    return f"CAST(least(greatest(round_even({raw}, 0), 300), 850) AS INTEGER)"


def inverse_sql(s: str) -> str:
    return f"1.0::DOUBLE / (1.0::DOUBLE + exp(-(({SCALE.offset!r}::DOUBLE - {s}) / {SCALE.factor!r}::DOUBLE)))"


BAND_SQL = """CASE WHEN {s} BETWEEN 740 AND 850 THEN 'A' WHEN {s} BETWEEN 680 AND 739 THEN 'B'
     WHEN {s} BETWEEN 620 AND 679 THEN 'C' WHEN {s} BETWEEN 560 AND 619 THEN 'D' ELSE 'E' END"""

_POINTED = APPS_SQL + SCORED_SQL + f", pts AS (SELECT *, {score_sql('p')} AS score FROM scored)\n"


def _pointed(spark: SparkSession, sf: str) -> DataFrame:
    book = views.scored(spark, sf, approved_only=False)
    return book.withColumn("score", scale.probability_to_score(F.col("p")))


@query(_POINTED + "SELECT id, p, score FROM pts")
def score_scale(spark: SparkSession, sf: str) -> DataFrame:
    return _pointed(spark, sf).select("id", "p", "score")


@query(
    _POINTED
    + f"""SELECT score, count(*) AS rows, {r(inverse_sql('score'))} AS p_at_score FROM pts GROUP BY score"""
)
def score_inverse(spark: SparkSession, sf: str) -> DataFrame:
    counts = _pointed(spark, sf).groupBy("score").agg(F.count(F.lit(1)).alias("rows"))
    return tidy(counts.withColumn("p_at_score", scale.score_to_probability(F.col("score"))))


@query(
    _POINTED
    + f"""SELECT {BAND_SQL.format(s='score')} AS band, count(*) AS rows, {r('avg(p)')} AS mean_p,
          {r('avg(y)')} AS bad_rate FROM pts GROUP BY 1"""
)
def risk_band(spark: SparkSession, sf: str) -> DataFrame:
    grouped = _pointed(spark, sf).groupBy(band_of(F.col("score")).alias("band"))
    return tidy(
        grouped.agg(
            F.count(F.lit(1)).alias("rows"), F.avg("p").alias("mean_p"), F.avg("y").alias("bad_rate")
        )
    )


@query(
    _POINTED
    + f""", bands AS (SELECT * FROM (VALUES ('A', 740, 850), ('B', 680, 739), ('C', 620, 679),
               ('D', 560, 619), ('E', 300, 559)) t(band, min_score, max_score)),
    held AS (SELECT {BAND_SQL.format(s='score')} AS band, count(*) AS n FROM pts GROUP BY 1)
    SELECT band, min_score, max_score, {r(inverse_sql('(min_score + max_score) / 2.0::DOUBLE'), 4)} AS indicative_pd,
           coalesce(n, 0) AS rows FROM bands LEFT JOIN held USING (band)"""
)
def band_table(spark: SparkSession, sf: str) -> DataFrame:
    """The policy bands with the number of applications in each."""
    held = _pointed(spark, sf).groupBy(band_of(F.col("score")).alias("band"))
    counts = held.agg(F.count(F.lit(1)).alias("rows"))
    return scale.band_table(spark).join(counts, "band", "left").fillna(0, ["rows"])


_RULE = """(CASE WHEN days_since_prev > 180 THEN 1.10::DOUBLE ELSE 0.0::DOUBLE END
   + CASE WHEN total_price > 15000 THEN 0.95::DOUBLE ELSE 0.0::DOUBLE END
   + 1.10::DOUBLE * coalesce(mean_discount * 10.0::DOUBLE, 0.35::DOUBLE)
   - CASE WHEN coalesce(mean_quantity, 0.0::DOUBLE) > 30 THEN 1.30::DOUBLE ELSE 0.0::DOUBLE END
   - CASE WHEN n_lines > 12 THEN 0.75::DOUBLE ELSE 0.0::DOUBLE END
   - CASE WHEN application_month % 30 > 12 THEN 0.85::DOUBLE ELSE 0.0::DOUBLE END
   + 0.60::DOUBLE * approved
   - CASE WHEN n_lines >= 3 THEN 0.55::DOUBLE ELSE 0.0::DOUBLE END)"""


@query(
    APPS_SQL
    + f""", ruled AS (SELECT id, round({_RULE}, 6) AS rule_score FROM apps),
    cut AS (SELECT quantile_cont(rule_score, {1 - 0.62!r}) AS cutoff FROM ruled)
    SELECT id, {r('rule_score')} AS rule_score, {r('cutoff')} AS cutoff,
           CASE WHEN rule_score >= cutoff THEN 1 ELSE 0 END AS approved FROM ruled, cut"""
)
def rule_policy(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    points = scale.rule_score(
        tenure=c("days_since_prev"),
        inflow=c("total_price"),
        ontime=c("mean_discount") * 10.0,
        worst_dpd=c("mean_quantity"),
        betting=c("n_lines"),
        zero_days=c("application_month") % 30,
        salary=c("approved"),
        lenders=c("n_lines"),
    )
    book = views.apps(spark, sf, customer=False).select("id", F.round(points, 6).alias("rule_score"))
    return tidy(scale.approve_top(stage(book, "rules"), "rule_score"))


# -------------------------------------------------------------- scorecard, fixed card

_CARD_SQL = ", ".join(f"('{f}', {c!r}::DOUBLE)" for f, c in CARD.items())
_BASE = (SCALE.offset - SCALE.factor * INTERCEPT) / len(CARD)


@query(
    WOE_SQL
    + f""", card AS (SELECT * FROM (VALUES {_CARD_SQL}) t(feature, coefficient))
    SELECT feature, bin_index, {r(f'{_BASE!r}::DOUBLE - {SCALE.factor!r}::DOUBLE * coefficient * woe')} AS points
    FROM weighed JOIN card USING (feature)"""
)
def points_allocation(spark: SparkSession, sf: str) -> DataFrame:
    bins = prebinned(spark, sf)[2]
    card = spark.createDataFrame(list(CARD.items()), "feature string, coefficient double")
    allocated = scorecard.points(bins, card, INTERCEPT, len(CARD))
    return tidy(allocated.select("feature", "bin_index", "points"))


_LINEAR = " + ".join(f"{c!r}::DOUBLE * max(w) FILTER (feature = '{f}')" for f, c in CARD.items())
_CARD_SCORED = (
    _APPLIED_SQL
    + f""", z AS (SELECT id, {_LINEAR} + ({INTERCEPT!r}::DOUBLE) AS z FROM applied GROUP BY id),
    pd AS (SELECT id, z, 1.0::DOUBLE / (1.0::DOUBLE + exp(-z)) AS p FROM z)
    """
)


def _card() -> scorecard.Scorecard:
    return scorecard.Scorecard(dict(CARD), INTERCEPT)


@query(_CARD_SCORED + f"SELECT id, {r('p')} AS p, {score_sql('p')} AS score FROM pd")
def scorecard_score(spark: SparkSession, sf: str) -> DataFrame:
    book, binning = prebinning(spark, sf)
    return tidy(_card().apply(binning.transform(book, ["id"], CARD), ["id"]))


@query(
    _CARD_SCORED
    + f"""SELECT id, {r(f'{SCALE.offset!r}::DOUBLE - {SCALE.factor!r}::DOUBLE * z', 4)} AS total_points FROM pd"""
)
def points_sum(spark: SparkSession, sf: str) -> DataFrame:
    """A row's bin points added up: its score before rounding and clipping."""
    book, binning = prebinning(spark, sf)
    woe = binning.transform(book, ["id"], CARD)
    card = _card()
    total = sum(
        (F.lit(card.base_points) - F.lit(SCALE.factor * c) * F.col(f"woe_{f}") for f, c in CARD.items()),
        F.lit(0.0),
    )
    return tidy(woe.select("id", total.alias("total_points")), 4)


_TERMS = [*CARD, "(intercept)"]
_WIDE = ", ".join(f"max(w) FILTER (feature = '{f}') AS x{i}" for i, f in enumerate(CARD))
_ENTRIES = ", ".join(f"[{', '.join(f'x{i} * x{j}' for j in range(len(CARD) + 1))}]" for i in range(len(CARD) + 1))


@query(
    _CARD_SCORED
    + f""", design AS (SELECT id, 1.0::DOUBLE AS x{len(CARD)}, {_WIDE} FROM applied GROUP BY id),
    products AS (SELECT p, unnest(range({len(CARD) + 1})) AS i, unnest([{_ENTRIES}]) AS line FROM design JOIN pd USING (id)),
    entries AS (SELECT p, i, unnest(range({len(CARD) + 1})) AS j, unnest(line) AS c FROM products)
    SELECT {_TERMS!r}[i + 1] AS term, {_TERMS!r}[j + 1] AS other, {r('sum(p * (1.0::DOUBLE - p) * c)', 4)} AS value
    FROM entries GROUP BY ALL"""
)
def information_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Curvature of the likelihood at the fixed card: what its Wald tests rest on."""
    book, binning = prebinning(spark, sf)
    woe = binning.transform(book, ["id"], CARD)
    rows = woe.select(F.array(*[f"woe_{f}" for f in CARD]).alias("x"))
    found = scorecard.information(rows, "x", list(CARD.values()), INTERCEPT)
    names = F.array(*[F.lit(t) for t in _TERMS])
    return tidy(found.select(names[F.col("i")].alias("term"), names[F.col("j")].alias("other"), "value"), 4)


_LOSSES = ", ".join(
    f"('{f}', {c!r}::DOUBLE)" for f, c in CARD.items()
)


@query(
    _APPLIED_SQL
    + f""", card AS (SELECT * FROM (VALUES {_LOSSES}) t(feature, coefficient)),
    best AS (SELECT feature, max(-coefficient * woe) AS top FROM weighed JOIN card USING (feature) GROUP BY feature),
    loss AS (
      SELECT id, feature, row_number() OVER (PARTITION BY id ORDER BY
               -({SCALE.factor!r}::DOUBLE * (top + coefficient * w)), feature) AS rn
      FROM applied JOIN card USING (feature) JOIN best USING (feature))
    SELECT feature, CAST(rn AS INTEGER) AS place, count(*) AS rows FROM loss WHERE rn <= 2 GROUP BY ALL"""
)
def reason_codes(spark: SparkSession, sf: str) -> DataFrame:
    """How often each feature is the first or second reason for lost points."""
    book, binning = prebinning(spark, sf)
    woe = binning.transform(book, ["id"], CARD)
    reasons = policy.reason_codes(woe, binning, CARD, SCALE.factor, top=2)
    placed = woe.select(F.posexplode(reasons).alias("place", "feature"))
    return placed.groupBy("feature", (F.col("place") + 1).alias("place")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    SCORES_SQL.replace("FROM scored WHERE approved = 1", "FROM scored WHERE approved = 1 AND "
                       "application_month >= 62")
    + f", t AS (SELECT id, 'oot' AS split, y, {score_sql('p')} AS score FROM s)"
    + bands_sql("score", "t")
    + f""", agg AS (SELECT band, count(*) AS n, sum(y) AS bads, min(score) AS lo, max(score) AS hi
                   FROM banded GROUP BY band)
    SELECT band, n AS "count", lo || '-' || hi AS score_range, {r('bads / n * 100', 2)} AS bad_rate_pct,
           {r('sum(bads) OVER (ORDER BY band) / sum(bads) OVER () * 100', 1)} AS cum_bad_capture_pct,
           {r('(bads / n) / (sum(bads) OVER () / sum(n) OVER ())', 2)} AS lift FROM agg"""
)
def score_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Out-of-time deciles of the published score with their ranges."""
    rows = staged_scores(spark, sf).where("split = 'oot'")
    rows = rows.withColumn("score", scale.probability_to_score(F.col("p")))
    return scorecard.score_bands(rows, "score", "y", "id")


# ------------------------------------------------------------------ fitted scorecard


def _fitted_card(spark: SparkSession, sf: str):
    book, binning = fitted(spark, sf)
    woe = stage(binning.transform(book, ["id", "split", "y"]), "woe")
    return woe, binning, scorecard.fit_scorecard(train_of(woe), binning, "y", min_iv=0.001)


@query()
def scorecard_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Selected features with coefficient, information value, Wald test and inflation factor."""
    _, _, card = _fitted_card(spark, sf)
    return card.diagnostics_frame(spark)


_TWO = ("n_lines", "mean_discount")


@query(
    recursive(_APPLIED_SQL)
    + f""", design AS (SELECT id, max(w) FILTER (feature = '{_TWO[0]}') AS x0, max(w) FILTER (feature = '{_TWO[1]}') AS x1, 1.0::DOUBLE AS x2 FROM applied GROUP BY id),
    train_rows AS (SELECT x0, x1, x2, y, 1.0::DOUBLE AS w FROM design JOIN book USING (id) WHERE split = 'train'),
    {newton_sql('train_rows', 3, penalty=1 / scorecard.INVERSE_PENALTY)}
    SELECT term, {r('c')} AS coefficient, {r('sqrt(v)')} AS std_error FROM (
      SELECT unnest({[*_TWO, "(intercept)"]!r}) AS term, unnest([c0, c1, c2]) AS c, unnest([v0, v1, v2]) AS v FROM fit)"""
)
def scorecard_newton(spark: SparkSession, sf: str) -> DataFrame:
    """A card of two features: coefficients and standard errors from Newton steps."""
    book, binning = prebinning(spark, sf)
    woe = stage(binning.transform(train_of(book), ["y"], _TWO), "woe")
    rows = woe.select(F.array(*[f"woe_{f}" for f in _TWO]).alias("x"), "y")
    fit = newton(rows, "x", "y", penalty=1 / scorecard.INVERSE_PENALTY, size=2)
    errors = np.sqrt(np.diag(np.linalg.inv(fit.information)))
    found = zip([*_TWO, "(intercept)"], [*map(float, fit.coefficients), fit.intercept], map(float, errors))
    return tidy(spark.createDataFrame(list(found), "term string, coefficient double, std_error double"))


@query()
def wald_and_vif(spark: SparkSession, sf: str) -> DataFrame:
    """The same diagnostics as reported: rounded, strongest first."""
    _, _, card = _fitted_card(spark, sf)
    return scorecard.diagnostics_report(card.diagnostics_frame(spark))


@query()
def scorecard_dropped(spark: SparkSession, sf: str) -> DataFrame:
    """Features left out, with the reason: weak, correlated, or wrong sign."""
    book, binning = fitted(spark, sf)
    woe = stage(binning.transform(book, ["y", "split"]), "woe")
    # a low correlation limit shows the pruning step at work on nearly independent features
    card = scorecard.fit_scorecard(train_of(woe), binning, "y", max_correlation=0.3)
    return card.dropped_frame(spark)


@query()
def scorecard_points(spark: SparkSession, sf: str) -> DataFrame:
    _, binning, card = _fitted_card(spark, sf)
    bins = binning.bin_frame(spark)
    return scorecard.points_table(
        bins, card.coefficient_frame(spark), card.intercept, len(card.features)
    )


@query()
def scorecard_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    woe, _, card = _fitted_card(spark, sf)
    rows = stage(card.apply(woe, ["id", "split", "y"]).select("id", "split", "y", "p"), "card")
    return tidy(evaluate(rows, "p", "y", "id", by="split"))


# ---------------------------------------------------------------------- boosted trees


def _tuned(spark: SparkSession, sf: str, name: str = "gbt"):
    """The whole search: all trials over the default ranges."""
    book, binning = fitted(spark, sf)
    woe = stage(binning.transform(book, ["id", "split", "y"]), "woe")
    features = [f"woe_{f}" for f in binning.features]
    return woe, binning, boost.tune(woe, features, "y", name=name)


@query()
def gbt_search(spark: SparkSession, sf: str) -> DataFrame:
    _, _, tuned = _tuned(spark, sf)
    return tuned.trial_frame(spark)


@query()
def gbt_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    woe, _, tuned = _tuned(spark, sf)
    rows = stage(tuned.score(woe).select("id", "split", "y", "p"), "gbt")
    return tidy(evaluate(rows, "p", "y", "id", by="split"))


@query()
def champion(spark: SparkSession, sf: str) -> DataFrame:
    """Comparison rows of the scorecard and the boosted model, and which is champion."""
    woe, binning, tuned = _tuned(spark, sf)
    card = scorecard.fit_scorecard(train_of(woe), binning, "y", min_iv=0.001)
    names = {"scorecard": card.apply(woe, ["id", "split", "y"]), "gbt": tuned.score(woe)}
    parts = []
    for name, scored in names.items():
        rows = stage(scored.select("id", "split", "y", "p"), name)
        parts.append(boost.summary_row(evaluate(rows, "p", "y", "id", by="split"), name))
    table = stage(parts[0].unionByName(parts[1]), "comparison")
    best = boost.champion(table, ["gbt"]).first()["champion"]
    return tidy(table, 4).withColumn("champion", F.col("model") == best)


@query()
def importance(spark: SparkSession, sf: str) -> DataFrame:
    _, binning, tuned = _tuned(spark, sf)
    return boost.importance(tuned.model, list(binning.features), spark)


@query()
def monotone_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Where the boosted model breaks the expected direction, over all rows and bins."""
    woe, binning, tuned = _tuned(spark, sf)
    grids = {f"woe_{f}": [b["woe"] for b in binning.of(f)] for f in binning.features}
    return tidy(boost.monotone_audit(woe, tuned, grids))


# ----------------------------------------------------------------------------- policy


@query(
    _POINTED
    + f""", cells AS (SELECT score, count(*) AS n, sum(y) AS b FROM pts WHERE approved = 1 GROUP BY score),
    run AS (SELECT score, sum(n - b) OVER (ORDER BY score DESC) AS g, sum(b) OVER (ORDER BY score DESC) AS b,
                   sum(n) OVER () AS total FROM cells)
    SELECT score AS cutoff, CAST(g AS BIGINT) AS goods, CAST(b AS BIGINT) AS bads,
           {r('(g + b) / total')} AS approval_rate,
           {r(f'g * {ECONOMICS.revenue_per_good!r}::DOUBLE - b * {ECONOMICS.loss_per_bad!r}::DOUBLE', 2)} AS profit
    FROM run"""
)
def profit_curve(spark: SparkSession, sf: str) -> DataFrame:
    curve = policy.profit_curve(_pointed(spark, sf).where("approved = 1"), "score", "y")
    return curve.select(
        "cutoff",
        "goods",
        "bads",
        F.round("approval_rate", 6).alias("approval_rate"),
        F.round("profit", 2).alias("profit"),
    )


@query(
    SQL["profit_curve"].replace("SELECT score AS cutoff", ", curve AS (SELECT score AS cutoff")
    + ") SELECT * FROM curve ORDER BY profit DESC, cutoff DESC LIMIT 1"
)
def best_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    """The most profitable cut-off."""
    best = policy.best_cutoff(policy.profit_curve(_pointed(spark, sf).where("approved = 1"), "score", "y"))
    return best.select(
        "cutoff", "goods", "bads",
        F.round("approval_rate", 6).alias("approval_rate"), F.round("profit", 2).alias("profit"),
    )


@query(
    APPS_SQL
    + ", "
    + views.OUTCOMES_SQL
    + f""", held AS (SELECT apps.*, true_default_flag AS t FROM apps JOIN outcomes USING (id)),
    long AS (SELECT 'segment' AS attribute, segment AS level, approved, t FROM held
             UNION ALL SELECT 'priority', priority, approved, t FROM held),
    rates AS (SELECT attribute, level, count(*) AS n, avg(approved) AS ar,
                     avg(approved) FILTER (t = 0) AS gr FROM long GROUP BY ALL),
    gaps AS (SELECT *, ar / max(ar) OVER (PARTITION BY attribute) AS di,
                    max(gr) OVER (PARTITION BY attribute) - gr AS og FROM rates)
    SELECT attribute, level, n, {r('ar')} AS approval_rate, {r('gr')} AS good_approval_rate,
           {r('di')} AS disparate_impact, di >= 0.80 AS impact_ok, {r('og')} AS opportunity_gap,
           og <= 0.05 AS opportunity_ok FROM gaps"""
)
def disparate_impact(spark: SparkSession, sf: str) -> DataFrame:
    book = views.apps(spark, sf, lines=False, gap=False).join(views.outcomes(spark, sf), "id")
    good = F.col("true_default_flag") == 0
    return tidy(policy.fairness(book, ["segment", "priority"], "approved", good))


@query(
    APPS_SQL
    + SCORED_SQL
    + f"""SELECT label, approved, count(*) AS rows, {r('sum(w)', 4)} AS weight FROM (
          SELECT approved, y AS label, 1.0::DOUBLE AS w FROM scored WHERE approved = 1
          UNION ALL SELECT approved, 1.0::DOUBLE, p FROM scored WHERE approved = 0
          UNION ALL SELECT approved, 0.0::DOUBLE, 1.0::DOUBLE - p FROM scored WHERE approved = 0)
        GROUP BY ALL"""
)
def reject_augment(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected applications enter once as bad and once as good, with weights."""
    book = views.scored(spark, sf, approved_only=False)
    wide = policy.fuzzy_augment(book.select("approved", "y", "p"), "p", "approved", "y")
    grouped = wide.groupBy(F.col("y").alias("label"), "approved")
    return tidy(grouped.agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("weight")), 4)


_REFIT = (
    recursive(APPS_SQL)
    + SCORED_SQL
    + """, book AS (SELECT approved, y, p, true_default_flag, CAST(coalesce(n_lines, 0) AS DOUBLE) AS x0, coalesce(mean_discount, 0.05::DOUBLE) AS x1, 1.0::DOUBLE AS x2
                  FROM scored JOIN outcomes USING (id)),
    twice AS (SELECT x0, x1, x2, y, 1.0::DOUBLE AS w FROM book WHERE approved = 1
              UNION ALL SELECT x0, x1, x2, 1.0::DOUBLE, p FROM book WHERE approved = 0
              UNION ALL SELECT x0, x1, x2, 0.0::DOUBLE, 1.0::DOUBLE - p FROM book WHERE approved = 0),
    """
)


@query(
    _REFIT.replace("WITH RECURSIVE ", f"WITH RECURSIVE {OUTCOMES_SQL.strip()}, ", 1)
    + newton_sql("twice", 3)
    + f"""SELECT approved, count(*) AS rows, {r('avg(p)')} AS before, {r('avg(1.0::DOUBLE / (1.0::DOUBLE + exp(-(c0 * x0 + c1 * x1 + c2))))')} AS after,
          {r('avg(true_default_flag)')} AS actual FROM book, fit GROUP BY approved"""
)
def reject_inference(spark: SparkSession, sf: str) -> DataFrame:
    """A refit on the augmented book, with its bad rate on rejects against what happened."""
    book = views.scored(spark, sf, approved_only=False).join(views.outcomes(spark, sf), "id")
    book = stage(
        book.select(
            "approved", "y", "p", "true_default_flag",
            F.coalesce("n_lines", F.lit(0)).cast("double").alias("lines"),
            F.coalesce("mean_discount", F.lit(0.05)).alias("discount"),
        ),
        "rejects",
    )
    slopes, intercept = policy.reject_inference(book, ["lines", "discount"], "p", "approved", "y")
    z = sum((F.lit(v) * F.col(k) for k, v in slopes.items()), F.lit(intercept))
    refit = book.withColumn("refit", 1.0 / (1.0 + F.exp(-z)))
    return tidy(
        refit.groupBy("approved").agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg("p").alias("before"),
            F.avg("refit").alias("after"),
            F.avg("true_default_flag").alias("actual"),
        )
    )


_LOGIT = "ln(least(greatest(p, 1e-10::DOUBLE), 1 - 1e-10::DOUBLE) / (1 - least(greatest(p, 1e-10::DOUBLE), 1 - 1e-10::DOUBLE)))"


@query(
    recursive(SCORES_SQL)
    + f""", logits AS (SELECT split, y, p, {_LOGIT} AS x0, 1.0::DOUBLE AS x1, 1.0::DOUBLE AS w FROM s),
    valid AS (SELECT x0, x1, y, w FROM logits WHERE split = 'valid'),
    {newton_sql('valid', 2)}
    SELECT split, {r('avg(p)')} AS before, {r('avg(1.0::DOUBLE / (1.0::DOUBLE + exp(-(c0 * x0 + c1))))')} AS after, {r('avg(y)')} AS observed
    FROM logits, fit GROUP BY split"""
)
def probability_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """Expected against observed bad rate per split, before and after recalibration on valid."""
    rows = staged_scores(spark, sf)
    slope, shift = policy.recalibrate(rows.where("split = 'valid'"), "p", "y")
    fixed = policy.apply_recalibration(F.col("p"), slope, shift)
    return tidy(
        rows.groupBy("split").agg(
            F.avg("p").alias("before"), F.avg(fixed).alias("after"), F.avg("y").alias("observed")
        )
    )


@query(
    SCORES_SQL
    + f""", cells AS (SELECT round(p, 3) AS s, count(*) AS n, sum(y) AS b FROM s WHERE split = 'valid' GROUP BY 1),
    sums AS (SELECT s, sum(n) OVER w AS n, sum(b) OVER w AS b, n AS own_n, b AS own_b FROM cells WINDOW w AS (ORDER BY s)),
    means AS (SELECT lo.s AS lo, hi.s AS hi, (hi.b - lo.b + lo.own_b) / (hi.n - lo.n + lo.own_n) AS m FROM sums lo JOIN sums hi ON lo.s <= hi.s),
    least_after AS (SELECT lo, hi, min(m) OVER (PARTITION BY lo ORDER BY hi ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS m FROM means),
    fitted AS (SELECT hi AS s, max(m) AS rate FROM least_after GROUP BY hi)
    SELECT CAST(row_number() OVER (ORDER BY min(s)) - 1 AS INTEGER) AS step, min(s) AS low, max(s) AS high, CAST(sum(n) AS BIGINT) AS n, CAST(sum(b) AS BIGINT) AS bads, {r('rate')} AS rate
    FROM fitted JOIN cells USING (s) GROUP BY rate"""
)
def isotonic_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Rising bad rates by score on the validation split; the SQL takes them as the largest of smallest means."""
    rows = staged_scores(spark, sf).where("split = 'valid'").withColumn("p", F.round("p", 3))
    return tidy(isotonic.isotonic_steps(rows, "p", "y"))


@query(SQL["scorecard_score"])
def stored_card(spark: SparkSession, sf: str) -> DataFrame:
    """The fixed card, saved and loaded, on the book."""
    book, binning = prebinning(spark, sf)
    path = f"{shared_folder(spark)}/creditloom/card-{uuid.uuid4().hex}"
    _card().save(spark, path)
    loaded = scorecard.Scorecard.load(spark, path)
    return tidy(loaded.apply(binning.transform(book, ["id"], loaded.features), ["id"]))


@query(METRIC_SQL["evaluation"])
def metric_record(spark: SparkSession, sf: str) -> DataFrame:
    """The evaluation, written as a metric record and read back."""
    found = tidy(evaluate(staged_scores(spark, sf), "p", "y", "id", by="split"))
    path = f"{shared_folder(spark)}/creditloom/metrics-{uuid.uuid4().hex}"
    io.write_metrics(found, path)
    return io.read_metrics(spark, path, ", ".join(f"`{n}` {t}" for n, t in found.dtypes))
