"""Registered queries of the behavioural mart, in batch and as streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators import asof, mart, timeline
from creditloom.operators.stability import drift_against
from creditloom.plans.common import r, tidy
from creditloom.plans.metric_queries import _DECILES, _TERM, _VERDICT
from creditloom.sources import views
from creditloom.sources.staging import shared_folder
from creditloom.sources.views import TXN_SQL
from creditloom.streaming import events, monitor

QUERIES = {}
SQL = {}
DECISION = "2024-01-31"


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def decision():
    return F.expr(f"TIMESTAMP_NTZ '{DECISION} 00:00:00'")


_AT = f"TIMESTAMP '{DECISION} 00:00:00'"
_KINDS = ("signup", "purchase", "error")
_DAYS = (7, 15, 30)


@query(
    TXN_SQL
    + "SELECT user_id, "
    + ", ".join(
        f"count(*) FILTER (type = '{t}' AND ts >= {_AT} - INTERVAL {d} DAY) AS {t}_count_{d}d"
        for t in _KINDS
        for d in _DAYS
    )
    + f" FROM txn WHERE ts >= {_AT} - INTERVAL 30 DAY AND ts < {_AT} GROUP BY user_id"
)
def mart_counts(spark: SparkSession, sf: str) -> DataFrame:
    return mart.windowed_counts(views.txn(spark, sf), decision(), _DAYS, _KINDS)


_GAPS = """, gaps AS (
      SELECT user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 1000000.0::DOUBLE AS g
      FROM {source})
    SELECT user_id, count(*) AS events, {mean} AS mean_gap, {reg} AS regularity FROM gaps GROUP BY user_id"""


@query(
    TXN_SQL
    + _GAPS.format(
        source="txn WHERE type = 'signup'",
        mean=r("avg(g)", 4),
        reg=r("1.0::DOUBLE - stddev_pop(g) / CASE WHEN avg(g) <> 0 THEN avg(g) END"),
    )
)
def mart_gap_regularity(spark: SparkSession, sf: str) -> DataFrame:
    """Rhythm of a user's inflows."""
    found = mart.gap_regularity(views.txn(spark, sf).where(F.col("type") == mart.INFLOW))
    return found.select(
        "user_id",
        "events",
        F.round("mean_gap", 4).alias("mean_gap"),
        F.round("regularity", 6).alias("regularity"),
    )


@query(
    TXN_SQL
    + f""", pairs AS (SELECT user_id, party, count(*) AS n FROM txn GROUP BY ALL)
    SELECT user_id, CAST(sum(n) AS BIGINT) AS events, {r('sum(n * n) / (sum(n) * sum(n))')} AS hhi,
           {r('max(n) / sum(n)')} AS top_share FROM pairs GROUP BY user_id"""
)
def mart_hhi(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(mart.concentration(views.txn(spark, sf)))


@query(
    TXN_SQL
    + f""", w AS (
      SELECT *, date_diff('day', CAST(ts AS DATE), CAST({_AT} AS DATE)) AS age FROM txn
      WHERE ts < {_AT} AND ts >= {_AT} - INTERVAL 30 DAY)
    SELECT user_id, {r(f'sum(amount) FILTER (ts >= {_AT} - INTERVAL 15 DAY)', 2)} AS recent,
           {r(f'sum(amount) FILTER (ts < {_AT} - INTERVAL 15 DAY)', 2)} AS earlier,
           {r(f'sum(amount) FILTER (ts >= {_AT} - INTERVAL 15 DAY) / sum(amount) FILTER (ts < {_AT} - INTERVAL 15 DAY) - 1.0::DOUBLE')} AS growth,
           {r('regr_slope(amount, -age)')} AS slope FROM w GROUP BY user_id"""
)
def mart_trend(spark: SparkSession, sf: str) -> DataFrame:
    found = mart.trend(views.txn(spark, sf), decision(), 15)
    return found.select(
        "user_id",
        F.round("recent", 2).alias("recent"),
        F.round("earlier", 2).alias("earlier"),
        F.round("growth", 6).alias("growth"),
        F.round("slope", 6).alias("slope"),
    )


_SIGNED = "CASE type WHEN 'signup' THEN amount WHEN 'purchase' THEN -amount ELSE 0.0 END"


@query(
    TXN_SQL
    + f""", moves AS (SELECT user_id, CAST(ts AS DATE) AS day, sum({_SIGNED}) AS net FROM txn GROUP BY ALL),
    closing AS (SELECT user_id, day, sum(net) OVER w AS balance, lead(day) OVER w AS next_day
                FROM moves WINDOW w AS (PARTITION BY user_id ORDER BY day)),
    days AS (
      SELECT user_id, balance, CAST(unnest(generate_series(CAST(day AS TIMESTAMP),
               CAST(coalesce(next_day - 1, day) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
      FROM closing),
    tail AS (SELECT *, max(day) OVER (PARTITION BY user_id) - day < 5 AS late FROM days)
    SELECT user_id, count(*) AS days, {r('avg(balance)', 4)} AS avg_balance, {r('min(balance)', 4)} AS min_balance,
           {r('stddev_pop(balance) / abs(avg(balance))', 4)} AS balance_cv,
           count(*) FILTER (balance <= 0) AS zero_days,
           {r('avg(balance) FILTER (late) / avg(balance)', 4)} AS month_end_ratio
    FROM tail GROUP BY user_id"""
)
def mart_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily balance features; sign-ups stand in for inflows and purchases for outflows."""
    runs = mart.balance_runs(views.txn(spark, sf), F.expr(_SIGNED))
    return tidy(mart.balance_features(runs), 4)


@query(
    TXN_SQL
    + f""", f AS (SELECT user_id, sum(CASE WHEN type = 'signup' THEN amount ELSE 0 END) AS i,
                  sum(CASE WHEN type = 'purchase' THEN amount ELSE 0 END) AS o FROM txn GROUP BY user_id)
    SELECT user_id, {r('i', 2)} AS inflow, {r('o', 2)} AS outflow,
           {r('(i - o) / CASE WHEN i <> 0 THEN i END')} AS net_flow_ratio FROM f"""
)
def mart_net_flow(spark: SparkSession, sf: str) -> DataFrame:
    found = mart.net_flow(views.txn(spark, sf))
    return found.select(
        "user_id",
        F.round("inflow", 2).alias("inflow"),
        F.round("outflow", 2).alias("outflow"),
        F.round("net_flow_ratio", 6).alias("net_flow_ratio"),
    )


def _sum_if(condition: str) -> str:
    return f"sum(CASE WHEN {condition} THEN amount ELSE 0 END)"


def _ratio(top: str, bottom: str) -> str:
    return r(f"{_sum_if(top)} / CASE WHEN {_sum_if(bottom)} <> 0 THEN {_sum_if(bottom)} END")


@query(
    TXN_SQL
    + f"""SELECT user_id, {_ratio("type = 'purchase' AND CAST(party AS INT) < 20", "type = 'purchase'")} AS till_share,
          {_ratio("type = 'purchase'", "type = 'signup'")} AS sent_over_received,
          {_ratio("type = 'purchase' AND CAST(party AS INT) >= 90", "type = 'purchase'")} AS betting_share,
          {_ratio("type = 'signup' AND CAST(party AS INT) >= 90", "type = 'signup'")} AS savings_share
          FROM txn GROUP BY user_id"""
)
def mart_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """Ratios of sums; counterparty ranges stand in for tills, betting and savings products."""
    inflow, outflow = F.col("type") == mart.INFLOW, F.col("type") == mart.OUTFLOW
    code = F.col("party").cast("int")
    ratios = {
        "till_share": (outflow & (code < 20), outflow),
        "sent_over_received": (outflow, inflow),
        "betting_share": (outflow & (code >= 90), outflow),
        "savings_share": (inflow & (code >= 90), inflow),
    }
    return tidy(mart.flow_ratios(views.txn(spark, sf), ratios))


@query(
    TXN_SQL
    + f"""SELECT user_id, {r('avg(CASE WHEN hour(ts) >= 22 OR hour(ts) < 4 THEN 1 ELSE 0 END)')} AS night_share,
          {r('avg(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END)')} AS weekend_share,
          {r("avg(CASE WHEN type = 'error' THEN 1 ELSE 0 END)")} AS failed_share FROM txn GROUP BY user_id"""
)
def mart_time_shares(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(mart.time_shares(views.txn(spark, sf)))


@query(
    TXN_SQL
    + f""", h AS (SELECT user_id, hour(ts) AS h, count(*) AS n FROM txn GROUP BY ALL),
    p AS (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM h)
    SELECT user_id, {r('greatest(-sum(p * ln(p)), 0.0::DOUBLE)')} AS entropy FROM p GROUP BY user_id"""
)
def mart_hour_entropy(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(mart.hour_entropy(views.txn(spark, sf)))


@query(
    TXN_SQL
    + f""", seen AS (SELECT user_id, party, min(ts) AS a, max(ts) AS b FROM txn WHERE ts < {_AT} GROUP BY ALL),
    n AS (SELECT user_id, count(*) FILTER (b >= {_AT} - INTERVAL 7 DAY) AS act,
                 count(*) FILTER (a >= {_AT} - INTERVAL 7 DAY) AS fresh FROM seen GROUP BY user_id)
    SELECT user_id, act AS active_parties, {r('fresh / CASE WHEN act <> 0 THEN act END')} AS new_share FROM n"""
)
def mart_new_party(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(mart.new_counterparties(views.txn(spark, sf), decision(), 7))


@query(
    TXN_SQL
    + f""", c AS (SELECT user_id, ts >= {_AT} - INTERVAL 15 DAY AS recent, party, count(*) AS n FROM txn
                 WHERE ts < {_AT} AND ts >= {_AT} - INTERVAL 30 DAY GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY user_id, recent ORDER BY n DESC, party) AS rn FROM c),
    s AS (SELECT user_id, party, count(*) AS sides, count(*) FILTER (NOT recent) AS early
          FROM k WHERE rn <= 10 GROUP BY ALL),
    v AS (SELECT user_id, count(*) FILTER (sides = 2) AS kept, sum(early) AS early FROM s GROUP BY user_id)
    SELECT user_id, CAST(kept AS INTEGER) AS kept, {r('kept / CASE WHEN early <> 0 THEN early END')} AS stability FROM v"""
)
def mart_set_stability(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(mart.set_stability(views.txn(spark, sf), decision(), 15))


@query(
    TXN_SQL
    + f"""SELECT user_id, max(amount) FILTER (type = 'purchase') AS max_outflow,
          {r("avg(amount) FILTER (type = 'purchase')")} AS mean_outflow,
          {r("max(amount) FILTER (type = 'purchase') / " + 'CASE WHEN ' + _sum_if("type = 'signup'") + ' <> 0 THEN ' + _sum_if("type = 'signup'") + ' END')}
            AS max_outflow_ratio FROM txn GROUP BY user_id"""
)
def mart_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(mart.size_features(views.txn(spark, sf)))


@query(
    TXN_SQL
    + f""", d AS (SELECT user_id, type, CAST(date_diff('day', CAST(ts AS DATE), CAST({_AT} AS DATE)) AS INTEGER) AS age
                 FROM txn WHERE ts < {_AT})
    SELECT user_id, max(age) AS tenure_days, min(age) AS days_since_last,
           min(age) FILTER (type = 'purchase') AS days_since_outflow FROM d GROUP BY user_id"""
)
def mart_recency(spark: SparkSession, sf: str) -> DataFrame:
    return mart.recency(views.txn(spark, sf), decision())


@query(
    TXN_SQL
    + """, c AS (SELECT user_id, type, party, count(*) AS n FROM txn GROUP BY ALL)
    SELECT user_id, CAST(max(CASE WHEN type = 'signup' AND n >= 3 THEN 1 ELSE 0 END) AS INTEGER) AS recurring_inflow,
           CAST(max(CASE WHEN type = 'purchase' AND n >= 3 THEN 1 ELSE 0 END) AS INTEGER) AS recurring_outflow
    FROM c GROUP BY user_id"""
)
def mart_flags(spark: SparkSession, sf: str) -> DataFrame:
    return mart.recurring_flags(views.txn(spark, sf))


# ------------------------------------------------------------- as of each application

_FLAGS = ("A", "N", "R")
_BACK = (30, 90, 365)

_ASOF_SQL = """
WITH asked AS (SELECT o_orderkey AS id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS decision_day FROM orders),
log AS (SELECT o_custkey AS user_id, CAST(l_shipdate AS DATE) AS day, l_returnflag AS type, l_extendedprice AS amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
met AS (SELECT id, a.user_id, decision_day, date_diff('day', day, decision_day) AS age, type, amount
        FROM asked a LEFT JOIN log l ON a.user_id = l.user_id AND day < decision_day)
"""


def _decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as applications: each looks back from its own day."""
    return views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("at")
    )


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    orders = views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"), "o_orderdate"
    )
    # Parquet packs orders so well that the planner would broadcast millions of them
    return views.table(spark, sf, "lineitem").join(orders.hint("merge"), "l_orderkey")


def _shipments(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select(
        "user_id",
        F.col("l_shipdate").alias("ts"),
        F.col("l_returnflag").alias("type"),
        F.col("l_extendedprice").alias("amount"),
    )


@query(
    _ASOF_SQL
    + "SELECT id, user_id, decision_day, "
    + ", ".join(f"count(*) FILTER (type = '{t}' AND age <= {d}) AS {t}_count_{d}d" for t in _FLAGS for d in _BACK)
    + ", "
    + ", ".join(f"{r(f'sum(amount) FILTER (age <= {d})', 2)} AS amount_{d}d" for d in _BACK)
    + " FROM met GROUP BY ALL"
)
def mart_asof_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments to a customer in the days before each of their orders."""
    found = asof.activity(_shipments(spark, sf), _decisions(spark, sf), _BACK, _FLAGS, key="id", at="at")
    return tidy(found, 2)


@query(
    _ASOF_SQL
    + """SELECT id, user_id, decision_day, CAST(max(age) AS INTEGER) AS tenure_days,
         CAST(min(age) AS INTEGER) AS days_since_last,
         CAST(min(age) FILTER (type = 'R') AS INTEGER) AS days_since_outflow FROM met GROUP BY ALL"""
)
def mart_asof_recency(spark: SparkSession, sf: str) -> DataFrame:
    return asof.recency(_shipments(spark, sf), _decisions(spark, sf), "R", key="id", at="at")


_LOAN_DAYS = 60


@query(
    f"""
    WITH asked AS (SELECT o_orderkey AS id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS decision_day FROM orders),
    loans AS (SELECT o_custkey AS user_id, l_suppkey AS lender, CAST(o_orderdate AS DATE) AS opened,
                     CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS repaid, l_extendedprice AS principal
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    met AS (SELECT id, a.user_id, decision_day, lender, opened, principal, repaid <= opened + {_LOAN_DAYS} AS ontime,
                   repaid IS NOT NULL AND greatest(repaid, opened) < decision_day AS shut
            FROM asked a LEFT JOIN loans l ON a.user_id = l.user_id AND opened < decision_day),
    held AS (SELECT *, opened IS NOT NULL AND NOT shut AS held FROM met)
    SELECT id, user_id, decision_day, count(opened) AS prior_loan_count,
           {r("avg(CASE WHEN ontime THEN 1 ELSE 0 END) FILTER (shut)")} AS ontime_share,
           CAST(min(date_diff('day', opened, decision_day)) AS INTEGER) AS days_since_last_loan,
           {r("count(*) FILTER (date_diff('day', opened, decision_day) <= 90) / 3.0::DOUBLE")} AS stacking_velocity,
           count(DISTINCT lender) FILTER (held) AS active_lenders,
           {r("coalesce(sum(principal) FILTER (held), 0.0)", 2)} AS exposure
    FROM held GROUP BY ALL"""
)
def mart_loan_history(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as loans from suppliers: opened with the order, repaid when a finished line ships."""
    loans = _lines(spark, sf).select(
        "user_id",
        F.col("l_suppkey").alias("lender"),
        F.col("o_orderdate").alias("opened"),
        F.date_add(F.to_date("o_orderdate"), _LOAN_DAYS).alias("due"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("repaid"),
        F.col("l_extendedprice").alias("principal"),
    )
    found = asof.loan_history(loans, _decisions(spark, sf), key="id", at="at")
    return tidy(found.withColumn("exposure", F.round("exposure", 2)))


# applications are sign-ups; each looks back over the wallet's days before its own
_MEET_SQL = (
    TXN_SQL
    + """, asked AS (SELECT event_id AS id, user_id, CAST(ts AS DATE) AS decision_day FROM events WHERE event_type = 'signup'),
    met AS (SELECT id, a.user_id, decision_day, t.ts, type, amount, party, date_diff('day', CAST(ts AS DATE), decision_day) AS age
            FROM asked a LEFT JOIN txn t ON t.user_id = a.user_id AND CAST(t.ts AS DATE) < decision_day)
    """
)


def _signups(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "events").where("event_type = 'signup'").select(F.col("event_id").alias("id"), "user_id", F.col("ts").alias("at"))


@query(
    _MEET_SQL
    + f""", n AS (SELECT id, party, count(*) FILTER (age <= 7) AS now, count(*) FILTER (age BETWEEN 8 AND 14) AS past, max(age) AS first_age
               FROM met WHERE party IS NOT NULL GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY now DESC, party) AS now_rank,
                 row_number() OVER (PARTITION BY id ORDER BY past DESC, party) AS past_rank FROM n),
    f AS (SELECT id, count(*) FILTER (now > 0) AS active, count(*) FILTER (now > 0 AND first_age <= 7) AS fresh, sum(now) AS n, sum(now * now) AS sq, max(now) AS most,
                 count(*) FILTER (past > 0 AND past_rank <= 10) AS base,
                 count(*) FILTER (now > 0 AND now_rank <= 10 AND past > 0 AND past_rank <= 10) AS kept FROM k GROUP BY id)
    SELECT a.id, a.user_id, a.decision_day, coalesce(active, 0) AS active_parties, {r('fresh / CASE WHEN active > 0 THEN active END')} AS new_share,
      CAST(coalesce(kept, 0) AS INTEGER) AS kept_parties, {r('kept / CASE WHEN base > 0 THEN base END')} AS stability,
      {r('sq / CASE WHEN n > 0 THEN n * n END')} AS hhi, {r('most / CASE WHEN n > 0 THEN n END')} AS top_share, coalesce(most, 0) AS top_count
    FROM asked a LEFT JOIN f ON f.id = a.id"""
)
def mart_asof_parties(spark: SparkSession, sf: str) -> DataFrame:
    """Counterparties of the week before each sign-up: how many, how many new, how stable, how concentrated."""
    return tidy(timeline.parties(views.txn(spark, sf), _signups(spark, sf), 7, key="id"))


_SHAPES = (7, 15)


@query(
    _MEET_SQL
    + ", h AS (SELECT id, hour(ts) AS h, "
    + ", ".join(f"count(*) FILTER (age <= {d}) AS n{d}" for d in _SHAPES)
    + " FROM met WHERE ts IS NOT NULL GROUP BY ALL), e AS (SELECT id, "
    + ", ".join(f"greatest(ln(sum(n{d})) - sum(CASE WHEN n{d} > 0 THEN n{d} * ln(n{d}) ELSE 0 END) / sum(n{d}), 0) AS entropy_{d}, sum(n{d}) AS n{d}" for d in _SHAPES)
    + " FROM (SELECT id, h, " + ", ".join(f"CASE WHEN sum(n{d}) OVER (PARTITION BY id) > 0 THEN n{d} END AS n{d}" for d in _SHAPES) + " FROM h) GROUP BY id)"
    + " SELECT m.id, m.user_id, m.decision_day, "
    + ", ".join(
        f"""count(ts) FILTER (age <= {d}) AS events_{d}d,
        {r(f"avg(CASE WHEN hour(ts) >= 22 OR hour(ts) < 4 THEN 1 ELSE 0 END) FILTER (age <= {d})")} AS night_share_{d}d,
        {r(f"avg(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END) FILTER (age <= {d})")} AS weekend_share_{d}d,
        {r(f"avg(CASE WHEN type = 'error' THEN 1 ELSE 0 END) FILTER (age <= {d})")} AS failed_share_{d}d,
        {r(f"first(entropy_{d})")} AS hour_entropy_{d}d"""
        for d in _SHAPES
    )
    + " FROM met m LEFT JOIN e ON e.id = m.id GROUP BY m.id, m.user_id, m.decision_day"
)
def mart_asof_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Night, weekend and failed shares and the entropy of the hour before each sign-up."""
    return tidy(timeline.shape(views.txn(spark, sf), _signups(spark, sf), _SHAPES, mart.FAILED, key="id"))


_CENTS = "CAST(round(amount * 100) AS BIGINT)"


@query(
    _MEET_SQL
    + f""", net AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(CASE type WHEN 'signup' THEN {_CENTS} WHEN 'purchase' THEN -{_CENTS} ELSE 0 END) AS net FROM txn GROUP BY ALL),
    b AS (SELECT user_id, day, sum(net) OVER (PARTITION BY user_id ORDER BY day) AS b, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS next FROM net),
    days AS (SELECT user_id, b, unnest(generate_series(CAST(day AS TIMESTAMP), coalesce(CAST(next AS TIMESTAMP) - INTERVAL 1 DAY, TIMESTAMP '2024-02-15'), INTERVAL 1 DAY)) AS day FROM b),
    w AS (SELECT a.*, b / 100.0::DOUBLE AS b, date_diff('day', CAST(d.day AS DATE), decision_day) AS age
          FROM asked a LEFT JOIN days d ON d.user_id = a.user_id AND d.day < decision_day AND d.day >= decision_day - INTERVAL 10 DAY)
    SELECT id, user_id, decision_day, count(b) AS days_known, {r('avg(b)')} AS avg_balance, {r('min(b)')} AS min_balance,
      {r('stddev_pop(b) / CASE WHEN avg(b) <> 0 THEN abs(avg(b)) END', 4)} AS balance_cv, count(*) FILTER (b <= 0) AS zero_days,
      {r('avg(b) FILTER (age <= 5) / CASE WHEN avg(b) <> 0 THEN avg(b) END', 4)} AS month_end_ratio
    FROM w GROUP BY ALL"""
)
def mart_asof_balance(spark: SparkSession, sf: str) -> DataFrame:
    """End-of-day balances of the ten days before each sign-up."""
    cents = F.round(F.col("amount") * 100).cast("long")
    signed = F.when(F.col("type") == mart.INFLOW, cents).when(F.col("type") == mart.OUTFLOW, -cents).otherwise(F.lit(0).cast("long"))
    found = timeline.balances(views.txn(spark, sf), _signups(spark, sf), signed, 10, key="id")
    found = found.withColumns({c: F.col(c) / 100.0 for c in ("avg_balance", "min_balance")})
    return tidy(found.withColumns({c: F.round(c, 4) for c in ("balance_cv", "month_end_ratio")}))


@query(
    _MEET_SQL
    + f"""SELECT id, user_id, decision_day, max(amount) FILTER (type = 'purchase' AND age <= 12) AS max_outflow,
      {r("avg(amount) FILTER (type = 'purchase' AND age <= 12)")} AS mean_outflow,
      {r("max(amount) FILTER (type = 'purchase' AND age <= 12) / CASE WHEN sum(amount) FILTER (type = 'signup' AND age <= 12) > 0 THEN sum(amount) FILTER (type = 'signup' AND age <= 12) END")} AS max_outflow_ratio
    FROM met GROUP BY ALL"""
)
def mart_asof_largest(spark: SparkSession, sf: str) -> DataFrame:
    """Largest outflow of the twelve days before each sign-up, and against the inflow."""
    out, inflow = (F.when(F.col("type") == t, F.col("amount")) for t in (mart.OUTFLOW, mart.INFLOW))
    return tidy(timeline.largest(views.txn(spark, sf), _signups(spark, sf), 12, out, inflow, key="id"))


@query(
    _MEET_SQL
    + f""", s AS (SELECT id, user_id, decision_day, {", ".join(f"coalesce(sum({_CENTS}) FILTER ({c} AND age {a}), 0) AS {n}" for n, c, a in (
        ("inflow", "type = 'signup'", "<= 10"), ("outflow", "type = 'purchase'", "<= 10"), ("inflow_past", "type = 'signup'", "BETWEEN 11 AND 20")))}
      FROM met GROUP BY ALL)
    SELECT id, user_id, decision_day, CAST(inflow AS BIGINT) AS inflow, CAST(outflow AS BIGINT) AS outflow,
      {r('outflow / CASE WHEN inflow <> 0 THEN inflow END')} AS spent_share, {r('inflow / CASE WHEN inflow_past <> 0 THEN inflow_past END - 1')} AS inflow_growth FROM s"""
)
def mart_asof_flows(spark: SparkSession, sf: str) -> DataFrame:
    """Flows (in cents) of the ten days before each sign-up, their ratio and growth on the ten days before."""
    cents = F.round(F.col("amount") * 100).cast("long")
    sums = {"inflow": F.when(F.col("type") == mart.INFLOW, cents), "outflow": F.when(F.col("type") == mart.OUTFLOW, cents)}
    found = timeline.flows(views.txn(spark, sf), _signups(spark, sf), 10, sums, {"spent_share": ("outflow", "inflow")}, ["inflow"], key="id")
    return tidy(found)


@query(
    _MEET_SQL
    + f""", w AS (SELECT id, CAST(floor(epoch(ts)) AS BIGINT) AS t, count(*) AS n FROM met WHERE ts IS NOT NULL AND age <= 15 GROUP BY ALL),
    g AS (SELECT id, n, t, t - lag(t) OVER (PARTITION BY id ORDER BY t) AS g FROM w),
    s AS (SELECT id, CAST(sum(n) AS BIGINT) AS n, (max(t) - min(t)) / CASE WHEN sum(n) > 2 THEN CAST(sum(n) - 1 AS DOUBLE) END AS mean,
      coalesce(sum(g * g), 0) / CASE WHEN sum(n) > 2 THEN CAST(sum(n) - 1 AS DOUBLE) END AS sq FROM g GROUP BY id)
    SELECT a.id, a.user_id, a.decision_day, coalesce(n, 0) AS events,
      {r('1 - sqrt(greatest(sq - mean * mean, 0)) / CASE WHEN mean <> 0 THEN mean END')} AS regularity FROM asked a LEFT JOIN s ON s.id = a.id"""
)
def mart_asof_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Rhythm of the fifteen days before each sign-up."""
    return tidy(timeline.regularity(views.txn(spark, sf), _signups(spark, sf), 15, key="id"))


@query(
    f"""
    WITH asked AS (SELECT o_orderkey AS id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS decision_day FROM orders),
    loans AS (SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS opened, CAST(o_orderdate AS DATE) + {_LOAN_DAYS} AS due,
                     CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS repaid, CAST(l_quantity AS BIGINT) AS drawn
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    met AS (SELECT id, a.user_id, decision_day, opened, due, drawn, CASE WHEN repaid IS NOT NULL THEN greatest(repaid, opened) END AS repaid
            FROM asked a LEFT JOIN loans l ON a.user_id = l.user_id AND opened < decision_day),
    seen AS (SELECT *, least(coalesce(repaid, decision_day), decision_day) - 1 AS last_unpaid FROM met)
    SELECT id, user_id, decision_day,
           CAST(greatest(coalesce(max(date_diff('day', due, last_unpaid)) FILTER (last_unpaid >= decision_day - 180 AND last_unpaid >= opened), 0), 0) AS INTEGER) AS max_dpd,
           {r("sum(drawn) FILTER (repaid IS NULL OR repaid >= decision_day) / sum(50) FILTER (repaid IS NULL OR repaid >= decision_day)")} AS utilisation
    FROM seen GROUP BY ALL"""
)
def mart_asof_past_due(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as loans due after a fixed term, with the quantity drawn of a limit of 50."""
    loans = _lines(spark, sf).select(
        "user_id", F.col("o_orderdate").alias("opened"), F.date_add(F.to_date("o_orderdate"), _LOAN_DAYS).alias("due"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("repaid"),
        F.col("l_quantity").cast("long").alias("drawn"), F.lit(50).cast("long").alias("limit"),
    )
    return tidy(timeline.past_due(loans, _decisions(spark, sf), 180, key="id", at="at"))


# ---------------------------------------------------------------------------- streams


def _run(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there now and read back its appended rows."""
    folder = f"{shared_folder(spark)}/creditloom/{name}-{uuid.uuid4().hex}"
    job = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    job.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def _source(sf: str) -> str:
    return f"{sf}/event[s].parquet"


_CLOSED = "(SELECT max(ts) FROM events) - INTERVAL 1 DAY"


@query(
    TXN_SQL
    + f""", w AS (SELECT *, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS s FROM txn)
    SELECT user_id, s AS "start", s + INTERVAL 7 DAY AS "end", count(*) AS events, {r('sum(amount)', 2)} AS amount,
           count(*) FILTER (type = 'error') AS failed,
           {r('avg(CASE WHEN hour(ts) >= 22 OR hour(ts) < 4 THEN 1 ELSE 0 END)')} AS night_share
    FROM w GROUP BY user_id, s HAVING s + INTERVAL 7 DAY <= {_CLOSED}"""
)
def stream_windowed_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly activity per user, as far as the watermark has closed the weeks."""
    rows = _run(spark, events.windowed_activity(events.read_events(spark, _source(sf))), "activity")
    return rows.select(
        "user_id",
        "start",
        "end",
        "events",
        F.round("amount", 2).alias("amount"),
        "failed",
        F.round("night_share", 6).alias("night_share"),
    )


@query(
    TXN_SQL
    + f""", g AS (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR AS joined FROM txn),
    n AS (SELECT *, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
    SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 12 HOUR AS "end", count(*) AS events,
           {r('sum(amount)', 2)} AS amount FROM n GROUP BY user_id, k
    HAVING max(ts) + INTERVAL 12 HOUR <= {_CLOSED}"""
)
def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Bursts of activity per user, as far as the watermark has closed them."""
    rows = _run(spark, events.sessions(events.read_events(spark, _source(sf))), "sessions")
    return rows.select(
        "user_id",
        "start",
        "end",
        "events",
        F.round("amount", 2).alias("amount"),
    )


_REFERENCE_END = "2024-01-16"


@query(
    f"""
    WITH base AS (SELECT value AS v, CAST(ts AS DATE) AS day FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
    edges AS (SELECT list_sort(list_distinct(quantile_cont(v, {_DECILES}))) AS e FROM base WHERE day < '{_REFERENCE_END}'),
    placed AS (SELECT day, len(list_filter(e, lambda x: x < v)) AS b FROM base, edges),
    expected AS (SELECT b, count(*) / sum(count(*)) OVER () AS e FROM placed WHERE day < '{_REFERENCE_END}' GROUP BY b),
    counts AS (SELECT day, b, count(*) AS n FROM placed WHERE day >= '{_REFERENCE_END}' GROUP BY ALL),
    days AS (SELECT day, sum(n) AS n FROM counts WHERE CAST(day AS TIMESTAMP) + INTERVAL 1 DAY <= {_CLOSED} GROUP BY day),
    filled AS (SELECT d.day, coalesce(x.e, 0.0::DOUBLE) AS e, coalesce(c.n, 0) / d.n AS a
               FROM days d, edges, unnest(range(0, len(edges.e) + 1)) t(b)
               LEFT JOIN expected x ON x.b = t.b LEFT JOIN counts c ON c.day = d.day AND c.b = t.b),
    value AS (SELECT day, sum({_TERM}) AS v FROM filled GROUP BY day)
    SELECT 'amount' AS feature, day, {r('greatest(v, 0.0::DOUBLE)')} AS psi, {_VERDICT.format(v='v')} AS verdict FROM value"""
)
def stream_drift(spark: SparkSession, sf: str) -> DataFrame:
    """PSI of each closed day of amounts after the reference period, against that period."""
    history = views.txn(spark, sf).where(F.col("ts") < F.expr(f"TIMESTAMP_NTZ '{_REFERENCE_END} 00:00:00'"))
    edges, shares = monitor.reference_shares(history, ["amount"])
    live = events.read_events(spark, _source(sf))
    cells = _run(spark, monitor.daily_cells(live, edges), "drift").where(F.col("day") >= F.lit(_REFERENCE_END))
    return tidy(drift_against(cells, shares, "day"))
