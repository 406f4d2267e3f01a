"""Sliding-window features against a plain join per application, with a hot user, odd rows and empty tables."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditloom.operators import timeline

DAYS = 20


@pytest.fixture(scope="module")
def book():
    rng = np.random.default_rng(12)
    n = 2500
    log = pd.DataFrame({
        "user_id": np.where(rng.random(n) < 0.6, 0, rng.integers(1, 25, n)),  # user 0 holds most rows
        "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 150 * 24, n), unit="h"),
        "party": rng.choice([*"abcdefghijklmnopqrstuvw"], n, p=np.arange(23, 0, -1) / 276),
        "type": rng.choice(["in", "out", "failed"], n),
        "amount": rng.integers(1, 400, n),
    })
    asked = pd.DataFrame({"user_id": rng.integers(0, 27, 250), "at": pd.Timestamp("2023-12-25") + pd.to_timedelta(rng.integers(0, 200 * 24, 250), unit="h")})
    asked["user_id"] = np.where(rng.random(250) < 0.4, 0, asked["user_id"])
    asked["id"] = np.arange(250)
    return log, asked


@pytest.fixture(scope="module")
def tables(spark, book):
    log, asked = (spark.createDataFrame(x) for x in book)
    log = log.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("at", F.lit("clash"))
    asked = asked.withColumn("at", F.col("at").cast("timestamp_ntz")).withColumn("day", F.lit("clash"))
    odd = spark.createDataFrame([(None, "2024-02-01", 900), (3, None, 901), (None, None, 902)], "user_id long, at string, id long")
    asked = asked.unionByName(odd.withColumn("at", F.col("at").cast("timestamp_ntz")), allowMissingColumns=True)
    lost = spark.createDataFrame([(None, "2024-02-01 10:00:00", "a", "in", 5), (3, None, "a", "in", 5)], "user_id long, ts string, party string, type string, amount long")
    return log.unionByName(lost.withColumn("ts", F.col("ts").cast("timestamp_ntz")), allowMissingColumns=True), asked


def history(book):
    """(id, rows of the user before the decision day with their age in days)."""
    log, asked = book
    for r in asked.itertuples():
        own = log[log.user_id == r.user_id]
        age = (r.at.normalize() - own.ts.dt.normalize()).dt.days
        yield r.id, own[age > 0].assign(age=age[age > 0])


def by_id(df):
    rows = {r["id"]: r for r in df.collect()}
    assert len(rows) == 253
    return rows


def same(got, want):
    return (got is None and want is None) or (got is not None and want is not None and abs(got - want) < 1e-9)


def ratio(a, b):
    return a / b if b else None


def test_parties(book, tables):
    got = by_id(timeline.parties(*tables, DAYS, top=4, key="id"))
    for i, own in history(book):
        best = lambda rows: sorted(Counter(rows.party).items(), key=lambda x: (-x[1], x[0]))
        now, past = best(own[own.age <= DAYS]), best(own[(own.age > DAYS) & (own.age <= 2 * DAYS)])
        first = own.groupby("party").age.max()
        n, kept = sum(c for _, c in now), len({p for p, _ in now[:4]} & {p for p, _ in past[:4]})
        r = got[i]
        assert (r.active_parties, r.kept_parties) == (len(now), kept)
        assert same(r.new_share, ratio(sum(first[p] <= DAYS for p, _ in now), len(now)))
        assert same(r.stability, ratio(kept, len(past[:4])))
        assert same(r.hhi, ratio(sum(c * c for _, c in now), n * n)) and same(r.top_share, ratio(now[0][1] if now else 0, n))
    assert all(got[i].active_parties == 0 and got[i].hhi is None for i in (900, 901, 902))


def test_shape(book, tables):
    got = by_id(timeline.shape(*tables, [DAYS, 60], "failed", key="id"))
    for i, own in history(book):
        for d in (DAYS, 60):
            rows, r = own[own.age <= d], got[i]
            n, hours = len(rows), rows.ts.dt.hour
            p = hours.value_counts(normalize=True)
            assert r[f"events_{d}d"] == n and same(r[f"hour_entropy_{d}d"], max(-(p * np.log(p)).sum(), 0) if n else None)
            assert same(r[f"night_share_{d}d"], ratio(((hours >= 22) | (hours < 4)).sum(), n))
            assert same(r[f"weekend_share_{d}d"], ratio((rows.ts.dt.dayofweek >= 5).sum(), n))
            assert same(r[f"failed_share_{d}d"], ratio((rows.type == "failed").sum(), n))


def test_balances_and_largest(book, tables):
    signed = F.when(F.col("type") == "in", F.col("amount")).when(F.col("type") == "out", -F.col("amount")).otherwise(0)
    got = by_id(timeline.balances(*tables, signed, DAYS, key="id"))
    out, inflow = (F.when(F.col("type") == t, F.col("amount")) for t in ("out", "in"))
    top = by_id(timeline.largest(*tables, DAYS, out, inflow, key="id"))
    for i, own in history(book):
        net = own.amount * own.type.map({"in": 1, "out": -1, "failed": 0})
        moves = net.groupby(own.age).sum()
        daily = [sum(v for a, v in moves.items() if a >= d) for d in range(1, DAYS + 1) if len(moves) and d <= moves.index.max()]
        r = got[i]
        assert (r.days_known, r.zero_days) == (len(daily), sum(b <= 0 for b in daily))
        assert same(r.avg_balance, np.mean(daily) if daily else None) and same(r.min_balance, min(daily, default=None))
        if daily and np.mean(daily):
            assert r.balance_cv == pytest.approx(np.std(daily) / abs(np.mean(daily)), abs=1e-6)
            assert r.month_end_ratio == pytest.approx(np.mean(daily[:5]) / np.mean(daily))
        rows = own[own.age <= DAYS]
        spent = rows.amount[rows.type == "out"]
        assert same(top[i].max_outflow, spent.max() if len(spent) else None) and same(top[i].mean_outflow, spent.mean() if len(spent) else None)
        assert same(top[i].max_outflow_ratio, ratio(spent.max(), rows.amount[rows.type == "in"].sum()) if len(spent) else None)


def test_flows(book, tables):
    sums = {t: F.when(F.col("type") == t, F.col("amount")) for t in ("in", "out")}
    got = by_id(timeline.flows(*tables, DAYS, sums, {"spent": ("out", "in")}, ["in"], key="id"))
    for i, own in history(book):
        total = lambda t, lo, hi: int(own.amount[(own.type == t) & (own.age > lo) & (own.age <= hi)].sum())
        now, past = total("in", 0, DAYS), total("in", DAYS, 2 * DAYS)
        assert (got[i]["in"], got[i]["out"]) == (now, total("out", 0, DAYS))
        assert same(got[i].spent, ratio(total("out", 0, DAYS), now)) and same(got[i].in_growth, ratio(now, past) - 1 if past else None)


def test_past_due(spark, book):
    _, asked = book
    rng = np.random.default_rng(2)
    n = 600
    loans = pd.DataFrame({"user_id": np.where(rng.random(n) < 0.5, 0, rng.integers(1, 25, n)), "opened": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 150, n), unit="D")})
    loans["due"] = loans.opened + pd.to_timedelta(rng.integers(0, 30, n), unit="D")
    loans["repaid"] = (loans.opened + pd.to_timedelta(rng.integers(-3, 90, n), unit="D")).where(rng.random(n) < 0.8)
    loans["drawn"], loans["limit"] = rng.integers(0, 50, n), 50
    rows = [tuple(None if pd.isna(x) else x.to_pydatetime() if isinstance(x, pd.Timestamp) else int(x) for x in r) for r in loans.itertuples(index=False)]
    table = spark.createDataFrame(rows, "user_id long, opened timestamp_ntz, due timestamp_ntz, repaid timestamp_ntz, drawn long, limit long")
    got = {r["id"]: r for r in timeline.past_due(table, spark.createDataFrame(asked), 40, key="id").collect()}
    day = pd.Timedelta(days=1)
    for r in asked.itertuples():
        worst, drawn, limit = 0, 0, 0
        t = r.at.normalize()
        for x in loans[loans.user_id == r.user_id].itertuples():
            end = max(x.repaid, x.opened) if not pd.isna(x.repaid) else t
            if x.opened < t and end >= t:
                drawn, limit = drawn + x.drawn, limit + x.limit
            for back in range(1, 41):
                d = t - back * day
                if x.opened <= d < end:
                    worst = max(worst, (d - x.due).days)
        assert got[r.id].max_dpd == worst and same(got[r.id].utilisation, drawn / limit if limit else None)


def test_unfolded_days_never_go_through_the_driver(spark):
    """Each asked day meets its stretches in a merge, however small the planner takes the days for."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    asked = spark.range(40).select((F.col("id") % 3).alias("user"), day.alias("day"))
    loans = asked.select("user", F.col("day").alias("opened"), F.col("day").alias("due"), F.date_add("day", 9).alias("repaid"))
    counts = asked.select("user", F.lit("a").alias("party"), "day", F.lit(1).alias("n"))
    for found in (timeline._earliest_due(loans, asked), timeline.best_on(counts, asked, 3, DAYS)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join [user" in line and ", k#" in line]
        assert joins and all("SortMergeJoin" in line for line in joins)


def test_extremes_store_a_logarithm_per_cell_and_no_pair_per_window(spark):
    n = 1200
    cells = spark.range(n).select(F.lit(0).alias("user"), F.col("id").alias("i"), ((F.col("id") * 7919) % 1009).alias("v"))
    spans = spark.range(n).select(
        F.lit(0).alias("user"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
        F.greatest(F.col("id") - 364, F.lit(0)).alias("first"), F.col("id").alias("last"),
    )
    got = [r.value for r in timeline.extremes(cells, spans, "min", 365).orderBy("day").collect()]
    v = [i * 7919 % 1009 for i in range(n)]
    assert got == [min(v[max(0, i - 364) : i + 1]) for i in range(n)]


def test_stretches_are_few_and_cover_each_day_once(spark):
    rows = [(lo, lo + n) for lo in (-5, 0, 3, 64, 1000) for n in (1, 2, 7, 31, 63)]
    held = spark.createDataFrame(rows, "lo long, end long")
    for r in held.withColumn("s", timeline._stretches(6)).collect():
        days = sorted(d for x in r.s for d in range(x.b << x.k, (x.b + 1) << x.k))
        assert days == list(range(r.lo, r.end)) and len(r.s) <= 11


def test_no_rows(tables):
    log, asked = tables
    for empty in (log.limit(0), log):
        some = asked if empty is not log else asked.limit(0)
        n = some.count()
        assert timeline.parties(empty, some, 7, key="id").count() == n
        assert timeline.shape(empty, some, [7], "failed", key="id").count() == n
        assert timeline.balances(empty, some, F.col("amount"), 7, key="id").count() == n
        assert timeline.largest(empty, some, 7, F.col("amount"), F.col("amount"), key="id").count() == n
