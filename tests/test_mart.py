import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditloom.operators import asof, mart
from creditloom.sources.views import days_since_previous

START = dt.datetime(2024, 1, 1)


def at():
    return F.expr("TIMESTAMP_NTZ '2024-01-31 00:00:00'")



@pytest.fixture(scope="module")
def log():
    """A log in which one user holds a third of the events."""
    rng = np.random.default_rng(2)
    n = 900
    users = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 20, n))
    return pd.DataFrame(
        {
            "user_id": users,
            "ts": [START + dt.timedelta(seconds=int(s)) for s in rng.integers(0, 30 * 86400, n)],
            "type": rng.choice(["signup", "purchase", "error", "view"], n),
            "amount": np.round(rng.exponential(20, n), 2),
            "party": rng.choice([f"p{i}" for i in range(12)], n),
        }
    )


@pytest.fixture(scope="module")
def txn(spark, log):
    df = spark.createDataFrame(log).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return df.repartition(5).cache()


def by_user(df):
    return df.toPandas().set_index("user_id")


def test_gap_regularity(txn, log):
    got = by_user(mart.gap_regularity(txn))
    for user, part in log.groupby("user_id"):
        gaps = part["ts"].sort_values().diff().dt.total_seconds().dropna()
        assert got.loc[user, "events"] == len(part)
        assert got.loc[user, "mean_gap"] == pytest.approx(gaps.mean())
        assert got.loc[user, "regularity"] == pytest.approx(1 - gaps.std(ddof=0) / gaps.mean(), abs=1e-9)


def test_gap_regularity_of_one_event_and_of_equal_times(spark):
    df = spark.createDataFrame(
        [(1, START), (2, START), (2, START)], "user_id long, ts timestamp_ntz"
    )
    got = by_user(mart.gap_regularity(df))
    assert pd.isna(got.loc[1, "regularity"]) and pd.isna(got.loc[2, "regularity"])
    assert got.loc[2, "mean_gap"] == 0


def test_concentration_and_entropy(txn, log):
    got, entropy = by_user(mart.concentration(txn)), by_user(mart.hour_entropy(txn))
    for user, part in log.groupby("user_id"):
        share = part["party"].value_counts(normalize=True)
        assert got.loc[user, "hhi"] == pytest.approx((share**2).sum())
        assert got.loc[user, "top_share"] == pytest.approx(share.max())
        hours = part["ts"].dt.hour.value_counts(normalize=True)
        assert entropy.loc[user, "entropy"] == pytest.approx(-(hours * np.log(hours)).sum(), abs=1e-9)


def test_daily_balances(txn, log):
    signed = F.expr("CASE type WHEN 'signup' THEN amount WHEN 'purchase' THEN -amount ELSE 0.0 END")
    got = by_user(mart.balance_features(mart.daily_balances(txn, signed)))
    runs = by_user(mart.balance_features(mart.balance_runs(txn, signed)))
    pd.testing.assert_frame_equal(runs.sort_index(), got.sort_index())
    sign = log["type"].map({"signup": 1, "purchase": -1}).fillna(0)
    for user, part in log.assign(v=sign * log["amount"]).groupby("user_id"):
        daily = part.groupby(part["ts"].dt.normalize())["v"].sum().asfreq("D", fill_value=0).cumsum()
        assert got.loc[user, "days"] == len(daily)
        assert got.loc[user, "avg_balance"] == pytest.approx(daily.mean())
        assert got.loc[user, "min_balance"] == pytest.approx(daily.min())
        assert got.loc[user, "balance_cv"] == pytest.approx(daily.std(ddof=0) / abs(daily.mean()))
        assert got.loc[user, "month_end_ratio"] == pytest.approx(daily.iloc[-5:].mean() / daily.mean())


def test_counterparties(txn, log):
    fresh, sets = by_user(mart.new_counterparties(txn, at(), 7)), by_user(mart.set_stability(txn, at(), 15, top=3))
    cut, half = START + dt.timedelta(days=23), START + dt.timedelta(days=15)
    for user, part in log.groupby("user_id"):
        seen = part.groupby("party")["ts"].agg(["min", "max"])
        active = seen["max"] >= cut
        assert fresh.loc[user, "active_parties"] == active.sum()
        if active.any():
            assert fresh.loc[user, "new_share"] == pytest.approx((active & (seen["min"] >= cut)).sum() / active.sum())

        def top(rows):
            n = rows["party"].value_counts().rename("n").rename_axis("party").reset_index()
            return set(n.sort_values(["n", "party"], ascending=[False, True]).head(3)["party"])

        a, b = top(part[part["ts"] >= half]), top(part[part["ts"] < half])
        assert sets.loc[user, "kept"] == len(a & b)


def test_top_counterparties_are_limited_before_the_shuffle(txn):
    plan = mart.set_stability(txn, at(), 15)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_days_since_previous(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [(1, 10, day(1)), (2, 10, day(1)), (3, 10, day(5)), (4, 11, day(9)), (5, None, day(9))]
    df = spark.createDataFrame(rows, "id long, who long, at timestamp_ntz")
    got = {r["id"]: r["days_since_prev"] for r in days_since_previous(df, "who", "at", "id").collect()}
    assert got == {1: None, 2: 0.0, 3: 4.0, 4: None, 5: None}


def test_loan_history(spark):
    d = lambda m, day: dt.datetime(2024, m, day)
    schema = (
        "user_id long, lender string, opened timestamp_ntz, due timestamp_ntz, repaid timestamp_ntz, "
        "principal double, outstanding double, credit_limit double, days_past_due int"
    )
    rows = [
        (1, "a", d(1, 1), d(2, 1), d(1, 30), 100.0, 0.0, 100.0, 0),
        (1, "b", d(3, 1), d(4, 1), d(4, 20), 100.0, 0.0, 100.0, 19),
        (1, "b", d(5, 20), d(6, 20), None, 100.0, 60.0, 100.0, 0),
        (1, "c", d(5, 25), d(6, 25), None, 100.0, 90.0, 200.0, 3),
        (1, "d", d(8, 1), d(9, 1), None, 100.0, 90.0, 200.0, 99),
        (2, "a", d(1, 1), d(2, 1), None, 50.0, 50.0, 100.0, 150),
    ]
    loans = spark.createDataFrame(rows, schema)
    got = by_user(mart.loan_history(loans, F.expr("TIMESTAMP_NTZ '2024-06-01 00:00:00'")))
    one = got.loc[1]
    assert one["prior_loan_count"] == 4 and one["ontime_share"] == 0.5
    assert one["days_since_last_loan"] == 7 and one["max_dpd"] == 19
    assert one["stacking_velocity"] == pytest.approx(2 / 3)
    assert one["active_lenders"] == 2 and one["exposure"] == 150 and one["utilisation"] == 0.5
    assert got.loc[2, "max_dpd"] == 150 and pd.isna(got.loc[2, "ontime_share"])


def test_trend_sizes_and_flags(spark):
    day = lambda n: START + dt.timedelta(days=n)
    rows = [(1, day(20), "purchase", 30.0, "x"), (1, day(25), "purchase", 10.0, "x"), (1, day(2), "purchase", 20.0, "x"),
            (1, day(3), "signup", 100.0, "y"), (2, day(3), "signup", 1.0, "y")]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, type string, amount double, party string")
    trend = by_user(mart.trend(df.where("type = 'purchase'"), at(), 15))
    assert trend.loc[1, "growth"] == 1.0
    sizes = by_user(mart.size_features(df))
    assert sizes.loc[1, "max_outflow_ratio"] == 0.3 and pd.isna(sizes.loc[2, "max_outflow"])
    flags = by_user(mart.recurring_flags(df))
    assert flags.loc[1, "recurring_outflow"] == 1 and flags.loc[1, "recurring_inflow"] == 0
    last = by_user(mart.recency(df, at()))
    assert last.loc[1, "days_since_outflow"] == 5 and last.loc[1, "tenure_days"] == 28
    assert pd.isna(last.loc[2, "days_since_outflow"])


# ------------------------------------------------------- as of each application


def test_each_application_looks_back_from_its_own_day(spark):
    log = spark.createDataFrame(
        [(1, "2024-03-01 09:00:00", "in", 5.0), (1, "2024-03-01 23:00:00", "out", 2.0), (1, "2024-03-10 01:00:00", "in", 1.0),
         (None, "2024-03-01 01:00:00", "in", 9.0), (1, None, "in", 9.0), (2, "2024-03-05 00:00:00", "in", 4.0)],
        "user_id long, ts string, type string, amount double",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    asked = spark.createDataFrame(
        [(10, 1, "2024-03-01 23:59:00"), (11, 1, "2024-03-11 00:00:00"), (12, 1, "2024-03-11 12:00:00"),
         (12, 1, "2024-03-11 12:00:00"), (13, 2, "2024-03-05 10:00:00"), (14, 3, "2024-03-05 00:00:00"),
         (15, None, "2024-03-11 00:00:00"), (16, 1, None)],
        "id long, user_id long, at string",
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = asof.activity(log, asked, [5, 10], ["in", "out"], key="id", at="at").collect()
    assert len(got) == 8 and sum(r["id"] == 12 for r in got) == 2
    by = {r["id"]: (r["in_count_5d"], r["in_count_10d"], r["out_count_10d"], r["amount_10d"]) for r in got}
    assert by[11] == by[12] == (1, 2, 1, 8.0)
    assert all(by[i] == (0, 0, 0, None) for i in (10, 13, 14, 15, 16))
    seen = {r["id"]: r for r in asof.recency(log, asked, "out", key="id", at="at").collect()}
    assert (seen[11]["tenure_days"], seen[11]["days_since_last"], seen[11]["days_since_outflow"]) == (10, 1, 10)
    assert seen[10]["tenure_days"] is None and seen[15]["days_since_last"] is None
    empty = asof.activity(log.limit(0), asked, [5], ["in"], key="id", at="at")
    assert empty.count() == 8 and empty.agg(F.sum("in_count_5d")).first()[0] == 0


def test_a_hot_user_equals_a_plain_join(spark):
    rng = np.random.default_rng(5)
    n = 3000
    users = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 40, n))
    days = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 120 * 24, n), unit="h")
    log = pd.DataFrame({"user_id": users, "ts": days, "type": rng.choice(["in", "out"], n), "amount": 1.0})
    asked = log.sample(400, random_state=1)[["user_id", "ts"]].reset_index(drop=True)
    asked["id"] = np.arange(len(asked))
    asked = asked.rename(columns={"ts": "at"})
    got = asof.activity(
        spark.createDataFrame(log), spark.createDataFrame(asked), [30], ["in", "out"], key="id", at="at"
    ).collect()
    pairs = asked.merge(log, on="user_id")
    age = (pairs["at"].dt.normalize() - pairs["ts"].dt.normalize()).dt.days
    expected = pairs[(age >= 1) & (age <= 30)].groupby(["id", "type"]).size()
    for row in got:
        assert row["in_count_30d"] == expected.get((row["id"], "in"), 0)
        assert row["out_count_30d"] == expected.get((row["id"], "out"), 0)


def test_lenders_count_while_any_of_their_loans_is_open(spark):
    loans = spark.createDataFrame(
        [(1, "x", "2024-01-01", "2024-02-01", "2024-01-20", 100.0), (1, "x", "2024-01-10", "2024-02-10", None, 50.0),
         (1, "y", "2024-01-05", "2024-01-10", "2024-01-15", 30.0), (1, "z", "2024-01-08", "2024-01-10", "2024-01-02", 7.0)],
        "user_id long, lender string, opened string, due string, repaid string, principal double",
    )
    asked = spark.createDataFrame([(1, 1, "2024-01-01"), (2, 1, "2024-01-12"), (3, 1, "2024-01-31"), (4, 2, "2024-01-31")],
                                  "id long, user_id long, at string")
    got = {r["id"]: r for r in asof.loan_history(loans, asked, key="id", at="at").collect()}
    shown = lambda r: (r["prior_loan_count"], r["ontime_share"], r["active_lenders"], r["exposure"])
    assert shown(got[1]) == shown(got[4]) == (0, None, 0, 0.0)
    assert shown(got[2]) == (4, 1.0, 2, 180.0)
    assert shown(got[3]) == (4, pytest.approx(2 / 3), 1, 50.0)
    assert (got[3]["days_since_last_loan"], got[3]["stacking_velocity"]) == (21, pytest.approx(4 / 3))
