"""The mart job end to end: raw tables to the contract, against values by hand, and on to the fitted views."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditloom import contract
from creditloom.plans import features, mart_job


@pytest.fixture(scope="module")
def raw():
    rng = np.random.default_rng(17)
    users, n = 260, 9000
    days = lambda lo, hi, k: pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(lo * 24, hi * 24, k), unit="h")
    kinds = [*mart_job.INFLOWS, *mart_job.OUTFLOWS, *mart_job.OTHERS]
    log = pd.DataFrame({
        "user_id": np.where(rng.random(n) < 0.2, 3, rng.integers(0, users - 10, n)), "ts": days(0, 520, n),
        "kind": rng.choice(kinds, n), "party": rng.choice([f"p{i}" for i in range(9)], n), "amount": rng.integers(5, 3000, n).astype(float),
        "failed": rng.random(n) < 0.1,
    })
    log["lat"], log["lon"] = np.where(log.kind == "agent", rng.uniform(-2, 0, n), np.nan), np.where(log.kind == "agent", rng.uniform(36, 38, n), np.nan)
    people = pd.DataFrame({
        "user_id": np.arange(users), "born": pd.Timestamp("1960-01-01") + pd.to_timedelta(rng.integers(0, 15000, users), unit="D"),
        "gender": rng.choice(["f", "m"], users), "region": rng.choice(["north", "south"], users), "segment": rng.choice(["salaried", "trader", "gig"], users),
        "device_tier": rng.choice(["feature", "mid"], users), "registered": pd.Timestamp("2022-01-01") + pd.to_timedelta(rng.integers(0, 600, users), unit="D"),
    })
    m = 700
    loans = pd.DataFrame({"user_id": rng.integers(0, users, m), "lender": rng.choice(["x", "y", "z"], m), "opened": days(0, 500, m)})
    loans["due"] = loans.opened + pd.Timedelta(days=30)
    loans["repaid"] = (loans.opened + pd.to_timedelta(rng.integers(1, 90, m), unit="D")).where(rng.random(m) < 0.8)
    loans["principal"], loans["drawn"], loans["limit"] = rng.integers(100, 900, m).astype(float), rng.integers(0, 500, m).astype(float), 500.0
    k = 900
    asked = pd.DataFrame({"customer_id": [f"c{i}" for i in range(k)], "user_id": rng.integers(0, users, k), "application_date": days(200, 540, k)})
    asked["approved"] = (rng.random(k) < 0.85).astype(int)
    asked["default_flag"] = np.where(asked.approved == 1, (rng.random(k) < 0.25).astype(float), np.nan)
    return asked, people, log, loans


@pytest.fixture(scope="module")
def book(spark, raw, tmp_path_factory):
    def frame(pdf):
        rows = [tuple(None if x is None or x != x else x.to_pydatetime() if isinstance(x, pd.Timestamp) else getattr(x, "item", lambda x=x: x)() for x in r) for r in pdf.itertuples(index=False)]
        kinds = {"i": "long", "f": "double", "M": "timestamp_ntz", "b": "boolean", "O": "string"}
        return spark.createDataFrame(rows, ", ".join(f"`{c}` {kinds.get(t.kind, 'string')}" for c, t in pdf.dtypes.items()))

    path = str(tmp_path_factory.mktemp("mart") / "book")
    mart_job.build_book(*(frame(t) for t in raw)).write.parquet(path)
    return spark.read.parquet(path)


def test_the_book_has_the_shape_of_the_contract(book):
    assert [(f.name, f.dataType) for f in book.schema.fields] == [(f.name, f.dataType) for f in contract.APPLICATION_SCHEMA.fields]
    lost = book.agg(*[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in contract.APPLICATION_SCHEMA.fields]).first().asDict()
    assert book.count() == book.select("customer_id").distinct().count() == 900
    assert {c for c, n in lost.items() if n} <= {f.name for f in contract.APPLICATION_SCHEMA.fields if f.nullable}
    assert all(0 < lost[c] < 900 for c in ("income_growth_3m", "max_dpd_last_180d", "prior_ontime_repayment_ratio"))


def test_values_by_hand(book, raw):
    asked, people, log, loans = raw
    got = {r["customer_id"]: r for r in book.collect()}
    for a in asked.sample(120, random_state=2).itertuples():
        r, day = got[a.customer_id], a.application_date.normalize()
        own = log[log.user_id == a.user_id]
        age = (day - own.ts.dt.normalize()).dt.days
        back = lambda d, *kinds: own[(age > 0) & (age <= d) & own.kind.isin(kinds)]  # noqa: B023, E731
        inflow, outflow = back(90, *mart_job.INFLOWS).amount.sum(), back(90, *mart_job.OUTFLOWS).amount.sum()
        ratio = lambda x, y: x / y if y else 0.0
        want = {
            "monthly_inflow_kes": inflow / 3, "inflow_txn_count_30d": len(back(30, *mart_job.INFLOWS)), "sim_swap_count_12m": len(back(365, "swap")),
            "net_cash_flow_ratio": ratio(inflow - outflow, inflow), "utility_bill_count_90d": len(back(90, "bill")), "school_fees_payment_flag": len(back(180, "school")) > 0,
            "airtime_topup_avg_kes": ratio(back(30, "airtime").amount.sum(), len(back(30, "airtime"))), "merchant_till_spend_ratio": ratio(back(90, "till").amount.sum(), outflow),
            "betting_spend_ratio": ratio(back(90, "bet").amount.sum(), outflow), "reversal_count_90d": len(back(90, "reversal")),
            "distinct_agent_locations_90d": back(90, "agent").party.nunique(), "distinct_counterparties_30d": own[(age > 0) & (age <= 30)].party.nunique(),
            "salary_deposit_flag": back(90, *mart_job.INFLOWS).party.value_counts().max() >= 3 if len(back(90, *mart_job.INFLOWS)) else 0,
            "max_single_outflow_ratio": ratio(back(90, *mart_job.OUTFLOWS).amount.max() if len(back(90, *mart_job.OUTFLOWS)) else 0, inflow / 3),
            "prior_loan_count": ((loans.user_id == a.user_id) & (loans.opened.dt.normalize() < day)).sum(),
            "tenure_days": (day - people.registered[a.user_id]).days,
        }
        past = back(180, *mart_job.INFLOWS).amount.sum() - inflow
        assert r["income_growth_3m"] == (pytest.approx(inflow / past - 1) if past else None)
        for name, value in want.items():
            assert r[name] == pytest.approx(float(value)), (a.customer_id, name)
        rent = np.sort(back(365, "rent").ts.astype("int64") // 10**9)
        gaps = np.diff(rent)
        steady = 1 - gaps.std() / gaps.mean() if len(rent) > 2 and gaps.mean() else 0
        assert r["rent_payment_regularity"] == pytest.approx(steady, abs=1e-9)
        assert isinstance(r["application_date"], dt.datetime) and r["application_month"] == (day.year - 2020) * 12 + day.month - 1


def test_the_book_goes_through_the_feature_stage(spark, book, tmp_path):
    out = str(tmp_path / "out")
    binning = features.build_features(spark, book.withColumn("application_month", F.col("application_month") % 24), out)
    assert set(binning.features) == set(contract.MODELLED)
    woe = spark.read.parquet(f"{out}/woe")
    assert woe.count() == book.where("approved = 1").count() and f"woe_{contract.MODELLED[0]}" in woe.columns
