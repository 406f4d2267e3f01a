"""The mart job: from a wallet's raw tables to the application book of the contract.

Every feature is as of the application's own day and sees what happened before it. Tables:

- ``applications``: the contract's id, date, approval and outcome, and user_id;
- ``people``: user_id, born, gender, region, segment, device_tier, registered;
- ``log``: user_id, ts, kind, party, amount, failed, lat, lon;
- ``loans``: user_id, lender, opened, due, repaid, principal, drawn, limit.

Each feature family is one table by application; they meet on the application's key. A user without a log has counts of 0; ratios
without a base are 0 where the contract wants a number and missing where it allows that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import contract
from creditloom.functions.expr import age_band
from creditloom.operators import asof, timeline
from creditloom.sources.staging import stage

#: Kinds of log rows, by the way money goes.
INFLOWS = ("in", "received")
OUTFLOWS = ("bill", "school", "rent", "airtime", "till", "sent", "bet", "save", "insure")
OTHERS = ("withdraw", "agent", "swap", "reversal")
MONTH, QUARTER, HALF, YEAR = 30, 90, 180, 365
#: Times that a counterparty has to recur.
RECURS = 3
KM_PER_DEGREE = 111.2
SINCE = "2020-01-01"


def _sums(log: DataFrame, decisions: DataFrame) -> DataFrame:
    """Counts and amounts of every kind in every window."""
    kinds = (*INFLOWS, *OUTFLOWS, *OTHERS)
    cells = {f"n_{k}": F.count_if(F.col("kind") == k) for k in kinds}
    cells |= {f"a_{k}": F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("amount"))), F.lit(0.0)) for k in kinds}
    cells |= {"n_all": F.count(F.lit(1)), "n_failed": F.count_if(F.col("failed"))}
    known = log.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    days = known.groupBy(F.col("user_id").alias("user"), F.to_date("ts").alias("day")).agg(*[c.alias(n) for n, c in cells.items()])
    asked = decisions.select(F.col("user_id").alias("user"), F.to_date("at").alias("day")).dropna().distinct()
    return timeline.window_sums(days, asked, list(cells), [MONTH, QUARTER, HALF, YEAR, None])


def _total(kinds: tuple[str, ...], days: int | None, what: str = "a") -> Column:
    return sum((F.col(f"{what}_{k}_{days}") for k in kinds), F.lit(0.0 if what == "a" else 0))


def _growth(kinds: tuple[str, ...]) -> Column:
    """The quarter against the one before it."""
    now = _total(kinds, QUARTER)
    return F.try_divide(now, _total(kinds, HALF) - now) - 1.0


def _flow_features() -> dict[str, Column]:
    inflow, outflow = _total(INFLOWS, QUARTER), _total(OUTFLOWS, QUARTER)
    monthly = inflow / 3.0
    return {
        "sim_swap_count_12m": F.col(f"n_swap_{YEAR}"),
        "monthly_inflow_kes": monthly,
        "inflow_txn_count_30d": _total(INFLOWS, MONTH, "n"),
        "income_growth_3m": _growth(INFLOWS),
        "net_cash_flow_ratio": F.try_divide(inflow - outflow, inflow),
        "utility_bill_count_90d": F.col(f"n_bill_{QUARTER}"),
        "school_fees_payment_flag": (F.col(f"n_school_{HALF}") > 0).cast("long"),
        "airtime_topup_count_30d": F.col(f"n_airtime_{MONTH}"),
        "airtime_topup_avg_kes": F.try_divide(f"a_airtime_{MONTH}", f"n_airtime_{MONTH}"),
        "merchant_till_spend_ratio": F.try_divide(F.col(f"a_till_{QUARTER}"), outflow),
        "p2p_send_receive_ratio": F.try_divide(f"a_sent_{QUARTER}", f"a_received_{QUARTER}"),
        "savings_deposit_count_90d": F.col(f"n_save_{QUARTER}"),
        "savings_balance_ratio": F.try_divide(F.greatest(F.col("a_save_None") - F.col("a_withdraw_None"), F.lit(0.0)), monthly),
        "betting_txn_count_30d": F.col(f"n_bet_{MONTH}"),
        "betting_spend_ratio": F.try_divide(F.col(f"a_bet_{QUARTER}"), outflow),
        "betting_spend_trend_90d": _growth(("bet",)),
        "failed_txn_ratio": F.try_divide(f"n_failed_{QUARTER}", f"n_all_{QUARTER}"),
        "reversal_count_90d": F.col(f"n_reversal_{QUARTER}"),
    }


def build_book(applications: DataFrame, people: DataFrame, log: DataFrame, loans: DataFrame) -> DataFrame:
    """One row per application in the shape of the contract."""
    key = contract.ID
    decisions = applications.select(key, "user_id", F.col(contract.DATE).alias("at"))
    log = stage(log.select("user_id", "ts", "kind", "party", "amount", "failed", "lat", "lon"), "log")
    of = lambda *kinds: log.where(F.col("kind").isin(*kinds))
    by = {"key": key}

    sums = _sums(log, decisions).select("user", "day", *[c.alias(n) for n, c in _flow_features().items()])
    families = [timeline._answer(decisions, sums, key, "user_id", "at")]

    def family(found: DataFrame, **names: str | Column) -> None:
        families.append(found.select(key, *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in names.items()]))

    family(timeline.regularity(of(*INFLOWS), decisions, YEAR, **by), inflow_regularity_score="regularity")
    family(timeline.regularity(of("bill"), decisions, YEAR, **by), utility_payment_punctuality="regularity")
    family(timeline.regularity(of("rent"), decisions, YEAR, **by), rent_payment_regularity="regularity")
    payers = timeline.parties(of(*INFLOWS), decisions, QUARTER, **by)
    family(payers, salary_deposit_flag=(F.col("top_count") >= RECURS).cast("long"), inflow_concentration_hhi="hhi")
    insured = timeline.parties(of("insure"), decisions, HALF, **by)
    family(insured, insurance_premium_flag=(F.col("top_count") >= RECURS).cast("long"))
    everyone = timeline.parties(log, decisions, MONTH, **by)
    family(everyone, distinct_counterparties_30d="active_parties", new_counterparty_ratio="new_share")
    family(timeline.parties(of("sent", "received"), decisions, QUARTER, **by), contact_stability_score="stability")
    agents = timeline.parties(of("agent"), decisions, QUARTER, **by)
    family(agents, distinct_agent_locations_90d="active_parties", home_agent_concentration="top_share")
    shape = timeline.shape(log, decisions, [QUARTER], "", kind="kind", **by)
    family(shape, night_txn_ratio=f"night_share_{QUARTER}d", weekend_txn_ratio=f"weekend_share_{QUARTER}d", txn_time_entropy=f"hour_entropy_{QUARTER}d")
    signed = F.when(F.col("kind").isin(*INFLOWS, "withdraw"), F.col("amount")).when(F.col("kind").isin(*OUTFLOWS), -F.col("amount")).otherwise(0.0)
    family(
        timeline.balances(log, decisions, signed, MONTH, **by), avg_daily_balance_kes="avg_balance", min_balance_kes="min_balance",
        balance_volatility_cv="balance_cv", days_with_zero_balance_30d="zero_days", month_end_liquidity_ratio="month_end_ratio",
    )
    spent = F.when(F.col("kind").isin(*OUTFLOWS), F.col("amount"))
    family(timeline.largest(log, decisions, QUARTER, spent, F.lit(None).cast("double"), **by), _largest="max_outflow")
    area = timeline.box(of("agent"), decisions, ["lat", "lon"], QUARTER, **by)
    north = (F.col("lat_max") - F.col("lat_min")) * KM_PER_DEGREE / 2
    east = (F.col("lon_max") - F.col("lon_min")) * KM_PER_DEGREE / 2 * F.cos(F.radians((F.col("lat_max") + F.col("lat_min")) / 2))
    family(area, travel_radius_km=F.sqrt(north * north + east * east))
    family(
        asof.loan_history(loans, decisions, at="at", **by), prior_loan_count="prior_loan_count", prior_ontime_repayment_ratio="ontime_share",
        days_since_last_loan="days_since_last_loan", active_lender_count="active_lenders", loan_stacking_velocity_90d="stacking_velocity", _exposure="exposure",
    )
    due = timeline.past_due(loans, decisions, HALF, **by)
    family(due, _max_dpd="max_dpd", overdraft_utilisation="utilisation")

    book = applications
    for found in families:
        book = book.join(found.drop("user_id", "decision_day"), key, "left")
    who = people.select(F.col("user_id").alias("_user"), "born", "gender", "region", "segment", "device_tier", "registered")
    book = book.join(who, F.col("user_id") == F.col("_user"), "left")
    day, monthly = F.to_date(contract.DATE), F.col("monthly_inflow_kes")
    age = F.floor(F.months_between(day, F.to_date("born")) / 12).cast("long")
    month = (F.year(day) * 12 + F.month(day)) - F.lit(int(SINCE[:4]) * 12 + int(SINCE[5:7]))
    book = book.withColumns({
        contract.MONTH: month.cast("long"),
        "age": age,
        "age_band": age_band(age),
        "tenure_days": F.datediff(day, F.to_date("registered")).cast("double"),
        "max_single_outflow_ratio": F.try_divide("_largest", "monthly_inflow_kes"),
        "total_credit_exposure_ratio": F.try_divide("_exposure", "monthly_inflow_kes"),
        # without a loan nothing can be late, and that is not the same as never late
        "max_dpd_last_180d": F.when(F.col("prior_loan_count") > 0, F.col("_max_dpd").cast("double")),
        "days_since_last_loan": F.col("days_since_last_loan").cast("double"),
    }).withColumn("monthly_inflow_kes", monthly)
    columns = []
    for field in contract.APPLICATION_SCHEMA.fields:
        value = F.col(field.name).cast(field.dataType)
        if field.name in contract.RAW and not field.nullable and field.dataType != contract.TEXT:
            value = F.coalesce(value, F.lit(0).cast(field.dataType))
        elif field.name in contract.RAW and field.dataType == contract.TEXT:
            value = F.coalesce(value, F.lit("unknown"))
        columns.append(value.alias(field.name))
    return book.select(*columns)
