"""Analyst ratios as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom import contract
from creditloom.functions.expr import clip, round_even
from creditloom.operators.quality import require_columns


def mean_present(*columns: Column) -> Column:
    """Mean over the values that are present; null if none is."""
    held = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))
    return F.when(held > 0, F.try_divide(total, held))


def buffer_days(balance: Column, inflow: Column) -> Column:
    return round_even(clip(F.try_divide(balance, inflow / 30.0 + 1.0), 0, 120))


def liquidity_stress(zero_days: Column, balance_cv: Column) -> Column:
    return round_even(zero_days / 30.0 * balance_cv)


def betting_to_savings(betting: Column, savings: Column) -> Column:
    return round_even(clip(F.try_divide(betting, savings + 0.02), 0, 50))


def credit_hunger(lenders: Column, velocity: Column, prior_loans: Column) -> Column:
    return round_even(F.try_divide(lenders * (1.0 + velocity), 1.0 + prior_loans))


def obligation_discipline(*punctuality: Column) -> Column:
    return round_even(mean_present(*punctuality))


def income_stability(regularity: Column, salary: Column) -> Column:
    return round_even(regularity * (1.0 + 0.5 * salary))


def exposure_to_capacity(exposure: Column, net_flow: Column, inflow: Column) -> Column:
    room = (clip(net_flow, low=0) + 0.02) * inflow
    return round_even(clip(F.try_divide(exposure * inflow, room + 1.0), 0, 200))


def add_derived(df: DataFrame) -> DataFrame:
    """The seven derived features beside the raw ones; no shuffle, no extra pass."""
    c = F.col
    derived = {
        "buffer_days": buffer_days(c("avg_daily_balance_kes"), c("monthly_inflow_kes")),
        "liquidity_stress_index": liquidity_stress(
            c("days_with_zero_balance_30d"), c("balance_volatility_cv")
        ),
        "betting_to_savings_ratio": betting_to_savings(
            c("betting_spend_ratio"), c("savings_balance_ratio")
        ),
        "credit_hunger_index": credit_hunger(
            c("active_lender_count"), c("loan_stacking_velocity_90d"), c("prior_loan_count")
        ),
        "obligation_discipline_index": obligation_discipline(
            c("utility_payment_punctuality"),
            c("rent_payment_regularity"),
            c("prior_ontime_repayment_ratio"),
        ),
        "income_stability_index": income_stability(
            c("inflow_regularity_score"), c("salary_deposit_flag")
        ),
        "exposure_to_capacity_ratio": exposure_to_capacity(
            c("total_credit_exposure_ratio"), c("net_cash_flow_ratio"), c("monthly_inflow_kes")
        ),
    }
    return require_columns(df.withColumns(derived), contract.DERIVED)
