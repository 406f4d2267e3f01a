"""The feature contract: Spark fields that carry family, role and expected risk direction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = "customer_id"
DATE = "application_date"
MONTH = "application_month"
APPROVED = "approved"
TARGET = "default_flag"
ORACLE_TARGET = "true_default_flag"
CARRY = (ID, DATE, MONTH, APPROVED, TARGET)

LONG, DOUBLE, TEXT = T.LongType(), T.DoubleType(), T.StringType()
SAFER, NEUTRAL, RISKIER = 1, 0, -1
PROTECTED_ROLE, MAY_BE_NULL = "protected", "null"

# ---- fixed values: name, type and expected direction of risk as the value rises, by family ----
CONTRACT = {
    "demographic": [
        ("age", LONG, NEUTRAL),
        ("gender", TEXT, NEUTRAL, PROTECTED_ROLE),
        ("region", TEXT, NEUTRAL, PROTECTED_ROLE),
        ("age_band", TEXT, NEUTRAL, PROTECTED_ROLE),
        ("segment", TEXT, NEUTRAL),
    ],
    "identity": [
        ("tenure_days", DOUBLE, SAFER),
        ("device_tier", TEXT, NEUTRAL),
        ("sim_swap_count_12m", LONG, RISKIER),
    ],
    "income": [
        ("monthly_inflow_kes", DOUBLE, SAFER),
        ("inflow_txn_count_30d", LONG, SAFER),
        ("inflow_regularity_score", DOUBLE, SAFER),
        ("salary_deposit_flag", LONG, SAFER),
        ("inflow_concentration_hhi", DOUBLE, NEUTRAL),
        ("income_growth_3m", DOUBLE, SAFER, MAY_BE_NULL),
    ],
    "cashflow": [
        ("avg_daily_balance_kes", DOUBLE, SAFER),
        ("min_balance_kes", DOUBLE, SAFER),
        ("balance_volatility_cv", DOUBLE, RISKIER),
        ("days_with_zero_balance_30d", LONG, RISKIER),
        ("net_cash_flow_ratio", DOUBLE, SAFER),
        ("month_end_liquidity_ratio", DOUBLE, SAFER),
    ],
    "obligations": [
        ("utility_bill_count_90d", LONG, SAFER),
        ("utility_payment_punctuality", DOUBLE, SAFER),
        ("school_fees_payment_flag", LONG, SAFER),
        ("rent_payment_regularity", DOUBLE, SAFER),
    ],
    "spending": [
        ("airtime_topup_count_30d", LONG, NEUTRAL),
        ("airtime_topup_avg_kes", DOUBLE, SAFER),
        ("merchant_till_spend_ratio", DOUBLE, SAFER),
        ("p2p_send_receive_ratio", DOUBLE, NEUTRAL),
        ("savings_deposit_count_90d", LONG, SAFER),
        ("savings_balance_ratio", DOUBLE, SAFER),
        ("insurance_premium_flag", LONG, SAFER),
    ],
    "behaviour": [
        ("betting_txn_count_30d", LONG, RISKIER),
        ("betting_spend_ratio", DOUBLE, RISKIER),
        ("betting_spend_trend_90d", DOUBLE, RISKIER, MAY_BE_NULL),
        ("night_txn_ratio", DOUBLE, RISKIER),
        ("weekend_txn_ratio", DOUBLE, NEUTRAL),
        ("txn_time_entropy", DOUBLE, NEUTRAL),
        ("distinct_counterparties_30d", LONG, NEUTRAL),
        ("new_counterparty_ratio", DOUBLE, RISKIER),
        ("max_single_outflow_ratio", DOUBLE, RISKIER),
        ("failed_txn_ratio", DOUBLE, RISKIER),
        ("reversal_count_90d", LONG, RISKIER),
    ],
    "credit": [
        ("prior_loan_count", LONG, NEUTRAL),
        ("prior_ontime_repayment_ratio", DOUBLE, SAFER, MAY_BE_NULL),
        ("days_since_last_loan", DOUBLE, NEUTRAL, MAY_BE_NULL),
        ("overdraft_utilisation", DOUBLE, RISKIER),
        ("active_lender_count", LONG, RISKIER),
        ("loan_stacking_velocity_90d", DOUBLE, RISKIER),
        ("max_dpd_last_180d", DOUBLE, RISKIER, MAY_BE_NULL),
        ("total_credit_exposure_ratio", DOUBLE, RISKIER),
    ],
    "mobility": [
        ("distinct_agent_locations_90d", LONG, NEUTRAL),
        ("home_agent_concentration", DOUBLE, SAFER),
        ("travel_radius_km", DOUBLE, NEUTRAL),
        ("contact_stability_score", DOUBLE, SAFER, MAY_BE_NULL),
    ],
    "derived": [
        ("buffer_days", DOUBLE, SAFER),
        ("liquidity_stress_index", DOUBLE, RISKIER),
        ("betting_to_savings_ratio", DOUBLE, RISKIER),
        ("credit_hunger_index", DOUBLE, RISKIER),
        ("obligation_discipline_index", DOUBLE, SAFER),
        ("income_stability_index", DOUBLE, SAFER),
        ("exposure_to_capacity_ratio", DOUBLE, RISKIER),
    ],
}
# ---- end of fixed values ----


def _fields() -> list[T.StructField]:
    out = []
    for family, features in CONTRACT.items():
        for name, kind, direction, *marks in features:
            role = "derived" if family == "derived" else "protected" if PROTECTED_ROLE in marks else "raw"
            out.append(T.StructField(name, kind, MAY_BE_NULL in marks, {"family": family, "role": role, "direction": direction}))
    return out


FEATURES = T.StructType(_fields())


def names(*roles: str, text: bool | None = None) -> tuple[str, ...]:
    """Features in one of ``roles``; ``text`` narrows to text or to numeric ones."""
    return tuple(f.name for f in FEATURES if f.metadata["role"] in roles and text in (None, f.dataType == TEXT))


MODELLED = names("raw", "derived")
NUMERIC = names("raw", "derived", text=False)
CATEGORICAL = names("raw", "derived", text=True)
PROTECTED = names("protected")
DERIVED = names("derived")
RAW = names("raw", "protected")
NULLABLE = tuple(f.name for f in FEATURES if f.nullable)
PRIORS = {name: FEATURES[name].metadata["direction"] for name in MODELLED if FEATURES[name].metadata["direction"]}

APPLICATION_SCHEMA = T.StructType(
    [
        T.StructField(ID, TEXT, False),
        T.StructField(DATE, T.TimestampNTZType(), False),
        T.StructField(MONTH, LONG, False),
        *[T.StructField(f.name, f.dataType, f.nullable) for f in FEATURES if f.name in RAW],
        T.StructField(APPROVED, LONG, False),
        T.StructField(TARGET, DOUBLE, True),
    ]
)

ORACLE_SCHEMA = T.StructType(
    [
        T.StructField(ID, T.StringType(), False),
        T.StructField(ORACLE_TARGET, T.LongType(), False),
        T.StructField("pd_true", T.DoubleType(), False),
        T.StructField("latent_capacity", T.DoubleType(), False),
        T.StructField("latent_stress", T.DoubleType(), False),
        T.StructField(APPROVED, T.LongType(), False),
    ]
)


def feature_frame(spark: SparkSession) -> DataFrame:
    """The contract as a dimension table."""
    rows = [(f.name, f.dataType.simpleString(), f.metadata["family"], f.metadata["role"], f.metadata["direction"]) for f in FEATURES]
    table = spark.createDataFrame(rows, "feature string, storage string, family string, role string, direction int")
    rising = F.element_at(F.create_map(*map(F.lit, (1, "safer", 0, "no expected direction", -1, "riskier"))), F.col("direction"))
    risk = F.element_at(F.create_map(*map(F.lit, (1, "lower risk", 0, "-", -1, "higher risk"))), F.col("direction"))
    return table.select(
        "feature",
        "family",
        F.when(F.col("storage") == "string", "categorical").otherwise("numeric").alias("type"),
        (F.col("role") != "protected").alias("modelled"),
        (F.col("role") == "protected").alias("protected"),
        (F.col("role") == "derived").alias("derived"),
        "direction",
        F.concat(F.regexp_replace(F.regexp_replace("feature", "_kes", " in KES"), "_", " "), F.lit(" ("), rising, F.lit(")")).alias("description"),
        risk.alias("risk_direction"),
    )
