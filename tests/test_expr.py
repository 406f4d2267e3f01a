import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.functions import expr
from creditloom.operators import derive, scale
from creditloom.config import ECONOMICS, SCALE


def column(spark, values, type_="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, x {type_}")


def values(df, name="v"):
    return [r[name] for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("count", [0, 1, 5, 12, 13, 39, 300])
def test_bins_are_right_closed(spark, count):
    rng = np.random.default_rng(count)
    edges = sorted(set(np.round(rng.normal(size=count), 2).tolist()) | ({0.0} if count else set()))
    # values on edges, both zeros, beyond both ends, missing
    data = [*edges, *rng.normal(size=50).tolist(), 0.0, -0.0, -1e9, 1e9, None]
    df = expr.with_bins(column(spark, data), {"x": edges}).select("i", F.col("_bin_x").alias("v"))
    expected = [None if v is None else int(np.digitize(v, edges, right=True)) for v in data]
    assert values(df) == expected


@pytest.mark.parametrize("count", [0, 2, 12, 13, 39])
@pytest.mark.parametrize("lost", [None, float("nan")])
def test_missing_numbers_get_no_bin_at_any_edge_count(spark, count, lost):
    edges = [float(e) for e in range(count)]
    df = expr.with_bins(column(spark, [lost, 0.5, lost, 1e9]), {"x": edges})
    assert values(df, "_bin_x") == [None, min(count, 1), None, count]


def test_bins_of_integers(spark):
    df = expr.with_bins(column(spark, [1, 2, 3, None], "bigint"), {"x": [1.5, 2.0]})
    assert values(df, "_bin_x") == [0, 1, 2, None]


def test_rounding_is_half_even_on_the_scaled_value(spark):
    data = [0.00005, 0.00015, 1.23455, -0.00005, None]
    got = values(column(spark, data).select("i", expr.round_even(F.col("x")).alias("v")))
    expected = [None if v is None else float(np.round(v, 4)) for v in data]
    assert got == expected


def test_clip_keeps_null(spark):
    df = column(spark, [-5.0, 5.0, 500.0, None])
    assert values(df.select("i", expr.clip(F.col("x"), 0, 120).alias("v"))) == [0.0, 5.0, 120.0, None]
    assert values(df.select("i", expr.clip(F.col("x"), low=0).alias("v"))) == [0.0, 5.0, 500.0, None]


def test_nan_becomes_null(spark):
    df = expr.normalise_missing(column(spark, [1.0, float("nan"), None]))
    assert values(df, "x") == [1.0, None, None]


def test_risk_bands_on_their_limits(spark):
    df = column(spark, [850, 740, 739, 680, 679, 620, 619, 560, 559, 300], "int")
    assert "".join(values(df.select("i", expr.risk_band(F.col("x")).alias("v")))) == "AABBCCDDEE"


def test_age_bands(spark):
    df = column(spark, [17, 18, 24, 25, 44, 45, 54, 55, 100, 101, None], "int")
    got = values(df.select("i", expr.age_band(F.col("x")).alias("v")))
    assert got == [None, "18-24", "18-24", "25-34", "35-44", "45-54", "45-54", "55+", "55+", None, None]


def test_strength_and_verdict_limits(spark):
    df = column(spark, [0.0, 0.02, 0.1, 0.3, 0.5])
    assert values(df.select("i", expr.iv_strength(F.col("x")).alias("v"))) == [
        "unpredictive", "weak", "medium", "strong", "suspiciously strong",
    ]
    df = column(spark, [0.0999, 0.1, 0.2499, 0.25])
    assert values(df.select("i", expr.psi_verdict(F.col("x")).alias("v"))) == [
        "stable", "investigate", "investigate", "unstable",
    ]


def test_scale_constants():
    assert SCALE.factor == pytest.approx(57.70780163555854, abs=1e-12)
    assert SCALE.offset == pytest.approx(403.72437617565924, abs=1e-12)
    assert ECONOMICS.revenue_per_good == pytest.approx(244.5)
    assert ECONOMICS.loss_per_bad == pytest.approx(2472.0)


def test_score_round_trip_and_extremes(spark):
    df = column(spark, [1 / 31, 0.0, 1.0, 0.5, None])
    assert values(df.select("i", scale.probability_to_score(F.col("x")).alias("v"))) == [600, 850, 300, 404, None]
    df = column(spark, [600, 640], "int")
    got = values(df.select("i", scale.score_to_probability(F.col("x")).alias("v")))
    assert got == pytest.approx([1 / 31, 1 / 61])


def test_band_midpoints(spark):
    got = [r["indicative_pd"] for r in scale.band_table(spark).orderBy("band").collect()]
    assert got == [0.0011, 0.0050, 0.0139, 0.0384, 0.3902]


def test_mean_of_present_values(spark):
    df = spark.createDataFrame([(0, 1.0, None), (1, 1.0, 3.0), (2, None, None)], "i int, a double, b double")
    assert values(df.select("i", derive.mean_present(F.col("a"), F.col("b")).alias("v"))) == [1.0, 2.0, None]


def test_derived_formulas(spark):
    row = {
        "avg_daily_balance_kes": 900.0, "monthly_inflow_kes": 3000.0, "days_with_zero_balance_30d": 6,
        "balance_volatility_cv": 1.5, "betting_spend_ratio": 0.3, "savings_balance_ratio": 0.0,
        "active_lender_count": 2, "loan_stacking_velocity_90d": 0.5, "prior_loan_count": 3,
        "utility_payment_punctuality": 0.4, "rent_payment_regularity": 0.6,
        "prior_ontime_repayment_ratio": None, "inflow_regularity_score": 0.8, "salary_deposit_flag": 1,
        "net_cash_flow_ratio": -0.2, "total_credit_exposure_ratio": 0.5,
    }
    schema = ", ".join(f"{k} {'long' if isinstance(v, int) else 'double'}" for k, v in row.items())
    got = derive.add_derived(spark.createDataFrame([tuple(row.values())], schema)).first()
    assert got["buffer_days"] == round(900 / 101, 4)
    assert got["liquidity_stress_index"] == 0.3
    assert got["betting_to_savings_ratio"] == 15.0
    assert got["credit_hunger_index"] == 0.75
    assert got["obligation_discipline_index"] == 0.5
    assert got["income_stability_index"] == 1.2
    assert got["exposure_to_capacity_ratio"] == round(1500 / (0.02 * 3000 + 1), 4)


def test_rule_score_defaults(spark):
    df = spark.range(1).select(
        scale.rule_score(
            *[F.lit(v) for v in (181, 15_001)], F.lit(None).cast("double"), F.lit(None).cast("double"),
            F.lit(13), F.lit(13), F.lit(1), F.lit(3),
        ).alias("v")
    )
    assert df.first()["v"] == pytest.approx(1.10 + 0.95 + 1.10 * 0.35 - 0.75 - 0.85 + 0.60 - 0.55)
    assert not math.isnan(df.first()["v"])
