"""Scale, policy and monitoring settings."""

from __future__ import annotations

import math
from typing import NamedTuple

# ---- fixed values: they must stay as they are for results to agree ----
SEED = 42
THIN_FILE_DAYS = 90
APPROVAL_RATE = 0.62
OOT_START_MONTH = 14
VALIDATION_FRACTION = 0.20
MIN_IV = 0.02
MAX_ABS_CORRELATION = 0.75
PSI_GREEN = 0.10
PSI_AMBER = 0.25
DISPARATE_IMPACT_FLOOR = 0.80
EQUAL_OPPORTUNITY_TOLERANCE = 0.05
BANDS = (
    ("A", 740, 850),
    ("B", 680, 739),
    ("C", 620, 679),
    ("D", 560, 619),
    ("E", 300, 559),
)
SCORE_AT_BASE_ODDS, BASE_ODDS, POINTS_TO_DOUBLE_ODDS = 600, 30.0, 40
SCORE_RANGE = (300, 850)
# one loan, in KES: amount, then shares of it, then a fixed cost
LOAN_AMOUNT, FEE_SHARE, ROLLOVER_SHARE, LOST_SHARE, FUNDING_SHARE, SERVICING_COST = 3000.0, 0.075, 0.30, 0.82, 0.012, 12.0
# ---- end of fixed values ----


class Scale(NamedTuple):
    """Score = offset - factor * log odds of default, kept within low and high."""

    offset: float
    factor: float
    low: int
    high: int


def scale_through(points: float, odds: float, double: float, low: int, high: int) -> Scale:
    """The line that gives ``points`` at ``odds`` and ``double`` more at twice the odds."""
    factor = double / math.log(2.0)
    return Scale(points - factor * math.log(odds), factor, low, high)


class Economics(NamedTuple):
    """What a repaid loan brings and a lost one costs."""

    revenue_per_good: float
    loss_per_bad: float


SCALE = scale_through(SCORE_AT_BASE_ODDS, BASE_ODDS, POINTS_TO_DOUBLE_ODDS, *SCORE_RANGE)
ECONOMICS = Economics(
    LOAN_AMOUNT * FEE_SHARE * (1.0 + ROLLOVER_SHARE) - LOAN_AMOUNT * FUNDING_SHARE - SERVICING_COST,
    LOAN_AMOUNT * LOST_SHARE + SERVICING_COST,
)
