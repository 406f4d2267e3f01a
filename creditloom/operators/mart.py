"""Behavioural features from a transaction log.

Users differ in size without limit, so nothing here sorts or collects a user's rows in one
task. Counts, sums and distinct pairs fold on the map side; whatever needs an order works on
(user, minute) or (user, day) cells, whose number per user is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.expr import epoch_micros

INFLOW = "signup"
OUTFLOW = "purchase"
FAILED = "error"


def since(ts: str, decision: Column, days: int) -> Column:
    return F.col(ts) >= decision - F.expr(f"INTERVAL {int(days)} DAYS")


def windowed_counts(
    df: DataFrame, decision: Column, windows: Sequence[int], types: Sequence[str],
    *, user: str = "user_id", ts: str = "ts", kind: str = "type",
) -> DataFrame:
    """Events per user, type and look-back window."""
    longest = max(windows)
    rows = df.where(since(ts, decision, longest) & (F.col(ts) < decision))
    return rows.groupBy(user).agg(
        *[
            F.count_if((F.col(kind) == t) & since(ts, decision, d)).alias(f"{t}_count_{d}d")
            for t in types
            for d in windows
        ]
    )


def gap_regularity(
    df: DataFrame, *, user: str = "user_id", ts: str = "ts"
) -> DataFrame:
    """1 minus the coefficient of variation of the gaps between a user's events.

    Gaps inside a (user, minute) cell and the gap from one cell to the next are added up
    separately; only cells are ever ordered per user, never the events.
    """
    at = df.select(user, epoch_micros(ts).alias("_t")).groupBy(user, "_t").agg(F.count(F.lit(1)).alias("_n"))
    at = at.withColumn("_m", F.floor(F.col("_t") / 60_000_000))
    inside = Window.partitionBy(user, "_m").orderBy("_t")
    step = (F.col("_t") - F.lag("_t").over(inside)) / 1e6
    cells = (
        at.withColumn("_g", step)
        .groupBy(user, "_m")
        .agg(
            F.min("_t").alias("first"),
            F.max("_t").alias("last"),
            F.sum("_n").alias("n"),
            F.coalesce(F.sum(F.col("_g") * F.col("_g")), F.lit(0.0)).alias("sq"),
        )
    )
    across = Window.partitionBy(user).orderBy("_m")
    jump = (F.col("first") - F.lag("last").over(across)) / 1e6
    totals = (
        cells.withColumn("_j", F.coalesce(jump, F.lit(0.0)))
        .groupBy(user)
        .agg(
            F.sum("n").alias("events"),
            ((F.max("last") - F.min("first")) / 1e6).alias("span"),
            F.sum(F.col("sq") + F.col("_j") * F.col("_j")).alias("sq"),
        )
    )
    gaps = F.col("events") - 1
    mean = F.try_divide("span", gaps)
    spread = F.sqrt(F.greatest(F.try_divide("sq", gaps) - mean * mean, F.lit(0.0)))
    return totals.select(
        user, "events", mean.alias("mean_gap"), (1.0 - F.try_divide(spread, mean)).alias("regularity")
    )


def concentration(df: DataFrame, *, user: str = "user_id", party: str = "party") -> DataFrame:
    """Herfindahl index of a user's counterparties and the share of the largest."""
    per_party = df.groupBy(user, party).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    return per_party.groupBy(user).agg(
        total.alias("events"),
        (F.sum(F.col("n") * F.col("n")) / (total * total)).alias("hhi"),
        (F.max("n") / total).alias("top_share"),
    )


def trend(
    df: DataFrame, decision: Column, days: int, *, user: str = "user_id", ts: str = "ts",
    amount: str = "amount",
) -> DataFrame:
    """Growth of a user's amounts: the last window over the one before it, and the daily slope."""
    recent = since(ts, decision, days)
    earlier = since(ts, decision, 2 * days) & ~recent
    before = F.col(ts) < decision
    day = F.datediff(F.to_date(decision), F.to_date(ts))
    sums = df.where(before & since(ts, decision, 2 * days)).groupBy(user).agg(
        F.sum(F.when(recent, F.col(amount))).alias("recent"),
        F.sum(F.when(earlier, F.col(amount))).alias("earlier"),
        F.regr_slope(F.col(amount), -day.cast("double")).alias("slope"),
    )
    growth = F.try_divide("recent", "earlier") - 1.0
    return sums.select(user, "recent", "earlier", growth.alias("growth"), "slope")


def balance_runs(
    df: DataFrame, signed: Column, *, user: str = "user_id", ts: str = "ts"
) -> DataFrame:
    """End-of-day running balance as runs of days, ``day`` to ``until``, between a user's first and last.

    Amounts fold to one row per user and day before the running sum; days without a movement
    carry the last balance forward inside a run.
    """
    moves = df.groupBy(user, F.to_date(ts).alias("day")).agg(F.sum(signed).alias("net"))
    order = Window.partitionBy(user).orderBy("day")
    closing = moves.select(
        user,
        "day",
        F.sum("net").over(order).alias("balance"),
        F.lead("day").over(order).alias("next_day"),
    )
    until = F.coalesce(F.date_sub("next_day", 1), F.col("day"))
    return closing.select(user, "day", until.alias("until"), "balance")


def daily_balances(
    df: DataFrame, signed: Column, *, user: str = "user_id", ts: str = "ts"
) -> DataFrame:
    """The balance on every calendar day: runs unfolded, for those who want the days themselves."""
    runs = balance_runs(df, signed, user=user, ts=ts)
    return runs.select(user, F.explode(F.sequence("day", "until")).alias("day"), "balance")


def balance_features(balances: DataFrame, *, user: str = "user_id", tail: int = 5) -> DataFrame:
    """Mean, minimum, variation, empty days and month-end ratio of daily balances.

    Takes runs or single days; a run weighs as many days as it has and is never unfolded.
    """
    if "until" not in balances.columns:
        balances = balances.withColumn("until", F.col("day"))
    whole = Window.partitionBy(user)
    days = F.datediff("until", "day") + 1
    late = F.datediff(F.max("until").over(whole), "day") + 1  # days from the run's start to the last
    weighted = balances.select(
        user,
        "balance",
        days.alias("_n"),
        F.greatest(F.least(days, F.lit(tail) - (late - days)), F.lit(0)).alias("_tail"),
        (F.sum(days * F.col("balance")).over(whole) / F.sum(days).over(whole)).alias("_mean"),
    )
    mean, off = F.first("_mean"), F.col("balance") - F.col("_mean")
    spread = F.sqrt(F.sum(F.col("_n") * off * off) / F.sum("_n"))
    late_mean = F.try_divide(F.sum(F.col("_tail") * F.col("balance")), F.sum("_tail"))
    return weighted.groupBy(user).agg(
        F.sum("_n").alias("days"),
        mean.alias("avg_balance"),
        F.min("balance").alias("min_balance"),
        F.try_divide(spread, F.abs(mean)).alias("balance_cv"),
        F.sum(F.when(F.col("balance") <= 0, F.col("_n")).otherwise(0)).alias("zero_days"),
        F.try_divide(late_mean, mean).alias("month_end_ratio"),
    )


def flow_ratios(
    df: DataFrame, ratios: Mapping[str, tuple[Column, Column]], *, user: str = "user_id",
    amount: str = "amount",
) -> DataFrame:
    """Ratios of conditional sums, e.g. net flow over inflow."""
    return df.groupBy(user).agg(
        *[
            F.try_divide(
                F.sum(F.when(top, F.col(amount)).otherwise(0.0)),
                F.sum(F.when(bottom, F.col(amount)).otherwise(0.0)),
            ).alias(name)
            for name, (top, bottom) in ratios.items()
        ]
    )


def net_flow(df: DataFrame, *, user: str = "user_id", kind: str = "type", amount: str = "amount") -> DataFrame:
    inflow = F.sum(F.when(F.col(kind) == INFLOW, F.col(amount)).otherwise(0.0))
    outflow = F.sum(F.when(F.col(kind) == OUTFLOW, F.col(amount)).otherwise(0.0))
    return df.groupBy(user).agg(
        inflow.alias("inflow"),
        outflow.alias("outflow"),
        F.try_divide(inflow - outflow, inflow).alias("net_flow_ratio"),
    )


def time_shares(
    df: DataFrame, *, user: str = "user_id", ts: str = "ts", kind: str = "type"
) -> DataFrame:
    """Shares of events at night (22 to 4), at the weekend, and failed."""
    hour = F.hour(ts)
    share = lambda c: F.avg(c.cast("double"))
    return df.groupBy(user).agg(
        share((hour >= 22) | (hour < 4)).alias("night_share"),
        share(F.dayofweek(ts).isin(1, 7)).alias("weekend_share"),
        share(F.col(kind) == FAILED).alias("failed_share"),
    )


def hour_entropy(df: DataFrame, *, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Shannon entropy of the hour of day, from at most 24 counts per user."""
    hours = df.groupBy(user, F.hour(ts).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    return hours.groupBy(user).agg(
        F.greatest(F.ln(total) - F.sum(F.col("n") * F.ln("n")) / total, F.lit(0.0)).alias("entropy")
    )


def new_counterparties(
    df: DataFrame, decision: Column, days: int, *, user: str = "user_id", ts: str = "ts",
    party: str = "party",
) -> DataFrame:
    """Counterparties seen in the window, and the share never seen before it."""
    seen = df.where(F.col(ts) < decision).groupBy(user, party).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last")
    )
    active = since("last", decision, days)
    fresh = active & since("first", decision, days)
    return seen.groupBy(user).agg(
        F.count_if(active).alias("active_parties"),
        F.try_divide(F.count_if(fresh), F.count_if(active)).alias("new_share"),
    )


def set_stability(
    df: DataFrame, decision: Column, days: int, *, top: int = 10, user: str = "user_id",
    ts: str = "ts", party: str = "party",
) -> DataFrame:
    """Overlap of a user's most frequent counterparties in two adjacent windows.

    The rank filter is applied before the shuffle as well, so a task never ships more than
    ``top`` rows per user and window.
    """
    recent = since(ts, decision, days)
    rows = df.where(since(ts, decision, 2 * days) & (F.col(ts) < decision))
    counts = rows.groupBy(user, recent.alias("recent"), party).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy(user, "recent").orderBy(F.desc("n"), party))
    best = counts.withColumn("_place", place).where(F.col("_place") <= top)
    sets = best.groupBy(user).agg(
        F.collect_list(F.when(F.col("recent"), F.col(party))).alias("a"),
        F.collect_list(F.when(~F.col("recent"), F.col(party))).alias("b"),
    )
    both = F.size(F.array_intersect("a", "b"))
    return sets.select(
        user, both.alias("kept"), F.try_divide(both, F.size("b")).alias("stability")
    )


def size_features(
    df: DataFrame, *, user: str = "user_id", kind: str = "type", amount: str = "amount"
) -> DataFrame:
    """Largest outflow over total inflow, and the mean outflow."""
    out = F.when(F.col(kind) == OUTFLOW, F.col(amount))
    inflow = F.sum(F.when(F.col(kind) == INFLOW, F.col(amount)).otherwise(0.0))
    return df.groupBy(user).agg(
        F.max(out).alias("max_outflow"),
        F.avg(out).alias("mean_outflow"),
        F.try_divide(F.max(out), inflow).alias("max_outflow_ratio"),
    )


def recency(
    df: DataFrame, decision: Column, *, user: str = "user_id", ts: str = "ts", kind: str = "type"
) -> DataFrame:
    """Days since the first and the last event, and since the last outflow."""
    rows = df.where(F.col(ts) < decision)
    day = F.to_date(decision)
    return rows.groupBy(user).agg(
        F.datediff(day, F.to_date(F.min(ts))).alias("tenure_days"),
        F.datediff(day, F.to_date(F.max(ts))).alias("days_since_last"),
        F.datediff(day, F.to_date(F.max(F.when(F.col(kind) == OUTFLOW, F.col(ts))))).alias(
            "days_since_outflow"
        ),
    )


def recurring_flags(
    df: DataFrame, *, times: int = 3, user: str = "user_id", kind: str = "type", party: str = "party"
) -> DataFrame:
    """Does any single counterparty recur among a user's inflows, or outflows?"""
    pairs = df.groupBy(user, kind, party).agg(F.count(F.lit(1)).alias("n"))
    again = F.col("n") >= times

    def flag(t: str) -> Column:
        return F.bool_or((F.col(kind) == t) & again).cast("int")

    return pairs.groupBy(user).agg(
        flag(INFLOW).alias("recurring_inflow"), flag(OUTFLOW).alias("recurring_outflow")
    )


def loan_history(
    loans: DataFrame, decision: Column, *, user: str = "user_id", days: int = 180
) -> DataFrame:
    """Credit-history features from a loan table.

    ``loans``: user, lender, opened, due, repaid (null while open), principal, outstanding,
    credit_limit, days_past_due.
    """
    before = loans.where(F.col("opened") < decision)
    open_ = F.col("repaid").isNull() | (F.col("repaid") >= decision)
    closed = ~open_
    return before.groupBy(user).agg(
        F.count(F.lit(1)).alias("prior_loan_count"),
        F.avg(F.when(closed, (F.col("repaid") <= F.col("due")).cast("double"))).alias("ontime_share"),
        F.datediff(F.to_date(decision), F.to_date(F.max("opened"))).alias("days_since_last_loan"),
        F.max(F.when(since("opened", decision, days), F.col("days_past_due"))).alias("max_dpd"),
        (F.count_if(since("opened", decision, 90)) / 3.0).alias("stacking_velocity"),
        F.countDistinct(F.when(open_, F.col("lender"))).alias("active_lenders"),
        F.sum(F.when(open_, F.col("outstanding")).otherwise(0.0)).alias("exposure"),
        F.try_divide(
            F.sum(F.when(open_, F.col("outstanding"))), F.sum(F.when(open_, F.col("credit_limit")))
        ).alias("utilisation"),
    )
