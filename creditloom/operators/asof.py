"""Behavioural features as of each application's own decision day.

The log is folded to one cell per user and day, the days that applications ask about join that
time line, and a window over whole days looks back from each. No application meets a log row in
a join, and a user has no more cells than the calendar has days, however many events or
applications they have. A feature sees what happened before the decision day, never the day itself.

Every application comes back once per row it has: without a user, a day or a history its counts are
0 and the rest is null. Log rows without a user or a time take no part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: name: (aggregate, cell column, days to look back; None: without limit)
Features = Mapping[str, tuple[str, str, int | None]]


def look_back(
    cells: DataFrame, decisions: DataFrame, features: Features, *, key: str, user: str, at: str
) -> DataFrame:
    """Features of every decision from (user, ``day``) cells; null where no cell is in reach."""
    asked = decisions.select(user, F.to_date(at).alias("day")).dropna().distinct()
    line = cells.unionByName(asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    order = Window.partitionBy(user).orderBy(F.unix_date("day"))

    def value(how: str, column: str, days: int | None) -> Column:
        start = Window.unboundedPreceding if days is None else -days
        return getattr(F, how)(column).over(order.rangeBetween(start, -1))

    seen = line.select(
        F.col(user).alias("_user"),
        F.col("day").alias("_day"),
        "_asked",
        *[value(*f).alias(name) for name, f in features.items()],
    ).where("_asked")
    mine = decisions.select(key, F.col(user).alias("_whose"), F.to_date(at).alias("_at"))
    joined = mine.join(seen, (F.col("_whose") == F.col("_user")) & (F.col("_at") == F.col("_day")), "left")
    return joined.select(key, F.col("_whose").alias(user), F.col("_at").alias("decision_day"), *features)


def activity(
    log: DataFrame,
    decisions: DataFrame,
    windows: Sequence[int],
    types: Sequence[str],
    *,
    key: str,
    user: str = "user_id",
    at: str = "ts",
    ts: str = "ts",
    kind: str = "type",
    amount: str = "amount",
) -> DataFrame:
    """Events per type and the sum of amounts in each look-back window."""
    day = F.to_date(ts).alias("day")
    cells = log.where(F.col(user).isNotNull() & F.col(ts).isNotNull()).groupBy(user, day).agg(
        *[F.count_if(F.col(kind) == t).alias(f"_n_{t}") for t in types],
        F.sum(amount).alias("_amount"),
    )
    features = {f"{t}_count_{d}d": ("sum", f"_n_{t}", d) for t in types for d in windows}
    features |= {f"amount_{d}d": ("sum", "_amount", d) for d in windows}
    found = look_back(cells, decisions, features, key=key, user=user, at=at)
    return found.fillna(0, [n for n in features if "_count_" in n])


def recency(
    log: DataFrame,
    decisions: DataFrame,
    outflow: str,
    *,
    key: str,
    user: str = "user_id",
    at: str = "ts",
    ts: str = "ts",
    kind: str = "type",
) -> DataFrame:
    """Days since the first and the last event, and since the last ``outflow``."""
    rows = log.where(F.col(user).isNotNull() & F.col(ts).isNotNull())
    cells = rows.groupBy(user, F.to_date(ts).alias("day")).agg(F.max(F.col(kind) == outflow).alias("_out"))
    spent = F.when(F.col("_out"), F.col("day"))
    cells = cells.select(user, "day", F.col("day").alias("_any"), spent.alias("_spent"))
    features = {"_first": ("min", "_any", None), "_last": ("max", "_any", None), "_paid": ("max", "_spent", None)}
    found = look_back(cells, decisions, features, key=key, user=user, at=at)
    names = {"_first": "tenure_days", "_last": "days_since_last", "_paid": "days_since_outflow"}
    return found.select(
        key, user, "decision_day", *[F.datediff("decision_day", c).alias(n) for c, n in names.items()]
    )


def loan_history(
    loans: DataFrame, decisions: DataFrame, *, key: str, user: str = "user_id", at: str = "ts"
) -> DataFrame:
    """Credit history before each decision day from the moves of a loan table.

    ``loans``: user, lender, opened, due, repaid (null while open), principal. A loan adds to the time
    line on the day it opens and takes itself off on the day it is repaid (not before it opened). Lenders
    count from the first to the last day on which any loan of theirs is open.
    """
    opened, repaid = F.to_date("opened"), F.greatest(F.to_date("repaid"), F.to_date("opened"))
    principal = F.coalesce(F.col("principal").cast("double"), F.lit(0.0))
    ontime = F.coalesce((F.to_date("repaid") <= F.to_date("due")).cast("long"), F.lit(0).cast("long"))
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def move(day: Column, new: Column, shut: Column, good: Column, owed: Column) -> Column:
        return F.struct(
            day.alias("day"), new.alias("new"), shut.alias("shut"), good.alias("good"), owed.alias("owed")
        )

    ends = F.array(
        move(opened, one, none, none, principal),
        move(F.when(F.col("repaid").isNotNull(), repaid), none, one, ontime, -principal),
    )
    known = loans.where(F.col(user).isNotNull() & F.col("opened").isNotNull())
    moves = known.select(user, "lender", F.explode(ends).alias("m")).select(user, "lender", "m.*")
    per_lender = moves.where("day IS NOT NULL").groupBy(user, "lender", "day").agg(
        *[F.sum(c).alias(c) for c in ("new", "shut", "good", "owed")]
    )
    after = F.sum(F.col("new") - F.col("shut")).over(Window.partitionBy(user, "lender").orderBy("day"))
    before = F.col("_open") - F.col("new") + F.col("shut")
    change = (F.col("_open") > 0).cast("long") - (before > 0).cast("long")
    cells = (
        per_lender.withColumn("_open", after)
        .withColumn("lenders", F.when(F.col("lender").isNotNull(), change).otherwise(none))
        .groupBy(user, "day")
        .agg(*[F.sum(c).alias(c) for c in ("new", "shut", "good", "owed", "lenders")])
        .withColumn("_opened", F.when(F.col("new") > 0, F.col("day")))
    )
    features = {
        "prior_loan_count": ("sum", "new", None),
        "_closed": ("sum", "shut", None),
        "_ontime": ("sum", "good", None),
        "_last": ("max", "_opened", None),
        "_recent": ("sum", "new", 90),
        "active_lenders": ("sum", "lenders", None),
        "exposure": ("sum", "owed", None),
    }
    found = look_back(cells, decisions, features, key=key, user=user, at=at)
    found = found.fillna(0, ["prior_loan_count", "_recent", "active_lenders", "exposure"])
    return found.select(
        key,
        user,
        "decision_day",
        "prior_loan_count",
        F.try_divide("_ontime", "_closed").alias("ontime_share"),
        F.datediff("decision_day", "_last").alias("days_since_last_loan"),
        (F.col("_recent") / 3.0).alias("stacking_velocity"),
        "active_lenders",
        "exposure",
    )
