"""Sliding-window features as of each application's own decision day, without joining log and applications.

As in ``asof``, the window of ``days`` days ends the day before the decision, and logs fold to cells per user and day
(or user, counterparty and day) first, so a user has no more cells than the calendar has days, however many events.
Three devices then answer any number of applications:

- sums: a running total per user, read where a window ends and where it begins (``window_sums``). Whatever enters a
  window leaves it ``days`` later, so distinct counterparties and squared shares are sums of changes as well;
- the best counterparties of a day: each one's count is a step function of the day; its steps are cut into
  stretches of 2**k days, each stretch keeps its best few, and a day reads the stretches it lies in (``best_on``);
- extremes: minima or maxima of 2**k consecutive cells, two of which cover any window (``extremes``).

Every application comes back once per row it has. Without a user, a day or a history, counts are 0 and the rest is null.
Log rows without a user or a time, and for counterparties without a counterparty, take no part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NIGHT_FROM, NIGHT_TO = 22, 4


def _asked(decisions: DataFrame, user: str, at: str) -> DataFrame:
    return decisions.select(F.col(user).alias("user"), F.to_date(at).alias("day")).dropna().distinct()


def _answer(decisions: DataFrame, found: DataFrame, key: str, user: str, at: str) -> DataFrame:
    """Every decision with the columns of (user, day, ...)."""
    mine = decisions.select(key, F.col(user).alias("_whose"), F.to_date(at).alias("_at"))
    values = [c for c in found.columns if c not in ("user", "day")]
    joined = mine.join(found, (F.col("_whose") == F.col("user")) & (F.col("_at") == F.col("day")), "left")
    return joined.select(key, F.col("_whose").alias(user), F.col("_at").alias("decision_day"), *values)


def _known(log: DataFrame, user: str, ts: str) -> DataFrame:
    return log.where(F.col(user).isNotNull() & F.col(ts).isNotNull())


# ------------------------------------------------------------------------------- sums


def window_sums(cells: DataFrame, asked: DataFrame, columns: Sequence[str], windows: Sequence[int | None]) -> DataFrame:
    """(user, day, {column}_{days}): sums of the cells of the ``days`` days before each asked day; None: of all before.

    ``cells``: user, day and the columns; ``asked``: user, day. A running total per user is read at both ends of
    every window; where nothing lies before, it is 0.
    """
    offsets = sorted({0, *(w for w in windows if w is not None)})
    ends = F.array(*[F.struct(F.lit(o).alias("_off"), F.date_sub("day", o).alias("_from")) for o in offsets])
    marks = asked.select("user", F.col("day").alias("_at"), F.inline(ends)).withColumnRenamed("_from", "day")
    line = cells.select("user", "day", *columns).unionByName(marks, allowMissingColumns=True)
    before = Window.partitionBy("user").orderBy(F.unix_date("day")).rangeBetween(Window.unboundedPreceding, -1)
    seen = line.select("user", "_at", "_off", *[F.sum(c).over(before).alias(c) for c in columns]).where("_at IS NOT NULL")

    def read(c: str, offset: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("_off") == offset, F.col(c))), F.lit(0))

    out = [
        (read(c, 0) if w is None else read(c, 0) - read(c, w)).alias(f"{c}_{w}") for c in columns for w in windows
    ]
    return seen.groupBy("user", F.col("_at").alias("day")).agg(*out)


def shape(
    log: DataFrame, decisions: DataFrame, windows: Sequence[int], failed: str, *, key: str, user: str = "user_id",
    at: str = "at", ts: str = "ts", kind: str = "type",
) -> DataFrame:
    """Shares at night, at the weekend and failed, and the entropy of the hour, in each window.

    24 counts per (user, day) are all that is kept of the hours.
    """
    hour, hours = F.hour(ts), [f"h{h}" for h in range(24)]
    cells = _known(log, user, ts).groupBy(F.col(user).alias("user"), F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.dayofweek(ts).isin(1, 7)).alias("weekend"),
        F.count_if(F.col(kind) == failed).alias("failed"), *[F.count_if(hour == h).alias(f"h{h}") for h in range(24)],
    )
    sums = window_sums(cells, _asked(decisions, user, at), ["n", "weekend", "failed", *hours], windows)
    night = [f"h{h}" for h in range(24) if h >= NIGHT_FROM or h < NIGHT_TO]
    out = []
    for w in windows:
        total = F.col(f"n_{w}")
        logs = sum((F.when(F.col(f"{h}_{w}") > 0, F.col(f"{h}_{w}") * F.ln(f"{h}_{w}")).otherwise(0.0) for h in hours), F.lit(0.0))
        entropy = F.greatest(F.ln(total) - logs / total, F.lit(0.0))
        out += [
            total.alias(f"events_{w}d"),
            F.try_divide(sum((F.col(f"{h}_{w}") for h in night), F.lit(0)), total).alias(f"night_share_{w}d"),
            F.try_divide(f"weekend_{w}", total).alias(f"weekend_share_{w}d"),
            F.try_divide(f"failed_{w}", total).alias(f"failed_share_{w}d"),
            F.when(total > 0, entropy).alias(f"hour_entropy_{w}d"),
        ]
    found = _answer(decisions, sums.select("user", "day", *out), key, user, at)
    return found.fillna(0, [f"events_{w}d" for w in windows])


def flows(
    log: DataFrame, decisions: DataFrame, days: int, sums: Mapping[str, Column], ratios: Mapping[str, tuple[str, str]],
    growth: Sequence[str] = (), *, key: str, user: str = "user_id", at: str = "at", ts: str = "ts",
) -> DataFrame:
    """Named sums of the window, ratios between them, and their growth on the window before it."""
    known = _known(log, user, ts)
    cells = known.groupBy(F.col(user).alias("user"), F.to_date(ts).alias("day")).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    got = window_sums(cells, _asked(decisions, user, at), list(sums), [days, 2 * days])
    past = {n: F.col(f"{n}_{2 * days}") - F.col(f"{n}_{days}") for n in growth}
    found = got.select(
        "user", "day", *[F.col(f"{n}_{days}").alias(n) for n in sums],
        *[F.try_divide(f"{a}_{days}", f"{b}_{days}").alias(n) for n, (a, b) in ratios.items()],
        *[(F.try_divide(F.col(f"{n}_{days}"), before) - 1.0).alias(f"{n}_growth") for n, before in past.items()],
    )
    return _answer(decisions, found, key, user, at).fillna(0, list(sums))


# --------------------------------------------------------------------- counterparties


def party_counts(log: DataFrame, days: int, *, user: str = "user_id", ts: str = "ts", party: str = "party") -> DataFrame:
    """user, party, day, n, was: a counterparty's events in the window from the day after ``day`` on, and until then.

    A cell adds its events on its day and takes them off ``days`` later.
    """
    cells = _known(log, user, ts).where(F.col(party).isNotNull()).groupBy(
        F.col(user).alias("user"), F.col(party).alias("party"), F.to_date(ts).alias("day")
    ).agg(F.count(F.lit(1)).alias("n"))
    moves = F.array(
        F.struct("day", F.col("n").alias("d")), F.struct(F.date_add("day", days).alias("day"), (-F.col("n")).alias("d"))
    )
    changes = cells.select("user", "party", F.inline(moves)).groupBy("user", "party", "day").agg(F.sum("d").alias("d"))
    now = F.sum("d").over(Window.partitionBy("user", "party").orderBy("day"))
    return changes.withColumn("n", now).select("user", "party", "day", "n", (F.col("n") - F.col("d")).alias("was"))


def _stretches(levels: int) -> Column:
    """The days from ``lo`` up to ``end``, fewer than 2**levels, as the at most two aligned stretches of each length 2**k."""
    return F.expr(f"""filter(flatten(transform(sequence(0, {levels - 1}), k -> transform(
        array(named_struct('l', shiftright(lo + shiftleft(1, k) - 1, k), 'r', shiftright(end, k))), x -> array(
            if(x.l < x.r and (x.l & 1) = 1, named_struct('k', k, 'b', x.l), null),
            if(x.l < x.r and (x.r & 1) = 1, named_struct('k', k, 'b', x.r - 1), null)))[0])), x -> x is not null)""")


def _lies_in(levels: int, day: Column) -> Column:
    """The stretch of each length that holds a day."""
    return F.array(*[F.struct(F.lit(k).alias("k"), F.shiftright(day, k).alias("b")) for k in range(levels)])


def _meet(asks: DataFrame, stored: DataFrame) -> DataFrame:
    """Asked days with the stretches they lie in, by a merge.

    The planner takes the unfolded days for as small as the days before ``inline``, and would send all of them through the driver.
    """
    return asks.join(stored.hint("merge"), ["user", "k", "b"])


def best_on(counts: DataFrame, asked: DataFrame, keep: int, days: int) -> DataFrame:
    """user, day, party, n, place: the ``keep`` largest counts on each asked day, ties by counterparty.

    A count holds from the day after its change to the day of the next one, ``days`` days at most. It is stored with
    the at most two stretches of each length 2**k that make up those days; an asked day lies in one stretch of each length.
    """
    steps = Window.partitionBy("user", "party").orderBy("day")
    held = counts.withColumn("_until", F.lead("day").over(steps)).where("n > 0").select(
        "user", "party", "n", (F.unix_date("day") + 1).alias("lo"), (F.unix_date("_until") + 1).alias("end")
    )
    first = Window.partitionBy("user", "k", "b").orderBy(F.desc("n"), "party")
    stored = held.select("user", "party", "n", F.inline(_stretches(max(days, 1).bit_length()))).withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= keep)
    asks = asked.select("user", "day", F.inline(_lies_in(max(days, 1).bit_length(), F.unix_date("day"))))
    best = Window.partitionBy("user", "day").orderBy(F.desc("n"), "party")
    hits = _meet(asks, stored.select("user", "k", "b", "party", "n"))
    return hits.select("user", "day", "party", "n", F.row_number().over(best).alias("place")).where(F.col("place") <= keep)


def parties(
    log: DataFrame, decisions: DataFrame, days: int, *, top: int = 10, key: str, user: str = "user_id", at: str = "at",
    ts: str = "ts", party: str = "party",
) -> DataFrame:
    """Counterparties in the window, the share never seen before it, how many of the ``top`` of the window before are
    among the ``top`` now, squared shares, and the share and events of the largest."""
    asked = _asked(decisions, user, at)
    counts = party_counts(log, days, user=user, ts=ts, party=party)
    changes = counts.groupBy("user", "day").agg(
        F.sum((F.col("n") > 0).cast("long") - (F.col("was") > 0).cast("long")).alias("active"),
        F.sum(F.col("n") - F.col("was")).alias("events"),
        F.sum(F.col("n") * F.col("n") - F.col("was") * F.col("was")).alias("squares"),
    )
    first = counts.groupBy("user", "party").agg(F.min("day").alias("day"))
    fresh = first.select("user", F.inline(F.array(
        F.struct("day", F.lit(1).cast("long").alias("fresh")), F.struct(F.date_add("day", days).alias("day"), F.lit(-1).cast("long").alias("fresh"))
    )))
    cells = changes.unionByName(fresh, allowMissingColumns=True)
    sums = window_sums(cells, asked, ["active", "fresh", "events", "squares"], [None])
    both = asked.unionByName(asked.select("user", F.date_sub("day", days).alias("day"))).distinct()
    best = best_on(counts, both, top, days).groupBy("user", "day").agg(
        F.collect_list("party").alias("best"), F.max("n").alias("most")
    )
    now = best.select("user", "day", F.col("best").alias("now"), "most")
    past = best.select("user", F.date_add("day", days).alias("day"), F.col("best").alias("past"))
    got = sums.join(now, ["user", "day"], "left").join(past, ["user", "day"], "left")
    kept = F.size(F.array_intersect("now", "past"))
    found = got.select(
        "user", "day", F.col("active_None").alias("active_parties"),
        F.try_divide("fresh_None", "active_None").alias("new_share"),
        F.when(F.col("now").isNull() | F.col("past").isNull(), 0).otherwise(kept).alias("kept_parties"),
        F.when(F.col("past").isNotNull(), F.when(F.col("now").isNull(), 0).otherwise(kept) / F.size("past")).alias("stability"),
        F.try_divide("squares_None", F.col("events_None") * F.col("events_None")).alias("hhi"),
        F.try_divide("most", "events_None").alias("top_share"), F.col("most").alias("top_count"),
    )
    return _answer(decisions, found, key, user, at).fillna(0, ["active_parties", "kept_parties", "top_count"])


# --------------------------------------------------------------------------- extremes


def extremes(cells: DataFrame, spans: DataFrame, how: str, longest: int) -> DataFrame:
    """(user, day, value): the least or greatest cell from the ``first`` to the ``last``, by number, of every span.

    ``cells``: user, i (0, 1, ... per user), v. ``spans``: user, day, first, last, ``longest`` cells at most. A cell
    stores the extreme of the 2**k cells from it on for each k, each from the two halves before it; a span is
    covered by two such stretches.
    """
    pick = {"min": F.least, "max": F.greatest}[how]
    order = Window.partitionBy("user").orderBy("i")
    levels = max(longest, 1).bit_length()
    table = cells.withColumn("m0", F.col("v"))
    for k in range(1, levels):
        table = table.withColumn(f"m{k}", pick(F.col(f"m{k - 1}"), F.lead(f"m{k - 1}", 1 << (k - 1)).over(order)))
    table = table.select("user", "i", F.array(*[f"m{k}" for k in range(levels)]).alias("_of"))
    size = F.col("last") - F.col("first") + 1
    # the largest power of two within the span, from the length of its binary digits
    asked = spans.where("last >= first").withColumn("_k", F.length(F.bin(size)) - 1)
    asked = asked.select("user", "day", "_k", F.explode(F.array(F.col("first"), F.col("last") + 1 - F.expr("shiftleft(1, _k)"))).alias("i"))
    found = asked.join(table, ["user", "i"]).select("user", "day", F.get("_of", F.col("_k")).alias("v"))
    return found.groupBy("user", "day").agg((F.min if how == "min" else F.max)("v").alias("value"))


def balances(
    log: DataFrame, decisions: DataFrame, signed: Column, days: int, *, tail: int = 5, key: str, user: str = "user_id",
    at: str = "at", ts: str = "ts",
) -> DataFrame:
    """Days with a known balance, their mean, minimum, variation and empty days, and the mean of the last ``tail`` days
    against it, over the end-of-day balances of the window.

    A balance holds until the next movement, up to the decision; runs of days are weighed, never unfolded.
    """
    moves = _known(log, user, ts).groupBy(F.col(user).alias("user"), F.to_date(ts).alias("day")).agg(F.sum(signed).alias("net"))
    order = Window.partitionBy("user").orderBy("day")
    held = F.datediff(F.lead("day").over(order), "day")
    runs = moves.select("user", "day", F.sum("net").over(order).alias("b"), held.alias("n"), (F.row_number().over(order) - 1).alias("i"))
    wealth = {"known": F.lit(1), "sum": F.col("b"), "squares": F.col("b") * F.col("b"), "empty": (F.col("b") <= 0).cast("int")}
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "user", "day", "b", "i", *[c.alias(f"_{n}") for n, c in wealth.items()],
        *[F.coalesce(F.sum(F.col("n") * c).over(past), F.lit(0)).alias(n) for n, c in wealth.items()],
    )
    offsets = sorted({0, tail, days})
    asked = _asked(decisions, user, at)
    ends = F.array(*[F.struct(F.lit(o).alias("_off"), F.date_sub("day", o).alias("_from")) for o in offsets])
    marks = asked.select("user", F.col("day").alias("_at"), F.inline(ends)).withColumnRenamed("_from", "day")
    before = Window.partitionBy("user").orderBy(F.unix_date("day")).rangeBetween(Window.unboundedPreceding, -1)
    parts = F.struct("day", "i", *wealth, *[f"_{n}" for n in wealth])
    line = runs.select("user", "day", parts.alias("run")).unionByName(marks, allowMissingColumns=True)
    seen = line.select("user", "day", "_at", "_off", F.last("run", ignorenulls=True).over(before).alias("run")).where("_at IS NOT NULL")
    reach = F.datediff("day", "run.day")  # days of the run that lie before the mark
    totals = seen.select("user", "_at", "_off", F.col("run.i").alias("i"), *[
        F.coalesce(F.col(f"run.{n}") + reach * F.col(f"run._{n}"), F.lit(0)).alias(n) for n in wealth
    ])

    def read(c: str, offset: int) -> Column:
        return F.max(F.when(F.col("_off") == offset, F.col(c)))

    got = totals.groupBy("user", F.col("_at").alias("day")).agg(
        *[(read(n, 0) - read(n, days)).alias(n) for n in wealth],
        (read("sum", 0) - read("sum", tail)).alias("late"), (read("known", 0) - read("known", tail)).alias("late_known"),
        F.coalesce(read("i", days), F.lit(0)).alias("i_before"), read("i", 0).alias("last"),
    )
    # the run that holds on the window's first day: the one before the window, unless another starts on that very day
    starts = asked.select("user", F.date_sub("day", days).alias("day")).distinct().join(runs.select("user", "day", "i"), ["user", "day"])
    starts = starts.select("user", F.date_add("day", days).alias("day"), F.col("i").alias("i_there"))
    spans = got.join(starts, ["user", "day"], "left").select("user", "day", F.coalesce("i_there", "i_before").alias("first"), "last")
    least = extremes(runs.select("user", "i", F.col("b").alias("v")), spans, "min", days)
    mean = F.try_divide("sum", "known")
    spread = F.sqrt(F.greatest(F.try_divide("squares", "known") - mean * mean, F.lit(0.0)))
    found = got.join(least, ["user", "day"], "left").select(
        "user", "day", F.col("known").alias("days_known"), mean.alias("avg_balance"), F.col("value").alias("min_balance"),
        F.try_divide(spread, F.abs(mean)).alias("balance_cv"), F.col("empty").alias("zero_days"),
        F.try_divide(F.try_divide("late", "late_known"), mean).alias("month_end_ratio"),
    )
    return _answer(decisions, found, key, user, at).fillna(0, ["days_known", "zero_days"])


def largest(
    log: DataFrame, decisions: DataFrame, days: int, outflow: Column, inflow: Column, *, key: str, user: str = "user_id",
    at: str = "at", ts: str = "ts",
) -> DataFrame:
    """Largest and mean outflow of the window and the largest against the window's inflow.

    ``outflow`` and ``inflow``: an amount, or null for rows that are none.
    """
    cells = _known(log, user, ts).groupBy(F.col(user).alias("user"), F.to_date(ts).alias("day")).agg(
        F.max(outflow).alias("v"), F.sum(outflow).alias("out"), F.count(outflow).alias("n"), F.sum(inflow).alias("inflow")
    )
    order = Window.partitionBy("user").orderBy("day")
    spent = cells.where("v IS NOT NULL").select("user", "day", "v", (F.row_number().over(order) - 1).alias("i"))
    asked = _asked(decisions, user, at)
    sums = window_sums(cells, asked, ["out", "n", "inflow"], [days])
    most = extremes(spent.select("user", "i", "v"), _numbers(spent, asked, days), "max", days)
    found = sums.join(most, ["user", "day"], "left").select(
        "user", "day", F.col("value").alias("max_outflow"), F.try_divide(f"out_{days}", f"n_{days}").alias("mean_outflow"),
        F.try_divide("value", f"inflow_{days}").alias("max_outflow_ratio"),
    )
    return _answer(decisions, found, key, user, at)


def box(
    log: DataFrame, decisions: DataFrame, columns: Sequence[str], days: int, *, key: str, user: str = "user_id",
    at: str = "at", ts: str = "ts",
) -> DataFrame:
    """{column}_min and {column}_max over the rows of the window that have a value."""
    asked = _asked(decisions, user, at)
    found = asked
    for c in columns:
        cells = _known(log, user, ts).where(F.col(c).isNotNull()).groupBy(F.col(user).alias("user"), F.to_date(ts).alias("day")).agg(
            F.min(c).alias("min"), F.max(c).alias("max")
        )
        cells = cells.withColumn("i", F.row_number().over(Window.partitionBy("user").orderBy("day")) - 1)
        spans = _numbers(cells, asked, days)
        for how in ("min", "max"):
            best = extremes(cells.select("user", "i", F.col(how).alias("v")), spans, how, days)
            found = found.join(best.withColumnRenamed("value", f"{c}_{how}"), ["user", "day"], "left")
    return _answer(decisions, found, key, user, at)


def _numbers(cells: DataFrame, asked: DataFrame, days: int) -> DataFrame:
    """First and last number of the cells (user, day) in the window of each asked day."""
    passed = window_sums(cells.withColumn("cells", F.lit(1)), asked, ["cells"], [None, days])
    return passed.select("user", "day", (F.col("cells_None") - F.col(f"cells_{days}")).alias("first"), (F.col("cells_None") - 1).alias("last"))


# -------------------------------------------------------------------------------- gaps


def regularity(
    log: DataFrame, decisions: DataFrame, days: int, *, key: str, user: str = "user_id", at: str = "at", ts: str = "ts"
) -> DataFrame:
    """Events of the window and 1 minus the coefficient of variation of the gaps between them; null under three events.

    Gaps inside a day and the gap to the day before it are sums per cell; of the window's first cell the latter lies outside
    and is taken off again.
    """
    seconds = F.unix_timestamp(F.col(ts).cast("timestamp"))
    times = _known(log, user, ts).groupBy(F.col(user).alias("user"), F.to_date(ts).alias("day"), seconds.alias("t")).agg(F.count(F.lit(1)).alias("n"))
    inside = F.col("t") - F.lag("t").over(Window.partitionBy("user", "day").orderBy("t"))
    cells = times.withColumn("g", inside).groupBy("user", "day").agg(
        F.sum("n").alias("n"), F.min("t").alias("from"), F.max("t").alias("until"), F.coalesce(F.sum(F.col("g") * F.col("g")), F.lit(0)).alias("sq")
    )
    order = Window.partitionBy("user").orderBy("day")
    jump = F.coalesce(F.col("from") - F.lag("until").over(order), F.lit(0))
    cells = cells.withColumn("jump", jump * jump).withColumn("i", F.row_number().over(order) - 1)
    asked = _asked(decisions, user, at)
    sums = window_sums(cells.withColumn("sq", F.col("sq") + F.col("jump")), asked, ["n", "sq"], [days])
    spans = _numbers(cells, asked, days).where("last >= first")
    first = cells.select("user", F.col("i").alias("first"), "from", F.col("jump").alias("outside"))
    last = cells.select("user", F.col("i").alias("last"), "until")
    got = sums.join(spans.join(first, ["user", "first"]).join(last, ["user", "last"]), ["user", "day"])
    gaps = F.col(f"n_{days}") - 1
    mean = F.try_divide(F.col("until") - F.col("from"), gaps)
    spread = F.sqrt(F.greatest(F.try_divide(F.col(f"sq_{days}") - F.col("outside"), gaps) - mean * mean, F.lit(0.0)))
    value = F.when(gaps >= 2, 1.0 - F.try_divide(spread, mean))
    found = got.select("user", "day", F.col(f"n_{days}").alias("events"), value.alias("regularity"))
    return _answer(decisions, found, key, user, at).fillna(0, ["events"])


# ------------------------------------------------------------------------------- loans


def past_due(loans: DataFrame, decisions: DataFrame, days: int = 180, *, key: str, user: str = "user_id", at: str = "at") -> DataFrame:
    """Worst days past due seen in the window, and what is drawn of the limits of open loans, the day before the decision.

    ``loans``: user, opened, due, repaid (null while open), and for utilisation drawn and limit. A loan is a line that
    rises by one a day from its due day until it is repaid; its largest value inside a window is at the right end
    of what the window cuts from it. Lines that end inside the window are cells of the day they end (a maximum
    over cells); of those that still rise the one due first is the worst.
    """
    due, opened = F.to_date("due"), F.to_date("opened")
    repaid = F.when(F.col("repaid").isNotNull(), F.greatest(F.to_date("repaid"), opened))
    known = loans.where(F.col(user).isNotNull() & F.col("opened").isNotNull())
    asked = _asked(decisions, user, at)
    # ended: the last day on which the loan was unpaid, and how late it was then
    late = F.datediff(repaid, due) - 1
    ended = known.where(repaid.isNotNull()).select(F.col(user).alias("user"), F.date_sub(repaid, 1).alias("day"), late.alias("late"))
    cells = ended.where("late > 0").groupBy("user", "day").agg(F.max("late").alias("v"))
    order = Window.partitionBy("user").orderBy("day")
    cells = cells.withColumn("i", F.row_number().over(order) - 1)
    worst = extremes(cells.select("user", "i", "v"), _numbers(cells, asked, days), "max", days)
    # rising: unpaid on the day before the decision; the earliest due day among intervals [opened, repaid) that hold it
    rising = _earliest_due(known.select(F.col(user).alias("user"), opened.alias("opened"), due.alias("due"), repaid.alias("repaid")), asked)
    moves = F.array(
        F.struct(opened.alias("day"), F.lit(1).alias("s")), F.struct(repaid.alias("day"), F.lit(-1).alias("s"))
    )
    lines = known.select(F.col(user).alias("user"), "drawn", "limit", F.inline(moves)).where("day IS NOT NULL")
    drawn = lines.groupBy("user", "day").agg(F.sum(F.col("s") * F.col("drawn")).alias("drawn"), F.sum(F.col("s") * F.col("limit")).alias("limit"))
    used = window_sums(drawn, asked, ["drawn", "limit"], [None])
    found = used.join(worst, ["user", "day"], "left").join(rising, ["user", "day"], "left").select(
        "user", "day",
        F.greatest(F.coalesce("value", F.lit(0)), F.coalesce(F.datediff(F.date_sub("day", 1), "due"), F.lit(0))).alias("max_dpd"),
        F.when(F.col("limit_None") > 0, F.col("drawn_None") / F.col("limit_None")).alias("utilisation"),
    )
    return _answer(decisions, found, key, user, at).fillna(0, ["max_dpd"])


def _earliest_due(loans: DataFrame, asked: DataFrame, levels: int = 17) -> DataFrame:
    """(user, day, due): the first due day among the loans that were unpaid on the day before each asked day.

    The unpaid days of a loan are cut into stretches of 2**k days (open loans: up to the last asked day), each stretch
    keeps the earliest due day, and a day reads the stretches it lies in.
    """
    last = asked.groupBy("user").agg(F.max("day").alias("_end"))
    held = loans.join(last, "user").select(
        "user", "due", F.unix_date("opened").alias("lo"), F.unix_date(F.least(F.coalesce("repaid", "_end"), "_end")).alias("end")
    ).where("lo < end")
    stored = held.select("user", "due", F.inline(_stretches(levels))).groupBy("user", "k", "b").agg(F.min("due").alias("due"))
    hits = _meet(asked.select("user", "day", F.inline(_lies_in(levels, F.unix_date("day") - 1))), stored)
    return hits.groupBy("user", "day").agg(F.min("due").alias("due"))
