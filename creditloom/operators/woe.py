"""Weight-of-evidence binning: fit over all features at once, apply in one projection.

Counting runs on the rows; what is left afterwards is at most (features x bins) counts. Merging folds
them, one row of short arrays per feature, in JVM expressions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.config import MIN_IV
from creditloom.functions.expr import in_chunks, iv_strength, present, sql_number, union_all, with_bins
from creditloom.functions.ordering import quantiles
from creditloom.operators.quality import QualityError

# ---- fixed values ----
MISSING = "Missing"
OTHER = "__other__"
SMOOTHING = 0.5
SMALLEST_BIN = 25
# ---- end of fixed values ----

BIN_SCHEMA = (
    "feature string, kind string, bin_index int, label string, lower double, upper double, "
    "is_missing boolean, count long, bads long, event_rate double, woe double, iv double"
)
FEATURE_SCHEMA = (
    "feature string, kind string, edges array<double>, iv double, monotonic boolean, direction int"
)


def prebin_probs(max_prebins: int = 40) -> list[float]:
    return np.linspace(0.0, 1.0, max_prebins + 1)[1:-1].tolist()


def _fold(counts: DataFrame, *by: str) -> DataFrame:
    return counts.groupBy(*by).agg(F.sum("count").alias("count"), F.sum("bads").alias("bads"))


def few_levels(df: DataFrame, columns: Sequence[str], at_most: int) -> dict[str, list[float]]:
    """Sorted distinct values of every column that has at most ``at_most`` of them.

    A sketch screens out wide columns; the exact distinct then only sees narrow ones, and decides. The sketch cannot
    lose a narrow column: n values fill n of its registers at most, for which it answers little more than n, far under
    the limit here. Missing values, NaN too, are no level.
    """
    if not columns:
        return {}
    screen = df.agg(*[F.approx_count_distinct(F.when(present(c), F.col(c))).alias(c) for c in columns]).first()
    narrow = [c for c in columns if screen[c] <= 3 * at_most + 3]
    if not narrow:
        return {}
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in narrow])
    values = df.select(F.inline(cells)).where(present("v")).distinct()
    found: dict[str, list[float]] = {c: [] for c in narrow}
    for r in values.collect():
        found[r["c"]].append(r["v"])
    return {c: sorted(v) for c, v in found.items() if len(v) <= at_most}


def prebin_edges(
    df: DataFrame, columns: Sequence[str], *, max_prebins: int = 40, max_bins: int = 8
) -> dict[str, list[float]]:
    """Inner cut points: interpolated quantiles, or midpoints where there are few levels."""
    levels = few_levels(df, columns, max_bins)
    wide = [c for c in columns if c not in levels]
    cuts = quantiles(df, wide, prebin_probs(max_prebins))
    edges = {c: [(a + b) / 2.0 for a, b in zip(v, v[1:])] for c, v in levels.items()}
    edges.update({c: sorted(set(q)) for c, q in cuts.items()})
    return {c: edges[c] for c in columns}


def edge_frame(spark: SparkSession, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    rows = [(f, i, float(e)) for f, cuts in edges.items() for i, e in enumerate(cuts)]
    return spark.createDataFrame(rows, "feature string, edge_index int, edge double")


def bin_counts(df: DataFrame, y: str, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, bin_index, count, bads); missing values count under index -1.

    Rows unfold a few features at a time into one integer that stands for feature and bin. The
    map side folds each task's rows into at most (features x bins) groups, so the shuffle does
    not grow with the table.
    """
    parts = [_coded_counts(df, y, {f: edges[f] for f in chunk}) for chunk in in_chunks(edges)]
    return union_all(parts)


def _coded_counts(df: DataFrame, y: str, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    features = list(edges)
    width = max(len(cuts) for cuts in edges.values()) + 2
    codes = ", ".join(f"{k * width + 1} + coalesce(`_bin_{f}`, -1)" for k, f in enumerate(features))
    placed = with_bins(df.select(y, *features), edges)
    rows = placed.select(F.col(y).alias("_y"), F.expr(f"explode(array({codes}))").alias("code"))
    counted = rows.groupBy("code").agg(
        F.count(F.lit(1)).alias("count"), F.sum("_y").cast("bigint").alias("bads")
    )
    names = "array(" + ", ".join(f"'{f}'" for f in features) + ")"
    return counted.select(
        F.expr(f"get({names}, CAST(code div {width} AS INT))").alias("feature"),
        F.expr(f"CAST(code % {width} - 1 AS INT)").alias("bin_index"),
        "count",
        "bads",
    )


def level_counts(df: DataFrame, y: str, columns: Sequence[str]) -> DataFrame:
    """(feature, level, count, bads) with missing values as a level."""
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            F.coalesce(F.col(f).cast("string"), F.lit(MISSING)).alias("level"),
            F.col(y).alias("_y"),
        )
        for f in columns
    ]
    rows = df.select(F.inline(F.array(*cells)))
    return rows.groupBy("feature", "level").agg(
        F.count(F.lit(1)).alias("count"), F.sum("_y").cast("bigint").alias("bads")
    )


def fold_rare(levels: DataFrame, smallest: int) -> DataFrame:
    """(feature, label, count, bads) with levels under the minimum folded into one label."""
    label = F.when(F.col("count") < smallest, OTHER).otherwise(F.col("level"))
    return _fold(levels.withColumn("label", label), "feature", "label")


def woe_iv(counts: DataFrame, by: str = "feature") -> DataFrame:
    """Smoothed weight of evidence and information value of every bin.

    The window runs over the bins of one feature, never over rows.
    """
    whole = Window.partitionBy(by)
    bad = F.col("bads") + SMOOTHING
    good = F.col("count") - F.col("bads") + SMOOTHING
    bad_share = bad / F.sum(bad).over(whole)
    good_share = good / F.sum(good).over(whole)
    weight = F.ln(good_share / bad_share)
    return counts.withColumns({"woe": weight, "iv": (good_share - bad_share) * weight})


def interval_label(lower: float, upper: float) -> str:
    """``(lower, upper]`` to four significant digits; for display only."""

    def side(v: float) -> str:
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return format(v, ",.4g")

    return f"({side(lower)}, {side(upper)}]"


def _absorbed(s: Column, i: Column) -> Column:
    """The bins of one feature after bin ``i`` (from 0) has joined its right neighbour."""

    def joined(a: Column) -> Column:
        return F.concat(F.slice(a, F.lit(1), i), F.array(F.get(a, i) + F.get(a, i + 1)), F.slice(a, i + 3, F.size(a)))

    upper = F.concat(F.slice(s["upper"], F.lit(1), i), F.slice(s["upper"], i + 2, F.size(s["upper"])))
    return F.struct(upper.alias("upper"), joined(s["count"]).alias("count"), joined(s["bads"]).alias("bads"))


def _merged(bins: Column, place: Callable[[Column], Column]) -> Column:
    """Bins join their neighbours one at a time, as long as ``place`` names one."""

    def step(s: Column, _: Column) -> Column:
        return F.coalesce(F.get(F.transform(F.array(place(s)), lambda i: F.when(i.isNotNull(), _absorbed(s, i))), F.lit(0)), s)

    return F.aggregate(F.sequence(F.lit(1), F.size(bins["count"])), bins, step)


def _first(a: Column, value: Column) -> Column:
    return (F.array_position(a, value) - 1).cast("int")


def _weights(s: Column) -> Column:
    """Weights of evidence up to a constant, which differences and trends do not need."""
    return F.zip_with(s["count"], s["bads"], lambda c, b: F.ln((c - b + SMOOTHING) / (b + SMOOTHING)))


def _steps(s: Column) -> Column:
    w, n = _weights(s), F.size(s["count"])
    return F.zip_with(F.slice(w, F.lit(2), n), F.slice(w, F.lit(1), n - 1), lambda b, a: b - a)


def _trend(s: Column) -> Column:
    """Sign of the correlation between position and weight; one bin counts as rising, equal weights as falling."""
    w, n = _weights(s), F.size(s["count"])
    moment = F.aggregate(F.transform(w, lambda x, i: x * (i - (n - 1) / 2)), F.lit(0.0), lambda a, x: a + x)
    flat = F.array_min(w) == F.array_max(w)
    return F.when(n < 2, 1).when(~flat & (moment >= 0), 1).otherwise(-1)


MERGED_SCHEMA = "feature string, bin_index int, lower double, upper double, count long, bads long, direction int"


def merge_counts(
    counts: DataFrame,
    edges: Mapping[str, Sequence[float]],
    *,
    smallest: int,
    max_bins: int = 8,
    priors: Mapping[str, int] | None = None,
    monotone: bool = True,
) -> DataFrame:
    """Merge the pre-bins of every feature: first small ones, then trend breaks, then the least distinct pairs.

    A feature's bins are three short arrays, and merging is a fold over them in JVM expressions. Small-bin and trend
    merging both stop at two bins.
    """
    spark = counts.sparkSession
    uppers = [(f, [*map(float, cuts), math.inf], (priors or {}).get(f, 0)) for f, cuts in edges.items()]
    known = counts.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("bin_index", F.struct("count", "bads")))).alias("by"))
    rows = spark.createDataFrame(uppers, "feature string, upper array<double>, prior int").join(known, "feature", "left")

    def filled(name: str) -> Column:  # every pre-bin is present, also the empty ones
        return F.transform("upper", lambda _, i: F.coalesce(F.col("by")[i][name], F.lit(0).cast("bigint"))).alias(name)

    def thin(s: Column) -> Column:
        n, least = F.size(s["count"]), F.array_min(s["count"])
        return F.when((n > 2) & (least < smallest), F.least(_first(s["count"], least), n - 2))

    def broken(s: Column) -> Column:
        climb = F.transform(_steps(s), lambda x: x * F.col("direction"))
        worst = F.array_min(climb)
        return F.when((F.size(s["count"]) > 2) & (worst < 0), _first(climb, worst))

    def alike(s: Column) -> Column:
        apart = F.transform(_steps(s), F.abs)
        return F.when(F.size(s["count"]) > max_bins, _first(apart, F.array_min(apart)))

    rows = rows.select("feature", "prior", F.struct("upper", filled("count"), filled("bads")).alias("bins"))
    rows = rows.withColumn("bins", _merged(F.col("bins"), thin))
    direction = F.when(F.col("prior") != 0, F.col("prior")).otherwise(_trend(F.col("bins"))) if monotone else F.lit(0)
    rows = rows.withColumn("direction", direction)
    if monotone:
        rows = rows.withColumn("bins", _merged(F.col("bins"), broken))
    rows = rows.withColumn("bins", _merged(F.col("bins"), alike))
    zipped = F.arrays_zip("bins.upper", "bins.count", "bins.bads")
    return rows.select("feature", "bins", "direction", F.posexplode(zipped).alias("bin_index", "bin")).select(
        "feature", "bin_index",
        F.when(F.col("bin_index") == 0, F.lit(-math.inf)).otherwise(F.get("bins.upper", F.col("bin_index") - 1)).alias("lower"),
        F.col("bin.upper").alias("upper"), F.col("bin.count").alias("count"), F.col("bin.bads").alias("bads"), "direction",
    )


@dataclass
class Binning:
    """Fitted bins of all features: a few hundred rows, kept as plain rows."""

    bins: list[dict]
    features: dict[str, dict] = field(default_factory=dict)

    def bin_frame(self, spark: SparkSession) -> DataFrame:
        names = [c.split()[0] for c in BIN_SCHEMA.split(", ")]
        return spark.createDataFrame([tuple(b[n] for n in names) for b in self.bins], BIN_SCHEMA)

    def feature_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (f, v["kind"], v["edges"], v["iv"], v["monotonic"], v["direction"])
            for f, v in self.features.items()
        ]
        return spark.createDataFrame(rows, FEATURE_SCHEMA)

    def iv_frame(self, spark: SparkSession) -> DataFrame:
        """feature, iv, strength, bins, monotonic, kind; highest information value first."""
        rows = [(f, v["iv"], len(self.of(f)), v["monotonic"], v["kind"]) for f, v in self.features.items()]
        table = spark.createDataFrame(rows, "feature string, iv double, bins long, monotonic boolean, kind string")
        table = table.select("feature", "iv", iv_strength(F.col("iv")).alias("strength"), "bins", "monotonic", "kind")
        return table.orderBy(F.desc("iv"), "feature")

    def of(self, feature: str) -> list[dict]:
        return [b for b in self.bins if b["feature"] == feature]

    def save(self, spark: SparkSession, path: str) -> None:
        self.bin_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/woe_bins")
        self.feature_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/woe_features")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Binning":
        bins = [r.asDict() for r in spark.read.parquet(f"{path}/woe_bins").collect()]
        feats = [r.asDict() for r in spark.read.parquet(f"{path}/woe_features").collect()]
        bins.sort(key=lambda b: (b["feature"], b["bin_index"]))
        return Binning(bins, {r.pop("feature"): r for r in feats})

    # ------------------------------------------------------------ row expressions

    def _pick(self, feature: str, value: str) -> Column:
        """The chosen bin's ``value`` ("woe", "label" or "bin_index") for a row."""
        rows = self.of(feature)
        if self.features[feature]["kind"] == "categorical":
            by_label = {b["label"]: b[value] for b in rows}
            unseen = by_label.get(OTHER, {"woe": 0.0, "label": OTHER, "bin_index": -1}[value])
            level = F.coalesce(F.col(feature).cast("string"), F.lit(MISSING))
            chain = F
            for label, v in by_label.items():
                chain = chain.when(level == label, F.lit(v))
            return chain.otherwise(F.lit(unseen))
        missing = [b for b in rows if b["is_missing"]]
        ranges = [b for b in rows if not b["is_missing"]]
        def literal(v: float | int | str) -> str:
            return f"'{v}'" if isinstance(v, str) else sql_number(v) if value == "woe" else str(v)

        x = f"CAST(`{feature}` AS DOUBLE)"
        chain = f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {literal((missing or ranges)[0][value])}"
        for b in ranges[:-1]:
            chain += f" WHEN {x} <= {sql_number(b['upper'])} THEN {literal(b[value])}"
        return F.expr(f"{chain} ELSE {literal(ranges[-1][value])} END")

    def transform(
        self, df: DataFrame, carry: Sequence[str] = (), features: Sequence[str] | None = None
    ) -> DataFrame:
        """``woe_<feature>`` columns beside the carried ones: one projection, no join."""
        names = list(features or self.features)
        return df.select(*carry, *[self._pick(f, "woe").alias(f"woe_{f}") for f in names])

    def assign(self, df: DataFrame, carry: Sequence[str] = (), value: str = "label") -> DataFrame:
        """The bin label (or index) of every feature."""
        return df.select(*carry, *[self._pick(f, value).alias(f) for f in self.features])

    def selected(self, min_iv: float = MIN_IV) -> list[str]:
        return [
            f
            for f, v in sorted(self.features.items(), key=lambda kv: -kv[1]["iv"])
            if v["iv"] >= min_iv
        ]


def direction_check(bins: DataFrame) -> DataFrame:
    """Per feature: does the weight of the non-missing bins move in its direction only?"""
    order = Window.partitionBy("feature").orderBy("bin_index")
    step = (F.col("woe") - F.lag("woe").over(order)) * F.col("direction")
    return (
        bins.where(~F.col("is_missing"))
        .withColumn("_ok", F.coalesce(step >= -1e-9, F.lit(True)))
        .groupBy("feature")
        .agg(F.bool_and("_ok").alias("monotonic"))
    )


def fit_bins(
    df: DataFrame,
    y: str,
    *,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    priors: Mapping[str, int] | None = None,
    max_bins: int = 8,
    min_bin_fraction: float = 0.03,
    max_prebins: int = 40,
    monotone: bool = True,
) -> Binning:
    """Fit every feature that the frame has. Use the train split only."""
    spark = df.sparkSession
    numeric = [f for f in numeric if f in df.columns]
    categorical = [f for f in categorical if f in df.columns]
    size = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(~present(y)).alias("lost")).first()
    if size["lost"]:
        raise QualityError(f"{size['lost']} rows have no observed outcome in {y}")
    smallest = max(int(min_bin_fraction * size["n"]), SMALLEST_BIN)

    parts = []
    if numeric:
        edges = prebin_edges(df, numeric, max_prebins=max_prebins, max_bins=max_bins)
        counts = bin_counts(df, y, edges)
        table = [tuple(r) for r in counts.collect()]  # at most features x (pre-bins + 1) rows
        counts = spark.createDataFrame(table, "feature string, bin_index int, count long, bads long")
        merged = merge_counts(
            counts.where("bin_index >= 0"),
            edges,
            smallest=smallest,
            max_bins=max_bins,
            priors=priors,
            monotone=monotone,
        )
        parts.append(
            merged.select(
                "feature", F.lit("numeric").alias("kind"), "bin_index", F.lit(None).cast("string").alias("label"), "lower", "upper",
                F.lit(False).alias("is_missing"), "count", "bads", "direction",
            )
        )
        parts.append(
            counts.where("bin_index = -1").select(
                "feature", F.lit("numeric").alias("kind"), F.lit(max_prebins + 1).alias("bin_index"),
                F.lit(MISSING).alias("label"), F.lit(None).cast("double").alias("lower"),
                F.lit(None).cast("double").alias("upper"), F.lit(True).alias("is_missing"),
                "count", "bads", F.lit(0).alias("direction"),
            )
        )
    if categorical:
        folded = fold_rare(level_counts(df, y, categorical), smallest)
        parts.append(
            folded.select(
                "feature", F.lit("categorical").alias("kind"), F.lit(0).alias("bin_index"), "label",
                F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"),
                (F.col("label") == MISSING).alias("is_missing"), "count", "bads",
                F.lit(0).alias("direction"),
            )
        )
    together = parts[0]
    for p in parts[1:]:
        together = together.unionByName(p)
    by_weight = Window.partitionBy("feature").orderBy("woe", "label")
    by_place = Window.partitionBy("feature").orderBy("bin_index")
    place = F.when(F.col("kind") == "numeric", F.row_number().over(by_place)).otherwise(
        F.row_number().over(by_weight)
    )
    weighed = (
        woe_iv(together)
        .withColumn("bin_index", (place - 1).cast("int"))
        .withColumn("event_rate", F.coalesce(F.try_divide("bads", "count"), F.lit(0.0)))
    )
    rows = sorted(
        (r.asDict() for r in weighed.collect()), key=lambda b: (b["feature"], b["bin_index"])
    )
    for b in rows:
        b["label"] = interval_label(b["lower"], b["upper"]) if b["label"] is None else b["label"]
    return _summarise(rows, [*numeric, *categorical])


def _summarise(rows: list[dict], order: Sequence[str]) -> Binning:
    features = {}
    for f in order:
        own = [b for b in rows if b["feature"] == f]
        ranges = [b for b in own if not b["is_missing"]]
        direction = ranges[0]["direction"] if ranges else 0
        steps = np.diff([b["woe"] for b in ranges]) * direction
        numeric = own[0]["kind"] == "numeric"
        features[f] = {
            "kind": own[0]["kind"],
            "edges": [b["upper"] for b in ranges[:-1]] if numeric else [],
            "iv": float(sum(b["iv"] for b in own)),
            "monotonic": bool((steps >= -1e-9).all()) if numeric and direction else True,
            "direction": int(direction),
        }
    return Binning([b for f in order for b in rows if b["feature"] == f], features)


# ---------------------------------------------------------------------- tables


def bin_table(bins: DataFrame) -> DataFrame:
    """Per-feature bins with their share of rows."""
    share = F.col("count") / F.sum("count").over(Window.partitionBy("feature"))
    return bins.withColumn("share", share)


def iv_table(bins: DataFrame) -> DataFrame:
    """Information value per feature with its strength and bin count, highest first."""
    return (
        bins.groupBy("feature")
        .agg(F.sum("iv").alias("iv"), F.count(F.lit(1)).alias("bins"))
        .withColumn("strength", iv_strength(F.col("iv")))
        .orderBy(F.desc("iv"), "feature")
    )


def top_features(ivs: DataFrame, k: int) -> DataFrame:
    """The ``k`` strongest features with their rank (one row per feature goes in)."""
    top = ivs.orderBy(F.desc("iv"), "feature").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("iv"), "feature")))


def drop_reasons(ivs: DataFrame, min_iv: float = MIN_IV) -> DataFrame:
    weak = ivs.where(F.col("iv") < min_iv)
    return weak.select("feature", F.format_string(f"IV %.4f below {min_iv}", "iv").alias("reason"))

