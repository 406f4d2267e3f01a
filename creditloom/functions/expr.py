"""Row expressions shared by the operators. All of them stay on the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.config import BANDS, PSI_AMBER, PSI_GREEN

FEW_EDGES = 12
CHUNK = 8

def normalise_missing(df: DataFrame) -> DataFrame:
    """Turn NaN into null once, at load, so that one test finds every missing value."""
    return df.select(
        *[
            F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def present(*names: str) -> Column:
    """Is every named number there? Null and NaN both count as missing, everywhere."""
    return reduce(
        Column.__and__,
        [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in names],
    )


def round_even(x: Column, places: int = 4) -> Column:
    """Half-to-even on the scaled value."""
    unit = float(10**places)
    return F.rint(x * unit) / unit


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clamp that keeps null (greatest and least alone would skip it)."""
    bounded = x
    if low is not None:
        bounded = F.greatest(bounded, F.lit(float(low)))
    if high is not None:
        bounded = F.least(bounded, F.lit(float(high)))
    return F.when(x.isNotNull(), bounded)


def sql_number(value: float) -> str:
    return f"{float(value)!r}D"


def _compared(name: str, edges: Sequence[float]) -> str:
    steps = " + ".join(f"CASE WHEN `{name}` > {sql_number(e)} THEN 1 ELSE 0 END" for e in edges)
    return f"CASE WHEN `{name}` IS NOT NULL AND NOT isnan(`{name}`) THEN {steps or '0'} END"


def with_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], prefix: str = "_bin_") -> DataFrame:
    """Add the right-closed bin index of every column: how many sorted edges lie below it.

    A few edges are compared in generated code. More go to ``Bucketizer``, which searches by
    halves and whose bins are closed on the left; it therefore gets the mirrored values
    (``0 - x`` also folds the two zeros into one). Null and NaN are missing and get no bin,
    however many edges there are.
    """
    few = {c: cuts for c, cuts in edges.items() if len(cuts) <= FEW_EDGES}
    many = {c: cuts for c, cuts in edges.items() if len(cuts) > FEW_EDGES}
    out = df.select("*", *[F.expr(_compared(c, cuts)).alias(prefix + c) for c, cuts in few.items()])
    if not many:
        return out
    mirrored = out.select("*", *[F.when(present(c), 0.0 - F.col(c)).alias(f"_neg_{c}") for c in many])
    inf = float("inf")
    bucketizer = Bucketizer(
        inputCols=[f"_neg_{c}" for c in many],
        outputCols=[f"_pos_{c}" for c in many],
        splitsArray=[[-inf, *[0.0 - e for e in reversed(cuts)], inf] for cuts in many.values()],
        handleInvalid="keep",
    )
    return bucketizer.transform(mirrored).select(
        *out.columns,
        *[(len(cuts) - F.col(f"_pos_{c}")).cast("int").alias(prefix + c) for c, cuts in many.items()],
    )


def in_chunks(names: Iterable[str], size: int = CHUNK) -> list[list[str]]:
    """Column names a few at a time.

    One pass that unfolds dozens of columns compiles to a method too long for the JVM to
    optimise; a union of passes over a few columns each reads the same bytes several times faster.
    """
    names = list(names)
    return [names[i : i + size] for i in range(0, len(names), size)]


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """While writing very wide projections: no generated method longer than the JVM compiles."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def epoch_micros(name: str) -> Column:
    """Microseconds of a zone-free timestamp since 1970, independent of the session zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{name}`)")


def from_epoch_micros(micros: Column) -> Column:
    """The inverse of :func:`epoch_micros`."""
    return F.timestamp_add("MICROSECOND", micros, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def iv_strength(iv: Column) -> Column:
    return (
        F.when(iv < 0.02, "unpredictive")
        .when(iv < 0.10, "weak")
        .when(iv < 0.30, "medium")
        .when(iv < 0.50, "strong")
        .otherwise("suspiciously strong")
    )


def psi_verdict(value: Column) -> Column:
    return (
        F.when(value < PSI_GREEN, "stable")
        .when(value < PSI_AMBER, "investigate")
        .otherwise("unstable")
    )


def risk_band(score: Column) -> Column:
    """Policy band of an integer score; anything outside every band is the last one."""
    chain = F
    for name, low, high in BANDS:
        chain = chain.when(score.between(low, high), name)
    return chain.otherwise(BANDS[-1][0])


def age_band(age: Column) -> Column:
    """Audit bands (17,24] (24,34] (34,44] (44,54] (54,100]; outside them, null."""
    return (
        F.when(age <= 17, F.lit(None))
        .when(age <= 24, "18-24")
        .when(age <= 34, "25-34")
        .when(age <= 44, "35-44")
        .when(age <= 54, "45-54")
        .when(age <= 100, "55+")
    )


def mask_thin_file(value: Column, tenure: Column, days: int = 90) -> Column:
    """Long-window values do not exist for files younger than the window."""
    return F.when(tenure >= days, value)


def observed_outcome(outcome: Column, approved: Column) -> Column:
    """Only an approved application has an outcome."""
    return F.when(approved == 1, outcome.cast("double"))


def log_odds(p: Column, floor: float) -> Column:
    q = F.least(F.greatest(p, F.lit(floor)), F.lit(1.0 - floor))
    return F.when(p.isNotNull(), F.ln(q / (1.0 - q)))


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))
