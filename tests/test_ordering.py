import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom.functions import ordering
from creditloom.functions.expr import normalise_missing


def frame(spark, pdf):
    return normalise_missing(spark.createDataFrame(pdf)).repartition(5)


def test_quantiles_equal_linear_interpolation(spark, both_paths):
    rng = np.random.default_rng(1)
    n = 997
    pdf = pd.DataFrame(
        {
            "a": rng.normal(size=n),
            "b": np.where(rng.random(n) < 0.4, 3.0, np.round(rng.random(n), 1)),
            "c": np.full(n, 2.5),
            "d": np.where(rng.random(n) < 0.9, np.nan, rng.random(n)),
        }
    )
    probs = np.linspace(0, 1, 41)[1:-1]
    got = ordering.quantiles(frame(spark, pdf), list("abcd"), probs)
    for c in "abcd":
        assert got[c] == pytest.approx(np.quantile(pdf[c].dropna(), probs), abs=1e-12)


def test_quantiles_of_nothing(spark, both_paths):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    got = ordering.quantiles(df, ["a", "b"], [0.5])
    assert got == {"a": [], "b": [1.5]}


def test_order_statistics_of_large_integers(spark, both_paths):
    base = 2**60
    df = spark.createDataFrame([(base + i,) for i in range(60)], "k long")
    got = ordering.order_statistics(df, {"k": [1, 17, 60]})["k"]
    assert (got[1], got[17], got[60]) == (base, base + 16, base + 59)


@pytest.mark.parametrize("n", [1, 2, 7, 10, 11, 656])
def test_bands_equal_qcut_of_the_rank(spark, both_paths, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"id": rng.permutation(n), "s": rng.choice([0.1, 0.2, 0.2, 0.7], n)})
    got = ordering.with_band(frame(spark, pdf), "s", "id", 10).toPandas().sort_values(["s", "id"])
    if n == 1:
        assert got["band"].tolist() == [1]
        return
    expected = pd.qcut(np.arange(n), 10, labels=range(1, 11)).astype(int)
    assert got["band"].tolist() == list(expected)


def test_published_band_sizes(spark, both_paths):
    df = spark.range(6556).select("id", (F.col("id") % 400).cast("double").alias("s"))
    sizes = ordering.with_band(df, "s", "id", 10).groupBy("band").count().orderBy("band").collect()
    assert [r["count"] for r in sizes] == [656, 656, 655, 656, 655, 656, 655, 656, 655, 656]


def test_bands_by_group(spark, both_paths, scored_pdf):
    got = ordering.with_band(frame(spark, scored_pdf), "p", "id", 10, "split").toPandas()
    for _, part in got.groupby("split"):
        part = part.sort_values(["p", "id"])
        expected = pd.qcut(np.arange(len(part)), 10, labels=range(1, 11)).astype(int)
        assert part["band"].tolist() == list(expected)


def test_running_totals(spark, both_paths):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["x", "y"], 400), "s": rng.integers(0, 90, 400) / 10})
    cells = (
        ordering.with_bucket(frame(spark, pdf), "s")
        .groupBy("g", "_bucket", "s")
        .agg(F.count("*").alias("n"))
    )
    got = ordering.running_totals(cells, ["g"], "s", ["n"]).toPandas()
    for g, part in got.groupby("g"):
        part = part.sort_values("s")
        assert part["n_before"].tolist() == (part["n"].cumsum() - part["n"]).tolist()
        assert set(part["n_total"]) == {(pdf["g"] == g).sum()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60),
    probs=st.lists(st.floats(0, 1), min_size=1, max_size=4),
)
def test_quantiles_on_arbitrary_lists(spark, data, probs):
    spark.conf.set(ordering.ONE_TASK_KEY, "5")
    try:
        df = spark.createDataFrame([(float(v),) for v in data], "x double")
        got = ordering.quantiles(df, ["x"], probs)["x"]
    finally:
        spark.conf.unset(ordering.ONE_TASK_KEY)
    assert got == pytest.approx(np.quantile(data, probs), rel=1e-9, abs=1e-9)
