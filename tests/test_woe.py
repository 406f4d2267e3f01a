import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditloom.functions.expr import normalise_missing
from creditloom.operators import scorecard, woe
from creditloom.operators.quality import QualityError
from creditloom.sources import io

# fixed values: published bins as (count, bads, woe, points)
GOLDEN = {
    "avg_daily_balance_kes": (
        0.4924,
        -0.09338973549708673,
        [
            (1494, 352, -1.095, 9.9),
            (1460, 254, -0.7143, 11.9),
            (2955, 401, -0.4201, 13.5),
            (1939, 207, -0.1483, 15.0),
            (5862, 403, 0.3344, 17.6),
            (3400, 158, 0.7478, 19.8),
            (1467, 36, 1.399, 23.3),
            (978, 16, 1.796, 25.4),
        ],
    ),
    "prior_ontime_repayment_ratio": (
        0.4389,
        -0.3626933250689503,
        [
            (934, 241, -1.215, -9.7),
            (1867, 348, -0.7978, -0.9),
            (934, 129, -0.4425, 6.5),
            (2800, 326, -0.2449, 10.6),
            (5601, 439, 0.1933, 19.8),
            (1867, 106, 0.5355, 27.0),
            (3734, 151, 0.8932, 34.5),
            (934, 14, 1.881, 55.1),
            (884, 73, 0.1313, 18.5),
        ],
    ),
}
INTERCEPT, K = -2.2949942363119535, 34


def test_golden_bins_and_points(spark):
    rows = [
        (f, i, str(i), n, b) for f, (_, _, bins) in GOLDEN.items() for i, (n, b, _, _) in enumerate(bins)
    ]
    counts = spark.createDataFrame(rows, "feature string, bin_index int, label string, count long, bads long")
    bins = woe.woe_iv(counts)
    card = spark.createDataFrame([(f, c) for f, (_, c, _) in GOLDEN.items()], "feature string, coefficient double")
    table = scorecard.points_table(bins, card, INTERCEPT, K)
    points = {(r["feature"], r["bin_index"]): r["points"] for r in table.collect()}
    for r in bins.collect():
        _, _, golden = GOLDEN[r["feature"]]
        assert float(f"{r['woe']:.4g}") == golden[r["bin_index"]][2]
        assert points[r["feature"], r["bin_index"]] == golden[r["bin_index"]][3]
    ivs = {r["feature"]: r["iv"] for r in woe.iv_table(bins).collect()}
    assert {f: round(v, 4) for f, v in ivs.items()} == {f: g[0] for f, g in GOLDEN.items()}


def merged(spark, upper, count, bads, prior=0, **how):
    rows = [("x", i, n, b) for i, (n, b) in enumerate(zip(count, bads))]
    counts = spark.createDataFrame(rows, "feature string, bin_index int, count long, bads long")
    bins = woe.merge_counts(counts, {"x": upper[:-1]}, **{"smallest": 1, **how}, priors={"x": prior})
    got = bins.orderBy("bin_index").collect()
    assert [r["lower"] for r in got] == [-math.inf, *(r["upper"] for r in got[:-1])]
    return [r["upper"] for r in got], [r["count"] for r in got], [r["bads"] for r in got], got[0]["direction"]


def test_small_bins_join_right_and_the_last_joins_left(spark):
    got = merged(spark, [1, 2, 3, math.inf], [5, 50, 50, 50], [1, 9, 5, 2], smallest=25, monotone=False)
    assert got[:2] == ([2, 3, math.inf], [55, 50, 50])
    got = merged(spark, [1, 2, 3, math.inf], [50, 50, 50, 5], [9, 7, 5, 0], smallest=25, monotone=False)
    assert got[:2] == ([1, 2, math.inf], [50, 50, 55])


def test_first_of_equally_small_bins_goes_first(spark):
    got = merged(spark, [1, 2, 3, math.inf], [10, 100, 10, 100], [1, 9, 1, 9], smallest=15, monotone=False)
    assert got[1] == [110, 110]


def test_merging_stops_at_two_bins(spark):
    got = merged(spark, [1, math.inf], [3, 4], [3, 0], smallest=25, prior=-1)
    assert got[0] == [1, math.inf] and got[3] == -1


def test_trend_breaks_are_merged_worst_first(spark):
    upper, count, bads, direction = merged(
        spark, [1, 2, 3, 4, math.inf], [100] * 5, [40, 20, 35, 10, 5], prior=1
    )
    assert count == [100, 200, 100, 100] and bads == [40, 55, 10, 5] and direction == 1


def test_direction_from_data_and_undefined_direction(spark):
    assert merged(spark, [1, 2, math.inf], [100] * 3, [5, 10, 20])[3] == -1
    assert merged(spark, [1, 2, math.inf], [100] * 3, [20, 10, 5])[3] == 1
    assert merged(spark, [1, 2, math.inf], [100] * 3, [10, 10, 10])[3] == -1
    assert merged(spark, [math.inf], [100], [10])[3] == 1


def test_weakest_pairs_go_until_the_limit(spark):
    got = merged(spark, [1, 2, 3, math.inf], [100] * 4, [40, 39, 20, 5], max_bins=2, monotone=False)
    assert got[1] == [200, 200] or got[1] == [300, 100]
    assert len(merged(spark, list(range(20)) + [math.inf], [100] * 21, range(21), max_bins=8)[0]) <= 8


def plain_merge(upper, count, bads, smallest, max_bins, prior):
    """The rules one bin at a time, on lists."""
    upper, count, bads = list(upper), list(count), list(bads)

    def absorb(i):
        count[i + 1] += count[i]
        bads[i + 1] += bads[i]
        del upper[i], count[i], bads[i]

    def weights():
        return np.log((np.array(count) - bads + 0.5) / (np.array(bads) + 0.5))

    while len(count) > 2 and min(count) < smallest:
        absorb(min(count.index(min(count)), len(count) - 2))
    with np.errstate(all="ignore"):
        r = np.corrcoef(np.arange(len(count)), weights())[0, 1] if len(count) > 1 else 1
    direction = prior or (1 if r >= 0 else -1)
    while len(count) > 2 and (np.diff(weights()) * direction).min() < 0:
        absorb(int((np.diff(weights()) * direction).argmin()))
    while len(count) > max_bins:
        absorb(int(np.abs(np.diff(weights())).argmin()))
    return upper, count, bads, direction


def test_merging_of_many_features_equals_the_plain_rules(spark):
    rng = np.random.default_rng(3)
    edges, rows, want = {}, [], {}
    for k in range(60):
        n = int(rng.integers(1, 41))
        count = rng.integers(0, 200, n)
        bads = rng.binomial(count, np.clip(rng.normal(0.2, 0.1) + np.linspace(0, rng.normal(0, 0.2), n), 0.01, 0.9))
        upper = [*np.sort(rng.normal(size=n - 1)).tolist(), math.inf]
        edges[f"f{k}"] = upper[:-1]
        rows += [(f"f{k}", i, int(c), int(b)) for i, (c, b) in enumerate(zip(count, bads)) if c]  # empty bins have no row
        want[f"f{k}"] = plain_merge(upper, count.tolist(), bads.tolist(), 60, 6, [0, 1, -1][k % 3])
    counts = spark.createDataFrame(rows, "feature string, bin_index int, count long, bads long")
    priors = {f"f{k}": [0, 1, -1][k % 3] for k in range(60)}
    got = woe.merge_counts(counts, edges, smallest=60, max_bins=6, priors=priors).orderBy("feature", "bin_index").collect()
    for f, expected in want.items():
        own = [r for r in got if r["feature"] == f]
        assert ([r["upper"] for r in own], [r["count"] for r in own], [r["bads"] for r in own], own[0]["direction"]) == expected


def test_missing_values_are_no_level_and_no_edge(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, float("nan")), (3.0, None), (float("nan"), 5.0), (None, 7.0)], "a double, b double")
    assert woe.prebin_edges(df, ["a", "b"]) == {"a": [1.5, 2.5], "b": [3.0, 6.0]}
    wide = spark.range(100).select(F.when(F.col("id") % 10 == 0, float("nan")).otherwise(F.col("id")).cast("double").alias("a"))
    assert all(np.isfinite(woe.prebin_edges(wide, ["a"])["a"]))
    assert woe.prebin_edges(df.limit(0), ["a"]) == {"a": []}


def test_labels():
    assert woe.interval_label(-math.inf, 400.0) == "(-inf, 400]"
    assert woe.interval_label(1440.0, 5628.4) == "(1,440, 5,628]"
    assert woe.interval_label(0.695, math.inf) == "(0.695, inf]"


@pytest.fixture(scope="module")
def book(spark):
    rng = np.random.default_rng(11)
    n = 4000
    x = rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(2 + x))).astype(float)
    pdf = pd.DataFrame(
        {
            "safe": x,
            "risky": -x + rng.normal(0, 0.5, n),
            "flag": (x > 0).astype(float),
            "count": rng.poisson(4, n),
            "constant": 1.0,
            "absent": np.nan,
            "holes": np.where(rng.random(n) < 0.2, np.nan, x + rng.normal(0, 1, n)),
            "noise": rng.normal(size=n),
            "level": rng.choice(["a", "b", "c", "rare"], n, p=[0.5, 0.3, 0.19, 0.01]),
            "y": y,
        }
    )
    pdf.loc[rng.random(n) < 0.05, "level"] = None
    return pdf, normalise_missing(spark.createDataFrame(pdf)).repartition(6).cache()


NUMERIC = ["safe", "risky", "flag", "count", "constant", "absent", "holes", "noise"]


@pytest.fixture(scope="module")
def binning(book):
    return woe.fit_bins(
        book[1], "y", numeric=[*NUMERIC, "not there"], categorical=["level"], priors={"safe": 1, "risky": -1}
    )


def test_fit_properties(book, binning):
    pdf, _ = book
    floor = max(int(0.03 * len(pdf)), 25)
    assert list(binning.features) == [*NUMERIC, "level"]
    for f, info in binning.features.items():
        rows = binning.of(f)
        assert sum(b["count"] for b in rows) == len(pdf)
        assert sum(b["bads"] for b in rows) == pdf["y"].sum()
        assert info["iv"] >= 0
        ranges = [b for b in rows if not b["is_missing"]]
        assert len(ranges) <= 8
        if len(ranges) > 2 and info["kind"] == "numeric":
            assert min(b["count"] for b in ranges) >= floor
            assert info["monotonic"]
    assert binning.features["safe"]["direction"] == 1
    assert binning.features["risky"]["direction"] == -1
    assert binning.features["flag"]["edges"] == [0.5]
    assert binning.features["constant"]["edges"] == []
    assert [b["label"] for b in binning.of("absent")] == ["(-inf, inf]", "Missing"]
    assert binning.of("absent")[0]["event_rate"] == 0.0
    assert binning.of("holes")[-1]["is_missing"]
    assert {b["label"] for b in binning.of("level")} == {"a", "b", "c", "__other__", "Missing"}
    weights = [b["woe"] for b in binning.of("level")]
    assert weights == sorted(weights)


def test_edges_are_pooled_quantiles(book, binning):
    pdf, df = book
    probs = np.linspace(0, 1, 41)[1:-1]
    got = woe.prebin_edges(df, ["safe", "flag", "holes"])
    assert got["safe"] == pytest.approx(np.unique(np.quantile(pdf["safe"], probs)), abs=1e-12)
    assert got["holes"] == pytest.approx(np.unique(np.quantile(pdf["holes"].dropna(), probs)), abs=1e-12)
    assert got["flag"] == [0.5]
    assert set(binning.features["safe"]["edges"]) <= set(got["safe"])


def test_counts_match_digitize(book):
    pdf, df = book
    edges = {"safe": [-1.0, 0.0, 1.0], "holes": [0.0]}
    got = {(r["feature"], r["bin_index"]): (r["count"], r["bads"]) for r in woe.bin_counts(df, "y", edges).collect()}
    place = np.digitize(pdf["safe"], edges["safe"], right=True)
    for i in range(4):
        assert got["safe", i] == ((place == i).sum(), pdf["y"][place == i].sum())
    assert got["holes", -1] == (pdf["holes"].isna().sum(), pdf["y"][pdf["holes"].isna()].sum())


def test_transform(spark, binning):
    rows = spark.createDataFrame(
        [(None,) * 8 + ("unseen",), (-9.0, 9.0, 1.0, 3, 1.0, 5.0, float("nan"), 0.0, "rare")],
        "safe double, risky double, flag double, count long, constant double, absent double, "
        "holes double, noise double, level string",
    )
    empty, full = binning.transform(rows).collect()
    by = {f: binning.of(f) for f in binning.features}
    other = next(b["woe"] for b in by["level"] if b["label"] == "__other__")
    assert empty["woe_safe"] == by["safe"][0]["woe"]  # no Missing bin: the lowest bin
    assert empty["woe_holes"] == by["holes"][-1]["woe"]
    assert full["woe_holes"] == by["holes"][-1]["woe"]
    assert empty["woe_level"] == full["woe_level"] == other
    assert full["woe_safe"] == by["safe"][0]["woe"]
    assert full["woe_risky"] == [b for b in by["risky"] if not b["is_missing"]][-1]["woe"]
    labels = binning.assign(rows).collect()
    assert labels[0]["level"] == "__other__" and labels[0]["holes"] == "Missing"


def test_value_on_an_edge_goes_down(spark, binning):
    edge = binning.features["safe"]["edges"][0]
    df = spark.createDataFrame([(edge,), (float(np.nextafter(edge, 9)),)], "safe double")
    got = [r[0] for r in df.select(binning._pick("safe", "bin_index")).collect()]
    assert got == [0, 1]


def test_unseen_level_without_other_weighs_nothing(spark, book):
    _, df = book
    fitted = woe.fit_bins(df.where("level IN ('a', 'b')"), "y", numeric=[], categorical=["level"])
    got = fitted.transform(spark.createDataFrame([("z",)], "level string")).first()[0]
    assert got == 0.0


def test_fit_refuses_missing_outcomes(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 1.0)], "x double, y double")
    with pytest.raises(QualityError):
        woe.fit_bins(df, "y", numeric=["x"])


def test_row_order_does_not_matter(book, binning):
    again = woe.fit_bins(
        book[1].orderBy(F.rand(5)), "y", numeric=["safe", "holes"], priors={"safe": 1, "risky": -1}
    )
    for f in ("safe", "holes"):
        assert [b["woe"] for b in again.of(f)] == pytest.approx([b["woe"] for b in binning.of(f)])


def test_save_and_load(spark, tmp_path, binning):
    binning.save(spark, str(tmp_path))
    again = woe.Binning.load(spark, str(tmp_path))
    assert set(again.features) == set(binning.features)
    assert again.of("holes") == [{k: v for k, v in b.items() if k != "direction"} for b in binning.of("holes")]
    nested = io.nested_bins(binning.bin_frame(spark)).where("feature = 'flag'").first()
    assert len(nested["bins"]) == 2 and '"feature":"flag"' in nested["json"]


def test_selection_and_reasons(spark, binning):
    table = woe.iv_table(binning.bin_frame(spark))
    picked = binning.selected(0.02)
    assert picked == [r["feature"] for r in table.where("iv >= 0.02").collect()]
    reasons = {r["feature"]: r["reason"] for r in woe.drop_reasons(table).collect()}
    assert reasons["constant"] == "IV 0.0000 below 0.02"
    top = woe.top_features(table, 2).orderBy("rank").collect()
    assert [r["feature"] for r in top] == picked[:2] and [r["rank"] for r in top] == [1, 2]


def test_monotone_flag_agrees_with_the_table(spark, binning):
    directions = spark.createDataFrame(
        [(f, v["direction"]) for f, v in binning.features.items()], "feature string, direction int"
    )
    bins = binning.bin_frame(spark).where("kind = 'numeric'").join(directions, "feature")
    for r in woe.direction_check(bins).collect():
        assert r["monotonic"] == binning.features[r["feature"]]["monotonic"]
