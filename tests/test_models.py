import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from creditloom.config import SCALE
from creditloom.operators import boost, isotonic, policy, profiles, scorecard, woe
from creditloom.operators.newton import newton as newton_fit
from creditloom.operators.quality import QualityError


@pytest.fixture(scope="module")
def book(spark):
    rng = np.random.default_rng(21)
    n = 6000
    a, b = rng.normal(size=n), rng.normal(size=n)
    z = -1.8 - 0.9 * a - 0.6 * b
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "split": rng.choice(["train", "valid", "oot"], n, p=[0.7, 0.15, 0.15]),
            "a": a,
            "b": b,
            "twin": a + rng.normal(0, 0.05, n),
            "weak": rng.normal(size=n),
            "y": (rng.random(n) < 1 / (1 + np.exp(-z))).astype(float),
        }
    )
    return spark.createDataFrame(pdf).repartition(4).cache()


FEATURES = ["a", "b", "twin", "weak"]


@pytest.fixture(scope="module")
def binning(book):
    return woe.fit_bins(book.where("split = 'train'"), "y", numeric=FEATURES)


@pytest.fixture(scope="module")
def weighted(book, binning):
    return binning.transform(book, ["id", "split", "y"]).cache()


@pytest.fixture(scope="module")
def card(weighted, binning):
    return scorecard.fit_scorecard(weighted.where("split = 'train'"), binning, "y")


def newton(x, y):
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        info = design.T @ (design * (p * (1 - p))[:, None])
        beta += np.linalg.solve(info, design.T @ (y - p))
    return beta, np.sqrt(np.diag(np.linalg.inv(info)))


def test_fit_matches_maximum_likelihood(weighted, card):
    train = weighted.where("split = 'train'").toPandas()
    x = train[[f"woe_{f}" for f in card.features]].to_numpy()
    beta, errors = newton(x, train["y"].to_numpy())
    assert list(card.coefficients.values()) == pytest.approx(beta[1:], abs=1e-4)
    assert card.intercept == pytest.approx(beta[0], abs=1e-4)
    rows = {r[0]: r for r in card.diagnostics}
    vif = []
    for i in range(x.shape[1]):  # 1 / (1 - R2) of each column on the others
        others = np.column_stack([np.ones(len(x)), np.delete(x, i, 1)])
        left = x[:, i] - others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        vif.append(x[:, i].var() / left.var())
    for i, f in enumerate(card.features):
        assert rows[f][3] == pytest.approx(vif[i], rel=1e-5)
        assert rows[f][4] == pytest.approx(errors[i + 1], rel=1e-3)
        assert rows[f][5] == pytest.approx(beta[i + 1] / errors[i + 1], rel=1e-3)
        assert rows[f][6] < 1e-6
    assert all(c <= 0 for c in card.coefficients.values())


def test_dropped_features_have_reasons(card):
    reasons = {f: rest for f, *rest in card.dropped}
    assert set(card.features) | set(reasons) == set(FEATURES)
    assert reasons["weak"][0] == "low information" and reasons["weak"][1] < 0.02
    reason, value, rival = next(r for f, r in reasons.items() if f in ("a", "twin"))
    assert reason == "correlated" and value > 0.9 and rival in card.features


def test_pruning_keeps_the_stronger_feature():
    matrix = np.array([[1.0, 0.8, -0.9], [0.8, 1.0, 0.1], [-0.9, 0.1, 1.0]])
    assert scorecard.prune_correlated(matrix, ["x", "y", "z"]) == (
        ["x"],
        [("y", "correlated", 0.8, "x"), ("z", "correlated", 0.9, "x")],
    )
    matrix[:] = np.nan
    assert scorecard.prune_correlated(matrix, ["x", "y", "z"])[0] == ["x", "y", "z"]


def test_pairwise_correlations_keep_incomplete_rows(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(400, 3)), columns=["x", "y", "z"])
    pdf["y"] += pdf.x
    pdf.loc[::3, "z"] = np.nan
    pdf.loc[1::4, "x"] = np.nan
    got = {(r.feature_a, r.feature_b): r.r for r in scorecard.pairwise_correlations(spark.createDataFrame(pdf), ["x", "y", "z"]).collect()}
    want = pdf.corr()  # pandas leaves out incomplete pairs only
    assert len(got) == 9 and all(v == pytest.approx(want.loc[k]) for k, v in got.items())
    assert scorecard.pairwise_correlations(spark.createDataFrame(pdf.head(0), "x double, y double"), ["x", "y"]).where("r IS NOT NULL").count() == 0


def test_a_constant_column_has_a_wald_test_too(spark):
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.normal(size=500), np.ones(500)])
    df = spark.createDataFrame([(row.tolist(),) for row in x], "x array<double>").repartition(3)
    p = 1 / (1 + np.exp(-(x @ [-0.7, 0.0] - 1.0)))
    design = np.column_stack([x, np.ones(500)])
    expected = design.T @ (design * (p * (1 - p))[:, None])
    found = {(i, j): v for i, j, v in scorecard.information(df, "x", [-0.7, 0.0], -1.0).collect()}
    assert all(found[i, j] == pytest.approx(expected[i, j]) for i in range(3) for j in range(3))
    tests = scorecard.wald(df, "x", [-0.7, 0.0], -1.0)
    assert np.isfinite(np.array(tests)).all() and tests[0][2] < 1e-4 < tests[1][2]
    assert scorecard.information(df.where("false"), "x", [-0.7, 0.0], -1.0).agg(F.sum("value")).first()[0] in (None, 0.0)


def test_wrong_signs_are_dropped_one_by_one(spark):
    rng = np.random.default_rng(4)
    n = 4000
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(1.5 + x[:, 0] + 0.5 * x[:, 1] - 0.8 * x[:, 2]))).astype(float)
    pdf = pd.DataFrame(x, columns=["woe_p", "woe_q", "woe_r"]).assign(y=y)
    info = {f: {"iv": iv} for f, iv in (("p", 0.3), ("q", 0.2), ("r", 0.1))}
    card = scorecard.fit_scorecard(spark.createDataFrame(pdf), woe.Binning([], info), "y")
    assert card.features == ["p", "q"]
    assert card.dropped[0][:2] == ("r", "sign") and 0 < card.dropped[0][2] < 1


def test_points_add_up_to_the_unrounded_score(spark, book, binning, card, weighted):
    table = scorecard.points(
        binning.bin_frame(spark), card.coefficient_frame(spark), card.intercept, len(card.features)
    )
    points = {(r["feature"], r["bin_index"]): r["points"] for r in table.collect()}
    assigned = binning.assign(book, ["id"], "bin_index").toPandas().set_index("id")
    z = weighted.select("id", card.log_odds().alias("z"), card.score().alias("s")).toPandas().set_index("id")
    total = sum(assigned[f].map(lambda i, f=f: points[f, i]) for f in card.features)
    raw = SCALE.offset - SCALE.factor * z["z"]
    assert (total.sort_index() - raw.sort_index()).abs().max() < 1e-8
    clipped = np.clip(np.round(raw), 300, 850).astype(int)
    assert (clipped.sort_index() == z["s"].sort_index()).all()


def test_save_and_load(spark, tmp_path, card, weighted):
    card.save(spark, str(tmp_path))
    again = scorecard.Scorecard.load(spark, str(tmp_path))
    assert again.coefficients == card.coefficients or set(again.coefficients) == set(card.coefficients)
    assert again.intercept == card.intercept and again.dropped == card.dropped
    assert again.base_points == pytest.approx(card.base_points)


def test_base_points_of_the_published_card():
    card = scorecard.Scorecard({str(i): -0.1 for i in range(34)}, -2.2949942363119535)
    assert card.base_points == pytest.approx(15.769513185867636, abs=1e-10)


def test_score_bands_read_low_to_high(spark, scored_pdf):
    from creditloom.operators.scale import probability_to_score

    df = spark.createDataFrame(scored_pdf).withColumn("score", probability_to_score(F.col("p")))
    rows = scorecard.score_bands(df, "score", "y", "id").orderBy("band").collect()
    ends = [tuple(int(v) for v in r["score_range"].split("-")) for r in rows]
    assert all(a <= b for a, b in ends) and ends == sorted(ends)
    assert rows[-1]["cum_bad_capture_pct"] == 100.0


# ---------------------------------------------------------------------- boosted trees

SPACE = boost.Space(trees=(5, 10, 5), depth=(2, 3), learning_rate=(0.1, 0.3))


@pytest.fixture(scope="module")
def tuned(weighted):
    return boost.tune(weighted, ["woe_a", "woe_b"], "y", trials=2, space=SPACE)


def test_search_keeps_the_best_refit(spark, weighted, tuned):
    from creditloom.operators.metrics import discrimination

    aucs = [auc for auc, _ in tuned.trials]
    assert len(aucs) == 2 and tuned.valid_auc == max(aucs)
    scored = tuned.score(weighted.where("split = 'valid'"))
    assert discrimination(scored, "p", "y").first()["auc"] == pytest.approx(tuned.valid_auc)
    assert tuned.trial_frame(spark).count() == 2


def test_finished_trials_are_not_run_again(weighted, tuned):
    again = boost.tune(weighted, ["woe_a", "woe_b"], "y", trials=2, space=SPACE, done=tuned.trials)
    assert again.valid_auc == tuned.valid_auc and again.params == tuned.params


def test_importance_and_signs(spark, tuned):
    rows = boost.importance(tuned.model, tuned.features, spark).collect()
    assert sum(r["share_pct"] for r in rows) == pytest.approx(100, abs=0.1)
    assert rows[0]["feature"] == "woe_a"
    assert boost.monotone_vector(["x", "y", "z"], {"x": 1, "y": -1}) == [-1, 1, 0]


def test_audit_against_brute_force(spark, weighted, tuned, binning):
    grids = {f"woe_{f}": [b["woe"] for b in binning.of(f)] for f in ("a", "b")}
    rows = weighted.limit(60).cache()
    got = {r["feature"]: r for r in boost.monotone_audit(rows, tuned, grids).collect()}
    base = rows.toPandas()
    for f in tuned.features:
        steps = sorted(set(grids[f]))
        curves = []
        for g in steps:
            varied = spark.createDataFrame(base.assign(**{f: g}))
            curves.append(tuned.score(varied).toPandas().sort_values("id")["p"].to_numpy())
        rises = np.diff(np.array(curves), axis=0) > 1e-12
        assert got[f]["violation_share"] == pytest.approx(rises.mean())
        assert got[f]["steps"] == rises.size


def test_champion_and_uplift(spark):
    table = spark.createDataFrame(
        [("scorecard", 0.81, 0.65), ("x", 0.79, 0.66), ("y", 0.80, 0.64), ("free", 0.9, 0.6)],
        "model string, valid_auc double, oot_gini double",
    )
    assert boost.champion(table, ["x", "y"]).first()[0] == "y"
    assert boost.uplift(table, "y", "scorecard").first()[0] == pytest.approx(-0.01)


@pytest.fixture(scope="module")
def binned(spark):
    """Four features of few values, with repeated rows and validation rows that lack an outcome."""
    rng = np.random.default_rng(3)
    n = 3000
    x = np.stack([rng.choice(rng.normal(size=k).round(4), n, p=rng.dirichlet(np.ones(k) * 4)) for k in (5, 7, 3, 9)], 1)
    pdf = pd.DataFrame(x, columns=list("abcd"))
    pdf["y"] = (rng.random(n) < 1 / (1 + np.exp(1 - x[:, 0] + 0.6 * x[:, 1] - 0.8 * x[:, 2] * x[:, 3]))).astype(float)
    pdf["split"] = rng.choice(["train", "valid", "oot"], n, p=[0.6, 0.2, 0.2])
    pdf.loc[(pdf.split == "valid") & (rng.random(n) < 0.2), "y"] = np.nan
    return spark.createDataFrame(pdf).repartition(4).cache()


def test_profiles_grow_the_trees_of_spark_ml(spark, binned):
    from creditloom.operators.metrics import discrimination

    space = boost.Space(trees=(4, 8, 2), learning_rate=(0.1, 0.3), depth=(3, 5), leaf_rows=(1, 30), row_share=(1, 1), column_share=(1, 1))
    few = boost.tune(binned, list("abcd"), "y", trials=3, space=space)
    spark.conf.set("spark.creditloom.oneTaskRows", "20")
    try:
        assert profiles.collapsed(binned, list("abcd"), "y", "split") is None
        rows = boost.tune(binned, list("abcd"), "y", trials=3, space=space)
    finally:
        spark.conf.unset("spark.creditloom.oneTaskRows")
    assert [a for a, _ in few.trials] == pytest.approx([a for a, _ in rows.trials], abs=1e-9)
    assert few.params == rows.params and few.model.totalNumNodes == rows.model.totalNumNodes
    assert few.model.featureImportances.toArray() == pytest.approx(rows.model.featureImportances.toArray())
    both = rows.score(few.score(binned, "p"), "q")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-9
    assert discrimination(both.where("split = 'valid'"), "p", "y").first()["auc"] == pytest.approx(few.valid_auc)


def test_profiles_sample_rows_and_features(spark, binned):
    few = profiles.collapsed(binned, list("abcd"), "y", "split")
    assert few.table.count() < binned.where("split != 'oot'").count()
    params = {"maxIter": 3, "maxDepth": 4, "subsamplingRate": 0.7, "featureSubsetStrategy": "0.5"}
    train = binned.where("split = 'train'").count()
    found = {seed: few.trees(params, seed).where("tree >= 0").orderBy("tree").collect() for seed in (1, 2)}
    roots = [t["count"][0] for trees in found.values() for t in trees]
    assert len(set(roots)) > 1 and all(abs(r - 0.7 * train) < 5 * np.sqrt(0.21 * train) for r in roots)
    assert [t["cut"] for t in found[1]] != [t["cut"] for t in found[2]]
    again = profiles.Profiles(few.table.repartition(7), few.cuts).trees(params, 1).where("tree >= 0").orderBy("tree").collect()
    assert again == found[1]  # the same draws however the profiles lie
    n = np.repeat([0.0, 1.0, 50.0], 4000)
    drawn = profiles.sampled(np.random.default_rng(0), n, 0.6)
    assert (drawn <= n).all() and drawn[8000:].mean() == pytest.approx(30, abs=0.3) and drawn[8000:].var() == pytest.approx(12, abs=1.5)


def test_profiles_leave_odd_rows_to_spark_ml(binned):
    few = lambda df: profiles.collapsed(df, ["a", "b"], "y", "split")
    assert few(binned) is not None
    for bad in (None, float("nan")):
        assert few(binned.withColumn("a", F.when(F.col("a") > 0, F.col("a")).otherwise(F.lit(bad).cast("double")))) is None
    assert few(binned.withColumn("y", F.col("y") * 2)) is None and few(binned.where("split = 'valid'")) is None
    assert few(binned.withColumn("b", F.rand(1))) is None
    assert not profiles.supported({"featureSubsetStrategy": "all"}) and not profiles.supported({"maxBins": 8})
    goods = boost.tune(binned.where("y = 0"), ["a", "b"], "y", trials=1, space=SPACE)  # one outcome: nothing to judge
    assert goods.trials[0][0] is None and goods.valid_auc == -1


@pytest.mark.parametrize("name", ["champion", "gbt_evaluation", "gbt_search", "importance", "monotone_audit"])
def test_registered_searches_are_whole(spark, monkeypatch, name):
    import inspect
    from types import SimpleNamespace

    from creditloom.plans import score_queries

    class Asked(Exception):
        pass

    def asked(*args, **more):
        raise Asked(signature.bind(*args, **more))

    signature = inspect.signature(boost.tune)
    monkeypatch.setattr(score_queries.boost, "tune", asked)
    monkeypatch.setattr(score_queries, "stage", lambda df, label: df)
    monkeypatch.setattr(score_queries, "fitted", lambda *_: (None, SimpleNamespace(features={"a": {}}, transform=lambda *_: None)))
    with pytest.raises(Asked) as e:
        score_queries.QUERIES[name](spark, "")
    call = e.value.args[0]
    call.apply_defaults()
    assert call.arguments["trials"] == 40 and call.arguments["space"] == boost.Space() and not call.arguments["done"]


# ----------------------------------------------------------------------------- policy


def test_profit_curve_and_best_cutoff(spark):
    rows = [(700, 0.0)] * 8 + [(700, 1.0)] * 0 + [(600, 0.0)] * 12 + [(600, 1.0)] + [(500, 0.0)] * 3 + [(500, 1.0)] * 3
    curve = policy.profit_curve(spark.createDataFrame(rows, "score int, y double"), "score", "y")
    got = {r["cutoff"]: r for r in curve.collect()}
    assert got[700]["profit"] == pytest.approx(8 * 244.5)
    assert got[600]["profit"] == pytest.approx(20 * 244.5 - 2472)
    assert (got[500]["goods"], got[500]["bads"], got[500]["approval_rate"]) == (23, 4, 1.0)
    best = policy.best_cutoff(curve).first()
    assert best["cutoff"] == 600


def test_fairness(spark):
    rows = [("f", 1, 0)] * 6 + [("f", 0, 0)] * 4 + [("m", 1, 0)] * 9 + [("m", 0, 1)]
    df = spark.createDataFrame(rows, "gender string, approved int, bad int")
    got = {r["level"]: r for r in policy.fairness(df, ["gender"], "approved", F.col("bad") == 0).collect()}
    assert got["f"]["disparate_impact"] == pytest.approx(0.6 / 0.9) and not got["f"]["impact_ok"]
    assert got["f"]["opportunity_gap"] == pytest.approx(0.4) and got["m"]["opportunity_ok"]


def test_reject_augmentation_and_refit(spark, book):
    wide = book.select("a", "y", (F.col("id") % 3 > 0).cast("int").alias("approved"), F.lit(0.2).alias("p"))
    twice = policy.fuzzy_augment(wide, "p", "approved", "y")
    approved = wide.where("approved = 1").count()
    rejected = wide.count() - approved
    assert twice.count() == approved + 2 * rejected
    assert twice.agg(F.sum("weight")).first()[0] == pytest.approx(wide.count())
    slopes, _ = policy.reject_inference(wide, ["a"], "p", "approved", "y")
    assert slopes["a"] < 0


def test_recalibration_restores_the_level(spark, book):
    z = -1.8 - 0.9 * F.col("a") - 0.6 * F.col("b")
    rows = book.select("y", (1 / (1 + F.exp(-(z * 1.7 + 1.0)))).alias("p"))
    slope, shift = policy.recalibrate(rows, "p", "y")
    fixed = rows.select(F.avg(policy.apply_recalibration(F.col("p"), slope, shift)), F.avg("y")).first()
    assert fixed[0] == pytest.approx(fixed[1], abs=1e-6)
    assert slope == pytest.approx(1 / 1.7, rel=0.15)


def test_reason_codes(spark, binning):
    rows = binning.transform(spark.createDataFrame([(-9.0, 9.0)], "a double, b double"), features=["a", "b"])
    codes = policy.reason_codes(rows, binning, {"a": -1.0, "b": -1.0}, 40.0, top=1)
    assert rows.select(codes).first()[0] == ["a"]


# ------------------------------------------------------------------ Newton and isotonic fits


def by_hand(x, y, w, penalty=0.0):
    """Coefficients and the curvature there, by plain Newton steps in numpy."""
    d = np.column_stack([x, np.ones(len(x))])
    held, beta = np.append(np.full(x.shape[1], penalty), 0), np.zeros(x.shape[1] + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-d @ beta))
        table = d.T @ (d * (w * p * (1 - p))[:, None])
        beta = beta - np.linalg.solve(table + np.diag(held), d.T @ (w * (p - y)) + held * beta)
    return beta, table


@pytest.mark.parametrize("weighted, penalty", [(False, 0.0), (True, 0.0), (True, 5.0)])
def test_newton_equals_numpy_in_few_passes(spark, weighted, penalty):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 3)) * [1, 3, 0.2]
    y = (rng.random(3000) < 1 / (1 + np.exp(2 - x @ [1.0, -0.5, 2.0]))).astype(float)
    w = rng.uniform(0.1, 2, 3000) if weighted else np.ones(3000)
    rows = [(a.tolist(), float(b), float(c)) for a, b, c in zip(x, y, w)]
    df = spark.createDataFrame(rows, "x array<double>, y double, w double").repartition(5)
    got = newton_fit(df, "x", "y", weight="w", penalty=penalty, size=3)
    beta, table = by_hand(x, y, w, penalty)
    assert np.abs(np.append(got.coefficients, got.intercept) - beta).max() < 1e-7 and got.passes <= 9
    assert got.information == pytest.approx(table, rel=1e-6)
    part = newton_fit(df, "x", "y", weight="w", penalty=penalty, places=[2, 0], start=np.array([beta[2], beta[0], beta[3]]))
    assert np.abs(np.append(part.coefficients, part.intercept) - by_hand(x[:, [2, 0]], y, w, penalty)[0]).max() < 1e-7
    far = newton_fit(df, "x", "y", weight="w", penalty=penalty, start=np.array([4.0, -9.0, 9.0, 5.0]))  # full steps alone diverge
    assert np.abs(np.append(far.coefficients, far.intercept) - beta).max() < 1e-6


def test_newton_on_constant_columns_and_without_outcomes(spark):
    df = spark.createDataFrame([([1.0, 2.0], float(i % 4 == 0)) for i in range(400)], "x array<double>, y double")
    got = newton_fit(df, "x", "y", size=2)
    z = got.coefficients @ [1.0, 2.0] + got.intercept
    assert 1 / (1 + np.exp(-z)) == pytest.approx(0.25)
    for lost in (None, float("nan")):
        with pytest.raises(QualityError):
            newton_fit(df.unionByName(spark.createDataFrame([([1.0, 2.0], lost)], df.schema)), "x", "y", size=2)


def test_every_fit_refuses_missing_outcomes(spark):
    rows = [(float(i % 7), float(i % 3 == 0), 1, 0.3) for i in range(60)] + [(1.0, None, 1, 0.3)]
    df = spark.createDataFrame(rows, "woe_a double, y double, approved int, p double")
    info = woe.Binning([], {"a": {"iv": 0.5}})
    for fit in (
        lambda: scorecard.fit_scorecard(df, info, "y"), lambda: boost.train(df, ["woe_a"], "y", {"maxIter": 1}),
        lambda: policy.recalibrate(df, "p", "y"), lambda: policy.reject_inference(df, ["woe_a"], "p", "approved", "y"),
        lambda: isotonic.isotonic_steps(df, "p", "y").collect(),
    ):
        with pytest.raises(QualityError):
            fit()


def plain_pools(cells):
    out = []
    for s, n, b in cells:
        out.append([s, s, n, b])
        while len(out) > 1 and out[-2][3] / out[-2][2] >= out[-1][3] / out[-1][2] - 1e-15:
            last = out.pop()
            out[-1] = [out[-1][0], last[1], out[-1][2] + last[2], out[-1][3] + last[3]]
    return out


@pytest.mark.parametrize("partitions", ["4", "40"])
def test_isotonic_steps(spark, partitions):
    rng = np.random.default_rng(5)
    p = np.round(rng.random(6000), 3)
    p[:2000] = 0.25  # a score that a third of all rows share
    y = (rng.random(6000) < 0.1 + 0.5 * p**2).astype(int)
    pdf = pd.DataFrame({"p": p, "y": y.astype(float)})
    df = spark.createDataFrame(pdf)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = isotonic.isotonic_steps(df.unionByName(spark.createDataFrame([(None, 1.0), (float("nan"), 0.0)], "p double, y double")), "p", "y").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    cells = [(s, len(g), g.sum()) for s, g in pdf.groupby("p")["y"]]
    assert [(r.low, r.high, r.n, r.bads) for r in got] == [tuple(b) for b in plain_pools(cells)]
    assert [r.step for r in got] == list(range(len(got))) and all(a.rate < b.rate for a, b in zip(got, got[1:]))
    theirs = IsotonicRegression(featuresCol="p", labelCol="y").fit(df)
    steps = [(r.high, r.rate) for r in got]
    both = isotonic.calibrated(theirs.transform(df), "p", steps).select(F.max(F.abs(F.col("prediction") - F.col("calibrated")))).first()
    assert both[0] < 1e-12
    odd = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "p double")
    assert [r.calibrated for r in isotonic.calibrated(odd, "p", steps).collect()] == [steps[0][1], steps[-1][1], None]
    assert isotonic.isotonic_steps(df.limit(0), "p", "y").count() == 0


def test_a_search_that_was_cut_off_goes_on_from_its_table(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"woe_a": rng.normal(size=600), "woe_b": rng.normal(size=600)})
    pdf["y"] = (rng.random(600) < 1 / (1 + np.exp(1 + pdf.woe_a))).astype(float)
    pdf["split"] = np.where(np.arange(600) % 4 == 0, "valid", "train")
    df, store, ran, real = spark.createDataFrame(pdf), str(tmp_path / "trials"), [], boost._fit
    space = boost.Space(trees=(2, 6, 1), depth=(2, 3), leaf_rows=(5, 20))

    def fit(*args):
        if len(ran) == 2:
            raise RuntimeError("the machine was lost")
        ran.append(args[3])
        return real(*args)

    monkeypatch.setattr(boost, "_fit", fit)
    with pytest.raises(RuntimeError):
        boost.tune(df, ["woe_a", "woe_b"], "y", name="one", trials=4, space=space, store=store)
    assert boost.stored_trials(spark, store).count() == 2
    monkeypatch.setattr(boost, "_fit", lambda *args: (ran.append(args[3]), real(*args))[1])
    resumed = boost.tune(df, ["woe_a", "woe_b"], "y", name="one", trials=4, space=space, store=store)
    assert len({boost.text_of(p) for p in ran}) == 4 and len(resumed.trials) == 4  # two before, two now, the winner once more at most
    whole = boost.tune(df, ["woe_a", "woe_b"], "y", name="one", trials=4, space=space)
    assert [t[0] for t in whole.trials] == pytest.approx([t[0] for t in resumed.trials]) and whole.params == resumed.params
    n = len(ran)
    again = boost.tune(df, ["woe_a", "woe_b"], "y", name="one", trials=4, space=space, store=store)
    assert len(ran) == n + 1 and again.valid_auc == pytest.approx(whole.valid_auc)  # only the winner is fitted
    boost.tune(df, ["woe_a"], "y", name="two", trials=1, space=space, store=store)
    assert {r["search"]: r["n"] for r in boost.stored_trials(spark, store).groupBy("search").agg(F.count("*").alias("n")).collect()} == {"one": 4, "two": 1}
