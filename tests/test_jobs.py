"""Sources, end-to-end jobs and streams on small written tables."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from creditloom import contract
from creditloom.operators import boost, quality, split
from creditloom.operators.scorecard import Scorecard
from creditloom.operators.woe import Binning
from creditloom.plans import features, models
from creditloom.sources import io, staging
from creditloom.streaming import events, monitor


def test_contract_counts(spark):
    assert len(contract.FEATURES) == 61 and len(contract.MODELLED) == 58
    assert len(contract.NUMERIC) == 56 and contract.CATEGORICAL == ("segment", "device_tier")
    assert len(contract.PROTECTED) == 3 and len(contract.DERIVED) == 7
    signs = list(contract.PRIORS.values())
    assert (signs.count(1), signs.count(-1), len(contract.MODELLED) - len(signs)) == (25, 20, 13)
    assert len(contract.APPLICATION_SCHEMA) == 59 and len(contract.CONTRACT) == 10
    table = contract.feature_frame(spark)
    assert table.count() == 61
    assert table.where("feature = 'tenure_days'").first()["risk_direction"] == "lower risk"


@pytest.fixture(scope="module")
def book(spark, tmp_path_factory):
    """A written application book drawn with a fixed seed."""
    rng = np.random.default_rng(42)
    n = 3000
    trait = rng.normal(size=n)
    columns = {
        contract.ID: [f"MK{i:07d}" for i in range(n)],
        contract.DATE: [dt.datetime(2024, 1, 1) + dt.timedelta(days=int(d)) for d in rng.integers(0, 540, n)],
    }
    months = np.array([(d - dt.datetime(2024, 1, 1)).days // 30 for d in columns[contract.DATE]])
    columns[contract.MONTH] = months
    for f in contract.FEATURES:
        if f.name in contract.DERIVED:
            continue
        pull = f.metadata["direction"] * trait * (0.5 if len(f.name) % 3 else 0.1)
        if f.dataType == contract.TEXT:
            columns[f.name] = rng.choice([f"{f.name}-{i}" for i in range(4)], n)
        elif f.dataType == contract.LONG:
            columns[f.name] = rng.poisson(np.exp(0.8 + pull * 0.3))
        else:
            columns[f.name] = np.round(np.exp(pull + rng.normal(0, 1, n)), 4)
        if f.nullable:
            columns[f.name] = np.where(rng.random(n) < 0.1, np.nan, columns[f.name])
    columns[contract.APPROVED] = (rng.random(n) < 0.8).astype(int)
    outcome = (rng.random(n) < 1 / (1 + np.exp(1.6 + trait))).astype(float)
    columns[contract.TARGET] = np.where(columns[contract.APPROVED] == 1, outcome, np.nan)
    df = spark.createDataFrame(pd.DataFrame(columns))
    df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.APPLICATION_SCHEMA])
    path = str(tmp_path_factory.mktemp("book") / "applications")
    io.write_book(df, path)
    return path


@pytest.fixture(scope="module")
def built(spark, book, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("views"))
    return out, features.build_features(spark, io.read_applications(spark, book), out)


def test_read_reports_a_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException):
        io.read_applications(spark, str(tmp_path / "absent"))


def test_read_turns_nan_into_null(spark, book):
    row = io.read_applications(spark, book).agg(
        F.count_if(F.isnan(contract.TARGET)), F.count_if(F.col(contract.TARGET).isNull())
    ).first()
    assert row[0] == 0 and row[1] > 0


def test_split_is_stable_and_complete(spark, book):
    df = io.read_applications(spark, book)
    one = split.time_split(df).select(contract.ID, "split", contract.MONTH)
    two = split.time_split(df.repartition(13)).select(contract.ID, F.col("split").alias("again"))
    both = one.join(two, contract.ID).cache()
    assert both.where("split <> again").count() == 0
    assert both.count() == df.where("approved = 1").count()
    assert both.where("(split = 'oot') <> (application_month >= 14)").count() == 0
    in_time = both.where("split <> 'oot'")
    assert in_time.where("split = 'valid'").count() / in_time.count() == pytest.approx(0.2, abs=0.04)
    assert split.time_split(df, approved_only=False).count() == df.count()
    other = split.time_split(df, seed=7).where("split = 'valid'").select(contract.ID)
    assert other.exceptAll(both.where("split = 'valid'").select(contract.ID)).count() > 0


def test_build_features_writes_the_views(spark, built):
    out, binning = built
    raw, woe = io.read_view(spark, f"{out}/raw"), io.read_view(spark, f"{out}/woe")
    assert raw.count() == woe.count()
    assert set(contract.MODELLED) <= set(raw.columns) and set(contract.PROTECTED) <= set(raw.columns)
    assert {f"woe_{f}" for f in contract.MODELLED} <= set(woe.columns)
    train = io.read_view(spark, f"{out}/raw", "train")
    assert "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().toString()
    assert sum(b["count"] for b in binning.of("tenure_days")) == train.count()
    for f in contract.NULLABLE:
        assert binning.of(f)[-1]["is_missing"]
    assert set(Binning.load(spark, out).features) == set(contract.MODELLED)


def test_matrices_and_written_views_agree(spark, book, built):
    _, written = built
    _, binning = features.build_matrices(io.read_applications(spark, book))
    for f in ("tenure_days", "buffer_days", "segment"):
        assert [b["woe"] for b in binning.of(f)] == pytest.approx([b["woe"] for b in written.of(f)])


def test_models_end_to_end(spark, built):
    out, _ = built
    card, report = models.scorecard_stage(spark, out)
    assert all(c <= 0 for c in card.coefficients.values()) and len(card.features) >= 2
    rows = {r["split"]: r for r in report.collect()}
    assert set(rows) == {"train", "valid", "oot"} and rows["train"]["auc"] > 0.65
    assert Scorecard.load(spark, out).intercept == card.intercept
    found = models.challenger_stage(
        spark, out,
        searches=[("gbt", 1, boost.Space(trees=(3, 3, 1), depth=(2, 2)))],
        free=("raw", 1, boost.Space(trees=(3, 3, 1), depth=(2, 2))),
        replicates=40,
    )
    gini = {r["model"]: r["oot_gini"] for r in found["comparison"].collect()}
    assert set(gini) == {"scorecard", "gbt", "raw"}
    assert found["constraint_cost"].first()["constraint_cost"] == pytest.approx(gini["raw"] - gini["gbt"], abs=2e-4)
    assert boost.stored_trials(spark, f"{out}/trials").count() == 2
    contest = found["contest"].first()
    assert contest["ci_low"] <= contest["difference"] <= contest["ci_high"]
    assert found["importance"].count() <= 20


def test_metrics_record(spark, tmp_path):
    schema = "split string, auc double"
    path = str(tmp_path / "metrics")
    assert io.read_metrics(spark, path, schema).count() == 0
    io.write_metrics(spark.createDataFrame([("oot", 0.8)], schema), path)
    assert [tuple(r) for r in io.read_metrics(spark, path, schema).collect()] == [("oot", 0.8)]


def test_levels_unseen_in_train_become_null(spark):
    df = spark.createDataFrame(
        [(1, "train", "a"), (2, "train", None), (3, "oot", "a"), (4, "oot", "z")], "id long, split string, lv string"
    )
    got = {r["id"]: r["lv"] for r in io.align_levels(df, ["lv"]).collect()}
    assert got == {1: "a", 2: None, 3: "a", 4: None}


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (1, float("inf"), None), (2, None, 1.0)], "id long, x double, y double")
    with pytest.raises(quality.QualityError, match="absent"):
        quality.require_columns(df, ["x", "absent"])
    with pytest.raises(quality.QualityError, match="infinite"):
        quality.require_finite(df)
    with pytest.raises(quality.QualityError, match="no observed outcome"):
        quality.require_outcomes(df, "y")
    with pytest.raises(Exception, match="id is not unique, e.g. 1"):
        quality.join_one_to_one(df, df, "id").collect()
    row = quality.quality_counts(df, ["x"], "y").first()
    assert (row["rows"], row["without_outcome"], row["infinite_values"]) == (3, 1, 1)
    rates = quality.missing_rates(df.select("id", "x", "y"), ["id", "x", "y"]).collect()
    assert [(r["feature"], round(r["missing_rate"], 4)) for r in rates] == [("x", 0.3333), ("y", 0.3333)]


def test_an_empty_split_has_no_dates(spark):
    df = spark.createDataFrame([], "split string, y double, d timestamp_ntz")
    assert split.describe_splits(df, y="y", date="d").count() == 0


def test_staging_uses_the_shared_folder(spark):
    folder = staging.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    staged = staging.stage(spark.range(5), "five")
    assert staged.count() == 5 and folder in staged.inputFiles()[0]


# ---------------------------------------------------------------------------- streams


@pytest.fixture
def event_folder(spark, tmp_path):
    folder = str(tmp_path / "events")
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    batches = [
        [(1, day(1, 23), 1, "signup", 5.0, '{"k": 1}'), (2, day(2, 12), 1, "error", 1.0, '{"k": 2}')],
        [(3, day(20), 1, "purchase", 2.0, '{"k": 1}')],
        [(6, day(21), 3, "view", 2.0, '{"k": 1}')],
        [(4, day(1, 5), 1, "signup", 9.0, '{"k": 1}'), (5, day(28), 2, "view", 1.0, '{"k": 1}')],
    ]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, events.EVENT_SCHEMA).coalesce(1)
        df.write.parquet(f"{folder}/{i}")
        for name in os.listdir(f"{folder}/{i}"):  # streams read files oldest first
            os.utime(f"{folder}/{i}/{name}", (1_700_000_000 + 60 * i,) * 2)
    return folder


def run(spark, stream, tmp_path, name):
    job = (
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-cp"))
        .trigger(availableNow=True).start(str(tmp_path / name))
    )
    job.awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_windows_close_and_late_events_are_left_out(spark, event_folder, tmp_path):
    source = events.read_events(spark, f"{event_folder}/*", files_per_trigger=1)
    got = run(spark, events.windowed_activity(source, lateness="1 day", size="1 day"), tmp_path, "w").collect()
    first = next(r for r in got if r["start"] == dt.datetime(2024, 1, 1))
    # the event of 1 January that arrives after 20 January is too late
    assert (first["events"], first["amount"], first["night_share"]) == (1, 5.0, 1.0)
    assert not any(r["start"] == dt.datetime(2024, 1, 28) for r in got)


def test_a_backlog_gives_the_same_windows_in_any_files(spark, event_folder, tmp_path):
    """The files hold late events; read as one backlog, none is lost whatever the files."""
    rows = spark.read.schema(events.EVENT_SCHEMA).parquet(f"{event_folder}/*")
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    rows.orderBy(F.desc("ts")).repartition(5).write.parquet(str(tmp_path / "five"))
    found = []
    for source in (str(tmp_path / "one"), str(tmp_path / "five"), f"{event_folder}/*"):
        name = f"b{len(found)}"
        stream = events.windowed_activity(events.read_events(spark, source), size="1 day")
        found.append(sorted(map(tuple, run(spark, stream, tmp_path, name).collect())))
    assert found[0] and found[0] == found[1] == found[2]


def test_sliding_windows_and_sessions(spark, event_folder, tmp_path):
    source = events.read_events(spark, f"{event_folder}/[01]", files_per_trigger=10)
    sliding = events.windowed_activity(source, size="2 days", slide="1 day")
    got = run(spark, sliding, tmp_path, "s").collect()
    assert sorted(r["events"] for r in got) == [1, 1, 2]
    source = events.read_events(spark, f"{event_folder}/[01]", files_per_trigger=10)
    got = run(spark, events.sessions(source, gap="14 hours"), tmp_path, "ss").collect()
    assert [(r["events"], r["start"], r["end"]) for r in got] == [
        (2, dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 3, 2))
    ]


def test_drift_per_micro_batch(spark, tmp_path):
    rng = np.random.default_rng(9)
    ref = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=500)}))
    edges, shares = monitor.reference_shares(ref, ["x"])
    for i, shift in enumerate((0.0, 2.0)):
        part = pd.DataFrame({"x": rng.normal(shift, 1, 500)})
        spark.createDataFrame(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(i)))
    stream = (
        spark.readStream.schema("x double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    )
    seen = {}

    def sink(found, batch_id):
        seen[batch_id] = found.first()["verdict"]

    monitor.watch(stream, edges, shares, sink, checkpoint=str(tmp_path / "cp")).awaitTermination()
    assert sorted(seen.values()) == ["stable", "unstable"]


def test_daily_drift_counts_do_not_depend_on_files(spark, tmp_path):
    rng = np.random.default_rng(31)
    n = 600
    pdf = pd.DataFrame(
        {"ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 6 * 86400, n), unit="s"), "x": rng.normal(size=n)}
    )
    pdf.loc[:20, "x"] = np.nan
    live = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp"))
    edges = {"x": [-0.5, 0.5]}
    for files in (1, 5):
        live.repartition(files).write.parquet(str(tmp_path / f"in{files}"))
        stream = spark.readStream.schema(live.schema).parquet(str(tmp_path / f"in{files}"))
        job = (
            monitor.daily_cells(stream, edges)
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / f"cp{files}"))
            .trigger(availableNow=True)
            .start(str(tmp_path / f"out{files}"))
        )
        job.awaitTermination()
        got = spark.read.parquet(str(tmp_path / f"out{files}")).toPandas()
        day = pdf["ts"].dt.date
        closed = pdf[(pdf["ts"].dt.normalize() + pd.Timedelta(days=2) <= pdf["ts"].max()) & pdf["x"].notna()]
        place = np.searchsorted(edges["x"], closed["x"]).astype(str)
        expected = closed.groupby([day[closed.index], place]).size().to_dict()
        assert {(r.day, r.place): r.n for r in got.itertuples()} == expected and len(expected) > 6


def test_the_checked_join_is_one_shuffle(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (None, "n")], "id long, v string")
    right = spark.createDataFrame([(2, 0.5), (1, None), (4, 1.0)], "id long, w double")
    joined = quality.join_one_to_one(left, right, "id")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, joined.collect())) == [(1, "a", None), (2, None, 0.5)]
    assert joined.columns == ["id", "v", "w"]
    for twice in ([(2, 0.5), (2, 0.5)], [(9, 0.5), (9, None)], [(None, 1.0), (None, 2.0)]):
        with pytest.raises(Exception, match="not unique"):
            quality.join_one_to_one(left, spark.createDataFrame(twice, "id long, w double"), "id").collect()
    assert quality.join_one_to_one(left, right.limit(0), "id").count() == 0


def test_levels_of_many_columns(spark, monkeypatch):
    rows = [(1, "train", "a", 5), (2, "train", None, 6), (3, "valid", "b", 5), (4, "oot", "a", 9), (5, "oot", None, None)]
    df = spark.createDataFrame(rows, "id int, split string, x string, k int")
    want = [(1, "a", 5), (2, None, 6), (3, None, 5), (4, "a", None), (5, None, None)]
    for limit in (1000, 1):  # sets in the plan, or joins
        monkeypatch.setattr(io, "LISTED_LEVELS", limit)
        got = io.align_levels(df, ["x", "k"])
        assert got.dtypes == df.dtypes and [(r.id, r.x, r.k) for r in got.orderBy("id").collect()] == want
    assert io.align_levels(df.where("split = 'oot'"), ["x", "k"]).select("x", "k").distinct().collect() == [(None, None)]
