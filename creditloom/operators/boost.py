"""Boosted-tree challengers on weight-of-evidence columns."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from creditloom.config import SEED
from creditloom.operators import profiles
from creditloom.operators.metrics import discrimination, evaluate
from creditloom.operators.quality import require_outcomes


@dataclass(frozen=True)
class Space:
    """Ranges of the search; the defaults are fixed values."""

    trees: tuple[int, int, int] = (200, 1200, 100)
    learning_rate: tuple[float, float] = (0.01, 0.12)
    depth: tuple[int, int] = (3, 9)
    leaf_rows: tuple[int, int] = (20, 300)
    row_share: tuple[float, float] = (0.6, 1.0)
    column_share: tuple[float, float] = (0.5, 1.0)

    def draw(self, rng: random.Random) -> dict:
        def log_uniform(low: float, high: float) -> float:
            return math.exp(rng.uniform(math.log(low), math.log(high)))

        low, high, step = self.trees
        return {
            "maxIter": rng.randrange(low, high + 1, step),
            "stepSize": log_uniform(*self.learning_rate),
            "maxDepth": rng.randint(*self.depth),
            "minInstancesPerNode": round(log_uniform(*self.leaf_rows)),
            "subsamplingRate": rng.uniform(*self.row_share),
            "featureSubsetStrategy": f"{rng.uniform(*self.column_share):.4f}",
        }


TRIAL_SCHEMA = "trial int, valid_auc double, params map<string,string>"


@dataclass
class Tuned:
    """The refitted best model of one search."""

    name: str
    model: GBTClassificationModel
    params: dict
    valid_auc: float
    features: list[str]
    trials: list[tuple] = field(default_factory=list)

    def score(self, df: DataFrame, name: str = "p") -> DataFrame:
        """Add the probability of default."""
        out = self.model.transform(assemble(df, self.features))
        kept = [c for c in out.columns if c not in ("_x", "rawPrediction", "probability", "prediction")]
        return out.select(*kept, vector_to_array("probability")[1].alias(name))

    def trial_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, auc, {k: str(v) for k, v in p.items()}) for i, (auc, p) in enumerate(self.trials)]
        return spark.createDataFrame(rows, TRIAL_SCHEMA)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_x").transform(df)


def monotone_vector(features: Sequence[str], priors: Mapping[str, int]) -> list[int]:
    """Expected sign of each feature on the probability of default."""
    return [-priors.get(f, 0) for f in features]


def woe_signs(features: Sequence[str]) -> dict[str, int]:
    """A higher weight of evidence is safer whatever the raw feature does."""
    return {f: -1 for f in features}


def train(df: DataFrame, features: Sequence[str], y: str, params: Mapping, seed: int = SEED):
    """Fit one boosted classifier; every row needs an outcome."""
    return _fit(require_outcomes(df, y), features, y, params, seed)


def _fit(df: DataFrame, features: Sequence[str], y: str, params: Mapping, seed: int):
    vectors = df if "_x" in df.columns else assemble(df, features)
    booster = GBTClassifier(featuresCol="_x", labelCol=y, seed=seed, **params)
    return booster.fit(vectors)


def tune(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    *,
    name: str = "gbt",
    trials: int = 40,
    space: Space = Space(),
    seed: int = SEED,
    done: Sequence[tuple] = (),
    split: str = "split",
    store: str | None = None,
) -> Tuned:
    """Seeded random search, judged by AUC on the validation split only.

    ``done`` holds trials finished earlier as (auc, params); they are not run again. ``store`` names a table of
    trials in a shared folder: each trial is appended when it ends, and a search that was cut off goes on with the draws
    that the table lacks. The winner is the model whose own validation AUC is best, and that fitted model is what is returned.
    """
    rng = random.Random(seed)
    draws = [space.draw(rng) for _ in range(trials)]
    found: dict[int, tuple] = {i: tuple(t) for i, t in enumerate(list(done)[:trials])}
    if store is not None:
        known = {(r["trial"], r["params"]): r["valid_auc"] for r in stored_trials(df.sparkSession, store).where(F.col("search") == name).collect()}
        for i, params in enumerate(draws):
            if (i, text_of(params)) in known:
                found.setdefault(i, (known[i, text_of(params)], params))
    require_outcomes(df.where(F.col(split) == "train"), y)
    few = profiles.collapsed(df, features, y, split)

    def keep(i: int, auc: float | None) -> None:
        found[i] = (auc, draws[i])
        if store is not None:
            store_trial(df.sparkSession, store, name, i, auc, draws[i])

    if few is not None and all(map(profiles.supported, [*draws, *[p for _, p in found.values()]])):
        best = _search_profiles(few, draws, found, keep, y, seed)
    else:
        best = _search_rows(df, features, draws, found, keep, y, seed, split)
    results = [found[i] for i in sorted(found)]
    best_auc = -1.0 if best[2] is None else best[2]
    return Tuned(name, best[0], best[1], float(best_auc), list(features), results)


def _top(found: Mapping[int, tuple]) -> int:
    """The trial with the best AUC, the first of equal ones."""
    judged = [i for i in sorted(found) if found[i][0] is not None]
    return max(judged, key=lambda i: found[i][0], default=min(found))


def _search_profiles(few: profiles.Profiles, draws: list[dict], found: dict, keep: Callable, y: str, seed: int) -> tuple:
    """Trials side by side, the longest first, each a task over the profiles: the winner with its parameters and AUC."""
    spark, trees = few.table.sparkSession, {}

    @inheritable_thread_target(spark)
    def run(i: int) -> tuple[int, DataFrame, float | None]:
        grown = few.trees(draws[i], seed)
        return i, grown, grown.where("tree < 0").first()["auc"]

    todo = sorted((i for i in range(len(draws)) if i not in found), key=lambda i: -draws[i]["maxIter"] * draws[i]["maxDepth"])
    with ThreadPoolExecutor(max(2, spark.sparkContext.defaultParallelism)) as pool:
        ended = [pool.submit(run, i) for i in todo]
        try:
            for future in as_completed(ended):
                i, trees[i], auc = future.result()
                keep(i, auc)
        finally:
            pool.shutdown(wait=False, cancel_futures=True)
    top = _top(found)
    auc, params = found[top]
    grown = trees[top] if top in trees else few.trees(params, seed)
    return profiles.as_model(spark, grown, few.cuts, params, y, seed), params, auc


def _search_rows(df: DataFrame, features: Sequence[str], draws: list[dict], found: dict, keep: Callable, y: str, seed: int, split: str) -> tuple:
    """Trials one after another, each over all rows: the winner with its parameters and AUC."""
    vectors = assemble(df, features)
    fitting = vectors.where(F.col(split) == "train").select("_x", y).persist(StorageLevel.MEMORY_AND_DISK)
    judging = vectors.where(F.col(split) == "valid").select("_x", y).persist(StorageLevel.MEMORY_AND_DISK)
    best, best_auc = None, -1.0
    try:
        for i, params in enumerate(draws):
            if i in found:
                continue
            model = _fit(fitting, features, y, params, seed)
            p = model.transform(judging).select(vector_to_array("probability")[1].alias("p"), y)
            auc = discrimination(p, "p", y).first()["auc"]
            keep(i, auc)
            if auc is not None and auc > best_auc:
                best, best_auc = (model, params), auc
        top_auc, top_params = found[_top(found)]
        if best is None or (top_auc or 0) > best_auc:
            best = (_fit(fitting, features, y, top_params, seed), top_params)
            best_auc = top_auc
    finally:
        fitting.unpersist()
        judging.unpersist()
    return *best, best_auc


STORED_SCHEMA = "search string, trial int, params string, valid_auc double"


def text_of(params: Mapping) -> str:
    """A draw as text that is the same wherever the draw is."""
    return json.dumps(dict(params), sort_keys=True)


def stored_trials(spark: SparkSession, path: str) -> DataFrame:
    """All finished trials of the searches that share a table; none if there is no table yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], STORED_SCHEMA)
    return spark.read.schema(STORED_SCHEMA).parquet(path)


def store_trial(spark: SparkSession, path: str, search: str, trial: int, auc: float | None, params: Mapping) -> None:
    row = [(search, trial, text_of(params), None if auc is None else float(auc))]
    spark.createDataFrame(row, STORED_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def importance(model, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Impurity importance of every feature with its share of the total, highest first."""
    values = model.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values, strict=True)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    total = max(float(values.sum()), 1e-12)
    shares = table.withColumn("share_pct", F.round(100 * F.col("importance") / total, 2))
    return shares.orderBy(F.desc("importance"), "feature")


def monotone_audit(
    df: DataFrame, tuned: Tuned, grids: Mapping[str, Sequence[float]]
) -> DataFrame:
    """Share of neighbouring bin weights between which the risk rises, per feature.

    Rows that agree in every feature are scored once and weighted by their number. Each such
    profile is scored at both ends of every step of every feature; steps are bins, so the
    fan-out is fixed by the model and nothing is regrouped by row.
    """
    features = tuned.features
    steps = [
        F.struct(F.lit(f).alias("feature"), F.lit(float(a)).alias("low"), F.lit(float(b)).alias("high"))
        for f in features
        for a, b in zip(sorted(set(grids[f])), sorted(set(grids[f]))[1:])
    ]
    profiles = df.groupBy(*features).agg(F.count(F.lit(1)).alias("rows"))
    varied = profiles.select("*", F.inline(F.array(*steps)))

    def at(end: str) -> list:
        return [F.when(F.col("feature") == f, F.col(end)).otherwise(F.col(f)).alias(f) for f in features]

    low = tuned.score(
        varied.select("feature", "rows", "high", *[F.col(f).alias(f"_{f}") for f in features], *at("low")),
        "p_low",
    )
    back = [
        F.when(F.col("feature") == f, F.col("high")).otherwise(F.col(f"_{f}")).alias(f) for f in features
    ]
    both = tuned.score(low.select("feature", "rows", "p_low", *back), "p_high")
    wrong = F.when(F.col("p_high") - F.col("p_low") > 1e-12, F.col("rows")).otherwise(0)
    return both.groupBy("feature").agg(
        F.sum("rows").alias("steps"),
        (F.sum(wrong) / F.sum("rows")).alias("violation_share"),
    )


def evaluate_model(df: DataFrame, tuned: Tuned, y: str, tie: str, split: str = "split") -> DataFrame:
    return evaluate(tuned.score(df), "p", y, tie, by=split)


def summary_row(evaluation: DataFrame, name: str) -> DataFrame:
    """The comparison row of one model from its per-split evaluation, not rounded."""

    def of(split: str, column: str):
        return F.max(F.when(F.col("split") == split, F.col(column)))

    return evaluation.agg(
        F.lit(name).alias("model"),
        of("valid", "auc").alias("valid_auc"),
        of("oot", "auc").alias("oot_auc"),
        of("oot", "gini").alias("oot_gini"),
        of("oot", "ks").alias("oot_ks"),
        of("oot", "calibration_ratio").alias("oot_calibration_ratio"),
    )


def champion(comparison: DataFrame, eligible: Sequence[str]) -> DataFrame:
    """The eligible model with the best validation AUC (ties by name)."""
    pool = comparison.where(F.col("model").isin(list(eligible)))
    return pool.agg(F.max_by("model", F.struct("valid_auc", "model")).alias("champion"))


def uplift(comparison: DataFrame, challenger: str, baseline: str) -> DataFrame:
    """Difference of out-of-time Gini between two rows of the comparison."""

    def gini(name: str):
        return F.max(F.when(F.col("model") == name, F.col("oot_gini")))

    return comparison.agg((gini(challenger) - gini(baseline)).alias("uplift"))
