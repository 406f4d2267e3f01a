"""Fit the scorecard and its boosted challengers from the written views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import contract
from creditloom.functions.expr import present, union_all
from creditloom.operators import boost
from creditloom.operators.bootstrap import gini_difference
from creditloom.operators.metrics import evaluate
from creditloom.operators.quality import join_one_to_one
from creditloom.operators.scorecard import Scorecard, fit_scorecard
from creditloom.operators.woe import Binning
from creditloom.plans.common import tidy
from creditloom.sources.io import read_view, write_metrics
from creditloom.sources.staging import stage


#: Features that the importance report names; ``boost.importance`` returns all of them.
IMPORTANCE_REPORTED = 20


def tie_key(df: DataFrame, key: str = contract.ID) -> DataFrame:
    """Integer tie-break for text keys, the same in every plan."""
    return df.withColumn("_tie", F.xxhash64(key))


def scorecard_stage(spark: SparkSession, folder: str) -> tuple[Scorecard, DataFrame]:
    """Fit on train, score every split, write the card, its scores and its evaluation."""
    binning = Binning.load(spark, folder)
    card = fit_scorecard(read_view(spark, f"{folder}/woe", "train"), binning, contract.TARGET)
    card.save(spark, folder)
    woe = read_view(spark, f"{folder}/woe")
    scored = card.apply(woe, [contract.ID, "split", F.col(contract.TARGET).alias("y")])
    scored.write.mode("overwrite").parquet(f"{folder}/scored")
    rows = tie_key(spark.read.parquet(f"{folder}/scored"))
    report = evaluate(rows, "p", "y", "_tie", by="split")
    write_metrics(report, f"{folder}/metrics-scorecard")
    return card, report


def _card_scores(spark: SparkSession, folder: str) -> DataFrame | None:
    """Scores that the card stage wrote, if it ran."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/scored")
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tie_key(spark.read.parquet(f"{folder}/scored")) if store.exists(path) else None


#: Stands for a missing raw number: below all others, so a tree can split it off.
BELOW_ALL = -1e15


def _raw_matrix(raw: DataFrame, binning: Binning) -> tuple[DataFrame, list[str]]:
    """Raw numbers, with missing ones below all others, and the weights of text features, which have no order."""
    numbers = [f for f, v in binning.features.items() if v["kind"] == "numeric"]
    texts = [f for f, v in binning.features.items() if v["kind"] != "numeric"]
    carry = [contract.ID, "split", contract.TARGET]
    filled = raw.withColumns({f: F.when(present(f), F.col(f).cast("double")).otherwise(BELOW_ALL) for f in numbers})
    return binning.transform(filled, [*carry, *numbers], texts), [*numbers, *(f"woe_{f}" for f in texts)]


def challenger_stage(
    spark: SparkSession,
    folder: str,
    *,
    searches: Sequence[tuple[str, int, boost.Space]] = (("gbt", 40, boost.Space()),),
    free: tuple[str, int, boost.Space] | None = None,
    replicates: int = 2000,
) -> dict[str, DataFrame]:
    """Search, choose by validation AUC, and test the champion against the scorecard.

    Choice and uplift use unrounded figures; the comparison that is returned has four places.
    Without a written card there is no card row, no uplift and no contest. Finished trials are kept in ``trials``
    under the folder, so a stage that was cut off goes on.

    Searches run on monotone weights. ``free`` is one more, on the raw numbers: it takes no part in the choice, and its
    out-of-time Gini less that of the first search is what the monotone bins cost (``constraint_cost``).
    """
    binning = Binning.load(spark, folder)
    features = [f"woe_{f}" for f in binning.features]
    woe = read_view(spark, f"{folder}/woe")
    rows = []
    tuned = {}
    unbound, raw_features = None, []
    if free is not None:
        unbound, raw_features = _raw_matrix(read_view(spark, f"{folder}/raw"), binning)
    for name, trials, space in (*searches, *([free] if free else [])):
        view, own = (unbound, raw_features) if free and name == free[0] else (woe, features)
        tuned[name] = boost.tune(
            view, own, contract.TARGET, name=name, trials=trials, space=space, store=f"{folder}/trials"
        )
        tuned[name].model.write().overwrite().save(f"{folder}/model-{name}")
        scored = stage(
            tie_key(tuned[name].score(view)).select(
                contract.ID, "_tie", "split", F.col(contract.TARGET).alias("y"), "p"
            ),
            f"scored-{name}",
        )
        report = evaluate(scored, "p", "y", "_tie", by="split")
        rows.append((name, scored, boost.summary_row(report, name)))
    card_scores = _card_scores(spark, folder)
    parts = [row for _, _, row in rows]
    if card_scores is not None:
        card_report = evaluate(card_scores, "p", "y", "_tie", by="split")
        parts.insert(0, boost.summary_row(card_report, "scorecard"))
    comparison = stage(union_all(parts), "comparison")
    best = boost.champion(comparison, [name for name, _, _ in searches]).first()["champion"]
    out = {
        "comparison": tidy(comparison, 4),
        "importance": boost.importance(tuned[best].model, features, spark).limit(IMPORTANCE_REPORTED),
    }
    if free is not None:
        cost = boost.uplift(comparison, free[0], searches[0][0])
        out["constraint_cost"] = cost.withColumnRenamed("uplift", "constraint_cost")
    if card_scores is None:
        return out
    theirs = next(s for n, s, _ in rows if n == best).where("split = 'oot'")
    ours = card_scores.where("split = 'oot'").select(contract.ID, F.col("p").alias("card_p"))
    out["uplift"] = boost.uplift(comparison, best, "scorecard")
    out["contest"] = gini_difference(
        stage(join_one_to_one(theirs, ours, contract.ID), "contest"),
        "p",
        "card_p",
        "y",
        replicates=replicates,
    )
    return out
