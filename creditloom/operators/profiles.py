"""Boosted trees on collapsed rows: rows that agree in every bin are one profile with its counts.

Weights of evidence have few values, so a book of any length has as many profiles as combinations of bins occur. The
trees are those of ``GBTClassifier`` (log loss, variance gain, every midpoint a cut, leaves at mean residuals), and so is
what they draw: a tree samples rows, here a binomial share of each profile's goods and bads, and a node samples features.
Spark deals the trials to tasks; each reads the profiles from the shared folder and passes over them, not over rows.
"""

from __future__ import annotations

import json
import math
import sys
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.expr import present
from creditloom.functions.ordering import one_task_rows
from creditloom.operators.woe import few_levels
from creditloom.sources.staging import shared_folder, stage

# tasks get the functions below themselves, so workers need not find this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: ``GBTClassifier`` tries every cut of a feature with at most so many values (its ``maxBins``).
MOST_VALUES = 32
#: Profiles times features that one task may hold, for each row that it may sort.
CODES_A_ROW = 8
COUNTS = ("train_goods", "train_bads", "valid_goods", "valid_bads")
DEFAULTS = {"maxIter": 20, "stepSize": 0.1, "maxDepth": 5, "minInstancesPerNode": 1, "subsamplingRate": 1.0, "featureSubsetStrategy": "1.0"}
#: Trees that a task hands over at once.
BATCH = 50
TREE_SCHEMA = (
    "auc double, tree int, prediction array<double>, impurity array<double>, count array<double>, total array<double>, "
    "squares array<double>, gain array<double>, child array<int>, feature array<int>, cut array<int>"
)
PARTS = TREE_SCHEMA.count("array")


@dataclass
class Profiles:
    """Staged profiles: a code per feature (``c0`` ..), and goods and bads of both splits."""

    table: DataFrame
    #: Cuts between neighbouring training values of each feature; a code counts the cuts below a value.
    cuts: list[list[float]]

    def trees(self, params: Mapping, seed: int) -> DataFrame:
        """Fit one model in one task: its trees, a row each, and a last row with the AUC on the validation split."""
        train = fitting(params, [len(c) + 1 for c in self.cuts], seed)
        return stage(self.table.coalesce(1).mapInArrow(train, TREE_SCHEMA), "trees")


def supported(params: Mapping) -> bool:
    """Are these parameters of the search, with a share of features?"""
    try:
        return set(params) <= set(DEFAULTS) and 0 < float(params.get("featureSubsetStrategy", 1.0)) <= 1
    except ValueError:
        return False


def collapsed(df: DataFrame, features: Sequence[str], y: str, split: str) -> Profiles | None:
    """Profiles of the train and validation rows; none where they are too many for one task or values are not plain.

    Training rows have outcomes (the caller has checked); validation rows without one judge nothing.
    """
    limit = CODES_A_ROW * one_task_rows(df.sparkSession) // max(len(features), 1)
    rows = df.where(F.col(split).isin("train", "valid"))
    fitted = F.col(split) == "train"
    odd = ~present(*features) | (fitted & ~F.col(y).isin(0, 1))
    plain = rows.agg(F.count_if(odd).alias("odd"), F.count_if(fitted).alias("n")).first() if features else None
    if plain is None or plain["odd"] or not plain["n"]:
        return None  # Spark ML refuses such rows
    levels = few_levels(rows.where(fitted), features, MOST_VALUES)
    if len(levels) < len(features):
        return None
    values = [sorted({v + 0.0 for v in levels[f]}) for f in features]
    cuts = [[(a + b) / 2.0 for a, b in zip(v, v[1:])] for v in values]

    def code(f: str, c: list[float]) -> Column:
        return sum((F.when(F.col(f) > t, 1).otherwise(0) for t in c), F.lit(0)).cast("int")

    def total(name: str, bad: Column) -> Column:
        return F.sum(F.when((F.col(split) == name) & present(y), bad.cast("double")).otherwise(0.0))

    table = rows.groupBy(*[code(f, c).alias(f"c{i}") for i, (f, c) in enumerate(zip(features, cuts))]).agg(
        *[total(s, bad).alias(f"{s}_{k}") for s in ("train", "valid") for k, bad in (("goods", 1 - F.col(y)), ("bads", F.col(y)))]
    )
    table = stage(table, "profiles")
    return Profiles(table, cuts) if table.count() <= limit else None


# ------------------------------------------------------------------------------ in a task


def fitting(params: Mapping, bins: list[int], seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(batches)
        codes = np.stack([found[f"c{i}"].to_numpy() for i in range(len(bins))]).astype(np.uint8)
        counts = np.stack([found[c].to_numpy() for c in COUNTS])
        order = np.lexsort(codes)  # the same rows draw the same numbers, wherever they come from
        score, grown = np.zeros(len(order)), []
        for tree in boosted(np.ascontiguousarray(codes[:, order]), counts[0, order], counts[1, order], bins, params, seed, score):
            grown.append(tree)
            if len(grown) == BATCH:
                yield as_batch(grown)
                grown = []
        grown.append((area(score, counts[2, order], counts[3, order]), -1, *[[]] * PARTS))
        yield as_batch(grown)

    return run


def as_batch(grown: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.float64(), pa.int32(), *[pa.list_(pa.float64())] * 6, *[pa.list_(pa.int32())] * 3]
    names = [c.split()[0] for c in TREE_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*grown), kinds, strict=True)], names)


def area(score: np.ndarray, goods: np.ndarray, bads: np.ndarray) -> float | None:
    """Area under the curve, ties counting half; none without both outcomes."""
    here = goods + bads > 0
    with np.errstate(over="ignore"):
        p = 1.0 / (1.0 + np.exp(-2.0 * score[here]))
    ranks = np.unique(p, return_inverse=True)[1]
    g, b = np.bincount(ranks, goods[here]), np.bincount(ranks, bads[here])
    pairs = g.sum() * b.sum()
    return float((b * (np.cumsum(g) - g / 2.0)).sum() / pairs) if pairs else None


def sampled(rng: np.random.Generator, n: np.ndarray, share: float) -> np.ndarray:
    """How many of ``n`` rows a share draws, when each is drawn by itself."""
    return n if share >= 1 else rng.binomial(n.astype(np.int64), share).astype(np.float64)


def together(bins: list[int], most: int) -> list[list[int]]:
    """Features in groups whose combinations of bins stay few, so that one count serves the group."""
    groups: list[list[int]] = []
    for f in sorted(range(len(bins)), key=lambda f: -bins[f]):
        room = [g for g in groups if math.prod(bins[i] for i in g) * bins[f] <= most]
        room[0].append(f) if room else groups.append([f])
    return groups


def boosted(codes: np.ndarray, goods: np.ndarray, bads: np.ndarray, bins: list[int], params: Mapping, seed: int, score: np.ndarray) -> Iterator[tuple]:
    """Trees one after another; ``score`` takes in the margin of every profile."""
    p = DEFAULTS | dict(params)
    picked = math.ceil(float(p["featureSubsetStrategy"]) * len(bins))
    groups = []
    for g in together(bins, min(max(codes.shape[1] // 256, 1), 512)):
        joint = np.zeros(codes.shape[1], np.uint16)
        for f in g:
            joint = joint * np.uint16(bins[f]) + codes[f]
        groups.append((g, joint))
    for tree in range(p["maxIter"]):
        rng = np.random.default_rng([seed % 2**63, tree])
        b, g = (sampled(rng, n, p["subsamplingRate"]) for n in (bads, goods))
        with np.errstate(over="ignore"):  # of a bad row; that of a good one is less by the constant
            rest = 4.0 / (1.0 + np.exp(2.0 * score)) if tree else 1.0
        low = rest - (4.0 if tree else 2.0)
        nodes, fitted = grown_tree(codes, groups, bins, b + g, b * rest + g * low, b * rest**2 + g * low**2, p["maxDepth"], p["minInstancesPerNode"], picked, rng)
        score += fitted * (p["stepSize"] if tree else 1.0)
        yield None, tree, *nodes


def grown_tree(
    codes: np.ndarray, groups: list[tuple[list[int], np.ndarray]], bins: list[int], w: np.ndarray, s: np.ndarray, q: np.ndarray,
    depth: int, smallest: int, picked: int, rng: np.random.Generator,
) -> tuple[list[np.ndarray], np.ndarray]:
    """One regression tree, level by level: the columns of its nodes, and its value for every profile."""
    profiles, features, widest = codes.shape[1], len(bins), max(bins)
    flat, fitted = codes.ravel(), np.zeros(profiles)
    at, place = np.arange(profiles), np.zeros(profiles, np.int64)  # profiles whose node may split, and their node
    W, S, Q, ids = np.array([w.sum()]), np.array([s.sum()]), np.array([q.sum()]), np.zeros(1, np.int64)
    levels, known = [], 1
    for level in range(depth + 1):
        k = len(W)
        mean = np.divide(S, W, out=np.zeros(k), where=W > 0)
        impurity = np.divide(Q, W, out=np.zeros(k), where=W > 0) - mean**2
        gain, child, feature, cut = np.full(k, -1.0), np.full(k, -1), np.full(k, -1), np.full(k, -1)
        levels.append([mean, impurity, W, S, Q, gain, child, feature, cut])
        if level == depth or widest == 1:
            fitted[at] = mean[place]
            break
        left_w, left_s = (np.zeros((k, features, widest)) for _ in range(2))
        for g, joint in groups:
            shape = [bins[f] for f in g]
            size = math.prod(shape)
            key = place * size + (joint if len(at) == profiles else joint[at])
            for out, x in ((left_w, w), (left_s, s)):
                cells = np.bincount(key, x, k * size).reshape(k, *shape)
                for axis, f in enumerate(g):
                    out[:, f, : bins[f]] = cells.sum(tuple(a + 1 for a in range(len(g)) if a != axis))
        left_w, left_s = left_w.cumsum(2)[:, :, :-1], left_s.cumsum(2)[:, :, :-1]
        right_w, right_s = W[:, None, None] - left_w, S[:, None, None] - left_s
        with np.errstate(divide="ignore", invalid="ignore"):
            base = np.where(W > 0, S**2 / W, 0.0)
            found = left_s**2 / left_w + right_s**2 / right_w - base[:, None, None]
        found[(left_w < smallest) | (right_w < smallest) | ~(found > 1e-12 * base[:, None, None])] = -1.0
        if picked < features:
            found[rng.random((k, features)).argsort(1).argsort(1) >= picked] = -1.0
        found = found.reshape(k, -1)
        best = found.argmax(1)
        split = found[np.arange(k), best] > 0
        n = int(split.sum())
        where = best[split]
        gain[split] = found[split, where] / W[split]
        child[split] = known + 2 * np.arange(n)
        feature[split], cut[split] = where // (widest - 1), where % (widest - 1)
        if not split.all():
            moves = split[place]
            fitted[at[~moves]] = mean[place[~moves]]
            at, place, w, s, q = (x[moves] for x in (at, place, w, s, q))
        if not n:
            break
        first = np.cumsum(split) * 2 - 2  # place of the left child in the next level
        start = feature * profiles
        place = first[place] + (flat[start[place] + at] > cut[place])
        lw, ls = left_w.reshape(k, -1)[split, where], left_s.reshape(k, -1)[split, where]
        W, S = (np.stack([x, t[split] - x], 1).ravel() for x, t in ((lw, W), (ls, S)))
        Q = np.bincount(place, q, 2 * n)
        known += 2 * n
    return [np.concatenate(c) for c in zip(*levels)], fitted


# ------------------------------------------------------------------------------ as a model


def as_model(spark: SparkSession, trees: DataFrame, cuts: list[list[float]], params: Mapping, y: str, seed: int) -> GBTClassificationModel:
    """The trees as a model of Spark ML, by way of its file format."""
    path = f"{shared_folder(spark)}/creditloom/model-{uuid.uuid4().hex}"
    nodes = trees.where("tree >= 0").select(
        "tree", F.posexplode(F.arrays_zip("prediction", "impurity", "count", "total", "squares", "gain", "child", "feature", "cut")).alias("id", "n")
    )
    limits = F.array(*[F.array(*[F.lit(float(t)) for t in c]).cast("array<double>") for c in cuts])
    inner = F.col("n.child") >= 0
    threshold = F.when(inner, F.array(F.get(F.get(limits, F.col("n.feature")), F.col("n.cut")))).otherwise(F.array().cast("array<double>"))
    data = F.struct(
        "id",
        F.col("n.prediction").alias("prediction"),
        F.col("n.impurity").alias("impurity"),
        F.array("n.count", "n.total", "n.squares").alias("impurityStats"),
        F.col("n.count").cast("long").alias("rawCount"),
        F.col("n.gain").alias("gain"),
        F.col("n.child").alias("leftChild"),
        F.when(inner, F.col("n.child") + 1).otherwise(-1).alias("rightChild"),
        F.struct(F.col("n.feature").alias("featureIndex"), threshold.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")).alias("split"),
    )
    nodes.select(F.col("tree").alias("treeID"), data.alias("nodeData")).write.parquet(f"{path}/data")
    booster = GBTClassifier(featuresCol="_x", labelCol=y, seed=seed, **params)
    given, usual = ({p.name: v for p, v in m.items()} for m in (booster._paramMap, booster._defaultParamMap))
    count = trees.where("tree >= 0").count()

    def described(kind: str, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, **more})

    plain = described("regression.DecisionTreeRegressionModel", uid=f"dtr_{uuid.uuid4().hex[:12]}", paramMap={"featuresCol": "_x"}, defaultParamMap={})
    rows = [(i, plain, float(params.get("stepSize", DEFAULTS["stepSize"])) if i else 1.0) for i in range(count)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    whole = described(
        "classification.GBTClassificationModel", uid=booster.uid, paramMap=given, defaultParamMap=usual, numFeatures=len(cuts), numTrees=count
    )
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return GBTClassificationModel.load(path)
