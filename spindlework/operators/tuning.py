"""Randomised hyper-parameter search with cross-validation."""

from __future__ import annotations

import json
import random

from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.operators import binned
from spindlework.operators.models import tree_depth
from spindlework.operators.resample import resampled_rounds
from spindlework.plans.workspace import materialise

# The searched spaces.  A pair is a range [low, high), a list a choice.
# Depths end at Spark's limit of 30.
FOREST_SPACE = {
    "numTrees": (50, 300),
    "maxDepth": [10, 20, 30],
    "minInstancesPerNode": (1, 10),
}
BOOSTING_SPACE = {
    "maxIter": (50, 300),
    "stepSize": [0.001, 0.01, 0.1, 0.2, 0.3],
    "maxDepth": (3, 10),
    "minInstancesPerNode": (1, 10),
    "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
}
DRAWS = 50
FOLDS = 5


def draw_settings(space: dict, draws: int = DRAWS, seed: int = 42) -> list[dict]:
    chance = random.Random(seed)

    def one(values):
        if isinstance(values, tuple):
            return chance.randrange(*values)
        return chance.choice(values)

    settings = [{name: one(values) for name, values in space.items()} for _ in range(draws)]
    for s in settings:
        if "maxDepth" in s:
            tree_depth(s["maxDepth"])
    return settings


def f1_evaluator(binary: bool = False) -> Evaluator:
    """F1 of class 1, or weighted over all classes."""
    if binary:
        return MulticlassClassificationEvaluator(
            labelCol="label", metricName="fMeasureByLabel", metricLabel=1.0
        )
    return MulticlassClassificationEvaluator(labelCol="label", metricName="f1")


def random_search(
    train: DataFrame,
    estimator: Estimator,
    space: dict,
    draws: int = DRAWS,
    folds: int = FOLDS,
    binary: bool = False,
    fold_column: str = "fold",
    parallelism: int = 2,
    seed: int = 42,
) -> tuple[DataFrame, object]:
    """Table (rank, mean_score, settings) of all draws, and the best one refitted.

    ``train`` has ``features``, ``label`` and a fold number per row.
    """
    settings = draw_settings(space, draws, seed)
    maps = [{estimator.getParam(k): v for k, v in s.items()} for s in settings]
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=f1_evaluator(binary),
        numFolds=folds,
        foldCol=fold_column,
        parallelism=parallelism,
        seed=seed,
    ).fit(materialise(train.select("features", "label", fold_column), "search"))
    ranked = sorted(zip(search.avgMetrics, settings), key=lambda r: -r[0])
    rows = [(i + 1, float(score), json.dumps(s, sort_keys=True)) for i, (score, s) in enumerate(ranked)]
    table = train.sparkSession.createDataFrame(rows, "rank int, mean_score double, settings string")
    return table, search.bestModel


def cross_validate(
    ready: DataFrame, estimator: Estimator, folds: int = FOLDS, binary: bool = False, resample: bool = False,
    fold_column: str = "fold", **options,
) -> list[float]:
    """F1 of each fold; with ``resample`` a round learns from synthetic rows of its own train rows too."""
    ready = materialise(ready.select("features", "label", fold_column), "cross-validation")
    if resample:
        first = ready.first()
        rounds = resampled_rounds(ready, folds, len(first["features"]) if first else 0, fold_column, **options)
    else:
        rounds = (
            (ready.filter(F.col(fold_column) != k), ready.filter(F.col(fold_column) == k)) for k in range(folds)
        )
    measure = f1_evaluator(binary)
    return [measure.evaluate(estimator.fit(materialise(a, "round")).transform(b)) for a, b in rounds]


def _units(kind: str, settings: list[dict]) -> tuple[list[dict], list[tuple[int, int, int]]]:
    """Fits that serve all draws, and for each draw its (fit, trees, depth).

    Forest draws share a fit unless their least leaf differs; boosting draws share one if they
    differ in their number of trees only.
    """
    units: dict[tuple, dict] = {}
    places = []
    for s in settings:
        trees, depth, least = s["numTrees" if kind == "forest" else "maxIter"], s["maxDepth"], s["minInstancesPerNode"]
        own = (least,) if kind == "forest" else (least, depth, s["stepSize"], s["subsamplingRate"])
        unit = units.setdefault(
            own,
            {"kind": kind, "least": least, "wanted": [], "rate": s.get("stepSize"), "subsample": s.get("subsamplingRate")},
        )
        unit["wanted"].append((trees, depth))
        places.append((list(units).index(own), trees, depth))
    return list(units.values()), places


def fold_f1(counts: DataFrame, binary: bool = False) -> DataFrame:
    """(unit, trees, depth, mean_score): F1 of class 1, or weighted over classes, mean of the folds."""
    keys = ["unit", "trees", "depth", "fold"]
    n = counts.groupBy(*keys, "label", "prediction").agg(F.sum("n").alias("n"))
    sides = n.select(*keys, F.col("label").alias("c"), F.col("n").alias("support"), F.lit(0).alias("said"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"))
    said = n.select(*keys, F.col("prediction").alias("c"), F.lit(0).alias("support"), F.col("n").alias("said"), F.lit(0).alias("tp"))
    per_class = sides.unionByName(said).groupBy(*keys, "c").agg(*[F.sum(x).alias(x) for x in ("support", "said", "tp")])
    f1 = 2 * F.col("tp") / (F.col("support") + F.col("said"))
    if binary:
        score = F.coalesce(F.max(F.when(F.col("c") == 1, f1)), F.lit(0.0))
    else:
        score = F.sum(f1 * F.col("support")) / F.sum("support")
    return per_class.groupBy(*keys).agg(score.alias("score")).groupBy("unit", "trees", "depth").agg(F.avg("score").alias("mean_score"))


def shared_search(
    train: DataFrame,
    kind: str,
    space: dict | None = None,
    draws: int = DRAWS,
    folds: int = FOLDS,
    binary: bool = False,
    fold_column: str = "fold",
    seed: int = 42,
    max_bytes: int = binned.CELL_BYTES,
) -> DataFrame:
    """Table (rank, mean_score, settings) of all draws of a forest or boosting space.

    All fits read one binned table, and draws share fits (``operators/binned.py``).  ``train`` has
    ``features``, ``label`` and a fold number per row.  Equal scores rank in the order of drawing.
    """
    space = space or (FOREST_SPACE if kind == "forest" else BOOSTING_SPACE)
    settings = draw_settings(space, draws, seed)
    units, places = _units(kind, settings)
    edges = binned.bin_edges(train)
    table = binned.cells(train, edges, fold_column)
    classes = 1 + (table.agg(F.max("label")).first()[0] or 0)
    counts = binned.search_counts(train.sparkSession, table, units, classes, folds, seed, len(edges), edges, max_bytes)
    found = {(r["unit"], r["trees"], r["depth"]): r["mean_score"] for r in fold_f1(counts, binary).collect()}
    scores = [found[p] for p in places]
    order = sorted(range(draws), key=lambda i: (-scores[i], i))
    rows = [(r + 1, float(scores[i]), json.dumps(settings[i], sort_keys=True)) for r, i in enumerate(order)]
    return train.sparkSession.createDataFrame(rows, "rank int, mean_score double, settings string")
