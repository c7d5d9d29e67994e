"""Classifiers with their full settings as defaults, and whole fitted pipelines.

Regularisation given as ``C`` (inverse strength over a sum of losses) becomes
``regParam = 1 / (C * rows)``, since Spark averages the loss over rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.operators.binned import Boosted, fit_boosted
from spindlework.operators.features import fit_features, index_to_text, labels_of
from spindlework.operators.forest import BinnedForest
from spindlework.operators.kernels import landmark_features
from spindlework.operators.resample import resampled
from spindlework.plans.workspace import materialise, work_dir
from spindlework.schemas import NUMERIC_FEATURES

MAX_TREE_DEPTH = 30  # Spark's limit


def tree_depth(depth: int) -> int:
    if depth > MAX_TREE_DEPTH:
        raise ValueError(f"depth {depth} is beyond Spark's limit of {MAX_TREE_DEPTH}")
    return depth


def counted_copies(df: DataFrame, weight: str = "weight") -> DataFrame:
    """Distinct rows with their number, which an estimator takes as their weight."""
    return df.groupBy(*df.columns).agg(F.count("*").cast("double").alias(weight))


def weighs_copies(estimator: Estimator) -> bool:
    """Whether a fit on distinct rows and their numbers is the fit on all rows: a weight must be all
    that an estimator makes of a row, so not if it draws rows or counts them for a least leaf."""
    if isinstance(estimator, (DecisionTreeClassifier, GBTClassifier)):
        alone = estimator.getMinInstancesPerNode() == 1
        return alone and (not isinstance(estimator, GBTClassifier) or estimator.getSubsamplingRate() == 1.0)
    return isinstance(estimator, (LogisticRegression, LinearSVC))


def fit_on_copies(estimator: Estimator, train: DataFrame, weight: str | None = None):
    """Fit on ``train`` (features, label), copies counted once if that gives the same model.

    With ``weight`` the rows of ``train`` stand for so many copies already; an estimator that neither
    weighs copies nor counts them itself gets them one by one.
    """
    if weight is not None:
        if isinstance(estimator, BinnedForest):
            return estimator.copy({estimator.copies: weight}).fit(train)
        if weighs_copies(estimator):
            return estimator.copy({estimator.weightCol: weight}).fit(train)
        each = train.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(weight).cast("int"))))
        return estimator.fit(materialise(each.drop(weight, "_copy"), "training"))
    if not weighs_copies(estimator):
        return estimator.fit(materialise(train, "training"))
    weighted = estimator.copy({estimator.weightCol: "weight"})
    cells = [vector_to_array("features").alias("features"), "label"]
    target = train.schema["label"].metadata
    distinct = counted_copies(train.select(*cells))
    ready = distinct.select(
        array_to_vector("features").alias("features"), F.col("label").alias("label", metadata=target), "weight"
    )
    return weighted.fit(materialise(ready, "training"))


def random_forest(
    trees: int = 196, depth: int = 10, min_instances: int = 2, min_gain: float = 0.0, seed: int = 42
) -> BinnedForest:
    return BinnedForest(
        labelCol="label",
        featuresCol="features",
        numTrees=trees,
        maxDepth=tree_depth(depth),
        minInstancesPerNode=min_instances,
        minInfoGain=min_gain,
        seed=seed,
    )


def binary_forest(trees: int = 200, depth: int = MAX_TREE_DEPTH, seed: int = 42) -> BinnedForest:
    """Forest whose trees grow as deep as Spark allows."""
    return random_forest(trees, depth, min_instances=1, seed=seed)


def decision_tree(depth: int = 5, seed: int = 42) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol="label", featuresCol="features", maxDepth=depth, seed=seed)


def multinomial_regression(iterations: int = 10) -> LogisticRegression:
    return LogisticRegression(
        labelCol="label", featuresCol="features", maxIter=iterations, family="multinomial"
    )


def binary_regression(rows: int, c: float = 0.4, iterations: int = 300) -> LogisticRegression:
    return LogisticRegression(
        labelCol="label",
        featuresCol="features",
        family="binomial",
        maxIter=iterations,
        regParam=1.0 / (c * max(1, rows)),
        elasticNetParam=0.0,
        standardization=False,
    )


def boosted_trees(
    trees: int = 100,
    rate: float = 0.1,
    depth: int = 3,
    min_instances: int = 1,
    subsample: float = 1.0,
    seed: int = 42,
) -> GBTClassifier:
    return GBTClassifier(
        labelCol="label",
        featuresCol="features",
        maxIter=trees,
        stepSize=rate,
        maxDepth=tree_depth(depth),
        minInstancesPerNode=min_instances,
        subsamplingRate=subsample,
        seed=seed,
    )


# The tuned settings.
TUNED_BOOSTING_BINARY = {"trees": 173, "rate": 0.1, "depth": 9, "min_instances": 1, "subsample": 0.9}
TUNED_BOOSTING_MULTICLASS = {"trees": 267, "rate": 0.01, "depth": 6, "min_instances": 6, "subsample": 1.0}


def boosted_trees_multiclass(parallelism: int = 2, **settings) -> OneVsRest:
    """One boosted model per class, since Spark's boosting is binary."""
    return OneVsRest(
        classifier=boosted_trees(**{**TUNED_BOOSTING_MULTICLASS, **settings}),
        labelCol="label",
        featuresCol="features",
        parallelism=parallelism,
    )


def fit_softmax_boosting(train: DataFrame, **options) -> tuple[PipelineModel, Boosted]:
    """Preparation and one boosted ensemble of all classes; settings are the tuned ones.

    ``options``: those of ``fit_features``, and of ``binned.fit_boosted`` to depart from the tuned.
    """
    own = {k: options.pop(k) for k in list(options) if k in ("trees", "rate", "depth", "min_instances", "subsample", "seed", "max_bytes")}
    label = options.get("label", "failure_type")
    train = train.na.drop(subset=[*NUMERIC_FEATURES, options.get("category", "type"), label or "label"])
    prepare = fit_features(train, **options)
    classes = len(labels_of(prepare)) if label else 2
    ready = materialise(prepare.transform(train).select("features", "label"), "training")
    return prepare, fit_boosted(ready, classes, **{**TUNED_BOOSTING_MULTICLASS, **own})


def scale_gamma(train: DataFrame, columns: list[str], weight: str | None = None) -> float:
    """1 / (columns x variance of all feature values), from one aggregate."""
    n = F.col(weight) if weight else F.lit(1)
    sums = train.agg(
        F.sum(n).alias("n"),
        *[F.sum(F.col(c) * n).alias(f"s_{c}") for c in columns],
        *[F.sum(F.col(c) * F.col(c) * n).alias(f"q_{c}") for c in columns],
    ).first()
    cells = sums["n"] * len(columns)
    mean = sum(sums[f"s_{c}"] for c in columns) / cells
    variance = sum(sums[f"q_{c}"] for c in columns) / cells - mean * mean
    return 1.0 / (len(columns) * variance) if variance > 0 else 1.0


def fourier_features(columns: list[str], gamma: float, size: int = 64, seed: int = 42) -> list:
    """Stages that map ``columns`` to random cosine features of the RBF kernel.

    Rahimi and Recht (2007): w ~ N(0, 2 gamma), b ~ U(0, 2 pi), sqrt(2/D) cos(wx + b).
    """
    draw = np.random.default_rng(seed)
    weights = draw.normal(0.0, np.sqrt(2.0 * gamma), (size, len(columns)))
    shift = draw.uniform(0.0, 2.0 * np.pi, size)
    scale = float(np.sqrt(2.0 / size))

    def cosine(i: int) -> str:
        dot = " + ".join(f"{float(w)!r}D * `{c}`" for w, c in zip(weights[i], columns))
        return f"{scale!r}D * cos({dot} + {float(shift[i])!r}D) AS `rff_{i}`"

    names = [f"rff_{i}" for i in range(size)]
    return [
        SQLTransformer(statement="SELECT *, " + ", ".join(cosine(i) for i in range(size)) + " FROM __THIS__"),
        VectorAssembler(inputCols=names, outputCol="features"),
    ]


def fit_kernel_svm(
    train: DataFrame,
    columns: list[str],
    c: float = 1.0,
    size: int = 64,
    iterations: int = 100,
    seed: int = 42,
    kernel_map: str = "cosines",
    weight: str | None = None,
) -> PipelineModel:
    """SVM with an RBF kernel: a linear SVM on features whose dot products stand for the kernel,
    random ``cosines`` or ``landmarks`` (``kernels.kernel_error`` measures either).  With ``weight`` a row
    of ``train`` stands for so many copies."""
    rows = train.agg(F.sum(weight)).first()[0] or 0 if weight else train.count()
    gamma = scale_gamma(train, columns, weight)
    if weight:
        train = train.groupBy(*columns, "label").agg(F.sum(weight).cast("double").alias("weight"))
    else:
        train = counted_copies(train.select(*columns, "label"))
    train = materialise(train, "kernel-rows")
    if kernel_map == "landmarks":
        stages = [landmark_features(train, columns, gamma, size, seed)]
    elif kernel_map == "cosines":
        stages = fourier_features(columns, gamma, size, seed)
    else:
        raise ValueError(f"unknown kernel map {kernel_map!r}")
    mapped = PipelineModel(stages=stages).transform(train).select("features", "label", "weight")
    svc = LinearSVC(
        labelCol="label",
        featuresCol="features",
        weightCol="weight",
        regParam=1.0 / (c * max(1, rows)),
        maxIter=iterations,
        standardization=False,
    )
    return PipelineModel(stages=[*stages, svc.fit(materialise(mapped, "kernel-features"))])


def fit_model(
    train: DataFrame,
    estimator: Estimator,
    decode: str | None = "predicted_class",
    resample: bool = False,
    **features,
) -> PipelineModel:
    """Preparation, classifier and class text as one model that can be saved whole.

    Rows that lack a measure, the category or the label teach nothing and are left out.  With
    ``resample`` the classifier learns from the prepared rows and synthetic ones that lift every
    class to the size of the largest; the preparation is fitted on the given rows.
    """
    label = features.get("label", "failure_type")
    needed = [*features.get("numeric", NUMERIC_FEATURES), features.get("category", "type"), label or "label"]
    train = train.na.drop(subset=needed)
    prepare = fit_features(train, **features)
    work_dir(train.sparkSession)  # sets the checkpoint folder long boosting runs use
    known = labels_of(prepare) if label is not None else []
    target = F.col("label")
    if len(known) > 1:  # classifiers learn the classes that occur, not the slot for unseen ones
        target = target.alias("label", metadata={"ml_attr": {"type": "nominal", "vals": known}})
    ready = prepare.transform(train).select("features", target)
    if resample and (first := (ready := materialise(ready, "training")).first()) is not None:
        balanced = resampled(ready, len(first["features"]))
        ready = balanced.select("features", target)
    stages = [*prepare.stages, fit_on_copies(estimator, ready)]
    if decode and known:
        stages.append(index_to_text("prediction", decode, known))
    return PipelineModel(stages=stages)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def prediction_listing(scored: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    return (
        scored.select(*order_by, vector_to_array("features").alias("features"), "label", "prediction")
        .orderBy(*order_by)
        .limit(n)
    )
