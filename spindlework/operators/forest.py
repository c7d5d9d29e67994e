"""Random forest as a ``pyspark.ml`` stage, grown on the binned table of ``operators/binned.py``.

Rows that agree in bins and label are one cell, drawn as often as a bootstrap of its rows would be, so
a tree costs what the distinct rows cost.  Trees are grown in parallel, each on all cells.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    DefaultParamsReadable,
    DefaultParamsWritable,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlework.operators.binned import TREE_ROWS, Tree, fit_forest, shares, to_bins, tree_rows, trees_of
from spindlework.plans.workspace import ship_package

CHUNK = 500  # rows that pass all trees at once


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed):
    pass


class BinnedForest(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """A forest of ``numTrees`` on bootstraps, nodes choosing among the root of the features."""

    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)  # noqa: N815
    maxDepth = Param(Params._dummy(), "maxDepth", "greatest depth", TypeConverters.toInt)  # noqa: N815
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a side", TypeConverters.toInt)  # noqa: N815
    minInfoGain = Param(Params._dummy(), "minInfoGain", "least gain of a split", TypeConverters.toFloat)  # noqa: N815
    copies = Param(Params._dummy(), "copies", "column of the number of copies that a row stands for", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, labelCol="label", featuresCol="features", numTrees=20, maxDepth=5, minInstancesPerNode=1,  # noqa: N803
        minInfoGain=0.0, seed=42,  # noqa: N803
    ):
        super().__init__()
        self._setDefault(numTrees=20, maxDepth=5, minInstancesPerNode=1, minInfoGain=0.0, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> BinnedForestModel:
        ship_package(dataset.sparkSession)
        copies = self.getOrDefault(self.copies) if self.isSet(self.copies) else None
        rows = dataset.select(
            F.col(self.getFeaturesCol()).alias("features"),
            F.col(self.getLabelCol()).cast("double").alias("label"),
            *([F.col(copies).cast("long").alias("copies")] if copies else []),
        )
        classes = 1 + int(rows.agg(F.max("label")).first()[0] or 0)
        settings = (self.numTrees, self.maxDepth, self.minInstancesPerNode, self.minInfoGain, self.seed)
        options = {"copies": "copies"} if copies else {}
        edges, trees = fit_forest(rows, classes, *[self.getOrDefault(p) for p in settings], **options)
        return self._copyValues(BinnedForestModel(edges, trees, classes))


class BinnedForestModel(Model, _Columns, MLReadable, MLWritable):
    """``probability``, the mean of the trees' class shares, and ``prediction``, the likeliest class."""

    def __init__(self, edges: list[list[float]] | None = None, trees: list[Tree] | None = None, classes: int = 1):
        super().__init__()
        self.edges, self.trees, self.classes = edges or [], trees or [], classes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        ship_package(spark)
        shared = spark.sparkContext.broadcast((self.edges, Stacked.of(self.trees, self.classes)))

        @F.pandas_udf("array<double>")
        def scored(x: pd.Series) -> pd.Series:
            edges, forest = shared.value
            rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(edges)))
            return pd.Series(list(forest.shares(to_bins(rows, edges))))

        own = F.col("_shares")
        return (
            dataset.withColumn("_shares", scored(vector_to_array(self.getFeaturesCol())))
            .withColumn(self.getProbabilityCol(), array_to_vector(own))
            .withColumn(self.getPredictionCol(), (F.array_position(own, F.array_max(own)) - 1).cast("double"))
            .drop("_shares")
        )

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class Stacked:
    """The nodes of all trees one after another, so that rows pass many trees at once."""

    def __init__(self, root, feature, cut, child, share):
        self.root, self.feature, self.cut, self.child, self.share = root, feature, cut, child, share

    @staticmethod
    def of(trees: list[Tree], classes: int) -> Stacked:
        sizes = [len(t.feature) for t in trees]
        root = np.cumsum([0, *sizes])[:-1] if sizes else np.zeros(0, np.int64)
        child = [np.array(t.child, np.int64) + at for t, at in zip(trees, root)]
        share = np.concatenate([shares(t) for t in trees]) if trees else np.zeros((0, classes))
        parts = [np.concatenate([np.array(getattr(t, n), np.int64) for t in trees] or [np.zeros(0, np.int64)]) for n in ("feature", "cut")]
        return Stacked(root.astype(np.int64), *parts, np.concatenate(child or [np.zeros(0, np.int64)]), share)

    def shares(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bins), self.share.shape[1]))
        for first in range(0, len(bins) if len(self.root) else 0, CHUNK):
            part = bins[first : first + CHUNK]
            n, width = part.shape
            flat, node = part.ravel(), np.repeat(self.root, n)
            start = np.tile(np.arange(n) * width, len(self.root))
            at = np.arange(len(node))
            while len(at):
                f = self.feature[node[at]]
                at, f = at[f >= 0], f[f >= 0]
                own = node[at]
                node[at] = self.child[own] + (flat[start[at] + f] > self.cut[own])
            out[first : first + CHUNK] = self.share[node].reshape(len(self.root), n, -1).mean(0)
        return out


class _Writer(MLWriter):
    def __init__(self, model: BinnedForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        model, spark = self.model, self.sparkSession
        extra = {"edges": model.edges, "classes": model.classes}
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata=extra)
        rows = tree_rows(list(enumerate(model.trees))).to_pylist() if model.trees else []
        spark.createDataFrame([tuple(r.values()) for r in rows], TREE_ROWS).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> BinnedForestModel:
        spark: SparkSession = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.kind(metadata["edges"], trees_of(spark.read.parquet(f"{path}/trees")), metadata["classes"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
