"""Landmark (Nystroem) features of the RBF kernel, and how far any feature map is from the kernel.

With landmarks L, K(x, y) is close to k(x)' W^-1 k(y), where k(x) holds the kernels of x with
the landmarks and W those of the landmarks among themselves (Williams and Seeger 2001).  The
features are W^-1/2 k(x), exact at the landmarks and between them as good as the data are close
to them, where random cosines are equally rough everywhere.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBES = 300  # points whose pairwise kernels the error is measured on
LEAST = 1e-9  # eigenvalues of W below this share of the largest carry only rounding


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(square, 0.0))


def chosen_points(df: DataFrame, columns: list[str], size: int, seed: int) -> np.ndarray:
    """At most ``size`` distinct points: those with the smallest digests, on any layout."""
    own = df.select(*[(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in columns]).na.drop()
    picked = own.groupBy(*columns).agg(F.lit(1)).orderBy(F.xxhash64(*columns, F.lit(seed)), *columns)
    return np.array([list(r)[: len(columns)] for r in picked.limit(size).collect()]).reshape(-1, len(columns))


class LandmarkFeatures(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """``features`` from numeric columns, in Arrow batches; saved with its pipeline."""

    gamma = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)
    landmarks = Param(Params._dummy(), "landmarks", "points, one after another", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="features", gamma=1.0, landmarks=None):  # noqa: N803
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def map(self) -> tuple[np.ndarray, np.ndarray, float]:
        """(landmarks, W^-1/2, gamma)."""
        gamma = self.getOrDefault(self.gamma)
        points = np.array(self.getOrDefault(self.landmarks)).reshape(-1, len(self.getInputCols()))
        values, vectors = np.linalg.eigh(rbf(points, points, gamma))
        keep = values > LEAST * values.max()
        return points, vectors[:, keep] / np.sqrt(values[keep]), gamma

    def _transform(self, dataset: DataFrame) -> DataFrame:
        points, root, gamma = self.map()

        @F.pandas_udf("array<double>")
        def features(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            return pd.Series(list(rbf(x, points, gamma) @ root))

        return dataset.withColumn(
            self.getOutputCol(),
            array_to_vector(features(*[F.col(c).cast("double") for c in self.getInputCols()])),
        )


def landmark_features(
    train: DataFrame, columns: list[str], gamma: float, size: int = 64, seed: int = 42
) -> LandmarkFeatures:
    points = chosen_points(train, columns, size, seed)
    return LandmarkFeatures(inputCols=columns, outputCol="features", gamma=gamma, landmarks=points.ravel().tolist())


def kernel_error(stages: list, df: DataFrame, columns: list[str], gamma: float, seed: int = 7) -> tuple[float, float]:
    """(mean, greatest) distance of features' dot products from the kernel, over the pairs of
    ``PROBES`` points drawn by digest."""
    points = chosen_points(df, columns, PROBES, seed)
    out = df.sparkSession.createDataFrame(points.tolist(), columns)
    for stage in stages:
        out = stage.transform(out)
    rows = out.select(*columns, vector_to_array("features").alias("v")).collect()
    x = np.array([list(r)[: len(columns)] for r in rows])
    v = np.array([r["v"] for r in rows])
    gap = np.abs(v @ v.T - rbf(x, x, gamma))
    return float(gap.mean()), float(gap.max())
