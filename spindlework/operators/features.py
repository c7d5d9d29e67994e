"""Label indexing, encoding, scaling and assembling of features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    IndexToString,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.schemas import NUMERIC_FEATURES

LABEL_ORDERS = {"frequency": "frequencyDesc", "text": "alphabetAsc"}


def label_indexer(column: str, name: str, order: str = "frequency", invalid: str = "keep") -> StringIndexer:
    """Text to 0..n-1, most frequent first (ties by text) or in text order."""
    return StringIndexer(
        inputCol=column, outputCol=name, stringOrderType=LABEL_ORDERS[order], handleInvalid=invalid
    )


def index_to_text(column: str, name: str, labels: list[str]) -> IndexToString:
    return IndexToString(inputCol=column, outputCol=name, labels=labels)


def with_label_index(df: DataFrame, column: str, name: str, order: str = "frequency") -> DataFrame:
    return label_indexer(column, name, order).fit(df).transform(df)


def vector_columns(df: DataFrame, vector: str, names: list[str]) -> DataFrame:
    """Vector entries as plain columns."""
    parts = df.withColumn("_v", vector_to_array(vector))
    return parts.select(
        *[c for c in df.columns if c != vector], *[F.col("_v")[i].alias(n) for i, n in enumerate(names)]
    )


def one_hot(column: str, name: str, drop_last: bool = True) -> list:
    """Index stage and encoder; ``drop_last=False`` keeps a slot for every level."""
    return [
        label_indexer(column, f"{column}_index", invalid="error"),
        OneHotEncoder(inputCol=f"{column}_index", outputCol=name, dropLast=drop_last),
    ]


@dataclass(frozen=True)
class ZScore:
    """Mean and population standard deviation per column, fitted on training rows."""

    mean: dict[str, float]
    std: dict[str, float]

    def expression(self, column: str) -> str:
        return f"(CAST(`{column}` AS DOUBLE) - {self.mean[column]!r}D) / {self.std[column]!r}D"

    def apply(self, df: DataFrame, suffix: str = "_z") -> DataFrame:
        return df.withColumns({f"{c}{suffix}": F.expr(self.expression(c)) for c in self.mean})

    def stage(self, suffix: str = "_z") -> SQLTransformer:
        columns = ", ".join(f"{self.expression(c)} AS `{c}{suffix}`" for c in self.mean)
        return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def fit_zscore(train: DataFrame, columns: list[str]) -> ZScore:
    """One aggregate; a constant column is centred but not divided."""
    stats = train.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    ).first()
    return ZScore(
        {c: stats[f"m_{c}"] or 0.0 for c in columns}, {c: stats[f"s_{c}"] or 1.0 for c in columns}
    )


def level_scale(train: DataFrame, column: str) -> dict[str, float]:
    """1 / population std of each level's indicator; levels in text order."""
    counts = {
        r[column]: r["count"]
        for r in train.filter(F.col(column).isNotNull()).groupBy(column).count().collect()
    }
    total = sum(counts.values())
    scale = {}
    for level in sorted(counts):
        share = counts[level] / total
        spread = (share * (1 - share)) ** 0.5
        scale[level] = 1 / spread if spread > 0 else 1.0
    return scale


def fit_features(
    train: DataFrame,
    categorical: str = "one_hot",
    scale: str = "none",
    label: str | None = "failure_type",
    label_order: str = "frequency",
    numeric: list[str] = NUMERIC_FEATURES,
    category: str = "type",
) -> PipelineModel:
    """Fit all preparation stages once on ``train``; output ``features`` and ``label``.

    ``categorical``: ``one_hot`` (last level implied), ``one_hot_all`` (a slot per
    level), ``index`` (the index as a number) or ``none``.
    ``scale``: ``none``, ``std`` (sample std, no centring, numeric columns) or
    ``zscore`` (population std and centring; one-hot slots scaled without centring).
    """
    stages: list = []
    if label is not None:
        stages.append(label_indexer(label, "label", label_order))
    parts: list[str] = list(numeric)
    if scale == "std":
        stages += [
            VectorAssembler(inputCols=numeric, outputCol="numeric_vector", handleInvalid="keep"),
            StandardScaler(inputCol="numeric_vector", outputCol="numeric_scaled"),
        ]
        parts = ["numeric_scaled"]
    elif scale == "zscore":
        stages.append(fit_zscore(train, numeric).stage())
        parts = [f"{c}_z" for c in numeric]
    elif scale != "none":
        raise ValueError(f"unknown scale {scale!r}")
    if categorical in ("one_hot", "one_hot_all", "index"):
        stages.append(
            StringIndexer(
                inputCol=category,
                outputCol=f"{category}_index",
                stringOrderType="alphabetAsc" if scale == "zscore" else "frequencyDesc",
                handleInvalid="keep",
            )
        )
        encoded = f"{category}_index"
        if categorical != "index":
            encoded = f"{category}_encoded"
            # an unseen level has its own index after the known ones; dropping the last
            # slot leaves it all zeros, dropping nothing more keeps a slot per known level
            stages.append(
                OneHotEncoder(inputCol=f"{category}_index", outputCol=encoded, dropLast=True)
            )
            if categorical == "one_hot":
                levels = train.select(category).filter(F.col(category).isNotNull()).distinct().count()
                if levels > 1:
                    stages.append(
                        VectorSlicer(
                            inputCol=encoded, outputCol=f"{encoded}_kept", indices=list(range(levels - 1))
                        )
                    )
                    encoded = f"{encoded}_kept"
                else:
                    encoded = None
        if scale == "zscore" and categorical == "one_hot_all":
            stages.append(
                ElementwiseProduct(
                    inputCol=encoded,
                    outputCol=f"{encoded}_scaled",
                    scalingVec=Vectors.dense(list(level_scale(train, category).values())),
                )
            )
            encoded = f"{encoded}_scaled"
        parts = [*parts, *([encoded] if encoded else [])]
    elif categorical != "none":
        raise ValueError(f"unknown categorical form {categorical!r}")
    # a missing measure becomes NaN, so that a row with one does not end the job
    stages.append(VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)


def labels_of(model: PipelineModel) -> list[str]:
    """Class texts of the fitted label stage, by index."""
    return list(model.stages[0].labels)
