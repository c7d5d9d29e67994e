"""Metrics of (label, prediction) tables.

Every metric starts from the counts of (label, prediction) pairs, which Spark
combines map-side; all later steps work on at most classes x classes rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlework.functions.values import percent_text


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts of the pairs that occur."""
    return (
        df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count("*").alias("n"))
        .orderBy("label", "prediction")
    )


def _pair_counts(
    df: DataFrame, label: str, prediction: str, by: tuple[str, ...] = (), copies: str | None = None
) -> DataFrame:
    n = F.sum(F.col(copies).cast("long")) if copies else F.count("*")
    return df.groupBy(*by, F.col(label).alias("_l"), F.col(prediction).alias("_p")).agg(n.alias("_n"))


def confusion_dense(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts of all pairs of seen classes, zeros included."""
    counts = _pair_counts(df, label, prediction)
    classes = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("_l", "_p")))))
    seen = F.map_from_entries(F.collect_list(F.struct(F.struct("_l", "_p"), "_n")))
    # one row: the class list and the counted pairs
    return (
        counts.agg(classes.alias("classes"), seen.alias("seen"))
        .select("classes", "seen", F.explode("classes").alias("label"))
        .select("label", "seen", F.explode("classes").alias("prediction"))
        .select(
            "label",
            "prediction",
            F.coalesce(
                F.col("seen")[F.struct(F.col("label").alias("_l"), F.col("prediction").alias("_p"))],
                F.lit(0),
            ).alias("n"),
        )
    )


def confusion_share(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Dense confusion with each pair's share of all rows and the ready label text."""
    dense = confusion_dense(df, label, prediction)
    cells = dense.agg(
        F.collect_list(F.struct("label", "prediction", "n")).alias("cells"), F.sum("n").alias("total")
    ).select("total", F.explode("cells").alias("c")).select("total", "c.*")
    share = F.try_divide(F.col("n"), F.col("total"))
    return cells.select(
        "label",
        "prediction",
        "n",
        share.alias("share"),
        F.concat(F.col("n").cast("string"), F.lit("\n"), percent_text(share)).alias("text"),
    )


def confusion_wide(df: DataFrame, classes: list, label: str = "label", prediction: str = "prediction") -> DataFrame:
    names = [str(c) for c in classes]
    return df.groupBy(label).pivot(prediction, classes).count().na.fill(0, names)


def class_table(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: tuple[str, ...] = ()
) -> DataFrame:
    """Per class: rows of the class, rows predicted as it, rows right."""
    sides = F.array(
        F.struct(
            F.col("_l").alias("class"),
            F.col("_n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.when(F.col("_l") == F.col("_p"), F.col("_n")).otherwise(0).alias("right"),
        ),
        F.struct(
            F.col("_p").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("_n").alias("predicted"),
            F.lit(0).cast("bigint").alias("right"),
        ),
    )
    return (
        _pair_counts(df, label, prediction, by)
        .select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, F.col("s.class").alias("class"))
        .agg(*[F.sum(f"s.{c}").alias(c) for c in ("support", "predicted", "right")])
    )


def _ratio(top: Column, bottom: Column, zero_division: float) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(float(zero_division)))


def _scores(zero_division: float) -> dict[str, Column]:
    right, support, predicted = F.col("right"), F.col("support"), F.col("predicted")
    return {
        "precision": _ratio(right, predicted, zero_division),
        "recall": _ratio(right, support, zero_division),
        "f1": _ratio(2 * right, support + predicted, zero_division),
    }


def weighted_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: tuple[str, ...] = ()
) -> DataFrame:
    """accuracy and support-weighted precision, recall and F1; one row (per ``by``)."""
    scored = class_table(df, label, prediction, by).withColumns(_scores(0.0))
    total = F.sum("support")
    return scored.groupBy(*by).agg(
        F.try_divide(F.sum("right"), total).alias("accuracy"),
        *[
            F.try_divide(F.sum(F.col(m) * F.col("support")), total).alias(m)
            for m in ("precision", "recall", "f1")
        ],
    )


def binary_metrics(
    df: DataFrame,
    label: str = "label_bin",
    prediction: str = "prediction_bin",
    positive: float = 1,
    by: tuple[str, ...] = (),
    copies: str | None = None,
) -> DataFrame:
    """accuracy, recall, precision and F1 of the positive class; one row (per ``by``).  With ``copies``
    a row of ``df`` stands for so many."""
    is_l, is_p = F.col("_l") == positive, F.col("_p") == positive

    def total(*conditions: Column) -> Column:
        if not conditions:
            return F.sum("_n")
        return F.coalesce(F.sum(F.when(reduce(lambda a, b: a & b, conditions), F.col("_n"))), F.lit(0))

    right, actual, predicted = total(is_l, is_p), total(is_l), total(is_p)
    return (
        _pair_counts(df, label, prediction, by, copies)
        .groupBy(*by)
        .agg(
            F.try_divide(total(F.col("_l") == F.col("_p")), total()).alias("accuracy"),
            _ratio(right, actual, 0).alias("recall"),
            _ratio(right, predicted, 0).alias("precision"),
            _ratio(2 * right, actual + predicted, 0).alias("f1"),
        )
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", zero_division: float = 0.0
) -> DataFrame:
    """Rows per class, then accuracy, macro average and weighted average.

    The class rows and the totals come out of one rollup.
    """
    scored = class_table(df, label, prediction).withColumns(_scores(zero_division))
    metrics = ("precision", "recall", "f1")
    levels = scored.rollup("class").agg(
        F.grouping("class").alias("_all"),
        F.sum("support").alias("support"),
        F.sum("right").alias("right"),
        *[F.avg(m).alias(m) for m in metrics],
        *[F.sum(F.col(m) * F.col("support")).alias(f"{m}_w") for m in metrics],
    )

    def row(name: Column, *values: Column) -> Column:
        return F.struct(
            name.cast("string").alias("class"),
            *[v.cast("double").alias(m) for m, v in zip(metrics, values)],
            F.col("support").alias("support"),
        )

    accuracy = F.try_divide(F.col("right"), F.col("support"))
    plain = row(F.col("class"), *[F.col(m) for m in metrics])
    totals = [
        row(F.lit("accuracy"), accuracy, accuracy, accuracy),
        row(F.lit("macro avg"), *[F.col(m) for m in metrics]),
        row(F.lit("weighted avg"), *[F.try_divide(F.col(f"{m}_w"), F.col("support")) for m in metrics]),
    ]
    return levels.select(
        F.explode(F.when(F.col("_all") == 0, F.array(plain)).otherwise(F.array(*totals))).alias("r")
    ).select("r.*")


def train_test_gap(df: DataFrame, split: str = "split") -> DataFrame:
    """Binary metrics of the train and test rows side by side, and their difference."""
    names = ("accuracy", "recall", "precision", "f1")
    scores = binary_metrics(df, by=(split,))
    wide = scores.agg(
        *[
            F.max(F.when(F.col(split) == s, F.col(m))).alias(f"{s}_{m}")
            for m in names
            for s in ("train", "test")
        ]
    )
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"train_{m}").alias("train"),
            F.col(f"test_{m}").alias("test"),
            (F.col(f"train_{m}") - F.col(f"test_{m}")).alias("gap"),
        )
        for m in names
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def model_comparison(tables: dict[str, DataFrame], metric: str = "f1") -> DataFrame:
    """Metric rows of several models stacked; ``best`` marks the highest ``metric``."""
    stacked = reduce(
        DataFrame.unionByName, [t.withColumn("model", F.lit(name)) for name, t in tables.items()]
    )
    # one row per model
    models = stacked.agg(
        F.collect_list(F.struct(*stacked.columns)).alias("rows"),
        F.max_by("model", F.struct(F.col(metric), F.col("model"))).alias("first"),
    )
    return models.select("first", F.explode("rows").alias("r")).select(
        "r.*", (F.col("r.model") == F.col("first")).alias("best")
    )


def fitted_comparison(
    scored: dict[str, DataFrame], split: str = "split", metric: str = "f1", copies: str | None = None
) -> DataFrame:
    """Train and test metrics of several models with their gap, a row for each model and metric.

    Each table holds ``label``, ``prediction`` and ``split`` of the rows a model scored; all are
    counted in one aggregate.  ``best`` marks the model with the highest ``metric`` on the test
    rows (ties: the first by name).  With ``copies`` a row of a table stands for so many.
    """
    names = ("accuracy", "recall", "precision", "f1")
    kept = [split, "label", "prediction", *([copies] if copies else [])]
    rows = reduce(DataFrame.unionByName, [t.select(F.lit(m).alias("model"), *kept) for m, t in scored.items()])
    scores = binary_metrics(rows, "label", "prediction", by=("model", split), copies=copies)
    wide = scores.groupBy("model").agg(
        *[
            F.max(F.when(F.col(split) == s, F.struct(*names))).alias(s)
            for s in ("train", "test")
        ]
    )
    # one row per model
    ranked = wide.agg(
        F.collect_list(F.struct("model", "train", "test")).alias("models"),
        F.min_by("model", F.struct(-F.col("test")[metric], F.col("model"))).alias("first"),
    ).select("first", F.explode("models").alias("m"))
    lines = [
        F.struct(
            F.lit(n).alias("metric"),
            F.col("m.train")[n].alias("train"),
            F.col("m.test")[n].alias("test"),
            (F.col("m.train")[n] - F.col("m.test")[n]).alias("gap"),
        )
        for n in names
    ]
    return ranked.select(
        F.col("m.model").alias("model"),
        (F.col("m.model") == F.col("first")).alias("best"),
        F.explode(F.array(*lines)).alias("r"),
    ).select("model", "r.*", "best")
