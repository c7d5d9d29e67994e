"""Minority oversampling by interpolation between near neighbours."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.operators.neighbours import nearest_points
from spindlework.operators.numbering import running_total
from spindlework.plans.workspace import materialise

_SLICE = 10_000  # synthetic rows one generator row may give


def smote_synthetic(
    df: DataFrame,
    coords: list[str],
    label: str = "label",
    k: int = 5,
    seed: int | str = 42,
    **layout: int,
) -> DataFrame:
    """Synthetic rows that lift every smaller class to the size of the largest.

    Synthetic row ``s`` of a class with ``c`` rows starts from the class's row
    ``base`` = s mod c (rows in order of their coordinates) in its round
    ``turn`` = s div c, and moves a random share of the way to one of that row's
    ``k`` nearest neighbours of the same class.  The draw is a digest of
    (class, base, turn, seed), so it repeats on any layout.  A class of one row is
    copied.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(label).cast("int").alias("label"),
        *[(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in coords],
    ).na.drop("any")
    points = materialise(
        rows.groupBy("label", *coords).agg(F.count("*").alias("n")), "class-points"
    )
    sizes = {r["label"]: r["rows"] for r in points.groupBy("label").agg(F.sum("n").alias("rows")).collect()}
    largest = max(sizes.values(), default=0)
    plan, first = [], 0
    for name, size in sorted(sizes.items()):
        if size < largest:
            plan.append((name, size, largest - size, first))
            first += size
    classes = spark.createDataFrame(plan, "label int, class_rows long, missing long, first long")
    minority = points.join(F.broadcast(classes), "label")  # one row per class

    keys = ["label", *coords]
    placed = running_total(minority, keys, "n", "upto").withColumn(
        "start", F.col("upto") - F.col("n") - F.col("first")
    )
    # ask for one more than k: a point's nearest neighbour is itself
    copies = minority.select(*keys, F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k + 1)))).alias("_c"))
    near = nearest_points(
        minority.select(*keys), copies.drop("_c"), coords, k + 1, "label", group="label", **layout
    )
    itself = F.col("distance2") == 0
    others = F.col("copies") - itself.cast("int")
    ahead = F.col("before") - (~itself).cast("int")
    choices = (
        near.select(
            F.col("label").cast("int").alias("label"),
            *coords,
            ahead.alias("ahead"),
            F.least(others, F.lit(k) - ahead).alias("slots"),
            F.array(*[f"nb_{c}" for c in coords]).alias("to"),
        )
        .filter(F.col("slots") > 0)
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("ahead", "slots", "to")).alias("near"), F.sum("slots").alias("k_eff"))
    )
    # both sides hold each point once
    source = placed.join(choices, keys, "left")
    rounds = F.floor(F.col("missing") / F.col("class_rows")) + 1
    n_slices = F.ceil(F.col("n") * rounds / _SLICE)
    sliced = source.withColumn("rounds", rounds).withColumn(
        "slice", F.explode(F.sequence(F.lit(0).cast("long"), n_slices - 1))
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lo = F.col("slice") * _SLICE
    hi = F.least(lo + _SLICE, F.col("n") * F.col("rounds")) - 1
    spread = sliced.repartition(parts, "label", "start", "slice").withColumn(
        "t", F.explode(F.sequence(lo, hi))
    )
    drawn = (
        spread.withColumn("base", F.col("start") + F.col("t") % F.col("n"))
        .withColumn("turn", F.floor(F.col("t") / F.col("n")))
        .filter(F.col("turn") * F.col("class_rows") + F.col("base") < F.col("missing"))
        .withColumn(
            "_d", F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in ("label", "base", "turn")], F.lit(str(seed))))
        )
        .withColumn("_pick", F.conv(F.substring("_d", 1, 8), 16, 10).cast("long") % F.col("k_eff"))
        .withColumn("_u", F.conv(F.substring("_d", 9, 8), 16, 10).cast("long") / F.lit(4294967296.0).cast("double"))
        .withColumn(
            "_to",
            F.filter(
                "near",
                lambda c: (c["ahead"] <= F.col("_pick")) & (F.col("_pick") < c["ahead"] + c["slots"]),
            )[0]["to"],
        )
    )
    moved = [
        F.coalesce(F.col(c) + F.col("_u") * (F.col("_to")[i] - F.col(c)), F.col(c)).alias(c)
        for i, c in enumerate(coords)
    ]
    return drawn.select("label", "base", "turn", *moved)


def smote_oversample(
    df: DataFrame, coords: list[str], label: str = "label", origin: bool = False, **options
) -> DataFrame:
    """The given rows and the synthetic ones, marked; ``origin`` keeps what a synthetic row came from."""
    given = df.select(
        F.col(label).cast("int").alias("label"), *[F.col(c).cast("double").alias(c) for c in coords]
    ).withColumn("synthetic", F.lit(False))
    made = smote_synthetic(df, coords, label, **options).withColumn("synthetic", F.lit(True))
    both = given.unionByName(made, allowMissingColumns=True)
    return both if origin else both.drop("base", "turn")


def resampled(ready: DataFrame, width: int, seed: int | str = 42, **options) -> DataFrame:
    """(features, label) with every class lifted to the size of the largest; ``features`` has
    ``width`` entries.  Features of a category may come out between its slots."""
    names = [f"x{i}" for i in range(width)]
    cells = vector_to_array("features")
    flat = ready.select("label", *[cells[i].alias(n) for i, n in enumerate(names)])
    both = smote_oversample(materialise(flat, "to-resample"), names, seed=seed, **options)
    return both.select(array_to_vector(F.array(*names)).alias("features"), F.col("label").cast("double").alias("label"))


def resampled_rounds(
    ready: DataFrame, folds: int, width: int, fold: str = "fold", seed: int | str = 42, **options
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(train, test) of each round of a cross-validation.

    Only the rows outside the round's fold are resampled, so no synthetic row comes from, or
    lies beside, a row that the model is then measured on.
    """
    for k in range(folds):
        train = ready.filter(F.col(fold) != k).select("features", "label")
        yield resampled(train, width, seed, **options), ready.filter(F.col(fold) == k).select("features", "label")
