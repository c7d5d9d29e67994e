"""Data profile: counts, distributions, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlework.functions.values import cell_type
from spindlework.operators.numbering import running_total
from spindlework.plans.workspace import materialise
from spindlework.schemas import NUMERIC_FEATURES


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and the number of records."""
    fields = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return (
        df.agg(F.count("*").alias("records"))
        .select("records", F.explode(F.array(*fields)).alias("f"))
        .select("f.position", "f.column", "f.type", "records")
    )


def _unpivot(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """Rows (column, value), one scan for all columns."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def infer_types(df: DataFrame) -> DataFrame:
    """Narrowest type that fits every cell of each text column, with the cell counts."""
    typed = df.select([cell_type(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])
    counts = typed.agg(
        *[
            F.count_if(F.col(f"`{c}`") == kind).alias(f"{i}_{kind}")
            for i, c in enumerate(df.columns)
            for kind in ("int", "float", "string")
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{i}_{kind}").alias(f"{kind}_cells") for kind in ("int", "float", "string")],
        )
        for i, c in enumerate(df.columns)
    ]
    return (
        counts.select(F.explode(F.array(*rows)).alias("r"))
        .select("r.*")
        .withColumn(
            "inferred",
            F.when(F.col("string_cells") > 0, "string")
            .when(F.col("float_cells") > 0, "float")
            .when(F.col("int_cells") > 0, "int")
            .otherwise("string"),
        )
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), column)
    )


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def crosstab_wide(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    return df.groupBy(row).pivot(column, values).count().na.fill(0, values)


def histograms(df: DataFrame, columns: list[str] = NUMERIC_FEATURES, bins: int = 15) -> DataFrame:
    """Equal-width bin counts for all columns in one pass; the last bin is closed."""
    bounds = df.agg(
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
    ).first()
    cells, edges = [], []
    for c in columns:
        lo, hi = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        width = (hi - lo) / bins
        at = F.least(F.floor((F.col(c).cast("double") - lo) / width), F.lit(bins - 1))
        cells.append(F.struct(F.lit(c).alias("column"), at.cast("int").alias("bin")))
        edges += [(c, i, lo + i * width) for i in range(bins)]
    spark = df.sparkSession
    grid = spark.createDataFrame(edges, "column string, bin int, bin_start double")
    if not cells:
        return grid.withColumn("n", F.lit(0).cast("bigint"))
    counts = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .select("cell.*")
        .groupBy("column", "bin")
        .agg(F.count("*").alias("n"))
    )
    # both sides hold columns x bins rows
    return grid.join(counts, ["column", "bin"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )


def null_counts(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def correlation_matrix(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Pearson correlation of every column pair in long form; NULL when one is constant.

    One aggregate; each pair uses the rows in which both values are present.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]

    def pearson(a: str, b: str):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x = F.when(both, F.col(a).cast("double"))
        y = F.when(both, F.col(b).cast("double"))
        if a == b:
            # a column that varies correlates fully with itself
            return F.when(F.stddev_pop(x) > 0, F.lit(1.0))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    stats = df.agg(*[pearson(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    rows = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            rows.append(
                F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"`{i}`").alias("correlation"))
            )
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


QUARTILES = (0.25, 0.5, 0.75)


def exact_percentiles(
    df: DataFrame, columns: list[str], at: tuple[float, ...] = QUARTILES
) -> DataFrame:
    """Linear-interpolated percentiles of every column, exact at any size.

    Values are counted first (map-side), then located by a distributed running
    total over the counted values; no task sees a whole column.
    """
    counted = (
        _unpivot(df, columns, "double")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    upto = materialise(running_total(counted, ["column", "value"], "n", "upto"), "value-ranks")
    extent = upto.groupBy("column").agg(
        F.min(F.col("upto") - F.col("n")).alias("first"), F.sum("n").alias("total")
    )
    ranks = [
        F.struct(F.lit(q).alias("q"), (F.lit(q) * (F.col("total") - 1)).alias("rank")) for q in at
    ]
    wanted = extent.select("column", "first", F.explode(F.array(*ranks)).alias("w")).select(
        "column", "first", "w.q", "w.rank"
    )
    low, high = F.floor("rank"), F.ceil("rank")
    start = F.col("upto") - F.col("n") - F.col("first")  # zero-based rank of the first copy
    end = F.col("upto") - F.col("first")
    covers_low = (start <= low) & (low < end)
    covers_high = (start <= high) & (high < end)
    # one row per (column, percentile) on the right
    return (
        upto.join(F.broadcast(wanted), "column")
        .filter(covers_low | covers_high)
        .groupBy("column", "q", "rank")
        .agg(
            F.max(F.when(covers_low, F.col("value"))).alias("lo"),
            F.max(F.when(covers_high, F.col("value"))).alias("hi"),
        )
        .select(
            "column",
            "q",
            (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("rank") - F.floor("rank"))).alias("value"),
        )
    )


def describe_numeric(
    df: DataFrame, columns: list[str] = NUMERIC_FEATURES, approximate: bool = False
) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max, one row per column."""
    names = ["count", "mean", "std", "min", "max"]
    measures = []
    for c in columns:
        x = F.col(c).cast("double")
        measures += [
            F.count(x).alias(f"{c}_count"),
            F.avg(x).alias(f"{c}_mean"),
            F.stddev_samp(x).alias(f"{c}_std"),
            F.min(x).alias(f"{c}_min"),
            F.max(x).alias(f"{c}_max"),
        ]
        if approximate:
            measures.append(F.percentile_approx(x, list(QUARTILES), 10000).alias(f"{c}_q"))
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"{c}_{m}").alias(m) for m in names],
            *(
                [F.col(f"{c}_q")[i].alias(q) for i, q in enumerate(("p25", "p50", "p75"))]
                if approximate
                else []
            ),
        )
        for c in columns
    ]
    summary = df.agg(*measures).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if not approximate:
        quartiles = exact_percentiles(df, columns).groupBy("column").agg(
            *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"p{int(q * 100)}") for q in QUARTILES]
        )
        # both sides have one row per column
        summary = summary.join(quartiles, "column", "left")
    return summary.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


SKETCH_K = 400  # KLL size: ranks within about 0.7 percent at 99 percent confidence
SKETCH_LOG = 12  # HLL registers, as a power of two: counts within about 1.6 percent (one sigma)


def profile_sketches(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """(column, n, total, squares, low, high, ranks, kinds): a mergeable profile of one batch.

    ``ranks`` is a KLL sketch of the values and ``kinds`` an HLL sketch of the distinct ones.
    One aggregate without a shuffle of values; a row a column, a few kilobytes, to be kept beside
    each batch, so that a profile of all data never reads the data again.
    """
    measures = []
    for c in columns:
        x = F.col(c).cast("double")
        measures.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("n"),
                F.sum(x).alias("total"),
                F.sum(x * x).alias("squares"),
                F.min(x).alias("low"),
                F.max(x).alias("high"),
                F.kll_sketch_agg_double(x, SKETCH_K).alias("ranks"),
                F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_LOG).alias("kinds"),
            )
        )
    return df.agg(F.array(*measures).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """One profile a column from any number of :func:`profile_sketches`."""
    filled = F.col("n") > 0
    return profiles.groupBy("column").agg(
        *[F.sum(c).alias(c) for c in ("n", "total", "squares")],
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double(F.when(filled, F.col("ranks"))).alias("ranks"),
        F.hll_union_agg(F.when(filled, F.col("kinds"))).alias("kinds"),
    )


def describe_sketches(profiles: DataFrame) -> DataFrame:
    """count, mean, std, min, quartiles, max and distinct values, by column, from stored profiles.

    Counts, mean and extremes are exact; quartiles are values whose rank is within the bound of
    ``SKETCH_K``, distinct counts within that of ``SKETCH_LOG``.  A column without values has NULLs.
    """
    merged = merge_profiles(profiles)
    n, some = F.col("n"), F.col("n") > 0
    mean = F.when(some, F.col("total") / n)
    spread = (F.col("squares") - F.col("total") * F.col("total") / n) / (n - 1)
    quartile = [
        F.when(some, F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(f"p{int(q * 100)}") for q in QUARTILES
    ]
    return merged.select(
        "column",
        n.alias("count"),
        mean.alias("mean"),
        F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("std"),
        F.col("low").alias("min"),
        *quartile,
        F.col("high").alias("max"),
        F.when(some, F.hll_sketch_estimate("kinds")).otherwise(0).alias("distinct_values"),
    )


def nunique(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    Exact form: cells become (column, value) rows that are combined map-side before
    their one shuffle, in a single scan.
    """
    columns = df.columns
    names = [F.struct(F.lit(c).alias("column")) for c in columns]
    if approximate:
        counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct_values")) for c in columns]
        return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    def text(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = value + F.lit(0.0)  # -0.0 and 0.0 are one value
        return value.cast("string")

    cells = [
        F.struct(F.lit(f.name).alias("column"), text(f).alias("value")) for f in df.schema.fields
    ]
    distinct = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").distinct()
    found = distinct.groupBy("column").agg(F.count("value").alias("distinct_values"))
    every = df.sparkSession.range(1).select(F.explode(F.array(*names)).alias("r")).select("r.*")
    # one row per column on either side
    return every.join(found, "column", "left").withColumn(
        "distinct_values", F.coalesce("distinct_values", F.lit(0))
    )


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


SCATTER_PAIRS = (
    ("rotational_speed", "tool_wear", 100, 20),
    ("rotational_speed", "torque", 100, 5),
    ("rotational_speed", "process_temperature", 100, 1),
)


def scatter_points(df: DataFrame, x: str, y: str, hue: str = "failure_type") -> DataFrame:
    return df.select(x, y, hue)


def scatter_grid(df: DataFrame, pairs=SCATTER_PAIRS, hue: str = "failure_type") -> DataFrame:
    """Points per grid cell and class for each (x, y, x step, y step), one pass."""
    cells = [
        F.struct(
            F.lit(x).alias("x"),
            F.lit(y).alias("y"),
            (F.floor(F.col(x) / dx) * dx).cast("bigint").alias("x_from"),
            (F.floor(F.col(y) / dy) * dy).cast("bigint").alias("y_from"),
        )
        for x, y, dx, dy in pairs
    ]
    return (
        df.select(F.explode(F.array(*cells)).alias("c"), hue)
        .groupBy("c.x", "c.y", "c.x_from", "c.y_from", hue)
        .agg(F.count("*").alias("n"))
        .select("x", "y", "x_from", "y_from", hue, "n")
    )
