"""Row numbers and running totals over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spindlework.plans.workspace import materialise

_POSITION_MASK = (1 << 33) - 1  # low bits of monotonically_increasing_id: row in partition


def _offsets(parts: DataFrame, part: str, size: str, offset: str) -> DataFrame:
    """Rows before each partition; one row per partition, so one task is enough."""
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    return parts.select(part, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(offset))


def number_rows(
    df: DataFrame,
    order_by: list[str] | None,
    name: str,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1..n in the order of ``order_by`` (NULLs first).

    Rows are range-partitioned and sorted inside each partition, the layout is
    written once, and every partition gets the row count of those before it.
    Without ``order_by`` rows are numbered as they lie, with no shuffle.
    """
    laid = df
    if order_by:
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        laid = df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
    laid = materialise(
        laid.withColumn("_part", F.spark_partition_id()).withColumn(
            "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK))
        ),
        "numbered",
    )
    parts = laid.groupBy("_part").agg(F.count("*").alias("_size"))
    return (
        laid.join(F.broadcast(_offsets(parts, "_part", "_size", "_before")), "_part")
        .withColumn(name, F.col("_before") + F.col("_pos") + 1)
        .select(*df.columns, name)
    )


def running_total(
    df: DataFrame,
    order_by: list[str],
    weight: str | Column,
    name: str,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name``, the sum of ``weight`` over all rows before and including each row.

    ``weight`` is a whole number, NULL counts as 0, and ``order_by`` must have no ties.  Same layout as
    :func:`number_rows`: the sum runs over the sorted rows of a range partition while they
    are written, so nothing is shuffled twice.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weight = F.col(weight) if isinstance(weight, str) else weight
    ranged = (
        df.withColumn("_w", F.coalesce(weight.cast("long"), F.lit(0)))
        .withColumn("_upto", F.col("_w"))
        .repartitionByRange(n, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.spark_partition_id())
    )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = 0
        for batch in batches:
            if batch.num_rows:
                at = batch.schema.names.index("_upto")
                total = np.cumsum(batch.column(at).to_numpy()) + so_far
                so_far = int(total[-1])
                yield batch.set_column(at, batch.schema.field(at), pa.array(total, pa.int64()))

    laid = materialise(ranged.mapInArrow(add_up, ranged.schema), "ranged")
    parts = laid.groupBy("_part").agg(F.sum("_w").alias("_size"))
    return (
        laid.join(F.broadcast(_offsets(parts, "_part", "_size", "_before")), "_part")
        .withColumn(name, F.col("_before") + F.col("_upto"))
        .select(*df.columns, name)
    )
