"""The whole warehouse load: five tables replaced in order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spindlework.operators.kpi import with_kpis
from spindlework.operators.star import date_dim, fact_table, failure_dim, product_dim, type_dim
from spindlework.sources.sinks import write_table

TABLES = ("failure_dim", "type_dim", "product_dim", "date_dim", "fact_table")


def parquet_target(spark: SparkSession, folder: str) -> tuple[Callable, Callable]:
    """(write, read) functions for a warehouse kept as parquet folders."""

    def write(df: DataFrame, name: str) -> None:
        write_table(df, f"{folder}/{name}")

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    return write, read


def load_star(
    readings: DataFrame,
    write: Callable[[DataFrame, str], None],
    read: Callable[[str], DataFrame],
    match: str = "normalised",
) -> None:
    """Build and replace the four dimensions, then the fact table.

    Each dimension scans only its own columns; the fact table uses the ``date_id``
    that was stored, not a second numbering.
    """
    write(failure_dim(readings), "failure_dim")
    write(type_dim(readings), "type_dim")
    write(product_dim(readings), "product_dim")
    write(date_dim(readings), "date_dim")
    write(fact_table(with_kpis(readings), read("date_dim"), match), "fact_table")
