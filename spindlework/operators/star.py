"""Star schema: four dimensions, the fact table, and the report that reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.functions.values import canonical_timestamp
from spindlework.operators.joins import BROADCAST_BYTES, lookup_join, lookup_joins
from spindlework.operators.kpi import METRICS
from spindlework.operators.numbering import number_rows

DATE_KEYS = ["date", "day_of_week", "quarter", "timestamp"]


def failure_dim(df: DataFrame) -> DataFrame:
    return df.select("failure_type", "failure_type_id").distinct()


def type_dim(df: DataFrame) -> DataFrame:
    return df.select("type", "type_id").distinct()


def product_dim(df: DataFrame) -> DataFrame:
    return df.select("product_id", "product_name", "product_category", "manufacturer").distinct()


def date_dim(df: DataFrame) -> DataFrame:
    """Distinct calendar rows, numbered by ``date_id`` in the order of their columns."""
    calendar = df.select(
        "date", "day_of_week", "quarter", canonical_timestamp("timestamp").alias("timestamp")
    ).distinct()
    moment = F.col("timestamp").try_cast("timestamp")
    return number_rows(
        calendar.withColumns({"month": F.month(moment), "year": F.year(moment)}),
        DATE_KEYS,
        "date_id",
    ).withColumn("date_id", F.col("date_id").cast("int"))


def fact_table(
    df: DataFrame, dates: DataFrame, match: str = "normalised", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Readings with KPIs, keyed to the dimensions.

    ``match="strict"`` compares the reading's raw timestamp text with the dimension's
    canonical text; ``"normalised"`` brings the reading to canonical form first.
    """
    if match not in ("strict", "normalised"):
        raise ValueError(f"match must be 'strict' or 'normalised', not {match!r}")
    key = F.col("timestamp") if match == "strict" else canonical_timestamp("timestamp")
    measures = [
        "process_temperature",
        "tool_wear",
        "air_temperature",
        "rotational_speed",
        "torque",
        "target",
        *METRICS,
    ]
    facts = df.select(
        "udi",
        F.col("failure_type_id").alias("failure_id"),
        "product_id",
        "type_id",
        *measures,
        key.alias("timestamp"),
    )
    joined = lookup_join(facts, dates.select("timestamp", "date_id"), "timestamp", max_bytes)
    return joined.select("udi", "failure_id", "product_id", "type_id", "date_id", *measures)


def star_report(
    fact: DataFrame,
    failures: DataFrame,
    types: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Readings, failures and wear by month, machine type, failure class and category.

    Facts are combined per key tuple before any dimension is joined.
    """
    keys = ["failure_id", "type_id", "product_id", "date_id"]
    grouped = fact.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum("target").alias("failures"),
        F.sum("tool_wear").alias("wear"),
        F.max("torque").alias("max_torque"),
    )
    dimensions = [
        (failures.withColumnRenamed("failure_type_id", "failure_id"), "failure_id"),
        (types, "type_id"),
        (products.select("product_id", "product_category"), "product_id"),
        (dates.select("date_id", "year", "month"), "date_id"),
    ]
    named = lookup_joins(grouped, dimensions, max_bytes)
    return named.groupBy("year", "month", "type", "failure_type", "product_category").agg(
        F.sum("n").alias("readings"),
        F.sum("failures").alias("failures"),
        F.sum("wear").alias("total_tool_wear"),
        F.max("max_torque").alias("max_torque"),
    )
