"""Machine and product KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlework.operators.joins import BROADCAST_BYTES, lookup_joins
from spindlework.plans.workspace import materialise

# Fixed values of the KPI definitions.
MAX_TOOL_LIFETIME = 100
DEFECT_CLASS = "Overstrain Failure"

METRICS = [
    "deviation_from_target_process_temperature",
    "tool_efficiency",
    "defect_rate",
    "tool_wear_per_unit",
    "tool_lifetime_efficiency",
]


def with_derived_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "deviation_from_target_process_temperature": F.abs(
                F.col("process_temperature") - F.col("air_temperature")
            ),
            "tool_efficiency": 1 - F.col("tool_wear") / MAX_TOOL_LIFETIME,
        }
    )


def kpi_base(df: DataFrame) -> DataFrame:
    """One row per (type, product): everything the three grouped KPIs need.

    Readings are scanned and combined map-side once; the KPIs are then taken from
    this small table.
    """
    return df.groupBy("type", "product_id").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("failure_type") == DEFECT_CLASS, 1)).alias("defects"),
        F.sum("tool_wear").alias("wear"),
        F.max("tool_wear").alias("max_wear"),
    )


def _defect_rate(defects: Column, n: Column) -> Column:
    return defects / n * 100


def _lifetime_efficiency(max_wear: Column) -> Column:
    return (F.lit(MAX_TOOL_LIFETIME) - max_wear) / F.lit(MAX_TOOL_LIFETIME) * 100


def product_kpis(base: DataFrame) -> DataFrame:
    return base.groupBy("product_id").agg(
        _defect_rate(F.sum("defects"), F.sum("n")).alias("defect_rate"),
        _lifetime_efficiency(F.max("max_wear")).alias("tool_lifetime_efficiency"),
    )


def type_kpis(base: DataFrame) -> DataFrame:
    # (type, product) pairs are unique here, so counting products counts distinct ones
    return base.groupBy("type").agg(
        F.round(F.try_divide(F.sum("wear"), F.count("product_id")), 2).alias("tool_wear_per_unit")
    )


def defect_rate(df: DataFrame) -> DataFrame:
    return df.groupBy("product_id").agg(
        _defect_rate(
            F.count(F.when(F.col("failure_type") == DEFECT_CLASS, 1)), F.count("*")
        ).alias("defect_rate")
    )


def tool_wear_per_unit(df: DataFrame) -> DataFrame:
    return type_kpis(kpi_base(df))


def tool_lifetime_efficiency(df: DataFrame) -> DataFrame:
    return df.groupBy("product_id").agg(
        _lifetime_efficiency(F.max("tool_wear")).alias("tool_lifetime_efficiency")
    )


def with_kpis(df: DataFrame, max_bytes: int = BROADCAST_BYTES, stored: bool = False) -> DataFrame:
    """Readings with all five metrics; ``stored`` readings, a written table, are not written again."""
    base = materialise(kpi_base(df), "kpi-base")
    kpis = [(product_kpis(base), "product_id"), (type_kpis(base), "type")]
    joined = lookup_joins(with_derived_metrics(df), kpis, max_bytes, stored)
    return joined.select(*df.columns, *METRICS)
