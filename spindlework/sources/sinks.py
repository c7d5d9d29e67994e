"""Tables written in full, and targets made when missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str | None = None, fmt: str = "parquet", **options: str) -> None:
    """Replace the target with ``df``.

    Any Spark format; connection options, secrets among them, come from the caller.
    """
    df.write.format(fmt).options(**options).mode("overwrite").save(path)


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str | None = None, fmt: str = "parquet"
) -> None:
    """Create the table if it is missing; raise when it exists with other columns."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{place}")
    found = {f.name: f.dataType for f in spark.table(name).schema.fields}
    wanted = {f.name: f.dataType for f in schema.fields}
    if found != wanted:
        raise ValueError(f"table {name} exists with columns {found}, not {wanted}")
