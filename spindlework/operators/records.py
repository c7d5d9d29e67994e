"""Record-level steps: naming, defaults, ids, JSON, rejects, enrichment."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlework.functions.values import canonical_timestamp, record_digest
from spindlework.operators.joins import _free, lookup_joins
from spindlework.schemas import (
    ABSENT_DEFAULTS,
    CSV_COLUMNS,
    MODEL_COLUMNS,
    RAW_SCHEMA,
    READING_SCHEMA,
    TELEMETRY_SCHEMA,
)


def strip_bom(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def format_record(df: DataFrame, nulls_too: bool = False) -> DataFrame:
    """Raw file columns under canonical names.

    A column the input lacks becomes its default text or NULL; with ``nulls_too`` a
    NULL in a present column is replaced as well.
    """
    df = strip_bom(df)

    def pick(raw: str, name: str) -> Column:
        kind = RAW_SCHEMA[name].dataType
        default = F.lit(ABSENT_DEFAULTS.get(name)).cast(kind)
        if raw not in df.columns:
            return default.alias(name)
        value = F.col(f"`{raw}`").try_cast(kind)
        return (F.coalesce(value, default) if nulls_too else value).alias(name)

    return df.select([pick(raw, name) for raw, name in CSV_COLUMNS.items()])


def with_random_id(df: DataFrame, name: str = "id") -> DataFrame:
    return df.select(F.uuid().alias(name), *df.columns)


def with_record_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Id derived from the record, the same at every replay; NULL and empty text differ."""
    return df.select(record_digest(*df.columns).alias(name), *df.columns)


def encode_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


# A message as it came, and what is wrong with it.
PAYLOAD = T.StructType().add("_payload", T.StringType()).add("_fault", T.StringType())


def parse_json(
    df: DataFrame, schema: T.StructType = READING_SCHEMA, keep: tuple[str, ...] = (), payload: bool = False
) -> DataFrame:
    """Message ``value`` (bytes or text) as typed columns; bad fields become NULL.

    With ``payload`` each row keeps its text and its fault: ``empty`` (NULL), ``unreadable`` (no
    JSON object), ``bad field`` (a value of another type), or NULL.
    """
    text = F.col("value").cast("string")
    if not payload:
        return df.select(*keep, F.from_json(text, schema).alias("data")).select(*keep, "data.*")
    broken = "_broken"
    wide = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    parsed = df.select(
        *keep,
        text.alias("_payload"),
        F.from_json(text, wide, {"columnNameOfCorruptRecord": broken}).alias("data"),
    )
    nothing = reduce(and_, [F.col(f"data.`{c}`").isNull() for c in schema.names])
    fault = (
        F.when(F.col("_payload").isNull(), "empty")
        .when(F.col(f"data.{broken}").isNotNull() & nothing, "unreadable")
        .when(F.col(f"data.{broken}").isNotNull(), "bad field")
    )
    return parsed.select(*keep, *[F.col(f"data.`{c}`") for c in schema.names], "_payload", fault.alias("_fault"))


def parse_telemetry(df: DataFrame) -> DataFrame:
    parsed = parse_json(df, TELEMETRY_SCHEMA)
    return parsed.withColumns(
        # from the epoch, so the session's zone plays no part
        {
            c: F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {c})")
            for c in ("timestamp", "last_maintenance_date")
        }
    )


def with_reject_flag(df: DataFrame, key: str = "udi", name: str = "rejected") -> DataFrame:
    """Mark rows without a key; empty and unreadable messages are among them."""
    return df.withColumn(name, F.col(key).isNull())


def split_rejects(df: DataFrame, key: str = "udi") -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def drop_nulls(df: DataFrame) -> DataFrame:
    """Rows without a null (or NaN) in any column.

    In a batch each row gets its number before it is looked at: a filter moves below computed columns and
    computes every one of them a second time, but not below a row number.
    """
    if df.isStreaming:  # knows no row numbers
        return df.na.drop("any")
    (row,) = _free(df.columns, "row")
    return df.withColumn(row, F.monotonically_increasing_id()).na.drop("any").drop(row)


def model_columns(df: DataFrame) -> DataFrame:
    return df.select(MODEL_COLUMNS)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def enrich_readings(
    narrow: DataFrame, types: DataFrame, failures: DataFrame, products: DataFrame, moment: str = "timestamp"
) -> DataFrame:
    """Give narrow readings the ids, product texts and calendar columns of wide ones."""
    df = lookup_joins(narrow, [(types, "type"), (failures, "failure_type"), (products, "product_id")])
    at = canonical_timestamp(moment).cast("timestamp")
    return df.withColumns(
        {
            "date": F.date_format(at, "yyyy-MM-dd"),
            "day_of_week": F.date_format(at, "EEEE"),
            "quarter": F.quarter(at),
        }
    ).select(READING_SCHEMA.names)
