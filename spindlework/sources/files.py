"""CSV files and stored tables."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlework.operators.records import strip_bom
from spindlework.schemas import RAW_CSV_SCHEMA

CORRUPT = "_corrupt_record"


def csv_scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header; types are inferred when no schema is given."""
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return strip_bom(reader.csv(path))


HEAD_BYTES = 1 << 16  # read at a time until a header's line ends


def _first_line(path: str) -> bytes:
    """First line of a file, in any file system that pyarrow can open."""
    from pyarrow import fs

    if path.startswith("file:"):
        system, place = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        system, place = fs.FileSystem.from_uri(path)
    line = b""
    with system.open_input_file(place) as source:
        while b"\n" not in line and (block := source.read(HEAD_BYTES)):
            line += block
    return line.partition(b"\n")[0].removesuffix(b"\r")


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = [_first_line(p).decode("utf-8", "replace") for p in batch.column("path").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), batch.column("path")], names=["header", "path"])


def _headers(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Header line -> files that start with it.

    Tasks open the files and read on until the first line ends, so the pass costs the same for
    small and large files; only groups of equal headers come to the driver, with the paths that
    Spark's reader is given next.  Where pyarrow doesn't know the file system, Spark reads the
    first lines, and passes over all of them.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path")
    if spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).toUri().getScheme() in _OPENED:
        parts = spark.sparkContext.defaultParallelism
        lines = found.repartition(parts).mapInArrow(_first_lines, "header string, path string")
        lines = lines.filter("header <> ''")
    else:
        lines = (
            spark.read.option("pathGlobFilter", "*.csv")
            .text(folder)
            .select(
                F.col("value"),
                F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"),
                F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("at"),
            )
            .filter(F.col("start") == 0)
            .groupBy("path")
            .agg(F.min_by("value", "at").alias("header"))
        )
    groups = lines.groupBy("header").agg(F.collect_list("path").alias("paths"))
    return {row["header"]: row["paths"] for row in groups.collect()}


_OPENED = (None, "file", "s3", "gs", "hdfs")


def _header_names(header: str) -> list[str]:
    return [c.lstrip("\ufeff").strip() for c in next(csv.reader([header]))]


def csv_folder(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = RAW_CSV_SCHEMA,
    one_header: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """All ``*.csv`` files of a folder: (records, rejected lines).

    Each file is read by its own header, so column order may differ between files;
    columns outside ``schema`` are dropped and absent ones are NULL.  A line that does
    not fit is rejected with its file name and the rest of the file is read on.
    ``one_header=True`` skips the pass that looks at every file's first line.  A
    missing folder raises.
    """
    if one_header:
        names = strip_bom(
            spark.read.option("header", True).option("pathGlobFilter", "*.csv").csv(folder)
        ).columns
        groups = [(names, [folder])]
    else:
        groups = [(_header_names(h), files) for h, files in _headers(spark, folder).items()]
    kinds = {f.name: f.dataType for f in schema.fields}
    records, rejects = [], []
    for names, paths in groups:
        fields = [T.StructField(n, kinds.get(n, T.StringType())) for n in names]
        rows = (
            spark.read.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())]))
            .option("header", True)
            .option("pathGlobFilter", "*.csv")
            .option("mode", "PERMISSIVE")
            .option("columnPruning", False)  # judge every cell, also of columns not selected
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(paths)
        )
        fit = rows.filter(F.col(CORRUPT).isNull())
        records.append(
            fit.select(
                *[
                    (F.col(f"`{n}`") if n in names else F.lit(None)).cast(k).alias(n)
                    for n, k in kinds.items()
                ]
            )
        )
        # Spark refuses to read the corrupt column alone, so a second one is looked at
        line = F.coalesce(CORRUPT, F.col(f"`{names[0]}`").cast("string"))
        rejects.append(
            rows.filter(F.col(CORRUPT).isNotNull() & line.isNotNull()).select(
                F.col("_metadata.file_name").alias("file"), line.alias("line")
            )
        )
    if not records:
        empty = spark.createDataFrame([], schema)
        return empty, spark.createDataFrame([], "file string, line string")
    first, *more = zip(records, rejects)
    good, bad = first
    for r, b in more:
        good, bad = good.unionByName(r), bad.unionByName(b)
    return good, bad


def stored_table(
    spark: SparkSession, path: str | None = None, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Full scan of a stored table; any Spark format and its options."""
    return spark.read.format(fmt).options(**options).load(path)
