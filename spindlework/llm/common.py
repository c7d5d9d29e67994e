"""Helpers the operators share: folds, Arrow batches cut by bytes, stored steps."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlework.plans.workspace import work_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % of


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder (zstd) and go on from the written table."""
    path = f"{work_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Remove a table of :func:`store` that nothing reads any more; other tables stay."""
    spark = df.sparkSession
    folder = work_dir(spark)
    for file in df.inputFiles()[:1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if path.getParent().toUri().getPath() == _path(spark, folder):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _path(spark: SparkSession, folder: str) -> str:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        own = f"_{name}"
        while own.lower() in taken:
            own = f"_{own}"
        taken.add(own.lower())
        out.append(own)
    return out


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``max_bytes`` of text; a longer row comes alone."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start, done = 0, 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, done + max_bytes, side="right"))
        stop = max(stop, start + 1)
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])
    pa.default_memory_pool().release_unused()


def as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty."""
    raw = pc.fill_null(batch.column(column).cast(pa.binary()), b"")
    return raw.to_pylist()


_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def plain_words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII bytes, with A-Z in lower case."""
    return text.translate(_WORD).split()
