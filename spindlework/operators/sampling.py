"""Peeks and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.functions.values import hex_digest


def peek(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def sample_n(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """``n`` rows drawn at random; Spark keeps the best ``n`` of each partition."""
    return df.orderBy(F.rand(seed)).limit(n)


def sample_n_by_hash(df: DataFrame, n: int, seed: int | str, keys: list[str]) -> DataFrame:
    """``n`` rows with the smallest digest of ``keys``: the same rows at every run."""
    digest = "_digest"
    return (
        df.withColumn(digest, hex_digest(*keys, seed=seed))
        .orderBy(digest, *df.columns)
        .limit(n)
        .drop(digest)
    )


def random_record(df: DataFrame, seed: int | None = None) -> DataFrame:
    return sample_n(df, 1, seed)
