"""Train/test splits and folds that repeat on any cluster layout."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.functions.values import hex_bucket, hex_digest
from spindlework.operators.numbering import number_rows

_DIGITS = 4  # hex digits per counting round: at most 65,536 counts reach the driver
_ALL_DIGITS = 32


def random_split(df: DataFrame, test: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, held_out = df.randomSplit([1 - test, test], seed=seed)
    return train, held_out


def with_hash_split(
    df: DataFrame, keys: list[str], test: float = 0.2, seed: int | str = 42, name: str = "split"
) -> DataFrame:
    """``train``/``test`` from the digest of ``keys``, about ``test`` of the rows."""
    cut = f"{math.floor((1 - test) * 16**8):08x}"
    head = F.substring(hex_digest(*keys, seed=seed), 1, 8)
    return df.withColumn(name, F.when(head < cut, "train").otherwise("test"))


def with_folds(
    df: DataFrame, keys: list[str], folds: int = 5, seed: int | str = 42, name: str = "fold"
) -> DataFrame:
    return df.withColumn(name, hex_bucket(hex_digest(*keys, seed=seed), folds))


def with_exact_split(
    df: DataFrame, keys: list[str], test: float = 0.2, seed: int | str = 42, name: str = "split"
) -> DataFrame:
    """Exactly ceil(``test`` x rows) test rows: those with the smallest digests.

    The cut is found by counting digests by their leading digits, so the table is
    never sorted or shuffled; the result is a filter on the digest.  Only rows that
    share the very digest of the cut (copies of one another) are numbered.
    """
    digest = hex_digest(*keys, seed=seed)
    prefix, wanted = "", None
    while True:
        width = len(prefix) + _DIGITS
        counts = (
            df.select(digest.alias("d"))
            .filter(F.col("d").startswith(prefix))
            .groupBy(F.substring("d", 1, width).alias("head"))
            .count()
            .orderBy("head")
            .collect()
        )
        if wanted is None:
            wanted = math.ceil(test * sum(r["count"] for r in counts))
            if wanted == 0:
                return df.withColumn(name, F.lit("train"))
        for row in counts:
            if wanted <= row["count"]:
                break
            wanted -= row["count"]
        prefix = row["head"]
        if wanted == row["count"]:
            inside = F.substring(digest, 1, width) <= prefix
            return df.withColumn(name, F.when(inside, "test").otherwise("train"))
        if width == _ALL_DIGITS:
            break
    apart = df.filter(digest != prefix).withColumn(
        name, F.when(digest < prefix, "test").otherwise("train")
    )
    copies = number_rows(df.filter(digest == prefix), None, "_copy").withColumn(
        name, F.when(F.col("_copy") <= wanted, "test").otherwise("train")
    )
    return apart.unionByName(copies.drop("_copy"))
