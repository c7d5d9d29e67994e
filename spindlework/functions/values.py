"""Scalar column functions that never raise on bad values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_timestamp(column: str | Column) -> Column:
    """Timestamp text in Spark's canonical form, NULL when it is no timestamp.

    Wall-clock text is read without a zone; text that names an offset or zone is turned
    into the session's zone.
    """
    column = F.col(column) if isinstance(column, str) else column
    zoned = column.cast("string").rlike(r"(Z|[+-]\d{1,2}:\d{2}|[A-Za-z]{3,}.*)\s*$")
    return F.when(zoned, column.try_cast("timestamp").cast("string")).otherwise(
        column.try_cast("timestamp_ntz").cast("string")
    )


def round_whole(value: Column) -> Column:
    """``value`` rounded to a whole number, halves away from zero, as ``round`` gives it: the share
    beyond the point is exact, so no decimal is made of it."""
    size = F.abs(value)
    share = size % F.lit(1.0)
    # adding zero makes -0.0 and 0.0 one number
    return F.signum(value) * (size - share + F.when(share >= 0.5, 1.0).otherwise(0.0)) + F.lit(0.0)


def hex_digest(*columns: str | Column, seed: int | str = "") -> Column:
    """md5 of the columns' text, ``|`` between them, NULL as an empty text."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def record_digest(*columns: str | Column) -> Column:
    """md5 of the columns' text, each behind its length, so that only equal records agree."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    marked = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("~")) for p in parts]
    return F.md5(F.concat(*marked))


def hex_bucket(digest: Column, buckets: int) -> Column:
    """0..buckets-1 from the first eight digits of a hex digest."""
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


# Python's own reading of a cell: int(text), else float(text), else text.
_WHOLE = r"[0-9]+(_[0-9]+)*"
INT_PATTERN = rf"^\s*[+-]?{_WHOLE}\s*$"
FLOAT_PATTERN = (
    rf"^\s*[+-]?(({_WHOLE}(\.({_WHOLE})?)?|\.{_WHOLE})([eE][+-]?{_WHOLE})?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
)


def cell_type(column: Column) -> Column:
    """``int``, ``float`` or ``string``; a blank cell is a string."""
    return (
        F.when(column.isNull(), F.lit(None).cast("string"))
        .when(column.rlike(INT_PATTERN), F.lit("int"))
        .when(column.rlike(FLOAT_PATTERN), F.lit("float"))
        .otherwise(F.lit("string"))
    )


def percent_text(share: Column) -> Column:
    """``share`` as a percentage with two decimals, rounded from its exact binary value.

    The hundredth is chosen by the exact sign of ``200 p - (2 k + 1)``: ``p`` is split
    into halves whose products with 200 carry no rounding error.
    """
    p = share * F.lit(100.0)
    k = F.floor(p * 100)
    scaled = p * F.lit(134217729.0)
    high = scaled - (scaled - p)
    over = (high * 200 - (2 * k + 1)) + (p - high) * 200
    up = (over > 0) | ((over == 0) & (k % 2 == 1))
    hundredths = k + up.cast("bigint")
    return F.format_string("%d.%02d%%", F.floor(hundredths / 100), hundredths % 100)
