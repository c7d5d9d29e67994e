"""Left joins of a large table with lookup tables, safe against hot keys."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindlework.plans.workspace import materialise

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 500_000
SALTS = 32  # tasks that share a hot key
HOT_SHARE = 1000  # a key is hot from one row in this many; so at most this many keys are


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` (rows and bytes, one aggregate) against the broadcast bound."""
    width = reduce(
        lambda a, b: a + b,
        [
            F.coalesce(F.octet_length(f.name), F.lit(0))
            if isinstance(f.dataType, (T.StringType, T.BinaryType))
            else F.lit(16)
            for f in df.schema.fields
        ],
    )
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= BROADCAST_ROWS and size <= max_bytes


def _free(taken: list[str], *names: str) -> list[str]:
    """Column names that are not taken."""
    low = {c.lower() for c in taken}
    return [next(n for n in (f"{'_' * k}{name}" for k in range(1, 99)) if n.lower() not in low) for name in names]


def hot_keys(left: DataFrame, keys: list[list[str]], share: int = HOT_SHARE) -> list[DataFrame]:
    """For each list of key columns, the keys that hold at least 1/``share`` of the rows, hence at
    most ``share`` of them; all lists are counted in one pass."""
    sets = sorted({tuple(on) for on in keys})
    columns = sorted({c for on in sets for c in on})
    size, which = _free(columns, "n", "set")
    counts = materialise(
        left.groupingSets([[F.col(c) for c in on] for on in sets], *columns).agg(
            F.count("*").alias(size), F.grouping_id().alias(which)
        ),
        "key-counts",
    )
    number = {on: int("".join("01"[c not in on] for c in columns), 2) for on in sets}
    total = counts.filter(F.col(which) == number[sets[0]]).agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return [
        counts.filter((F.col(which) == number[tuple(on)]) & (F.col(size) * share >= F.lit(total)))
        .select(*on)
        .na.drop("any")
        for on in keys
    ]


def lookup_joins(
    left: DataFrame,
    lookups: list[tuple[DataFrame, str | list[str]]],
    max_bytes: int = BROADCAST_BYTES,
    stored: bool = False,
) -> DataFrame:
    """``left`` left-joined with each of ``lookups`` (table, equal column names).

    Each lookup table is written once and measured.  Within the bound it is broadcast, so the
    large side is not shuffled for it.  If any is beyond, ``left`` is written once for the whole
    chain (unless it is ``stored``: a written table with at most columns added or left out), one pass
    counts its keys for all such tables, and each is joined by a shuffle in which
    a hot key's rows, and rows without a key, are dealt over ``SALTS`` tasks and the few lookup
    rows of hot keys are repeated for each.
    """
    held = []
    for right, on in lookups:
        right = materialise(right, "lookup")
        held.append((right, [on] if isinstance(on, str) else list(on), fits_broadcast(right, max_bytes)))
    columns = [*left.columns, *(c for right, on, _ in held for c in right.columns if c not in on)]
    salt, place, mark = _free(columns, "salt", "place", "hot")
    beyond = [on for _, on, fits in held if not fits]
    if beyond:
        left = left if stored else materialise(left, "lookup-left")
        own = [on for on in beyond if set(on) <= set(left.columns)]  # others come from a lookup
        hot = {tuple(on): keys for on, keys in zip(own, hot_keys(left, own))} if own else {}
        # the place of a row in the written table: the same at every attempt
        left = left.withColumn(place, F.monotonically_increasing_id())
    for right, on, fits in held:
        if fits:
            left = left.join(F.broadcast(right), on, "left")
            continue
        known = hot.get(tuple(on))
        if known is None:
            left = left.join(right, on, "left")
            continue
        marked = F.broadcast(materialise(known, "hot-keys").withColumn(mark, F.lit(True)))  # at most HOT_SHARE rows
        apart = reduce(or_, [F.col(c).isNull() for c in on], F.col(mark).isNotNull())
        dealt = F.when(apart, F.pmod(place, F.lit(SALTS))).otherwise(0).cast("int")
        repeated = F.when(F.col(mark).isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        left = left.join(marked, on, "left").withColumn(salt, dealt).drop(mark)
        right = right.join(marked, on, "left").withColumn(salt, F.explode(repeated)).drop(mark)
        left = left.join(right, [*on, salt], "left").drop(salt)
    return left.select(columns)


def lookup_join(
    left: DataFrame, right: DataFrame, on: str | list[str], max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """:func:`lookup_joins` with one table."""
    return lookup_joins(left, [(right, on)], max_bytes)
