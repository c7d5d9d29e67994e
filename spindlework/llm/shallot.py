"""Centroid clustering by Shallot search, in whole numbers.

Every vector remembers its nearest and second-nearest centroid, an upper bound of the distance
to the first and a lower bound of the distance to all others.  When centroids have moved, the
bounds move along; where the upper one stays below the lower one, or below half the way from
the nearest centroid to the next, nothing changes and no distance is computed.  Otherwise the
scan starts from the closer of the two remembered centroids and takes the others in the order
of their distance to it.  Centroid j can be nearest or second only if its distance to the start
is at most d1 + d2, with d1 the vector's distance to the start and d2 that to the
second-nearest seen so far, so the ball shrinks with every better one and the scan ends early.
Bounds are floats with a margin; what survives them is compared by squared distances in whole
numbers, ties to the smaller number.

A round is one narrow pass over the vectors: they are read with their state, assigned, and
written with the new state, and beside them each task leaves one row a centroid with its count,
component sums and distance sum, which are added up exactly as decimals.  Only centroids (at
most ``k`` x dims numbers) come to the driver.  The states of earlier rounds are removed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import release, store

SAFE = 1 << 26  # components up to here: squared distances fit 64 bits for up to 512 of them
MARGIN = 1e-9
STATE = "vec_id long, q array<double>, near int, second int, upper double, lower double"
ROWS = f"{STATE}, distance long, cluster int, n long, sums array<decimal(38,0)>, total decimal(38,0)"


def whole_numbers(df: DataFrame, dims: int) -> DataFrame:
    """(vec_id, q) of the vectors that take part: q = floor(256 x), as doubles that are whole."""
    x = F.col("embedding").cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # doubles of 2^52 and more are whole, and their floor need not fit a long
    q = F.transform(
        x,
        lambda v: F.when(F.abs(v) < float(1 << 44), F.floor(v * 256.0).cast("double")).otherwise(v * 256.0),
    )
    return df.filter((F.size(x) == dims) & ~odd).select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"))


def matrix(column: pa.Array, dims: int, wide: bool) -> np.ndarray:
    """A list column as a matrix of whole numbers; Python ones where 64 bits may not do."""
    x = column.flatten().to_numpy().reshape(-1, dims)
    if wide or (len(x) and np.abs(x).max() > SAFE):
        return np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)
    return x.astype(np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its row of ``c`` (or to the one), in whole numbers."""
    d = x - c
    return (d * d).sum(1)


class Centroids:
    """Centroids with, for each, the others by distance."""

    def __init__(self, rows: list[list[int]]):
        self.wide = any(abs(v) > SAFE for row in rows for v in row)
        self.at = np.array(rows, object if self.wide else np.int64).reshape(len(rows), -1)
        k = len(rows)
        apart = np.array([squared(self.at, self.at[i]) for i in range(k)]).astype(float).reshape(k, k)
        self.apart = np.sqrt(apart)
        self.order = np.argsort(self.apart, axis=1, kind="stable")
        self.half = np.full(k, np.inf)
        if k > 1:
            self.half = np.sort(self.apart, axis=1)[:, 1] / 2 * (1 - MARGIN)


def root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(float))


def scan_from(x: np.ndarray, start: int, first: np.ndarray, held: np.ndarray, held_d: np.ndarray, c: Centroids):
    """Nearest and second-nearest of rows that share the centroid they start from.

    ``first``: squared distances to ``start``; ``held``, ``held_d``: the other remembered
    centroid and its squared distance.  Returns (near, d_near, second, d_second, computed).
    """
    near, d1 = np.full(len(x), start), first.copy()
    second, d2 = held.copy(), held_d.copy()
    swap = (d2 < d1) | ((d2 == d1) & (second < near))
    near[swap], second[swap] = second[swap], near[swap]
    d1[swap], d2[swap] = d2[swap], d1[swap]
    reach, ball = root(first), root(d2)
    rows, computed = np.arange(len(x)), 0
    for j in c.order[start].tolist():
        if j == start:
            continue
        # beyond the ball nothing later in the order can come closer either
        rows = rows[c.apart[start, j] * (1 - MARGIN) <= (reach[rows] + ball[rows]) * (1 + MARGIN)]
        if not len(rows):
            break
        own = rows[held[rows] != j]
        if not len(own):
            continue
        d = squared(x[own], c.at[j])
        computed += len(own)
        best = (d < d1[own]) | ((d == d1[own]) & (j < near[own]))
        a = own[best]
        second[a], d2[a] = near[a], d1[a]
        near[a], d1[a] = j, d[best]
        next_best = ~best & (d < d2[own])
        b = own[next_best]
        second[b], d2[b] = j, d[next_best]
        ball[own] = root(d2[own])
    return near, d1, second, d2, computed


def assign(x: np.ndarray, state: tuple | None, moved: np.ndarray, c: Centroids, distances: bool):
    """(near, second, upper, lower, distance, computed) of the rows of ``x``.

    ``state``: (near, second, upper, lower) of the round before, None at first; ``moved``: how
    far each centroid went since.  With ``distances`` every distance is computed anew.
    """
    n, k = len(x), len(c.at)
    computed = 0
    if state is None:
        near, second = np.zeros(n, np.int64), np.full(n, min(1, k - 1))
        upper, lower = np.full(n, np.inf), np.zeros(n)
    else:
        near, second, upper, lower = (s.copy() for s in state)
        upper = upper + moved[near]
        by = np.sort(moved)
        others = np.where(moved[near] == by[-1], by[-2] if k > 1 else 0.0, by[-1])
        lower = lower - others
    distance = np.zeros(n, x.dtype)
    if k == 1:
        return near, second, upper, lower, squared(x, c.at[0]), n
    sure = np.maximum(lower, c.half[near])
    open_ = np.flatnonzero(upper >= sure)
    todo = np.arange(n) if distances else open_
    if len(todo):  # the exact distance to the remembered centroid may settle it
        distance[todo] = squared(x[todo], c.at[near[todo]])
        computed += len(todo)
        upper[todo] = root(distance[todo]) * (1 + MARGIN)
        open_ = open_[upper[open_] >= sure[open_]]
    if len(open_):
        other = squared(x[open_], c.at[second[open_]])
        computed += len(open_)
        own = distance[open_]
        closer = (other < own) | ((other == own) & (second[open_] < near[open_]))
        start = np.where(closer, second[open_], near[open_])
        held = np.where(closer, near[open_], second[open_])
        d_start, d_held = np.where(closer, other, own), np.where(closer, own, other)
        for s in np.unique(start).tolist():
            at = np.flatnonzero(start == s)
            rows = open_[at]
            a, d1, b, d2, more = scan_from(x[rows], s, d_start[at], held[at], d_held[at], c)
            near[rows], second[rows], distance[rows] = a, b, d1
            upper[rows], lower[rows] = root(d1) * (1 + MARGIN), root(d2) * (1 - MARGIN)
            computed += more
    return near, second, upper, lower, distance, computed


def whole_sums(x: np.ndarray, near: np.ndarray, k: int) -> list:
    """Component sums of each centroid's rows as Python whole numbers."""
    if x.dtype == object:
        out = np.zeros((k, x.shape[1]), object)
        np.add.at(out, near, x)
        return out
    out = np.zeros((k, x.shape[1]), np.int64)  # a batch of SAFE components stays below 2^63
    np.add.at(out, near, x)
    return out.astype(object)


def assign_pass(rows: DataFrame, centroids: list[list[int]], moved: list[float], first: bool, last: bool) -> DataFrame:
    """Rows with their new state, and beside them each task's sums for every centroid."""
    dims = len(centroids[0])
    names = [part.split()[0] for part in ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, k = Centroids(centroids), len(centroids)
        n, total = np.zeros(k, np.int64), np.zeros(k, object)
        sums = np.zeros((k, dims), object)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                x = matrix(part.column("q"), dims, c.wide)
                if not first:
                    state = tuple(part.column(s).to_numpy() for s in ("near", "second", "upper", "lower"))
                else:
                    state = None
                near, second, upper, lower, distance, _ = assign(x, state, np.array(moved), c, last)
                n += np.bincount(near, minlength=k)
                if last:
                    np.add.at(total, near, distance.astype(object))
                else:
                    sums = sums + whole_sums(x, near, k)
                nothing = pa.nulls(len(near))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"),
                        nothing.cast(part.schema.field("q").type) if last else part.column("q"),
                        pa.array(near.astype(np.int32)),
                        pa.array(second.astype(np.int32)),
                        pa.array(upper),
                        pa.array(lower),
                        pa.array(distance.tolist() if last else [None] * len(near), pa.int64()),
                        nothing.cast(pa.int32()),
                        nothing.cast(pa.int64()),
                        nothing.cast(pa.list_(pa.decimal128(38, 0))),
                        nothing.cast(pa.decimal128(38, 0)),
                    ],
                    names=names,
                )
        some = np.flatnonzero(n).tolist()
        empty = pa.nulls(len(some))
        yield pa.RecordBatch.from_arrays(
            [
                empty.cast(pa.int64()),
                empty.cast(pa.list_(pa.float64())),
                *[empty.cast(t) for t in (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())],
                pa.array(some, pa.int32()),
                pa.array([int(n[i]) for i in some], pa.int64()),
                pa.array([[Decimal(v) for v in sums[i].tolist()] for i in some], pa.list_(pa.decimal128(38, 0))),
                pa.array([Decimal(total[i]) for i in some], pa.decimal128(38, 0)),
            ],
            names=names,
        )

    return rows.mapInArrow(run, ROWS)


def smallest_digests(vectors: DataFrame, k: int, key: Column) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``key``, in that order; ties by components."""
    rows = vectors.select("q", F.sha2(key, 256).alias("h")).orderBy("h", "q").limit(k).collect()
    return [[int(v) for v in row["q"]] for row in rows]


def moved_by(old: list[list[int]], new: list[list[int]]) -> list[float]:
    return [
        math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))) * (1 + MARGIN) for x, y in zip(old, new)
    ]


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, seed: str = "2"
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) and the centroids.

    Vectors of ``vectors`` (vec_id, embedding) that are null, of other length, or hold null or
    non-finite components take no part.  Fewer vectors than ``k`` make fewer centroids.
    Repeated rows are vectors of their own, ids may be null or repeat (their digest then has
    an empty id, or ties, which the components break).  An empty table gives an empty table;
    other columns are not read.  Distances and inertias are exact at any size of components; a
    value that no long holds raises.
    """
    spark = vectors.sparkSession
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    state = store(whole_numbers(vectors, dims), "vectors")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    centroids = smallest_digests(state, k, key)
    if not centroids:
        return spark.createDataFrame([], result), []
    moved = [0.0] * len(centroids)
    for turn in range(rounds):
        before, state = state, store(
            assign_pass(vectors_of(state, turn), centroids, moved, turn == 0, False), "clustered"
        )
        release(before)
        sums = (
            state.filter("n IS NOT NULL")
            .select("cluster", "n", F.posexplode("sums").alias("dim", "v"))
            .groupBy("cluster", "dim")
            .agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
            .collect()  # k x dims rows
        )
        new = [list(row) for row in centroids]
        for row in sums:
            new[row["cluster"]][row["dim"]] = int(row["v"]) // row["n"]
        moved, centroids = moved_by(centroids, new), new
    before, state = state, store(
        assign_pass(vectors_of(state, rounds), centroids, moved, rounds == 0, True), "clustered"
    )
    release(before)
    totals = state.filter("n IS NOT NULL").groupBy("cluster").agg(F.sum("total").alias("total")).collect()
    inertia = sum(int(row["total"]) for row in totals)
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids]
    known = spark.createDataFrame(
        [(row["cluster"], int(row["total"]), inertia, digests[row["cluster"]]) for row in totals],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    rows = state.filter("n IS NULL").select("vec_id", F.col("near").alias("cluster"), "distance")
    return rows.join(F.broadcast(known), "cluster").select(*[p.split()[0] for p in result.split(", ")]), centroids


def vectors_of(state: DataFrame, turn: int) -> DataFrame:
    """The vectors among the rows of a state."""
    if turn == 0:
        return state
    return state.filter("n IS NULL").select([p.split()[0] for p in STATE.split(", ")])


def _oracle(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Lloyd's rounds in SQL: every vector against every centroid."""
    parts = [
        f"""WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, q FROM (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})),
s AS (SELECT q, row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS c FROM v),
e AS MATERIALIZED (SELECT r, unnest(q) AS x, unnest(range({dims})) AS d FROM v),
c0 AS MATERIALIZED (SELECT c, unnest(q) AS y, unnest(range({dims})) AS d FROM s WHERE c < {k})"""
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT r, arg_min(c, (z, c)) AS c, min(z) AS z FROM (
  SELECT r, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS z FROM e JOIN c{i} USING (d) GROUP BY r, c) GROUP BY r)"""
        )
        if i < rounds:
            parts.append(
                f"""m{i} AS (SELECT c, d, CAST((t - ((t % n) + n) % n) // n AS BIGINT) AS y FROM (
  SELECT c, d, sum(x) AS t, count(*) AS n FROM e JOIN a{i} USING (r) GROUP BY c, d)),
c{i + 1} AS MATERIALIZED (SELECT c, d, coalesce(m{i}.y, c{i}.y) AS y FROM c{i} LEFT JOIN m{i} USING (c, d))"""
            )
    return (
        ",\n".join(parts)
        + f""",
h AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, z AS distance,
  CAST(sum(z) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(z) OVER () AS BIGINT) AS inertia,
  centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN h USING (c)
"""
    )


ORACLE = _oracle()
