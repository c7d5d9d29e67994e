"""Exact k nearest neighbours as two cogrouped joins over space partitions.

Copies are collapsed first: a point is a distinct (group, coordinates, label) with
its number of copies, a query a distinct (group, coordinates).  A sample of each group gives
median splits that cut space into leaves, at most ``TOP_LEAVES`` in all, so the broadcast tree is
bounded; points and queries are shuffled by leaf.  Round one finds each query's best ``k`` inside
its own leaf, which bounds its search radius; round two sends the query to exactly those other
leaves whose bounding box reaches into that radius.

Inside a task the points of a leaf are cut further, by medians of themselves, into small ones of
``SMALL`` points.  A query visits the nearest of these first, then, set by set for all queries at
once, those its radius still reaches; the radius shrinks with every better point, so a query meets
a few of them, however many points the leaf has: the leaves follow
the table and the work of a query does not.  Large leaves are cut into chunks, so no task holds
an unbounded group, and a task emits at most ``k`` points per query.  Neighbours are ordered by
distance, then label, then coordinates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spindlework.operators.joins import lookup_join
from spindlework.plans.workspace import materialise

LEAF_ROWS = 16_384
SAMPLE_PER_LEAF = 64
TOP_LEAVES = 4096  # bounds the broadcast tree and, with SAMPLE_PER_LEAF, the driver's sample
SMALL = 256  # points of a leaf inside a task
NEAREST_FIRST = 2  # of these a query visits before the others in reach are taken in turn
QUERY_CHUNK = 20_000
POINT_CHUNK = 100_000
_BLOCK_CELLS = 1_000_000  # distances held at once by a task
_SLACK = 64 * np.finfo(float).eps  # times the squared sum of two lengths: rounding of a product, with room


@dataclass
class SplitTree:
    """Median splits of one group in heap order, with the box of every node."""

    first_leaf: int
    depth: int
    axis: np.ndarray
    cut: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    weight: np.ndarray | None = None

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.ones(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + (x[rows, self.axis[node]] > self.cut[node])
        return node - self.leaves + self.first_leaf

    def set_boxes(self, low: np.ndarray, high: np.ndarray, weight: np.ndarray) -> None:
        n, d = low.shape
        self.low = np.full((2 * n, d), np.inf)
        self.high = np.full((2 * n, d), -np.inf)
        self.low[n:], self.high[n:], self.weight = low, high, weight
        for node in range(n - 1, 0, -1):
            self.low[node] = np.minimum(self.low[2 * node], self.low[2 * node + 1])
            self.high[node] = np.maximum(self.high[2 * node], self.high[2 * node + 1])

    def _nearest_in_box(self, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        # same order of operations as the point distances, so rounding cannot exceed them
        gap = np.maximum(np.maximum(self.low[node] - x, x - self.high[node]), 0.0)
        total = np.square(gap[:, 0])
        for j in range(1, x.shape[1]):
            total += np.square(gap[:, j])
        return total

    def radius_bound(self, x: np.ndarray, k: int) -> np.ndarray:
        """Squared distance within which some single leaf surely holds ``k`` points."""
        bound = np.full(len(x), np.inf)
        for leaf in np.nonzero(self.weight >= k)[0]:
            node = leaf + self.leaves
            total = 0.0
            for j in range(x.shape[1]):
                far = np.maximum(np.abs(x[:, j] - self.low[node, j]), np.abs(x[:, j] - self.high[node, j]))
                total = total + far * far
            bound = np.minimum(bound, total)
        return bound

    def reach(self, x: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs whose box lies within the row's squared radius."""
        rows = np.arange(len(x))
        node = np.ones(len(x), dtype=np.int64)
        for level in range(self.depth + 1):
            near = self._nearest_in_box(x[rows], node) <= radius[rows]
            filled = np.isfinite(self.low[node, 0])
            rows, node = rows[near & filled], node[near & filled]
            if level < self.depth:
                rows = np.repeat(rows, 2)
                node = np.repeat(2 * node, 2)
                node[1::2] += 1
        return rows, node - self.leaves + self.first_leaf


def _grow(sample: np.ndarray, points: int, first_leaf: int, leaf_rows: int) -> SplitTree:
    depth = max(0, math.ceil(math.log2(max(1, points) / leaf_rows)))
    depth = min(depth, max(0, int(math.log2(max(1, len(sample) / 8)))))
    axis = np.zeros(1 << depth, dtype=np.int64)
    cut = np.zeros(1 << depth)
    members = {1: np.arange(len(sample))}
    for node in range(1, 1 << depth):
        rows = members.pop(node)
        if len(rows):
            part = sample[rows]
            axis[node] = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            values = part[:, axis[node]]
            cut[node] = np.median(values)
            if cut[node] == values.max():  # many equal values: keep both sides filled
                below = values[values < cut[node]]
                cut[node] = below.max() if len(below) else cut[node]
            right = values > cut[node]
            members[2 * node], members[2 * node + 1] = rows[~right], rows[right]
        else:
            members[2 * node] = members[2 * node + 1] = rows
    return SplitTree(first_leaf, depth, axis, cut)


def _small_leaves(p: np.ndarray) -> list[np.ndarray]:
    """Rows of ``p`` in sets of at most ``SMALL``, halved along the widest axis."""
    out, todo = [], [np.arange(len(p))]
    by_axis = np.ascontiguousarray(p.T)
    while todo:
        rows = todo.pop()
        part = by_axis[:, rows]
        spread = part.max(axis=1) - part.min(axis=1)
        axis = int(np.argmax(spread))
        if len(rows) <= SMALL or not spread[axis] > 0:
            out.append(rows)
            continue
        half = len(rows) // 2
        order = np.argpartition(part[axis], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return out


def _squares(gaps: list[np.ndarray]) -> np.ndarray:
    """Sum of squares, always in the order of the coordinates, so that boxes and points round alike."""
    total = np.square(gaps[0])
    for gap in gaps[1:]:
        total += np.square(gap)
    return total


def _best(q: np.ndarray, p: np.ndarray, radius: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query row, point row, squared distance) of up to ``k`` points per query; ties by point row.

    Candidates come from a matrix product, whose rounding ``slack`` bounds from above; what is
    returned, compared and cut at ``k`` are distances summed coordinate by coordinate.
    """
    none = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)
    if not len(q) or not len(p):
        return none
    # a coordinate in which all agree adds nothing
    agree = (p == p[0]).all(axis=0) & (q == p[0]).all(axis=0)
    use = np.flatnonzero(~agree) if not agree.all() else np.array([0])
    q, p, dims = q[:, use], p[:, use], len(use)
    leaves = _small_leaves(p)
    place, edges = np.concatenate(leaves), np.cumsum([0, *map(len, leaves)])
    laid = p[place]
    low, high = (f.reduceat(laid, edges[:-1], axis=0) for f in (np.minimum, np.maximum))
    centre = (low + high) / 2
    laid = laid - np.repeat(centre, np.diff(edges), axis=0)
    norm = np.square(laid).sum(1)
    reach = np.sqrt(np.maximum.reduceat(norm, edges[:-1]))
    factors = np.ascontiguousarray(np.column_stack((-2 * laid, norm, np.ones(len(laid)))).T)
    out: list[tuple[np.ndarray, ...]] = []
    step = max(1, _BLOCK_CELLS // len(leaves))
    for start in range(0, len(q), step):
        x, limit = q[start : start + step], radius[start : start + step]
        box = _squares(
            [np.maximum(np.maximum(low[:, j, None] - x[:, j], x[:, j] - high[:, j, None]), 0.0) for j in range(dims)]
        )
        near, bound = np.full((len(x), k), np.inf), limit.copy()
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def visit(rows: np.ndarray, leaf: int) -> None:
            """Note the candidates of ``rows`` in a leaf and shrink their bounds."""
            at = slice(edges[leaf], edges[leaf + 1])
            y = x[rows] - centre[leaf]
            own = np.square(y).sum(1)
            slack = _SLACK * np.square(np.sqrt(own) + reach[leaf])
            about = np.column_stack((y, np.ones(len(y)), own)) @ factors[:, at]
            some = np.flatnonzero(~(about.min(1) > bound[rows] + slack))
            rows, about, slack = rows[some], about[some], slack[some, None]
            if len(rows):
                best = np.partition(about, k - 1, axis=1)[:, :k] if about.shape[1] > k else about
                near[rows] = np.sort(np.concatenate((near[rows], best + slack), 1), 1)[:, :k]
                bound[rows] = np.fmin(bound[rows], near[rows, k - 1])
                r, c = np.nonzero(~(about > bound[rows, None] + slack))
                found.append((rows[r], place[edges[leaf] + c]))

        with np.errstate(invalid="ignore", over="ignore"):
            active = np.arange(len(x))
            for _ in range(NEAREST_FIRST):
                leaf = box[:, active].argmin(0)  # the nearest one not visited
                gap = box[leaf, active]
                go = (gap <= bound[active]) & np.isfinite(gap)
                active, leaf = active[go], leaf[go]
                if not len(active):
                    break
                box[leaf, active] = np.inf
                order = np.argsort(leaf, kind="stable")
                for at in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
                    visit(active[at], leaf[at[0]])
            for leaf in range(len(leaves) if len(active) else 0):
                rows = np.flatnonzero((box[leaf] <= bound) & np.isfinite(box[leaf]))
                if len(rows):
                    visit(rows, leaf)
            if not found:
                continue
            rows, cols = (np.concatenate(c) for c in zip(*found))
            value = _squares([x[rows, j] - p[cols, j] for j in range(dims)])
        keep = value <= np.fmin(bound, limit)[rows]
        rows, cols, value = rows[keep], cols[keep], value[keep]
        order = np.lexsort((cols, value, rows))
        rows, cols, value = rows[order], cols[order], value[order]
        keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        out.append((rows[keep] + start, cols[keep], value[keep]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else none


def _search(
    queries: DataFrame,
    points: DataFrame,
    coords: list[str],
    k: int,
    label: str,
    group: str | None = None,
    places: bool = True,
    leaf_rows: int = LEAF_ROWS,
    query_chunk: int = QUERY_CHUNK,
    point_chunk: int = POINT_CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """The nearest points, by query id, and the distinct queries; without ``places`` the points'
    coordinates are neither carried nor used to order points of one distance and label."""
    spark = points.sparkSession
    g = group or "_group"
    if group is None:
        queries, points = queries.withColumn(g, F.lit(0)), points.withColumn(g, F.lit(0))
    # adding zero makes -0.0 and 0.0 one coordinate
    as_double = [(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in coords]
    group_text = F.col(g).cast("string").alias(g)
    points = materialise(
        points.select(group_text, *as_double, F.col(label).cast("double").alias("neighbour_label"))
        .na.drop("any")
        .groupBy(g, *coords, "neighbour_label")
        .agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies")),
        "points",
    )
    queries = materialise(
        queries.select(group_text, *as_double)
        .na.drop("any")
        .distinct()
        .withColumn("qid", F.monotonically_increasing_id()),
        "neighbour-queries",
    )

    sizes = {r[g]: r["count"] for r in points.groupBy(g).count().collect()}
    leaf_rows = max(leaf_rows, sum(sizes.values()) // TOP_LEAVES)
    shares = {name: min(1.0, SAMPLE_PER_LEAF * (size // leaf_rows + 1) / size) for name, size in sizes.items()}
    sample = points.sampleBy(g, shares, seed=7).select(g, *coords).toPandas()
    trees: dict[str, SplitTree] = {}
    first_leaf = 0
    for name, size in sorted(sizes.items()):
        rows = sample.loc[sample[g] == name, coords].to_numpy(dtype=float)
        trees[name] = _grow(rows, size, first_leaf, leaf_rows)
        first_leaf += trees[name].leaves

    def route_with(shared):
        def route(names: pd.Series, *columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            leaf = np.full(len(x), -1, dtype=np.int64)
            for name, tree in shared.value.items():
                mine = (names == name).to_numpy()
                if mine.any():
                    leaf[mine] = tree.leaf_of(x[mine])
            return pd.Series(leaf)

        return F.pandas_udf(route, "bigint")

    route = route_with(spark.sparkContext.broadcast(trees))
    points = materialise(points.withColumn("leaf", route(g, *coords)), "routed-points")
    boxes = (
        points.groupBy("leaf")
        .agg(
            F.count("*").alias("rows"),
            F.sum("copies").alias("weight"),
            *[F.min(c).alias(f"lo_{c}") for c in coords],
            *[F.max(c).alias(f"hi_{c}") for c in coords],
        )
        .toPandas()
        .set_index("leaf")
    )
    for tree in trees.values():
        span = boxes.reindex(range(tree.first_leaf, tree.first_leaf + tree.leaves))
        tree.set_boxes(
            span[[f"lo_{c}" for c in coords]].fillna(np.inf).to_numpy(dtype=float),
            span[[f"hi_{c}" for c in coords]].fillna(-np.inf).to_numpy(dtype=float),
            span["weight"].fillna(0).to_numpy(),
        )
    shared = spark.sparkContext.broadcast(trees)

    shown = coords if places else []
    nb = [f"nb_{c}" for c in shown]
    found_schema = ", ".join(
        ["qid bigint", "distance2 double", "neighbour_label double"]
        + [f"`{c}` double" for c in nb]
        + ["copies int"]
    )
    home_schema = f"{found_schema}, radius double"

    def search(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values(["neighbour_label", *shown], kind="stable")
        q, p, d = _best(
            asked[coords].to_numpy(dtype=float),
            known[coords].to_numpy(dtype=float),
            asked["radius"].to_numpy(dtype=float),
            k,
        )
        found = known[["neighbour_label", *shown, "copies"]].iloc[p].reset_index(drop=True)
        found.columns = ["neighbour_label", *nb, "copies"]
        found.insert(0, "distance2", d)
        found.insert(0, "qid", asked["qid"].to_numpy()[q])
        return found

    def search_home(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        """Found points, each with the radius its query has from all of them."""
        found = search(asked, known)
        upto = found.groupby("qid")["copies"].cumsum()
        found["radius"] = found["distance2"].where(upto >= k, np.inf).groupby(found["qid"]).transform("min")
        return found

    def probe(asked: DataFrame, with_radius: bool = False) -> DataFrame:
        """Search every (query, leaf) row of ``asked`` inside its leaf."""
        per_leaf = {r["leaf"]: r["count"] for r in asked.groupBy("leaf").count().collect()}
        layout = [
            (int(leaf), -(-n // query_chunk), -(-int(boxes.at[leaf, "rows"]) // point_chunk))
            for leaf, n in per_leaf.items()
            if leaf in boxes.index
        ]
        chunks = spark.createDataFrame(layout, "leaf bigint, q_chunks bigint, p_chunks bigint")
        zero = F.lit(0).cast("bigint")
        asked = (
            asked.join(F.broadcast(chunks), "leaf")  # one row per leaf
            .withColumn("q", F.pmod("qid", "q_chunks"))
            .withColumn("p", F.explode(F.sequence(zero, F.col("p_chunks") - 1)))
        )
        known = (
            points.join(F.broadcast(chunks), "leaf")
            .withColumn("p", F.pmod(F.xxhash64(*coords, "neighbour_label"), F.col("p_chunks")))
            .withColumn("q", F.explode(F.sequence(zero, F.col("q_chunks") - 1)))
        )
        keys = ["leaf", "q", "p"]
        return (
            asked.select(*keys, "qid", *coords, "radius")
            .groupBy(*keys)
            .cogroup(known.select(*keys, *coords, "neighbour_label", "copies").groupBy(*keys))
            .applyInPandas(
                search_home if with_radius else search, home_schema if with_radius else found_schema
            )
        )

    def others(batches):
        """Leaves, other than its own, that a query's radius reaches into."""
        for batch in batches:
            x = batch[coords].to_numpy(dtype=float)
            radius = batch["radius"].to_numpy(dtype=float).copy()
            for name, tree in shared.value.items():
                mine = np.nonzero((batch[g] == name).to_numpy())[0]
                if not len(mine):
                    continue
                open_ended = mine[~np.isfinite(radius[mine])]
                if len(open_ended):
                    radius[open_ended] = tree.radius_bound(x[open_ended], k)
                rows, leaf = tree.reach(x[mine], radius[mine])
                rows = mine[rows]
                away = leaf != batch["leaf"].to_numpy()[rows]
                out = batch[["qid", *coords]].iloc[rows[away]].reset_index(drop=True)
                out["radius"] = radius[rows[away]]
                out["leaf"] = leaf[away]
                yield out

    home = materialise(
        queries.withColumn("leaf", route(g, *coords)).withColumn("radius", F.lit(float("inf"))),
        "routed-queries",
    )
    first = materialise(probe(home, with_radius=True), "near-points")
    # a query in a leaf without points has no radius yet
    reached = first.groupBy("qid").agg(F.min("radius").alias("near"))
    asked_schema = ", ".join(
        ["qid bigint", *[f"`{c}` double" for c in coords], "radius double", "leaf bigint"]
    )
    away = materialise(
        home.join(reached, "qid", "left")
        .select(g, "qid", *coords, F.coalesce("near", "radius").alias("radius"), "leaf")
        .mapInPandas(others, asked_schema),
        "far-queries",
    )
    found = first.drop("radius").unionByName(probe(away))
    # at most k rows per query and visited leaf come in
    order = W.partitionBy("qid").orderBy("distance2", "neighbour_label", *nb)
    upto = F.sum("copies").over(order.rowsBetween(W.unboundedPreceding, 0))
    kept = found.withColumn("before", upto - F.col("copies")).filter(F.col("before") < k)
    return kept, queries


def nearest_points(
    queries: DataFrame,
    points: DataFrame,
    coords: list[str],
    k: int,
    label: str,
    group: str | None = None,
    **layout: int,
) -> DataFrame:
    """Nearest points of every distinct query, until ``k`` copies are reached.

    Output: group, ``qid``, query coordinates, ``distance2``, ``neighbour_label``,
    ``nb_<coordinate>``, ``copies`` (capped at ``k``) and ``before``, the copies nearer
    than this row.  With ``group``, queries only see points of their own group.
    """
    kept, asked = _search(queries, points, coords, k, label, group, **layout)
    nb = [f"nb_{c}" for c in coords]
    return kept.join(asked, "qid").select(  # one row per query
        *([group] if group else []), "qid", *coords, "distance2", "neighbour_label", *nb, "copies", "before"
    )


def knn_predict(
    test: DataFrame,
    train: DataFrame,
    coords: list[str],
    label: str = "label",
    k: int = 5,
    name: str = "prediction",
    **layout: int,
) -> DataFrame:
    """Majority label of the ``k`` nearest training rows; a tie takes the smallest."""
    near, asked = _search(test, train, coords, k, label, places=False, **layout)
    used = F.least(F.col("copies"), F.lit(k) - F.col("before"))
    votes = near.groupBy("qid", "neighbour_label").agg(F.sum(used).alias("votes"))
    winner = (
        votes.groupBy("qid")
        .agg(F.min(F.struct(-F.col("votes"), F.col("neighbour_label").alias("l")))["l"].alias(name))
        .join(asked.select("qid", *coords), "qid")  # one row per query
    )
    keyed = test.withColumns({c: F.col(c).cast("double") + F.lit(0.0) for c in coords})
    return lookup_join(keyed, winner.drop("qid"), coords)
