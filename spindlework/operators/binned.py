"""Tree ensembles on one binned table, shared by every fit of a search.

Features are cut into at most ``MAX_BINS`` bins, and rows that agree in bins, label and fold
become one cell with a weight, so all fits read the same small table and never the features.
A tree grows level by level from sums over (node, feature, bin).  Sums are of whole numbers
(weights, and gradients in steps of 1 / ``STEPS``), hence the same in any order and on any
layout.  Bootstrap weights and feature choices are digests of the cell or node, the tree and the
seed, so a tree does not depend on which others are grown.  Four things follow:

* draws that differ only in their number of trees (boosting and forest) or in depth (forest) are
  one fit, scored at each prefix of its trees and at each depth;
* forests that differ in their least leaf share draws, and trees that no least changes; boosting fits that
  draw alike share them, and cells that no tree of theirs tells apart are one group (``Groups``);
* within ``CELL_BYTES`` the table is sent to the tasks and each takes fits, or trees of a forest, of
  its own; cells that differ in fold only are added up there, and of two sister nodes only the
  smaller is summed, the other is what its parent has left;
* beyond it, fits go one after another, each level's sums a distributed aggregate over the
  table's partitions, with the same trees as the result.

Boosting is one softmax ensemble: a round fits a regression tree for each class to the gradients of
all classes (Friedman 2001), with Newton leaf values.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlework.plans.workspace import materialise

MAX_BINS = 64
STEPS = float(1 << 20)
CELL_BYTES = 192 * 1024 * 1024
TOGETHER = 1024  # nodes of a level whose sums are held at once; even, so that sisters stay together
STRIDE = 16  # rounds after which the margins of a distributed fit are written
PACKED = 4096  # joint bins of features that are summed in one pass
BATCH = 1 << 15  # cells that are drawn at a time
GROUPS = 512  # of cells that a search's boosted trees tell apart; beyond, every fit reads cells
VOTE_BYTES = 768 * 1024 * 1024  # of a task of a forest search

# --- the binned table ------------------------------------------------------------


def bin_edges(
    df: DataFrame, features: str = "features", max_bins: int = MAX_BINS, copies: str | None = None
) -> list[list[float]]:
    """Upper edges of each feature's bins but the last: midpoints of its values if they are
    few, else approximate quantiles.  With ``copies`` a row stands for so many."""
    number = (F.col(copies) if copies else F.lit(1)).cast("int").alias("c")
    cells = df.select(number, F.posexplode(vector_to_array(features)).alias("i", "v")).filter(~F.isnan("v"))
    counts = materialise(cells.groupBy("i", "v").agg(F.count("*").alias("n")), "feature-values")
    kinds = {r["i"]: r["n"] for r in counts.groupBy("i").agg(F.count("*").alias("n")).collect()}
    few = [i for i, n in kinds.items() if n <= max_bins]
    edges: list[list[float]] = [[] for _ in range(max(kinds, default=-1) + 1)]
    values: dict[int, list[float]] = {i: [] for i in few}
    for r in counts.filter(F.col("i").isin(few)).select("i", "v").collect():  # max_bins a feature
        values[r["i"]].append(r["v"])
    for i, own in values.items():
        own.sort()
        edges[i] = [(a + b) / 2 for a, b in zip(own, own[1:])]
    if len(few) < len(kinds):
        shares = [k / max_bins for k in range(1, max_bins)]
        cut = F.percentile_approx("v", shares, 100 * max_bins)
        many = cells.filter(~F.col("i").isin(few))
        if copies:
            many = many.select("i", "v", F.explode(F.sequence(F.lit(1), F.col("c"))))
        for r in many.groupBy("i").agg(cut.alias("cuts")).collect():
            edges[r["i"]] = sorted(set(r["cuts"]))
    return edges


def to_bins(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bin of each value; a missing one goes with the largest."""
    out = np.zeros(x.shape, np.uint8)
    for i, own in enumerate(edges):
        out[:, i] = np.searchsorted(np.array(own), x[:, i], side="left")
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def cells(df: DataFrame, edges: list[list[float]], fold: str | None = None, copies: str | None = None) -> DataFrame:
    """(bins, label, fold, w, key): distinct rows of (features, label, fold) with their number, that of
    their ``copies`` if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = to_bins(_matrix(batch.column("x"), len(edges)), edges)
            rows = pa.array([row.tobytes() for row in bins], pa.binary())
            rest = ["label", "fold", "n"]
            yield pa.RecordBatch.from_arrays([rows, *[batch.column(c) for c in rest]], names=["bins", *rest])

    given = df.select(
        vector_to_array("features").alias("x"),
        F.col("label").cast("int").alias("label"),
        (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
        (F.col(copies) if copies else F.lit(1)).cast("long").alias("n"),
    )
    rows = given.mapInArrow(run, "bins binary, label int, fold int, n long")
    counted = rows.groupBy("bins", "label", "fold").agg(F.sum("n").alias("w"))
    return materialise(counted.withColumn("key", F.xxhash64("bins", "label", "fold")), "cells")


@dataclass
class Table:
    """Cells as arrays."""

    bins: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    w: np.ndarray
    key: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch | pa.Table) -> Table:
        label, fold, w, key = (batch.column(c).to_numpy() for c in ("label", "fold", "w", "key"))
        raw = batch.column("bins")
        parts = raw.chunks if isinstance(raw, pa.ChunkedArray) else [raw]
        bins = [_bytes(x) for x in parts if len(x)]
        bins = np.concatenate(bins) if bins else np.zeros((0, 0), np.uint8)
        return Table(bins, label.astype(np.int64), fold, w.astype(float), key.view(np.uint64))

    @cached_property
    def n_bins(self) -> int:
        return int(self.bins.max()) + 1 if self.bins.size else 1

    @cached_property
    def columns(self) -> np.ndarray:
        """Bins, a row a feature."""
        return np.ascontiguousarray(self.bins.T)

    @cached_property
    def packs(self) -> list[tuple[list[int], list[int], np.ndarray]]:
        """Neighbouring features in sets of at most ``PACKED`` joint bins: (features, bins of each, joint bin of
        every cell)."""
        out, features, dims = [], [], []
        sizes = (self.columns.max(1).astype(np.int64) + 1).tolist() if len(self.label) else []
        for f, size in enumerate(sizes):
            if features and np.prod(dims) * size > PACKED:
                out.append((features, dims))
                features, dims = [], []
            features, dims = [*features, f], [*dims, size]
        out += [(features, dims)] if features else []
        return [(fs, ds, np.ravel_multi_index([self.columns[f] for f in fs], ds)) for fs, ds in out]

    @cached_property
    def by_class(self) -> dict[int, list[np.ndarray]]:
        """Joint bins with the label, kept for each number of classes asked for."""
        return {}

    @cached_property
    def merged(self) -> tuple[Table, np.ndarray]:
        """The table without regard to folds, and each cell's place in it."""
        padded = np.pad(self.bins, ((0, 0), (0, -self.bins.shape[1] % 8)))
        words = np.column_stack((padded.view(np.uint64), self.label.view(np.uint64)))
        order = np.lexsort(words.T)
        new = np.ones(len(order), bool)
        new[1:] = (words[order][1:] != words[order][:-1]).any(1)
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        first = order[new]
        w = np.bincount(at, self.w, len(first))
        return Table(self.bins[first], self.label[first], np.full(len(first), -1, np.int32), w, self.key[first]), at


def _bytes(column: pa.Array) -> np.ndarray:
    """Values of one length as rows of bytes."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].reshape(len(column), -1)


def fits_tasks(table: DataFrame, features: int, max_bytes: int = CELL_BYTES) -> bool:
    return table.count() * (features + 24) <= max_bytes


# --- draws by digest --------------------------------------------------------------


def mixed(x: np.ndarray | int, salt: int) -> np.ndarray:
    """Digest of 64-bit numbers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):  # it wraps by design
        x = np.asarray(x, np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(times)
        x ^= x >> np.uint64(31)
        return x


def uniform(key: np.ndarray, salt: int) -> np.ndarray:
    return (mixed(key, salt) >> np.uint64(11)) / float(1 << 53)


@lru_cache(maxsize=4096)
def _upto(w: int, rate: float | None) -> np.ndarray:
    """Chances of at most 0, 1, ... draws, the last but one below 1."""
    p = np.exp(-w) if rate is None else (1 - rate) ** w
    out, k = [p], 0
    while p > 0 and out[-1] < 1 and k < (2000 if rate is None else w - 1):
        k += 1
        p *= w / k if rate is None else (w - k + 1) / k * rate / (1 - rate)
        out.append(min(out[-1] + p, 1.0))
    return np.array(out) if w else np.zeros(0)


def _passed(ends: np.ndarray, at: np.ndarray, plain: int = 4) -> np.ndarray:
    """How many of the ascending ``ends`` each number has reached, most of them few."""
    out = np.zeros(len(at), np.int64)
    for end in ends[:plain]:
        out += at >= end
    if len(ends) > plain:
        far = np.flatnonzero(out == plain)
        out[far] += np.searchsorted(ends[plain:], at[far], side="right")
    return out


def drawn(key: np.ndarray, w: np.ndarray, salt: int, rate: float | None = None) -> np.ndarray:
    """How often each cell of ``w`` rows is drawn: Poisson(w), or binomial(w, rate), by
    inversion of its distribution."""
    out = np.zeros(len(key))
    # beyond this the chance of no draw is no number any more
    most = 500 if rate is None else min(500, int(-300 / np.log10(1 - rate)))
    wide = w > most  # by the normal law, cut to what is possible
    own = np.where(wide, 0, w).astype(np.int64) if wide.any() else w.astype(np.int64)
    kinds = np.flatnonzero(np.bincount(own)) if len(own) else own
    steps = [_upto(int(n), rate) + n for n in kinds]
    starts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
    if len(starts) <= 2 * len(kinds) + 1:  # cells in order of weight
        ends = dict(zip(kinds.tolist(), steps))
        for first, last in zip(starts, starts[1:]):
            for at in range(first, last, BATCH):
                part, n = slice(at, min(at + BATCH, last)), int(own[at])
                out[part] = _passed(ends[n], uniform(key[part], salt) + n)
    else:
        # one list, ascending, for all weights
        ends, before = np.concatenate(steps or [np.zeros(0)]), np.zeros(501, np.int64)
        before[kinds] = np.cumsum([0, *map(len, steps)])[:-1]
        out = (np.searchsorted(ends, uniform(key, salt) + own, side="right") - before[own]).astype(float)
    if wide.any():
        u = uniform(key[wide], salt)
        spread = np.sqrt(w[wide] if rate is None else w[wide] * rate * (1 - rate))
        mean = w[wide] if rate is None else w[wide] * rate
        z = np.sqrt(-2 * np.log(1 - u)) * np.cos(2 * np.pi * uniform(key[wide], salt + 1))
        out[wide] = np.clip(np.rint(mean + spread * z), 0, np.inf if rate is None else w[wide])
    return out


# --- one tree ------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes in the order they were made; feature -1 marks a leaf."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    child: list[int] = field(default_factory=list)  # left one; the right one follows
    value: list[np.ndarray] = field(default_factory=list)

    def step(self, node: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """Each row's node one level further down."""
        feature, cut, child = np.array(self.feature), np.array(self.cut), np.array(self.child)
        f = feature[node]
        down = np.flatnonzero(f >= 0)
        right = bins[down, f[down]] > cut[node[down]]
        out = node.copy()
        out[down] = child[node[down]] + right
        return out


def descend(tree: Tree, bins: np.ndarray, stops: list[int] | None = None) -> list[np.ndarray]:
    """Each row's node at the depths ``stops`` (ascending), or its leaf."""
    feature, cut, child = np.array(tree.feature), np.array(tree.cut), np.array(tree.child)
    node, rows, out, depth = np.zeros(len(bins), np.int64), np.arange(len(bins)), [], 0
    while True:
        while stops and len(out) < len(stops) and stops[len(out)] == depth:
            out.append(node.copy())
        f = feature[node[rows]]
        rows, f = rows[f >= 0], f[f >= 0]
        if not len(rows) or (stops and len(out) == len(stops)):
            return out + [node] * (len(stops or [0]) - len(out))
        at = node[rows]
        node[rows] = child[at] + (bins[rows, f] > cut[at])
        depth += 1


def placed(tree: Tree, columns: np.ndarray, stops: list[int], seen: dict) -> list[np.ndarray]:
    """As :func:`descend`, a node's rows at a time, for trees of few nodes; trees of the same rows share
    ``seen``, the rows that the same splits lead to."""
    size = columns.shape[1]
    out, todo = [np.zeros(size, np.int64) for _ in stops], [(0, np.arange(size), (), 0)]
    while todo:
        node, rows, path, depth = todo.pop()
        f, cut = tree.feature[node], tree.cut[node]
        for stop, to in zip(stops, out):
            if stop == depth or (stop > depth and f < 0):
                to[rows] = node
        if f < 0 or depth == stops[-1] or not len(rows):
            continue
        path = (*path, f, cut) if path is not None else None
        parts = seen.get(path) if path else None
        if parts is None:
            right = columns[f][rows] > cut
            parts = rows[~right], rows[right]
            if path:
                seen[path] = parts
        for side in (0, 1):
            kept = path is not None and len(parts[side]) > size // 32
            todo.append((tree.child[node] + side, parts[side], (*path, side) if kept else None, depth + 1))
    return out


def sums_of(bins: np.ndarray, slot: np.ndarray, values: np.ndarray, slots: int, n_bins: int) -> np.ndarray:
    """Sums of each column of ``values`` by (slot, feature, bin); slot -1 takes no part."""
    own = np.flatnonzero(slot >= 0)
    base, out = slot[own] * n_bins, np.zeros((slots, bins.shape[1], n_bins, values.shape[1]))
    columns = [values[own, j] for j in range(values.shape[1])]
    for f in range(bins.shape[1]):
        at = base + bins[own, f]
        for j, column in enumerate(columns):
            out[:, f, :, j] = np.bincount(at, column, slots * n_bins).reshape(slots, n_bins)
    return out


class NodeSums:
    """A growing tree's rows, in sets by node, and the sums of its newest nodes.

    ``add(rows, slot, slots, f)`` sums a feature by (slot, bin), ``total(rows, slot, slots)`` gives a
    node's value, and ``closed(value)`` the nodes that no split can follow.  ``whole`` holds the sums of
    all rows, if they are known; ``parted``, that a node's value is its sums over the bins of any feature.
    Trees of the same weights may share ``seen``: nodes of many rows that the same splits lead to.
    """

    def __init__(
        self, t: Table, rows: np.ndarray, add: Callable, total: Callable, closed: Callable,
        whole: np.ndarray | None = None, parted: bool = False, seen: dict | None = None,
    ):
        self.columns, self.add, self.total, self.closed = t.columns, add, total, closed
        self.whole, self.parted, self.seen = whole, parted, seen
        self.many = len(rows) // 32
        self.rows = {0: rows}
        self.path: dict[int, tuple] = {0: ()}  # of nodes of many rows
        self.level: list[int] = []  # nodes of the level asked for
        self.sums: dict[int, np.ndarray] = {}
        self.sums_above: dict[int, np.ndarray] = {}

    def move(self, tree: Tree) -> None:
        """Rows of the last level's nodes to their children."""
        for node in self.level:
            f = tree.feature[node]
            if f >= 0:
                rows, child = self.rows.pop(node), tree.child[node]
                path = (*self.path.pop(node), f, tree.cut[node]) if node in self.path else None
                known = self.seen.get(path) if self.seen is not None and path else None
                if known is None:
                    right = self.columns[f][rows] > tree.cut[node]
                    known = rows[~right], rows[right]
                    if self.seen is not None and path:
                        self.seen[path] = known
                for side in (0, 1):
                    self.rows[child + side] = known[side]
                    if path and len(known[side]) > self.many:
                        self.path[child + side] = (*path, side)

    def _summed(self, nodes: list[int]) -> np.ndarray:
        kept = {n: ("sums", self.path[n]) for n in nodes if n in self.path} if self.seen is not None else {}
        found = {n: self.seen[k] for n, k in kept.items() if k in self.seen}
        rest = [n for n in nodes if n not in found]
        if rest == [0] and self.whole is not None:
            own = self.whole[None]
        elif rest or not nodes:
            parts = [self.rows[n] for n in rest]
            rows = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            slot = np.repeat(np.arange(len(rest)), [len(x) for x in parts])
            own = np.stack([self.add(rows, slot, len(rest), f) for f in range(len(self.columns))], 1)
        if len(rest) == len(nodes):
            out = own
        else:
            found |= {n: own[i] for i, n in enumerate(rest)}
            out = np.stack([found[n] for n in nodes])
        for i, n in enumerate(nodes):
            if n in kept:
                self.seen[kept[n]] = out[i]
        return out

    def _values(self, tree: Tree, level: list[int], parent: dict[int, int]) -> np.ndarray:
        """Values of a level's nodes, from the sums above if they are there."""
        if self.parted and level == [0] and self.whole is not None:
            return self.whole[0].sum(0)[None]
        if self.parted and all(n in parent for n in level):
            out = []
            for n in level:
                above = parent[n]
                sums, cut = self.sums_above[above][tree.feature[above]], tree.cut[above] + 1
                out.append(sums[:cut].sum(0) if n == tree.child[above] else sums[cut:].sum(0))
            return np.stack(out)
        own = [self.rows[n] for n in level]
        slot = np.repeat(np.arange(len(level)), [len(x) for x in own])
        return self.total(np.concatenate(own), slot, len(level))

    def __call__(self, tree: Tree, level: list[int], last: bool) -> tuple[np.ndarray | None, np.ndarray]:
        if level[0] not in self.rows:  # a new level, not a further piece of the last
            self.move(tree)
            self.sums_above, self.sums, self.level = self.sums, {}, []
        self.level = self.level + level
        split = [n for n in self.sums_above if tree.feature[n] >= 0]
        parent = {tree.child[n] + side: n for n in split for side in (0, 1)}
        value = self._values(tree, level, parent)
        if last:
            return None, value
        shut = self.closed(value)
        direct, derived = [], []
        for at in range(0, len(level), 2):
            pair = level[at : at + 2]
            if shut[at : at + 2].all():
                continue
            if len(pair) == 2 and pair[0] in parent:
                small = int(len(self.rows[pair[1]]) < len(self.rows[pair[0]]))
                direct.append(pair[small])
                derived.append((at, small, parent[pair[0]]))
            else:
                direct += [n for n, s in zip(pair, shut[at : at + 2]) if not s]
        found = self._summed(direct)
        out = np.zeros((len(level), *found.shape[1:]))
        out[np.array(direct, np.int64) - level[0]] = found
        for at, small, above in derived:
            out[at + 1 - small] = self.sums_above[above] - out[at + small]
        if len(self.level) == len(level) and len(level) < TOGETHER:  # the level in one piece
            self.sums = {n: out[i] for i, n in enumerate(level) if not shut[i]}
        else:
            self.sums = {}
        return out, value

    def places(self, size: int) -> np.ndarray:
        """Each row's last node."""
        out = np.zeros(size, np.int64)
        for node, rows in self.rows.items():
            out[rows] = node
        return out


def gini_gain(left: np.ndarray, right: np.ndarray, total: np.ndarray) -> np.ndarray:
    """How much the weighted impurity falls, from class weights on each side and in all."""

    def pure(x):
        return np.einsum("...c,...c->...", x, x) / np.maximum(x.sum(-1), 1e-300)

    return pure(left) + pure(right) - pure(total)


def square_gain(left: np.ndarray, right: np.ndarray, total: np.ndarray) -> np.ndarray:
    """How much the squared error falls, from (sum, weight) on each side and in all."""

    def square(x):
        return x[..., 0] ** 2 / np.maximum(x[..., 1], 1e-300)

    return square(left) + square(right) - square(total)


def grow(
    gain: Callable,
    weigh: Callable[[np.ndarray], np.ndarray],
    depth: int,
    least: float,
    features_at: Callable[[list[int], int], np.ndarray] | None = None,
    min_gain: float = 0.0,
) -> Generator[tuple[Tree, list[int], bool], np.ndarray | tuple, Tree]:
    """Grow a tree level by level: yields (tree, newest nodes, whether they are the last), is sent
    their sums, or sums and values (of the last, values alone matter), returns the tree.

    ``weigh`` takes the rows' weight from sums; a side of fewer than ``least`` rows is no split, nor
    is one that gains less than ``min_gain`` a row.  Ties go to the smaller feature, then the smaller
    bin.  A level of more than ``TOGETHER`` nodes comes in pieces.
    """
    tree = Tree([-1], [0], [0], [None])
    level, marks = [0], [1]
    for d in range(depth + 1):
        new_level, new_marks = [], []
        for first in range(0, len(level), TOGETHER):
            part, own = level[first : first + TOGETHER], marks[first : first + TOGETHER]
            answer = yield tree, part, d == depth
            total, value = answer if isinstance(answer, tuple) else (answer, answer[:, 0].sum(1))
            for at, node in enumerate(part):
                tree.value[node] = value[at]
            if d == depth:
                continue
            whole = total.sum(2, keepdims=True)
            left = np.cumsum(total, 2)[:, :, :-1]
            right = whole - left
            enough = (weigh(left) >= least) & (weigh(right) >= least)
            won = np.where(enough, gain(left, right, whole), -np.inf)
            if features_at is not None:
                won[~features_at(own, won.shape[1])] = -np.inf
            if not won.shape[2]:
                continue
            flat = won.reshape(len(part), -1)
            best = flat.argmax(1)
            needed = 1e-9 * np.maximum(np.abs(total).max((1, 2, 3)), 1.0)
            if min_gain:
                needed = np.maximum(needed, min_gain * weigh(whole)[:, 0, 0])
            split = np.flatnonzero(flat[np.arange(len(part)), best] > needed)
            below = [mixed(np.array(own, np.uint64)[split], side + 1).tolist() for side in (0, 1)]
            for i, at in enumerate(split.tolist()):
                node, (f, cut) = part[at], divmod(int(best[at]), won.shape[2])
                tree.feature[node], tree.cut[node], tree.child[node] = f, cut, len(tree.feature)
                for side in (0, 1):
                    new_level.append(len(tree.feature))
                    new_marks.append(below[side][i])
                    tree.feature.append(-1)
                    tree.cut.append(0)
                    tree.child.append(0)
                    tree.value.append(None)
        level, marks = new_level, new_marks
    return tree


def finish(growing: Generator, sums: Callable[[Tree, list[int], bool], np.ndarray | tuple]) -> Tree:
    """The tree of :func:`grow` with every level's sums from ``sums``."""
    ask = next(growing)
    while True:
        try:
            ask = growing.send(sums(*ask))
        except StopIteration as end:
            return end.value


def numbered(node: np.ndarray, level: list[int]) -> np.ndarray:
    """Place of each row's node in its level, -1 for rows that stopped above."""
    slot = node - level[0]
    return np.where((slot >= 0) & (slot < len(level)), slot, -1)


# --- forest ---------------------------------------------------------------------------


def class_sums(t: Table, w: np.ndarray, classes: int) -> np.ndarray:
    """Weights of all cells by (feature, bin, class)."""
    if classes not in t.by_class:
        t.by_class[classes] = [code * classes + t.label for _, _, code in t.packs]
    out = np.zeros((len(t.columns), t.n_bins, classes))
    for (features, dims, _), code in zip(t.packs, t.by_class[classes]):
        joint = np.bincount(code, w, int(np.prod(dims)) * classes).reshape(*dims, classes)
        for i, f in enumerate(features):
            out[f, : dims[i]] = joint.sum(tuple(j for j in range(len(dims)) if j != i))
    return out


def forest_tree(
    t: Table, w: np.ndarray, number: int, seed: int, depth: int, least: int, classes: int, min_gain: float = 0.0,
    whole: np.ndarray | None = None, seen: dict | None = None,
) -> tuple[Tree, NodeSums]:
    """A tree of the forest on cells of drawn weights ``w``, and where its rows ended.

    Trees of the same weights may share ``whole``, their :func:`class_sums`, and ``seen`` (:class:`NodeSums`).
    """
    size, columns = t.n_bins * classes, t.columns
    last: list = [None, None, None]  # rows, their places without the bin, and weights: the same for all features

    def add(rows: np.ndarray, slot: np.ndarray, slots: int, f: int) -> np.ndarray:
        if last[0] is not rows:
            last[:] = rows, slot * size + t.label[rows], w[rows]
        at = last[1] + columns[f][rows].astype(np.int64) * classes
        return np.bincount(at, last[2], slots * size).reshape(slots, t.n_bins, classes)

    def total(rows: np.ndarray, slot: np.ndarray, slots: int) -> np.ndarray:
        return np.bincount(slot * classes + t.label[rows], w[rows], slots * classes).reshape(slots, classes)

    def closed(value: np.ndarray) -> np.ndarray:
        return (value.max(1) >= value.sum(1)) | (value.sum(1) < 2 * least)

    whole = class_sums(t, w, classes) if whole is None and len(w) else whole
    sums = NodeSums(t, np.flatnonzero(w > 0), add, total, closed, whole, True, seen)
    return finish(forest_growth(number, seed, depth, least, min_gain), sums), sums


def forest_growth(number: int, seed: int, depth: int, least: int, min_gain: float = 0.0) -> Generator:
    return grow(gini_gain, lambda s: s.sum(-1), depth, least, feature_choice(number, seed), min_gain)


def feature_choice(number: int, seed: int) -> Callable[[list[int], int], np.ndarray]:
    """The root of the number of features (rounded up) that each node may split on."""

    def choose(marks: list[int], n: int) -> np.ndarray:
        keep = int(np.ceil(np.sqrt(n)))
        marks = mixed(np.array(marks, np.uint64), seed * 1_000_003 + number)
        ranks = np.stack([mixed(marks, f + 11) for f in range(n)], 1).argsort(1).argsort(1)
        return ranks < keep

    return choose


def shares(tree: Tree) -> np.ndarray:
    """Class shares of each node."""
    own = np.array(tree.value)
    return own / np.maximum(own.sum(1, keepdims=True), 1e-300)


def tree_depth(tree: Tree) -> int:
    feature, child = np.array(tree.feature), np.array(tree.child)
    level, depth = np.zeros(1, np.int64), 0
    while len(level := level[feature[level] >= 0]):
        level, depth = np.concatenate((child[level], child[level] + 1)), depth + 1
    return depth


def least_of(tree: Tree) -> float:
    """The smallest weight beside a split.  With any least up to it the same splits are the best ones,
    as those that a larger least rules out were not chosen without it."""
    return min((v.sum() for v in tree.value[1:]), default=np.inf)


class Votes:
    """Sums of class shares at some depths, one array for all depths that no tree has told apart."""

    def __init__(self, rows: int, classes: int, depths: list[int]):
        self.of = dict.fromkeys(depths, np.zeros((rows, classes)))

    def part(self, depth: int) -> None:
        """Depths below that of a tree come apart."""
        for d in self.of:
            if d < depth and sum(x is self.of[d] for x in self.of.values()) > 1:
                self.of[d] = self.of[d].copy()

    def add(self, shares_at: Callable[[int], np.ndarray]) -> None:
        done = set()
        for d in sorted(self.of, reverse=True):
            if id(self.of[d]) not in done:
                done.add(id(self.of[d]))
                self.of[d] += shares_at(d)


def by_weight(t: Table, held: int) -> np.ndarray:
    """The cells outside a fold in the order of their weights."""
    own = np.flatnonzero(t.fold != held)
    return own[np.argsort(t.w[own], kind="stable")]


def forest_prefixes(
    t: Table, held: int, seed: int, wanted: dict[int, set[tuple[int, int]]], classes: int
) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(least, trees, depth, predictions of the held-out cells) for each pair of trees and depth wanted of a
    forest of each least leaf.  Forests draw the same rows, and share the trees that no least changes."""
    whole, at = t.merged
    own = by_weight(t, held)
    key, weight, place = t.key[own], t.w[own], at[own]
    test, back = np.unique(at[t.fold == held], return_inverse=True)
    bins, few = whole.bins[test], len(test) // 256
    columns = np.ascontiguousarray(bins.T)
    most = {least: max(n for n, _ in pairs) for least, pairs in wanted.items()}
    votes = {least: Votes(len(test), classes, sorted({d for _, d in pairs})) for least, pairs in wanted.items()}
    for number in range(max(most.values())):
        w = np.bincount(place, drawn(key, weight, seed * 7919 + 2 * number), len(whole.w))
        todo = sorted(least for least in wanted if number < most[least])
        sums, seen, seen_test = class_sums(whole, w, classes), {} if len(todo) > 1 else None, {}
        while todo:
            deep = max(d for least in todo for d in votes[least].of)
            tree, _ = forest_tree(whole, w, number, seed, deep, todo[0], classes, 0.0, sums, seen)
            limit = max(least_of(tree), todo[0])
            same, todo = [x for x in todo if x <= limit], [x for x in todo if x > limit]
            reached, given = tree_depth(tree), shares(tree)
            stops = sorted({min(d, reached) for x in same for d in votes[x].of})
            nodes = placed(tree, columns, stops, seen_test) if len(given) < few else descend(tree, bins, stops)
            found = {d: given[node] for d, node in zip(stops, nodes)}
            for least in same:
                votes[least].part(reached)
                votes[least].add(lambda d: found[min(d, reached)])
                for d, own_votes in votes[least].of.items():
                    if (number + 1, d) in wanted[least]:
                        yield least, number + 1, d, own_votes.argmax(1)[back]


# --- boosting -------------------------------------------------------------------------


def softmax(margin: np.ndarray) -> np.ndarray:
    if margin.shape[1] == 2:
        first = 1 / (1 + np.exp(np.minimum(margin[:, 1] - margin[:, 0], 700)))
        return np.stack((first, 1 - first), 1)
    e = np.exp(margin - margin.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradients(share: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A class's gradients from its shares and which rows are its own, and what their Newton steps
    are divided by, in whole steps."""
    r = own - share
    size = np.abs(r)
    return np.rint(r * STEPS), np.rint(size * (1 - size) * STEPS)


def mirrored(tree: Tree) -> Tree:
    """The tree of the other of two classes, whose gradients are the same with the sign changed."""
    return Tree(tree.feature, tree.cut, tree.child, [v * (-1.0, 1.0, 1.0) for v in tree.value])


def weight_of(sums: np.ndarray) -> np.ndarray:
    return sums[..., 1]


def leaf(value: np.ndarray, classes: int) -> float:
    """Newton step of a node from its (gradients, weight, divisor)."""
    if value[2] < 1:
        return 0.0
    return float((classes - 1) / classes * value[0] / value[2])


@dataclass
class Boosted:
    """A softmax ensemble on binned features."""

    edges: list[list[float]]
    classes: int
    start: list[float]
    rate: float
    rounds: list[list[Tree]] = field(default_factory=list)

    def margins(self, bins: np.ndarray, begin: np.ndarray | None = None, first: int = 0) -> np.ndarray:
        out = np.tile(self.start, (len(bins), 1)) if begin is None else begin.copy()
        for trees in self.rounds[first:]:
            for k, tree in enumerate(trees):
                out[:, k] += self.rate * self.values(tree)[self.leaves(tree, bins)]
        return out

    def values(self, tree: Tree) -> np.ndarray:
        return np.array([leaf(v, self.classes) for v in tree.value])

    @staticmethod
    def leaves(tree: Tree, bins: np.ndarray) -> np.ndarray:
        return descend(tree, bins)[0]

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``prediction``."""
        edges, score = self.edges, self.margins

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(edges)))
            return pd.Series(score(to_bins(rows, edges)).argmax(1).astype(float))

        return df.withColumn("prediction", predict(vector_to_array(features)))


def prior(weights: np.ndarray) -> list[float]:
    """Logarithms of the classes' shares; of one without rows, that of a thousandth row."""
    own = np.maximum(weights, 1e-3)
    return np.log(own / own.sum()).tolist()


def boost(
    t: Table,
    edges: list[list[float]],
    classes: int,
    trees: int,
    rate: float,
    depth: int,
    least: int,
    subsample: float,
    seed: int,
    held: int = -2,
    each: Callable[[int, np.ndarray, np.ndarray], None] | None = None,
) -> Boosted:
    """Fit within a task; ``each(rounds, margins, places)`` sees the margins after every round, and the
    place among them of every cell of ``t``."""
    train = np.where(t.fold == held, 0.0, t.w)
    model = Boosted(edges, classes, prior(np.bincount(t.label, train, classes)), rate)
    whole, at = t.merged
    size, columns, every = whole.n_bins, whole.columns, np.arange(len(whole.w))
    margin = np.tile(model.start, (len(whole.w), 1))
    w = np.bincount(at, train, len(whole.w))
    for number in range(trees):
        if subsample < 1:
            w = np.bincount(at, drawn(t.key, train, seed * 7919 + 2 * number, subsample), len(whole.w))
        share, found, weights = softmax(margin), [], {}  # weights of the root, the same for all classes
        for k in range(classes if classes != 2 else 1):
            r, h = gradients(share[:, k], whole.label == k)
            r *= w
            h *= w

            def add(rows: np.ndarray, slot: np.ndarray, slots: int, f: int, r=r, w=w, weights=weights) -> np.ndarray:
                if slots == 1 and len(rows) == len(every):
                    if f not in weights:
                        weights[f] = np.bincount(columns[f], w, size)
                    both = [np.bincount(columns[f], r, size), weights[f]]
                else:
                    place = columns[f][rows] + slot * size
                    both = [np.bincount(place, x[rows], slots * size) for x in (r, w)]
                return np.stack(both, 1).reshape(slots, size, 2)

            def total(rows: np.ndarray, slot: np.ndarray, slots: int, r=r, h=h, w=w) -> np.ndarray:
                if slots == 1 and len(rows) == len(every):
                    return np.array([[x.sum() for x in (r, w, h)]])
                return np.stack([np.bincount(slot, x[rows], slots) for x in (r, w, h)], 1)

            sums = NodeSums(whole, every, add, total, lambda value: value[:, 1] < 2 * least)
            tree = finish(grow(square_gain, weight_of, depth, least), sums)
            found.append((tree, sums.places(len(every))))
        if classes == 2:
            found.append((mirrored(found[0][0]), found[0][1]))
        for k, (tree, node) in enumerate(found):
            margin[:, k] += rate * model.values(tree)[node]
        model.rounds.append([tree for tree, _ in found])
        if each is not None:
            each(number + 1, margin, at)
    return model


class ManyGroups(Exception):
    """Trees tell more groups of cells apart than are kept."""


class Groups:
    """Cells of one label that no split so far tells apart: in all fits that share them they have one margin,
    so a round costs what the groups cost, and weights are summed by (group, feature, bin) for all fits at once.

    A split that runs through a group parts it; what a fit keeps by group it passes on with :meth:`stretched`.
    """

    def __init__(self, t: Table, most: int = GROUPS):
        self.t, self.most, self.w = t, most, np.zeros(len(t.w))
        kinds = np.unique(t.label)
        if len(kinds) > most:
            raise ManyGroups
        self.label, self.parent = kinds.tolist(), [-1] * len(kinds)
        self.number = np.searchsorted(kinds, t.label)
        self.rows = [np.flatnonzero(self.number == g) for g in range(len(kinds))]
        self.places = [self.number * int(np.prod(dims)) + code for _, dims, code in t.packs]
        self.low, self.high = ([end(t.bins[rows], 0) for rows in self.rows] for end in (np.min, np.max))
        self.sums = np.zeros((most, len(t.columns), t.n_bins))

    def _added(self, groups: int, places: list[np.ndarray], w: np.ndarray) -> np.ndarray:
        out = np.zeros((groups, *self.sums.shape[1:]))
        for (features, dims, _), place in zip(self.t.packs, places):
            joint = np.bincount(place, w, groups * int(np.prod(dims))).reshape(groups, *dims)
            for i, f in enumerate(features):
                out[:, f, : dims[i]] = joint.sum(tuple(j + 1 for j in range(len(dims)) if j != i))
        return out

    def weigh(self, w: np.ndarray) -> None:
        """Weights of the cells from now on."""
        self.w = w
        self.sums[: len(self.parent)] = self._added(len(self.parent), self.places, w)

    def stretched(self, x: np.ndarray) -> np.ndarray:
        """Values by group for the groups made since, too: those of the groups they come from."""
        if len(x) == len(self.parent):
            return x
        out = np.concatenate((x, np.zeros((len(self.parent) - len(x), *x.shape[1:]), x.dtype)))
        for g in range(len(x), len(out)):
            out[g] = out[self.parent[g]]
        return out

    def split(self, g: int, f: int, cut: int) -> int:
        """The group of a group's cells beyond a cut; the others stay."""
        rows, new = self.rows[g], len(self.parent)
        if new == self.most:
            raise ManyGroups
        right = self.t.columns[f][rows] > cut
        parts = rows[~right], rows[right]
        for place, (_, dims, code) in zip(self.places, self.t.packs):
            place[parts[1]] = new * int(np.prod(dims)) + code[parts[1]]
        self.number[parts[1]] = new
        self.parent.append(g)
        self.label.append(self.label[g])
        self.rows.append(parts[1])
        self.rows[g] = parts[0]
        self.low.append(None)
        self.high.append(None)
        for at, part in zip((g, new), parts):
            self.low[at], self.high[at] = self.t.bins[part].min(0), self.t.bins[part].max(0)
        small = int(len(parts[1]) < len(parts[0]))
        own = self._added(1, [code[parts[small]] for _, _, code in self.t.packs], self.w[parts[small]])[0]
        self.sums[(g, new)[1 - small]] = self.sums[g] - own
        self.sums[(g, new)[small]] = own
        return new

    def tree(self, r: np.ndarray, h: np.ndarray, depth: int, least: int) -> tuple[Tree, list[tuple[int, list[int]]]]:
        """The regression tree on gradients by group, and its leaves with the groups in each."""
        nodes: dict[int, list[int]] = {0: list(range(len(self.parent)))}
        asked: list[int] = []

        def move(tree: Tree) -> None:
            for node in asked:
                f, cut, child = tree.feature[node], tree.cut[node], tree.child[node]
                if f >= 0:
                    left, right = [], []
                    for g in nodes.pop(node):
                        if self.low[g][f] > cut:
                            right.append(g)
                        else:
                            left.append(g)
                            if self.high[g][f] > cut:
                                right.append(self.split(g, f, cut))
                    nodes[child], nodes[child + 1] = left, right

        def sums(tree: Tree, level: list[int], last: bool) -> tuple[np.ndarray | None, np.ndarray]:
            nonlocal r, h
            if level[0] not in nodes:
                move(tree)
                asked.clear()
                r, h = self.stretched(r), self.stretched(h)
            asked.extend(level)
            value, total = [], []
            for node in level:
                own = nodes[node]
                weights = self.sums[own]
                w = weights[:, 0].sum(1)
                value.append((r[own] @ w, w.sum(), h[own] @ w))
                if not last:
                    total.append(np.stack((np.tensordot(r[own], weights, 1), weights.sum(0)), -1))
            return None if last else np.stack(total), np.array(value)

        tree = finish(grow(square_gain, weight_of, depth, least), sums)
        move(tree)
        return tree, list(nodes.items())


def boost_together(
    t: Table, classes: int, units: dict[int, dict], subsample: float, seed: int, held: int,
    each: Callable[[int, int, np.ndarray, Groups], None], most: int = GROUPS,
) -> None:
    """The fits of :func:`boost` for units that draw alike, round by round on shared :class:`Groups`.

    A unit is a dict with ``trees``, ``rate``, ``depth`` and ``least``; ``each(unit, rounds, margins by group,
    groups)`` follows every round; the groups are of the cells in another order.  Raises :class:`ManyGroups` if trees tell too many cells apart.
    """
    own = by_weight(t, held)
    at, first = np.concatenate((np.flatnonzero(t.fold == held), own)), len(t.w) - len(own)
    t = Table(t.bins[at], t.label[at], t.fold[at], t.w[at], t.key[at])
    groups, train = Groups(t, most), np.where(t.fold == held, 0.0, t.w)
    start = prior(np.bincount(t.label, train, classes))
    margins = {u: np.tile(start, (len(groups.parent), 1)) for u in units}
    for number in range(max(unit["trees"] for unit in units.values())):
        if subsample < 1:
            train[first:] = drawn(t.key[first:], t.w[first:], seed * 7919 + 2 * number, subsample)
        if subsample < 1 or not number:
            groups.weigh(train)
        for u, unit in units.items():
            if number >= unit["trees"]:
                continue
            margin = groups.stretched(margins[u])
            share, label, steps = softmax(margin), np.array(groups.label), []
            model = Boosted([], classes, start, unit["rate"])
            for k in range(classes if classes != 2 else 1):
                r, h = gradients(share[:, k], label == k)
                tree, leaves = groups.tree(groups.stretched(r), groups.stretched(h), unit["depth"], unit["least"])
                both = (tree, mirrored(tree)) if classes == 2 else (tree,)
                for side, one in enumerate(both):
                    value, step = model.values(one), np.zeros(len(groups.parent))
                    for node, members in leaves:
                        step[members] = value[node]
                    steps.append((k + side, step))
            margin = groups.stretched(margin)
            for k, step in steps:
                margin[:, k] += unit["rate"] * groups.stretched(step)
            margins[u] = margin
            each(u, number + 1, margin, groups)


# --- the same over partitions -----------------------------------------------------------


def level_sums(
    table: DataFrame, wanted: list[tuple[int, Tree, list[int], bool]], values_of: Callable, n_bins: int
) -> dict[int, np.ndarray]:
    """Sums for the newest levels of several trees: one aggregate over the table.

    ``values_of(t, batch, id)`` gives the columns to add up for a tree.  The result is bounded by
    nodes x features x bins, not by rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added: dict[int, np.ndarray] = {}
        for batch in batches:
            t = Table.of(batch)
            for number, tree, level, last in wanted if len(t.w) else ():
                node = Boosted.leaves(tree, t.bins)
                values = values_of(t, batch, number)
                own = sums_of(t.bins[:, :1] if last else t.bins, numbered(node, level), values, len(level), n_bins)
                added[number] = added[number] + own if number in added else own
        for number, own in added.items():
            at = np.flatnonzero(own.any(-1))
            rows = own.reshape(-1, own.shape[-1])[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(at), number)),
                    pa.array(at),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(at) + 1, dtype=np.int32) * own.shape[-1]), pa.array(rows.ravel())
                    ),
                ],
                names=["tree", "at", "sums"],
            )

    rows = table.mapInArrow(run, "tree long, at long, sums array<double>")
    one = rows.select("tree", "at", F.posexplode("sums").alias("j", "v")).groupBy("tree", "at", "j")
    found = one.agg(F.sum("v").alias("v")).toPandas()
    features = len(table.first()["bins"]) if wanted else 0
    width = 1 + int(found["j"].max()) if len(found) else 1
    across = {n: 1 if last else features for n, _, _, last in wanted}
    out = {n: np.zeros((len(level) * across[n] * n_bins, width)) for n, _, level, _ in wanted}
    for n, own in found.groupby("tree"):
        out[n][own["at"].to_numpy(), own["j"].to_numpy()] = own["v"].to_numpy()
    return {n: out[n].reshape(len(level), across[n], n_bins, width) for n, _, level, _ in wanted}


def grow_together(
    table: DataFrame, growing: dict[int, Generator], values_of: Callable, n_bins: int = MAX_BINS + 1
) -> dict[int, Tree]:
    """Several trees at once, a job a level."""
    asks, done = {n: next(g) for n, g in growing.items()}, {}
    while asks:
        answers = level_sums(table, [(n, *ask) for n, ask in asks.items()], values_of, n_bins)
        for n in list(asks):
            try:
                asks[n] = growing[n].send(answers[n])
            except StopIteration as end:
                done[n] = end.value
                del asks[n]
    return done


def boost_distributed(
    table: DataFrame, edges: list[list[float]], classes: int, trees: int, rate: float, depth: int, least: int,
    subsample: float, seed: int, held: int = -2, stride: int = STRIDE,
) -> Boosted:
    """The fit of :func:`boost` with every level's sums an aggregate over the table's partitions.

    All classes' trees of a round grow together.  Margins are written every ``stride`` rounds;
    between, tasks add those of the rounds since.
    """
    taught = table.filter(F.col("fold") != held)
    weights = {r["label"]: r["w"] for r in taught.groupBy("label").agg(F.sum("w").alias("w")).collect()}
    start = prior(np.array([float(weights.get(k, 0)) for k in range(classes)]))
    model = Boosted(edges, classes, start, rate)
    now = taught.withColumn("margin", F.array(*[F.lit(x) for x in model.start]))
    done = 0
    for number in range(trees):
        if number - done >= stride:
            now, done = materialise(_with_margins(now, model, done), "margins"), number

        def values_of(t: Table, batch: pa.RecordBatch, k: int, done=done, number=number) -> np.ndarray:
            margin = model.margins(t.bins, _matrix(batch.column("margin"), classes), done)
            w = t.w if subsample >= 1 else drawn(t.key, t.w, seed * 7919 + 2 * number, subsample)
            r, h = gradients(softmax(margin)[:, k], t.label == k)
            return np.stack((w * r, w, w * h), 1)

        growing = {k: grow(square_gain, weight_of, depth, least) for k in range(classes if classes != 2 else 1)}
        found = grow_together(now, growing, values_of)
        if classes == 2:
            found[1] = mirrored(found[0])
        model.rounds.append([found[k] for k in range(classes)])
    return model


def _with_margins(now: DataFrame, model: Boosted, done: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = Table.of(batch).bins
            if len(bins):
                margin = model.margins(bins, _matrix(batch.column("margin"), model.classes), done)
                kind = batch.schema.field("margin")
                at = batch.schema.get_field_index("margin")
                yield batch.set_column(at, kind, pa.array(margin.tolist(), kind.type))

    return now.mapInArrow(run, now.schema)


def forest_distributed(
    table: DataFrame, held: int, seed: int, trees: int, least: int, depth: int, classes: int, together: int = 16,
    min_gain: float = 0.0,
) -> list[Tree]:
    """The trees of :func:`forest_prefixes` over the table's partitions, some at a time."""
    taught = table.filter(F.col("fold") != held)

    def values_of(t: Table, batch: pa.RecordBatch, number: int) -> np.ndarray:
        w = drawn(t.key, t.w, seed * 7919 + 2 * number)
        values = np.zeros((len(w), classes))
        values[np.arange(len(w)), t.label] = w
        return values

    out: list[Tree] = []
    for first in range(0, trees, together):
        numbers = range(first, min(first + together, trees))
        growing = {n: forest_growth(n, seed, depth, least, min_gain) for n in numbers}
        found = grow_together(taught, growing, values_of)
        out += [found[n] for n in numbers]
    return out


# --- fits for callers ---------------------------------------------------------------------


def fit_boosted(
    train: DataFrame,
    classes: int,
    trees: int,
    rate: float,
    depth: int,
    min_instances: int = 1,
    subsample: float = 1.0,
    seed: int = 42,
    max_bytes: int = CELL_BYTES,
) -> Boosted:
    """A softmax ensemble on ``train`` (features, label 0..classes-1)."""
    edges = bin_edges(train)
    table = cells(train, edges)
    settings = (edges, classes, trees, rate, depth, min_instances, subsample, seed)
    if not fits_tasks(table, len(edges), max_bytes):
        return boost_distributed(table, *settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        t = Table.of(pa.Table.from_batches(list(batches)))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(boost(t, *settings))], pa.binary())], names=["model"])

    import pickle

    # a bounded table of cells, see fits_tasks
    return pickle.loads(table.coalesce(1).mapInArrow(run, "model binary").first()["model"])


def fit_forest(
    train: DataFrame, classes: int, trees: int, depth: int, min_instances: int = 1, min_gain: float = 0.0, seed: int = 42,
    max_bytes: int = CELL_BYTES, copies: str | None = None,
) -> tuple[list[list[float]], list[Tree]]:
    """Bin edges and trees of a random forest on ``train`` (features, label 0..classes-1).

    A tree reads a bootstrap of all rows, and each node the root of the number of features.  With ``copies``
    a row of ``train`` stands for so many.
    """
    spark = train.sparkSession
    edges = bin_edges(train, copies=copies)
    table = cells(train, edges, copies=copies)
    if not fits_tasks(table, len(edges), max_bytes):
        return edges, forest_distributed(table, -2, seed, trees, min_instances, depth, classes, min_gain=min_gain)
    held = spark.sparkContext.broadcast(table.toArrow().to_batches())  # a bounded table of cells

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Table.of(pa.Table.from_batches(held.value))
        for batch in batches:
            for number in batch.column("id").to_pylist():
                w = drawn(t.key, t.w, seed * 7919 + 2 * number)
                yield tree_rows([(number, forest_tree(t, w, number, seed, depth, min_instances, classes, min_gain)[0])])

    if not len(edges) or not table.count():
        return edges, []
    tasks = min(trees, 2 * spark.sparkContext.defaultParallelism)
    grown = materialise(spark.range(trees).repartition(tasks, "id").mapInArrow(run, TREE_ROWS), "trees")
    return edges, trees_of(grown)


TREE_ROWS = "number long, feature array<int>, cut array<int>, child array<int>, value array<array<double>>"


def tree_rows(numbered_trees: list[tuple[int, Tree]]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.list_(pa.float64()))]
    rows = [(n, t.feature, t.cut, t.child, [v.tolist() for v in t.value]) for n, t in numbered_trees]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["number", "feature", "cut", "child", "value"]
    )


def trees_of(rows: DataFrame) -> list[Tree]:
    """Trees by number from rows of :func:`tree_rows`."""
    own = sorted(rows.collect(), key=lambda r: r["number"])
    return [Tree(r["feature"], r["cut"], r["child"], [np.array(v) for v in r["value"]]) for r in own]


def search_counts(
    spark: SparkSession, table: DataFrame, units: list[dict], classes: int, folds: int, seed: int, features: int,
    edges: list[list[float]], max_bytes: int = CELL_BYTES, most_groups: int = GROUPS,
) -> DataFrame:
    """(unit, trees, depth, fold, label, prediction, n) of every unit of a search and every fold.

    A unit is a dict with ``kind`` ("forest" or "boosting"), ``wanted`` (pairs of trees and
    depth), ``least``, and for boosting ``rate`` and ``subsample``.  Boosting units that draw alike are
    fitted together on :class:`Groups`, and on cells where these are more than ``most_groups``.
    """
    names = ["unit", "trees", "depth", "fold", "label", "prediction", "n"]
    kinds = "unit int, trees int, depth int, fold int, label int, prediction int, n long"

    def pairs(label: np.ndarray, guess: np.ndarray, w: np.ndarray) -> list[tuple[int, int, int]]:
        n = np.bincount(label * classes + guess, w, classes * classes)
        return [(int(i) // classes, int(i) % classes, int(n[i])) for i in np.flatnonzero(n)]

    def counted(t: Table, fold: int, guess: np.ndarray) -> list[tuple[int, int, int]]:
        test = t.fold == fold
        return pairs(t.label[test], guess, t.w[test])

    def forests(t: Table, numbers: list[int], fold: int) -> list[tuple]:
        wanted, unit_of = {}, {units[u]["least"]: u for u in numbers}
        for u in numbers:
            wanted[units[u]["least"]] = set(map(tuple, units[u]["wanted"]))
        found = forest_prefixes(t, fold, seed, wanted, classes)
        return [(unit_of[x], n, d, fold, *row) for x, n, d, guess in found for row in counted(t, fold, guess)]

    def boosted(t: Table, numbers: list[int], fold: int) -> list[tuple]:
        out, asked, own = [], {u: {n for n, _ in units[u]["wanted"]} for u in numbers}, {}
        for u in numbers:
            ((_, depth),) = {(0, d) for _, d in units[u]["wanted"]}
            own[u] = {"trees": max(asked[u]), "rate": units[u]["rate"], "depth": depth, "least": units[u]["least"]}
        subsample, test = units[numbers[0]]["subsample"], t.fold == fold

        def by_group(u: int, rounds: int, margin: np.ndarray, groups: Groups) -> None:
            if rounds in asked[u]:
                n = np.bincount(groups.number, np.where(groups.t.fold == fold, groups.t.w, 0), len(groups.parent))
                rows = pairs(np.array(groups.label), margin.argmax(1), n)
                out.extend((u, rounds, own[u]["depth"], fold, *row) for row in rows)

        def by_cell(u: int) -> Callable[[int, np.ndarray, np.ndarray], None]:
            def each(rounds: int, margin: np.ndarray, at: np.ndarray) -> None:
                if rounds in asked[u]:
                    rows = counted(t, fold, margin.argmax(1)[at[test]])
                    out.extend((u, rounds, own[u]["depth"], fold, *row) for row in rows)

            return each

        if most_groups:
            try:
                boost_together(t, classes, own, subsample, seed, fold, by_group, most_groups)
            except ManyGroups:  # to be fitted on cells, each in a task of its own
                return [(u, 0, 0, fold, 0, 0, 0) for u in numbers]
            return out
        for u in numbers:
            settings = (own[u]["trees"], own[u]["rate"], own[u]["depth"], own[u]["least"], subsample, seed, fold)
            boost(t, edges, classes, *settings, by_cell(u))
        return out

    if fits_tasks(table, features, max_bytes):
        held = spark.sparkContext.broadcast([b for b in table.toArrow().to_batches()])

        def in_tasks(sets: list[tuple[list[int], int]], fit: Callable) -> DataFrame:
            """Counts of sets of units and a fold, each in a task of its own."""

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                t = None
                for batch in batches:
                    for i in batch.column("id").to_pylist():
                        t = t or Table.of(pa.Table.from_batches(held.value))
                        rows = fit(t, *sets[i])
                        if rows:
                            columns = zip(zip(*rows), [pa.int32()] * 6 + [pa.int64()])
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=names)

            return materialise(spark.range(0, len(sets), 1, len(sets)).mapInArrow(run, kinds), "search-counts")

        every = range(len(units))
        if units[0]["kind"] == "forest":
            # forests that share a task share draws and trees; as many tasks as there are cores, and more if their
            # votes would take too much room
            rows = (table.agg(F.countDistinct("bins", "label")).first()[0] or 1) * classes * 8
            deep = sum(len({d for _, d in unit["wanted"]}) for unit in units)
            cores = spark.sparkContext.defaultParallelism
            sets = min(len(units), max(1, cores // folds, -(-rows * deep // VOTE_BYTES)))
            return in_tasks([([u for u in every if u % sets == i], f) for i in range(sets) for f in range(folds)], forests)
        alike: dict[float, list[int]] = {}
        for u in every:
            alike.setdefault(units[u]["subsample"], []).append(u)
        found = in_tasks([(own, f) for _, own in sorted(alike.items()) for f in range(folds)], boosted)
        left = [([r["unit"]], r["fold"]) for r in found.filter("trees = 0").collect()]  # one a unit and fold at most
        if not left:
            return found
        most_groups = 0
        return found.filter("trees > 0").unionByName(in_tasks(left, boosted))

    todo = [(u, f) for u in range(len(units)) for f in range(folds)]
    parts: DataFrame | None = None
    for u, fold in todo:
        unit = units[u]
        wanted = sorted(map(tuple, unit["wanted"]))
        most, depth = max(n for n, _ in wanted), max(d for _, d in wanted)
        if unit["kind"] == "forest":
            trees = forest_distributed(table, fold, seed, most, unit["least"], depth, classes)
            model = None
        else:
            trees = None
            model = boost_distributed(
                table, edges, classes, most, unit["rate"], depth, unit["least"], unit["subsample"], seed, fold
            )

        def run(batches, u=u, fold=fold, wanted=wanted, trees=trees, model=model):
            for batch in batches:
                t = Table.of(batch)
                rows = []
                for n, d in wanted if len(t.w) else ():
                    if model is not None:
                        few = Boosted(model.edges, classes, model.start, model.rate, model.rounds[:n])
                        guess = few.margins(t.bins).argmax(1)
                    else:
                        votes = np.zeros((len(t.w), classes))
                        for tree in trees[:n]:
                            node = np.zeros(len(t.w), np.int64)
                            for _ in range(d):
                                node = tree.step(node, t.bins)
                            votes += shares(tree)[node]
                        guess = votes.argmax(1)
                    rows += [(u, n, d, fold, *row) for row in counted(t, fold, guess)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int32()] * 6 + [pa.int64()])], names=names
                    )

        one = materialise(table.filter(F.col("fold") == fold).mapInArrow(run, kinds), "search-counts")
        parts = one if parts is None else parts.unionByName(one)
    return parts
