"""Exact top-k inner products over a bit-sliced index.

Index.  Components become integers floor(scale x).  A block of rows keeps, for every
attribute and bit, one bitmap over its rows (a slice); attributes are shifted by the
block's minimum, so slices are unsigned.  Slices are what is stored and shuffled: some ten bits
a component, and whole numbers of any size without loss.

Scores.  A query adds the slices of attribute d, weighted by the set bits of its own
component (complemented for a negative one), all at once for all rows of a block: slices
of equal weight are reduced by carry-save adders, three bitmaps to a sum and a carry of the
next weight, until one bitmap for each bit of the score is left.

Selection goes from the most significant score slice downward, keeping the rows certainly
among the best k and those tied so far.  Rows still tied at the last slice are the
boundary: their scores are equal, and the smaller id wins.  Selected rows are scored
exactly.

Blocks of rows and chunks of queries meet by an equi-join on a block and a set of up to
``SET_CHUNKS`` chunks: a stated query set against all rows, in blocks.  A block is shuffled
once for each set, a chunk once for each block.  At most k rows leave a block for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spindlework.llm.common import store

BLOCK_ROWS = 1 << 15
CHUNK_QUERIES = 256
SET_CHUNKS = 64  # chunks that meet a block in one task, at most
TASKS = 64  # fewer chunks a set where blocks are too few for so many tasks
NARROW = 2.0**62  # whole numbers below fit a long with their differences


def quantise(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale x) as whole doubles; what exceeds a double becomes the largest one."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(values * scale))


def whole(values: np.ndarray) -> np.ndarray:
    """Whole doubles as int64, or as Python's whole numbers if any is too large."""
    if (np.abs(values) < NARROW).all():
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def pack(bits: np.ndarray) -> np.ndarray:
    """Boolean rows as one bitmap of 64-bit words, bit i of word j for row 64 j + i."""
    padded = np.zeros(-(-len(bits) // 64) * 64, bool)
    padded[: len(bits)] = bits
    return np.packbits(padded, bitorder="little").view(np.uint64)


def unpack(bitmap: np.ndarray, rows: int) -> np.ndarray:
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:rows].astype(bool)


class Block:
    """Bit slices of some rows, in the order of their ids."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, bits: np.ndarray, slices: np.ndarray):
        self.ids, self.low, self.bits = ids, whole(low), bits.tolist()
        self.at = (np.cumsum(bits) - bits).tolist()
        self.slices = slices.reshape(-1, -(-len(ids) // 64))
        self.every = pack(np.ones(len(ids), bool))
        self.wide = self.low.dtype == object or max(self.bits, default=0) > 62
        self._values: np.ndarray | None = None

    @staticmethod
    def parts(ids: np.ndarray, scaled: np.ndarray) -> list[bytes]:
        """What is stored: ids, minima, bits of each attribute, slices."""
        order = np.argsort(ids, kind="stable")
        ids, scaled = ids[order], scaled[order]
        low = scaled.min(0)
        over = whole(scaled) - whole(low)
        bits = np.array([int(x).bit_length() for x in over.max(0)], np.int32)
        bitmaps = [pack((over[:, d] >> b) & 1 > 0) for d, n in enumerate(bits) for b in range(n)]
        return [ids.tobytes(), low.tobytes(), bits.tobytes(), b"".join(x.tobytes() for x in bitmaps)]

    @classmethod
    def read(cls, ids: bytes, low: bytes, bits: bytes, slices: bytes) -> Block:
        kinds = (np.int64, np.float64, np.int32, np.uint64)
        return cls(*(np.frombuffer(x, kind) for x, kind in zip((ids, low, bits, slices), kinds)))

    def values(self) -> np.ndarray:
        """The components again, rows x attributes."""
        if self._values is None:
            kind = object if self.wide else np.int64
            out = np.empty((len(self.ids), len(self.bits)), kind)
            for d, (bits, at) in enumerate(zip(self.bits, self.at)):
                column = np.full(len(self.ids), self.low[d], kind)
                for b in range(bits):
                    column += unpack(self.slices[at + b], len(self.ids)).astype(kind) * (1 << b)
                out[:, d] = column
            self._values = out
        return self._values

    def score_slices(self, query: list[int]) -> list[np.ndarray]:
        """Bitmaps of the score's bits, lowest first; scores carry a common offset."""
        waiting: dict[int, list] = {}
        plain: dict[int, list[int]] = {}
        turned: dict[int, list[int]] = {}
        for d, (q, bits, at) in enumerate(zip(query, self.bits, self.at)):
            held = turned if q < 0 else plain
            size, place = abs(q), 0
            while size:
                if size & 1:
                    for b in range(bits):
                        held.setdefault(place + b, []).append(at + b)
                size, place = size >> 1, place + 1
        for weight, rows in plain.items():
            waiting.setdefault(weight, []).append(self.slices[rows])
        for weight, rows in turned.items():
            waiting.setdefault(weight, []).append(~self.slices[rows] & self.every)
        out: list[np.ndarray] = []
        weight = 0
        none = np.zeros_like(self.every)
        while waiting:
            stack = waiting.pop(weight, [])
            x = np.concatenate(stack) if stack else np.zeros((0, len(self.every)), np.uint64)
            carries = []
            while len(x) > 2:
                n = len(x) // 3
                a, b, c = x[:n], x[n : 2 * n], x[2 * n : 3 * n]
                half = a ^ b
                carries.append((a & b) | (half & c))
                x = np.concatenate((half ^ c, x[3 * n :]))
            if len(x) == 2:
                carries.append((x[0] & x[1])[None])
                x = (x[0] ^ x[1])[None]
            out.append(x[0] if len(x) else none)
            if carries:
                waiting.setdefault(weight + 1, []).append(np.concatenate(carries))
            weight += 1
        return out

    def top(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, list[int]]:
        """Rows of the k best scores (ties to the smaller id) without the id ``own``."""
        rest = self.every.copy()
        if own is not None:
            a, b = np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right")
            if a < b:
                self_rows = np.zeros(len(self.ids), bool)
                self_rows[a:b] = True
                rest &= ~pack(self_rows)
        sure = np.zeros_like(rest)
        for bitmap in reversed(self.score_slices(query.tolist())):
            high = rest & bitmap
            n = int(np.bitwise_count(sure | high).sum())
            if n > k:
                rest = high
            else:
                sure |= high
                rest = rest & ~bitmap
            if n == k:
                rest = np.zeros_like(rest)
                break
        rows = np.flatnonzero(unpack(sure, len(self.ids)))
        tied = np.flatnonzero(unpack(rest, len(self.ids)))[: max(k - len(rows), 0)]
        rows = np.concatenate((rows, tied))
        scores = self.scores(rows, query)
        order = sorted(range(len(rows)), key=lambda i: (-scores[i], self.ids[rows[i]]))
        return self.ids[rows[order]], [scores[i] for i in order]

    def scores(self, rows: np.ndarray, query: np.ndarray) -> list[int]:
        own = self.values()[rows]
        size = sum(abs(q) * ((1 << bits) + abs(m)) for q, bits, m in zip(query.tolist(), self.bits, self.low.tolist()))
        if size >= NARROW:
            own, query = own.astype(object), query.astype(object)
        return [int(x) for x in (own * query).sum(1)]


LONG = (-(2**63), 2**63 - 1)


BLOCK = ("ids", "low", "bits", "slices")


def blocks_of(rows: DataFrame, size: int, scale: float, name: str) -> DataFrame:
    """Quantised vectors in sliced blocks (dims, no, ids, low, bits, slices), numbered within dims.

    Rows are dealt by a hash of the id into parts of about ``size`` rows; parts of a task
    are cut again so that none holds more than twice ``size`` rows.
    """
    counts = {r.dims: r.n for r in rows.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    parts = F.create_map(*[F.lit(x) for d, n in counts.items() for x in (d, -(-n // size))])
    parts = parts if counts else F.lit(None).cast("map<int, bigint>")
    hashed = rows.withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.coalesce(parts[F.col("dims")], F.lit(1)))
    )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[int, list[float]]]] = {}
        counter = 0  # a part lies in one task, so (part, counter) names a block

        def emit(key):
            nonlocal counter
            counter += 1
            own = held.pop(key)
            ids = np.array([v for v, _ in own], np.int64)
            scaled = quantise(np.array([x for _, x in own], np.float64), scale)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]], pa.int32()),
                    pa.array([key[1]], pa.int64()),
                    pa.array([counter], pa.int64()),
                    *(pa.array([x], pa.binary()) for x in Block.parts(ids, scaled)),
                ],
                names=["dims", "part", "block", *BLOCK],
            )

        last = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("dims", "part", "vec_id", "embedding")]
            for dims, part, vec, values in zip(*columns):
                key = (dims, part)
                if last is not None and key != last and last in held:
                    yield emit(last)
                last = key
                held.setdefault(key, []).append((vec, values))
                if len(held[key]) >= 2 * size:
                    yield emit(key)
        for key in list(held):
            yield emit(key)

    shuffled = hashed.repartition("dims", "part").sortWithinPartitions("dims", "part")
    made = shuffled.select("dims", "part", "vec_id", "embedding").mapInArrow(
        gather, "dims int, part long, block long" + "".join(f", {c} binary" for c in BLOCK)
    )
    made = store(made, name)
    # a few thousand rows at 100 million vectors: one row for each block
    numbered = made.select("dims", "part", "block").withColumn(
        "no", F.row_number().over(W.partitionBy("dims").orderBy("part", "block"))
    )
    return made.join(numbered, ["dims", "part", "block"]).select("dims", "no", *BLOCK)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    block_rows: int = BLOCK_ROWS,
    chunk: int = CHUNK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row where ``is_query``.

    Vectors that are null or hold a null or non-finite component, and rows with a null
    vec_id, take no part.  A query meets vectors of its own length only (empty vectors: all
    scores 0) and never a row of its own vec_id; a vec_id that occurs several times as a
    query is answered once for each row.  Ties go to the smaller vec_id.  Scores are exact whole
    numbers; one beyond a long becomes the end of a long.
    """
    usable = F.col("vec_id").isNotNull() & F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        is_query.alias("_q"),
    ).filter(usable)
    rows = store(rows.withColumn("dims", F.size("embedding")), "vectors")
    index = blocks_of(rows, block_rows, scale, "slices")
    queries = blocks_of(rows.filter("_q"), chunk, scale, "queries")
    n = {r.dims: (r.b, r.q) for r in _sizes(index, queries)}
    if not n:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score long"
        )
    sets = {d: min(q, max(-(-q // SET_CHUNKS), -(-TASKS // b))) for d, (b, q) in n.items()}
    maps = [
        F.create_map(*[F.lit(x) for d in n for x in (d, of(d))])[F.col("dims")]
        for of in (lambda d: n[d][0], lambda d: sets[d])
    ]
    # each block goes to every set of chunks and each chunk to every block
    tasks = min(sum(b * sets[d] for d, (b, _) in n.items()), 20_000)
    left = index.withColumn("q", F.explode(F.sequence(F.lit(1), maps[1])))
    right = queries.select(
        "dims",
        F.col("no").alias("chunk"),
        (F.pmod(F.col("no"), maps[1]) + 1).alias("q"),
        *(F.col(c).alias(f"q_{c}") for c in BLOCK),
    ).withColumn("no", F.explode(F.sequence(F.lit(1), maps[0])))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                block = Block.read(*(row[c] for c in BLOCK))
                asked = Block.read(*(row[f"q_{c}"] for c in BLOCK))
                found = []
                for j, (own, query) in enumerate(zip(asked.ids.tolist(), asked.values())):
                    best, scores = block.top(query, k, own)
                    ends = (min(max(s, LONG[0]), LONG[1]) for s in scores)
                    found += [(j, own, v, s) for v, s in zip(best.tolist(), ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["dims"]] * len(found), pa.int32()),
                        pa.array([row["chunk"]] * len(found), pa.int32()),
                        *(pa.array([f[c] for f in found], t) for c, t in enumerate([pa.int32()] + [pa.int64()] * 3)),
                    ],
                    names=["dims", "chunk", "place", "query_id", "vec_id", "score"],
                )

    meet = ["dims", "q", "no"]
    met = left.repartition(tasks, *meet).join(right.repartition(tasks, *meet).hint("shuffle_merge"), meet)
    best = met.mapInArrow(
        search, "dims int, chunk int, place int, query_id long, vec_id long, score long"
    )
    order = W.partitionBy("dims", "chunk", "place").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _sizes(index: DataFrame, queries: DataFrame):
    """Blocks and chunks for each vector length that has both."""
    b = index.groupBy("dims").agg(F.max("no").alias("b"))
    q = queries.groupBy("dims").agg(F.max("no").alias("q"))
    return b.join(q, "dims").collect()


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
