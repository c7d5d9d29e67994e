"""Ranked lexical search, term at a time with limited accumulators.

Index.  Every text is scanned once into a compact forward index: its length in terms, and the
digests and counts of its distinct terms.  The index serves any number of items, so the texts
are not read again.

Search.  A task holds a block of documents and works an item's terms off from the rarest to the
most frequent.  A term adds its scores to accumulators, one a document.  The most that the
remaining terms can still add is known from each term's weight and its largest factor in the
block.  Once that is below the k-th best score so far (partial scores of this block, whole
scores of the task's earlier blocks), no document without an accumulator can be among the k
best: no more are created, and from then on only those that can still reach the k-th score are
kept and updated, so what comes out is exact.  A task's k best of each item are merged over
tasks by rank, in two steps, so no item's rows of all tasks meet at once.

Items are taken from the driver in chunks of at most ``CHUNK`` terms; each chunk reads the
compact index, never the texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spindlework.llm.common import as_bytes, plain_words, slices, store

CHUNK = 500_000  # terms of the items one pass over the index serves
BLOCK = 8192  # documents that share a task's accumulators
SALTS = 32
NO_ID = np.iinfo(np.int64).max

_digests: dict[bytes, int] = {}  # of this worker, for frequent terms
_HELD = 100_000


def digests(words: list[bytes]) -> np.ndarray:
    """64-bit digests of terms."""
    if len(_digests) > _HELD:
        _digests.clear()
    known, digest = _digests, xxhash.xxh3_64_intdigest
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = digest(w)
        out.append(h)
    return np.array(out, np.uint64).view(np.int64)


def forward_index(docs: DataFrame) -> DataFrame:
    """(doc_id, n, terms, tf) of every row with at least one term, from (doc_id, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 21):
                ids, counts, ends, keys, tf = [], [], [0], [], []
                for doc, text in zip(part.column("doc_id").to_pylist(), as_bytes(part, "text")):
                    words = plain_words(text)
                    if words:
                        own = Counter(words)
                        ids.append(doc)
                        counts.append(len(words))
                        keys.append(digests(list(own)))
                        tf.append(np.fromiter(own.values(), np.int32, len(own)))
                        ends.append(ends[-1] + len(own))
                if ids:
                    at = pa.array(ends, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids, pa.int64()),
                            pa.array(counts, pa.int64()),
                            pa.ListArray.from_arrays(at, pa.array(np.concatenate(keys))),
                            pa.ListArray.from_arrays(at, pa.array(np.concatenate(tf))),
                        ],
                        names=["doc_id", "n", "terms", "tf"],
                    )

    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return own.mapInArrow(scan, "doc_id long, n long, terms array<long>, tf array<int>")


def item_chunks(items: DataFrame, chunk: int) -> Iterator[list[tuple]]:
    """Items as (item_id, sorted term digests, how often each), a chunk at a time."""
    held, size = [], 0
    for row in items.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        words = Counter(plain_words((row.text or "").encode("utf-8")))
        if not words:
            continue
        keys = digests(list(words))
        often = np.fromiter(words.values(), np.int64, len(words))
        order = np.argsort(keys)
        if held and size + len(keys) > chunk:
            yield held
            held, size = [], 0
        held.append((row.item_id, keys[order], often[order]))
        size += len(keys)
    if held:
        yield held


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A list column as (row of each value, value)."""
    ends = column.offsets.to_numpy()
    rows = np.repeat(np.arange(len(column)), np.diff(ends))
    return rows, column.values.to_numpy()[ends[0] : ends[-1]]


def found(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``terms`` are among the sorted ``wanted``, and where there."""
    at = np.searchsorted(wanted, terms)
    at[at == len(wanted)] = 0
    hit = np.flatnonzero(wanted[at] == terms)
    return hit, at[hit]


def document_counts(index: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """How many documents hold each of the ``wanted`` terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            hit, at = found(batch.column("terms").flatten().to_numpy(), wanted)
            total += np.bincount(at, minlength=len(wanted))
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.astype(np.int32)), pa.array(total[own])], names=["at", "n"]
        )

    rows = index.select("terms").mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(len(wanted), np.int64)
    for row in rows.collect():  # one row for each term of a chunk
        out[row["at"]] = row["n"]
    return out


def length_factor(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """m of each document: 75 + (25 n N) div L, in whole numbers."""
    if len(n) and 25 * int(n.max()) * documents >= 1 << 63:
        return np.array([75 + 25 * int(x) * documents // length for x in n], np.int64)
    return 75 + 25 * n * documents // length


class Best:
    """The k best (score, document) of an item so far; equal scores by document."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)

    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate((self.score, score)), np.concatenate((self.doc, doc))
        if len(score) > 4 * self.k:  # what is below the k-th score need not be sorted
            least = np.partition(score, -self.k)[-self.k]
            score, doc = score[score >= least], doc[score >= least]
        order = np.lexsort((doc, -score))[: self.k]
        self.score, self.doc = score[order], doc[order]


def search_block(items: list[tuple], best: list[Best], docs: np.ndarray, postings, weight: np.ndarray) -> int:
    """Add a block's documents to ``best``; ``postings(t)`` gives (rows, factors) of a term.

    Returns how many accumulators were created.
    """
    sums = np.zeros(len(docs), np.int64)
    created = 0
    for (_, terms, often), kept in zip(items, best):
        lists = []
        for t, q in zip(terms.tolist(), often.tolist()):
            rows, factor, most = postings(t)
            if len(rows) and weight[t]:
                lists.append((int(weight[t]) * q, rows, factor, int(weight[t]) * q * most))
        if not lists:
            continue
        lists.sort(key=lambda x: (-x[0], len(x[1])))  # rarest first
        left = sum(x[3] for x in lists)
        least = kept.floor()
        sums[:] = 0
        alive = None  # survivors, once no more are created
        for w, rows, factor, most in lists:
            if alive is None and left < max(least, 1):
                alive = sums > 0
                alive &= sums + left >= least
            if alive is not None:
                own = alive[rows]
                rows, factor = rows[own], factor[own]
            sums[rows] += w * factor
            left -= most
            if alive is None:
                got = sums[sums > 0] if left < max(least, int(sums.max())) else ()
                if len(got) >= kept.k:  # the k-th partial score
                    least = max(least, int(np.partition(got, -kept.k)[-kept.k]))
        own = np.flatnonzero(sums > 0)
        created += len(own)
        own = own[sums[own] >= least]
        kept.add(sums[own], docs[own])
    return created


def search(index: DataFrame, items: list[tuple], stats: tuple[int, int], k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best documents of each item, by its number."""
    documents, length = stats
    wanted = np.unique(np.concatenate([terms for _, terms, _ in items]))
    df = document_counts(index, wanted)
    weight = np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64
    )
    numbered = [(0, np.searchsorted(wanted, terms), often) for _, terms, often in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in numbered]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                rows, terms = flat(block.column("terms"))
                hit, term = found(terms, wanted)
                order = np.argsort(term, kind="stable")
                rows, term = rows[hit][order], term[order]
                tf = flat(block.column("tf"))[1][hit][order].astype(np.int64)
                m = length_factor(block.column("n").to_numpy(), documents, length)
                factor = 1_000_000_000 * tf // (1000 * tf + 12 * m[rows])
                lo = np.searchsorted(term, np.arange(len(wanted) + 1))
                most = np.zeros(len(wanted), np.int64)
                np.maximum.at(most, term, factor)

                def postings(t: int):
                    a, b = lo[t], lo[t + 1]
                    return rows[a:b], factor[a:b], int(most[t])

                ids = block.column("doc_id").to_numpy()
                search_block(numbered, best, ids, postings, weight)
        sizes = [len(b.doc) for b in best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(best), dtype=np.int32), sizes)),
                pa.array(np.concatenate([b.doc for b in best])),
                pa.array(np.concatenate([b.score for b in best])),
            ],
            names=["item", "doc_id", "score"],
        )

    return index.filter("doc_id IS NOT NULL").mapInArrow(run, "item int, doc_id long, score long")


def ranked(rows: DataFrame, groups: list[str], k: int) -> DataFrame:
    """The k best rows of each group, with their rank."""
    order = W.partitionBy(*groups).orderBy(F.desc("score"), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 20, chunk: int = CHUNK) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0.

    Null and empty texts have no term: such documents count nowhere, such items have no row.
    Rows without an id count in all statistics and are never returned, since ties go by id.
    Repeated document rows are ranked one by one; each row of ``items`` is an item, and those
    that agree in id and text count once.  Empty tables give an empty table; other columns are
    not read.
    """
    spark: SparkSession = docs.sparkSession
    index = store(forward_index(docs), "forward-index")
    total = index.agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
    kind = items.schema["item_id"].dataType
    result = f"item_id {kind.simpleString()}, rank int, doc_id long, score long"
    parts = []
    own = items.select("item_id", "text").distinct()
    for held in item_chunks(own, chunk) if total["n"] else ():
        rows = search(index, held, (total["n"], total["length"]), k)
        salted = rows.withColumn("salt", F.spark_partition_id() % SALTS)
        best = ranked(ranked(salted, ["item", "salt"], k).drop("rank", "salt"), ["item"], k)
        names = spark.createDataFrame(
            [(i, item) for i, (item, _, _) in enumerate(held)], f"item int, item_id {kind.simpleString()}"
        )
        named = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        parts.append(named)
    if not parts:
        return spark.createDataFrame([], result)
    return reduce(DataFrame.unionByName, [store(p, "ranked") for p in parts]) if len(parts) > 1 else parts[0]


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
doc AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
tot AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM doc),
post AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM doc) GROUP BY r, t),
term AS (SELECT item_id, t, CAST(count(*) AS BIGINT) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM benchmark WHERE text IS NOT NULL) GROUP BY item_id, t),
wt AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM post, tot WHERE t IN (SELECT t FROM term) GROUP BY t, nn),
s AS (
  SELECT item_id, doc_id, r, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
  FROM term JOIN wt USING (t) JOIN post USING (t) JOIN (SELECT r, doc_id, n FROM doc) USING (r), tot GROUP BY item_id, doc_id, r),
k AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM s WHERE score > 0 AND doc_id IS NOT NULL)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""
