"""Benchmark decontamination: one Aho-Corasick automaton over the test items.

Texts become lower-case words.  Ten words in a row always hold a whole block of five words
that begins at a multiple of five in its item, so the automaton holds these blocks
(and short items whole), about one state for each character of the benchmark, not ten.  A
text is scanned once; where a block occurs, the match is followed to both sides word by
word, and counts if it spans a window.  Word places map back to the original text.

The automaton is built from at most ``SHARD_BYTES`` of benchmark text, so what is
broadcast is bounded; a larger benchmark is cut into shards and each is scanned in a pass
of its own that adds its hits to those before, with the rows written in between.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import as_bytes, fresh, plain_words, slices, store

WINDOW = 10
SHARD_BYTES = 2 << 20  # an automaton of some 150 MB in a task

_automata: dict[int, tuple] = {}  # of this worker, by broadcast


def build(items: list[tuple[str, bytes]], window: int = WINDOW):
    """Automaton over the items' blocks; a block leads to (item number, place in it)."""
    import ahocorasick

    block = window // 2
    places: dict[str, list[tuple[int, int]]] = defaultdict(list)
    words = [[w.decode("utf-8", "surrogateescape") for w in plain_words(t)] for _, t in items]
    for i, own in enumerate(words):
        if 0 < len(own) < window:
            places[" ".join(own)].append((i, 0))
        else:
            for at in range(0, len(own) - block + 1, block):
                places[" ".join(own[at : at + block])].append((i, at))
    automaton = ahocorasick.Automaton()
    for text, where in places.items():
        automaton.add_word(f" {text} ", (text.count(" ") + 1, where))
    if places:
        automaton.make_automaton()
    return automaton if places else None, words


def find(text: bytes, automaton, items: list[list[str]], window: int = WINDOW):
    """Words of the text and its hits (first word, end word, item number)."""
    own = [w.decode("utf-8", "surrogateescape") for w in plain_words(text)]
    if automaton is None or not own:
        return len(own), []
    line = f" {' '.join(own)} "
    starts = None
    done: dict[tuple[int, int], int] = {}  # by item and shift: words up to here are known
    hits = []
    for end, (length, where) in automaton.iter(line):
        if starts is None:
            sizes = np.fromiter(map(len, own), np.int64, len(own)) + 1
            starts = np.concatenate(([0], np.cumsum(sizes)))  # place of the space before
        at = int(np.searchsorted(starts, end)) - length
        for item, place in where:
            if done.get((item, at - place), -1) > at:
                continue
            words, low, high = items[item], 0, length
            while at - low > 0 and place - low > 0 and words[place - low - 1] == own[at - low - 1]:
                low += 1
            while (
                at + high < len(own)
                and place + high < len(words)
                and words[place + high] == own[at + high]
            ):
                high += 1
            done[item, at - place] = at + high
            if low + high >= min(window, len(words)):
                hits.append((at - low, at + high, item))
    return len(own), hits


def shards(benchmark: DataFrame, limit: int = SHARD_BYTES) -> list[DataFrame]:
    """The benchmark in parts of about ``limit`` bytes, by a hash of the text."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // limit) or 1
    if n == 1:
        return [benchmark]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [benchmark.filter(part == k) for k in range(n)]


def word_spans(text: bytes) -> list[tuple[int, int]]:
    """Byte places of the words in the original text."""
    flags = np.frombuffer(text.translate(_IS_WORD), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags, [0])).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_IS_WORD = bytes(int(len(plain_words(bytes([c]))) > 0) for c in range(256))


def find_hits(
    docs: DataFrame, benchmark: DataFrame, n_words: str, found: str, window: int = WINDOW
) -> DataFrame:
    """``docs`` with the number of words and the hits, an array of (first, stop, item id as text).

    Items with null text or without words match nothing; a null item id shows as ''.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("string").alias("text"),
    ).filter("text IS NOT NULL")
    hit = pa.struct([("first", pa.int32()), ("stop", pa.int32()), ("item", pa.string())])
    empty = F.array().cast("array<struct<first: int, stop: int, item: string>>")
    out = docs.withColumn(n_words, F.lit(0).cast("long")).withColumn(found, empty)
    parts = shards(items)
    for k, shard in enumerate(parts):
        rows = [(r.item_id, r.text.encode("utf-8")) for r in shard.distinct().collect()]
        held = docs.sparkSession.sparkContext.broadcast(rows)  # SHARD_BYTES, or one item

        def scan(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            key = id(held.value)
            if key not in _automata:
                _automata.clear()
                _automata[key] = (held.value, *build(held.value, window))
            rows, automaton, items = _automata[key]
            for batch in batches:
                for part in slices(batch, "text", 1 << 20):
                    counts, hits = [], []
                    for text, before in zip(as_bytes(part, "text"), part.column(found).to_pylist()):
                        n, own = find(text, automaton, items, window)
                        counts.append(n)
                        hits.append(
                            before
                            + [{"first": a, "stop": b, "item": rows[i][0]} for a, b, i in own]
                        )
                    names = part.schema.names
                    columns = dict(zip(names, part.columns))
                    columns[n_words] = pa.array(counts, pa.int64())
                    columns[found] = pa.array(hits, pa.list_(hit))
                    yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

        out = out.mapInArrow(scan, out.schema)
        if k + 1 < len(parts):
            out = store(out, "scanned")
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits), a row for each row.

    ``hits`` has the byte places of each hit in the original text and the item.  Null and
    empty texts have no words; repeated rows give repeated rows; an empty benchmark leaves
    every document clean; an empty table gives an empty table.
    """
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("item_id", pa.string())])

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hits = as_bytes(batch, "text"), batch.column("_hits").to_pylist()
            rows = []
            for text, own in zip(texts, hits):
                items = sorted({h["item"] for h in own})
                hit, reached = 0, 0
                for a, b in sorted((h["first"], h["stop"]) for h in own):
                    hit += max(0, b - max(a, reached))
                    reached = max(reached, b)
                spans = word_spans(text) if own else []
                places = [
                    {"start": spans[h["first"]][0], "stop": spans[h["stop"] - 1][1], "item_id": h["item"]}
                    for h in own
                ]
                digest = hashlib.sha256(",".join(items).encode()).hexdigest()
                rows.append((hit, len(items), digest, hit > 0, places))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("_words"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.string()),
                    pa.array([r[3] for r in rows], pa.bool_()),
                    pa.array([r[4] for r in rows], pa.list_(span)),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hits"],
            )

    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return find_hits(own, benchmark, "_words", "_hits", window).mapInArrow(
        sum_up,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
        "contaminated boolean, hits array<struct<start: int, stop: int, item_id: string>>",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns as they are."""
    n_words, found = fresh(docs, "words", "hits")
    out = find_hits(docs, benchmark, n_words, found, window)
    return out.filter(F.size(found) == 0).select(docs.columns)


ORACLE = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, len(x) AS n, array_to_string(x, ' ') AS s FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS x
    FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
own AS (
  SELECT r, n, a, array_to_string(w[a:a + n - 1], ' ') AS s FROM (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM doc, sizes WHERE len(w) >= n)),
hit AS (SELECT r, own.n, a, item_id FROM own JOIN win USING (s)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (
    SELECT r, unnest(range(a, a + n)) AS p FROM (SELECT DISTINCT r, a, n FROM hit)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
