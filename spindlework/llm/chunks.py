"""Substring dedup by content-defined chunking with a gear rolling hash.

A gear hash rolls over the last 16 bytes at every place.  A chunk ends where the hash is
smaller than at the ``REACH`` places on either side, so a cut depends only on the bytes
around it: after an insertion the cuts fall on the same content again, and a passage that
occurs twice has the same cuts inside from 40 bytes after its begin to 24 before its end.
Chunks are 25 bytes or longer, 49 on average; where ``MOST`` bytes have no cut, as in text that
repeats a short period, cuts follow at that distance from the last one.

The unit that is deduplicated is a chunk with the one that follows it (about 98 bytes), so
that a phrase that happens to fill one chunk is no duplicate.  Units meet by digest; all but
the first (smallest document, then place) lose their bytes.

Runs of such units end at cuts, up to some chunk inside the passage they come from.  So the
``AROUND`` bytes on either side of a run are compared with those beside its origin, and the run
grows by what is equal.  A removed byte has its equal at an earlier place, so all content stays
somewhere.

Digests are 96 bits.  They are counted before anything is joined, with the counts combined
map-side, so a passage that a third of the documents share is one row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import as_bytes, fresh, slices, store

ROLL = 16  # bytes the gear hash sees
REACH = 24  # a cut is the least hash of 24 places before and after
MOST = 512  # bytes of a chunk: text that repeats within 24 bytes has no least hash
LEAST = 50  # bytes of a unit
AROUND = 192  # bytes on either side of a run that are compared; 0.5 % of chunks end further off
STEP = 1 << 20  # bytes of a long text hashed at a time
HELD = 10_000  # spans a task has as Python values at a time, unless one text has more
GEAR = np.random.default_rng(11).integers(0, 1 << 63, 256, np.uint64)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 16 bytes up to each place: sum of GEAR[byte] shifted by its age."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):  # doubles the bytes a hash has seen
        h[step:] += h[:-step] << np.uint64(2 * step)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)


def window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` places from each one; beyond the end nothing counts."""
    out, done = h, 1
    while done < width:
        step = min(done, width - done)
        more = out.copy()
        np.minimum(out[:-step], out[step:], out=more[: len(out) - step])
        out, done = more, done + step
    return out


def cuts(text: bytes) -> list[int]:
    """Begins of the chunks and the end of the text."""
    n, found = len(text), [0]
    edge = ROLL - 1 + REACH  # bytes before a place that decide on it
    data = np.frombuffer(text, np.uint8)
    for at in range(edge, n - REACH, STEP):  # a long text goes in pieces that overlap
        h = gear_hashes(data[at - edge : min(at + STEP + REACH, n)])
        least = window_min(h, REACH)
        inner = np.arange(edge, len(h) - REACH)
        low = (h[inner] < least[inner - REACH]) & (h[inner] < least[inner + 1])
        found += (inner[low] + (at - edge) + 1).tolist()
    found.append(n)
    if max(map(int.__sub__, found[1:], found), default=0) <= MOST:
        return found
    return [x for a, b in zip(found, found[1:]) for x in range(a, b, MOST)] + [n]


def units(text: bytes) -> list[tuple[int, int]]:
    """(begin, end) of every two chunks in a row; a text of one chunk is one unit."""
    at = cuts(text)
    pairs = zip(at[:-2], at[2:]) if len(at) > 2 else [(0, len(text))]
    return [(a, b) for a, b in pairs if b - a >= LEAST]


def unit_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, t, h, c, start, size): every unit of every text; from (doc_id, t, text)."""

    def rows(own: list[tuple]) -> pa.RecordBatch:
        doc, t, h, c, start, size = zip(*own) if own else [()] * 6
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc, pa.int64()),
                pa.array(t, pa.int64()),
                pa.array(np.array(h, np.uint64).view(np.int64)),
                pa.array(np.array(c, np.uint32).view(np.int32)),
                pa.array(start, pa.int32()),
                pa.array(size, pa.int32()),
            ],
            names=["doc_id", "t", "h", "c", "start", "size"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = xxhash.xxh3_64_intdigest, xxhash.xxh32_intdigest
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids, keys = (part.column(c).to_pylist() for c in ("doc_id", "t"))
                own: list[tuple] = []
                for doc, t, text in zip(ids, keys, as_bytes(part, "text")):
                    for a, b in units(text):
                        piece = text[a:b]
                        own.append((doc, t, high(piece), low(piece), a, b - a))
                    if len(own) >= 50_000:
                        yield rows(own)
                        own = []
                yield rows(own)

    return docs.mapInArrow(scan, "doc_id long, t long, h long, c int, start int, size int")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, t, text): t tells texts of the same id apart."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text")
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, t, spans): for every document that holds units seen before, its runs of
    such bytes as (start, stop, first_doc_id, first_t, first_start), in order and without overlap.
    A run equals, byte for byte, what begins at its first_start in its first document, and goes
    on as far as both are equal, but for what another run holds.

    Rows that repeat both id and text count as one document.  Null ids come first in order.
    Null and empty texts and texts under LEAST bytes have no unit.
    """
    rows = store(unit_rows(keyed(docs)), "units")
    place = F.struct("doc_id", "t", "start")
    shared = (
        rows.groupBy("h", "c")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .filter("n > 1")
        .select("h", "c", "first")
    )
    again = (
        rows.join(store(shared, "shared-units"), ["h", "c"])  # a hot unit can be split
        .filter(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "t")
        .agg(
            F.collect_list(
                F.struct(
                    "start",
                    (F.col("start") + F.col("size")).alias("stop"),
                    F.col("first.doc_id").alias("first_doc_id"),
                    F.col("first.t").alias("first_t"),
                    F.col("first.start").alias("first_start"),
                )
            ).alias("spans")
        )
    )
    runs = again.mapInArrow(joined, f"doc_id long, t long, spans {SPANS}")
    runs = store(runs.select("doc_id", "t", F.explode("spans").alias("s")).select("doc_id", "t", "s.*"), "runs")
    sides = store(grown(docs, runs), "run-sides")
    ends = sides.groupBy("doc_id", "t").agg(F.collect_list(F.struct(*SPAN, "after", "more")).alias("spans"))
    return ends.mapInArrow(stretched, f"doc_id long, t long, spans {SPANS}")


SPAN = ("start", "stop", "first_doc_id", "first_t", "first_start")
SPANS = "array<struct<start: int, stop: int, first_doc_id: bigint, first_t: bigint, first_start: int>>"
SPAN_TYPE = pa.list_(pa.struct(list(zip(SPAN, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())))))


def with_spans(batch: pa.RecordBatch, spans: list[list[dict]]) -> pa.RecordBatch:
    own = [batch.column("doc_id"), batch.column("t"), pa.array(spans, SPAN_TYPE)]
    return pa.RecordBatch.from_arrays(own, names=["doc_id", "t", "spans"])


def few(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``HELD`` spans; a row of more comes alone."""
    ends = np.cumsum(pc.list_value_length(batch.column("spans")).to_numpy(zero_copy_only=False))
    start, done = 0, 0
    while start < batch.num_rows:
        stop = max(int(np.searchsorted(ends, done + HELD, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units that meet or overlap, of the same origin and shift, as one run."""

    def origin(x: dict) -> tuple:
        return x["first_doc_id"], x["first_t"], x["first_start"] - x["start"]

    for batch in (part for whole in batches for part in few(whole)):
        out = []
        for spans in batch.column("spans").to_pylist():
            own: list[dict] = []
            for x in sorted(spans, key=lambda s: (s["start"], s["stop"])):
                last = own[-1] if own else None
                if last is None or x["start"] > last["stop"]:
                    own.append(x)
                elif x["stop"] > last["stop"]:
                    if origin(x) == origin(last):
                        last["stop"] = x["stop"]
                    else:  # goes on, but comes from elsewhere
                        past = last["stop"] - x["start"]
                        own.append({**x, "start": last["stop"], "first_start": x["first_start"] + past})
            out.append(own)
        yield with_spans(batch, out)


def grown(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Two rows a run, for the bytes before it and after it: ``more`` of them, up to AROUND,
    are equal to those beside its origin."""
    size = F.col("stop") - F.col("start")
    sides = runs.withColumn("after", F.explode(F.array(F.lit(False), F.lit(True)))).select(
        "doc_id", "t", *SPAN, "after",
        F.when(F.col("after"), F.col("stop")).otherwise(F.col("start")).alias("at"),
        (F.col("first_start") + F.when(F.col("after"), size).otherwise(0)).alias("first_at"),
    )
    # places are distinct, so a passage that many share is asked for once; a text has no more
    # of them than bytes
    places = (
        sides.select("doc_id", "t", "after", "at")
        .union(sides.select("first_doc_id", "first_t", "after", "first_at"))
        .distinct()
        .groupBy(F.col("doc_id").alias("d"), F.col("t").alias("k"))
        .agg(F.collect_list(F.struct("after", "at")).alias("places"))
    )
    asked = keyed(docs).join(places, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("k")))

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                rows: list[tuple] = []
                ids, keys, wanted = (part.column(c).to_pylist() for c in ("d", "k", "places"))
                for doc, t, text, own in zip(ids, keys, as_bytes(part, "text"), wanted):
                    for p in own:
                        at = p["at"]
                        near = text[at : at + AROUND] if p["after"] else text[max(at - AROUND, 0) : at][::-1]
                        rows.append((doc, t, p["after"], at, near))
                kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary())
                columns = zip(*rows) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=["d", "k", "side", "place", "near"]
                )

    near = asked.select("d", "k", "text", "places").mapInArrow(
        beside, "d long, k long, side boolean, place int, near binary"
    )
    # rows that repeat id and text give the same bytes again
    near = store(near.dropDuplicates(["d", "k", "side", "place"]), "run-surroundings")

    def met(left: DataFrame, doc: str, t: str, at: str, name: str) -> DataFrame:
        same = F.col(doc).eqNullSafe(F.col("d")) & (F.col(t) == F.col("k"))
        same &= (F.col("after") == F.col("side")) & (F.col(at) == F.col("place"))
        return left.join(near, same).drop("d", "k", "side", "place").withColumnRenamed("near", name)

    both = met(met(sides, "doc_id", "t", "at", "own"), "first_doc_id", "first_t", "first_at", "origin")
    kept = ("doc_id", "t", *SPAN, "after")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("own").to_pylist(), batch.column("origin").to_pylist())
            more = pa.array([alike(a, b) for a, b in pairs], pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), more], names=[*kept, "more"])

    kinds = "doc_id long, t long, start int, stop int, first_doc_id long, first_t long, first_start int"
    return both.select(*kept, "own", "origin").mapInArrow(compare, f"{kinds}, after boolean, more int")


def alike(a: bytes, b: bytes) -> int:
    """Bytes that both begin with."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs grown on both sides, but not into each other or an origin in the same text."""
    for batch in (part for whole in batches for part in few(whole)):
        out = []
        ids, keys = (batch.column(c).to_pylist() for c in ("doc_id", "t"))
        for doc, t, sides in zip(ids, keys, batch.column("spans").to_pylist()):
            more = {(s["start"], s["after"]): s["more"] for s in sides}
            own = sorted(({c: s[c] for c in SPAN} for s in sides if s["after"]), key=lambda s: s["start"])
            limits = [s["start"] for s in own[1:]] + [1 << 31]
            past = 0
            for run, limit in zip(own, limits):
                start, stop = run["start"], run["stop"]
                before = min(more[start, False], start - past)
                after = min(more[start, True], limit - stop)
                if (run["first_doc_id"], run["first_t"]) == (doc, t):  # origin and run stay apart
                    room = max(start - run["first_start"] - (stop - start), 0)
                    before = min(before, room)
                    after = min(after, room - before)
                run["start"], run["first_start"] = start - before, run["first_start"] - before
                run["stop"] = past = stop + after
            out.append(own)
        yield with_spans(batch, out)


def repeats(docs: DataFrame) -> DataFrame:
    """A row for each run of bytes that occurred before: (doc_id, start, n_bytes,
    first_doc_id, first_start), places in UTF-8 bytes; the first occurrence has no row."""
    return repeated_spans(docs).select("doc_id", F.explode("spans").alias("s")).select(
        "doc_id", "s.start", (F.col("s.stop") - F.col("s.start")).alias("n_bytes"),
        "s.first_doc_id", "s.first_start",
    )


def without(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the spans, which are widened to whole characters."""
    kept, at = [], 0
    for start, stop in spans:
        while start > at and text[start] & 0xC0 == 0x80:
            start -= 1
        while stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop += 1
        kept.append(text[at:start])
        at = max(at, stop)
    kept.append(text[at:])
    return b"".join(kept).decode("utf-8")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated runs; other columns as they are, n_chars (if there)
    counted anew.  A document whose whole text came before stays with empty text; null
    texts stay null."""
    key, t, runs = fresh(docs, "id", "t", "spans")
    spans = repeated_spans(docs).select(
        F.col("doc_id").alias(key), F.col("t").alias(t), F.col("spans").alias(runs)
    )
    met = docs.join(
        spans,
        F.col("doc_id").cast("long").eqNullSafe(F.col(key))
        & (F.xxhash64(F.col("text").cast("string")) == F.col(t)),
        "left",
    ).select(*docs.columns, runs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index("text")
            for part in slices(batch, "text", 1 << 20):
                texts = part.column("text").to_pylist()
                for i, spans in enumerate(part.column(runs).to_pylist()):
                    if spans:
                        own = [(s["start"], s["stop"]) for s in spans]
                        texts[i] = without(texts[i].encode("utf-8"), own)
                columns = part.columns[:-1]
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])

    out = met.mapInArrow(cut, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(
            "n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(kind)
        )
    return out.select(docs.columns)
