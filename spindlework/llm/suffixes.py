"""Exact removal of repeated byte strings by a sampled suffix array.

A byte goes if some string of ``LENGTH`` (200) bytes that covers it starts anywhere else
too.  All suffixes of all texts would be hundreds of bytes for each byte, so the array is
sampled by content: the 64 bytes from a place on are hashed, and the place with the least hash
in a window of 137 is an anchor.  Every string of 200 bytes holds such a window, so equal
strings have equal anchors at equal places, and it is enough to sort the suffixes at anchors.

1. Anchors whose 64 leading bytes occur once can be in no repeat and never travel: hashes
   are counted first.
2. The other anchors send their surroundings, 136 bytes before and 200 from the anchor on;
   equal surroundings are counted map-side and sent once.
3. Suffixes are range-partitioned by their 64 leading bytes at splitters Spark samples, so
   no match reaches over a bucket's boundary (bytes are compared up to the next change of
   the leading bytes).  A bucket is sorted by multikey quicksort, eight bytes at a time, only
   the rows still tied going on; the bytes before the anchor are sorted likewise from the
   anchor backward.
4. The string that begins j bytes before an anchor is j bytes backward and 200 - j forward, so
   it repeats where two rows share both classes: the run of common prefixes of 200 - j and
   the run of common backward prefixes of j.  The least and greatest such j give the bytes
   around the anchor that go.

Leading bytes shared by more than ``HOT`` different surroundings are not sorted in one task:
their strings are counted by digest over the cluster, which is exact as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import as_bytes, store

LENGTH = 200
LEAD = 64  # bytes that are hashed; a power of two
WINDOW = LENGTH - LEAD + 1
BEFORE = LENGTH - LEAD
STEP = 1 << 20  # bytes of a long text looked at in one piece
BUCKET = 20_000  # suffixes sorted together, or one group of equal leading bytes
HOT = 1 << 16

_rng = np.random.default_rng(23)
BYTES = _rng.integers(0, 1 << 63, 256, np.uint64)
BASE = int(_rng.integers(0, 1 << 62)) * 2 + 1


def lead_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the LEAD bytes from each place on, for all places that have as many."""
    h, power = BYTES[data], BASE
    step = 1
    while step < LEAD:
        h = h[:-step] * np.uint64(power) + h[step:]
        power = power * power % (1 << 64)
        step *= 2
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding(h: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) of ``width`` places from each one on."""
    done = 1
    while done < width:
        step = min(done, width - done)
        h = least(h[:-step], h[step:])
        done += step
    return h


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of a text, in order."""
    data = np.frombuffer(text, np.uint8)
    windows = len(data) - LENGTH + 1  # strings of LENGTH bytes
    places, hashes = [], []
    for at in range(0, windows, STEP):
        n = min(STEP, windows - at)
        h = lead_hashes(data[at : at + n + LENGTH - 1])
        low = sliding(h, WINDOW, np.minimum)
        rim = np.zeros(WINDOW - 1, np.uint64)
        chosen = np.flatnonzero(
            sliding(np.concatenate((rim, low, rim)), WINDOW, np.maximum) == h
        )
        places.append(chosen + at)
        hashes.append(h[chosen])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    found, first = np.unique(np.concatenate(places), return_index=True)
    return found, np.concatenate(hashes)[first]


def _heads(docs: DataFrame) -> DataFrame:
    """(doc_id, sha, n_bytes, h, p): anchors' hashes and places of every text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [anchors(t) for t in as_bytes(batch, "text")]
            sizes = np.cumsum([0] + [len(p) for p, _ in rows]).astype(np.int32)
            p = np.concatenate([p for p, _ in rows]).astype(np.int32)
            h = np.concatenate([h for _, h in rows]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "sha", "n_bytes")),
                    pa.ListArray.from_arrays(sizes, pa.array(h)),
                    pa.ListArray.from_arrays(sizes, pa.array(p)),
                ],
                names=["doc_id", "sha", "n_bytes", "h", "p"],
            )

    return docs.mapInArrow(
        scan, "doc_id long, sha binary, n_bytes long, h array<bigint>, p array<int>"
    )


def _surroundings(texts: DataFrame) -> DataFrame:
    """(rid, p, back, fwd) for each place in ``ps`` of (rid, text, ps); back runs backward."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, ps, back, fwd = [], [], [], []
            places = batch.column("ps").to_pylist()
            for r, text, own in zip(batch.column("rid").to_pylist(), as_bytes(batch, "text"), places):
                rid += [r] * len(own)
                ps += own
                back += [text[max(p - BEFORE, 0) : p][::-1] for p in own]
                fwd += [text[p : p + LENGTH] for p in own]
                if len(ps) > 20_000:
                    yield _batch(rid, ps, back, fwd)
                    rid, ps, back, fwd = [], [], [], []
            yield _batch(rid, ps, back, fwd)

    return texts.mapInArrow(scan, "rid long, p int, back binary, fwd binary")


def _batch(rid, ps, back, fwd) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rid, pa.int64()), pa.array(ps, pa.int32()),
            pa.array(back, pa.binary()), pa.array(fwd, pa.binary()),
        ],
        names=["rid", "p", "back", "fwd"],
    )


def matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings as rows of ``width`` bytes filled with zeros, and their lengths."""
    padded = b"".join([s.ljust(width, b"\0") for s in strings])
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    return np.frombuffer(padded, np.uint8).reshape(-1, width), lengths


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of byte rows by multikey quicksort, eight bytes a key: rows that a key leaves
    tied are sorted by the next one, the others are done."""
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0])
    tied = np.ones(len(rows), bool)
    group = np.zeros(len(rows), np.int64)
    for k in range(words.shape[1]):
        at = np.flatnonzero(tied)
        if not len(at):
            break
        own = order[at]
        own = own[np.lexsort((words[own, k], group[at]))]
        order[at] = own
        new = np.ones(len(at), bool)
        new[1:] = (words[own[1:], k] != words[own[:-1], k]) | (group[at[1:]] != group[at[:-1]])
        number = np.cumsum(new)
        group[at] = number
        sizes = np.bincount(number)
        tied[at] = sizes[number] > 1
    return order


def common(rows: np.ndarray) -> np.ndarray:
    """Common leading bytes of each row with the one before; -1 for the first."""
    differs = rows[1:] != rows[:-1]
    same = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
    return np.concatenate(([-1], same))


def repeated_reach(
    backs: list[bytes], fwds: list[bytes], counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest j for which the string from j bytes before the anchor repeats;
    -1 where none does.  Rows differ; ``counts`` is how often each occurs."""
    n = len(fwds)
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    if not n:
        return low, high
    fwd, fwd_len = matrix(fwds, LENGTH)
    back, back_len = matrix(backs, BEFORE)
    often = counts > 1
    first, last = np.maximum(LENGTH - fwd_len, 0), np.minimum(back_len, BEFORE)
    whole = often & (first <= last)
    low[whole], high[whole] = first[whole], last[whole]

    order = multikey_order(fwd)
    shared = common(fwd[order])
    group = np.cumsum(shared < LEAD)  # equal leading bytes; alone, a row has no partner
    alone = np.bincount(group)[group] == 1
    order, shared = order[~alone], np.where(np.diff(group[~alone], prepend=-1) != 0, -1, shared[~alone])
    if not len(order):
        return low, high
    back_order = multikey_order(back[order])
    back_shared = common(back[order][back_order])
    own_back, own_fwd = back_len[order], fwd_len[order]
    behind = np.empty(len(order), np.int64)
    for j in range(BEFORE + 1):
        behind[back_order] = np.cumsum(back_shared < j)
        ahead = np.cumsum(shared < LENGTH - j)
        valid = np.flatnonzero((own_back >= j) & (own_fwd >= LENGTH - j))
        key = ahead[valid] * (len(order) + 1) + behind[valid]
        by = np.argsort(key)
        same = np.diff(key[by]) == 0
        twice = np.zeros(len(valid), bool)
        twice[by[1:][same]] = twice[by[:-1][same]] = True
        rows = order[valid[twice]]
        low[rows] = np.where(low[rows] < 0, j, np.minimum(low[rows], j))
        high[rows] = np.maximum(high[rows], j)
    return low, high


def _sort_buckets(distinct: DataFrame) -> DataFrame:
    """(back, fwd, low, high) of rows (back, fwd, n) laid in order of their leading bytes."""

    def work(rows: list[tuple]) -> pa.RecordBatch:
        backs, fwds, counts = zip(*rows)
        low, high = repeated_reach(list(backs), list(fwds), np.array(counts))
        keep = np.flatnonzero(low >= 0)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([backs[i] for i in keep], pa.binary()),
                pa.array([fwds[i] for i in keep], pa.binary()),
                pa.array(low[keep], pa.int32()),
                pa.array(high[keep], pa.int32()),
            ],
            names=["back", "fwd", "low", "high"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("back", "fwd", "n"))):
                if len(held) >= BUCKET and row[1][:LEAD] != held[-1][1][:LEAD]:
                    yield work(held)
                    held = []
                held.append(row)
        if held:
            yield work(held)

    return distinct.mapInArrow(scan, "back binary, fwd binary, low int, high int")


def _count_strings(distinct: DataFrame) -> DataFrame:
    """The same for leading bytes with very many surroundings: each of the strings around
    an anchor is counted by digest, combined map-side."""
    j = F.explode(F.sequence(F.lit(0), F.lit(BEFORE))).alias("j")
    strings = distinct.select("back", "fwd", "n", j).filter(
        (F.length("back") >= F.col("j")) & (F.length("fwd") >= LENGTH - F.col("j"))
    )
    cut = F.concat(
        F.expr("substring(back, 1, j)"), F.lit(b"|"), F.expr(f"substring(fwd, 1, {LENGTH} - j)")
    )
    strings = strings.withColumn("s", F.sha2(cut, 256))
    often = strings.groupBy("j", "s").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    return (
        strings.join(often, ["j", "s"])
        .groupBy("back", "fwd")
        .agg(F.min("j").alias("low"), F.max("j").alias("high"))
    )


def reaches(distinct: DataFrame, hot: int = HOT, bucket: int = BUCKET) -> DataFrame:
    """(back, fwd, low, high) of different surroundings (back, fwd, n) that repeat."""
    rows = store(distinct, "surroundings")
    lead = F.substring("fwd", 1, LEAD)
    # leading bytes whose hashes collide are counted as one, and go one way together
    leads = rows.groupBy(F.xxhash64(lead).alias("_lead")).agg(F.count("*").alias("_n"))
    many = store(leads.filter(F.col("_n") > hot).select("_lead"), "hot-leads")
    parts = max(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // bucket)
    )
    is_hot = F.xxhash64(lead) == F.col("_lead")
    cold = rows.join(many, is_hot, "left_anti").select("back", "fwd", "n")
    found = _sort_buckets(cold.repartitionByRange(parts, lead).sortWithinPartitions(lead))
    if many.limit(1).count():
        found = found.unionByName(_count_strings(rows.join(many, is_hot, "left_semi")))
    return found


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch, as one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _cut(texts: DataFrame) -> DataFrame:
    """(rid, removed, spans, kept) of (rid, text, found: array of (start, stop))."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, runs, kept = [], [], []
            for text, found in zip(as_bytes(batch, "text"), batch.column("found").to_pylist()):
                spans = merge([(f["start"], f["stop"]) for f in found])
                rest, at = hashlib.sha256(), 0
                for start, stop in spans:
                    rest.update(text[at:start])
                    at = stop
                rest.update(text[at:])
                removed.append(sum(b - a for a, b in spans))
                runs.append([{"start": a, "stop": b} for a, b in spans])
                kept.append(rest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid"), pa.array(removed, pa.int64()),
                    pa.array(runs, batch.schema.field("found").type), pa.array(kept),
                ],
                names=["rid", "removed", "spans", "kept"],
            )

    return texts.mapInArrow(
        scan,
        "rid long, removed long, spans array<struct<start: int, stop: int>>, kept string",
    )


def repeated_bytes(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row of ``docs``.

    Null counts as empty.  Rows with equal text are occurrences of their own, whatever
    their ids (null, repeated), so each loses all it has from 200 bytes on.  Texts under 200
    bytes lose nothing; an empty table gives an empty table; other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("sha"), F.octet_length(text).cast("long").alias("n_bytes"),
    )
    heads = store(_heads(own).withColumn("rid", F.monotonically_increasing_id()), "anchors")
    # one row stands for all of equal text
    texts = store(
        heads.groupBy("sha").agg(F.count("*").alias("copies"), F.min("rid").alias("rid")), "texts"
    )
    single = heads.join(texts.select("rid"), "rid", "left_semi")
    each = single.select("rid", F.explode(F.arrays_zip("h", "p")).alias("a")).select(
        "rid", F.col("a.h").alias("h"), F.col("a.p").alias("p")
    )
    # written first, so that adaptive execution can split a hot hash in the join
    shared = store(
        each.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "shared-leads"
    )
    places = each.join(shared, "h").groupBy("rid").agg(F.collect_list("p").alias("ps"))
    wanted = places.join(heads.select("rid", "doc_id", "sha"), "rid").select(
        "rid", "ps", "sha", F.xxhash64("doc_id").alias("_id")
    )
    long = own.filter(F.col("n_bytes") >= LENGTH).select("sha", "text", F.xxhash64("doc_id").alias("_id"))
    # a sha has one rid here, and rows that meet by it have one text; the keys of the join are
    # those of the aggregate, so the texts are shuffled once
    touched = store(
        long.join(wanted, ["sha", "_id"]).dropDuplicates(["sha", "_id"]).select("rid", "text", "ps"),
        "touched",
    )
    around = store(_surroundings(touched), "around")
    distinct = around.groupBy("back", "fwd").agg(F.count("*").alias("n"))
    digest = [F.xxhash64("back", "fwd").alias("c1"), F.xxhash64("fwd", "back").alias("c2")]
    known = store(reaches(distinct, hot).select(*digest, "low", "high"), "reaches")
    found = (
        around.select("rid", "p", *digest)
        .join(known, ["c1", "c2"])
        .groupBy("rid")
        .agg(
            F.collect_list(
                F.struct(
                    (F.col("p") - F.col("high")).alias("start"),
                    (F.col("p") + LENGTH - F.col("low")).alias("stop"),
                )
            ).alias("found")
        )
    )
    cut = _cut(touched.select("rid", "text").join(found, "rid"))
    of_text = texts.join(cut, "rid", "left").drop("rid")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    none = F.array().cast("array<struct<start: int, stop: int>>")
    all_of_it = F.array(
        F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop"))
    )
    return heads.select("doc_id", "n_bytes", "sha").join(of_text, "sha").select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce(F.size("spans"), F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256))
        .otherwise(F.coalesce("kept", F.lower(F.hex("sha"))))
        .alias("kept_sha256"),
        F.when(whole, all_of_it).otherwise(F.coalesce("spans", none)).alias("spans"),
    )
