"""SimHash near-duplicates by pigeonring filtering.

Fingerprints are 64 majority bits of shingle hashes.  Two of them link at ``limit`` (4) or
fewer differing bits.  Cut into five segments in a ring, a linked pair has a start from
which every chain of l segments differs in at most l * 4 / 5 bits: the first segment in none,
the first two in at most one, three in two, four in three.  The first two conditions make
the keys: segment i equal, and one half of segment i + 1 equal, so a fingerprint has ten keys of
about 19.5 bits.  Rows of a key are compared chain by chain, and only what passes every
budget gets the full Hamming check.

Copies are collapsed first (one row for each fingerprint).  Inside a key a search from row
to row removes what it has reached, so a group of n linked rows yields n - 1 links, not all
pairs; links of all keys together connect what all pairs would.  A key with more than
``SPLIT`` rows is dealt into blocks, and each pair of blocks is a group of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import as_bytes, fresh, slices, store
from spindlework.llm.components import components

SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit, bits
SPLIT = 4096


def fingerprint(text: bytes, size: int = 4) -> int:
    """Majority bits of the XXH64 of word shingles; words as ASCII white space cuts them."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(len(words) - size + 1, 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(starts)
    for at in range(0, total, 1 << 16):
        pairs = zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])
        own = np.array([digest(line[a:b], 42) for a, b in pairs], np.uint64)
        bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    set_bits = np.packbits(counts * 2 > total, bitorder="little")
    return int(set_bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """``docs`` (any columns and text) with fp (the bits as a signed long) in place of text."""
    kept = [f for f in docs.schema.fields if f.name != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 22):
                own = np.array([fingerprint(t, size) for t in as_bytes(part, "text")], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in kept), pa.array(own.view(np.int64))],
                    names=[*(f.name for f in kept), "fp"],
                )

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return docs.mapInArrow(scan, f"{fields}fp long")


def keys(fps: DataFrame) -> DataFrame:
    """(start, key, fp): the ten keys of each fingerprint."""
    made = []
    for i in range(5):
        at, bits = SEGMENTS[i]
        whole = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << bits) - 1))
        at, bits = SEGMENTS[(i + 1) % 5]
        for first, n in ((at, bits // 2), (at + bits // 2, bits - bits // 2)):
            half = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << n) - 1))
            number = len(made)
            made.append(whole * (1 << 12) + half * 16 + number)
    return fps.select("fp", F.posexplode(F.array(*made)).alias("start", "key")).withColumn(
        "start", F.floor(F.col("start") / 2).cast("int")
    )


def _chain_masks() -> list[list[np.uint64]]:
    """For each start: masks of the chains of 2, 3 and 4 segments."""
    out = []
    for i in range(5):
        mask, own = 0, []
        for step in range(4):
            at, bits = SEGMENTS[(i + step) % 5]
            mask |= ((1 << bits) - 1) << at
            if step:
                own.append(np.uint64(mask))
        out.append(own)
    return out


MASKS = _chain_masks()


def passes(x: np.ndarray, start: int, limit: int) -> np.ndarray:
    """Places of the XORs that keep every chain's budget and the whole limit."""
    at = np.arange(len(x))
    for length, mask in zip((2, 3, 4), MASKS[start]):
        keep = np.bitwise_count(x[at] & mask) <= length * limit // 5
        at = at[keep]
        if not len(at):
            return at
    return at[np.bitwise_count(x[at]) <= limit]


def links(own: np.ndarray, start: int, limit: int) -> list[tuple[int, int]]:
    """A spanning forest of the linked rows of one key."""
    out, rest = [], own
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = passes(rest ^ x, start, limit)
            if len(near):
                reached = rest[near]
                out += [(int(x), int(y)) for y in reached]
                front += list(reached)
                left = np.ones(len(rest), bool)
                left[near] = False
                rest = rest[left]
    return out


def all_links(grouped: DataFrame, limit: int) -> DataFrame:
    """Links (a, b) of rows (start, key, pair, fp) that share key and pair."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(key, start, fp):
            edges = np.flatnonzero(np.diff(key[:, 0]) | np.diff(key[:, 1])) + 1
            bounds = np.concatenate(([0], edges, [len(fp)]))
            sizes = np.diff(bounds)
            found = []
            for s in range(5):  # groups of two at once, by start
                two = bounds[:-1][(sizes == 2) & (start[bounds[:-1]] == s)]
                a, b = fp[two], fp[two + 1]
                near = passes(a ^ b, s, limit)
                found.append(np.stack((a[near], b[near]), 1))
            for g in np.flatnonzero(sizes > 2):
                lo, hi = bounds[g], bounds[g + 1]
                found.append(
                    np.array(links(fp[lo:hi], int(start[lo]), limit), np.uint64).reshape(-1, 2)
                )
            pairs = np.concatenate(found).view(np.int64) if found else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]
            )

        held = None
        for batch in batches:  # sorted by key and pair; the last group waits for more rows
            key = np.stack([batch.column(c).to_numpy() for c in ("key", "pair")], 1)
            now = (key, batch.column("start").to_numpy(), batch.column("fp").to_numpy().view(np.uint64))
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now))
            last = (now[0] == now[0][-1]).all(1)
            cut = int(np.argmax(last)) if len(last) else 0
            if cut:
                yield work(*(x[:cut] for x in now))
            held = tuple(x[cut:] for x in now)
        if held is not None and len(held[2]):
            yield work(*held)

    return grouped.mapInArrow(scan, "a long, b long")


def near_fingerprints(fps: DataFrame, limit: int = 4, split: int = SPLIT) -> DataFrame:
    """(node, root) of distinct fingerprints ``fps`` (fp) that have a link.

    ``limit`` may be 4 at most: the first two chain budgets, which the keys stand for, need
    limit / 5 below 1 and 2 limit / 5 below 2.
    """
    if limit > 4:
        raise ValueError("the keys hold for at most 4 differing bits")
    own = store(keys(fps), "fingerprint-keys")
    large = own.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > split)
    blocks = large.select("key", F.ceil(F.col("n") / split).cast("int").alias("blocks"))
    dealt = own.join(store(blocks, "large-keys"), "key", "left").withColumn(
        "block", F.when(F.col("blocks").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("blocks")))
    )
    # pair of blocks (low, high): a row takes part in every pair that holds its block
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)).cast("int") - 1))
    paired = dealt.withColumn("other", other).select(
        "start", "key", "fp",
        F.coalesce(
            F.least("block", "other") * F.lit(1 << 31) + F.greatest("block", "other"), F.lit(0)
        ).cast("long").alias("pair"),
    )
    # by key alone a hot key would meet in one task
    laid = paired.repartition("key", "pair").sortWithinPartitions("key", "pair")
    return components(all_links(laid, limit).distinct())


def groups(prints: DataFrame, limit: int = 4, linked: DataFrame | None = None) -> DataFrame:
    """(fp, component_id, root): the smallest doc_id of the component, for every fingerprint
    of ``prints`` (doc_id, fp); null where no document of it has an id.  ``linked`` has
    (node, root) where links are not those of near fingerprints."""
    nodes = store(
        prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprints"
    )
    if linked is None:
        linked = near_fingerprints(nodes.select("fp"), limit)
    roots = nodes.join(linked, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    roots = store(roots, "roots")
    lows = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    return roots.join(lows, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, limit: int = 4, size: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Null and empty texts and texts of white space have fingerprint zero, which links like any
    other; a text of fewer than ``size`` words is one shingle.  Null ids do not count as
    smallest (a component of null ids only has a null id).  Repeated rows give repeated
    rows; an empty table gives an empty table; other columns are not read.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    prints = store(fingerprints(own, size), "prints")
    known = groups(prints, limit).select("fp", "component_id")
    return prints.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, limit: int = 4, size: int = 4) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the smallest doc_id.

    A component without any id, and rows that repeat the chosen id within it, keep one row.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    prints = store(fingerprints(own, size), "prints")
    return chosen_rows(docs, prints, groups(prints, limit), lambda rows: fingerprints(rows, size))


def chosen_rows(
    docs: DataFrame, prints: DataFrame, known: DataFrame, mark: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The rows of ``docs`` that stand for the components ``known``; ``prints`` has (doc_id,
    fp) of every row, and ``mark`` gives rows (doc_id, text, any) with fp in place of text."""
    chosen = store(
        prints.join(known, "fp")
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("doc_id", "root")
        .agg(F.min("fp").alias("fp")),
        "chosen",
    )
    # ids of one row go by a join on the id; those of several are looked at in full
    key, row, mark_, root = fresh(docs, "id", "row", "fp", "root")
    once = prints.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    once = once.filter("n = 1").select("doc_id")
    single = store(chosen.join(once, "doc_id").select(F.col("doc_id").alias(key)), "single-ids")
    out = docs.join(single, F.col("doc_id") == F.col(key), "left_semi")
    doubled = chosen.join(single, F.col("doc_id") == F.col(key), "left_anti")
    if doubled.limit(1).count() == 0:
        return out
    ids = doubled.select(F.col("doc_id").alias(key)).distinct()
    rest = docs.join(ids, F.col("doc_id").eqNullSafe(F.col(key)), "left_semi")
    marked = mark(rest.withColumn(row, F.struct(*docs.columns)).select("doc_id", "text", row))
    of = doubled.select(F.col("doc_id").alias(key), F.col("fp").alias(mark_), F.col("root").alias(root))
    # of rows with the same id, those of the chosen fingerprint, and of these the least
    kept = (
        marked.join(of, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col("fp") == F.col(mark_)))
        .groupBy(key, root)
        .agg(F.min(row).alias(row))
    )
    return out.unionByName(kept.select(f"{row}.*"))
