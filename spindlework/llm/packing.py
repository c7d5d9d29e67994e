"""Vector best-fit packing of tokenised documents into sequences.

Tokenising.  Normalising, lower case and the split into words are local to what white space
separates, so the ids of a text are those of its words in a row.  Frequent words are encoded
once a worker and looked up; ids are joined as bytes.

Packing.  A sequence has three capacities: tokens, documents and attention cost (the sum of
squared lengths).  Pieces are placed in falling order, each into the open sequence that can
take it under every capacity and has the least weighted residual norm afterwards.  A
capacity's weight is the share of it the pieces ask for, against the share most asked for.

Scale.  Only piece lengths are shuffled, not ids.  Pieces are dealt by a hash of their row
number into groups of about ``GROUP`` and each group is packed in a task; a group leaves
one or two sequences part full, of thousands.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import as_bytes, slices, store

GROUP = 32_768
HELD_WORDS = 400_000  # words a worker keeps; later ones are encoded each time
PLAIN = re.compile("[a-zß-öø-ÿ]+")  # lower-case letters that stay as they are
STOP = re.compile(rb"(?<=[a-z])([.,])(?=[ \n]|$)")


@lru_cache(maxsize=1)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    vocabulary = made.get_vocab(with_added_tokens=True)
    last = np.zeros(max(vocabulary.values()) + 1, bool)
    for token, number in vocabulary.items():
        last[number] = token.endswith("</w>")
    return made, last


def encode_words(words: list[bytes], path: str) -> dict[bytes, bytes]:
    """Ids of words.  Plain ones, which are one unit to the model, go many to a text and
    are told apart by the mark of a unit's last token; the others go one by one."""
    model, last = tokenizer(path)
    texts = [w.decode("utf-8") for w in words]
    alone, plain = [], []
    for i, text in enumerate(texts):
        (plain if PLAIN.fullmatch(text) else alone).append(i)
    runs = [plain[i : i + 64] for i in range(0, len(plain), 64)]
    found = model.encode_batch_fast(
        [" ".join([texts[i] for i in run]) for run in runs], add_special_tokens=False
    )
    out: dict[bytes, bytes] = {}
    for run, line in zip(runs, found):
        ids = np.array(line.ids, "<u4")
        ends = (np.flatnonzero(last[ids]) + 1).tolist()
        if len(ends) != len(run):
            alone += run
            continue
        raw = ids.tobytes()
        for i, a, b in zip(run, [0, *ends], ends):
            out[words[i]] = raw[4 * a : 4 * b]
    found = model.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)
    for i, line in zip(alone, found):
        out[words[i]] = np.array(line.ids, "<u4").tobytes()
    return out


_held: dict[str, dict[bytes, bytes]] = {}


def encode(texts: list[bytes], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers, without special tokens.

    Lower case is done here for A-Z and a full stop or comma behind a letter is split off
    (both change no id), so that fewer words differ; a text that may hold a special
    token's string keeps its letters.
    """
    known = _held.setdefault(path, {})
    words = [
        (t if b"<|" in t else STOP.sub(rb" \1", t.lower())).split() for t in texts
    ]
    fresh = list(set().union(*words).difference(known))
    own = known
    if fresh:
        made = encode_words(fresh, path)
        if len(known) + len(made) <= HELD_WORDS:
            known.update(made)
        else:
            own = _Two(made)
            own.known = known
    return [b"".join(map(own.__getitem__, w)) for w in words]


class _Two(dict):
    """A slice's own words before the held ones."""

    known: dict[bytes, bytes]

    def __missing__(self, word: bytes) -> bytes:
        return self.known[word]


def pieces(
    docs: DataFrame, path: str | None = None, limit: int = 4096, end_id: int = 1, keep_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): documents cut at ``limit`` tokens.

    A null text counts as empty and is one piece that holds the end id alone.
    """
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + keep_ids]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = path
        if place is None:
            import public_tokenizers

            place = public_tokenizers.path("word_bpe_49k.json")
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, "text", 1 << 21):
                rows = []
                ids = encode(as_bytes(part, "text"), place)
                for doc, own in zip(part.column("doc_id").to_pylist(), ids):
                    own += end
                    for k, at in enumerate(range(0, len(own), 4 * limit)):
                        cut = own[at : at + 4 * limit]
                        row = (doc, k, at // 4, len(cut) // 4, crc32(cut), cut)
                        rows.append(row[: 5 + keep_ids])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names
                )

    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return own.mapInArrow(
        scan,
        "doc_id long, piece int, start long, length long, ids_crc32 long"
        + ", ids binary" * keep_ids,
    )


def best_fit(
    lengths: np.ndarray, tokens: int = 4096, documents: int | None = None, cost: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, placed in falling order under all three capacities.

    Without limits of their own a sequence takes as many documents as tokens and a cost of
    tokens squared; these refuse no piece but count in the choice like any other.
    """
    documents = tokens if documents is None else documents
    cost = tokens * tokens if cost is None else cost
    if not len(lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if lengths.max() > tokens or int(lengths.max()) ** 2 > cost or documents < 1:
        raise ValueError("a piece exceeds a capacity of an empty sequence")
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order].astype(np.int64)
    asked = np.array([sizes.sum() / tokens, len(sizes) / documents, (sizes.astype(float) ** 2).sum() / cost])
    per_token, per_document, per_cost = asked / asked.max() / (tokens, documents, cost)
    least = int(sizes[-1])
    # residual capacities of the open sequences, whole numbers, the first n_open of each
    room, spare, effort = (np.zeros(len(sizes), np.int64) for _ in range(3))
    number = np.zeros(len(sizes), np.int64)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    n_open = made = 0
    for i, size in zip(order.tolist(), sizes.tolist()):
        square = size * size
        rest, more, work = room[:n_open] - size, spare[:n_open] - 1, effort[:n_open] - square
        able = np.flatnonzero((rest >= 0) & (more >= 0) & (work >= 0))
        if len(able):
            norm = (rest[able] * per_token) ** 2
            norm += (more[able] * per_document) ** 2
            norm += (work[able] * per_cost) ** 2
            at = int(able[norm.argmin()])
        else:
            at, number[n_open], n_open, made = n_open, made, n_open + 1, made + 1
            room[at], spare[at], effort[at] = tokens, documents, cost
        bins[i], offsets[i] = number[at], tokens - room[at]
        room[at] -= size
        spare[at] -= 1
        effort[at] -= square
        if room[at] < least or spare[at] < 1 or effort[at] < least * least:
            n_open -= 1  # takes nothing any more: the last open one moves here
            for held in (room, spare, effort, number):
                held[at] = held[n_open]
    return bins, offsets


def pack(
    made: DataFrame,
    tokens: int = 4096,
    documents: int | None = None,
    cost: int | None = None,
    group: int = GROUP,
) -> DataFrame:
    """``made`` (with length, from :func:`pieces`) with sequence_id and offset."""
    rows = store(made.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    n = -(-rows.count() // group) or 1
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(n)))
    out = rows.drop("_row").schema.add("sequence_id", "long").add("offset", "long")

    def work(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("_row")
        bins, offsets = best_fit(table.column("length").to_numpy(), tokens, documents, cost)
        table = table.drop_columns(["_row", "_group"])
        first = key[0].as_py() << 32
        return table.append_column("sequence_id", pa.array(bins + first)).append_column(
            "offset", pa.array(offsets)
        )

    return dealt.groupBy("_group").applyInArrow(work, out)


def packed(docs: DataFrame, path: str | None = None, tokens: int = 4096) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all documents.

    Every row of ``docs`` has at least one piece (the end id); repeated rows are packed as
    often as they occur; an empty table gives an empty table; other columns are not read.
    """
    return pack(pieces(docs, path, tokens), tokens)
