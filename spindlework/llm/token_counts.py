"""Token counts by a sentencepiece model, without keeping the tokens.

Texts are encoded in Arrow batches cut by bytes, not by rows, so a batch of long
documents is no larger than one of short ones; only the lengths leave the encoder.
A long text is cut at safe boundaries: before a space that follows a character which is
no space.  No piece of the vocabulary holds a space mark behind another character (this
is checked when the model is loaded; otherwise texts stay whole), so no merge can reach
over such a place, and the space itself returns as the prefix the model puts before
every text.  The sum of the parts therefore equals the count of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import slices

MARK = "▁"  # how the model writes a space


@lru_cache(maxsize=2)
def load(path: str):
    """The model and whether its texts may be cut before spaces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    inner = any(MARK in piece.lstrip(MARK) for piece in pieces)
    probe = ["a b", "a", "b", " b", f"{MARK}b"]
    whole, a, b, spaced, marked = (model.encode(x) for x in probe)
    safe = not inner and a + b == whole and len(spaced) >= 1 and spaced == marked
    # doubled spaces must survive, or the prefix of a part would swallow one
    safe = safe and model.encode("a  b") == a + model.encode(" b") and model.encode(" b") != b
    return model, safe


def cut(text: str, size: int) -> list[str]:
    """``text`` in parts of about ``size`` characters, cut at safe spaces (dropped)."""
    parts, start = [], 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at >= 0 and text[at - 1] in (" ", MARK):
            at = text.find(" ", at + 1)
        if at < 0 or at + 1 >= len(text):
            break
        parts.append(text[start:at])
        start = at + 1
    parts.append(text[start:])
    return parts


def count_batch(texts: list[str], model, safe: bool, part_chars: int) -> list[int]:
    """Tokens of each text; parts of about equal size go to the encoder together."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        own = cut(text, part_chars) if safe and len(text) > part_chars else [text]
        parts += own
        owner += [i] * len(own)
    lengths = [len(ids) for ids in model.encode(parts, num_threads=1)]
    return np.bincount(owner, weights=lengths, minlength=len(texts)).astype(np.int64).tolist()


def token_counts(
    docs: DataFrame,
    model_path: str | None = None,
    limit: int = 4096,
    batch_bytes: int = 1 << 20,
    part_chars: int = 1 << 15,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    A null text counts as empty (0 tokens); a text without a safe boundary is encoded
    whole; repeated rows give repeated rows; other columns of ``docs`` are not read; an
    empty table gives an empty table.  ``model_path`` must exist on every executor;
    by default it is looked up there.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = model_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        model, safe = load(path)
        for batch in batches:
            for part in slices(batch, "text", batch_bytes):
                texts = part.column("text").to_pylist()
                sizes = [len(t.encode("utf-8")) for t in texts]
                tokens = count_batch(texts, model, safe, part_chars)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(tokens, pa.int64()),
                        pa.array([n > limit for n in tokens], pa.bool_()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
