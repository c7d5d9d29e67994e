"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram is the product of its three
letter vectors, each permuted (rotated) by its place; a document is the sum of its
trigrams, a language the sum of its documents at unit length.  Documents are compared
with the language prototypes by cosine, both taken from the centre of the prototypes,
so that what all languages share does not count.

Memory: a language costs one vector; documents are summed a slice of bytes at a time.
Sums are made per task, then by Spark per language and dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import fold, slices

SYMBOLS = 128  # 0: between words, 1 to 26: a to z, above: other letters by a hash
SURE = 128  # trigrams from which on a text's likeness to a language stands clear of chance
CELLS = 4_000_000  # largest (documents x trigrams) table in memory, unless one text alone
HELD = 128  # stretches compared at once


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Symbol of every code point."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if chr(point).isalpha():
            table[point] = point - 96 if 97 <= point <= 122 else 27 + point * 40503 % 101
    return table


@lru_cache(maxsize=2)
def letter_vectors(dims: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter vectors, permuted for the first, second and third place of a trigram."""
    letters = np.random.default_rng(seed).choice([-1.0, 1.0], (SYMBOLS, dims))
    letters = letters.astype(np.float32)
    return tuple(np.roll(letters, shift, axis=1) for shift in (0, 1, 2))


def trigrams(text: str) -> np.ndarray:
    """Trigram numbers of a text; runs of other characters count as one space."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = symbol_table()[points].astype(np.int32)
    symbols = symbols[(symbols > 0) | np.concatenate(([True], symbols[:-1] > 0))]
    if not symbols.any():
        return np.zeros(0, np.int32)
    return (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]


def document_vectors(texts: list[str], dims: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of texts, and which of them have a letter."""
    first, second, third = letter_vectors(dims, seed)
    found = [trigrams(t or "") for t in texts]
    out = np.zeros((len(texts), dims), np.float32)
    start = 0
    while start < len(texts):
        stop, distinct, mask = start, 0, np.zeros(SYMBOLS**3, bool)
        while stop < len(texts):
            fresh = np.unique(found[stop][~mask[found[stop]]])
            if stop > start and (distinct + len(fresh)) * (stop + 1 - start) > CELLS:
                break
            mask[fresh] = True
            distinct, stop = distinct + len(fresh), stop + 1
        together = np.concatenate(found[start:stop])
        grams = np.flatnonzero(mask)
        place = np.zeros(SYMBOLS**3, np.int32)
        place[grams] = np.arange(len(grams), dtype=np.int32)
        owner = np.repeat(np.arange(stop - start), [len(x) for x in found[start:stop]])
        counts = np.bincount(
            owner * max(len(grams), 1) + place[together],
            minlength=(stop - start) * len(grams),
        ).reshape(stop - start, len(grams))
        for at in range(0, len(grams), 1 << 14):  # vectors of so many trigrams at a time
            g = grams[at : at + (1 << 14)]
            bound = first[g // SYMBOLS**2] * second[g // SYMBOLS % SYMBOLS] * third[g % SYMBOLS]
            out[start:stop] += counts[:, at : at + (1 << 14)].astype(np.float32) @ bound
        start = stop
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norms, 1e-9), np.array([len(x) > 0 for x in found], bool)


def train(
    docs: DataFrame, dims: int = 512, seed: int = 7, max_languages: int = 1000
) -> tuple[list[str], np.ndarray]:
    """Language names and centred prototypes from rows (text, lang).

    Rows with null text or lang, or without letters, teach nothing.  More languages than
    ``max_languages`` (the bound of what reaches the driver and every task) is an error.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                vectors, has = document_vectors(part.column("text").to_pylist(), dims, seed)
                langs = np.array(part.column("lang").to_pylist(), object)
                for lang in set(langs[has]):
                    total = vectors[has & (langs == lang)].sum(0, dtype=np.float64)
                    sums[lang] = sums[lang] + total if lang in sums else total
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([total.tolist()], pa.list_(pa.float64()))],
                names=["lang", "total"],
            )

    rows = (
        docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
        .filter("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(bundle, "lang string, total array<double>")
        .select("lang", F.posexplode("total").alias("dim", "x"))
        .groupBy("lang", "dim")
        .agg(F.sum("x").alias("x"))
        .limit(max_languages * dims + 1)
        .toPandas()
    )
    if len(rows) > max_languages * dims:
        raise ValueError(f"more than {max_languages} languages")
    if not len(rows):
        return [], np.zeros((0, dims))
    wide = rows.pivot(index="lang", columns="dim", values="x").sort_index()
    prototypes = wide.to_numpy()
    prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)
    return list(wide.index), prototypes


def predict(
    docs: DataFrame,
    languages: list[str],
    prototypes: np.ndarray,
    seed: int = 7,
    added: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with the language and its score added.

    ``und`` with score 0: null text, a text without a letter, or nothing learned.  Ties go
    to the language first in order.  The score is the cosine, negative ones as 0.
    """
    dims = prototypes.shape[1]
    centre = prototypes.mean(0) if len(languages) > 1 else np.zeros(dims)
    apart = prototypes - centre
    apart /= np.maximum(np.linalg.norm(apart, axis=1, keepdims=True), 1e-9)
    held = docs.sparkSession.sparkContext.broadcast((apart, centre))  # bounded in train()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart, centre = held.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                vectors, has = document_vectors(part.column("text").to_pylist(), dims, seed)
                best, score = np.zeros(len(has), int), np.zeros(len(has))
                if languages:
                    off = vectors - centre
                    off /= np.maximum(np.linalg.norm(off, axis=1, keepdims=True), 1e-9)
                    cosines = off @ apart.T
                    best = cosines.argmax(1)
                    score = np.clip(cosines[np.arange(len(best)), best], 0, 1)
                named = has & bool(languages)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([languages[b] if k else "und" for b, k in zip(best, named)]),
                        pa.array(np.where(named, score, 0.0).astype(float), pa.float64()),
                    ],
                    names=[*part.schema.names, *added],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(compare, f"{fields}, {added[0]} string, {added[1]} double")


def distinct(text: str | None) -> str:
    """The distinct words of a text in order."""
    return " ".join(dict.fromkeys((text or "").split()))


def stretches(grams: np.ndarray) -> np.ndarray:
    """All trigrams of a text in rows of ``SURE``; the last row reaches back if it is short, and
    fewer make no row."""
    starts = np.arange(0, len(grams), SURE)
    at = np.minimum(starts, len(grams) - SURE)[:, None] + np.arange(SURE)
    return grams[at] if len(grams) >= SURE else np.zeros((0, SURE), np.int32)


def stretch_vectors(grams: np.ndarray, dims: int, seed: int) -> np.ndarray:
    """Unit vectors of rows of trigrams."""
    first, second, third = letter_vectors(dims, seed)
    g, place = np.unique(grams, return_inverse=True)
    at = np.arange(len(grams))[:, None] * len(g) + place.reshape(grams.shape)
    counts = np.bincount(at.ravel(), minlength=len(grams) * len(g)).reshape(len(grams), len(g))
    bound = first[g // SYMBOLS**2] * second[g // SYMBOLS % SYMBOLS] * third[g % SYMBOLS]
    out = counts.astype(np.float32) @ bound
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def floors(docs: DataFrame, languages: list[str], prototypes: np.ndarray, seed: int = 7) -> np.ndarray:
    """The likeness (cosine, not centred) a text of each language has at least: three quarters
    of what all but 0.5 % of its own texts (text, lang) have.  Texts count by their distinct
    words, so that one word many times over does not.  Since likeness grows with length, a text's
    is the mean over all its stretches of ``SURE`` trigrams.

    A language without a text of ``SURE`` trigrams has floor -1, which no text is below.
    """
    dims = prototypes.shape[1]
    held = docs.sparkSession.sparkContext.broadcast(prototypes)  # bounded in train()
    place = {name: i for i, name in enumerate(languages)}

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                at = [place.get(x, -1) for x in part.column("lang").to_pylist()]
                rows = [(i, stretches(trigrams(distinct(t)))) for i, t in zip(at, part.column("text").to_pylist()) if i >= 0]
                rows = [(i, x) for i, x in rows if len(x)]
                at = np.array([i for i, _ in rows], np.int32)
                grams = np.concatenate([x for _, x in rows] or [np.zeros((0, SURE), np.int32)])
                owner = np.repeat(np.arange(len(rows)), [len(x) for _, x in rows])
                total = np.zeros(len(rows))
                for start in range(0, len(grams), HELD):
                    own = owner[start : start + HELD]
                    vectors = stretch_vectors(grams[start : start + HELD], dims, seed)
                    like = (vectors * held.value[at[own]]).sum(1, dtype=np.float64)
                    total += np.bincount(own, like, len(rows))
                like = total / np.bincount(owner, minlength=len(rows))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(like)], names=["at", "like"])

    out = np.full(len(languages), -1.0)
    rows = (
        docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
        .filter("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(own, "at int, like double")
        .groupBy("at")
        .agg(F.percentile_approx("like", 0.005, 100_000).alias("low"))
    )
    for r in rows.collect():  # one row a language
        out[r["at"]] = 0.75 * r["low"]
    return out


def like_some(
    docs: DataFrame, languages: list[str], prototypes: np.ndarray, least: np.ndarray, seed: int = 7
) -> DataFrame:
    """The rows of ``docs`` with a letter, without texts whose distinct words have ``SURE``
    trigrams or more and a likeness below the floor ``least`` of every language.  With nothing
    learned, no text with a letter goes."""
    dims = prototypes.shape[1]
    held = docs.sparkSession.sparkContext.broadcast((prototypes, least))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prototypes, least = held.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = [distinct(t) for t in part.column("text").to_pylist()]
                vectors, stays = document_vectors(texts, dims, seed)
                if languages:
                    low = stays & (vectors @ prototypes.T < least).all(1)
                    for i in np.flatnonzero(low):
                        stays[i] = len(trigrams(texts[i])) < SURE
                yield part.filter(pa.array(stays))

    return docs.mapInArrow(scan, docs.schema)


def language_ids(docs: DataFrame, folds: int = 3, held_fold: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; learns outside the held fold.

    Null ids count as empty text for the fold; repeated rows give repeated rows; an empty
    table gives an empty table.  Only doc_id, text and lang are read, lang in training only.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        (fold("doc_id", folds) == held_fold).alias("held_out"),
    )
    languages, prototypes = train(own.filter(~F.col("held_out")))
    return predict(own.select("doc_id", "held_out", "text"), languages, prototypes).drop("text")
