"""Toxic passages as maximum-scoring segments of token log-odds.

Weights.  Tokens (words in lower case, hashed into a fixed number of cells) are counted,
once a document, in toxic and clean documents of a bounded labelled sample, of whose near
copies one is taken.  A cell's weight is its log-odds
between the classes under a Dirichlet prior in proportion to the pooled counts; only
weights significant against their variance stay positive, and every other token costs a
little, so that the expected score of clean text is negative.

Passages.  A single scan in linear time finds every maximal segment of positive score.

Calibration.  Best segments of random text follow an extreme-value law: segments of score
S or more are expected K n exp(-lambda S) times in n tokens.  lambda is the root of
sum p exp(lambda w) = 1 over the clean token distribution, K is measured on clean sample
documents.  The evidence of a document's passages is summed over the E-values, and a
logistic curve fitted on sample documents not used for the weights turns it into a
probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import as_bytes, fold, plain_words, slices, store

CELLS = 1 << 20
SAMPLE = 20_000  # labelled documents of each class, at most; documented bound of the fit
PRIOR = 0.1  # weight of the Dirichlet prior against the counts
SIGNIFICANT = 3.5  # standard errors
SKETCHES = 12  # minima of hashed word triples by which near copies in the sample are told
TOGETHER = 3  # minima that copies share in a row: 94 % of pairs alike to 0.8, 0.4 % at 0.1
DRIFT = 0.1  # cost of a token that says nothing


@dataclass
class Model:
    weights: np.ndarray  # score of each cell
    decay: float  # lambda
    rate: float  # K
    curve: np.ndarray  # intercept and slopes of the logistic curve


def cells(text: bytes) -> np.ndarray:
    words = plain_words(text)
    return np.fromiter(map(crc32, words), np.uint32, len(words)) & np.uint32(CELLS - 1)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, stop, score), in order, in linear time."""
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    # one run of neighbouring positive tokens acts as one
    breaks = np.flatnonzero(np.diff(positive) > 1)
    starts = positive[np.concatenate(([0], breaks + 1))]
    stops = positive[np.concatenate((breaks, [len(positive) - 1]))] + 1
    kept: list[list[float]] = []  # start, stop, total before, total after, link to the left
    for start, stop in zip(starts.tolist(), stops.tolist()):
        now = [start, stop, total[start], total[stop], -1]
        while True:
            j = len(kept) - 1  # the last one to the left that begins lower
            while j >= 0 and kept[j][2] >= now[2]:
                j = int(kept[j][4])
            if j < 0 or kept[j][3] >= now[3]:
                now[4] = j
                kept.append(now)
                break
            now[0], now[2] = kept[j][0], kept[j][2]  # join with all from j on
            del kept[j:]
    return [(int(a), int(b), float(high - low)) for a, b, low, high, _ in kept]


def evidence(found: list[tuple[int, int, float]], n: int, decay: float, rate: float):
    """Two figures of a document: summed evidence and that of its best passage."""
    if not found:
        return 0.0, 0.0
    scores = np.array([s for _, _, s in found])
    expected = rate * max(n, 1) * np.exp(-np.minimum(decay * scores, 600))
    proof = np.maximum(-np.log(expected), 0.0)
    return float(np.log1p(proof.sum())), float(np.log1p(proof.max()))


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(doc_id, toxic, half): at most ``size`` labelled ids of a class, by a hash of the id.

    Rows with a null label or a label other than 0 and 1 are no examples, nor are ids that
    ``docs`` does not have; an id labelled twice counts as toxic if any row says so.
    """
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .join(there, "doc_id", "left_semi")
        .withColumn("_order", F.xxhash64("doc_id"))
    )
    of = [known.filter(F.col("toxic") == k).orderBy("_order", "doc_id").limit(size) for k in (0, 1)]
    return of[0].unionByName(of[1]).select(
        "doc_id", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).alias("half")
    )


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Minima of SKETCHES hashes over the word triples of each text."""
    mix = np.random.default_rng(5).integers(1, 1 << 62, (SKETCHES, 3), np.uint64) | np.uint64(1)
    for batch in batches:
        rows = []
        for text in as_bytes(batch, "text"):
            words = plain_words(text)
            h = np.fromiter(map(crc32, words), np.uint64, len(words)) + np.uint64(1)
            h = np.concatenate((h, np.zeros(2, np.uint64)))
            h *= np.uint64(0x9E3779B97F4A7C15)
            three = [(h[:-2] * a) ^ (h[1:-1] * b) ^ (h[2:] * c) for a, b, c in mix]
            rows.append([int((x >> np.uint64(1)).min()) if len(x) else 0 for x in three])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), batch.column("half")]
            + [pa.array([r[k] for r in rows], pa.int64()) for k in range(SKETCHES)],
            names=["doc_id", "toxic", "half", *(f"s{k}" for k in range(SKETCHES))],
        )


def one_of_copies(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The sample with the smallest id of the near copies of a class.

    Copies are rows that share all minima of one of SKETCHES / TOGETHER sets; texts without a
    word are copies of each other.
    """
    columns = ["doc_id", "toxic", "half", *(f"s{k}" for k in range(SKETCHES))]
    rows = docs.join(F.broadcast(sample), "doc_id").mapInArrow(
        _sketch, "doc_id long, toxic int, half long" + "".join(f", s{k} long" for k in range(SKETCHES))
    )
    for k in range(0, SKETCHES, TOGETHER):
        keys = [F.col(c).alias(f"k_{c}") for c in ("toxic", *(f"s{i}" for i in range(k, k + TOGETHER)))]
        rows = rows.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("r")).select("r.*")
    return rows.select("doc_id", "toxic", "half")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a cell, one row for each cell seen in the task."""
    counts = np.zeros((2, CELLS), np.int64)
    for batch in batches:
        for text, toxic in zip(as_bytes(batch, "text"), batch.column("toxic").to_pylist()):
            counts[toxic][np.unique(cells(text))] += 1
    seen = np.flatnonzero(counts.any(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(counts[0, seen]), pa.array(counts[1, seen])],
        names=["cell", "clean", "toxic"],
    )


def token_weights(clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Log-odds of cells under a Dirichlet prior; insignificant ones cost DRIFT."""
    pooled = clean + toxic + 0.01
    prior = PRIOR * pooled
    n1, n0 = toxic.sum() + prior.sum(), clean.sum() + prior.sum()
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (n1 - a)) - np.log(b / (n0 - b))
    z = odds / np.sqrt(1 / a + 1 / b)
    return np.where(z >= SIGNIFICANT, odds, np.clip(odds, -1.0, 0.0) * 0.1 - DRIFT)


def decay_of(weights: np.ndarray, clean: np.ndarray) -> float:
    """lambda: the positive root of sum p exp(lambda w) = 1, p of clean tokens with prior."""
    p = clean + 0.01
    p = p / p.sum()
    low, high = 0.0, 1.0

    def excess(x: float) -> float:
        return float((p * np.exp(np.minimum(x * weights, 600))).sum() - 1)

    if not (weights > 0).any():
        return 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(high, 1e-3)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method on a few columns with an intercept; slopes are shrunk, not negative."""
    design = np.column_stack((np.ones(len(x)), x))
    curve, shrink = np.zeros(design.shape[1]), ridge * np.eye(design.shape[1])
    shrink[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ curve, -30, 30)))
        slope = design.T @ (y - p) - shrink @ curve
        bend = (design * (p * (1 - p))[:, None]).T @ design + shrink
        curve = curve + np.linalg.solve(bend + 1e-9 * np.eye(len(bend)), slope)
    curve[1:] = np.maximum(curve[1:], 0)
    return curve


def train(docs: DataFrame, sample: DataFrame) -> Model | None:
    """Fit on (doc_id, text) rows of the sample; None if a class has no example.

    The sample has at most 2 x SAMPLE ids, so it is broadcast; the counts have CELLS rows
    at most, the calibration one row for each sample document.
    """
    chosen = store(one_of_copies(docs, sample), "toxicity-sample")
    texts = docs.join(F.broadcast(chosen), "doc_id")
    rows = (
        texts.filter("half = 0")
        .select("text", "toxic")
        .mapInArrow(_count, "cell long, clean long, toxic long")
        .groupBy("cell")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toPandas()
    )
    clean, toxic = np.zeros(CELLS), np.zeros(CELLS)
    clean[rows.cell], toxic[rows.cell] = rows.clean, rows.toxic
    if not clean.sum() or not toxic.sum():
        return None
    weights = token_weights(clean, toxic)
    decay = decay_of(weights, clean)
    held = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, label in zip(as_bytes(batch, "text"), batch.column("toxic").to_pylist()):
                own = cells(text)
                found = segments(held.value[own])
                kept.append((label, len(own), [s for _, _, s in found]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in kept], pa.int32()),
                    pa.array([k[1] for k in kept], pa.int64()),
                    pa.array([k[2] for k in kept], pa.list_(pa.float64())),
                ],
                names=["toxic", "n", "scores"],
            )

    seen = (
        texts.filter("half = 1")
        .select("text", "toxic")
        .mapInArrow(scan, "toxic int, n long, scores array<double>")
        .toPandas()
    )
    if not len(seen):
        return Model(weights, decay, 1e-3, np.array([-2.0, 2.0, 0.0]))
    plain = seen[seen.toxic == 0]
    # by the law at S = 0: clean text has K segments a token by chance
    rate = (1.0 + plain.scores.map(len).sum()) / (plain.n.sum() + 1.0)
    x = np.array(
        [evidence([(0, 0, v) for v in s], n, decay, rate) for s, n in zip(seen.scores, seen.n)]
    ).reshape(-1, 2)
    return Model(weights, decay, rate, logistic(x, seen.toxic.to_numpy(float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text, others) with score, evalue and passages in place of text.

    ``passages`` holds every segment of E-value under 1 with its words' places and score.
    """
    kept = [f for f in docs.schema.fields if f.name != "text"]
    held = docs.sparkSession.sparkContext.broadcast(
        (model.weights.astype(np.float32), model.decay, model.rate, model.curve)
    )
    passage = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, decay, rate, curve = held.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                out = []
                for text in as_bytes(part, "text"):
                    own = cells(text)
                    found = segments(weights[own])
                    x = evidence(found, len(own), decay, rate)
                    p = 1 / (1 + np.exp(-np.clip(curve[0] + curve[1:] @ x, -30, 30)))
                    best = max((s for _, _, s in found), default=0.0)
                    e = rate * len(own) * float(np.exp(-min(decay * best, 600)))
                    low = np.log(max(rate * len(own), 1e-300)) / decay
                    out.append((p, e, [s for s in found if s[2] > low]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(f.name) for f in kept),
                        pa.array([o[0] for o in out], pa.float64()),
                        pa.array([o[1] for o in out], pa.float64()),
                        pa.array([[dict(zip(("start", "stop", "score"), s)) for s in o[2]] for o in out], pa.list_(passage)),
                    ],
                    names=[*(f.name for f in kept), "score", "evalue", "passages"],
                )

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return docs.mapInArrow(
        scan,
        f"{fields}score double, evalue double, "
        "passages array<struct<start: int, stop: int, score: double>>",
    )


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted, evalue, passages) for every row of ``docs``.

    Learns only from labelled rows outside the held fold (a null id counts as empty text
    for the fold and is never labelled).  Null and empty texts have no passage and get
    the score of no evidence.  Without an example of both classes every score is 0.
    Repeated rows give repeated rows; an empty table gives an empty table.
    """
    held = fold("doc_id", folds) == held_fold
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        held.alias("held_out"),
    )
    model = train(
        own.filter(~F.col("held_out")).select("doc_id", "text"),
        labelled_sample(docs, labels.filter(~held), SAMPLE),
    )
    if model is None:
        model = Model(np.full(CELLS, -DRIFT), 1.0, 1.0, np.array([-30.0, 0.0, 0.0]))
    scored = score(own, model)
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evalue", "passages",
    )
