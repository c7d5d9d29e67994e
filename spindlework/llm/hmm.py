"""A hidden Markov language model, trained by Baum-Welch over the whole corpus.

A hidden state emits a word of the whole training vocabulary.  The rounds of training tie
words together: the most frequent ones are classes of their own, all others share classes by
their last two characters.  A last pass of expected counts is kept for every word and state, in
a table that grows with the vocabulary, and unties the words: a word of a shared class takes its
own odds of the states, drawn to those of its class where it is rare.  Within a class and
state known words and one part for unknown words sum to one, so the model is a proper
distribution over the same events as the unigram base.

Jobs.  Texts become blocks of about ``BLOCK_BYTES`` with numbers local to the block and the
block's own word list.  Every Baum-Welch round is one pass over the blocks: expected counts are
summed in the task, then by Spark for each class; only states x classes figures reach the
driver.  Then word lists (a row for each word and block, not for each token) meet by word
with their counts and expected states, and go back to their blocks.  Words with a class of
their own take no part in that, so no word of many rows meets in one task, and no vocabulary is
broadcast or gathered anywhere.

Training cuts long texts into stretches of ``STRETCH`` tokens.  A stretch reads ``MARGIN``
tokens more on both sides, which give its first and last state their odds; every token and
every transition is counted once.  Scores cut nothing: the scaled forward recursion runs over
each whole text, all texts of a block side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from string import punctuation
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spindlework.llm.common import as_bytes, fold, slices, store

STATES = 8  # 8 at most: the states of a word are written as 4 bits each
ROUNDS = 5
OWN_CLASSES = 2048  # most frequent words
END_CLASSES = 1024  # classes by ending
CLASSES = OWN_CLASSES + END_CLASSES + 1  # and that of the text's end
OFTEN = 1 << 16  # a word of this part of some block's tokens may get a class of its own
WORD_PRIOR = 2.0  # tokens by which a word's states are drawn to those of its class
BLOCK_BYTES = 7 << 19
STRETCH = 176
MARGIN = 8
TOGETHER = 768  # stretches computed side by side


@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes (or words) x states
    use: np.ndarray | None = None  # share of the tokens in each state


@dataclass
class Words:
    """What scoring knows of shared classes and of the corpus, CLASSES rows at most."""

    tokens: np.ndarray  # training tokens of each class
    distinct: int  # different words in training
    prior: np.ndarray  # classes x states, odds of the states in a class
    whole: np.ndarray  # classes x states, what the words of a class sum to


def blocks(docs: DataFrame) -> DataFrame:
    """(block, doc_ids, held, sizes, ids, words, counts, often, often_n), a row for each block,
    of rows (doc_id, held_out, text).  Word 0 is the end of a text, written as ''; words are
    joined by blanks.  ``often``: the words that make up one token in ``OFTEN`` of the block or
    more, with their counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_ids", "held", "sizes", "ids", "words", "counts", "often", "often_n"]

        def emit(own):
            docs, held, lines = zip(*own)
            number: dict[bytes, int] = {b"": 0}
            tokens, sizes = [], []
            for line in lines:
                words = line.lower().split()
                for w in dict.fromkeys(words):  # early, so mostly frequent, words get small numbers
                    number.setdefault(w, len(number))
                tokens.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                tokens.append(np.zeros(1, np.uint32))
                sizes.append(len(words) + 1)
            ids = np.concatenate(tokens)
            learns = np.repeat(~np.array(held), sizes)
            counts = np.bincount(ids[learns], minlength=len(number))
            often = np.flatnonzero((counts > 0) & (counts * OFTEN >= len(ids)))
            listed = list(number)
            kinds = [pa.int64(), pa.bool_(), pa.int32(), None, None, None, pa.string(), pa.int64()]
            values = [
                docs, held, sizes, planes(ids), b" ".join(listed), planes(counts),
                [listed[i].decode("utf-8") for i in often], counts[often],
            ]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([value], pa.binary())
                    if kind is None
                    else pa.array([list(value)], pa.list_(kind))
                    for kind, value in zip(kinds, values)
                ],
                names=names,
            )

        own, size = [], 0
        for part in (s for batch in batches for s in slices(batch, "text", BLOCK_BYTES)):
            ids, held = (part.column(c).to_pylist() for c in ("doc_id", "held_out"))
            for row in zip(ids, held, as_bytes(part, "text")):
                own.append(row)
                size += len(row[2])
                if size >= BLOCK_BYTES:
                    yield emit(own)
                    own, size = [], 0
        if own:
            yield emit(own)

    made = docs.mapInArrow(
        scan,
        "doc_ids array<bigint>, held array<boolean>, sizes array<int>, ids binary, "
        "words binary, counts binary, often array<string>, often_n array<bigint>",
    )
    return store(made.withColumn("block", F.monotonically_increasing_id()), "blocks")


def frequent_words(made: DataFrame) -> dict[str, int]:
    """Class of each word that has one of its own: the OWN_CLASSES most frequent words."""
    listed = made.select(F.explode(F.arrays_zip("often", "often_n")).alias("w")).select(
        F.col("w.often").alias("word"), F.col("w.often_n").alias("n")
    )
    top = (
        listed.filter("word <> ''")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(OWN_CLASSES)
    )
    return {r.word: i for i, r in enumerate(top.collect())}  # at most OWN_CLASSES rows


class _Endings(dict):
    def __missing__(self, end: str) -> int:
        self[end] = found = OWN_CLASSES + crc32(end.encode()) % END_CLASSES
        return found


def ending_class(word: str) -> Column:
    """The shared class of a word, as :func:`with_classes` gives it."""
    end = F.substring(F.regexp_replace(word, r"[\p{Punct}]+\z", ""), -2, 2)
    return (F.crc32(end) % END_CLASSES).cast("int") + OWN_CLASSES


def with_classes(made: DataFrame, own: dict[str, int]) -> tuple[DataFrame, np.ndarray]:
    """Blocks with ``kinds`` (the class of each word of the block) and ``classes`` (that of
    each token) in place of often, and the training tokens of each class."""
    held = made.sparkSession.sparkContext.broadcast(own | {"": CLASSES - 1})  # bounded
    kept = ["block", "doc_ids", "held", "sizes", "ids", "words", "counts"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ends = held.value, _Endings()
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                words = part.column("words")[0].as_py().decode("utf-8").split(" ")
                kinds = np.fromiter(
                    (own[w] if w in own else ends[w.rstrip(punctuation)[-2:]] for w in words),
                    np.uint16,
                    len(words),
                )
                tokens = kinds[from_planes(part.column("ids")[0].as_py())]
                tally = np.bincount(kinds, from_planes(part.column("counts")[0].as_py()), CLASSES)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in kept),
                        pa.array([kinds.tobytes()], pa.binary()),
                        pa.array([tokens.tobytes()], pa.binary()),
                        pa.array([tally.astype(np.int64)], pa.list_(pa.int64())),
                    ],
                    names=[*kept, "kinds", "classes", "tally"],
                )

    coded = store(
        made.select(*kept).mapInArrow(
            scan,
            "block long, doc_ids array<bigint>, held array<boolean>, sizes array<int>, ids binary, "
            "words binary, counts binary, kinds binary, classes binary, tally array<bigint>",
        ),
        "coded",
    )
    tokens = np.zeros(CLASSES)
    summed = coded.select(F.posexplode("tally").alias("cls", "n")).filter("n > 0").groupBy("cls")
    for r in summed.agg(F.sum("n").alias("n")).collect():  # at most CLASSES rows
        tokens[r.cls] = r.n
    return coded.drop("tally"), tokens


PLACE = 31  # bits of a word's place in its block, in front of which are its states


def bits_of_states(states: int) -> list[Column]:
    """The figure of each state in ``at_q``."""
    return [F.shiftrightunsigned("at_q", PLACE + 4 * s).bitwiseAND(F.lit(15)) for s in range(states)]


def nibbles(shares: np.ndarray) -> np.ndarray:
    """Rows of figures as 4 bits each, 15 for the largest of a row, the first in front."""
    most = np.maximum(shares.max(1, keepdims=True), 1e-30)
    parts = np.rint(15 * shares / most).astype(np.int64)
    return (parts << (4 * np.arange(shares.shape[1]))).sum(1)


def from_nibbles(packed: np.ndarray, states: int) -> np.ndarray:
    """Rows of shares that sum to one (zeros if there is none)."""
    parts = (packed[:, None] >> (4 * np.arange(states))) & 15
    return parts / np.maximum(parts.sum(1, keepdims=True), 1)


def word_states(coded: DataFrame, model: Model) -> DataFrame:
    """(block, at_q, word, n): for each word of a shared class and each block with it, its
    training tokens there, and its place in the block and their expected states as
    :func:`nibbles` in one number, the place in its last 31 bits."""
    held = coded.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                kinds = np.frombuffer(batch.column("kinds")[i].as_py(), np.uint16)
                ids = from_planes(batch.column("ids")[i].as_py())
                sizes = batch.column("sizes")[i].values.to_numpy()
                learns = ~batch.column("held")[i].values.to_numpy(zero_copy_only=False)
                found = expect(
                    held.value, kinds[ids], *stretches(sizes, learns), keys=ids, n_keys=len(kinds)
                )
                at = np.flatnonzero((kinds >= OWN_CLASSES) & (kinds < CLASSES - 1))
                words = pa.array([batch.column("words")[i].as_py()], pa.binary()).cast(pa.string())
                counts = from_planes(batch.column("counts")[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), batch.column("block")[i].as_py(), np.int64)),
                        pa.array(nibbles(found[2][at]) << PLACE | at),
                        pc.split_pattern(words, " ").values.take(pa.array(at)),
                        pa.array(counts[at].astype(np.int64)),
                    ],
                    names=["block", "at_q", "word", "n"],
                )

    return coded.select("block", "held", "sizes", "ids", "words", "counts", "kinds").mapInArrow(
        scan, "block long, at_q long, word string, n long"
    )


def whole_vocabulary(rows: DataFrame, states: int) -> DataFrame:
    """Rows of :func:`word_states` with (c, states) of their word in the whole corpus, its class, and
    ``first`` at one row of each word.  A word has one row in a block at most, and words of
    their own class none, so the rows that meet by word are few in each task."""
    whole = W.partitionBy("word")
    q = bits_of_states(states)
    share = F.col("n") / F.greatest(sum(q[1:], q[0]), F.lit(1))
    met = rows.withColumn("share", share).select(
        "block",
        F.col("at_q").bitwiseAND(F.lit((1 << PLACE) - 1)).alias("at"),
        "word",
        F.sum("n").over(whole).alias("c"),
        *(F.sum(q[s] * F.col("share")).over(whole).alias(f"s{s}") for s in range(states)),
        (F.min("block").over(whole) == F.col("block")).alias("first"),
    )
    most = F.greatest(*(F.col(f"s{s}") for s in range(states)), F.lit(1e-30))
    packed = [F.shiftleft(F.rint(15 * F.col(f"s{s}") / most).cast("long"), PLACE + 4 * s) for s in range(states)]
    joined = F.col("at")
    for part in packed:
        joined = joined.bitwiseOR(part)
    return store(
        met.select("block", "c", joined.alias("at_q"), ending_class("word").alias("cls"), "first"),
        "words",
    )


def word_figures(words: DataFrame, model: Model, tokens: np.ndarray) -> Words:
    """The sums over the vocabulary that make the words of each class and state sum to one."""
    k = len(model.start)
    q = bits_of_states(k)
    drawn = (F.col("c") + 1) / (F.col("c") + WORD_PRIOR)
    own = drawn * F.col("c") / F.greatest(sum(q[1:], q[0]), F.lit(1))
    rows = (
        words.filter("first AND c > 0")
        .withColumn("own", own)
        .groupBy("cls")
        .agg(
            F.count("*").alias("v"),
            F.sum(drawn * WORD_PRIOR).alias("t"),
            *(F.sum(q[s] * F.col("own")).alias(f"s{s}") for s in range(k)),
        )
        .collect()  # at most END_CLASSES rows
    )
    prior = model.emit * model.use
    prior = prior / prior.sum(1, keepdims=True)
    whole = prior.copy()  # the part of unknown words
    for r in rows:
        whole[r.cls] += np.array([r[f"s{s}"] for s in range(k)]) + r.t * prior[r.cls]
    shared = np.arange(CLASSES)
    alone = tokens[(shared < OWN_CLASSES) | (shared == CLASSES - 1)]
    return Words(tokens, int(np.count_nonzero(alone)) + sum(r.v for r in rows), prior, whole)


def word_emissions(model: Model, known: Words, kinds, count, q) -> np.ndarray:
    """words x states: the odds of each word in each state, of its class, training tokens in the
    whole corpus and packed states."""
    emit = model.emit[kinds]
    at = np.flatnonzero((kinds >= OWN_CLASSES) & (kinds < CLASSES - 1))
    of, c = kinds[at], count[at, None]
    states = (c * from_nibbles(q[at], len(model.start)) + WORD_PRIOR * known.prior[of]) / (c + WORD_PRIOR)
    states = np.where(c > 0, states, known.prior[of])
    emit[at] *= (c + 1) * states / known.whole[of]
    return emit


def planes(ids: np.ndarray) -> bytes:
    """32-bit numbers with their first bytes in front, then the second ones and so on: most
    numbers are small, so the last planes are zeros and take no room when compressed."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def stretches(sizes: np.ndarray, learns: np.ndarray):
    """(begin, length, whether a text begins there, first and last token that count) of the
    stretches of texts that teach, with their margins, in falling length."""
    starts = np.cumsum(sizes) - sizes
    starts, sizes = starts[learns], sizes[learns]
    n = -(-sizes // STRETCH)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start, stop = np.repeat(starts, n), np.repeat(starts + sizes, n)
    own = start + step * STRETCH
    own_stop = np.minimum(own + STRETCH, stop)
    begin, end = np.maximum(own - MARGIN, start), np.minimum(own_stop + MARGIN, stop)
    order = np.argsort(begin - end, kind="stable")
    return tuple(x[order] for x in (begin, end - begin, begin == start, own - begin, own_stop - begin))


def expect(model: Model, classes: np.ndarray, begin, length, first, low, high, keys=None, n_keys=0):
    """Expected starts, moves and emissions of stretches (in falling length), and the log
    likelihood, by the scaled forward-backward recursion, of the tokens from ``low`` to
    ``high`` and the moves into them.  Emissions are summed by class, or by ``keys``."""
    k, rows = len(model.start), CLASSES if keys is None else n_keys
    starts, moves, emissions, likelihood = np.zeros(k), np.zeros((k, k)), np.zeros((rows, k)), 0.0
    move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)
    for at in range(0, len(begin), TOGETHER):
        b, n, f, lo, hi = (x[at : at + TOGETHER] for x in (begin, length, first, low, high))
        steps = int(n[0])
        active = np.searchsorted(-n, -np.arange(1, steps + 1), side="right")  # longer than t
        place = np.zeros((steps, len(b)), np.int64)
        for t in range(steps):
            place[t, : active[t]] = b[: active[t]] + t
        seen = emit[classes[place]]  # steps x stretches x states
        time = np.arange(steps)[:, None]
        counts = (time >= lo) & (time < hi)
        alpha, scale = np.zeros_like(seen), np.ones((steps, len(b)), np.float32)
        now = np.where(f[:, None], model.start, 1.0 / k).astype(np.float32)
        for t in range(steps):
            m = active[t]
            now = (now[:m] if t == 0 else now[:m] @ move) * seen[t, :m]
            scale[t, :m] = now.sum(1)
            now /= scale[t, :m, None]
            alpha[t, :m] = now
        likelihood += float(np.log(scale[counts]).sum(dtype=np.float64))
        beta = np.ones_like(seen)
        for t in range(steps - 2, -1, -1):
            m = active[t + 1]
            ahead = seen[t + 1, :m] * beta[t + 1, :m] / scale[t + 1, :m, None]
            moves += (alpha[t, :m] * counts[t + 1, :m, None]).T.astype(np.float64) @ ahead
            beta[t, :m] = ahead @ move.T
        gamma = alpha * beta
        starts += gamma[0][f & (lo == 0)].sum(0)
        flat, where = gamma[counts], (classes if keys is None else keys)[place[counts]]
        for s in range(k):
            emissions[:, s] += np.bincount(where, flat[:, s], minlength=rows)
    return starts, moves * model.move, emissions, likelihood


def first_model(tokens: np.ndarray, states: int, seed: int = 3) -> Model:
    """Each state sees the class frequencies through noise of its own; states tend to stay."""
    rng = np.random.default_rng(seed)
    share = (tokens + 0.5) / (tokens + 0.5).sum()
    emit = share[:, None] * np.exp(rng.normal(size=(CLASSES, states)))
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0), np.full(states, 1 / states))


def improve(coded: DataFrame, model: Model, tokens: np.ndarray) -> tuple[Model, float]:
    """One Baum-Welch round over all blocks: the next model and the log likelihood of this."""
    held = coded.sparkSession.sparkContext.broadcast(model)  # states x classes figures
    k = len(model.start)
    columns = [f"s{i}" for i in range(k)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        sums = [np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES, k)), 0.0]
        for batch in batches:
            for i in range(batch.num_rows):
                classes = np.frombuffer(batch.column("classes")[i].as_py(), np.uint16)
                sizes = batch.column("sizes")[i].values.to_numpy()
                learns = ~batch.column("held")[i].values.to_numpy(zero_copy_only=False)
                own = expect(model, classes, *stretches(sizes, learns))
                sums = [a + b for a, b in zip(sums, own)]
        start, move, emit, likelihood = sums
        table = np.vstack((emit, move, start, np.full(k, likelihood)))
        rows = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), *(pa.array(table[rows, s]) for s in range(k))],
            names=["row", *columns],
        )

    rows = (
        coded.select("sizes", "held", "classes")
        .mapInArrow(scan, "row int, " + ", ".join(f"{c} double" for c in columns))
        .groupBy("row")
        .agg(*(F.sum(c).alias(c) for c in columns))
        .toPandas()
    )
    table = np.zeros((CLASSES + k + 2, k))
    table[rows.row] = rows[columns]
    share = (tokens + 0.5) / (tokens + 0.5).sum()
    use = table[:CLASSES].sum(0) + 1
    emit = table[:CLASSES] + 100 * share[:, None]  # Dirichlet priors
    move = table[CLASSES : CLASSES + k] + 1 + 9 * np.eye(k)
    start = table[CLASSES + k] + 1
    return (
        Model(
            start / start.sum(),
            move / move.sum(1, keepdims=True),
            emit / emit.sum(0),
            use / use.sum(),
        ),
        float(table[-1, 0]),
    )


def forward(model: Model, classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 likelihood of each text's classes (or words) by the scaled forward recursion, exact."""
    order = np.argsort(-sizes, kind="stable")
    starts, n = (np.cumsum(sizes) - sizes)[order], sizes[order]
    total = np.zeros(len(n))
    now = np.repeat(model.start[None], len(n), 0)
    active = np.searchsorted(-n, -np.arange(1, int(n[0]) + 1), side="right") if len(n) else []
    for t, m in enumerate(active):
        now = (now[:m] if t == 0 else now[:m] @ model.move) * model.emit[classes[starts[:m] + t]]
        scale = now.sum(1)
        now /= scale[:, None]
        total[:m] += np.log10(scale)
    out = np.zeros(len(n))
    out[order] = total
    return out


def score(coded: DataFrame, words: DataFrame, model: Model, known: Words) -> DataFrame:
    """A row for each text: its figures by the base and by the model."""
    held = coded.sparkSession.sparkContext.broadcast((model, known))  # CLASSES rows
    own = words.groupBy("block").agg(
        F.collect_list(F.struct("c", "at_q")).alias("own")  # a block's words
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = held.value
        n = int(known.tokens.sum())
        for batch in batches:
            for i in range(batch.num_rows):
                kinds = np.frombuffer(batch.column("kinds")[i].as_py(), np.uint16)
                ids = from_planes(batch.column("ids")[i].as_py())
                sizes = batch.column("sizes")[i].values.to_numpy()
                count, q = known.tokens[kinds].astype(np.int64), np.zeros(len(kinds), np.int64)
                count[(kinds >= OWN_CLASSES) & (kinds < CLASSES - 1)] = 0
                if batch.column("own")[i].is_valid:
                    c, at_q = (x.to_numpy() for x in batch.column("own")[i].values.flatten())
                    at = at_q & ((1 << PLACE) - 1)
                    count[at], q[at] = c, at_q >> PLACE
                base = np.log10((count + 1) / (n + known.distinct + 1))
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                of_words = Model(model.start, model.move, word_emissions(model, known, kinds, count, q))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids")[i].values,
                        batch.column("held")[i].values,
                        pa.array(sizes.astype(np.int64)),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64)[ids], starts)),
                        pa.array(np.full(len(sizes), n, np.int64)),
                        pa.array(np.add.reduceat(base[ids], starts)),
                        pa.array(forward(of_words, ids, sizes)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    # a block without a word of a shared class has no list
    joined = coded.select("block", "doc_ids", "held", "sizes", "ids", "kinds").join(own, "block", "left")
    return joined.drop("block").mapInArrow(
        scan,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def train(coded: DataFrame, tokens: np.ndarray, states: int = STATES, rounds: int = ROUNDS):
    """The model after ``rounds`` rounds and the log likelihood before each."""
    model, seen = first_model(tokens, states), []
    for _ in range(rounds):
        model, likelihood = improve(coded, model, tokens)
        seen.append(likelihood)
    return model, seen


def language_scores(
    docs: DataFrame, folds: int = 7, held_fold: int = 2, states: int = STATES, rounds: int = ROUNDS
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row a row.

    Null and empty texts consist of the end alone.  Null ids count as empty text for the
    fold.  Repeated rows count and score as often as they occur.  With nothing to learn
    from, every token is unknown and the model is its first state.  An empty table gives an
    empty table; other columns are not read.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold("doc_id", folds) == held_fold).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    made = blocks(own)
    coded, tokens = with_classes(made, frequent_words(made))
    model, _ = train(coded, tokens, states, rounds)
    words = whole_vocabulary(word_states(coded, model), states)
    return score(coded, words, model, word_figures(words, model, tokens))
