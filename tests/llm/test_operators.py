"""Operators 1 to 10 against brute force, exact round trips or held-out accuracy."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import math
import random
import re
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from compare import DATA, canonical, connect
from pyspark.sql import functions as F

import corpus_pipeline
from spindlework.llm import (
    bitsliced,
    chunks,
    components,
    contamination,
    hmm,
    language,
    packing,
    queries,
    simhash,
    suffixes,
    token_counts,
    toxicity,
)
from spindlework.llm.common import read

SF = str(DATA / "sf0.001")
LONG = " ".join(f"w{i * 40503 % 99991} und{i % 31}" for i in range(60_000))


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ids, columns with names in use."""
    rows = [
        (None, None, None, "a"), (None, "same words here and there", "en", None),
        (None, "same words here and there", "en", None), (1, "", "fr", "b"), (2, "  \n\t", None, "b"),
        (3, LONG, "en", "c"), (4, LONG, "en", "c"), (4, LONG, "en", "c"), (4, "other", "en", "c"),
        (5, "q" * 5000, "xx", "d"), (6, "!!! 123 ???", "en", "d"), (7, "<|endoftext|> É é ﬁ", "fr", "d"),
    ]
    return spark.createDataFrame(
        [(*r, 1.0, "t", 0) for r in rows],
        "doc_id long, text string, lang string, source string, score double, t string, fp int",
    )


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


# 1: substring dedup


def test_gear_cuts_are_the_local_minima_and_resist_shifts():
    text = bytes(random.Random(1).choices(range(97, 123), k=5000))
    h, reach = chunks.gear_hashes(np.frombuffer(text, np.uint8)), chunks.REACH
    want = [0] + [
        i + 1
        for i in range(chunks.ROLL - 1 + reach, len(text) - reach)
        if h[i] < min(h[i - reach : i]) and h[i] < min(h[i + 1 : i + reach + 1])
    ]
    assert chunks.cuts(text) == [*want, len(text)]
    moved = chunks.cuts(b"some bytes before it " * 5 + text)
    assert {c + 105 for c in want[2:]} <= set(moved)


def test_long_texts_are_cut_alike_in_pieces(monkeypatch):
    text = LONG.encode()[:20_000]
    whole = chunks.cuts(text)
    monkeypatch.setattr(chunks, "STEP", 777)
    assert chunks.cuts(text) == whole


def test_repeats_are_found_and_first_occurrences_stay(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(60))
    own = [" ".join(word() for _ in range(80)) for _ in range(30)]
    rows = [(i, f"{t} {passage} {t[::-1]}" if i % 3 == 0 else t) for i, t in enumerate(own)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = chunks.repeats(df).collect()
    assert {r.doc_id for r in found} == set(range(3, 30, 3))
    assert {r.first_doc_id for r in found} == {0}
    kept, given = texts(chunks.drop_repeats(df)), dict(rows)
    for i, t in given.items():
        assert kept[i] == t if i % 3 or not i else len(kept[i]) < len(t) - 150
    for r in found:
        assert same_bytes(given, r)


def same_bytes(given, r):
    first = given[r.first_doc_id].encode()[r.first_start : r.first_start + r.n_bytes]
    return r.n_bytes > 0 and given[r.doc_id].encode()[r.start : r.start + r.n_bytes] == first


def test_every_run_equals_its_origin(spark, docs):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(120)]
    rows = [
        (1, " ".join(words[:70])), (2, " ".join(words[40:])), (3, " ".join(words)),  # 3 goes on where 1 ends
        (4, "-" * 100_000), (5, "ab" * 5000), (6, "ab" * 5000 + "!"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    given, found = dict(rows), chunks.repeats(df).collect()
    assert all(same_bytes(given, r) for r in found)
    assert {r.first_doc_id for r in found if r.doc_id == 3} == {1, 2}
    gone = collections.Counter()
    for r in found:
        gone[r.doc_id] += r.n_bytes
    assert gone[4] > 95_000 and gone[5] > 8000 and gone[6] > 9000  # short periods have cuts too
    given = texts(docs)
    found = chunks.repeats(docs).collect()
    assert found and all(same_bytes(given, r) for r in found)


def test_runs_reach_the_ends_of_their_passages(spark):
    """Of passages of 51 words, other words around them, 95 % of the bytes go, and no others."""
    rng = random.Random(12)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n)]

    passages = [words(51) for _ in range(60)]
    rows = [(i, " ".join(words(40) + passages[i % 60] + words(40))) for i in range(180)]
    rows += [(200, " ".join([*words(30), *passages[0], *words(20), *passages[0]])), (None, " ".join(passages[1]))]
    given = dict(rows)
    found = chunks.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    begins = {(r.doc_id, r.start) for r in found}
    for r in found:
        own, first = given[r.doc_id].encode(), given[r.first_doc_id].encode()
        a, b = r.start + r.n_bytes, r.first_start + r.n_bytes
        assert own[r.start : a] == first[r.first_start : b]
        if (r.doc_id, a) not in begins:  # else another run, of another origin, goes on there
            assert own[a : a + 1] != first[b : b + 1] or a == len(own) or b == len(first)
    sizes = [len(" ".join(p)) for p in passages]
    copies = 2 * sum(sizes) + 2 * sizes[0] + sizes[1]
    gone = sum(r.n_bytes for r in found)
    assert 0.95 * copies <= gone <= copies + 4 * len(found)


def test_alike_and_growth_within_a_text(spark):
    assert chunks.alike(b"abc", b"abd") == 2 and chunks.alike(b"", b"x") == 0 and chunks.alike(b"ab", b"abc") == 2
    text = "0123456789abcdef" * 900
    for r in chunks.repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect():
        assert 0 <= r.first_start < r.start  # an earlier place, so no byte goes with all its equals
        assert text[r.start : r.start + r.n_bytes] == text[r.first_start : r.first_start + r.n_bytes]


def test_extra_columns_keep_their_values(spark, docs):
    names = ["_id", "_t", "_spans", "_hits", "_words", "_row", "_fp", "__id", "FP", "root"]
    few = docs.select("doc_id", "text").limit(60)
    own = few.unionByName(few.limit(5)).withColumns({n: F.concat(F.lit(n), "doc_id") for n in names}).cache()
    bench = read(spark, SF, "benchmark")
    for out in (simhash.one_of_each(own), chunks.drop_repeats(own), contamination.drop_contaminated(own, bench)):
        assert out.columns == own.columns
        assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names)


def test_repeats_of_odd_rows(odd, none):
    out = chunks.drop_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    kept = {(r.doc_id, r.text) for r in out.collect()}
    assert (3, LONG) in kept and (4, "") in kept and (4, "other") in kept and (None, None) in kept
    assert chunks.drop_repeats(none).count() == 0 and chunks.repeats(none).count() == 0


def test_removal_keeps_whole_characters():
    assert chunks.without("aéb".encode(), [(0, 2)]) == "b"


def test_spans_become_values_a_slice_at_a_time(monkeypatch):
    monkeypatch.setattr(chunks, "HELD", 10, raising=False)
    span = lambda i: dict(zip(chunks.SPAN, (i, i + 60, 0, 0, i + 9000)))
    counts = (4, 4, 4, 25, 1, 0)
    ids = pa.RecordBatch.from_arrays([pa.array(range(6))] * 2, names=["doc_id", "t"])
    given = chunks.with_spans(ids, [[span(40 * j) for j in range(n)] for n in counts])
    parts = list(chunks.joined(iter([given])))
    assert [p.num_rows for p in parts] == [2, 1, 1, 2]
    runs = [s for p in parts for s in p.column("spans").to_pylist()]
    assert [[(r["start"], r["stop"]) for r in own] for own in runs] == [[(0, 40 * n + 20)] if n else [] for n in counts]


# 2: exact top-k search


def brute_top(rows, k=5):
    out = []
    vectors = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in rows}
    for q in (i for i in vectors if i % 50 == 0):
        scored = sorted((-int(v @ vectors[q]), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_search_equals_brute_force_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-6, 7, 6) / 50).tolist()) for i in range(700)]
    rows += [(1000 + i, [0.1] * 6) for i in range(40)] + [(2000 + i, [0.5, -0.5]) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = bitsliced.top_k(df, F.col("vec_id") % 50 == 0, block_rows=150, chunk=5).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows)


def test_search_answers_every_row_of_a_repeated_id(spark):
    """300 query rows of one id fill several blocks with the same ids."""
    rng = np.random.default_rng(9)
    rows = [(50, (rng.integers(-20, 21, 4) / 64).tolist()) for _ in range(300)]
    others = [(i, (rng.integers(-20, 21, 4) / 64).tolist()) for i in range(1, 41)]
    df = spark.createDataFrame(rows + others, "vec_id long, embedding array<double>")
    got = bitsliced.top_k(df, F.col("vec_id") % 50 == 0, block_rows=16, chunk=16).collect()
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in others]
    want = []
    for _, v in rows:
        q = np.floor(256 * np.array(v)).astype(int)
        scored = sorted((-int(q @ o), i) for i, o in whole)[:5]
        want += [(50, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_search_leaves_out_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1),
        (5, [1.0, 1.0], 1), (5, [1.0, 1.0], 1), (None, [9.0, 9.0], 1), (50, [1e300, 1.0], 1), (6, [1.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = bitsliced.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [
        (0, 1, 50), (0, 2, 5), (0, 3, 5), (50, 1, 0), (50, 2, 5), (50, 3, 5),
    ]
    assert bitsliced.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("sets, tasks", [(64, 64), (2, 1)])
def test_search_of_large_components_is_exact(spark, monkeypatch, sets, tasks):
    """Components far beyond 2^53 beside small ones; a long holds every score."""
    monkeypatch.setattr(bitsliced, "SET_CHUNKS", sets)
    monkeypatch.setattr(bitsliced, "TASKS", tasks)
    rng = random.Random(4)
    rows = [(50, [1 / 256, 0.0]), (1, [2.0**50, 0.0]), (2, [2.0**49, 3.0]), (3, [-(2.0**52), 1.0])]
    rows += [(i, [rng.choice([0.0, 1 / 256, 2.0**51, 2.0**70 if i % 50 else 0.0]), 0.0]) for i in range(100, 300)]
    rows = [(i, [min(v[0], 2.0**54), v[1]] if i % 50 else [1 / 256, v[1]]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = bitsliced.top_k(df, F.col("vec_id") % 50 == 0, block_rows=40, chunk=1).collect()
    assert {r.score for r in got if r.query_id == 50} == {2**62}
    exact = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = []
    for q in (i for i in exact if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(exact[q], v)), i) for i, v in exact.items() if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    assert sorted(map(tuple, got)) == sorted(want)


def test_blocks_give_their_rows_back():
    rng = np.random.default_rng(3)
    for scaled in (
        rng.integers(-500, 500, (130, 7)).astype(float),
        np.floor(rng.normal(size=(70, 3)) * 2.0**80),
        np.zeros((5, 2)), np.zeros((3, 0)),
    ):
        ids = rng.permutation(len(scaled)).astype(np.int64)
        block = bitsliced.Block.read(*bitsliced.Block.parts(ids, scaled))
        want = [[int(x) for x in v] for v in scaled[np.argsort(ids)]]
        assert block.values().tolist() == want and block.ids.tolist() == sorted(ids)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = connect(DATA / "sf0.001").execute(queries.ORACLE[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns) and canonical(got) == canonical(want)


# 3: token counts


def test_token_counts_equal_the_library(odd, docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    own = odd.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    got = token_counts.token_counts(own, part_chars=300)
    want = [
        (r.doc_id, len((r.text or "").encode()), n := len(model.encode(r.text or "")), n > 4096)
        for r in own.collect()
    ]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_cuts_are_safe():
    model, safe = token_counts.load(public_tokenizers.path("piece_bpe_32k.model"))
    assert safe
    rng, bits = random.Random(5), [" ", "  ", "a", "b", "<s>", "▁", "\n", "é", "the", ".", "\t", "　", "x "]
    for _ in range(2000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 40)))
        assert token_counts.count_batch([text], model, True, 3) == [len(model.encode(text))]


# 4: near-duplicates by SimHash


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(len(words) - 3, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(values, limit=4):
    """The first place reached from each place over values that differ in few bits."""
    at, fp = list(range(len(values))), np.array(values, np.uint64)

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    for i in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1 :] ^ fp[i]) <= limit) + i + 1:
            a, b = root(i), root(int(j))
            at[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fp))]


def test_near_duplicates_equal_brute_force(docs):
    rows = sorted(simhash.near_duplicates(docs).collect())
    given = sorted((r.doc_id, r.text) for r in docs.collect())
    prints = [brute_fingerprint(t) for _, t in given]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in rows] == [given[i][0] for i in brute_groups(prints)]


@pytest.mark.parametrize("split", [4096, 7])
def test_links_of_dense_fingerprints(spark, split):
    """Many within few bits of each other, also with keys dealt into blocks."""
    rng = random.Random(8)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(60):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.root for r in simhash.near_fingerprints(df, 4, split).collect()}
    roots = [got.get(v, v) for v in values]
    want = brute_groups([v % (1 << 64) for v in values])
    assert roots == [values[i] for i in want]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {
        **{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}
    }


def test_near_duplicates_of_odd_rows(odd, none):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd).collect()}
    assert (None, "0" * 16, 1) in got and (1, "0" * 16, 1) in got and (2, "0" * 16, 1) in got
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    rows = sorted((str(r.doc_id), (r.text or "")[:9]) for r in kept.collect())
    assert rows == sorted(
        [("None", "same word"), ("1", ""), ("3", LONG[:9]), ("4", "other"), ("5", "q" * 9), ("6", "!!! 123 ?"), ("7", "<|endofte")]
    )
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0


# 5: toxicity


def brute_segments(scores):
    """Maximal scoring segments by their recursive definition."""
    best = max(
        ((sum(scores[a:b]), a - b, -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
        default=(0,),
    )
    if best[0] <= 0:
        return []
    a, b = best[3:]
    left, right = brute_segments(scores[:a]), brute_segments(scores[b:])
    return left + [(a, b, best[0])] + [(x + b, y + b, s) for x, y, s in right]


def test_segments_equal_their_definition():
    rng = random.Random(6)
    for _ in range(200):
        scores = [rng.choice([-7, -3, -2, -1, 1, 2, 5]) for _ in range(rng.randint(0, 18))]
        assert sum(s for *_, s in toxicity.segments(np.array(scores, float))) == sum(
            s for *_, s in brute_segments(scores)
        )


def test_toxicity_learns_the_words(spark):
    docs, labels = read(spark, str(DATA / "sf0.1"), "documents"), read(spark, str(DATA / "sf0.1"), "labels")
    got = toxicity.toxicity(docs, labels)
    rows = got.join(labels, "doc_id").filter("held_out").select("toxic", "predicted", "score").collect()
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    caught = [r.predicted for r in rows if r.toxic == 1]
    assert sum(caught) >= 0.6 * len(caught)  # the others hold no toxic word
    assert all(0 <= r.score <= 1 for r in rows)


def test_copies_in_the_sample_are_alike(spark):
    """Near copies count once; texts that share a phrase, or a class apart, stay."""
    rng = random.Random(8)
    phrase = [f"common{i}" for i in range(12)]
    rows, sample = [], []
    for i in range(60):
        own = [f"d{i}w{rng.randrange(10**6)}" for _ in range(108)]
        rows.append((i, " ".join(own[:50] + phrase + own[50:])))
        copy = own[:50] + phrase + own[50:]
        copy[rng.randrange(5)] = "other"
        rows.append((100 + i, " ".join(copy)))
        sample += [(i, i % 2, 0), (100 + i, i % 2, 0)]
    rows += [(500, rows[0][1]), (600, ""), (601, None)]
    sample += [(500, 1, 1), (600, 0, 0), (601, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chosen = spark.createDataFrame(sample, "doc_id long, toxic int, half long")
    kept = {r.doc_id for r in toxicity.one_of_copies(docs, chosen).collect()}
    assert kept >= set(range(60)) | {500, 600} and 601 not in kept
    assert len(kept & set(range(100, 160))) <= 2


def test_sample_takes_ids_that_have_a_document(spark):
    docs = spark.createDataFrame([(i, "x") for i in range(0, 40, 2)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 4 // 2) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(docs, labels, 15).collect()
    assert len(got) == 20 and {r.doc_id for r in got} == set(range(0, 40, 2))


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (None, 1), (3, None), (4, 1), (4, 0), (5, 7)], "doc_id long, toxic int"
    )
    assert toxicity.toxicity(odd, labels).count() == odd.count()
    rows = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert {r.predicted for r in rows} == {0}
    assert toxicity.toxicity(none, labels).count() == 0


# 6: decontamination


def test_contamination_of_odd_rows(spark, odd, none):
    ten = "one two three four five six seven eight nine ten"
    items = [(1, f"Zero, {ten}. eleven"), (2, "short item"), (None, "SHORT item"), (3, None), (4, "?!"), (1, ten)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    own = [(1, f"x {ten.upper()} y"), (2, "a Short--item b short item"), (3, ten[:-4]), (None, None), (5, f"É {ten.replace(' ', '  ')}")]
    df = spark.createDataFrame([(*r, 0) for r in own], "doc_id long, text string, n_hit int")
    got = {r.doc_id: r for r in contamination.contamination(df, bench).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_words, got[1].n_hit, got[1].n_items, got[1].items_sha256) == (12, 10, 1, sha("1"))
    assert (got[2].n_hit, got[2].n_items, got[2].items_sha256) == (4, 2, sha(",2"))
    assert not got[3].contaminated and got[None].n_words == 0 and got[5].n_hit == 10
    hit = got[5].hits[0]
    assert own[4][1].encode()[hit.start : hit.stop].decode() == ten.replace(" ", "  ")
    assert {r.doc_id for r in contamination.drop_contaminated(df, bench).collect()} == {3, None}
    assert contamination.contamination(odd, bench.limit(0)).filter("contaminated").count() == 0
    assert contamination.contamination(none, bench).count() == 0


def test_benchmark_in_shards(spark, docs, monkeypatch):
    bench = read(spark, SF, "benchmark")
    whole = sorted(contamination.contamination(docs, bench).drop("hits").collect())
    monkeypatch.setattr(contamination, "SHARD_BYTES", 900)
    shards = contamination.shards
    monkeypatch.setattr(contamination, "shards", lambda b: shards(b, 900))
    assert sorted(contamination.contamination(docs, bench).drop("hits").collect()) == whole


# 7: hidden Markov language model


def test_expected_counts_and_likelihood_equal_enumeration(monkeypatch):
    for name, value in (("CLASSES", 5), ("TOGETHER", 4), ("STRETCH", 6), ("MARGIN", 2)):
        monkeypatch.setattr(hmm, name, value)
    rng, k = np.random.default_rng(0), 3
    model = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(5), k).T)
    sizes = np.array([3, 9, 1, 14, 6])
    classes = rng.integers(0, 5, sizes.sum()).astype(np.uint16)
    parts = hmm.stretches(sizes, np.array([1, 1, 0, 1, 1], bool))
    got = hmm.expect(model, classes, *parts)
    start, move, emit, total = np.zeros(k), np.zeros((k, k)), np.zeros((5, k)), 0.0
    inside = collections.Counter()

    def odds(x, first):  # of every path of states through the tokens x
        for z in itertools.product(range(k), repeat=len(x)):
            p = (model.start[z[0]] if first else 1 / k) * model.emit[x[0], z[0]]
            for i in range(1, len(x)):
                p *= model.move[z[i - 1], z[i]] * model.emit[x[i], z[i]]
            yield z, p

    for begin, n, first, low, high in zip(*parts):
        x = classes[begin : begin + n]
        paths = list(odds(x, first))
        whole = sum(p for _, p in paths)
        before = sum(p for _, p in odds(x[:low], first)) if low else 1.0
        total += math.log(sum(p for _, p in odds(x[:high], first)) / before)
        inside.update(range(begin + low, begin + high))
        for z, p in paths:
            start[z[0]] += first * p / whole
            for i in range(low, high):
                emit[x[i], z[i]] += p / whole
                if i:
                    move[z[i - 1], z[i]] += p / whole
    for a, b in zip(got, (start, move, emit, total)):
        assert np.allclose(a, b, rtol=1e-4)
    # every token of a text that teaches counts once, and every move between two of them
    assert inside == collections.Counter([*range(12), *range(13, 33)])
    assert math.isclose(move.sum(), 2 + 8 + 13 + 5)
    keys = rng.integers(0, 9, sizes.sum())
    by_key = hmm.expect(model, classes, *parts, keys=keys, n_keys=9)[2]
    assert by_key.shape == (9, k) and np.allclose(by_key.sum(0), emit.sum(0), rtol=1e-4)
    for n, start_at, got_one in zip(sizes, np.cumsum(sizes) - sizes, hmm.forward(model, classes, sizes)):
        alpha = model.start * model.emit[classes[start_at]]
        for c in classes[start_at + 1 : start_at + n]:
            alpha = (alpha @ model.move) * model.emit[c]
        assert math.isclose(math.log10(alpha.sum()), got_one)


def test_base_score_and_held_out_gain(docs):
    rows = hmm.language_scores(docs).collect()
    tokens = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in docs.collect()}
    c = collections.Counter()
    for d, words in tokens.items():
        if crc32(str(d).encode()) % 7 != 2:
            c.update(words)
    n, v = sum(c.values()), len(c)
    for r in rows:
        own = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_emissions_of_the_whole_vocabulary_are_a_distribution(spark, docs):
    odd_words = [(10**6, "a !! \u00e9\u00e9?! x\u2028 y!\u2028 -- \U0001f600\U0001f601\U0001f602 ab. ab", False)]
    own = docs.select("doc_id", "text", (hmm.fold("doc_id", 7) == 2).alias("held_out"))
    own = own.union(spark.createDataFrame(odd_words, own.schema))

    def words_of(row):
        return bytes(row.words).decode().split(" ")

    made = hmm.blocks(own.repartition(5, "doc_id"))  # some blocks
    frequent = hmm.frequent_words(made)
    coded, tokens = hmm.with_classes(made, frequent)
    model, seen = hmm.train(coded, tokens, states=3, rounds=3)
    assert seen == sorted(seen)
    rows = hmm.word_states(coded, model)
    words = hmm.whole_vocabulary(rows, 3)
    known = hmm.word_figures(words, model, tokens)
    count = collections.Counter()
    for r in own.collect():
        if not r.held_out:
            count.update((r.text or "").encode().lower().split() + [b""])
    assert tokens.sum() == sum(count.values()) and known.distinct == len(count)
    top = sorted((-n, w) for w, n in count.items() if w)[: hmm.OWN_CLASSES]
    assert sum(count[w.encode()] for w in frequent) == -sum(n for n, _ in top)

    # the table has each word's count; its class is the same in tasks and in SQL
    place = (1 << hmm.PLACE) - 1
    at = {(r.block, r.at_q & place): r for r in words.collect()}
    assert sum(r.first for r in at.values()) == len({w for r in coded.collect() for w in words_of(r)} - {"", *frequent})
    q, kind, parts = {}, {}, collections.defaultdict(lambda: np.zeros(3))
    for r in coded.collect():
        kinds = np.frombuffer(r.kinds, np.uint16)
        for i, (word, cls) in enumerate(zip(words_of(r), kinds)):
            got = at.pop((r.block, i), None)
            kind[word] = cls
            assert (got is None) == (word == "" or word in frequent)
            if got:
                assert (got.c, got.cls) == (count[word.encode()], cls)
                assert q.setdefault(word, got.at_q >> hmm.PLACE) == got.at_q >> hmm.PLACE
    assert not at
    # expected states of a word, summed over its blocks, up to the rounding to 4 bits
    for r in rows.collect():
        parts[r.word] += r.n * hmm.from_nibbles(np.array([r.at_q >> hmm.PLACE]), 3)[0]
    for word, share in parts.items():
        if count[word.encode()]:
            assert np.abs(hmm.from_nibbles(np.array([q[word]]), 3)[0] - share / share.sum()).max() < 0.06

    # all known words and one unknown word of each shared class sum to one in every state
    vocabulary = sorted(w for w in kind if count[w.encode()])
    kinds = np.array([kind[w] for w in vocabulary] + list(range(hmm.OWN_CLASSES, hmm.CLASSES - 1)))
    counts = np.array([count[w.encode()] for w in vocabulary] + [0] * hmm.END_CLASSES)
    packed = np.array([q.get(w, 0) for w in vocabulary] + [0] * hmm.END_CLASSES)
    emit = hmm.word_emissions(model, known, kinds, counts, packed)
    assert np.allclose(emit.sum(0), 1, rtol=1e-9) and (emit > 0).all()
    scored = hmm.score(coded, words, model, known).collect()
    assert len(scored) == own.count() and all(math.isfinite(r.score) for r in scored)


def test_states_of_a_word_are_written_in_four_bits():
    rng = np.random.default_rng(0)
    shares = rng.dirichlet(np.ones(8), 200) * rng.integers(1, 1000, 200)[:, None]
    back = hmm.from_nibbles(hmm.nibbles(shares), 8)
    assert np.abs(back - shares / shares.sum(1, keepdims=True)).max() < 0.04
    assert hmm.from_nibbles(hmm.nibbles(np.zeros((1, 8))), 8).sum() == 0


def test_language_scores_of_odd_rows(odd, none):
    rows = hmm.language_scores(odd).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) for r in rows)
    assert min(r.n_tokens for r in rows) == 1
    assert hmm.language_scores(none).count() == 0
    alone = hmm.language_scores(odd.filter("doc_id IS NULL").limit(1)).collect()
    assert len(alone) == 1 and math.isfinite(alone[0].base_score)


# 8: packing


def test_ids_equal_the_library(odd, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    model = packing.tokenizer(path)[0]
    want = lambda t: np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    own = [r.text or "" for r in odd.union(odd.limit(0)).collect()] + [r.text for r in docs.limit(40).collect()]
    assert packing.encode([t.encode() for t in own], path) == [want(t) for t in own]
    rng = random.Random(5)
    bits = [" ", "a", "B", "<|endoftext|>", "<|ENDOFTEXT|>", "\n", "é", "É", "́", "the.", "The,", "don't",
            "　", "1", "...", ".,", "\x1f", "Σ", "İ", "ﬁ", "Å", ".\n", "\r", "\x85", "中文", "a."]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 12)))
        assert packing.encode([text.encode()], path)[0] == want(text), repr(text)


def test_packing_round_trip(odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(packing.pieces(odd, path, 500, keep_ids=True), 500, group=200).collect()
    fill = collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length and crc32(r.ids) == r.ids_crc32 and r.start == 500 * r.piece
        fill[r.sequence_id].append((r.offset, r.length))
    for own in fill.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 500
    ids = collections.Counter()
    for r in odd.collect():
        ids[(r.doc_id, packing.encode([(r.text or "").encode()], path)[0] + b"\1\0\0\0")] += 1
    made = collections.Counter()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for d, own in by.items():
        whole = sum((len(x.ids) for x in own))
        made[d] = whole
    want = collections.Counter()
    for (d, raw), n in ids.items():
        want[d] += len(raw) * n
    assert made == want
    assert packing.packed(odd.limit(0)).count() == 0


def brute_best_fit(lengths, tokens, documents, cost):
    """Every sequence stays open; the norm of all three weighted residuals decides."""
    caps = [tokens, documents or tokens, cost or tokens**2]
    asked = [sum(lengths) / caps[0], len(lengths) / caps[1], sum(x * x for x in lengths) / caps[2]]
    weights = [a / max(asked) / c for a, c in zip(asked, caps)]
    left, out = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = (lengths[i], 1, lengths[i] ** 2)
        rests = [[a - b for a, b in zip(own, need)] for own in left]
        able = [j for j, rest in enumerate(rests) if min(rest) >= 0]
        if not able:
            left.append(list(caps))
            able, rests = [len(left) - 1], {len(left) - 1: [a - b for a, b in zip(caps, need)]}
        norms = {j: sum((w * r) ** 2 for w, r in zip(weights, rests[j])) for j in able}
        least = min(norms.values())
        near = [j for j in able if norms[j] <= least * (1 + 1e-12)]
        out[i] = near[0]
        left[near[0]] = rests[near[0]]
    return out


def fills(bins, lengths):
    """Tokens, documents and cost of every sequence."""
    own = collections.defaultdict(list)
    for b, x in zip(bins, lengths.tolist()):
        own[int(b)].append(x)
    return sorted((sum(x), len(x), sum(y * y for y in x)) for x in own.values())


def test_best_fit_under_every_capacity():
    lengths = np.random.default_rng(1).integers(1, 200, 3000)
    for documents, cost in ((None, None), (3, None), (None, 20_000), (4, 30_000)):
        bins, offsets = packing.best_fit(lengths, 200, documents, 40_000 if cost is None else cost) \
            if lengths.max() ** 2 <= (cost or 40_000) else (None, None)
        if bins is None:
            with pytest.raises(ValueError):
                packing.best_fit(lengths, 200, documents, cost)
            continue
        assert np.bincount(bins, lengths).max() <= 200
        if documents:
            assert np.bincount(bins).max() <= documents
    small = np.minimum(lengths, 120)
    bins, _ = packing.best_fit(small, 200, 4, 20_000)
    assert np.bincount(bins, small.astype(float) ** 2).max() <= 20_000 and np.bincount(bins).max() <= 4
    for size, want in ((small, (4, 20_000)), (lengths, (None, None))):
        # sequences with the same residuals may stand for each other
        assert fills(packing.best_fit(size, 200, *want)[0], size) == fills(
            brute_best_fit(size.tolist(), 200, *want), size
        )
    bins, _ = packing.best_fit(lengths, 200)
    assert bins.max() + 1 <= 1.01 * math.ceil(lengths.sum() / 200) + 1


# 9: suffix-array dedup


def brute_removed(given, length=200):
    seen = collections.Counter(t[i : i + length] for t in given for i in range(len(t) - length + 1))
    for t in given:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        yield len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


def made_texts(spark):
    rng = random.Random(4)
    shared = ["".join(rng.choices("abé \n", k=rng.randint(150, 420))) for _ in range(12)]
    rows = []
    for i in range(120):
        text = ""
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(shared)
            own = "".join(rng.choices("xyz\0", k=rng.randint(0, 150)))
            text += p[rng.randrange(80) : len(p) - rng.randrange(80)] if rng.random() < 0.7 else own
        rows.append((rng.choice([None, i, i, 7]), text if rng.random() < 0.95 else None))
    rows += [(1, "a" * 1000), (2, "ab" * 300), (3, "q" * 199), (4, "q" * 200), (5, "z" * 201)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("hot", [suffixes.HOT, 3])
def test_repeated_bytes_equal_brute_force(spark, hot):
    df = made_texts(spark)
    rows = df.collect()
    want = sorted(
        (str(r.doc_id), *b) for r, b in zip(rows, brute_removed([(r.text or "").encode() for r in rows]))
    )
    got = suffixes.repeated_bytes(df, hot).drop("spans").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want


def test_repeated_bytes_of_odd_rows(odd, none, monkeypatch):
    got = suffixes.repeated_bytes(odd).collect()
    assert len(got) == odd.count()
    assert {r.n_removed for r in got if r.n_bytes == len(LONG)} == {len(LONG)}
    assert suffixes.repeated_bytes(none).count() == 0
    places = suffixes.anchors(LONG.encode()[:30_000])[0].tolist()
    monkeypatch.setattr(suffixes, "STEP", 1000)
    assert suffixes.anchors(LONG.encode()[:30_000])[0].tolist() == places


def test_multikey_order_is_byte_order():
    rng = np.random.default_rng(7)
    rows = rng.integers(0, 3, (500, 40)).astype(np.uint8)
    order = suffixes.multikey_order(rows)
    assert [bytes(r) for r in rows[order]] == sorted(bytes(r) for r in rows)


# 10: language identification


def test_languages_held_out(spark):
    docs = read(spark, str(DATA / "sf0.01"), "documents")
    got = language.language_ids(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    rows = got.collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_rows(odd, none):
    rows = language.language_ids(odd).collect()
    assert len(rows) == odd.count()
    for r, given in zip(sorted(rows, key=str), rows):
        assert r.lang_pred
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {1, 2, 6} <= und and 3 not in und
    assert language.language_ids(none).count() == 0
    with pytest.raises(ValueError):
        language.train(odd, dims=8, max_languages=1)


# the pipeline


def test_pipeline(spark, docs):
    now, n = docs, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns, name
        assert 0.5 * n < now.count() <= n
        now = now.cache()
    kept = {r.doc_id for r in now.select("doc_id").collect()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == kept
    clean = simhash.near_duplicates(docs)
    low = {r.component_id for r in clean.collect()}
    letters = {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}
    bench = read(spark, SF, "benchmark")
    dirty = {r.doc_id for r in contamination.contamination(docs, bench).filter("contaminated").collect()}
    assert kept >= (low & letters) - dirty


def test_texts_like_no_language_go_and_short_ones_stay(spark, docs):
    rng = random.Random(4)
    noise = lambda k: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(k))
    coded = lambda k: base64.b64encode(rng.randbytes(k)).decode()
    odd_ones = [noise(k) for k in (30, 60, 300) for _ in range(10)] + [coded(k) for k in (200, 2000) for _ in range(10)]
    clean = [" ".join(r.text.split()[:k]) for r in docs.limit(40).collect() for k in (3, 8, 40) if re.search(r"[a-z]", " ".join(r.text.split()[:k]))]
    extra = [(10_000 + i * 3, t, None) for i, t in enumerate(odd_ones)] + [(20_000 + i * 3, t, None) for i, t in enumerate(clean)]
    given = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, given, SF).collect()}
    assert not any(10_000 <= i < 20_000 for i in kept)
    assert kept >= {i for i, *_ in extra if i >= 20_000}
    assert kept >= {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}


def test_floors_read_whole_texts(spark):
    """Texts that begin alike and go on otherwise give another floor; every stretch counts."""
    rng = random.Random(5)
    word = lambda letters: "".join(rng.choices(letters, k=6))
    openings = [" ".join(word("abcdefgh") for _ in range(40)) for _ in range(20)]
    ends = [" ".join(word("stuvwxyz") for _ in range(20)) for _ in openings]
    kinds = "text string, lang string"
    near = spark.createDataFrame([(a, "x") for a in openings], kinds)
    far = spark.createDataFrame([(f"{a} {b}", "x") for a, b in zip(openings, ends)], kinds)
    names, prototypes = language.train(near)
    assert language.floors(far, names, prototypes)[0] < 0.9 * language.floors(near, names, prototypes)[0]
    for n in (0, 127, 128, 129, 255, 256, 1000):
        rows = language.stretches(np.arange(n))
        assert set(rows.ravel()) == (set(range(n)) if n >= 128 else set()) and rows.shape[1] == 128


def test_pipeline_of_odd_and_no_rows(spark, odd, none):
    for given in (odd, none):
        now = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF).cache()
            assert now.columns == given.columns
        corpus_pipeline.STAGES[-1][1](spark, now, SF).count()
