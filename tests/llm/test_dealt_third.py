"""Operators 11 to 13 against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from compare import DATA
from pyspark.sql import functions as F

from spindlework.llm import common, disclosure, lexical, shallot
from spindlework.llm.common import read
from spindlework.llm.queries import QUERIES as LLM_QUERIES

SF = str(DATA / "sf0.001")
ODD = [
    (None, None), (None, "same words here"), (1, ""), (2, " \n\t"), (3, "w1 " * 60_000 + "rare"), (4, "same words here"),
    (4, "same words here"), (5, "q" * 200_000), (6, "!!! ???"), (7, "É é ﬁ ĳ 9"), (-8, "same"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, "x", 1, 2.0, "r") for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, n string, score int, rank double, row string")


# 11: centroid clustering


def brute_clusters(rows, k, rounds, dims):
    """Lloyd's rounds over Python whole numbers."""
    own = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            own.append((i, [math.floor(256 * x) for x in v]))
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    c = [v for _, v in sorted(own, key=lambda r: (digest(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in enumerate(c))
    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in own:
            members[near(v)[1]].append(v)
        c = [[sum(x) // len(x) for x in zip(*members[j])] if j in members else c[j] for j in range(len(c))]
    last = [(i, *near(v)) for i, v in own]
    total = collections.Counter()
    for _, d, j in last:
        total[j] += d
    sha = [hashlib.sha256(",".join(map(str, w)).encode()).hexdigest() for w in c]
    return sorted(((i, j, d, total[j], sum(total.values()), sha[j]) for i, d, j in last), key=repr)


@pytest.mark.parametrize("scale, k, rounds", [(0.01, 9, 5), (3.0, 7, 4), (2.0**19, 5, 3), (1.0, 1, 2), (0.5, 200, 2), (1.0, 6, 0)])
def test_clusters_equal_brute_force(spark, scale, k, rounds):
    rng = random.Random(int(k))
    spots = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(6)]
    rows = [(i % 90, [scale * (x + rng.gauss(0, 0.3)) for x in rng.choice(spots)]) for i in range(100)]
    rows += [(7, [0.0] * 4)] * 20 + [(None, [1e-20, -1e-20, 0.0, -0.0])]  # copies, ties, no id
    rows += [(500, None), (501, [1.0]), (502, [None, 0.0, 0.0, 0.0]), (503, [float("nan")] * 4), (504, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cluster string").repartition(3)
    got = shallot.cluster(df, k, rounds, 4)[0].collect()
    assert sorted(map(tuple, got), key=repr) == brute_clusters(rows, k, rounds, 4)


def test_no_vectors_make_no_clusters(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    out, centroids = shallot.cluster(none)
    assert out.count() == 0 and centroids == [] and len(out.columns) == 6


def test_bounds_spare_most_distances():
    """Far fewer distances than all pairs once the centroids settle, and the same nearest ones."""
    draw = np.random.default_rng(3)
    spots = draw.integers(-4000, 4000, (40, 64))
    x = spots[draw.integers(0, 40, 4000)] + draw.integers(-300, 300, (4000, 64))
    c = shallot.Centroids(spots.tolist())
    near, second, upper, lower, distance, first = shallot.assign(x, None, np.zeros(40), c, False)
    moved = spots + draw.integers(-20, 20, spots.shape)
    later = shallot.Centroids(moved.tolist())
    steps = np.sqrt(((moved - spots) ** 2).sum(1).astype(float))
    again = shallot.assign(x, (near, second, upper, lower), steps, later, False)
    brute = ((x[:, None, :] - moved[None]) ** 2).sum(2)
    assert (again[0] == brute.argmin(1)).all()
    assert again[5] < 4000 * 2 < first


def test_earlier_states_are_removed(spark, tmp_path):
    kept = common.store(spark.range(3), "kept")
    gone = common.store(spark.range(3), "gone")
    elsewhere = tmp_path / "own"
    spark.range(3).write.parquet(str(elsewhere))
    common.release(gone)
    common.release(spark.read.parquet(str(elsewhere)))
    assert kept.count() == 3 and spark.read.parquet(str(elsewhere)).count() == 3
    with pytest.raises(Exception):
        gone.count()


# 12: personal data

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def brute_base(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text):
            digits = [int(d) for d in re.findall("[0-9]", m.group())]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card":
                twice = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(twice) % 10:
                    continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_matches_equal_their_patterns():
    rng = random.Random(9)
    parts = ["a", "b@", "@", ".c", "-", "%", "+1", "+", " ", "(", ")", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4",
             "255.", "256.", "007.", "12", "3", "\n", "é", "x@y.z", "5", "0"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        got = [(disclosure.KINDS[k], a, b) for k, a, b, _ in disclosure.base_matches(text)]
        assert got == brute_base(text), text


def test_base_is_linear_in_odd_texts():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000, "a@" * 150_000, "a" * 300_000 + "@", "+1" * 150_000, "a@" + "b" * 300_000):
        disclosure.base_matches(text)


def brute_personal(rows, alpha, support):
    """Every row of the query from sets of documents and contexts."""
    texts = [t or "" for _, t in rows]
    term = re.compile(r"[^\W\d_]{2,}")
    found = [disclosure.base_matches(t) for t in texts]
    terms, stems = collections.Counter(), collections.Counter()
    for t in texts:
        own = {w.lower() for w in term.findall(t)}
        terms.update(own)
        stems.update({w[:3] for w in own})
    entities, pairs, begins, seen, places = (collections.defaultdict(set) for _ in range(5))
    for i, (t, base) in enumerate(zip(texts, found)):
        for kind, a, b, form in base:
            c = (kind, form)
            entities[c].add(i)
            around = (t[max(0, a - 120) : a], t[b : b + 120])
            for m in term.finditer(t):
                inside = (max(0, a - 120) <= m.start() and m.end() <= a) or (b <= m.start() and m.end() <= b + 120)
                if inside and not any(x < m.end() and m.start() < y for _, x, y, _ in base):
                    w = m.group().lower()
                    pairs[c, w].add(i)
                    begins[c, w[:3]].add(i)
                    seen[c, w].add(around)
                    places[i].add((c, w, m.span()))
    n, out = len(rows), []
    for i, (doc, _) in enumerate(rows):
        extra = {}
        for c, w, span in places[i]:
            content = math.log(n / len(entities[c]))
            share = lambda both, own: math.log(n * both / (len(entities[c]) * own))  # noqa: B023, E731
            if content > 0 and len(seen[c, w]) >= support and share(len(pairs[c, w]), terms[w]) >= alpha * content:
                safe = share(len(begins[c, w[:3]]), stems[w[:3]]) < alpha * content
                extra[span] = max(extra.get(span, 0), 4 if safe else 5)
        base = [(k, a, b) for k, a, b, _ in found[i]]
        line = lambda spans: ",".join(f"{disclosure.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))
        counts = [sum(k == j for k, *_ in base) for j in range(4)]
        digest = hashlib.sha256(line(base).encode()).hexdigest()
        out.append((doc, *counts, digest, line(base + [(k, *s) for s, k in extra.items()])))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 7)))
    rows = []
    for i in range(300):
        words = [word() for _ in range(rng.randint(5, 60))]
        if i % 20 == 0:  # a name that occurs with the address alone, one with a common beginning
            words[3:3] = ["Zzyzx", "quimby", "ann.q@mail.example.com", "the"]
        elif i % 20 == 1:
            words[2:2] = ["+1 (974) 555-3436", "quimbaya", "the", "10.0.0.1"]
        elif i % 4 == 0:
            words[1:1] = ["quimbly", "the"]
        rows.append((i, " ".join(words)))
    rows += [(rows[0][0], rows[0][1])] * 40 + ODD
    return rows


def test_personal_data_equals_brute_force(spark, people, monkeypatch):
    df = spark.createDataFrame([(*r, "x", "y") for r in people], "doc_id long, text string, spans string, kind string").repartition(4)
    want = brute_personal(people, 0.75, 3)
    assert any("generalised" in r[-1] for r in want) and any("removed" in r[-1] for r in want)
    assert sorted(map(tuple, disclosure.personal_data(df).collect()), key=repr) == want
    monkeypatch.setattr(disclosure, "HELD", 0)  # counts by a join instead of a look-up
    monkeypatch.setattr(disclosure, "FLUSH", 10)
    assert sorted(map(tuple, disclosure.personal_data(df).collect()), key=repr) == want


def test_sanitised_texts(spark, people):
    df = spark.createDataFrame(people, "doc_id long, text string")
    made = [(r.doc_id, r.text) for r in disclosure.sanitise(df).collect()]
    out = dict(made)
    assert "zzyzx" not in out[20].lower() and "[email]" in out[20] and " the " in out[20]
    assert out[24].count("quimbly") == 1 and {(2, " \n\t"), (None, None), (1, "")} <= set(made)
    none = df.limit(0)
    assert disclosure.personal_data(none).count() == 0 and disclosure.sanitise(none).count() == 0


def test_personal_data_of_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    got = disclosure.personal_data(read(spark, SF, "documents")).collect()
    assert sorted(map(tuple, got), key=repr) == brute_personal(rows, 0.75, 3)


def brute_whole(rows, alpha, support):
    """Extra spans of each row, from sets of documents and texts, for terms anywhere in a text."""
    texts = [t or "" for _, t in rows]
    found = [disclosure.base_matches(t) for t in texts]
    words = [{m.group().lower() for m in disclosure.TERM.finditer(t)} for t in texts]
    spots = [
        [(m.span(), m.group().lower()) for m in disclosure.TERM.finditer(t)
         if not any(x < m.end() and m.start() < y for _, x, y, _ in base)]
        for t, base in zip(texts, found)
    ]
    holds = collections.defaultdict(set)
    for i, base in enumerate(found):
        for kind, _, _, form in base:
            holds[kind, form].add(i)
    out = [{} for _ in rows]
    n = len(rows)
    for own in holds.values():
        content = math.log(n / len(own))
        share = lambda both, all_of: math.log(n * both / (len(own) * all_of))  # noqa: B023, E731
        for word in {w for i in own for _, w in spots[i]}:
            both = {i for i in own if any(w == word for _, w in spots[i])}
            if content <= 0 or len({texts[i] for i in both}) < support:
                continue
            if share(len(both), sum(word in x for x in words)) < alpha * content:
                continue
            begun = sum(any(w[:3] == word[:3] for _, w in spots[i]) for i in own)
            kind = 4 if share(begun, sum(any(w[:3] == word[:3] for w in x) for x in words)) < alpha * content else 5
            for i in both:
                for span, w in spots[i]:
                    if w == word:
                        out[i][span] = max(out[i].get(span, 0), kind)
    return sorted(((rows[i][0], sorted((k, *s) for s, k in x.items())) for i, x in enumerate(out)), key=repr)


def test_terms_far_from_an_entity_are_marked(spark, people, monkeypatch):
    far = lambda i: f"Zzyzx{' ' * 60}filler{i} and more words {'x1 ' * 90}"
    rows = people + [(1000 + i, far(i) + "reach@example.org") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_whole(rows, 0.75, 3)

    def extra():
        got = disclosure.personal_data(df, near=None).select("doc_id", "spans").collect()
        spans = [(d, [x.split(":") for x in s.split(",") if x]) for d, s in got]
        number = disclosure.KINDS.index
        return sorted(((d, sorted((number(k), int(a), int(b)) for k, a, b in own if number(k) > 3)) for d, own in spans), key=repr)

    assert extra() == want
    assert any(d == 1000 and s for d, s in want)
    monkeypatch.setattr(disclosure, "HELD", 0)
    assert extra() == want
    made = dict(tuple(r) for r in disclosure.sanitise(df, near=None).collect())
    assert "more words" not in made[1000] and "[email]" in made[1000] and made[None] is None
    assert disclosure.personal_data(df.limit(0), near=None).count() == 0


def test_query_marks_terms_anywhere_in_a_text(spark, tmp_path):
    rows = [(i, f"name{'abcdefg'[i]}q vasiliy {'1 ' * 200} v.p@example.org") for i in range(5)] + [(i, f"other {i}") for i in range(5, 200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.spans for r in LLM_QUERIES["op12_pii_disclosure"](spark, str(tmp_path)).collect()}
    assert all("removed:7:14" in got[i] for i in range(5)) and got[7] == ""


# 13: ranked lexical search


def brute_search(docs, items, k):
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    own = [(i, collections.Counter(word.findall(low(t)))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n, length = len(own), sum(x[2] for x in own)
    df = collections.Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in set(items):
        terms = collections.Counter(word.findall(low(text)))
        scored = []
        for i, c, size in own:
            m = 100 - 25 + 25 * size * n // length
            s = sum(
                q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                for t, q in terms.items() if c[t]
            )
            if s > 0 and i is not None:
                scored.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk, block, k", [(lexical.CHUNK, lexical.BLOCK, 20), (1, 7, 3), (5, 1, 1)])
def test_search_equals_brute_force(spark, odd, monkeypatch, chunk, block, k):
    monkeypatch.setattr(lexical, "BLOCK", block)
    rng = random.Random(k)
    rows = [(i, " ".join(rng.choices(["a", "b", "C", "dd", "Ee", "rare", "é", *map(str, range(30))], k=rng.randint(1, 40)))) for i in range(80)]
    docs = odd.select("doc_id", "text", "n", "score", "rank").unionByName(
        spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], "doc_id long, text string, n string, score int, rank double")
    )
    items = [(1, "rare dd 3"), (2, "same same words"), (3, None), (4, "?!"), (5, "a b c nowhere"), (6, "É é"), (6, "5 6 7 8 9"), (6, "5 6 7 8 9")]
    bench = spark.createDataFrame([(*r, 9) for r in items], "item_id int, text string, doc_id int")
    got = lexical.lexical_search(docs.repartition(3), bench, k, chunk)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(ODD + rows, items, k)


def test_search_of_no_rows(spark, odd):
    bench = spark.createDataFrame([(1, "same")], "item_id int, text string")
    assert lexical.lexical_search(odd.limit(0), bench).count() == 0
    assert lexical.lexical_search(odd, bench.limit(0)).count() == 0
    assert lexical.lexical_search(odd.filter(F.col("text").isNull()), bench).count() == 0


def test_accumulators_are_limited():
    """Few documents get an accumulator once a rare term has decided."""
    n = 5000
    docs = np.arange(n)
    lists = {0: (np.arange(10), np.full(10, 900_000)), 1: (docs, np.full(n, 100))}
    best = [lexical.Best(5)]
    items = [(0, np.array([0, 1]), np.array([1, 1]))]
    made = lexical.search_block(items, best, docs, lambda t: (*lists[t], int(lists[t][1].max())), np.array([8000, 1]))
    assert made == 10
    assert best[0].doc.tolist() == [0, 1, 2, 3, 4] and best[0].score[0] == 8000 * 900_000 + 100
