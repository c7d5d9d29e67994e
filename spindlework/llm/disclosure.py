"""Personal data, and the terms around it that give it away.

Base.  Email and IP addresses, card and phone numbers are found by fixed patterns, each in time
proportional to the text.

Information-theoretic sanitisation.  A base match is an occurrence of a protected entity (its
normal form).  With N documents, an entity c carries IC(c) = log N / df(c), and a term t tells
PMI(c; t) = log N df(c, t) / (df(c) df(t)) of it: df counts documents, and df(c, t) those
in which t stands within ``near`` code points of c, or, with ``near=None``, anywhere in the
same text.  The share PMI / IC is 1 where t never occurs
without c and about 0 where they are independent.  A term whose share reaches ``alpha`` around an
entity, and that was seen with it in at least ``support`` different contexts, so that a chance
meeting or a copied text proves nothing, discloses it.  There it is generalised to its first
``STEM`` letters if what all terms with that beginning tell of the entity stays below the
threshold, and removed if not.

Scale.  One scan writes places and digests (text only of documents with a base match, for whole
texts); another counts the documents of the terms in question.  Pairs are counted map-side, so an
entity that a third of the documents share is a row a task for each of its terms.  In whole texts
pairs are made only of entities and terms that occur in ``support`` different ones, and only where
the counts of both leave room for ``alpha``, which frequent terms do not.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlework.llm.common import slices, store

KINDS = ("email", "ip", "card", "phone", "generalised", "removed")  # order of the spans
NEAR = 120
STEM = 3
ALPHA = 0.75
SUPPORT = 3
HELD = 1_000_000  # terms whose counts are taken by look-up; more are counted by a join
FLUSH = 200_000

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")
TERM = re.compile(r"[^\W\d_]{2,}")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches around each @: what precedes it back to the last match, and a dotted domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    double = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    own = [int(d) for d in reversed(digits)]
    return (sum(own[::2]) + sum(double[d] for d in own[1::2])) % 10 == 0


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, stop, normal form) by kind and place."""
    out = [(0, a, b, text[a:b].lower()) for a, b in emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0")[:4] or "0" for p in m.group().split(".")]
        if all(int(p) <= 255 for p in parts):
            out.append((1, *m.span(), ".".join(parts)))
    for m in CARD.finditer(text):
        digits = NO_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span(), digits))
    for m in PHONE.finditer(text):
        digits = NO_DIGIT.sub("", m.group())
        if 9 <= len(digits) <= 15:
            out.append((3, *m.span(), digits))
    return out


def key(mark: str, text: str) -> int:
    """Digest of an entity, a term or a beginning, as a signed long."""
    h = xxhash.xxh3_64_intdigest(f"{mark}:{text}".encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def cover(spans: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a place shares a code point with one of ``spans``."""
    taken = sorted(spans)
    starts = [a for a, _ in taken]
    reach = np.maximum.accumulate([b for _, b in taken]).tolist()

    def covered(a: int, b: int) -> bool:
        at = bisect_left(starts, b) - 1  # the last match that begins before b
        return at >= 0 and reach[at] > a

    return covered


def around(text: str, base: list[tuple[int, int, int, str]], reach: int = NEAR) -> list[dict]:
    """Terms near each entity, outside all base matches.

    ``first``, ``first_g``: the first time the document has this pair of entity and term, or of
    entity and beginning.
    """
    covered = cover([(a, b) for _, a, b, _ in base])
    out, seen = [], set()
    for kind, start, stop, form in base:
        lo, hi = max(0, start - reach), min(len(text), stop + reach)
        entity = key(KINDS[kind], form)
        before, after = text[lo:start], text[stop:hi]
        context = key("context", f"{before}\0{after}")
        for part, offset in ((before, lo), (after, stop)):
            for m in TERM.finditer(part):
                a, b = m.start() + offset, m.end() + offset
                # a term that the window cuts is none
                if (a == lo and a and text[a - 1].isalpha()) or (b == hi and b < len(text) and text[b].isalpha()):
                    continue
                if covered(a, b):
                    continue
                word = m.group().lower()
                t, g = key("t", word), key("g", word[:STEM])
                row = {"c": entity, "t": t, "g": g, "context": context, "start": a, "stop": b}
                row["first"] = (entity, t) not in seen
                row["first_g"] = (entity, g) not in seen
                seen.update(((entity, t), (entity, g)))
                out.append(row)
    return out


def terms_outside(text: str, base: list[dict]) -> Iterator[tuple[int, int, str]]:
    """(start, stop, term) of all terms of a text outside its base matches."""
    covered = cover([(s["start"], s["stop"]) for s in base])
    for m in TERM.finditer(text):
        if not covered(*m.span()):
            yield *m.span(), m.group().lower()


SPAN = "struct<kind: int, start: int, stop: int>"
PLACE = "struct<c: bigint, t: bigint, g: bigint, context: bigint, start: int, stop: int, first: boolean, first_g: boolean>"


SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))


def scan(docs: DataFrame, keep_text: bool = False, reach: int | None = NEAR) -> DataFrame:
    """(row, doc_id, base, entities, near[, text]) of each row of (doc_id, text).

    For whole texts (``reach`` None) with a digest ``context`` of the text for ``near``, and always
    with ``text``, which is null unless it is kept or has a base match.
    """
    place = pa.struct(
        [(c, pa.int64()) for c in ("c", "t", "g", "context")]
        + [("start", pa.int32()), ("stop", pa.int32()), ("first", pa.bool_()), ("first_g", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                spans, entities, near = [], [], []
                texts = part.column("text").to_pylist()
                for text in texts:
                    base = base_matches(text or "")
                    spans.append([{"kind": k, "start": a, "stop": b} for k, a, b, _ in base])
                    entities.append(sorted({key(KINDS[k], form) for k, _, _, form in base}))
                    if reach is None:
                        near.append(key("context", text) if base else None)
                    else:
                        near.append(around(text, base, reach) if base else [])
                columns = [
                    part.column("row"),
                    part.column("doc_id"),
                    pa.array(spans, SPAN_TYPE),
                    pa.array(entities, pa.list_(pa.int64())),
                    pa.array(near, pa.int64() if reach is None else pa.list_(place)),
                ]
                names = ["row", "doc_id", "base", "entities", "context" if reach is None else "near"]
                if keep_text:
                    columns, names = [*columns, part.column("text")], [*names, "text"]
                elif reach is None:
                    held = [t if own else None for t, own in zip(texts, spans)]
                    columns, names = [*columns, pa.array(held, pa.string())], [*names, "text"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = f"row long, doc_id long, base array<{SPAN}>, entities array<long>"
    kinds += ", context long" if reach is None else f", near array<{PLACE}>"
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(run, kinds + ", text string" * (keep_text or reach is None))


def document_counts(docs: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """(term, n): the documents with each term or beginning, of ``wanted`` digests or of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = None if wanted is None else set(wanted.tolist())
        known: dict[str, tuple] = {}
        total: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())], names=["term", "n"]
            )

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                for text in part.column("text").to_pylist():
                    own = set()
                    for word in set(TERM.findall(text or "")):
                        keys = known.get(word)
                        if keys is None:
                            low = word.lower()
                            keys = (key("t", low), key("g", low[:STEM]))
                            keys = keys if only is None else tuple(k for k in keys if k in only)
                            if len(known) > FLUSH:
                                known.clear()
                            known[word] = keys
                        own.update(keys)
                    total.update(own)
                if len(total) > FLUSH:
                    yield rows()
                    total.clear()
        yield rows()

    own = docs.select(F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def counted(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(term, n) for each term t and beginning g of ``pairs``."""
    terms = store(pairs.select(F.explode(F.array("t", "g")).alias("term")).distinct(), "terms")
    wanted = None
    if terms.count() <= HELD:
        wanted = np.array([r["term"] for r in terms.collect()], np.int64)
    return store(document_counts(docs, wanted).join(terms, "term", "left_semi"), "term-counts")


def disclosures(found: DataFrame, docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """(c, t, kind): which terms disclose which entities, and what becomes of them there."""
    near = found.select(F.explode("near").alias("x")).select("x.*")
    one = F.col("first").cast("long")
    pairs = near.groupBy("c", "t", "g").agg(
        F.sum(one).alias("n_ct"), F.count_distinct("context").alias("contexts")
    )
    pairs = store(pairs.filter(F.col("contexts") >= support).drop("contexts"), "pairs")
    stems = near.groupBy("c", "g").agg(F.sum(F.col("first_g").cast("long")).alias("n_cg"))
    entities = found.select(F.explode("entities").alias("c")).groupBy("c").agg(F.count("*").alias("n_c"))
    counts = counted(docs, pairs)
    n = F.lit(float(max(found.count(), 1)))
    met = (
        pairs.join(entities, "c")
        .join(stems, ["c", "g"])
        .join(counts.select(F.col("term").alias("t"), F.col("n").alias("n_t")), "t")
        .join(counts.select(F.col("term").alias("g"), F.col("n").alias("n_g")), "g")
    )
    content = F.log(n / F.col("n_c"))

    def tells(both: str, own: str):
        return F.log(n * F.col(both) / (F.col("n_c") * F.col(own)))

    # an entity in every document carries nothing to disclose
    reached = (content > 0) & (tells("n_ct", "n_t") >= alpha * content)
    safe = tells("n_cg", "n_g") < alpha * content
    return met.filter(reached).select("c", "t", outcome(safe))


def distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, context, t, g): each term of a text once."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            rows: list[tuple] = []
            for row, context, text, base in zip(*(part.column(c).to_pylist() for c in ("row", "context", "text", "base"))):
                own = sorted({word for _, _, word in terms_outside(text, base)})
                rows += [(row, context, key("t", w), key("g", w[:STEM])) for w in own]
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "context", "t", "g"])


def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, extra): all places of the terms in ``marks``, outside base matches."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            out = []
            for text, base, marks in zip(*(part.column(c).to_pylist() for c in ("text", "base", "marks"))):
                kinds, own = {m["t"]: m["kind"] for m in marks}, []
                for a, b, word in terms_outside(text, base):
                    kind = kinds.get(key("t", word))
                    if kind is not None:
                        own.append({"kind": kind, "start": a, "stop": b})
                out.append(own)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(out, SPAN_TYPE)], names=["row", "extra"])


def whole_texts(found: DataFrame, docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """(row, extra): places of the terms that disclose an entity anywhere in the same text.

    The context of a pair is its text, so an entity or term of fewer than ``support`` different
    texts discloses nothing.  What a pair tells at most, if every document of the rarer one holds
    both, is known before pairs are counted.
    """
    n = F.lit(float(max(found.count(), 1)))
    content = F.log(n / F.col("n_c"))

    def tells(both, own: str):
        return F.log(n * both / (F.col("n_c") * F.col(own)))

    held = found.select("row", "context", F.explode("entities").alias("c"))
    entities = held.groupBy("c").agg(F.count("*").alias("n_c"), F.count_distinct("context").alias("contexts"))
    # an entity in every document carries nothing to disclose
    entities = store(entities.filter((F.col("contexts") >= support) & (content > 0)).drop("contexts"), "entities")
    holders = store(held.join(entities, "c").select("row", "c", "n_c"), "holders")
    carriers = store(
        found.join(holders.select("row").distinct(), "row", "left_semi").select("row", "context", "text", "base"),
        "carriers",
    )
    terms = store(carriers.mapInArrow(distinct_terms, "row long, context long, t long, g long"), "carrier-terms")
    wide = terms.groupBy("t", "g").agg(F.count_distinct("context").alias("contexts"))
    wide = store(wide.filter(F.col("contexts") >= support).drop("contexts"), "wide-terms")
    counts = counted(docs, wide)
    rated = wide.join(counts.select(F.col("term").alias("t"), F.col("n").alias("n_t")), "t")
    met = terms.join(rated, ["t", "g"]).join(holders, "row")
    met = store(met.filter(tells(F.least("n_c", "n_t"), "n_t") >= alpha * content), "met")
    pairs = met.groupBy("c", "t", "g", "n_c", "n_t").agg(
        F.count("*").alias("n_ct"), F.count_distinct("context").alias("contexts")
    )
    reached = (F.col("contexts") >= support) & (tells(F.col("n_ct"), "n_t") >= alpha * content)
    pairs = store(pairs.filter(reached).select("c", "t", "g", "n_c"), "pairs")
    begun = terms.select("row", "g").join(pairs.select("g").distinct(), "g", "left_semi").distinct()
    stems = begun.join(holders.select("row", "c"), "row").join(pairs.select("c", "g").distinct(), ["c", "g"])
    told = (
        pairs.join(stems.groupBy("c", "g").agg(F.count("*").alias("n_cg")), ["c", "g"])
        .join(counts.select(F.col("term").alias("g"), F.col("n").alias("n_g")), "g")
        .select("c", "t", outcome(tells(F.col("n_cg"), "n_g") < alpha * content))
    )
    marks = (
        met.select("row", "c", "t").join(told, ["c", "t"])
        .groupBy("row", "t").agg(F.max("kind").alias("kind"))  # removed, if one entity asks for it
        .groupBy("row").agg(F.collect_list(F.struct("t", "kind")).alias("marks"))
    )
    return carriers.join(marks, "row").select("row", "text", "base", "marks").mapInArrow(
        marked, f"row long, extra array<{SPAN}>"
    )


def outcome(safe):
    """What becomes of a term: generalised where its beginning is ``safe``, else removed."""
    return F.when(safe, KINDS.index("generalised")).otherwise(KINDS.index("removed")).alias("kind")


def close_by(found: DataFrame, docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """(row, extra): places of the terms near an entity that disclose it."""
    told = store(disclosures(found, docs, alpha, support), "disclosures")
    return (
        found.select("row", F.explode("near").alias("x"))
        .select("row", "x.c", "x.t", "x.start", "x.stop")
        .join(told, ["c", "t"])
        .groupBy("row", "start", "stop")
        .agg(F.max("kind").alias("kind"))  # removed, if one entity asks for it
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "stop")).alias("extra"))
    )


def all_spans(
    docs: DataFrame,
    alpha: float = ALPHA,
    support: int = SUPPORT,
    keep_text: bool = False,
    near: int | None = NEAR,
) -> DataFrame:
    """(row, doc_id, base, spans[, text]): all spans by kind and place for each row of ``docs``."""
    found = store(scan(docs, keep_text, near), "found")
    extra = (whole_texts if near is None else close_by)(found, docs, alpha, support)
    none = F.array().cast(f"array<{SPAN}>")
    spans = F.array_sort(F.concat("base", F.coalesce("extra", none)))
    return found.drop("entities", "near", "context").join(extra, "row", "left").withColumn("spans", spans).drop("extra")


def as_text(spans: str):
    """kind:start:stop of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")),
    )
    return F.array_join(one, ",")


def personal_data(
    docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT, near: int | None = NEAR
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), a row for each row.

    Terms are looked for within ``near`` code points of an entity, with None in whole texts.
    Null and empty texts have no span; repeated rows give repeated rows (and count as
    documents, but their contexts as one); an empty table gives an empty table; other columns
    are not read.
    """
    def count(kind: int):
        own = F.size(F.filter("base", lambda s: s["kind"] == kind))
        return own.cast("long").alias(f"n_{KINDS[kind]}")

    return all_spans(docs, alpha, support, near=near).select(
        "doc_id", *map(count, range(4)), F.sha2(as_text("base"), 256).alias("base_sha256"), as_text("spans").alias("spans")
    )


def cleaned(text: str, spans: list[dict]) -> str:
    """The text with base matches as [kind], generalised terms by their beginning and an
    asterisk, and removed terms left out."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["stop"])):
        if s["start"] < at:  # inside what is gone already, or beyond its end
            at = max(at, s["stop"])
            continue
        out.append(text[at : s["start"]])
        kind = KINDS[s["kind"]]
        if kind == "generalised":
            out.append(f"{text[s['start'] : s['start'] + STEM]}*")
        elif kind != "removed":
            out.append(f"[{kind}]")
        at = s["stop"]
    out.append(text[at:])
    return "".join(out)


def sanitise(
    docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT, near: int | None = NEAR
) -> DataFrame:
    """(doc_id, text): texts without what identifies a person; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                rows = zip(part.column("text").to_pylist(), part.column("spans").to_pylist())
                texts = [t and cleaned(t, s) for t, s in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
                )

    found = all_spans(docs, alpha, support, True, near)
    return found.select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, text string")
