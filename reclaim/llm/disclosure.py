r"""Operator 11: personal data and the terms that give it away.

*Base entities* are e-mail addresses, IP numbers, card numbers and phone
numbers (patterns below; leftmost matches of a kind, those that fail its test
are dropped).  Their texts are replaced by the name of their kind.

*Disclosing terms* are found by information theory.  The corpus is cut into
segments of at most ``SEGMENT`` words of a line.  With N segments, n(t) with the
term t, n(c) with the entity c and n(t, c) with both,

    IC(c) = log2(N / n(c))        PMI(t; c) = log2(n(t, c) * N / (n(t) * n(c)))

are what c says and how much of that t gives away.  A term discloses an entity
if PMI(t; c) >= ``ALPHA`` * IC(c) and both stand together in at least
``SUPPORT`` different segments (copies of a segment count once).  Wherever such a
term stands outside base entities, it is generalised to its first ``PREFIX``
letters and ``*``, if the class of all terms with these letters discloses no
entity, or else removed.  Classes are counted like terms.

Terms are the runs of word characters outside base entities, in lower case, of
at least ``LEAST`` letters.  One pass over the texts writes counts, summed up in the task first;
an entity or a term that fills a third of all segments arrives as one row for
each ``HELD`` counts of a task.  Pairs are at most segment words times segment
entities, so a line of any length gives pairs in proportion to it.  The
disclosing terms go to the tasks in a closure if there are at most ``CLOSURE``
of them; else texts are joined with them by a digest.

Cases: null text is empty text (no spans, empty text out); the null doc_id and
repeated rows are rows like others; equal texts have equal results; texts of any
length are searched whole, in linear time; extra columns are ignored; an empty
table gives no rows; without entities nothing is a disclosing term.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, tidy, written

BASE = ("email", "ip", "card", "phone")
TERM = "term"
KINDS = {kind: i for i, kind in enumerate((*BASE, TERM))}
SEGMENT = 32  # words
ALPHA = 0.9
SUPPORT = 3  # different segments
LEAST, PREFIX = 3, 3  # letters
CLOSURE = 20_000  # disclosing terms
HELD = 200_000  # counts held by a task
STEP = 256  # documents held at once

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"\w+")

Span = tuple[int, int, int]  # start, kind, end


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@`` and a domain with a dot.  Local parts
    hold no ``@``, so each is the run of its letters in front of one."""
    free, at = 0, text.find("@")
    while at >= 0:
        front = text[free:at]
        local = len(front) - len(front.rstrip(LOCAL))
        free = at + 1
        if local and (domain := DOMAIN.match(text, free)):
            free = domain.end()
            yield at - local, free
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the base entities by start, then kind."""
    out: list[Span] = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) < 4 and int(part) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def features(words: list[str]) -> set[str]:
    """The terms of a segment and the classes that generalise them."""
    terms = {w for w in words if len(w) >= LEAST}
    return terms | {f"{w[:PREFIX]}*" for w in terms if len(w) > PREFIX}


def marked(text: str, spans: list[Span]) -> Iterator[tuple[re.Match, bool]]:
    """Words of the text, and whether a span reaches into each."""
    cover: list[list[int]] = []  # the spans, those that overlap as one
    for a, _, b in spans:
        if cover and a <= cover[-1][1]:
            cover[-1][1] = max(cover[-1][1], b)
        else:
            cover.append([a, b])
    i = 0
    for m in WORD.finditer(text):
        while i < len(cover) and cover[i][1] <= m.start():
            i += 1
        yield m, i < len(cover) and cover[i][0] < m.end()


def segments(text: str, spans: list[Span], size: int = SEGMENT) -> Iterator[tuple[int, list[str], list[str]]]:
    """End, words and those words outside spans of each segment; segments do
    not cross lines."""
    end, words, free, line = 0, [], [], text.find("\n")
    for m, inside in marked(text, spans):
        if words and (len(words) == size or 0 <= line < m.start()):
            yield end, words, free
            words, free = [], []
        if 0 <= line < m.start():
            line = text.find("\n", m.start())
        word, end = m[0].lower(), m.end()
        words.append(word)
        if not inside:
            free.append(word)
    if words:
        yield end, words, free


def plain_segments(text: str, size: int = SEGMENT) -> Iterator[list[str]]:
    """The same as words, for texts without entities."""
    for line in text.split("\n"):
        words = WORD.findall(line)
        for at in range(0, len(words), size):
            yield words[at : at + size]


COUNTS = "kind string, value string, term string, segment binary, n long"


def counts(docs: DataFrame) -> DataFrame:
    """Parts of all counts: of segments (all null), terms (term), entities
    (kind, value) and pairs with the segment's digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            kind, value, term, segment = zip(*held)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.string()), pa.array(value, pa.string()), pa.array(term, pa.string()), pa.array(segment, pa.binary()), pa.array(held.values(), pa.int64())],
                ["kind", "value", "term", "segment", "n"],
            )
            held.clear()
            return batch

        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                terms: Counter = Counter()
                n = 0
                for text in batch.column(0).slice(at, STEP).to_pylist():
                    spans = base_spans(text)
                    if not spans:
                        for words in plain_segments(text):
                            terms.update(features([w.lower() for w in words]))
                            n += 1
                        continue
                    next_ = 0
                    for end, words, free in segments(text, spans):
                        found = features(free)
                        terms.update(found)
                        n += 1
                        inside = set()  # entities whose first word is in this segment
                        while next_ < len(spans) and spans[next_][0] < end:
                            a, kind, b = spans[next_]
                            inside.add((BASE[kind], text[a:b]))
                            next_ += 1
                        if inside:
                            digest = hashlib.md5(" ".join(words).encode()).digest()
                            for kind, value in inside:
                                held[kind, value, None, None] += 1
                                for t in found:
                                    held[kind, value, t, digest] += 1
                            if len(held) >= HELD:
                                yield out()
                for t, k in terms.items():
                    held[None, None, t, None] += k
                held[None, None, None, None] += n
                if len(held) >= HELD:
                    yield out()
        if held:
            yield out()

    return docs.select(text_or_empty().alias("text")).mapInArrow(tidy(run), COUNTS)


def disclosing(docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """Disclosing terms: term, strongest share of an entity's information that
    it gives away, and what it is replaced by (empty: removed)."""
    parts = written(counts(docs), "disclosure-counts")
    total = parts.where("kind is null and term is null").agg(F.sum("n")).first()[0] or 0
    terms = parts.where("kind is null and term is not null").groupBy("term").agg(F.sum("n").alias("n_t"))
    entities = parts.where("kind is not null and term is null").groupBy("kind", "value").agg(F.sum("n").alias("n_c"))
    pairs = (
        parts.where("kind is not null and term is not null")
        .groupBy("kind", "value", "term", "segment")
        .agg(F.sum("n").alias("n"))
        .groupBy("kind", "value", "term")
        .agg(F.sum("n").alias("n_tc"), F.count("*").alias("different"))
        .where(F.col("different") >= support)
    )
    n = F.lit(float(total))
    share = F.log2(F.col("n_tc") * n / (F.col("n_t") * F.col("n_c"))) / F.log2(n / F.col("n_c"))
    strong = (
        pairs.join(entities.where(F.col("n_c") < n), ["kind", "value"])
        .join(terms, "term")
        .select("term", share.alias("share"))
        .where(F.col("share") >= alpha)
        .groupBy("term")
        .agg(F.max("share").alias("share"))
    )
    strong = written(strong, "disclosure-strong")
    classes = strong.where(F.col("term").endswith("*")).select(F.col("term").alias("class"))
    general = F.concat(F.substring("term", 1, PREFIX), F.lit("*"))
    return (
        strong.where(~F.col("term").endswith("*"))
        .withColumn("general", general)
        .join(classes, F.col("general") == F.col("class"), "left")
        .select("term", "share", F.when(F.col("class").isNull() & (F.char_length("term") > PREFIX), F.col("general")).otherwise("").alias("replacement"))
    )


def all_spans(text: str, terms: dict[str, str]) -> list[Span]:
    """Base spans and, outside them, those of disclosing terms."""
    spans = base_spans(text)
    if not terms:
        return spans
    found = [(m.start(), KINDS[TERM], m.end()) for m, inside in marked(text, spans) if not inside and m[0].lower() in terms]
    return sorted(spans + found)


def cleaned(text: str, spans: list[Span], terms: dict[str, str]) -> str:
    """The text with entities named by kind and terms replaced."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], terms[text[start:end].lower()] if kind == KINDS[TERM] else f"<{BASE[kind].upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


SPANS = "array<struct<kind: string, start: long, end: long>>"


def sanitise(docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT, closure: int = CLOSURE) -> DataFrame:
    """One row per document: doc_id, spans (by start, then kind; code points)
    and the sanitised text."""
    found = written(disclosing(docs, alpha, support), "disclosure-terms")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    head = found.select("term", "replacement").limit(closure + 1).collect()
    shared = {r.term: r.replacement for r in head} if len(head) <= closure else None
    if shared is None:
        texts = texts.withColumn("digest", F.md5("text"))
        mine = terms_of(texts).join(found, "term").groupBy("digest").agg(F.collect_set(F.struct("term", "replacement")).alias("terms"))
        texts = texts.join(mine, "digest", "left").select("doc_id", "text", "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = list(KINDS)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                own = [None] * len(part) if shared is not None else part.column(2).to_pylist()
                spans, clean = [], []
                for text, terms in zip(part.column(1).to_pylist(), own):
                    terms = {t["term"]: t["replacement"] for t in terms or []} if shared is None else shared
                    found = all_spans(text, terms)
                    spans.append([{"kind": kinds[k], "start": a, "end": b} for a, k, b in found])
                    clean.append(cleaned(text, found, terms))
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind), pa.array(clean, pa.string())], ["doc_id", "spans", "sanitised"])

    return texts.mapInArrow(tidy(run), f"doc_id long, spans {SPANS}, sanitised string")


def terms_of(texts: DataFrame) -> DataFrame:
    """digest and each different term of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text in zip(batch.column(0), batch.column(1)):
                terms = sorted({w for w in map(str.lower, WORD.findall(text.as_py())) if len(w) >= LEAST})
                yield pa.RecordBatch.from_arrays([pa.array([digest.as_py()] * len(terms), pa.string()), pa.array(terms, pa.string())], ["digest", "term"])

    return texts.select("digest", "text").mapInArrow(tidy(run), "digest string, term string")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def digests(docs: DataFrame) -> DataFrame:
    """The digest columns of ``sanitise`` with its defaults."""
    return sanitise(docs).select(
        "doc_id",
        *(F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.sha2(listed(of_kinds(*BASE)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.size(of_kinds(TERM)).cast("long").alias("n_term"),
        F.sha2("sanitised", 256).alias("sanitised_sha256"),
    )
