"""Operator 6: order MinHash fingerprints.

A text's k-mers are numbered by occurrence (the first, second ... time that
the k-mer appears), so repeats count.  Each of ``HASHES`` functions selects the
``TUPLE`` numbered k-mers of least hash, keeps them in text order and hashes
the tuple.  Two texts agree in a function with a probability that falls with
their edit distance: not only the k-mers must be shared, but their order too.

``edited`` pairs every document with the next one (ascending doc_id, the last
with the first), whose first code points replace the end of its text.  The
documents are dealt by explicit doc_id ranges and streamed in order inside
each; only the first document of each range is sent a second time, to the
range before, so texts are shuffled once.

Cases: null text is the empty text; a text shorter than k is one k-mer, an
empty text none, and a missing tuple entry hashes as such, so equal texts have
equal fingerprints; a single document is its own next document; equal doc_ids
(and null, which comes first) are ordered by text; texts of any length are
read whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MOST_PARTITIONS, partitions, shards, text_or_empty, tidy

K, HASHES, TUPLE = 6, 24, 2
RANGE_MB = 2  # text of a doc_id range
ODD = np.random.default_rng(6).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
COLUMNS = 1 << 14  # k-mers hashed at a time
GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * GOLD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def kmers(code: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k-mer of code points."""
    if len(code) < k:
        return mix(np.array([hash_all(code)], np.uint64)) if len(code) else np.zeros(0, np.uint64)
    wide = code.astype(np.uint64) + np.uint64(1)
    n = len(code) - k + 1
    h = wide[:n].copy()
    for i in range(1, k):
        h *= np.uint64(0x100000001B3)
        h += wide[i : i + n]
    return mix(h)


def hash_all(code: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(code.astype("<u4").tobytes(), digest_size=8).digest(), "little")


def numbered(h: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, occurrence number), in text order."""
    n = len(h)
    if n < 2:
        return mix(h + GOLD)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    # One sort of (hash, position) packed into a word brings equal k-mers together.
    packed = (h & ~low) | np.arange(n, dtype=np.uint64)
    packed.sort()
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(packed[1:] >> bits, packed[:-1] >> bits, out=first[1:])
    again = np.flatnonzero(~first)
    out = h + GOLD
    if len(again):
        group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        out[(packed[again] & low).astype(np.int64)] += (again - group[again]).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(out)


def least(h: np.ndarray, at: int, take: int, hashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place in the text, numbered k-mer) of the ``take`` least hashes
    under each function, a row each; ``h`` starts at place ``at``."""
    best = tuple(np.zeros((hashes, 0), t) for t in (np.uint64, np.int64, np.uint64))
    rows = np.arange(hashes)
    for start in range(0, len(h), COLUMNS):
        part = h[start : start + COLUMNS]
        x = part[None, :] * ODD[:hashes, None]
        for _ in range(min(take, len(part))):
            i = x.argmin(1)
            found = (x[rows, i], i + (at + start), part[i])
            best = tuple(np.concatenate([b, f[:, None]], 1) for b, f in zip(best, found))
            x[rows, i] = TOP
        best = smallest(best, take)
    return best


def smallest(best: tuple[np.ndarray, ...], take: int) -> tuple[np.ndarray, ...]:
    """The ``take`` least of each row, places ascending among equals."""
    order = np.argsort(best[0], axis=1, kind="stable")[:, :take]
    return tuple(np.take_along_axis(b, order, 1) for b in best)


def sketch(parts: list[tuple[np.ndarray, ...]], take: int) -> np.ndarray:
    """Fingerprint from the least hashes of a text's parts (in text order)."""
    best = smallest(tuple(np.concatenate(x, 1) for x in zip(*parts)), take)
    value = np.take_along_axis(best[2], np.argsort(best[1], axis=1), 1)
    out = np.full(len(value), value.shape[1], np.uint64)
    for column in value.T:
        out = mix(out * np.uint64(0x100000001B3) + column)
    return (out >> np.uint64(32)).astype(np.uint32)


def fingerprint(text: str, k: int = K, hashes: int = HASHES, take: int = TUPLE) -> np.ndarray:
    """The order-MinHash fingerprint of one text."""
    return sketch([least(numbered(kmers(codes(text), k)), 0, take, hashes)], take)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def pair_fingerprints(text: str, other: str, k: int = K, hashes: int = HASHES, take: int = TUPLE) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of two texts; the k-mers of their common start, whose
    occurrence numbers agree, are searched once."""
    a, b = codes(text), codes(other)
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[:n] != b[:n])
    shared = (int(unlike[0]) if len(unlike) else n) - k + 1
    ha, hb = numbered(kmers(a, k)), numbered(kmers(b, k))
    if shared < 1 or not np.array_equal(ha[:shared], hb[:shared]):
        return tuple(sketch([least(h, 0, take, hashes)], take) for h in (ha, hb))
    start = least(ha[:shared], 0, take, hashes)
    return tuple(sketch([start, least(h[shared:], shared, take, hashes)], take) for h in (ha, hb))


def edit(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many (or
    all) of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def range_of(bounds: list[int]) -> Column:
    """Number of bounds that are at most doc_id, by bisection."""
    if not bounds:
        return F.lit(0)
    high = 1 << (len(bounds).bit_length() - 1)
    padded = F.array(*[F.lit(b).cast("long") for b in bounds + [(1 << 63) - 1] * (2 * high - 1 - len(bounds))])
    steps = F.array(*[F.lit(high >> i) for i in range(high.bit_length())])
    hit = lambda at, step: F.element_at(padded, at + step) <= F.col("doc_id")
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(hit(at, step), step).otherwise(F.lit(0)))


def with_next(docs: DataFrame, range_mb: int = RANGE_MB) -> tuple[DataFrame, int]:
    """Rows (range, own, doc_id, text): every document, own = 0, and behind
    each range the document that follows it, own = 1."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # Ranges are streamed, so they may grow: the driver holds their bounds.
    count = partitions(shards(base, range_mb))
    cuts = base.approxQuantile("doc_id", [i / count for i in range(1, count)], 0.1 / count) if count > 1 else []
    place = range_of(sorted({int(b) for b in cuts}))
    first = {r.r: r.id for r in base.groupBy(place.alias("r")).agg(F.min("doc_id").alias("id")).collect()}  # a row per range
    order = sorted(first)
    last = max(order, default=0)
    by_range = lambda values: F.element_at(F.array(*[F.lit(values.get(i)).cast("long") for i in range(last + 1)]), F.col("range") + 1)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # the first range follows the last
    leads = F.col("doc_id").isNull() | (F.col("doc_id") == by_range(first))
    here = F.struct(F.col("range").cast("long").alias("range"), F.lit(0).alias("own"))
    ahead = F.struct(by_range(before).alias("range"), F.lit(1).alias("own"))
    both = base.withColumn("range", place).withColumn("at", F.explode(F.when(leads, F.array(here, ahead)).otherwise(F.array(here))))
    return both.select("at.range", "at.own", "doc_id", "text"), count


def edited(docs: DataFrame, k: int = K, hashes: int = HASHES, take: int = TUPLE, range_mb: int = RANGE_MB) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their
    likeness to each other and to the next document's."""
    rows, count = with_next(docs, range_mb)
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def show(f: np.ndarray) -> str:
        return f.astype(">u4").tobytes().hex()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last document of the range, waiting for its next one
        here, done = None, True
        waiting: tuple | None = None  # the one before, fingerprinted
        out: list[tuple] = []
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                r, own, doc, text = (c[i].as_py() for c in columns)
                if r != here:
                    here, done, held = r, False, None
                if done:
                    continue
                if held is not None:
                    changed = edit(held[1], text)
                    a, b = pair_fingerprints(held[1], changed, k, hashes, take)
                    if waiting is not None:
                        out.append(finish(waiting, a))
                    waiting = (held[0], held[1], changed, a, b)
                if own:
                    out.append(finish(waiting, fingerprint(text, k, hashes, take)))
                    waiting, held, done = None, None, True
                else:
                    held = (doc, text)
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], arrow)
                    out.clear()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], arrow)

    def finish(waiting: tuple, following: np.ndarray) -> tuple:
        doc, text, changed, a, b = waiting
        return doc, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), show(a), show(b), likeness(a, b), likeness(a, following)

    arrow = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    parts = count if count == MOST_PARTITIONS else max(1, -(-count // 4))
    return rows.repartition(parts, "range").sortWithinPartitions("range", "own", F.col("doc_id").asc_nulls_first(), "text").mapInArrow(tidy(run), schema)
