"""Operator 2: removal of repeated byte strings by sharded suffix arrays.

A string of ``LENGTH`` = 100 bytes (a window) that also starts earlier, in a
smaller doc_id or at an earlier place of the same document, is removed.

0. All but the first of equal texts (by md5) are removed whole; they take no
   part in what follows.
1. Texts (in parts of ``PART`` bytes that overlap by one window) are dealt by
   hash to shards whose number follows the input.
2. Windows are located by winnowing: the least hash among the k-grams of a
   window is its anchor, so equal windows have equal anchors at equal places.
   A shard sends each of its anchors once; anchors that no other place has
   are out.
3. Per shard: the stretches with repeated anchors get a suffix array by
   Larsson-Sadakane refinement (ranks by 8 bytes, doubled while groups are
   unsorted) and Kasai common prefixes; neighbours
   with a common prefix of a window or more are one repeated string.  All but
   the shard's first occurrence are removed at once, so a passage found in a
   third of all documents leaves a shard only once.
4. Cross-shard merging: first occurrences whose anchor other shards have too
   meet by anchor; the shards' sorted runs are merged in pairs by binary
   search, and of equal windows all but the earliest are removed.

Anchors only choose which places are compared: all removals are judged on the
bytes of whole windows.

Cases: null text is empty; texts shorter than a window are kept; matches never
cross documents; rows with one doc_id and equal text are one document, and
with unequal texts ordered by a hash of the text; a null doc_id comes first;
texts of any length are handled in parts; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MB, partitions, tidy, total_bytes, written

LENGTH = 100
GRAM = 32  # bytes of an anchor's k-gram
SHARD_MB = 4
PART = 4 * MB
BLOCK = 1 << 16  # bytes hashed at a time: the work arrays stay in the cache
_random = np.random.default_rng(2)
BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = [np.uint64(x) for x in _random.integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]
MISSING = -(1 << 63)  # stands for a null doc_id inside


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def rolled(raw: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each place where they fit, put
    together from hashes of powers of two."""
    n = len(raw) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h, width, done, out, salt = BYTE[raw], 1, 0, None, 0
    while True:
        if size & width:
            part = h[done : done + n]
            out = part.copy() if out is None else out * ODD[salt + 8] + part
            done += width
        if done == size:
            return mix(out)
        h = h[:-width] * ODD[salt] + h[width:]
        width, salt = width * 2, salt + 1


def sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` neighbours."""
    width = 1
    while width * 2 <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def anchors(raw: np.ndarray, valid: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last): runs of valid window starts with one anchor."""
    hashes, first, last = [], [], []
    for at in range(0, len(raw), BLOCK):
        part = raw[at : at + BLOCK + length - 1]
        if len(part) < length:
            break
        h = rolled(part, gram)
        place = np.arange(len(h), dtype=np.uint64)
        # Hash above, place below: equal hashes give way to the later place.
        low = np.uint64((1 << 21) - 1)
        least = sliding_least((h & ~low) | (low - place), length - gram + 1)
        anchor = (low - (least & low)).astype(np.int64)
        start = np.flatnonzero(valid[at : at + len(anchor)])
        if not len(start):
            continue
        mine = anchor[start]
        edge = np.flatnonzero(np.concatenate([[True], (mine[1:] != mine[:-1]) | (start[1:] != start[:-1] + 1)]))
        hashes.append(h[mine[edge]])
        first.append(start[edge] + at)
        last.append(start[np.append(edge[1:], len(start)) - 1] + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(first), np.concatenate(last)


def suffix_array(raw: np.ndarray) -> np.ndarray:
    """Places of ``raw`` in the order of their suffixes.

    Larsson-Sadakane refinement: the rank of a place is the last position of
    its group; only groups of more than one place are sorted again, by the
    rank of the place one prefix further on, which doubles the prefix."""
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    word = np.zeros(n, np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | padded[i : i + n]
    order = np.argsort(word)
    rank = np.empty(n, np.int64)
    same = word[order[1:]] == word[order[:-1]]
    ends = np.flatnonzero(np.append(~same, True))
    group = np.repeat(ends, np.diff(np.concatenate([[-1], ends])))
    rank[order] = group
    open_ = np.flatnonzero(np.append(same, False) | np.concatenate([[False], same]))  # positions in unsorted groups
    prefix = 8
    while len(open_):
        place = order[open_]
        further = place + prefix
        # A suffix that ends within the prefix comes before those that go on.
        key = np.where(further < n, rank[np.minimum(further, n - 1)] + prefix + 1, n - place)
        mine = rank[place]
        sort = np.argsort(mine << 32 | key)
        place, mine, key = place[sort], mine[sort], key[sort]
        order[open_] = place
        same = (mine[1:] == mine[:-1]) & (key[1:] == key[:-1])
        ends = np.flatnonzero(np.append(~same, True))
        rank[place] = np.repeat(open_[ends], np.diff(np.concatenate([[-1], ends])))
        open_ = open_[np.append(same, False) | np.concatenate([[False], same])]
        prefix *= 2
    return order


def common_prefixes(raw: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Kasai: length of the common prefix (at most ``most``) of each suffix
    with the one before it in ``order``.  In text order the length falls by
    at most one from place to place; the text is walked in many stretches side
    by side, each from length 0."""
    n = len(raw)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([raw, np.zeros(most + 8, np.uint8)])
    word = np.zeros(n + most, np.uint64)
    for i in range(8):
        word |= padded[i : i + n + most].astype(np.uint64) << np.uint64(8 * i)
    stretch = 64
    lines = -(-n // stretch)
    held = np.zeros(lines, np.int64)
    out = np.zeros(n, np.int64)
    for step in range(stretch):
        place = np.arange(lines) * stretch + step
        place = place[place < n]
        held = np.maximum(held[: len(place)] - 1, 0)
        other = before[place]
        # A suffix ends with the text: no match beyond it.
        room = np.where(other < 0, 0, np.minimum(most, n - np.maximum(place, other)))
        held = np.minimum(held, room)
        going = np.flatnonzero(held < room)
        while len(going):
            differ = word[place[going] + held[going]] ^ word[other[going] + held[going]]
            low = differ & (~differ + np.uint64(1))  # lowest bit that differs
            equal = np.where(differ == 0, 8, np.frexp(low.astype(np.float64))[1].astype(np.int64) - 1 >> 3)
            held[going] = np.minimum(held[going] + equal, room[going])
            going = going[(equal == 8) & (held[going] < room[going])]
        out[place] = held
    return out[order]


class Shard:
    """The parts of a shard, one behind the other in document order."""

    def __init__(self, table: pa.Table, copies: pa.Table, length: int = LENGTH):
        if copies.num_rows:
            known = set(zip(copies.column("doc_id").to_pylist(), copies.column("h").to_pylist()))
            table = table.filter(pa.array([k not in known for k in zip(table.column("doc_id").to_pylist(), table.column("h").to_pylist())], pa.bool_()))
        table = table.sort_by([("doc_id", "ascending"), ("h", "ascending"), ("at", "ascending")])
        names = [table.column(c).to_numpy() for c in ("doc_id", "h", "at")]
        if table.num_rows > 1:  # a repeated row is the same document
            again = np.logical_and.reduce([x[1:] == x[:-1] for x in names])
            table = table.filter(pa.array(np.append(True, ~again)))
        texts = table.column("part").to_pylist()
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        self.doc, self.h, self.at = (table.column(c).to_numpy() for c in ("doc_id", "h", "at"))
        size = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(size) - size
        # Windows that start in a part and end in it; the overlap is the next part's.
        count = np.clip(size - length + 1, 0, PART)
        self.valid = np.zeros(len(self.raw), bool)
        for b, c in zip(self.begin.tolist(), count.tolist()):
            self.valid[b : b + c] = True

    def where(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc_id, h, start in the document) of places."""
        i = np.searchsorted(self.begin, place, "right") - 1
        # Empty parts share their begin with the next one: the last is meant.
        return self.doc[i], self.h[i], place - self.begin[i] + self.at[i]


def runs(places: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) of runs of neighbouring places; ``breaks``: a value per
    place, a change of which ends a run."""
    if not len(places):
        return places, places
    edge = places[1:] != places[:-1] + 1
    if breaks is not None:
        edge |= breaks[1:] != breaks[:-1]
    first = np.flatnonzero(np.concatenate([[True], edge]))
    return places[first], np.diff(np.append(first, len(places)))


def repeated_in_shard(raw: np.ndarray, first: np.ndarray, last: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(candidates, is_first): window starts of the runs first..last, sorted,
    and which of them no earlier window of the shard equals."""
    size = last - first + 1
    candidates = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    # The stretches that hold the candidates, one behind the other.
    cover = np.zeros(len(raw) + 1, np.int32)
    np.add.at(cover, first, 1)
    np.add.at(cover, last + length, -1)
    inside = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    compact = raw[inside]
    mark = np.zeros(len(raw), bool)
    mark[candidates] = True
    is_candidate = mark[inside]
    order = suffix_array(compact)
    lcp = common_prefixes(compact, order, length)
    # Only candidates are compared; between two of them the least prefix counts.
    chosen = np.flatnonzero(is_candidate[order])
    least = np.minimum.reduceat(lcp[: chosen[-1] + 1], np.concatenate([[0], chosen[:-1] + 1])) if len(chosen) else lcp[:0]
    group = np.cumsum(least < length)
    place = inside[order[chosen]]
    earliest = np.full(int(group[-1]) + 1 if len(group) else 0, len(raw), np.int64)
    np.minimum.at(earliest, group, place)
    is_first = np.zeros(len(raw), bool)
    is_first[earliest[earliest < len(raw)]] = True
    return candidates, is_first[candidates]


def merge_runs(shards: list[np.ndarray], key: np.ndarray, owner: np.ndarray, same) -> np.ndarray:
    """Which windows an earlier window of another shard equals.  shards: the
    windows of each shard; key: hash of each window; owner: rank of each by
    (document, start); same(i, j): whether the bytes are equal."""
    beaten = np.zeros(len(key), bool)
    line = [s[np.argsort(key[s], kind="stable")] for s in shards]
    while len(line) > 1:
        merged = []
        for a, b in zip(line[::2], line[1::2]):
            at = np.searchsorted(key[a], key[b])
            hit = np.flatnonzero((at < len(a)) & (key[a][np.minimum(at, len(a) - 1)] == key[b]))
            i, j = a[at[hit]], b[hit]
            equal = same(i, j)
            hit, i, j = hit[equal], i[equal], j[equal]
            wins = owner[i] < owner[j]
            beaten[j[wins]] = True
            beaten[i[~wins]] = True
            a = a.copy()
            a[at[hit]] = np.where(wins, i, j)
            left = np.ones(len(b), bool)
            left[hit] = False
            merged.append(np.insert(a, at[left], b[left]))
        line = merged + line[len(line) // 2 * 2 :]
    return beaten


def base(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(MISSING)).alias("doc_id"), text.alias("text")).withColumn("h", F.xxhash64("text"))


def places_of(rows: DataFrame, size: Column, count: int) -> DataFrame:
    """``rows`` for every part of their texts: at (its begin) and shard."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(size - 1, F.lit(0)).cast("long"), F.lit(PART).cast("long")))
    return rows.withColumn("at", starts).withColumn("shard", F.pmod(F.xxhash64("doc_id", "h", "at"), F.lit(count)).cast("int"))


def parts_of(rows: DataFrame, count: int) -> DataFrame:
    """shard, doc_id, h, at, part: overlapping parts of the texts."""
    size = F.octet_length("text")
    return places_of(rows.where(size >= LENGTH), size, count).select(
        "shard", "doc_id", "h", "at", F.substring("text", (F.col("at") + 1).cast("int"), F.lit(PART + LENGTH - 1)).alias("part")
    )


def copies_of(rows: DataFrame) -> DataFrame:
    """doc_id, h, n (bytes) of texts of a window or more that a document
    before has too."""
    texts = written(rows.where(F.octet_length("text") >= LENGTH).select("doc_id", "h", F.octet_length("text").cast("long").alias("n"), F.md5("text").alias("md5")), "md5")
    # One row per text that occurs again; equal (doc_id, text) rows are one document.
    first = texts.groupBy("md5").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("md5", "first")
    return texts.join(written(first, "copied"), "md5").where("doc_id > first").select("doc_id", "h", "n").distinct()


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(doc_id, h, start, size): byte spans to remove, possibly overlapping."""
    count = max(1, -(-total_bytes(rows) // (SHARD_MB * MB)))
    parts = parts_of(rows, count).repartition(partitions(count), "shard")

    # Copies go to the shards of their parts.
    gone = written(copies_of(rows), "copies")
    copies = places_of(gone, F.col("n"), count).select("shard", "doc_id", "h").repartition(partitions(count), "shard")

    def list_anchors(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        shard = Shard(left, right)
        values, n = np.unique(anchors(shard.raw, shard.valid)[0], return_counts=True)
        return pa.table({"shard": pa.array(np.full(len(values), key[0].as_py()), pa.int32()), "anchor": pa.array(values.view(np.int64)), "many": pa.array(n > 1)})

    listed = parts.groupBy("shard").cogroup(copies.groupBy("shard")).applyInArrow(list_anchors, "shard int, anchor long, many boolean")
    # A shard lists an anchor once, so no anchor has more rows than there are shards.
    alike = W.partitionBy("anchor")
    shared = (
        listed.withColumn("shards", F.count("*").over(alike))
        .where(F.col("many") | (F.col("shards") > 1))
        .select("shard", "anchor", (F.col("shards") > 1).alias("cross"))
    )
    told = shared.unionByName(copies, allowMissingColumns=True)

    def in_shard(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return FOUND.empty_table()
        of_copy = right.column("doc_id").is_valid()
        shard, right = Shard(left, right.filter(of_copy)), right.filter(pc.invert(of_copy))
        if not right.num_rows:
            return FOUND.empty_table()
        h, first, last = anchors(shard.raw, shard.valid)
        known = right.column("anchor").to_numpy().view(np.uint64)
        sort = np.argsort(known)
        known, cross = known[sort], right.column("cross").to_numpy(zero_copy_only=False)[sort]
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        take = np.flatnonzero(known[at] == h)
        h, first, last, cross = h[take], first[take], last[take], cross[at[take]]
        candidates, is_first = repeated_in_shard(shard.raw, first, last)
        out = []
        # Removed here: merged spans of windows that an earlier one equals.
        # Windows of different documents are never neighbours: each document
        # ends with places where no window starts.
        gone, n = runs(candidates[~is_first])
        doc, text, start = shard.where(gone)
        out.append(pa.table({"shard": np.full(len(gone), key[0].as_py(), np.int32), "anchor": np.zeros(len(gone), np.int64), "doc_id": doc, "h": text, "start": start, "n": n, "bytes": pa.nulls(len(gone), pa.binary())}, schema=FOUND))
        # For the merge: runs of first windows with one anchor that others have.
        owner = np.repeat(np.arange(len(h)), last - first + 1)
        send = is_first & cross[owner]
        begin, n = runs(candidates[send], owner[send])
        source = owner[np.searchsorted(candidates, begin)]
        doc, text, start = shard.where(begin)
        whole = shard.raw.tobytes()
        context = [whole[b : b + k + LENGTH - 1] for b, k in zip(begin.tolist(), n.tolist())]
        out.append(pa.table({"shard": np.full(len(begin), key[0].as_py(), np.int32), "anchor": h[source].view(np.int64), "doc_id": doc, "h": text, "start": start, "n": n, "bytes": pa.array(context, pa.binary())}, schema=FOUND))
        return pa.concat_tables(out)

    found = written(
        parts.groupBy("shard").cogroup(told.repartition(partitions(count), "shard").groupBy("shard")).applyInArrow(in_shard, "shard int, anchor long, doc_id long, h long, start long, n long, bytes binary"),
        "repeats",
    )

    def across(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("h", "ascending"), ("start", "ascending")])
        raw = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
        n = table.column("n").to_numpy()
        begin = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
        row = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        place = begin[row] + step
        key = np.concatenate([rolled(raw[a : a + BLOCK + LENGTH - 1], LENGTH) for a in range(0, max(1, len(raw) - LENGTH + 1), BLOCK)])[place]

        windows = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)

        def same(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = np.ones(len(i), bool)
            for a in range(0, len(i), 1 << 14):
                s = slice(a, a + (1 << 14))
                out[s] = (windows[place[i[s]]] == windows[place[j[s]]]).all(1)
            return out

        shard = table.column("shard").to_numpy()[row]
        by_shard = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[by_shard])) + 1
        # Rows are in document order, windows in row order: that is the rank.
        beaten = np.flatnonzero(merge_runs(np.split(by_shard, cuts), key, np.arange(len(row)), same))
        first, size = runs(beaten, row[beaten])
        source = row[first]
        return pa.table(
            {"doc_id": table.column("doc_id").to_numpy()[source], "h": table.column("h").to_numpy()[source], "start": table.column("start").to_numpy()[source] + step[first], "size": size + LENGTH - 1}
        )

    met = found.where(F.col("bytes").isNotNull()).withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(count)).cast("int"))
    merged = met.repartition(partitions(count), "bucket").groupBy("bucket").applyInArrow(across, "doc_id long, h long, start long, size long")
    local = found.where(F.col("bytes").isNull()).select("doc_id", "h", "start", (F.col("n") + (LENGTH - 1)).alias("size"))
    whole = gone.select("doc_id", "h", F.lit(0).cast("long").alias("start"), F.col("n").alias("size"))
    return local.union(merged).union(whole)


FOUND = pa.schema([("shard", pa.int32()), ("anchor", pa.int64()), ("doc_id", pa.int64()), ("h", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary())])


def joined(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint (start, end) spans that cover the same bytes; spans that touch
    are one."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + size)[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]])) if len(start) else np.zeros(0, np.int64)
    return start[first], end[np.append(first[1:], len(end)) - 1] if len(start) else end


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with the byte spans to remove: starts, sizes (null: none)."""
    rows = base(docs)
    spans = repeated_spans(rows).groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    spans = written(spans.select("doc_id", "h", F.col("spans.start").alias("starts"), F.col("spans.size").alias("sizes")), "spans")
    spans = spans.toDF("span_doc", "span_h", "starts", "sizes")
    names = [c for c in docs.columns if c not in spans.columns]
    doc, h = F.coalesce(F.col("doc_id").cast("long"), F.lit(MISSING)), F.xxhash64(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return docs.select(*names).join(spans, (doc == F.col("span_doc")) & (h == F.col("span_h")), "left").select(*names, "starts", "sizes")


def kept_bytes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    edges = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def span_arrays(starts: list[int] | None, sizes: list[int] | None) -> tuple[np.ndarray, np.ndarray]:
    return joined(np.array(starts or [], np.int64), np.array(sizes or [], np.int64))


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed, n_spans of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for doc, text, starts, sizes in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    a, b = span_arrays(starts, sizes)
                    kept = kept_bytes(text, a, b) if len(a) else text
                    rows.append({"doc_id": doc, "kept": kept, "n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": len(a)})
                yield pa.RecordBatch.from_pylist(rows, schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return with_spans(rows).mapInArrow(tidy(run), "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def whole_characters(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without the bytes of characters that they hold in part only."""
    raw = np.frombuffer(text + b"  ", np.uint8)
    inner = (raw & 0xC0) == 0x80  # continuation bytes
    for _ in range(3):
        starts = starts + (inner[starts] & (starts < ends))
        ends = ends - (inner[ends] & (ends > starts))
    return starts, ends


def cut_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated strings cut out of text, to whole
    characters, and the column n_removed (bytes); null texts stay null."""
    names = [c for c in docs.columns if c not in ("starts", "sizes", "n_removed")]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField("n_removed", T.LongType())])
    at_text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, removed = [], []
                for text, starts, sizes in zip(*(part.column(i).to_pylist() for i in (at_text, len(names), len(names) + 1))):
                    removed.append(0)
                    if starts:
                        raw = text.encode()
                        a, b = whole_characters(raw, *span_arrays(starts, sizes))
                        text = kept_bytes(raw, a, b).decode()
                        removed[-1] = int((b - a).sum())
                    texts.append(text)
                columns = list(part.columns[: len(names)])
                columns[at_text] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int64())], [*names, "n_removed"])

    return with_spans(docs.select(*names)).mapInArrow(tidy(run), schema)


def digests(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
