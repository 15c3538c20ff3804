"""Operator 8: best-two-fit packing of tokenized documents into sequences.

A document is its byte-level BPE ids and an end id.  Documents of more than
``limit`` tokens are cut: the first piece takes the remainder, all later ones
are full.  Pieces are written once with their checksums and counted; they are
dealt to shards of about ``SHARD`` pieces by a hash that also takes their place
in that table, so the number of shards follows the pieces, and neither one long
document nor rows with one id or text fill a shard.  A shard is packed by best-two-fit: open a sequence with the longest piece left,
fill the gap greedily with the longest piece that fits, then replace the
sequence's smallest piece by two unpacked pieces whose sum fills the gap and
the freed place more tightly, as long as such a pair exists and the gap is
over ``SLACK`` tokens.

Token ids come from the vocabulary of the given tokenizer file; its merge
order must equal its id order (checked), so that merging by rank gives the
same ids as merging by the file's merge list.  Strings of its added tokens in a
text are these tokens, as in the file's own library.

Cases: null or empty text is a piece with the end id alone; texts of any
length are cut whole; equal documents and repeated rows are packed one by one
(ties by doc_id, piece and checksum); rows with a null doc_id are packed like others;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_worker, partitions, text_or_empty, tidy, written

LIMIT = 1024
END_ID = 2
SHARD = 4096
SLACK = 4  # tokens of a gap that stay open: a pair of short pieces is worth more
STEP = 256  # documents whose pieces are held at once
# Fixed value: the split pattern of byte-level BPE vocabularies of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that such files write for each byte: printable
    Latin-1 bytes stand for themselves, the rest count up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(tokenizer_json: bytes):
    """Encoding function with the ids of the given byte-level BPE file."""
    import tiktoken

    spec = json.loads(tokenizer_json)
    pre, model = spec["pre_tokenizer"], spec["model"]
    if spec["normalizer"] or (pre["type"], pre["add_prefix_space"], pre["use_regex"]) != ("ByteLevel", False, True) or model["type"] != "BPE":
        raise ValueError("a plain byte-level BPE file is needed")
    letters, special = byte_letters(), {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added tokens must stand for their own letters only")
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    joined = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if joined != list(range(256, 256 + len(joined))) or len(vocab) != 256 + len(joined):
        raise ValueError("merge order and id order differ")
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
    enc = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        return enc.encode(text, allowed_special="all") if any(t in text for t in special) else enc.encode_ordinary(text)

    return encode


def cut(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = n % limit or min(n, limit)
    return [(0, first), *((s, limit) for s in range(first, n, limit))]


def pieces(docs: DataFrame, tokenizer_json: bytes, limit: int = LIMIT, end_id: int = END_ID, checksums: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids; with
    ``checksums`` ids_crc32 instead of ids, the checksum of their
    little-endian bytes (so that ids need not leave the worker)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = in_worker(("byte-bpe", zlib.crc32(tokenizer_json)), lambda: encoder(tokenizer_json))
        end = np.array([end_id], "<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                rows, ids, sums = [], [], []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own = np.append(np.asarray(encode(text), "<u4"), end)
                    places = cut(len(own), limit)
                    rows += [(doc, k, s, n) for k, (s, n) in enumerate(places)]
                    if checksums:
                        raw = own.tobytes()
                        sums += [zlib.crc32(raw[4 * s : 4 * (s + n)]) for s, n in places]
                    else:
                        ids.append(own)
                doc, piece, start, length = zip(*rows)
                head = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
                if checksums:
                    yield pa.RecordBatch.from_arrays([*head, pa.array(sums, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])
                else:
                    ends = np.concatenate([[0], np.cumsum(length)])
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*head, lists], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        tidy(run), "doc_id long, piece int, start long, length long, " + ("ids_crc32 long" if checksums else "ids array<int>")
    )


def two_fit(lengths: list[int], limit: int = LIMIT, slack: int = SLACK) -> tuple[list[int], list[int]]:
    """(sequence, offset) of each piece, sequences numbered from 0."""
    waiting: dict[int, list[int]] = {}
    for i in reversed(range(len(lengths))):
        waiting.setdefault(lengths[i], []).append(i)
    left = sorted(waiting)  # distinct lengths still waiting

    def take(n: int) -> int:
        i = waiting[n].pop()
        if not waiting[n]:
            del waiting[n]
            left.remove(n)
        return i

    def best_pair(room: int, more_than: int) -> tuple[int, int] | None:
        best, pair = more_than, None
        low, high = 0, bisect_right(left, room) - 1
        while low <= high:
            total = left[low] + left[high]
            if total > room:
                high -= 1
            else:
                if total > best and (low < high or len(waiting[left[low]]) > 1):
                    best, pair = total, (left[low], left[high])
                    if best == room:
                        break
                low += 1
        return pair

    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    number = 0
    while left:
        held = [take(left[-1])]
        gap = limit - lengths[held[0]]
        while left and left[0] <= gap:
            n = left[bisect_right(left, gap) - 1]
            held.append(take(n))
            gap -= n
        while gap > slack and len(held) > 1:
            out = held[-1]  # filled longest first: the last is the smallest
            pair = best_pair(gap + lengths[out], lengths[out])
            if pair is None:
                break
            held.pop()
            gap += lengths[out] - sum(pair)
            held += [take(n) for n in pair[::-1]]
            if lengths[out] in waiting:
                waiting[lengths[out]].append(out)
            else:
                waiting[lengths[out]] = [out]
                insort(left, lengths[out])
            held.sort(key=lambda i: -lengths[i])
        at = 0
        for i in held:
            sequence[i], offset[i] = number, at
            at += lengths[i]
        number += 1
    return sequence, offset


def pack(parts: DataFrame, limit: int = LIMIT, shard: int = SHARD) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ids_crc32,
    ...)."""
    columns = parts.columns
    parts = written(parts.withColumn("place", F.monotonically_increasing_id()), "pieces")
    count = max(1, -(-parts.count() // shard))
    dealt = parts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "place"), F.lit(count))).drop("place")
    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")])
        sequence, offset = two_fit(table.column("length").to_pylist(), limit)
        first = table.column("shard")[0].as_py() << 32
        return table.select(columns).append_column("sequence_id", pa.array([first + s for s in sequence], pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", sequence_id long, offset long"
    return dealt.repartition(partitions(count), "shard").groupBy("shard").applyInArrow(run, schema)


def packed(docs: DataFrame, tokenizer_json: bytes, limit: int = LIMIT, end_id: int = END_ID, shard: int = SHARD) -> DataFrame:
    """Tokenize, cut and pack documents; one row per piece with ids_crc32."""
    return pack(pieces(docs, tokenizer_json, limit, end_id, checksums=True), limit, shard)
