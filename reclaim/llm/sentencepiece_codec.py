"""Operator 1: SentencePiece encoding and decoding for merge-type vocabularies.

Encoding is a score-ordered agenda of adjacent symbol pairs: all pairs whose
concatenation is a vocabulary piece enter an agenda keyed (score descending,
position ascending); the best pair is merged, its two new neighbours enter.
White space only ever starts a piece of such a vocabulary, so words are
independent and each distinct word is merged once per worker process: the codec
and its cache outlive the tasks.  The cache has two generations of at most half
of ``CACHE_BYTES`` each; a word found in the older one moves to the newer, so
frequent words stay when the older is dropped.
Words met for the first time in a batch are merged together: the agenda of a
short word is one row of a score-rank matrix, whose leftmost minimum is the
next merge; long words use a heap.  Every Arrow batch checks those words
against the sentencepiece library and raises on a difference.

Cases: null text is empty text, empty text has the end id alone, characters
outside the vocabulary become byte pieces, words of any length are merged
whole (no cap), extra columns are ignored, an empty table gives no rows and
repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_worker, text_or_empty, tidy

SPACE = "▁"
CACHE_BYTES = 160 << 20  # of cached words and ids in one worker process
ENTRY = 200  # bytes of a cached word beside its letters and ids
STEP = 512  # documents encoded together
ROW = 32  # longest word merged in a matrix row
NEVER = np.iinfo(np.int32).max


def fields(message: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) pairs of one protocol-buffer message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[i]
            value |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return value, i

    i = 0
    while i < len(message):
        key, i = varint(i)
        kind = key & 7
        if kind == 0:
            value, i = varint(i)
        else:
            size, i = varint(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = message[i : i + size], i + size
        yield key >> 3, value


class Codec:
    """Encoder and decoder of one merge-type (BPE) model with identity
    normalisation."""

    NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

    def __init__(self, model: bytes, cache_bytes: int = CACHE_BYTES):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=model)
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        self.pieces: list[tuple[str, int]] = []
        trainer, normalizer = {}, {}
        for number, value in fields(model):
            if number == 1:
                piece = dict(fields(value))
                text, kind = piece[1].decode(), piece.get(3, self.NORMAL)
                index = len(self.pieces)
                self.pieces.append((text, kind))
                if kind == self.BYTE:
                    self.byte_ids[int(text[1:-1], 16)] = index
                elif kind == self.UNKNOWN:
                    self.unknown = index
                elif kind == self.NORMAL:
                    self.score[text] = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
                    self.ids[text] = index
                elif kind != self.CONTROL:
                    raise ValueError(f"piece {text!r}: user-defined and unused pieces are not supported")
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        if trainer.get(3, 1) != 2 or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1):
            raise ValueError("a merge-type model with identity normalisation and a leading space is needed")
        self.fallback = bool(trainer.get(35, 0))
        self.end = trainer.get(42, 2)
        # A space after another character inside a piece would tie words together.
        self.word = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if all(re.fullmatch(f"{SPACE}*[^{SPACE}]*", p) for p in self.ids) else r"(?s).+")
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cache_bytes, self.held = cache_bytes, 0
        self._pair_table()

    def _pair_table(self) -> None:
        """Hash table (left id, right id) -> (merged id, rank by score)."""
        order = sorted(self.ids, key=lambda p: -self.score[p])
        rank, last = {}, None
        for p in order:
            if last is None or self.score[p] != last:
                last, at = self.score[p], len(rank)
            rank[p] = at
        keys, merged, ranks = [], [], []
        for piece, index in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(index)
                    ranks.append(rank[piece])
        # A character that is no piece itself, but part of one, needs the text agenda.
        self.rows_exact = all(c in self.ids for piece in self.ids for c in piece)
        self.bits = max(4, (4 * len(keys)).bit_length())
        size = 1 << self.bits
        self.pair_key = np.full(size, -1, np.int64)
        self.pair_id = np.zeros(size, np.int32)
        self.pair_rank = np.full(size, NEVER, np.int32)
        slots = self._slot(np.array(keys, np.int64)).tolist()
        for key, slot, index, r in zip(keys, slots, merged, ranks):
            while self.pair_key[slot] != -1:
                slot = (slot + 1) % size
            self.pair_key[slot], self.pair_id[slot], self.pair_rank[slot] = key, index, r
        self.char_id = np.full(0x110000, -1, np.int32)
        for piece, index in self.ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = index

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged id and rank of each pair (rank NEVER: no such piece)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = self._slot(keys)
        found = self.pair_key[slot]
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while open_.size:
            slot[open_] = (slot[open_] + 1) % len(self.pair_key)
            found[open_] = self.pair_key[slot[open_]]
            open_ = open_[(found[open_] != keys[open_]) & (found[open_] != -1)]
        hit = (found == keys) & (left >= 0) & (right >= 0)
        return self.pair_id[slot], np.where(hit, self.pair_rank[slot], NEVER)

    def merge_rows(self, words: list[str], width: int) -> list[bytes]:
        """Ids (int32 bytes) of words of at most ``width`` characters."""
        n = len(words)
        length = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        cells = np.arange(width)[None, :] < length[:, None]
        symbol = np.full((n, width + 1), -1, np.int32)
        symbol[:, :width][cells] = np.where((ids := self.char_id[flat]) >= 0, ids, -2 - flat.astype(np.int32))
        target, rank = self._pairs(symbol[:, :-1].ravel(), symbol[:, 1:].ravel())
        target, rank = target.reshape(n, width), rank.reshape(n, width)
        live = np.arange(n)
        done = symbol.copy()
        columns = np.arange(width)
        while True:
            best = rank.argmin(1)
            rows = np.arange(len(live))
            going = rank[rows, best] != NEVER
            if not going.all():
                done[live[~going]] = symbol[~going]
                live, symbol, rank, target, best = live[going], symbol[going], rank[going], target[going], best[going]
                rows = np.arange(len(live))
            if not len(live):
                break
            new = target[rows, best]
            # Close the gap that the right symbol of the merged pair leaves.
            shift = columns[None, :] + (columns[None, :] > best[:, None])
            symbol[:, :width] = np.take_along_axis(symbol, shift, 1)
            symbol[rows, best] = new
            moved = np.minimum(columns[None, :] + (columns[None, :] >= best[:, None]), width - 1)
            rank, target = np.take_along_axis(rank, moved, 1), np.take_along_axis(target, moved, 1)
            rank[:, width - 1] = NEVER
            target[rows, best], rank[rows, best] = self._pairs(new, symbol[rows, best + 1])
            inner = np.flatnonzero(best)
            b = best[inner]
            target[inner, b - 1], rank[inner, b - 1] = self._pairs(symbol[inner, b - 1], new[inner])
        used = done != -1
        ends = np.cumsum(used.sum(1)).tolist()
        ids = done[used]
        raw = ids.astype(np.int32).tobytes()
        out = [raw[4 * a : 4 * e] for a, e in zip([0, *ends], ends)]
        for i in np.flatnonzero((done < -1).any(1)).tolist():
            out[i] = self._bytes(done[i][used[i]])
        return out

    def _bytes(self, ids: np.ndarray) -> bytes:
        """Ids with unknown characters (-2 - code point) spelled out."""
        out: list[int] = []
        for i in ids.tolist():
            if i >= 0:
                out.append(i)
            elif self.fallback:
                out += [self.byte_ids[b] for b in chr(-2 - i).encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, np.int32).tobytes()

    def merge(self, word: str) -> list[int]:
        """Ids of one word by the agenda."""
        symbols: list[str | None] = list(word)
        n, score, agenda = len(symbols), self.score, []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in score:
                agenda.append((-score[pair], i, i + 1, pair))
        if agenda:
            heapq.heapify(agenda)
            before, after = list(range(-1, n - 1)), list(range(1, n + 1))
            while agenda:
                _, i, j, pair = heapq.heappop(agenda)
                left, right = symbols[i], symbols[j]
                if left is None or right is None or len(left) + len(right) != len(pair):
                    continue
                symbols[i], symbols[j] = pair, None
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    if (wide := pair + symbols[k]) in score:
                        heapq.heappush(agenda, (-score[wide], i, k, wide))
                h = before[i]
                if h >= 0 and (wide := symbols[h] + pair) in score:
                    heapq.heappush(agenda, (-score[wide], h, i, wide))
        out: list[int] = []
        for s in symbols:
            if s is not None:
                if (index := self.ids.get(s)) is not None:
                    out.append(index)
                elif self.fallback:
                    out += [self.byte_ids[b] for b in s.encode()]
                elif not out or out[-1] != self.unknown:
                    out.append(self.unknown)
        return out

    def words(self, text: str) -> list[str]:
        return self.word.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def learn(self, words: set[str]) -> None:
        """Merge words not seen yet and check them against the library."""
        groups: dict[int, list[str]] = {}
        for w in words:
            n = len(w)
            width = 8 if n <= 8 else 12 if n <= 12 else 16 if n <= 16 else ROW if n <= ROW else 0
            groups.setdefault(width if self.rows_exact else 0, []).append(w)
        for width, group in groups.items():
            ids = self.merge_rows(group, width) if width else [np.array(self.merge(w), np.int32).tobytes() for w in group]
            # Of the empty text the library makes nothing, not a lone space.
            theirs = [x or [self.ids.get(SPACE, -1)] for x in self.library.encode([w[1:] for w in group], num_threads=1)]
            same = [4 * len(x) for x in theirs] == [len(x) for x in ids]
            if not same or np.fromiter(chain.from_iterable(theirs), np.int32).tobytes() != b"".join(ids):
                wrong = next(w for w, x, y in zip(group, ids, theirs) if np.array(y, np.int32).tobytes() != x)
                raise ValueError(f"the library encodes {wrong!r} differently")
            self.keep(zip(group, ids))

    def keep(self, found: Iterable[tuple[str, bytes]]) -> None:
        for word, ids in found:
            self.cache[word] = ids
            self.held += ENTRY + 4 * len(word) + len(ids)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        if self.held > self.cache_bytes // 2:
            self.older, self.cache, self.held = self.cache, {}, 0
        split = [self.words(text) for text in texts]
        fresh = set(chain.from_iterable(split)).difference(self.cache)
        if fresh:
            known = fresh.intersection(self.older)
            self.keep((w, self.older[w]) for w in known)
            self.learn(fresh - known if known else fresh)
        end = np.int32(self.end).tobytes()
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(get, words)) + end, np.int32) for words in split]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def encode_decode(docs: DataFrame, model: bytes, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """One row per document: ids (end id last) and the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = in_worker(("sentencepiece", hashlib.sha256(model).digest(), cache_bytes), lambda: Codec(model, cache_bytes))
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                ids = codec.encode_batch(part.column(1).to_pylist())
                ends = np.cumsum([0] + [len(x) for x in ids])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids))),
                        pa.array([codec.decode(x.tolist()) for x in ids], pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        tidy(run), "doc_id long, ids array<int>, decoded string"
    )


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """The digest columns of ``encode_decode``."""
    out = encode_decode(docs, model)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
