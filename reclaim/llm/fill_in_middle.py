"""Operator 13: fill-in-middle transformation with a wavelet matrix.

Every code point of a text has a class (``CLASSES``); the class sequence is
held as a wavelet matrix: one packed bit vector with a rank directory for each
bit of the class.  A unit ends behind each character of the unit's classes
(``UNITS``), so the rank queries of these classes, added up, count the units
that end before a position.  That count over the whole text gives the number of
units; bisection on it finds the place of a cut.

Both cuts are drawn from a hash of seed and doc_id: behind the smaller and the
larger of ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units.  A text is left plain if
it is empty, holds a sentinel, or ``h3 % 100 >= rate``; else the order is
suffix-prefix-middle if ``h4 % 100 < spm_rate`` and prefix-suffix-middle
otherwise.  ``restored`` gives the text back from output and form.

Texts are taken in chunks of at most ``CHUNK`` code points (short ones
together, long ones in slices), so the matrices of a task hold half a byte for
each code point of the documents at work.

Cases: null text is empty text (plain, no units); a null doc_id is hashed as
the empty string; equal and repeated rows have equal results; a text without a
unit's end is one unit; texts of any length are cut whole; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, tidy

OTHER, BLANK, NEWLINE, STOP = range(4)
CLASSES = {BLANK: " \t\x0b\x0c\r", NEWLINE: "\n", STOP: ".!?。！？"}
# Unit -> classes behind whose characters it ends.
UNITS = {"char": (OTHER, BLANK, NEWLINE, STOP), "word": (BLANK, NEWLINE), "sentence": (NEWLINE, STOP), "line": (NEWLINE,)}
SENTINELS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
CHUNK = 1 << 20  # code points of one matrix
STEP = 256  # documents held at once
PLAIN, PSM, SPM = "plain", "psm", "spm"


class Bits:
    """A packed bit vector with a rank directory."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(packed.tobytes() + bytes(16 - len(packed) % 8), "<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones in front of each position."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank queries on a sequence of small classes."""

    def __init__(self, classes: np.ndarray, levels: int = 2):
        self.levels: list[Bits] = []
        for level in reversed(range(levels)):
            bit = (classes >> level & 1).astype(bool)
            self.levels.append(Bits(bit))
            classes = np.concatenate([classes[~bit], classes[bit]])

    def rank(self, kind: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Occurrences of a class in [start, end)."""
        for i, bits in enumerate(self.levels):
            a, b = bits.rank(start), bits.rank(end)
            if kind >> len(self.levels) - 1 - i & 1:
                start, end = bits.zeros + a, bits.zeros + b
            else:
                start, end = start - a, end - b
        return end - start

    def boundaries(self, kinds: tuple[int, ...], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return sum(self.rank(kind, start, end) for kind in kinds)

    def reach(self, kinds: tuple[int, ...], start: np.ndarray, end: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Smallest position with ``count`` (at least 1, at most all)
        boundaries since ``start``, by bisection on the ranks."""
        low, high = start + 1, end.copy()
        while (open_ := low < high).any():
            middle = low + high >> 1
            enough = self.boundaries(kinds, start, middle) >= count
            high, low = np.where(open_ & enough, middle, high), np.where(open_ & ~enough, middle + 1, low)
        return low


def class_table() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    for kind, characters in CLASSES.items():
        out[[ord(c) for c in characters]] = kind
    return out


class Cutter:
    """Unit counts and cut positions of some texts."""

    def __init__(self, texts: list[str], kinds: tuple[int, ...], table: np.ndarray, chunk: int = CHUNK):
        self.kinds, self.texts = kinds, texts
        self.matrices: list[WaveletMatrix] = []
        doc, matrix, start, end, base = [], [], [], [], []
        held, size = [], 0

        def close() -> None:
            nonlocal held, size
            if held:
                points = np.frombuffer("".join(held).encode("utf-32-le"), np.uint32)
                self.matrices.append(WaveletMatrix(table[points]))
                held, size = [], 0

        for i, text in enumerate(texts):
            for at in range(0, len(text), chunk):
                part = text[at : at + chunk]
                if size + len(part) > chunk:
                    close()
                doc.append(i)
                matrix.append(len(self.matrices))
                start.append(size)
                base.append(at)
                held.append(part)
                size += len(part)
                end.append(size)
        close()
        self.doc, self.matrix, self.start, self.end, self.base = (np.array(x, np.int64) for x in (doc, matrix, start, end, base))
        found = np.zeros(len(doc), np.int64)
        for m, wavelet in enumerate(self.matrices):
            rows = np.flatnonzero(self.matrix == m)
            found[rows] = wavelet.boundaries(kinds, self.start[rows], self.end[rows])
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))  # first slice of each text
        self.reached = np.concatenate([[0], np.cumsum(found)])  # boundaries in front of each slice
        self.ends = self.reached[self.first[1:]] - self.reached[self.first[:-1]]
        last = np.array([table[ord(t[-1])] if t else -1 for t in texts], np.int64)
        self.n = self.ends + ((last >= 0) & ~np.isin(last, kinds))

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Position behind so many units of each text."""
        out = np.array([len(t) for t in self.texts], np.int64)
        out[units == 0] = 0
        rows = np.flatnonzero((units > 0) & (units <= self.ends))
        goal = self.reached[self.first[rows]] + units[rows]
        piece = np.searchsorted(self.reached, goal) - 1  # the slice that reaches the goal
        for m in np.unique(self.matrix[piece]).tolist():
            here = np.flatnonzero(self.matrix[piece] == m)
            p = piece[here]
            found = self.matrices[m].reach(self.kinds, self.start[p], self.end[p], goal[here] - self.reached[p])
            out[rows[here]] = found - self.start[p] + self.base[p]
        return out


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(h[:8], 16), int(h[8:16], 16), int(h[16:24], 16), int(h[24:32], 16)


def transform(docs: DataFrame, unit: str = "line", rate: int = 100, spm_rate: int = 50, seed: int = 7, sentinels: tuple[str, str, str] = SENTINELS, chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars,
    middle_chars (null if plain) and the output text."""
    kinds, (pre, suf, mid) = UNITS[unit], sentinels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                cutter = Cutter(texts, kinds, table, chunk)
                h = np.array([draws(seed, i) for i in ids], np.int64)
                k = h[:, :2] % (cutter.n[:, None] + 1)
                first, second = cutter.cut(k.min(1)).tolist(), cutter.cut(k.max(1)).tolist()
                rows = []
                for text, a, b, (_, _, h3, h4) in zip(texts, first, second, h.tolist()):
                    if not text or any(s in text for s in sentinels) or h3 % 100 >= rate:
                        rows.append((PLAIN, None, None, text))
                    elif h4 % 100 < spm_rate:
                        rows.append((SPM, a, b - a, f"{suf}{text[b:]}{pre}{text[:a]}{mid}{text[a:b]}"))
                    else:
                        rows.append((PSM, a, b - a, f"{pre}{text[:a]}{suf}{text[b:]}{mid}{text[a:b]}"))
                form, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(cutter.n), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        tidy(run), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text, from output and form alone.  No sentinel begins with
    another one's end, so the joints make no sentinel of their own."""
    pre, suf, mid = (re.escape(s) for s in sentinels)
    psm = F.split(F.substring(output, len(sentinels[0]) + 1, 1 << 30), f"{suf}|{mid}", -1)
    spm = F.split(F.substring(output, len(sentinels[1]) + 1, 1 << 30), f"{pre}|{mid}", -1)
    return (
        F.when(F.col(form) == PSM, F.concat(psm[0], psm[2], psm[1]))
        .when(F.col(form) == SPM, F.concat(spm[1], spm[2], spm[0]))
        .otherwise(F.col(output))
    )


def digests(docs: DataFrame) -> DataFrame:
    """The digest columns of ``transform`` with its defaults."""
    return transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )


# Lines by splitting at the newline; a list of lines is joined again for each
# part.  With k of n units, the cut lies behind the k-th newline, or at the end.
SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS p,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), u AS (
  SELECT *, CASE WHEN text = '' THEN 0 WHEN p[-1] = '' THEN len(p) - 1 ELSE len(p) END AS n,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS k1, greatest(h1 % (n + 1), h2 % (n + 1)) AS k2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), s AS (
  SELECT doc_id, text, n, form,
         CASE WHEN k1 = n THEN text WHEN k1 = 0 THEN '' ELSE array_to_string(p[1:k1], chr(10)) || chr(10) END AS prefix,
         CASE WHEN k2 = n THEN text WHEN k2 = 0 THEN '' ELSE array_to_string(p[1:k2], chr(10)) || chr(10) END AS upto
  FROM c
), o AS (
  SELECT doc_id, n, form, text, length(prefix) AS a, length(upto) AS b, prefix,
         substr(text, length(prefix) + 1, length(upto) - length(prefix)) AS middle, substr(text, length(upto) + 1) AS suffix
  FROM s
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM o
"""
