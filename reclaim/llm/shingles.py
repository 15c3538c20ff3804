"""Distinct word shingles of texts as sorted 64-bit hashes, by numpy.

Words are runs of bytes other than space and 0x09-0x0D of the text with A-Z in
lower case.  A text of fewer than ``n`` words has its whole word sequence as
its one shingle; without words the set is empty.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20  # bytes hashed at a time
_random = np.random.default_rng(20240)
BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9FB21C651E98DF25)
STEP = [np.uint64(x) for x in _random.integers(1, 1 << 62, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _block_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of a block of bytes."""
    inside = ~BLANK[raw]
    at = np.flatnonzero(inside)
    if not len(at):
        return at, np.zeros(0, np.uint64)
    edge = np.empty(len(at), bool)
    edge[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=edge[1:])
    first = np.flatnonzero(edge)
    size = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, size)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(size.max()) - 1, BASE)]).astype(np.uint64))
    return at[first], mix(np.add.reduceat(BYTE[LOWER[raw[at]]] * power[place], first) + size.astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and where each text's words end."""
    joined = np.frombuffer(b" ".join(texts), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts, hashes = [], []
    at = 0
    while at < len(joined):
        stop = min(len(joined), at + BLOCK)
        if stop < len(joined):
            # Cut behind the last blank; a longer word is hashed whole.
            blank = np.flatnonzero(BLANK[joined[at:stop]])
            while not len(blank) and stop < len(joined):
                stop = min(len(joined), stop + BLOCK)
                blank = np.flatnonzero(BLANK[joined[at:stop]])
            stop = at + int(blank[-1]) + 1 if len(blank) and stop < len(joined) else stop
        s, h = _block_words(joined[at:stop])
        starts.append(s + at)
        hashes.append(h)
        at = stop
    if not starts:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), ends)


def shingle_sets(texts: list[bytes], n: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    word, ends = word_hashes(texts)
    rolled = np.zeros(0, np.uint64)
    if len(word) >= n:
        m = len(word) - n + 1
        rolled = np.full(m, np.uint64(n))
        for i in range(n):
            rolled = rolled * STEP[0] + word[i : i + m] * STEP[1]
        rolled = mix(rolled)
    out, start = [], 0
    for end in ends.tolist():
        count = end - start
        if count >= n:
            out.append(np.unique(rolled[start : end - n + 1]))
        elif count:
            h = np.array([count], np.uint64)
            for i in range(start, end):
                h = h * STEP[0] + word[i : i + 1] * STEP[1]
            out.append(mix(h))
        else:
            out.append(np.zeros(0, np.uint64))
        start = end
    return out


def batches_of(texts: list[bytes], size: int = BLOCK) -> list[tuple[int, int]]:
    """(from, to) ranges of texts of about ``size`` bytes."""
    out, start, held = [], 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            out.append((start, i + 1))
            start, held = i + 1, 0
    return out + ([(start, len(texts))] if start < len(texts) else [])
