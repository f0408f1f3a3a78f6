"""Words and word shingles of many texts at once, as numpy arrays.

A word is a longest run of bytes other than space and 0x09-0x0D, unchanged.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

SEPARATORS = (9, 10, 11, 12, 13, 32)
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SEPARATORS)] = False
_STEP = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ROLL = np.uint64(0xD6E8FEB86659FD93)
_LANE_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


class Words(NamedTuple):
    data: np.ndarray   # bytes of all texts, eight zero bytes after them
    start: np.ndarray  # first byte of each word
    end: np.ndarray    # byte after it
    first: np.ndarray  # first word of each text, then the number of words


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x


def find_words(texts: pa.Array) -> Words:
    """The words of each text of a string array without nulls."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.zeros(high - low + 8, np.uint8)
    if high > low:
        data[:-8] = np.frombuffer(texts.buffers()[2], np.uint8, high - low, low)
    offsets = offsets - low
    inside = np.zeros(high - low + 2, bool)
    inside[1:-1] = _IS_WORD[data[:-8]]
    body = inside[1:-1]
    begins = body & ~inside[:-2]
    ends = body & ~inside[2:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < high - low)]
    begins[edge] = body[edge]
    ends[edge - 1] = body[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes, read eight at a time."""
    data, start, length = words.data, words.start, words.end - words.start
    lanes = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    out = mixed(length.astype(np.uint64) * _STEP + np.uint64(seed))
    at, rest, who = start, length, None
    while len(at):
        lane = lanes[at] & _LANE_MASKS[np.minimum(rest, 8)]
        if who is None:
            out = mixed((out ^ lane) * _ROLL)
            who = np.flatnonzero(rest > 8)
        else:
            out[who] = mixed((out[who] ^ lane) * _ROLL)
            keep = rest > 8
            who, at, rest = who[keep], at[keep], rest[keep]
            at, rest = at + 8, rest - 8
            continue
        at, rest = at[who] + 8, rest[who] - 8
    return out


def runs_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 values run out and are left off."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _ROLL
        out += hashes[j:j + n]
    return mixed(out)


def whole_runs(first: np.ndarray, k: int) -> np.ndarray:
    """Which words begin k words of one text: a mask over all words."""
    n = int(first[-1])
    drop = np.zeros(n + 1, np.int32)
    last = first[1:]
    begin = np.maximum(first[:-1], last - (k - 1))
    np.add.at(drop, begin, 1)
    np.add.at(drop, last, -1)
    return np.cumsum(drop[:-1]) == 0


def shingles(words: Words, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(values, first): the k-word shingle hashes of each text in order, repeats included.

    A text of one to k - 1 words has one shingle, all of it; an empty text has none.
    """
    hashes = word_hashes(words, seed)
    first = words.first
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < k))
    rolled = runs_of(hashes, k)
    mask = whole_runs(first, k)[:len(rolled)]
    values = rolled[mask]
    sizes = np.maximum(counts - (k - 1), 0)
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for i, d in enumerate(short):
            value = np.uint64(counts[d])
            for h in hashes[first[d]:first[d + 1]]:
                value = np.uint64((int(value) * int(_ROLL) + int(h)) & 0xFFFFFFFFFFFFFFFF)
            extra[i] = value
        place = np.concatenate([[0], np.cumsum(sizes)])[short]
        values = np.insert(values, place, mixed(extra))
        sizes[short] = 1
    return values, np.concatenate([[0], np.cumsum(sizes)])
