"""Word shingles of whole texts as 64-bit numbers, in numpy.

Words are the runs without ASCII white space, with A-Z in lower case. A word's number is a sum
of its bytes times random odd factors by position; a shingle's number mixes those of its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5
_SPAN = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number through a bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _stream(n: int, seed: int) -> np.ndarray:
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(steps + np.uint64(seed)) | np.uint64(1)


_FACTORS = _stream(256, 11)
_PLACES = _stream(64, 12)


def _factors(n: int) -> np.ndarray:
    global _FACTORS
    if n > len(_FACTORS):
        _FACTORS = _stream(max(n, 2 * len(_FACTORS)), 11)
    return _FACTORS


def _word_numbers(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, first byte) of each word; ``starts``: offsets at which a new text begins."""
    at = np.flatnonzero(~_WHITE[data])
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    fresh = np.empty(len(at), bool)
    fresh[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=fresh[1:])
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    fresh |= edge[at]
    first = np.flatnonzero(fresh)
    sizes = np.diff(np.append(first, len(at)))
    within = np.arange(len(at)) - np.repeat(first, sizes)
    values = _LOWER[data[at]].astype(np.uint64)
    values += np.uint64(1)
    values *= _factors(int(sizes.max()))[within]
    return mixed(np.add.reduceat(values, first) + sizes.astype(np.uint64)), at[first]


def word_numbers(texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all words, number of words of each text); a null has none."""
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, body = texts.buffers()
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    data, ends = data[ends[0] : ends[-1]], ends - ends[0]
    numbers, firsts, start = [], [], 0
    while start < len(data):
        stop = min(start + _SPAN, len(data))
        while stop < len(data):  # cut between words
            gaps = np.flatnonzero(_WHITE[data[start:stop]])
            if len(gaps):
                stop = start + int(gaps[-1]) + 1
                break
            stop = min(start + 2 * (stop - start), len(data))
        inner = ends[(ends >= start) & (ends < stop)] - start
        number, first = _word_numbers(data[start:stop], inner)
        numbers.append(number)
        firsts.append(first + start)
        start = stop
    if not numbers:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    counts = np.diff(np.searchsorted(np.concatenate(firsts), ends))
    return np.concatenate(numbers), counts


def shingle_sets(texts: pa.BinaryArray, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingles of each text.

    Fewer words than ``width`` make one shingle of them all; no word, none.
    """
    words, counts = word_numbers(texts)
    ends = np.concatenate(([0], np.cumsum(counts)))
    n = max(0, len(words) - width + 1)
    runs = np.zeros(n, np.uint64)
    for j in range(width):
        runs += words[j : j + n] * _PLACES[j]
    runs = mixed(runs)
    sets = []
    for i, count in enumerate(counts.tolist()):
        start = int(ends[i])
        if count >= width:
            sets.append(np.unique(runs[start : start + count - width + 1]))
        elif count:
            part = words[start : start + count] * _PLACES[8 : 8 + count]
            sets.append(mixed(np.array([part.sum(dtype=np.uint64) + np.uint64(count)], np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
