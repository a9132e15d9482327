"""Hashes of word shingles for batches of texts."""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
#: Fixed value: the words of a text stand between these bytes.
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = odd_numbers(SHINGLE_WORDS, 5)


def mixed(h: np.ndarray) -> np.ndarray:
    """The bits of 64-bit hashes spread over all places."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _word_hashes(text: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a row of texts, and each text's bounds among them."""
    n = len(text)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    solid = ~_SPACE[text]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[first] = solid[first]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    spans = np.diff(np.append(starts, n))
    place = np.arange(starts[0], n) - np.repeat(starts, spans)
    powers = np.ones(int(place.max()) + 1, np.uint64)
    powers[1:] = _BASE
    np.cumprod(powers, out=powers)
    values = powers[place] * (text[starts[0]:].astype(np.uint64) + np.uint64(1))
    values[~solid[starts[0]:]] = 0
    return mixed(np.add.reduceat(values, starts - starts[0])), np.searchsorted(starts, bounds)


def shingle_sets(text: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, in order.

    ``text`` is the bytes of all texts in a row, ``bounds`` where each begins and
    ends. A text of one to four words is one shingle; one without words has none.
    """
    words, ends = _word_hashes(text, bounds)
    padded = np.concatenate((words, np.zeros(SHINGLE_WORDS, np.uint64)))
    n = len(words)
    hashes = np.zeros(n, np.uint64)
    for place, factor in enumerate(_PLACES):
        hashes += padded[place:place + n] * factor
    sets = []
    for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if end - begin >= SHINGLE_WORDS:
            sets.append(np.unique(mixed(hashes[begin:end - SHINGLE_WORDS + 1])))
        elif end > begin:
            sets.append(mixed((words[begin:end] * _PLACES[:end - begin]).sum(keepdims=True)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
