"""Encoding of texts through a bounded cache of the pieces between spaces."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces one generation of the cache holds, and bytes of them and their ids; two
#: generations are kept. Longer pieces, as of texts without spaces, are not kept.
CACHE_PIECES = 200_000
CACHE_BYTES = 16_000_000
LONGEST_PIECE = 64


class PieceCache:
    """Ids of pieces, forgotten by generation so that memory stays bounded.

    The younger generation takes every piece used; when it is full it becomes the
    older one, and what the older one held and nobody asked for since goes.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[list[int]]], limit: int = CACHE_PIECES, most_bytes: int = CACHE_BYTES):
        self._encode, self._limit, self._most_bytes = encode, limit, most_bytes
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._held = 0

    def ids(self, pieces: list[str]) -> list[bytes]:
        """The 32-bit ids of each piece."""
        young, old = self._young, self._old
        found = list(map(young.get, pieces))
        missing = []
        for at in [at for at, ids in enumerate(found) if ids is None]:
            ids = found[at] = old.get(pieces[at])
            if ids is None:
                missing.append(at)
            else:
                young[pieces[at]] = ids
                self._held += len(pieces[at]) + len(ids)
        if missing:
            new = [pieces[at] for at in missing]
            for at, piece, ids in zip(missing, new, self._encode(new)):
                ids = found[at] = array("i", ids).tobytes()
                if len(piece) <= LONGEST_PIECE:
                    young[piece] = ids
                    self._held += len(piece) + len(ids)
        if len(young) >= self._limit or self._held >= self._most_bytes:
            self._old, self._young, self._held = young, {}, 0
        return found


def encode_texts(texts: pa.Array, cache: PieceCache, lead: str = "") -> pa.ListArray:
    """The ids of every text, from the ids of its pieces between spaces.

    ``lead`` is put before every piece but the first of a text: "" where the
    tokenizer drops spaces, " " where a space belongs to the word after it.
    """
    pieces = pc.split_pattern(texts, " ")
    bounds = pieces.offsets.to_numpy()
    coded = pieces.values.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    words = coded.dictionary.to_pylist()
    if lead:
        first = np.zeros(len(codes) + 1, np.int64)
        first[bounds[:-1]] = 1
        codes = codes * 2 + first[:-1]
        present = np.flatnonzero(np.bincount(codes, minlength=2 * len(words)))
        words = [words[c >> 1] if c & 1 else lead + words[c >> 1] for c in present.tolist()]
        place = np.zeros(2 * len(coded.dictionary), np.int64)
        place[present] = np.arange(len(present))
        codes = place[codes]
    ids = cache.ids(words)
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), np.intc)
    starts = np.cumsum(lengths) - lengths
    return pa.ListArray.from_arrays(
        pa.array(_bounds(lengths[codes], bounds), pa.int32()), pa.array(_gather(flat, starts[codes], lengths[codes]))
    )


def _bounds(lengths: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))[pieces]


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + length]`` one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


def printable_bytes() -> list[str]:
    """The character that byte-level vocabularies write for each byte.

    Printable Latin-1 bytes stand for themselves, the others for the characters from
    code point 256 on, in order.
    """
    kept = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]
