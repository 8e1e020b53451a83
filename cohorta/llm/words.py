"""Words of whole text columns as 64-bit hashes, vectorised over UTF-8 bytes.

A word is a run of ASCII letters, digits and bytes of non-ASCII characters; A-Z count as a-z.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BYTES = np.arange(256)
FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IS_WORD = (
    ((_BYTES >= 48) & (_BYTES <= 57)) | ((FOLD >= 97) & (FOLD <= 122)) | (_BYTES >= 128)
)
PIECE = 1 << 21  # bytes hashed at a time: the arrays stay small and in cache
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits (in place)."""
    h ^= h >> np.uint64(30)
    h *= _MIX
    h ^= h >> np.uint64(27)
    h *= _MIX2
    h ^= h >> np.uint64(31)
    return h


@dataclass
class Words:
    """Words of a block of texts: hash, first byte and end byte of each, and where each text begins."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def _piece_hashes(blob: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each [start, end) of the blob; all bytes between are not used."""
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    inner = np.arange(total, dtype=np.int64) - np.repeat(before, lengths)
    at = inner + np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _ODD, np.uint64))
    terms = (FOLD[blob[at]].astype(np.uint64) + np.uint64(1)) * powers[inner]
    return mix(np.add.reduceat(terms, before))


def find_words(blob: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts that lie back to back in the blob; no word crosses two texts."""
    starts_all, ends_all, hashes = [], [], []
    first = np.zeros(len(blob) + 1, bool)
    first[offsets] = True
    at = 0
    while at < len(blob):
        stop = min(len(blob), at + PIECE)
        while stop < len(blob) and IS_WORD[blob[stop - 1]] and IS_WORD[blob[stop]] and not first[stop]:
            stop += 1
        inside = IS_WORD[blob[at:stop]]
        head = inside.copy()
        head[1:] &= ~inside[:-1] | first[at + 1 : stop]
        tail = inside.copy()
        tail[:-1] &= ~inside[1:] | first[at + 1 : stop]
        starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
        if len(starts):
            hashes.append(_piece_hashes(blob[at:stop], starts, ends))
            starts_all.append(starts + at)
            ends_all.append(ends + at)
        at = stop
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    starts, ends = join(starts_all, np.int64), join(ends_all, np.int64)
    return Words(join(hashes, np.uint64), starts, ends, np.searchsorted(starts, offsets))
