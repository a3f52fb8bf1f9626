"""Word shingles as 64-bit fingerprints.

Two different shingles share a fingerprint with probability 2^-64, which is not checked again.
"""

from __future__ import annotations

import numpy as np
import xxhash

from aerolag.llm import caches

SHINGLE_WORDS = 5
#: Words whose hash a worker keeps; hashing one anew is cheap.
HASHES_KEPT = 50_000

#: One odd multiplier for each place in a shingle, and two to mix the sum.
_PLACE = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < HASHES_KEPT:
            self[word] = value
        return value


_hashes = _Hashes()
caches.drops(_hashes.clear)


def _mixed(values: np.ndarray) -> np.ndarray:
    for multiplier in _MIX:
        values = (values ^ (values >> np.uint64(33))) * multiplier
    return values ^ (values >> np.uint64(33))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted fingerprints of the distinct shingles of five words.

    Words are parted by blanks, tabs and line breaks, A-Z taken in lower case. Fewer words than five
    are one shingle; a text without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    length = min(SHINGLE_WORDS, len(words))
    total = np.full(len(words) - length + 1, length, dtype=np.uint64)
    for place in range(length):
        total += hashes[place : len(hashes) - length + 1 + place] * _PLACE[place]
    return np.unique(_mixed(total))


def set_key(fingerprints: np.ndarray) -> int:
    """A 64-bit key of a set, as a signed integer."""
    key = xxhash.xxh64_intdigest(fingerprints.tobytes(), seed=2)
    return key - (1 << 64) if key >= 1 << 63 else key
