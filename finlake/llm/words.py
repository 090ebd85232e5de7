"""Word and hash helpers on UTF-8 bytes (numpy inside tasks).

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, after
lower-casing A-Z.  ``bytes.lower`` and ``bytes.split`` do exactly that, and
UTF-8 continuation bytes are never ASCII, so no character is cut.
"""

from __future__ import annotations

import numpy as np
import xxhash

_hash = xxhash.xxh3_64_intdigest
_U = np.uint64


def words(text: str | None) -> list[bytes]:
    return [] if not text else text.encode("utf-8", "surrogatepass").lower().split()


def hash_words(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hash, ws), dtype=np.uint64, count=len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles; fewer words:
    the whole sequence as one shingle; no words: empty."""
    h = hash_words(words(text))
    n = len(h)
    if n == 0:
        return h
    w = min(k, n)
    total = np.full(n - w + 1, _U(w))
    for i in range(w):
        total = mix(total * _U(0x9E3779B97F4A7C15) + h[i:n - w + 1 + i])
    return np.unique(total)
