"""Word hashes of a batch of texts, computed on the batch's bytes at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_PUNCT = b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20)
#: A random number per byte, and the base of the polynomial hash (odd).
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _CHUNK), _powers(_INVERSE, _CHUNK)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_terms(data: np.ndarray, powers: np.ndarray) -> np.ndarray:
    out = _BYTE[data]
    for at in range(0, len(out), _CHUNK):
        out[at:at + _CHUNK] *= powers[:len(out) - at]
    return out


def hashed_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte past the last, hash) of every word of a buffer
    that ends in white space.  Hashes are odd, and so never 0."""
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    first, last = edge[0::2], edge[1::2]
    # Sums of byte * base^(position in its chunk); words that cross a chunk
    # are hashed one by one.
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_byte_terms(data, _UP))))
    out = (sums[last] - sums[first]) * _DOWN[first % _CHUNK]
    for i in np.flatnonzero(first // _CHUNK != (last - 1) // _CHUNK):
        value = 0
        for b in data[first[i]:last[i]][::-1].tolist():
            value = (value * _BASE + int(_BYTE[b])) & 0xFFFFFFFFFFFFFFFF
        out[i] = value
    return first, last, mixed(out + (last - first).astype(np.uint64) * _STEP) | np.uint64(1)


def word_hashes(texts: Sequence[str | None], lower: bool = True, punctuation: bool = False
                ) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, odd and so never 0; words of each text).

    Words are runs of other than [\\x20\\x09-\\x0D]; by default lower-cased
    and without ASCII punctuation.  A word hashes alike in every text.
    """
    raw = []
    for t in texts:
        t = t or ""
        b = (t.lower() if lower else t).encode("utf-8", "surrogatepass")
        raw.append(b if punctuation else b.translate(None, _PUNCT))
    first, _, out = hashed_words(np.frombuffer(b"\n".join(raw) + b"\n", np.uint8))
    ends = np.cumsum([len(b) + 1 for b in raw])
    count = np.diff(np.searchsorted(first, ends), prepend=0) if len(raw) else np.zeros(0, np.int64)
    return out, count
