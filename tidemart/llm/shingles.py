"""Word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

#: The white space between words, and ASCII capitals to small letters.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all of them."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n or more powers of the base, and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        both = [np.full(size, b, dtype=np.uint64) for b in (_BASE, _BASE_INVERSE)]
        for x in both:
            x[0] = 1
        _POWERS[:] = [np.cumprod(x, dtype=np.uint64) for x in both]
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with A-Z lower-cased, text after text, and where each text's words begin (and the last end)."""
    joined = b"\n".join(texts).translate(_LOWER)
    data = np.frombuffer(joined, dtype=np.uint8)
    gap = _SPACE[data]
    edge = np.diff(np.concatenate([[True], gap, [True]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    powers, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    return hashes, np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Each text's distinct shingles of ``width`` words, sorted. With fewer words, all of them as one; with none, empty."""
    hashes, bounds = word_hashes(texts)
    salts = mix(np.arange(1, width + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    rows = max(len(hashes) - width + 1, 0)
    rolled = np.zeros(rows, dtype=np.uint64)
    for i in range(width):
        rolled += hashes[i : i + rows] * salts[i]
    rolled = mix(rolled)
    sets = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        n = end - start
        if n >= width:
            sets.append(np.unique(rolled[start : end - width + 1]))
        elif n:
            sets.append(mix((hashes[start:end] * salts[:n]).sum(keepdims=True) + np.uint64(n)))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return sets
