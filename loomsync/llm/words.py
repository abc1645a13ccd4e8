"""Word and shingle hashes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of texts that are hashed at once; bounds the memory of a task.
AT_ONCE = 1 << 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SYMBOL = np.random.default_rng(20250101).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDER = np.random.default_rng(20250102).integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def _portions(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive texts that reach ``AT_ONCE`` bytes with their last one."""
    at = size = 0
    for i, text in enumerate(texts, 1):
        size += len(text) + 1
        if size >= AT_ONCE:
            yield at, i
            at, size = i, 0
    if at < len(texts) or not texts:
        yield at, len(texts)


def word_hashes(texts: list[bytes], separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of the text it comes from."""
    found = [_word_hashes(texts[a:b], separators, a) for a, b in _portions(texts)]
    return np.concatenate([h for h, _ in found]), np.concatenate([o for _, o in found])


def _word_hashes(texts: list[bytes], separators: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    joined = b" ".join(texts) + b" "
    data = np.frombuffer(joined, np.uint8)
    inside = ~separators[data]
    edge = np.diff(np.concatenate(([0], inside.view(np.int8))))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    powers = np.full(len(data), _FACTOR)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SYMBOL[data] * powers, out=total[1:])
    back = np.full(len(data), _INVERSE)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    hashes = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(bounds, starts, side="right") - 1 + first


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``size`` words.

    A text of fewer words has its whole word sequence as the only one, one without words none.
    """
    hashes, owner = word_hashes([t.lower() for t in texts])
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    n = max(0, len(hashes) - size + 1)
    mixed = np.zeros(n, np.uint64)
    for k in range(size):
        mixed += hashes[k : k + n] * _ORDER[k]
    mixed = mix(mixed)
    sets = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a >= size:
            row = np.sort(mixed[a : b - size + 1])
            keep = np.ones(len(row), bool)
            np.not_equal(row[1:], row[:-1], out=keep[1:])
            sets.append(row[keep])
        elif b > a:
            sets.append(np.array([xxhash.xxh3_64_intdigest(hashes[a:b].tobytes())], np.uint64))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
