"""Suffix array by induced sorting, and common prefixes in text order.

The steps are those of the sequential method: classify suffixes as larger (L)
or smaller (S) than their right neighbour, sort the leftmost-smaller (LMS)
substrings by one induction, name them, sort the shorter string of names by the
same function, and induce the full order from it. Each scan runs in blocks: a
block of the array ends before the first place that its own entries fill, so
all its entries are known when it is read and numpy can move it at once.
"""

from __future__ import annotations

import numpy as np

_FIRST_BLOCK = 1024


def _ranks_within(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order of ``keys``, the sorted keys, and the rank of each of them among equals."""
    place = np.arange(len(keys))
    tagged = (keys.astype(np.int64) << 32) | place  # unique, so any sort is stable
    tagged.sort()
    sorted_keys = tagged >> 32
    first = place.copy()
    first[1:][sorted_keys[1:] == sorted_keys[:-1]] = 0
    np.maximum.accumulate(first, out=first)
    return tagged & 0xFFFFFFFF, sorted_keys, place - first


def _scan(text: np.ndarray, wanted: np.ndarray, order: np.ndarray, edge: np.ndarray, step: int) -> None:
    """Fill ``order`` with the suffixes of type ``wanted`` that entries already there induce.

    ``step`` is 1 for the scan to the right (L suffixes from bucket heads) and -1 for the one
    to the left (S from tails). ``edge`` holds, per symbol, the next free place in its direction.
    """
    order = order[::step]
    n, at, size = len(order), 0, _FIRST_BLOCK
    while at < n:
        stop = min(at + size, n)
        block = order[at:stop]
        seen = (block > 0).nonzero()[0]
        before = block[seen] - 1
        kept = wanted[before]
        before = before[kept]
        if not len(before):
            at = stop
            size *= 2
            continue
        symbols = text[before]
        sort, sorted_symbols, rank = _ranks_within(symbols)
        place = np.empty(len(before), np.int64)
        place[sort] = edge[sorted_symbols] + rank
        first = int(place.min())
        if first < stop:  # entries from there on may still be filled by this block
            known = int(seen[kept].searchsorted(first - at))
            before, place, symbols = before[:known], place[:known], symbols[:known]
            size = max(64, 2 * (first - at))
            stop = first
        else:
            size *= 2
        order[place] = before
        edge[symbols] = place + 1  # in the order of the block: the last of a symbol stays
        at = stop


def _induce(text: np.ndarray, smaller: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Order of all suffixes, from the LMS suffixes in the order of ``seeds``."""
    n = len(text)
    order = np.full(n, -1, np.int32)
    back = seeds[::-1]
    sort, symbols, rank = _ranks_within(text[back])
    order[ends[symbols] - rank] = back[sort]
    _scan(text, ~smaller, order, starts.copy(), 1)
    keep = order[0]
    order[(order >= 0) & smaller[order]] = -1  # the seeds were only a means
    order[0] = keep
    _scan(text, smaller, order, n - 1 - ends, -1)
    order[0] = n - 1
    return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text``, whose last symbol must be its only and smallest one (0)."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32)
    # S where the next differing symbol is larger; runs take the type of their end.
    differs = np.flatnonzero(text[1:] != text[:-1])
    run_type = text[differs] < text[differs + 1]
    smaller = np.empty(n, bool)
    smaller[: differs[-1] + 1] = np.repeat(run_type, np.diff(np.concatenate(([-1], differs))))
    smaller[differs[-1] + 1 :] = True
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    counts = np.bincount(text)
    ends = np.cumsum(counts) - 1
    starts = ends - counts + 1
    order = _induce(text, smaller, starts, ends, leftmost)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    ranked = order[is_leftmost[order]]
    names = _names(text, leftmost, is_leftmost, ranked)
    if names[-1] + 1 < len(ranked):
        by_position = np.empty(n, np.int64)
        by_position[ranked] = names
        ranked = leftmost[suffix_array(by_position[leftmost])]
    return _induce(text, smaller, starts, ends, ranked)


def _names(text: np.ndarray, leftmost: np.ndarray, is_leftmost: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Number of each LMS substring in sorted order; equal substrings share one."""
    length = np.empty(len(text), np.int64)
    length[leftmost] = np.diff(np.append(leftmost, len(text) - 1)) + 1
    a, b = ranked[:-1].astype(np.int64), ranked[1:].astype(np.int64)
    differ = length[a] != length[b]
    open_ = np.flatnonzero(~differ)
    depth = 0
    while len(open_):
        unlike = text[a[open_] + depth] != text[b[open_] + depth]
        differ[open_[unlike]] = True
        depth += 1
        open_ = open_[~unlike]
        open_ = open_[length[a[open_]] > depth]
    return np.concatenate(([0], np.cumsum(differ)))


def permuted_lcp(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix, in text order, with the one before it in ``order``.

    Only a suffix whose left symbol differs from its neighbour's is compared;
    the value falls by one per step to the right up to the next such suffix.
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = n - 1
    compared = np.ones(n, bool)
    compared[1:] = text[:-1] != text[before[1:] - 1]
    compared[1:] |= before[1:] == 0
    compared[order[0]] = True
    at = np.flatnonzero(compared)
    known = np.zeros(len(at), np.int64)
    wide = np.zeros(n + 8, np.uint16)
    wide[:n] = text
    words = np.ndarray((n + 5,), "<u8", wide.tobytes(), strides=(2,))
    open_ = np.flatnonzero(at != before[at])
    while len(open_):
        i, j = at[open_] + known[open_], before[at[open_]] + known[open_]
        odd = words[i] ^ words[j]
        same = (odd == 0) & (np.maximum(i, j) + 4 <= n)
        low = odd[~same]
        for bits in (16, 32, 48):
            known[open_[~same]] += (low & np.uint64((1 << bits) - 1)) == 0
        known[open_[same]] += 4
        open_ = open_[same]
    last = np.maximum.accumulate(np.where(compared, np.arange(n), 0))
    full = np.zeros(n, np.int64)
    full[at] = known
    return full[last] - (np.arange(n) - last)
