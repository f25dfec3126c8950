"""Sets of five-word shingles as sorted 64-bit hashes, for blocks of texts at once."""

from __future__ import annotations

import functools

import numpy as np

WORDS = 5
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_FACTORS = (np.arange(1, WORDS + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)) | _U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the row it is in; words never cross rows."""
    data = _LOWER[data]
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    stops = np.flatnonzero(np.concatenate((~inside | first, [True])))
    ends = stops[np.searchsorted(stops, starts + 1)]
    up, down = _powers(1 << max(16, int(len(data) - 1).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + _U(1)) * up[: len(data)])))
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def by_row_and_hash(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The order by row, then hash: a fast sort of the hashes, then a stable one of few row numbers."""
    if len(row) and row.max() >= 1 << 16:
        return np.lexsort((hashes, row))
    order = np.argsort(hashes)
    return order[np.argsort(row.astype(np.uint16)[order], kind="stable")]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles sorted by row and hash, number per row).

    A row of fewer than five words has its whole sequence as its one shingle; a
    row without words has none.
    """
    words, row = word_hashes(data, offsets)
    rows = len(offsets) - 1
    per_row = np.bincount(row, minlength=rows)
    longest = max(0, len(words) - WORDS + 1)
    whole = np.zeros(longest, np.uint64)
    for j in range(WORDS):
        whole += words[j : j + longest] * _FACTORS[j]
    fits = row[:longest] == row[WORDS - 1 :] if longest else np.zeros(0, bool)
    first = np.concatenate(([0], np.cumsum(per_row)))
    short = np.flatnonzero((per_row > 0) & (per_row < WORDS))
    sums = np.zeros(len(short), np.uint64)
    for j in range(WORDS - 1):
        has = per_row[short] > j
        sums[has] += words[first[short[has]] + j] * _FACTORS[j]
    sums += per_row[short].astype(np.uint64) * _U(0x94D049BB133111EB)
    hashes = mixed(np.concatenate((whole[fits], sums)))
    of = np.concatenate((row[:longest][fits], short)).astype(np.int32)
    order = by_row_and_hash(of, hashes)
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.bincount(of[new], minlength=rows)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0
