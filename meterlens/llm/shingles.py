"""Word shingles of a text as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64
#: 64-bit constants of the polynomial word hash and of the final mixing.
BASE = 0x9E3779B97F4A7C15 | 1
SPACE_TABLE = np.zeros(256, bool)
SPACE_TABLE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the output."""
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


BYTE_VALUES = mix64(np.arange(1, 257, dtype=U))
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS = [np.ones(1, U), np.ones(1, U)]


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**i (or its inverse's) modulo 2**64 for i < n, from a table that doubles."""
    table = _POWERS[inverse]
    while len(table) < n:
        step = U(pow(INVERSE if inverse else BASE, len(table), 1 << 64))
        table = np.concatenate([table, table * step])
    _POWERS[inverse] = table
    return table[:n]


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words (runs without ASCII white space), A-Z lower-cased, in order."""
    data = LOWER[data]
    space = SPACE_TABLE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) == 0:
        return np.empty(0, U)
    edge = np.concatenate([[0], edge]) if not space[0] else edge
    starts = edge[0::2]
    if len(starts) == 0:
        return np.empty(0, U)
    ends = edge[1::2]
    if len(ends) < len(starts):
        ends = np.append(ends, len(data))
    terms = BYTE_VALUES[data] * powers(len(data))
    sums = np.concatenate([np.zeros(1, U), np.cumsum(terms, dtype=U)])
    h = (sums[ends] - sums[starts]) * powers(len(data), True)[starts]
    return mix64(h + (ends - starts).astype(U))


def shingle_set(data: np.ndarray, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``words``-word shingles; the whole sequence if shorter."""
    w = word_hashes(data)
    if len(w) == 0:
        return w
    n = min(words, len(w))
    count = len(w) - n + 1
    h = np.full(count, n, U)
    for i in range(n):
        h = h * U(BASE) + w[i : i + count]
    return np.unique(mix64(h))
