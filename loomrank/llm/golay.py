"""Fuzzy hash keys from the perfect binary Golay code (23, 12, 7), vectorised over arrays of words.

Every word of 23 bits lies within 3 bits of exactly one of the 4096 codewords. Besides that one, a word at distance 3 has
five codewords at distance 4, a nearer word none. The index of a codeword is its 12 message bits. All tables are worked
out below from the generator polynomial.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (fixed value).
GENERATOR = 0b110001110101
LENGTH, CHECKS = 23, 11


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


def _tables() -> tuple[np.ndarray, ...]:
    unit = [_remainder(1 << i) for i in range(LENGTH)]
    low, high = np.zeros(1 << CHECKS, dtype=np.uint32), np.zeros(1 << (LENGTH - CHECKS), dtype=np.uint32)
    for table, first in ((low, 0), (high, CHECKS)):
        for i in range(1, len(table)):
            top = i.bit_length() - 1
            table[i] = table[i ^ (1 << top)] ^ unit[first + top]
    leader, size = np.zeros(1 << CHECKS, dtype=np.uint32), np.ones(1 << CHECKS, dtype=np.int64)
    others: list[list[int]] = [[] for _ in range(1 << CHECKS)]
    for weight in range(1, 5):
        for spots in combinations(range(LENGTH), weight):
            error = sum(1 << i for i in spots)
            syndrome = 0
            for i in spots:
                syndrome ^= unit[i]
            if weight < 4:
                leader[syndrome] = error
            else:
                others[syndrome].append(error)
    errors = np.zeros((1 << CHECKS, 6), dtype=np.uint32)
    errors[:, 0] = leader
    for s, found in enumerate(others):
        size[s] = 1 + len(found)
        errors[s, 1 : 1 + len(found)] = found
    return low, high, errors, size


LOW, HIGH, ERRORS, SIZE = _tables()


def near(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords within 4 bits of each word, the nearest first: a matrix of 6 columns, and how many hold."""
    words = words.astype(np.uint32)
    syndrome = LOW[words & np.uint32((1 << CHECKS) - 1)] ^ HIGH[words >> np.uint32(CHECKS)]
    return ((words[:, None] ^ ERRORS[syndrome]) >> np.uint32(CHECKS)).astype(np.int64), SIZE[syndrome]


def products(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """All combinations of one key from each part for every word: the word's row, and a column of keys for each part."""
    n = len(parts[0][1])
    counts = np.prod([size for _, size in parts], axis=0)
    rows = np.repeat(np.arange(n), counts)
    rest = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    columns = []
    for keys, size in parts:
        which = rest % size[rows]
        rest = rest // size[rows]
        columns.append(keys[rows, which])
    return rows, columns
