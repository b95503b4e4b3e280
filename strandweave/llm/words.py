"""Words of a chunk of UTF-8 texts as numpy arrays, and their 64-bit names."""

from __future__ import annotations

import numpy as np

from .repeats import mix

U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_FULL = [U((1 << (8 * k)) - 1) for k in range(8)]
_MASKS = np.array([*_FULL, U(0xFFFFFFFFFFFFFFFF)], U)

__all__ = ["lowered", "mix", "word_bounds", "word_names"]


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of all words, in order, and the bounds of the texts among them; no word crosses from text to text."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~_BLANK[data]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    ends = inside[:-1] & ~inside[1:]
    cut = bounds[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begins[cut] |= inside[cut]
    ends[cut - 1] |= inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, bounds)


def word_names(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit name for each word, from its length and its bytes eight at a time."""
    buffer = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", buffer, 0, (1,))
    size = end - start
    names = mix(size.astype(U) + U(0x9E3779B97F4A7C15))
    left, rows, at = size, np.arange(len(start)), start
    while len(rows):
        taken = np.minimum(left, 8)
        names[rows] = mix(names[rows] ^ (eights[at] & _MASKS[taken])) + U(0x9E3779B97F4A7C15)
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return names
