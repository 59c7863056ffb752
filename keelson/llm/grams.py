"""Hashed character n-grams of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Odd multipliers of the gram hash, one for each place of a gram.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """(lower-case code point, is a letter) of the 65,536 code points of the first plane."""
    low, letter = np.arange(65536, dtype=np.uint32), np.zeros(65536, dtype=bool)
    for i in range(65536):
        c = chr(i)
        letter[i] = c.isalpha()
        if len(x := c.lower()) == 1:
            low[i] = ord(x)
    return low, letter


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a 0, and the place where each text begins (and the total)."""
    joined = "\0".join([t or "" for t in texts]) + "\0"
    out = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    return out, np.concatenate([[0], np.cumsum(lengths)])


def letters_only(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points with everything but letters as a blank (0 stays), and the mask of letters."""
    low, letter = tables()
    first = points < 65536
    small = np.where(first, points, 0)
    is_letter = np.where(first, letter[small], False)
    for i in np.unique(points[~first]):  # rare planes
        if chr(int(i)).isalpha():
            is_letter |= points == i
    out = np.where(first, low[small], points)
    return np.where(is_letter, out, np.where(points == 0, 0, 32)).astype(np.uint32), is_letter


def hashed(points: np.ndarray, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the gram that begins at each place, whether it lies within one text)."""
    n = len(points) - order + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, bool)
    acc, inside = np.full(n, np.uint64(order)), np.ones(n, dtype=bool)
    for j in range(order):
        part = points[j : j + n]
        acc = (acc ^ (part.astype(np.uint64) + np.uint64(1))) * np.uint64(FACTORS[j])
        acc ^= acc >> np.uint64(29)
        inside &= part != 0
    acc *= np.uint64(FACTORS[0])
    return (acc >> np.uint64(64 - bits)).astype(np.int64), inside


def blocks(points: np.ndarray, order: int, bits: int, step: int = 500_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """`hashed` by blocks of places: (first place, buckets, inside), so that one very long text stays cheap."""
    for at in range(0, max(0, len(points) - order + 1), step):
        yield at, *hashed(points[at : at + step + order - 1], order, bits)


def owners(begins: np.ndarray) -> np.ndarray:
    """The number of the text that each place belongs to."""
    return np.repeat(np.arange(len(begins) - 1), np.diff(begins))
