"""Simple-8b words: a 4-bit selector and up to 60 bits of equally wide ids, in independent blocks.

Selector 0 is an escape: the next word is one raw 64-bit id (an id of 2**60 or more).  Selector 1 is a run of up to
120 zeros.  Selectors 2 to 15 hold a fixed count of ids of a fixed width.  A block is cut after `BLOCK` ids, starts at
a word boundary and its last word may be partly filled, so each block decodes on its own and all of them at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
#: (ids in a word, bits of an id) of selectors 1 to 15: fixed values of the coding.
WIDTHS = ((120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = np.array([1, *(c for c, _ in WIDTHS)], dtype=np.int64)
BITS = np.array([64, *(b for _, b in WIDTHS)], dtype=np.int64)


def bit_lengths(ids: np.ndarray) -> np.ndarray:
    """Exact bit lengths of uint64 values."""
    if ids.max(initial=0) < 2**53:
        return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    high = ids >> np.uint64(32)
    low = np.frexp((ids & np.uint64(2**32 - 1)).astype(np.float64))[1]
    return np.where(high > 0, 32 + np.frexp(high.astype(np.float64))[1], low).astype(np.uint8)


def choose(bits: np.ndarray, block: int) -> np.ndarray:
    """For each position the selector of the word that would start there, up to the block's end."""
    n = len(bits)
    rows = -(-n // block)
    table = np.zeros((rows, block), np.uint8)
    table.reshape(-1)[:n] = bits
    best = np.zeros((rows, block), np.uint8)

    def wider(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
        """The greater of x here and y k places ahead; beyond the block's end there is nothing."""
        out = x.copy()
        if k < block:
            np.maximum(x[:, :-k], y[:, k:], out=out[:, :-k])
        return out

    span = {1: table}  # span[k][i]: most bits in ids i .. i + k - 1 of the block
    k = 1
    while k < 64:
        span[2 * k] = wider(span[k], span[k], k)
        k *= 2
    for selector in range(15, 0, -1):  # denser words overwrite sparser ones
        count, width = WIDTHS[selector - 1]
        power = 1 << (count.bit_length() - 1)
        most = span[power] if power == count else wider(span[power], span[power], count - power)
        np.copyto(best, np.uint8(selector), where=most <= width)
    return best.reshape(-1)[:n]


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, for each block the number of its first word)."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    best = choose(bit_lengths(ids), block)
    begin = np.arange(0, n, block)
    end = np.minimum(begin + block, n)
    after = np.arange(n) + COUNTS[best]
    starts, at = np.zeros(n, bool), begin
    while len(at):  # one word of every block at a time
        starts[at] = True
        at = after[at]
        inside = at < end
        at, end = at[inside], end[inside]
    first = np.flatnonzero(starts)
    owner = first // block
    chosen = best[first]
    held = np.diff(first, append=n)  # the last word of a block may hold fewer than its selector allows
    shift = (np.arange(n) - np.repeat(first, held)) * np.repeat(BITS[chosen], held)
    body = np.bitwise_or.reduceat(ids << shift.astype(np.uint64), first)
    size = 1 + (chosen == 0)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    escaped = chosen == 0
    words[place] = (chosen.astype(np.uint64) << np.uint64(60)) | np.where(escaped, np.uint64(0), body)
    words[place[escaped] + 1] = ids[first[escaped]]
    heads = np.searchsorted(owner, np.arange(len(begin)))
    return words, place[heads].astype(np.int32)


def decode(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n ids of all blocks, decoded together."""
    if not n:
        return np.zeros(0, np.uint64)
    words = np.asarray(words, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    escapes = np.flatnonzero(selector == 0)
    if len(escapes):  # a raw word may look like an escape itself: walk runs of them
        last = -2
        for i in escapes.tolist():
            if i == last + 1:
                continue
            raw[i + 1] = True
            last = i
        head = np.flatnonzero(~raw)
    else:
        head = np.arange(len(words))
    kind = selector[head]
    owner = np.searchsorted(offsets, head, side="right") - 1
    total = np.cumsum(COUNTS[kind]) - COUNTS[kind]
    first_of_block = np.searchsorted(owner, np.arange(len(offsets)))
    at = owner * block + total - total[first_of_block][owner]
    held = np.diff(at, append=n)
    shift = (np.arange(n) - np.repeat(at, held)) * np.repeat(BITS[kind], held)
    mask = (np.uint64(1) << np.minimum(BITS[kind], 60).astype(np.uint64)) - np.uint64(1)
    out = (np.repeat(words[head], held) >> shift.astype(np.uint64)) & np.repeat(mask, held)
    out[at[kind == 0]] = words[head[kind == 0] + 1]
    return out
