"""Operator 1: pack token ids into fixed windows by non-negative least squares over shallow length combinations.

Each task packs its own documents, block by block, so nothing is shuffled, memory is bounded by the block, and a
lost task is simply run again.  In a block:

1. every document gives its full windows away as sequences of their own; what is left is shorter than a window;
2. the remainders are counted in a histogram on a grid (128 bins for a window of 2048 and a grid of 16);
3. all combinations of at most `depth` bins that fill the window exactly are enumerated, and NNLS finds how often to
   repeat each so that the histogram is used up;
4. repeats are rounded down and filled with real remainders; the slack that the grid leaves in such a sequence, and
   whatever documents no combination took, are packed greedily, longest first, from one stream that may be cut.

What the stream has left at the end of a block opens the next block; at the end of the task it is cut into
sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import tokens, work

#: Ids that a task holds before it packs them.
BLOCK_IDS = 8_000_000
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


@lru_cache(maxsize=4)
def combinations(bins: int, depth: int) -> np.ndarray:
    """Rows: multisets of at most `depth` (1 to 3) bins that sum to `bins`, unused places 0."""
    rows = [(bins, 0, 0)]
    if depth >= 2:
        rows += [(bins - b, b, 0) for b in range(1, bins // 2 + 1)]
    if depth >= 3:
        rows += [(bins - b - c, b, c) for c in range(1, bins // 3 + 1) for b in range(c, (bins - c) // 2 + 1)]
    return np.array(rows, dtype=np.int64)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Lawson and Hanson's active-set method for min |a x - b| with x >= 0.

    Should `rounds` not be enough, the x so far is returned: it is as valid, and what it leaves over joins the residuals.
    """
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).sum()))
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[passive] = -np.inf
        best = int(np.argmax(gain))
        if not gain[best] > tolerance:
            break
        passive[best] = True
        while True:
            on = np.flatnonzero(passive)
            z = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if (z > 0).all():
                break
            low = z <= 0
            old = x[on]
            step = np.min(old[low] / np.maximum(old[low] - z[low], 1e-300))
            x[on] = old + step * (z - old)
            drop = on[low & (x[on] <= 1e-12)]
            if not len(drop):
                drop = on[[int(np.argmin(np.where(low, x[on], np.inf)))]]
            x[drop], passive[drop] = 0, False
            if not passive.any():
                return x
        x[:] = 0
        x[on] = z
    return x


def repeats(histogram: np.ndarray, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination, whole repeats) that never use more of a bin than the histogram holds.  histogram[0] is unused."""
    bins = len(histogram) - 1
    combos = combinations(bins, depth)
    usable = ((combos == 0) | (histogram[combos] > 0)).all(axis=1)
    combos = combos[usable]
    if not len(combos):
        return []
    a = np.zeros((bins + 1, len(combos)))
    for place in range(combos.shape[1]):
        np.add.at(a, (combos[:, place], np.arange(len(combos))), combos[:, place] > 0)
    x = nnls(a, histogram.astype(float))
    left, out = histogram.copy(), []
    for i in np.argsort(-x, kind="stable"):
        combo = [int(v) for v in combos[i] if v]
        need = {v: combo.count(v) for v in combo}
        times = min([int(x[i] + 1e-6), *(int(left[v]) // k for v, k in need.items())])
        if times > 0:
            out.append((tuple(combo), times))
            for v, k in need.items():
                left[v] -= k * times
    return out


class Packer:
    """Packs the documents of one task; `add` and `close` give pieces (key, start, length, sequence, offset)."""

    def __init__(self, window: int, depth: int, grid: int):
        self.window, self.depth, self.grid = window, depth, grid
        self.stream: list[tuple[int, int, int]] = []  # open pieces: key, start, length
        self.sequences = 0

    def _next(self) -> int:
        self.sequences += 1
        return self.sequences - 1

    def pack(self, lengths: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
        """lengths: (key, ids) of the block's documents."""
        window, bins = self.window, self.window // self.grid
        queues: list[list[tuple[int, int, int]]] = [[] for _ in range(bins + 1)]
        for key, n in lengths:
            full = n // window
            for k in range(full):
                yield key, k * window, window, self._next(), 0
            if rest := n - full * window:
                queues[-(-rest // self.grid)].append((key, full * window, rest))
        built = []
        for combo, times in repeats(np.array([len(q) for q in queues]), self.depth):
            for _ in range(times):
                built.append([queues[v].pop() for v in combo])
        loose = [p for q in reversed(queues) for p in q]
        have = sum(p[2] for p in loose) + sum(p[2] for p in self.stream)
        slack = [window - sum(p[2] for p in s) for s in built]
        need = sum(slack)
        while need > have:  # too little to fill the slack: give one sequence back
            need -= slack.pop()
            loose += (back := built.pop())
            have += sum(p[2] for p in back)
        self.stream += loose
        self.stream.reverse()  # taken from the end
        for own, gap in zip(built, slack, strict=True):
            at, sequence = 0, self._next()
            for key, start, n in own:
                yield key, start, n, sequence, at
                at += n
            yield from self._fill(sequence, at, gap)
        left = have - need
        while left >= window:
            yield from self._fill(self._next(), 0, window)
            left -= window
        self.stream.reverse()

    def _fill(self, sequence: int, at: int, n: int) -> Iterator[tuple[int, int, int, int, int]]:
        """Take n ids from the end of the stream; the last piece may be cut."""
        while n:
            key, start, have = self.stream.pop()
            take = min(n, have)
            yield key, start, take, sequence, at
            if take < have:
                self.stream.append((key, start + take, have - take))
            at += take
            n -= take

    def close(self) -> Iterator[tuple[int, int, int, int, int]]:
        left = sum(p[2] for p in self.stream)
        self.stream.reverse()
        while left:
            size = 1 << (left.bit_length() - 1)
            yield from self._fill(self._next(), 0, size)
            left -= size


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    window: int = 2048,
    depth: int = 3,
    grid: int = 16,
    block_ids: int = BLOCK_IDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian u32).

    A null or empty text has `end_id` only.  Repeated rows are packed once each; a null id is kept.  Very long texts are
    encoded in slices and cut over as many sequences as they fill.  Other columns are ignored.  `window` must be a power of two and `grid` divide it.  An empty table gives no rows.
    """
    if window & (window - 1) or window % grid or not 1 <= depth <= 3:
        raise ValueError("window must be a power of two, grid divide it, and depth be 1, 2 or 3")
    work.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokenizer_path)
        base = TaskContext.get().partitionId() << 40
        packer = Packer(window, depth, grid)
        held: dict[int, tuple[int | None, np.ndarray]] = {}  # by running number: doc_id and ids
        fresh: list[tuple[int, int]] = []
        count = total = 0
        schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")), ("ids", pa.binary())])

        def rows(pieces: Iterator[tuple[int, int, int, int, int]]) -> Iterator[pa.RecordBatch]:
            out: list[list] = [[] for _ in schema]
            for key, start, n, sequence, at in pieces:
                doc, ids = held[key]
                data = ids[start : start + n].astype("<u4").tobytes()
                for column, value in zip(out, (doc, start, n, len(ids), base + sequence, at, data), strict=True):
                    column.append(value)
                if len(out[0]) == 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
                    out = [[] for _ in schema]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in work.slices(texts, tokens.SLICE_CHARS):
                ids, size = encode.encode(texts[a:b], end_id)
                for doc, own in zip(keys[a:b], np.split(ids, np.cumsum(size)[:-1]), strict=True):
                    held[count] = (doc, own)
                    fresh.append((count, len(own)))
                    count += 1
                total += len(ids)
                if total >= block_ids:
                    yield from rows(packer.pack(fresh))
                    open_keys = {p[0] for p in packer.stream}
                    held = {k: (doc, own.copy()) for k, (doc, own) in held.items() if k in open_keys}
                    fresh, total = [], 0
        if fresh:
            yield from rows(packer.pack(fresh))
        yield from rows(packer.close())

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The digest columns of pieces: ids_crc32 in place of ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
