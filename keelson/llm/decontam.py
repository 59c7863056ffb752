"""Operator 8: benchmark decontamination with item-sized SimHash windows.

Windows as long as a benchmark item slide over a document wherever the document shares at least one word shingle with
the benchmark (a window that shares none has similarity 0, so none is lost).  Each window's 64-bit SimHash is probed
in a multi-index over the items' fingerprints: 8 blocks of 8 bits, one of which must agree to within radius // 8 bits,
so every fingerprint within the radius is found.  What is within the radius is verified by the exact weighted Jaccard
similarity of the shingles (weight: how often a shingle occurs).

The benchmark is a stated query set.  It is broadcast in blocks whose size is checked.  For a larger benchmark the rows
are numbered and written once; each block is a pass over them that writes the numbers and hits of what it found, and
nothing else, and the hits of all passes are joined to the rows.  Documents are not shuffled unless over a million of
them hold items.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import work

#: Items and characters of one broadcast block of the benchmark.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 20_000_000
#: What a verdict adds to a row.
FOUND = ("contaminated", "item_ids", "similarity", "start_word")
FOUND_DDL = "contaminated boolean, item_ids array<long>, similarity double, start_word long"
_words = re.compile(r"\w+").findall
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def words_of(text: str | None) -> list[str]:
    """Lower-case words; marks and blanks only separate."""
    return _words(text.lower()) if text else []


def mixed(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k values in a row."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc = (acc ^ values[j : j + n]) * _MIX[j % len(_MIX)]
        acc ^= acc >> np.uint64(32)
    acc *= _MIX[0]
    return acc ^ (acc >> np.uint64(29))


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of a hash's 64 bits."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").reshape(-1)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: the sum of the lesser counts over the sum of the greater ones."""
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


class Items:
    """A block of the benchmark, prepared for probing."""

    def __init__(self, rows: list[tuple[int, str | None]], shingle: int, radius: int):
        self.shingle, self.radius = shingle, radius
        self.ids: list[int] = []
        self.vocabulary: dict[str, int] = {}
        self.grams: list[Counter] = []
        prints: list[int] = []
        by_length: dict[int, list[int]] = defaultdict(list)
        seeds: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))  # shingle size -> seed -> window lengths
        for item, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
            words = words_of(text)
            if not words or item is None:
                continue
            k, number = min(shingle, len(words)), len(self.ids)
            numbers = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.uint64)
            for seed in mixed(numbers, k).tolist():
                seeds[k][seed].add(len(words))
            hashes = mixed(word_hashes(words), k)
            self.ids.append(item)
            self.grams.append(Counter(hashes.tolist()))
            prints.append(int(packed(signs(hashes).sum(axis=0, keepdims=True))[0]))
            by_length[len(words)].append(number)
        self.seeds = {k: (np.array(sorted(s), np.uint64), [sorted(s[x]) for x in sorted(s)]) for k, s in seeds.items()}
        self.by_length = {n: np.array(v) for n, v in by_length.items()}
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]) <= radius // 8
        self.prints = np.array(prints, np.uint64)
        self.index = {n: near[self.prints[v].astype("<u8").view(np.uint8).reshape(-1, 8).T].transpose(0, 2, 1) for n, v in self.by_length.items()}  # block x value x item

    def candidates(self, prints: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) with fingerprints within the radius."""
        blocks, items = prints.astype("<u8").view(np.uint8).reshape(-1, 8), self.by_length[length]
        table = self.index[length]
        hit = table[0][blocks[:, 0]]
        for b in range(1, 8):
            hit = hit | table[b][blocks[:, b]]
        window, at = np.nonzero(hit)
        within = np.bitwise_count(prints[window] ^ self.prints[items[at]]) <= self.radius
        return window[within], items[at[within]]

    def match(self, text: str | None, least: float) -> list[tuple[int, float, int]]:
        """(item id, best similarity, first word of the best window) of each item found."""
        words = words_of(text)
        get, n = self.vocabulary.get, len(words)
        known = np.array([get(w, 0) for w in words], np.uint64)
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)  # window length -> ranges of first words
        for k, (seeds, lengths) in self.seeds.items():
            if n < k:
                continue
            at = np.flatnonzero(known == 0)
            ok = np.ones(n - k + 1, bool)
            for j in range(k):
                ok[at[(at >= j) & (at <= n - k + j)] - j] = False
            place = np.flatnonzero(ok)
            if not len(place):
                continue
            keys = mixed(known, k)[place]
            found = np.minimum(np.searchsorted(seeds, keys), len(seeds) - 1)
            for p, s in zip(place[seeds[found] == keys].tolist(), found[seeds[found] == keys].tolist(), strict=True):
                for length in lengths[s]:
                    low, high = max(0, p + k - length), max(0, min(p, n - length))
                    own = spans[length]
                    if own and low <= own[-1][1] + 1:
                        own[-1] = (min(own[-1][0], low), max(own[-1][1], high))
                    else:
                        own.append((low, high))
        best: dict[int, tuple[float, int]] = {}
        for length, ranges in spans.items():
            k = min(self.shingle, length)
            for low, high in ranges:
                for first in range(low, high + 1, 4096):
                    last = min(high, first + 4095)
                    hashes = mixed(word_hashes(words[first : min(n, last + length)]), k)
                    if not len(hashes):
                        continue
                    width = min(length - k + 1, len(hashes))
                    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs(hashes), axis=0)])
                    prints = packed(sums[width:] - sums[:-width])
                    for window, item in zip(*(x.tolist() for x in self.candidates(prints, length)), strict=True):
                        value = similarity(Counter(hashes[window : window + width].tolist()), self.grams[item])
                        if value >= least and value > best.get(item, (0.0, 0))[0]:
                            best[item] = (value, first + window)
        return [(self.ids[i], v, s) for i, (v, s) in sorted(best.items())]


def contamination(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, shingle: int = 5, radius: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, contaminated, item_ids, similarity (best), start_word (of the best window) of every row.

    Null and empty documents, and an empty benchmark, give contaminated = false, no items and similarity 0.  Items
    without a word or an id are left out; items shorter than a shingle are one shingle.  Repeated rows are judged
    alike; other columns are ignored.  Ties go to the lowest item id.  A very long document is read window by window.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _judged(rows, benchmark, ["doc_id"], "text", least, shingle, radius)


def with_contamination(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, shingle: int = 5, radius: int = 20, text_col: str = "text") -> DataFrame:
    """Every row of `docs` as it is, with the verdict's columns beside it (columns of these names are replaced)."""
    rest = [c for c in docs.columns if c not in FOUND]
    return _judged(docs.select(*rest), benchmark, rest, text_col, least, shingle, radius)


def _judged(rows: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str, least: float, shingle: int, radius: int) -> DataFrame:
    """The columns `keep` with what was found; a row is judged by itself however many blocks there are."""
    spark = rows.sparkSession
    work.prepare(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where("item_id IS NOT NULL")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    one = size["n"] <= BLOCK_ITEMS and size["chars"] <= BLOCK_CHARS

    def passed(own: DataFrame, block: list[tuple[int, str | None]], out: list[str], hits_only: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(Items(block, shingle, radius))
        order = own.columns
        at, places = order.index(text_col), [order.index(c) for c in out]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shared.value.match(t, least) for t in batch.column(at).to_pylist()]
                ids = [[x[0] for x in f] for f in found]
                top = [max(f, key=lambda x: (x[1], -x[0]))[1:] if f else (0.0, None) for f in found]
                made = pa.RecordBatch.from_arrays([*(batch.column(k) for k in places), pa.array(list(map(bool, ids)), pa.bool_()), pa.array(ids, pa.list_(pa.int64())), pa.array([t[0] for t in top], pa.float64()), pa.array([t[1] for t in top], pa.int64())], names=[*out, *FOUND])
                yield made.filter(made.column(len(out))) if hits_only else made

        return own.mapInArrow(run, work.carried(own, out, FOUND_DDL))

    if one:
        return passed(rows, [tuple(r) for r in items.collect()], keep, False)
    row = "_row"
    while row in rows.columns:
        row += "_"
    rows = work.pinned(rows.select(*dict.fromkeys([*keep, text_col])).withColumn(row, F.monotonically_increasing_id()), "numbered")
    hits = None
    for number, block in enumerate(cut(items)):
        found = work.pinned(passed(rows.select(row, text_col), block, [row], True).select(row, *FOUND[1:], F.lit(number).alias("block")), "hits")
        hits = found if hits is None else hits.unionByName(found)
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "item_ids"))), lambda x: x["item_ids"]))  # a list a block
    best = F.max_by(F.struct("similarity", "start_word"), F.struct(F.col("similarity"), -F.col("block")))  # of equal ones the earlier block's
    merged = work.pinned(hits.groupBy(row).agg(ids.alias("_ids"), best.alias("_best")), "found")
    joined = work.join_counted(rows, merged, row, "left")
    return joined.select(*keep, F.col("_best").isNotNull().alias(FOUND[0]), F.coalesce("_ids", F.array().cast("array<long>")).alias(FOUND[1]), F.coalesce("_best.similarity", F.lit(0.0)).alias(FOUND[2]), F.col("_best.start_word").alias(FOUND[3]))


def cut(items: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The items in order of id and text, in blocks of at most BLOCK_ITEMS and BLOCK_CHARS (a longer item is one)."""
    block: list[tuple[int, str | None]] = []
    chars = 0
    for item, text in items.orderBy("item_id", "text").toLocalIterator():
        n = len(text or "")
        if block and (len(block) >= BLOCK_ITEMS or chars + n > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((item, text))
        chars += n
    yield block
