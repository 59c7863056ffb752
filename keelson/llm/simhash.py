"""Operator 9: near duplicates by SimHash, found with the generalised pigeonhole principle.

Two fingerprints within `radius` bits must agree to within t_i bits in at least one of m groups of bits whenever
sum(t_i + 1) = radius + 1.  Correlated bits are put in the same group, and dynamic programming gives each group its
threshold (-1: not probed, 0: equal, 1: one bit off) so that the estimated cost, rows probed and pairs compared, is
least; m is chosen by the same cost.  The estimate scales a bounded sample to the counted number of fingerprints.

Each distinct fingerprint is probed once, however many documents have it.  Rows with one probe key are compared in
numpy, and only a spanning forest of the links found leaves a task, so what is written grows with the rows, not with
their pairs.  Keys with more rows than `cap` are first split again by a pigeonhole on the other bits, and what is
still too large is compared tile by tile in many tasks.  No link is lost and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import work

#: Fingerprints that the estimate of costs looks at.
SAMPLE = 2000
#: Relative costs of a probe row and of a comparison.
ROW_COST, PAIR_COST = 2e-6, 2e-8
CAP = 2048
CHUNK = 20_000


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):  # a very long text a piece at a time
        counts += np.unpackbits(hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, size: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) hashes of the text's word shingles, repeats included; 0 without a word."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A-Z only, ASCII blanks only
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=42)
    data, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    return majority(np.fromiter((digest(data[i:j], 42) for i, j in zip(starts[:n].tolist(), ends[size - 1 :].tolist(), strict=True)), np.uint64, n))


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""
    work.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


@dataclass(frozen=True)
class Group:
    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return signed(sum(1 << b for b in self.bits))


def signed(value: int) -> int:
    value &= 2**64 - 1
    return value - 2**64 if value >= 2**63 else value


def group_bits(fps: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """m groups of nearly equal size; each grows by the bit most correlated with what it has."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    z = bits - bits.mean(axis=0)
    norm = np.sqrt((z**2).sum(axis=0))
    norm[norm == 0] = 1
    corr = np.abs(z.T @ z / np.outer(norm, norm))
    np.fill_diagonal(corr, 0)
    free, out = list(range(64)), []
    for g in range(m):
        size = len(free) // (m - g)
        own = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(own[0])
        while len(own) < size:
            best = max(free, key=lambda b: (corr[b, own].sum(), -b))
            own.append(best)
            free.remove(best)
        out.append(tuple(sorted(own)))
    return out


def allocate(costs: list[list[float]], radius: int) -> tuple[float, list[int]]:
    """Thresholds (each -1, 0, 1, ... up to the costs given) with sum(t + 1) = radius + 1 and least total cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, c in enumerate([0.0, *own]):
                if used + t <= radius + 1 and (used + t not in step or cost + c < step[used + t][0]):
                    step[used + t] = (cost + c, [*chosen, t - 1])
        best = step
    return best.get(radius + 1, (float("inf"), []))


def plan(sample: np.ndarray, total: int, radius: int) -> list[Group]:
    """The cheapest grouping and thresholds for `total` distinct fingerprints like the sample."""
    left, right = np.triu_indices(min(len(sample), 1000), 1)
    apart = sample[left] ^ sample[right] if len(left) else np.zeros(1, np.uint64)
    found: tuple[float, list[Group]] = (float("inf"), [])
    for m in range((radius + 2) // 2, radius + 2):
        groups = group_bits(sample, m)
        costs = []
        for bits in groups:
            off = np.bitwise_count(apart & np.uint64(sum(1 << b for b in bits)))
            chance = [max(float((off <= t).mean()) if len(left) else 0.0, (1 + t * len(bits)) / 2.0 ** len(bits)) for t in (0, 1)]
            costs.append([total * (1 + t * len(bits) / 2) * ROW_COST + total**2 / 2 * chance[t] * PAIR_COST for t in (0, 1)])
        cost, chosen = allocate(costs, radius)
        if cost < found[0]:
            found = (cost, [Group(b, t) for b, t in zip(groups, chosen, strict=True) if t >= 0])
    return found[1]


def probe_rows(distinct: DataFrame, groups: list[Group]) -> DataFrame:
    """g, key, fp, own: the fingerprint's own bits in group g and, at threshold 1, the same with one set bit cleared."""
    keys = []
    for g, group in enumerate(groups):
        keys.append(f"array(named_struct('g', {g}, 'key', fp & {group.mask}L, 'own', true))")
        if group.threshold == 1:
            bits = ", ".join(map(str, group.bits))
            keys.append(f"transform(filter(array({bits}), b -> (shiftrightunsigned(fp, b) & 1L) = 1L), b -> named_struct('g', {g}, 'key', fp & {group.mask}L & ~shiftleft(1L, b), 'own', false))")
    joined = "flatten(array(" + ", ".join(keys) + "))"
    return distinct.select("fp", F.expr(f"explode({joined})").alias("k")).select("k.g", "k.key", F.lit(0).alias("sub"), F.lit(0).cast("long").alias("sub_key"), "fp", "k.own")


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of labels along pairs; the least number of each class is its label."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        if not len(a):
            break
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt
    return label


def forest(run: np.ndarray, fp: np.ndarray, own: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, least fingerprint of its class) of all links within runs of equal `run`, which are contiguous."""
    start = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    length = np.diff(np.append(start, len(run)))
    good = (length > 1) & (np.add.reduceat(own.astype(np.int64), start) > 0)
    keep = np.repeat(good, length)
    run, fp, own = run[keep], fp[keep], own[keep]
    if not len(fp):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    values, number = np.unique(fp, return_inverse=True)
    label = np.arange(len(values))
    end = np.repeat(np.cumsum(length[good]), length[good])
    at, d, held, size = np.arange(len(fp)), 1, [], 0
    while len(at):
        at = at[at + d < end[at]]
        near = at[(own[at] | own[at + d]) & (np.bitwise_count(fp[at] ^ fp[at + d]) <= radius)]
        held.append((number[near], number[near + d]))
        size += len(near)
        if size > 500_000:
            label, held, size = merge(label, *map(np.concatenate, zip(*held, strict=True))), [], 0
        d += 1
    if held:
        label = merge(label, *map(np.concatenate, zip(*held, strict=True)))
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


def compare(rows: DataFrame, radius: int) -> DataFrame:
    """Links a, b (spanning forests) of rows g, key, sub, sub_key, fp, own that share all of g, key, sub and sub_key."""
    on = ["g", "key", "sub", "sub_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0

        def links(upto_end: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            change = np.zeros(size, bool)
            for c in columns[:4]:
                change[1:] |= c[1:] != c[:-1]
            cut = size if upto_end else int(np.flatnonzero(change)[-1]) if change.any() else 0
            if cut:
                runs = np.cumsum(change[:cut])
                a, b = forest(runs, columns[4][:cut].view(np.uint64), columns[5][:cut], radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
            held, size = [[c[cut:] for c in columns]], size - cut

        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            size += batch.num_rows
            if size >= CHUNK:
                yield from links(False)
        if size:
            yield from links(True)

    dealt = rows.select(*on, "fp", "own").repartition(*on).sortWithinPartitions(*on)
    return dealt.mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, radius: int = 3, cap: int = CAP) -> DataFrame:
    """Links a, b that connect exactly the fingerprints (column fp, distinct) that a chain of steps of `radius` bits connects."""
    work.prepare(distinct.sparkSession)
    total = distinct.count()
    sample = np.array([r["fp"] for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    groups = plan(sample, total, radius) if total > 1 else [Group(tuple(range(64)), 0)]
    on = ["g", "key", "sub", "sub_key"]
    rows, found = probe_rows(distinct, groups), None
    for level in range(2):
        hot = work.pinned(rows.groupBy(*on).agg(F.count("*").alias("n"), F.max("own").alias("any_own")).where((F.col("n") > cap) & F.col("any_own")).select(*on, "n"), "hot-keys")
        if hot.isEmpty():
            part = compare(rows, radius)
            return part if found is None else found.unionByName(part)
        few = F.broadcast(hot) if hot.count() <= work.BROADCAST_ROWS else hot
        part = compare(rows.join(few, on, "left_anti"), radius)
        found = part if found is None else found.unionByName(part)
        rows = rows.join(few, on, "inner")
        if level == 0:  # the other bits of a group in radius + 1 parts: one of them is equal
            split = []
            for g, group in enumerate(groups):
                other = [b for b in range(64) if b not in group.bits]
                parts = [signed(sum(1 << b for b in other[k :: radius + 1])) for k in range(radius + 1)]
                split.append(f"WHEN {g} THEN array({', '.join(f'named_struct("s", {k + 1}, "v", fp & {v}L)' for k, v in enumerate(parts))})")
            rows = rows.select("g", "key", "fp", "own", F.expr(f"explode(CASE g {' '.join(split)} END)").alias("p")).select("g", "key", F.col("p.s").alias("sub"), F.col("p.v").alias("sub_key"), "fp", "own")
    # tiles: every two of a key's chunks meet in one task; a chunk has about cap / 2 rows
    chunks = F.ceil(F.col("n") / (cap // 2)).cast("int")
    rows = rows.withColumn("c", chunks).withColumn("own_chunk", F.pmod(F.xxhash64("fp"), F.col("c")).cast("int"))
    rows = rows.select("g", "key", "sub", "sub_key", "fp", "own", "own_chunk", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("with_chunk"))
    tile = F.xxhash64("key", "sub", "sub_key", F.least("own_chunk", "with_chunk"), F.greatest("own_chunk", "with_chunk"))
    return found.unionByName(compare(rows.select("g", tile.alias("key"), "sub", "sub_key", "fp", "own"), radius))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the least node of its class) of all nodes that are not roots, by alternating large and small stars."""

    def signature(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = work.pinned(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = signature(now)
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = work.pinned(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        now = work.pinned(small, "small-star")
        after = signature(now)
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_duplicates(docs: DataFrame, radius: int = 3, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    component_id is the smallest doc_id that a chain of links reaches; nulls don't count unless there is nothing else.
    Null, empty and blank texts have fingerprint 0 and are linked like any other.  Repeated rows and repeated ids get
    a row each; all shingles of a very long text count, a piece at a time; other columns are ignored; an empty table gives
    no rows.
    """
    prints = work.pinned(fingerprints(docs, size, id_col, text_col), "fingerprints")
    distinct = work.pinned(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    found = components(links(distinct.select("fp"), radius))
    nodes = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    nodes = work.pinned(nodes, "nodes")
    least = nodes.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = nodes.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
