"""Near copies by the exact Jaccard similarity of word shingles: candidates by SimHash and MinHash, then a verifying join.

Texts with equal shingle sets are one class from the start and only one of them goes on.  Operator 9 proposes the pairs
whose SimHash fingerprints lie within its radius, which holds near-identical texts.  At similarity 0.8 fingerprints lie
10 of 64 bits apart on average, with a deviation of 3; a radius that reaches them prunes nothing, so MinHash bands propose
the rest: a class has BANDS keys, each made of ROWS minima, and two classes that share a key are a candidate pair.  First
each key links its classes to one leader, another one in each key, so a large group of near copies costs as many pairs as
it has keys.  A key whose classes are in different components still is then compared in full inside tasks, in tiles of
bounded size, and only links that join components leave a task, so no candidate is left out and no pairs are written.  A key
of more than SPLIT chunks is first split by SUBKEYS further minima, each of which two of its classes share with chance s; a
pair shares none with chance (1 - s)**SUBKEYS: 7 in 10**12 at 0.8.  A pair at similarity s is missed by the bands with chance (1 - s**ROWS)**BANDS: 6 in 100,000 at 0.8, 3 in 10 million
at 0.85.  Every pair is verified on the exact sets, whoever proposed it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import simhash, work

BANDS, ROWS = 32, 6
#: Rows, and bytes of shingle hashes, of one of the two chunks of a key that meet in a task.
CHUNK, CHUNK_BYTES = 1024, 8_000_000
#: A key of more chunks than this is split by so many further minima first, one row a minimum.
SPLIT, SUBKEYS = 16, 16
_SEED = np.random.default_rng(42)
_FACTORS = _SEED.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _SEED.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_SUB_FACTORS = _SEED.integers(0, 2**31, SUBKEYS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SUB_SHIFTS = _SEED.integers(0, 2**32, SUBKEYS, dtype=np.uint32)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the text's word shingles; a shorter text is one shingle, a blank one too."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # as simhash.fingerprint
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words), 42)], np.uint64)
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - size + 1
    return np.unique(np.fromiter((digest(data[i:j], 42) for i, j in zip(starts[:n].tolist(), ends[size - 1 :].tolist(), strict=True)), np.uint64, n))


def minima(hashes: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The least value of a set under each of several hash functions."""
    least = np.full(len(factors), 2**32 - 1, np.uint32)
    halves = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(halves), 1024):  # a very long text a piece at a time
        h = halves[at : at + 1024, None] * factors
        h += shifts
        np.minimum(least, h.min(axis=0), out=least)
    return least


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """BANDS keys of a set."""
    least = minima(hashes, _FACTORS, _SHIFTS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ column) * np.uint64(0xC2B2AE3D27D4EB4F)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """row, doc_id, digest (of the shingle set), fp (its SimHash) and keys of every row."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, prints, keys = [], [], []
            for text in batch.column(2).to_pylist():
                hashes = shingles(text, size)
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                prints.append(simhash.signed(simhash.majority(hashes)))
                keys.append(band_keys(hashes))
            flat = pa.array(np.concatenate(keys)) if keys else pa.array([], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(prints, pa.int64()), lists], names=["row", "doc_id", "digest", "fp", "keys"])

    return docs.select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, digest binary, fp long, keys array<long>")


def verified(pairs: DataFrame, docs: DataFrame, least: float, size: int) -> DataFrame:
    """The pairs a, b of rows whose shingle sets have a Jaccard similarity of `least` or more."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = 0
                if min(len(a), len(b)) >= least * max(len(a), len(b)):
                    at = np.searchsorted(a, b)
                    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
                keep.append(both >= least * (len(a) + len(b) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    own = shingle_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("row")), size)
    joined = pairs.join(own.select(F.col("row").alias("a"), F.col("hashes").alias("x")), "a").join(own.select(F.col("row").alias("b"), F.col("hashes").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(judge, "a long, b long")


def shingle_sets(docs: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """row and hashes (its sorted shingle hashes, 8 bytes each) of the rows named in `rows`."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t, size).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], names=["row", "hashes"])

    named = work.pinned(rows.distinct(), "candidates")
    texts = work.flagged(docs.select("row", "text"), named, "row", "_named").where("_named").select("row", "text")
    return work.pinned(texts.mapInArrow(sets, "row long, hashes binary"), "shingle-sets")


def joins(rows: list[int], root: np.ndarray, sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links (pairs of rows) of similarity `least` or more that join every two classes of `root` which some such link joins."""
    label = np.unique(root, return_inverse=True)[1]
    lengths = np.array([len(s) for s in sets])
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts, mark, out = np.cumsum(lengths) - lengths, np.zeros(len(values), bool), []
    most = np.bincount(label).argmax()
    for x in np.flatnonzero(label != most).tolist():  # two rows of the greatest class need no comparison
        own = flat[starts[x] : starts[x] + lengths[x]]
        mark[own] = True
        both = np.add.reduceat(mark[flat], starts, dtype=np.int64)
        mark[own] = False
        for y in np.flatnonzero((both >= least * (lengths + lengths[x] - both)) & (label != label[x])).tolist():
            if label[y] != label[x]:
                out.append((rows[x], rows[y]))
                label[label == label[y]] = label[x]
    return out


def split(members: DataFrame) -> DataFrame:
    """members under SUBKEYS further keys each, without those whose rows have one root already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [minima(np.frombuffer(h.as_py(), np.uint64), _SUB_FACTORS, _SUB_SHIFTS).astype(np.int64) for h in batch.column(3)]
            flat = pa.array(np.concatenate(found)) if found else pa.array([], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, SUBKEYS), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], names=["key", "row", "root", "minima"])

    keys = members.select("key", "row", "root", "hashes").mapInArrow(run, "key long, row long, root long, minima array<long>")
    keys = keys.select("key", "row", "root", F.posexplode("minima").alias("i", "v")).select("row", "root", F.xxhash64("key", "i", "v").alias("key"))
    keys = work.pinned(keys, "sub-keys")
    mixed = keys.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    sets = members.groupBy("row").agg(F.first("hashes").alias("hashes"))  # a row's is the same under each key
    return keys.join(mixed, "key", "left_semi").join(sets, "row").select("key", "row", "root", "hashes")


def compare(members: DataFrame, least: float, chunk: int, chunk_bytes: int, most: int = SPLIT) -> DataFrame:
    """Links a, b of members (key, row, root, hashes) that share a key and differ in root, as far as they join roots.

    A key with more than `chunk` rows or `chunk_bytes` of hashes is cut into chunks, and every two of its chunks meet in
    one task; a key of more than `most` chunks is split first.
    """

    def chunks(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / chunk), F.ceil(F.sum(F.length("hashes")) / chunk_bytes)).cast("int").alias("c"))

    hot = work.pinned(chunks(members).where(F.col("c") > most).select("key"), "hot-keys")
    if not hot.isEmpty():
        whole = work.pinned(split(work.join_counted(members, hot, "key", "left_semi")), "split-keys")
        members = work.join_counted(members, hot, "key", "left_anti").unionByName(whole)
    rows = members.join(chunks(members), "key").withColumn("own", F.pmod(F.xxhash64("row"), F.col("c")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("other"))
    on = ["key", "low", "high"]
    rows = rows.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "row", "root", "hashes").repartition(*on).sortWithinPartitions(*on)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []

        def links() -> Iterator[pa.RecordBatch]:
            root = np.array([h[1] for h in held])
            found = joins([h[0] for h in held], root, [np.frombuffer(h[2], np.uint64) for h in held], least) if len(held) > 1 and (root != root[0]).any() else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            for *now, row, root, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != tile:
                    if held:
                        yield from links()
                    tile, held = now, []
                held.append((row, root, hashes))
        if held:
            yield from links()

    return rows.mapInArrow(run, "a long, b long")


def copies(docs: DataFrame, least: float = 0.8, size: int = 5, radius: int = 3) -> DataFrame:
    """The rows (column row) to drop so that one row of each component of similar texts stays.

    `docs` has row (unique, not null), doc_id and text, and is read several times: it should be pinned.  The row with
    the smallest doc_id stays, nulls last, and of equal ids the one with the smallest row.
    """
    work.prepare(docs.sparkSession)
    docs = docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = work.pinned(signatures(docs, size), "signatures")
    classes = work.pinned(signed.groupBy("digest").agg(F.min("row").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")).select("rep", "first"), "classes")
    own = work.pinned(signed.join(classes.select(F.col("rep").alias("row")), "row", "left_semi").select("row", "fp", "keys"), "class-keys")
    prints = work.pinned(own.groupBy("fp").agg(F.min("row").alias("at")), "class-prints")
    near = simhash.links(prints.select("fp"), radius).join(prints.select(F.col("fp").alias("a"), F.col("at").alias("x")), "a").join(prints.select(F.col("fp").alias("b"), F.col("at").alias("y")), "b").select("x", "y")
    near = near.unionByName(own.join(prints, "fp").select(F.col("row").alias("x"), F.col("at").alias("y")))
    members = own.select("row", F.explode("keys").alias("key"))
    leaders = members.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("key", "row").alias("h"), "row")).alias("l")).where("n > 1").select("key", F.col("l.row").alias("leader"))
    leaders = work.pinned(leaders, "leaders")
    shared = work.pinned(work.join_counted(members, leaders, "key", "inner"), "shared-keys")
    near = near.unionByName(shared.select(F.col("row").alias("x"), F.col("leader").alias("y")))
    star = work.pinned(near.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "star-pairs")
    edges = work.pinned(verified(star, docs, least, size), "star-edges")
    roots = work.pinned(simhash.components(edges), "star-roots")
    labelled = work.join_counted(shared.select("key", "row"), roots.withColumnRenamed("node", "row"), "row", "left").select("key", "row", F.coalesce("root", "row").alias("root"))
    labelled = work.pinned(labelled, "labelled")
    mixed = work.pinned(labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key"), "mixed-keys")
    left = work.pinned(work.join_counted(labelled, mixed, "key", "left_semi"), "unsettled")
    members = left.join(shingle_sets(docs, left.select("row"), size), "row")
    found = simhash.components(work.pinned(edges.unionByName(compare(members, least, CHUNK, CHUNK_BYTES)), "edges"))
    rooted = work.join_counted(classes, found.withColumnRenamed("node", "rep"), "rep", "left")
    kept = work.pinned(rooted.groupBy(F.coalesce("root", "rep").alias("root")).agg(F.min("first").alias("first")).select(F.col("first.row").alias("row")), "kept")
    return signed.select("row").join(kept, "row", "left_anti")
