"""Operator 11: exact duplicates by digest, with the frequent digests split from the rest.

Texts are hashed where they lie; from there on only ids and 32-byte digests move.  Each task summarises its digests by
Misra and Gries with COUNTERS counters; the summaries are added up, which leaves at most 1.6 / SHARE candidates, and these
are counted exactly.  The rows that stay of the digests with over SHARE of all rows, 1 / SHARE at most, are broadcast, so
their copies are settled without a shuffle; the rows of all other digests, none of which is frequent, are shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm import work

#: A digest is frequent if it has over this share of all rows.
SHARE = 1 / 1024
#: Counters of a task's summary: with 4 / SHARE the summaries miss at most 3/8 of a frequent digest's rows.
COUNTERS = 4096


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """row, doc_id and digest (SHA-256 of the text with A-Z lower-cased; null counts as empty) of every row."""
    import hashlib

    work.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.lower changes A-Z only
            found = [hashlib.sha256((t.as_py() or b"").lower()).digest() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["row", "doc_id", "digest"])

    row = F.monotonically_increasing_id() if row is None else row
    rows = docs.select(row.alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(run, "row long, doc_id long, digest binary")


def compressed(counts: dict[bytes, int], k: int) -> dict[bytes, int]:
    """At most k counters: the (k + 1)-th largest count is taken off all of them, and what has nothing left goes."""
    if len(counts) <= k:
        return counts
    cut = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), len(counts) - k - 1)[len(counts) - k - 1])
    return {d: c - cut for d, c in counts.items() if c > cut}


def summary(values: Iterator[list[bytes]], k: int) -> list[tuple[bytes, int]]:
    """Misra-Gries counters of the values, too low by at most 1 / (k + 1) of them, without those of up to 1 / 2k of them."""
    counts, n = Counter(), 0
    for some in values:
        counts.update(some)
        n += len(some)
        if len(counts) > 2 * k:
            counts = Counter(compressed(counts, k))
    return [(d, c) for d, c in compressed(counts, k).items() if 2 * k * c > n]


def frequent(prints: DataFrame, share: float = SHARE, counters: int = COUNTERS) -> DataFrame:
    """digest, n, keep_id, keep_row of every digest with over `share` of the rows of `prints`, which should be pinned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = summary((b.column(0).to_pylist() for b in batches), counters)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.binary()), pa.array([c for _, c in found], pa.int64())], names=["digest", "c"])

    total = prints.count()
    enough = total * (share - 1.5 / counters)  # a frequent digest has more in the sum of the summaries
    candidates = prints.select("digest").mapInArrow(run, "digest binary, c long").groupBy("digest").agg(F.sum("c").alias("c")).where(F.col("c") > enough)
    candidates = work.pinned(candidates.select("digest"), "candidates")
    counted = winners(prints.join(F.broadcast(candidates), "digest", "left_semi"))
    return work.pinned(counted.where(F.col("n") > total * share), "frequent")


def winners(prints: DataFrame) -> DataFrame:
    """digest, n, keep_id and keep_row: the row with the largest doc_id stays, nulls last; of equal ids any one of them."""
    out = prints.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"), F.max_by("row", "doc_id").alias("a"), F.max("row").alias("b"))
    return out.select("digest", "n", "keep_id", F.coalesce("a", "b").alias("keep_row"))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None, share: float = SHARE, counters: int = COUNTERS) -> DataFrame:
    """row, doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal if they are once A-Z are lower-cased.  Null and empty texts are one group; the row with the largest
    doc_id of a group stays (a null id only where there is no other; of rows that repeat the id one, chosen by its row),
    so each group keeps exactly one row.  Very long texts are hashed whole, where they lie.  Other columns are ignored,
    whatever their names; an empty table gives no rows.  `row` numbers the rows of a pinned frame; without it they are
    numbered here.
    """
    if counters * share < 4:
        raise ValueError("counters should be at least 4 / share")
    prints = work.pinned(digests(docs, id_col, text_col, row), "digests")
    heavy = F.broadcast(frequent(prints, share, counters))
    rest = prints.join(heavy, "digest", "left_anti")
    repeated = winners(rest).where("n > 1")
    columns = ["row", "doc_id", "digest", "n", "keep_id", "keep_row"]
    both = prints.join(heavy, "digest").select(*columns).unionByName(rest.join(repeated, "digest", "left").select(*columns))
    alone = F.col("n").isNull()
    return both.select(
        "row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns; the table is written once, so that its rows can be numbered."""
    name = "_row"
    while name in docs.columns:
        name += "_"
    keyed = work.pinned(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    gone = work.pinned(duplicates(keyed, id_col, text_col, F.col(name)).where("NOT kept").select("row"), "copies")
    return work.flagged(keyed, gone, name, f"{name}gone").where(f"NOT `{name}gone`").select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents),
g AS (SELECT h, count(*) AS n, max(doc_id) AS keep_id FROM t GROUP BY h)
SELECT t.doc_id, g.keep_id, g.n AS group_size, t.doc_id = g.keep_id AS kept, t.h AS text_sha256 FROM t JOIN g ON t.h = g.h
"""
