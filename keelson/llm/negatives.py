"""Operator 13: hard negatives by inner product, with bounds from summaries of vector segments.

Of a segment of L components x = mean + rest, and the rest is orthogonal to the mean, so the inner product of two segments
lies between L m m' - L s s' and L m m' + L s s' (means m, deviations s).  Every vector carries its summaries for one
segment, for 4 and for 16.  In a tile of anchors and rows the coarsest bounds are taken of all pairs, finer ones of the
pairs that are left, and exact integer scores only of those that may still be among the first.  Summaries are stored in
single precision and the bounds widened by more than that rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm import clusters, work
from keelson.operators import grid

#: Segments of each level; a vector with fewer components has one a component.
LEVELS = (1, 4, 16)
#: Anchors and rows of the pieces in which a tile is searched.
ANCHORS, ROWS = 256, 4096
#: Inner products below this are exact in double precision.
EXACT = 2.0**53
NONE = -(2**63)


def segments(width: int) -> list[np.ndarray]:
    """For each level the first component of each segment."""
    return [np.arange(min(n, width)) * width // max(1, min(n, width)) for n in LEVELS]


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations, times the root of the segment's length, of all segments of all levels."""
    means, rests = [], []
    for start in segments(v.shape[1]):
        if not len(start):
            continue
        length = np.diff(np.append(start, v.shape[1]))
        total, square = np.add.reduceat(v, start, axis=1).astype(float), np.add.reduceat(v.astype(float) ** 2, start, axis=1)
        means.append(total / np.sqrt(length))
        rests.append(np.sqrt(np.maximum(0, square - total**2 / length)))
    empty = np.zeros((len(v), 0), np.float32)
    return (np.hstack(means).astype(np.float32), np.hstack(rests).astype(np.float32)) if means else (empty, empty)


def lists(a: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * a.shape[1], pa.int32()), pa.array(a.ravel()))


def summarised(rows: DataFrame) -> DataFrame:
    """rows (row, id, label, v) with the summaries m and s of their vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, v in grid.by_width(pa.chunked_array([batch.column(3)]), np.int64):
                own = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*own.columns, *map(lists, summaries(v))], names=["row", "id", "label", "v", "m", "s"])

    return rows.mapInArrow(run, "row long, id long, label int, v array<long>, m array<float>, s array<float>")


class Side:
    """The rows of one width of one side of a tile."""

    def __init__(self, table: pa.Table, at: np.ndarray, v: np.ndarray):
        own = table.take(pa.array(at))
        number = lambda c: own.column(c).to_numpy()
        self.table, self.v, self.row, self.label = own, v, number("row"), number("label")
        self.none = np.asarray(own.column("id").is_null().to_numpy(), bool)
        self.id = own.column("id").fill_null(0).to_numpy()
        matrix = lambda c: np.asarray(own.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(len(at), -1)
        self.m, self.s = (matrix("m"), matrix("s")) if v.shape[1] else (np.zeros((len(at), 0)),) * 2
        self.norm = np.sqrt((v.astype(float) ** 2).sum(axis=1))
        self.most = float(np.abs(v).max(initial=0))

    def part(self, at: np.ndarray) -> Side:
        out = object.__new__(Side)
        out.table, out.most = None, self.most
        for name in ("v", "row", "label", "none", "id", "m", "s", "norm"):
            setattr(out, name, getattr(self, name)[at])
        return out


def scores(a: Side, b: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of the pairs (i, j): all at once if many pairs are asked for and doubles are exact."""
    if a.most * b.most * max(1, a.v.shape[1]) < EXACT and 16 * len(i) > len(a.v) * len(b.v):
        return (a.v.astype(float) @ b.v.astype(float).T)[i, j].astype(np.int64)
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 50_000):
        out[at : at + 50_000] = np.einsum("ij,ij->i", a.v[i[at : at + 50_000]], b.v[j[at : at + 50_000]])
    return out


def survivors(a: Side, b: Side, low: np.ndarray, high: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The allowed pairs whose score may lie between the anchor's `low` and `high`, by the levels one after the other."""
    i, j = np.nonzero(allowed)
    end = 0
    for start in segments(a.v.shape[1]):
        at, end = slice(end, end + len(start)), end + len(start)
        if not len(i):
            break
        if 8 * len(i) > len(a.v) * len(b.v):  # cheaper for all pairs than one by one
            mean, rest = (a.m[:, at] @ b.m[:, at].T)[i, j], (a.s[:, at] @ b.s[:, at].T)[i, j]
        else:
            mean, rest = np.empty(len(i)), np.empty(len(i))
            for k in range(0, len(i), 50_000):
                x, y = i[k : k + 50_000], j[k : k + 50_000]
                mean[k : k + 50_000], rest[k : k + 50_000] = np.einsum("ij,ij->i", a.m[x, at], b.m[y, at]), np.einsum("ij,ij->i", a.s[x, at], b.s[y, at])
        rest += a.norm[i] * b.norm[j] * 2.0**-20  # single precision, of means and deviations
        keep = (mean + rest >= low[i]) & (mean - rest <= high[i])
        i, j = i[keep], j[keep]
    return i, j


def pieces(a: Side, b: Side) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x in range(0, len(a.row), ANCHORS):
        for y in range(0, len(b.row), ROWS):
            yield np.arange(x, min(x + ANCHORS, len(a.row))), np.arange(y, min(y + ROWS, len(b.row)))


def widths(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[Side, Side]]:
    """Both sides for each length of vectors that occurs in both."""
    theirs = {v.shape[1]: (at, v) for at, v in grid.by_width(rows.column("v"), np.int64)}
    for at, v in grid.by_width(anchors.column("v"), np.int64):
        if v.shape[1] in theirs:
            yield Side(anchors, at, v), Side(rows, *theirs[v.shape[1]])


def positives_of_tile(n: int):
    """For each anchor of a tile its first n other rows of the same label: anchor, positive_row, id, score."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        for a, b in widths(anchors, rows):
            for label in np.intersect1d(a.label, b.label):
                out.append(one_label(a.part(np.flatnonzero(a.label == label)), b.part(np.flatnonzero(b.label == label))))
        return found(["anchor", "positive_row", "id", "none", "score"], out)

    def one_label(a: Side, b: Side) -> list[np.ndarray]:
        best = [np.zeros(0, np.int64) for _ in range(3)]  # anchor's place, row's place, score
        low = np.full(len(a.row), -np.inf)
        for x, y in pieces(a, b):
            mine, other = a.part(x), b.part(y)
            i, j = survivors(mine, other, low[x], np.full(len(x), np.inf), mine.row[:, None] != other.row[None, :])
            best = [np.concatenate(c) for c in zip(best, (x[i], y[j], scores(mine, other, i, j)), strict=True)]
            kept = grid.first_of_each(best[0], n, -best[2], b.none[best[1]], b.id[best[1]], b.row[best[1]])
            best = [c[kept] for c in best]
            full = np.flatnonzero(np.bincount(best[0], minlength=len(a.row)) == n)
            worst = np.full(len(a.row), np.iinfo(np.int64).max)
            np.minimum.at(worst, best[0], best[2])
            low[full] = worst[full]
        return [a.row[best[0]], b.row[best[1]], b.id[best[1]], b.none[best[1]], best[2]]

    return run


def found(names: list[str], parts: list[list[np.ndarray]]) -> pa.Table:
    """A table of the parts; `id` is null where `none` says so."""
    if not parts:
        parts = [[np.zeros(0, bool if n == "none" else np.int64) for n in names]]
    columns = dict(zip(names, (np.concatenate(c) for c in zip(*parts, strict=True)), strict=True))
    none = columns.pop("none")
    return pa.table({n: pa.array(c, pa.int64(), mask=none if n == "id" else None) for n, c in columns.items()})


def negatives_of_tile(n: int, least: int, most: int):
    """For each anchor and positive score of a tile the first n rows of other labels in the score's range: anchor,
    positive_score, negative_row, id, score."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        return found(["anchor", "positive_score", "negative_row", "id", "none", "score"], [one_width(a, b) for a, b in widths(anchors, rows)])

    def one_width(a: Side, b: Side) -> list[np.ndarray]:
        wanted = a.table.column("positives").to_pylist()
        slots = max(map(len, wanted))
        ps = np.array([[*w, *[NONE] * (slots - len(w))] for w in wanted], np.int64)  # each row's different scores
        used = ps != NONE
        lo, hi = -(-least * np.where(used, ps, 0) // 100), most * np.where(used, ps, 0) // 100
        bar = np.where(used, lo, np.iinfo(np.int64).max)  # what a score must reach, by anchor and slot
        top = np.where(used, hi, NONE).max(axis=1).astype(float)
        best = [np.zeros(0, np.int64) for _ in range(4)]  # anchor's place, slot, row's place, score
        for x, y in pieces(a, b):
            mine, other = a.part(x), b.part(y)
            i, j = survivors(mine, other, bar[x].min(axis=1).astype(float), top[x], mine.label[:, None] != other.label[None, :])
            score = scores(mine, other, i, j)
            for k in range(slots):
                fits = (score >= bar[x[i], k]) & (score <= hi[x[i], k]) & used[x[i], k]
                new = x[i[fits]], np.full(fits.sum(), k), y[j[fits]], score[fits]
                best = [np.concatenate(c) for c in zip(best, new, strict=True)]
            place = best[0] * slots + best[1]
            kept = grid.first_of_each(place, n, -best[3], b.none[best[2]], b.id[best[2]], b.row[best[2]])
            best, place = [c[kept] for c in best], place[kept]
            full = np.flatnonzero(np.bincount(place, minlength=len(a.row) * slots) == n)
            worst = np.full(len(a.row) * slots, np.iinfo(np.int64).max)
            np.minimum.at(worst, place, best[3])
            bar.ravel()[full] = worst[full]
        return [a.row[best[0]], ps[best[0], best[1]], b.row[best[2]], b.id[best[2]], b.none[best[2]], best[3]]

    return run


def first(rows: DataFrame, by: list[str], n: int, row: str) -> DataFrame:
    """The first n of each group of tiles' rows, with their `rank`."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), F.col(row))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: float = 256.0, id_col: str = "id", vector_col: str = "vector", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, and the same ones' row numbers.

    Anchors are the rows whose id is divisible by `every`.  Scores are inner products of the components floor(scale * x);
    higher ones come first, ties by smaller id, nulls last, then by row.  A negative has another label and a score between
    `least` and `most` per cent of the positive's, so a positive with a negative score has none.  Rows with a null label, a
    null vector or a null or non-finite component take no part; vectors of different lengths don't meet; a null id is no
    anchor; rows that repeat an id count each, and are positives of each other; other columns are ignored; an empty table
    gives no rows.
    """
    work.prepare(rows.sparkSession)
    named = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("int").alias("label"), F.col(f"`{vector_col}`").alias("vector")).where("label IS NOT NULL")
    whole = clusters.grid(named, None, scale, "vec_id", "vector", "label").select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").alias("id"), "label", "v")
    every_row = work.pinned(summarised(whole), "summaries")
    anchors = work.pinned(every_row.where(F.col("id") % every == 0), "anchors")
    near = grid.tiled(anchors, every_row, positives_of_tile(positives), "anchor long, positive_row long, id long, score long")
    near = first(near, ["anchor"], positives, "positive_row").select("anchor", "positive_row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    near = work.pinned(near, "positives")
    asked = near.where("positive_score >= 0").groupBy(F.col("anchor").alias("row")).agg(F.collect_set("positive_score").alias("positives"))  # `positives` values at most
    asking = work.pinned(anchors.join(asked, "row"), "asking")
    far = grid.tiled(asking, every_row, negatives_of_tile(negatives, least, most), "anchor long, positive_score long, negative_row long, id long, score long")
    far = first(far, ["anchor", "positive_score"], negatives, "negative_row").select("anchor", "positive_score", "rank", "negative_row", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    out = near.join(far, ["anchor", "positive_score"]).join(ids, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", F.col("anchor").alias("anchor_row"), "positive_row", "negative_row")


ORACLE = """
WITH e AS MATERIALIZED (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.id % 50 = 0 AND a.id <> b.id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
