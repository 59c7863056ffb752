"""Operator 12: clusters around centroids, with Ptolemaic lower bounds from pivot distances.

Ptolemy's inequality gives, for a vector x, a centroid c and a pair of pivots p, s with distance e > 0,

    d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / e

The distances from vectors to pivots are written once beside the vectors and serve every round; those from centroids to
pivots are a few numbers a round.  Bounds are rounded down, so a centroid is passed over only if it is farther than one
that has been measured exactly; the others are measured in integers.  A round is one pass over the vectors, in which a task
leaves a sum for each cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import work

#: Pivots are the first vectors after the starting centroids in hash order; each two neighbours are a pair.
PIVOTS = 8
#: Largest magnitude of a component once scaled: squared distances of vectors of 512 components fit a long, inner products of 2,048.
LARGEST = 1 << 26


def grid(vectors: DataFrame, dims: int | None, scale: float, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """vec_id, `more` columns and v (integers floor(scale * x), x as double) of the vectors with `dims` components (None: any
    number), all finite."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), *more, x.alias("x")).where(F.size("x") == dims if dims is not None else F.col("x").isNotNull())
    rows = rows.where(F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))))
    too_large = F.raise_error(F.lit(f"a component is beyond {LARGEST / scale:g}: its squared distances don't fit a long"))
    return rows.select("vec_id", *more, F.transform("x", lambda c: F.when(F.abs(c) * scale <= LARGEST, F.floor(c * scale)).otherwise(too_large.cast("long"))).alias("v"))


def first_by_hash(rows: DataFrame, n: int) -> np.ndarray:
    """The n vectors whose `1:<vec_id>` has the smallest SHA-256; of equal ids the smaller vector; null ids last."""
    order = [F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256).asc_nulls_last(), F.col("v")]
    return np.array([r["v"] for r in rows.orderBy(*order).limit(n).collect()], np.int64)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of a and b, one by one."""
    apart = a - b
    return np.einsum("ij,ij->i", apart, apart)


@dataclass(frozen=True)
class Pivots:
    """Pairs of pivots that lie apart: their vectors, and the distance within each pair, rounded up."""

    left: np.ndarray
    right: np.ndarray
    apart: np.ndarray

    @staticmethod
    def of(vectors: np.ndarray) -> Pivots:
        left, right = vectors[0 : len(vectors) // 2 * 2 : 2], vectors[1::2]
        far = squares(left, right) if len(left) else np.zeros(0, np.int64)
        return Pivots(left[far > 0], right[far > 0], np.sqrt(far[far > 0].astype(float)) * (1 + 2**-50))

    def distances(self, v: np.ndarray) -> np.ndarray:
        """Distances to the left pivots, then to the right ones, within one part in 2**52."""
        return np.sqrt(np.stack([squares(v, p[None, :]) for p in (*self.left, *self.right)], axis=1).astype(float)) if len(self.left) else np.zeros((len(v), 0))

    def bounds(self, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """Squares of lower bounds of the distances between the vectors of two tables of pivot distances."""
        n, out = len(self.left), np.zeros((len(mine), len(theirs)))
        for k in range(n):
            a, b = np.outer(mine[:, k], theirs[:, n + k]), np.outer(mine[:, n + k], theirs[:, k])
            low = (np.abs(a - b) - (a + b) * 2**-49) / self.apart[k]  # each product is off by less than 2**-50 of itself
            np.maximum(out, low, out=out)
        return out * out * (1 - 2**-50)


def nearest(v: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, of_centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, ties to the smaller; squared distance; distances measured) of each vector."""
    low = pivots.bounds(to_pivots, of_centroids)
    every = np.arange(len(v))
    best = low.argmin(axis=1)
    least = squares(v, centroids[best])
    left = low <= least[:, None].astype(float) * (1 + 2**-50)
    left[every, best] = False
    measured = len(v)
    for k in range(len(centroids)):
        at = np.flatnonzero(left[:, k])
        at = at[low[at, k] <= least[at] * (1 + 2**-50)]  # what has been measured since may be nearer
        if not len(at):
            continue
        measured += len(at)
        d = squares(v[at], centroids[k])
        nearer = (d < least[at]) | ((d == least[at]) & (k < best[at]))
        least[at[nearer]], best[at[nearer]] = d[nearer], k
    return best, least, measured


def arrays(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors and pivot distances of a batch of vec_id, v, p."""
    flat = lambda c, kind: np.asarray(c.flatten().to_numpy(zero_copy_only=False), kind)
    return flat(batch.column(1), np.int64).reshape(batch.num_rows, dims), flat(batch.column(2), float).reshape(batch.num_rows, -1)


def with_pivots(rows: DataFrame, pivots: Pivots, dims: int) -> DataFrame:
    """vec_id, v and p (distances to the pivots)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.int64).reshape(batch.num_rows, dims)
            p = pivots.distances(v)
            ends = pa.array(np.arange(0, p.size + 1, p.shape[1]) if p.shape[1] else np.zeros(len(v) + 1, int), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(p.ravel()))], names=["vec_id", "v", "p"])

    return rows.mapInArrow(run, "vec_id long, v array<long>, p array<double>")


def assigned(rows: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """vec_id, cluster and distance (squared) of every vector."""
    of_centroids, dims = pivots.distances(centroids), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, p = arrays(batch, dims)
            best, least, _ = nearest(v, p, centroids, of_centroids, pivots)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32()), pa.array(least, pa.int64())], names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(rows: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of their vectors; those without any stay.

    Each task gives one row a cluster, and Spark adds them up: as many rows as there are centroids reach the driver.
    """
    of_centroids, dims = pivots.distances(centroids), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            v, p = arrays(batch, dims)
            best = nearest(v, p, centroids, of_centroids, pivots)[0]
            np.add.at(sums, best, v)
            counts += np.bincount(best, minlength=len(centroids))
        own = np.flatnonzero(counts)
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(counts[own]), pa.array(list(sums[own]), pa.list_(pa.int64()))], names=["cluster", "n", "s"])

    parts = rows.mapInArrow(run, "cluster int, n long, s array<long>")
    added = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[d].cast("decimal(28,0)")).alias(f"s{d}") for d in range(dims)])
    out = centroids.copy()
    for r in added.collect():
        out[r["cluster"]] = [int(r[f"s{d}"]) // r["n"] for d in range(dims)]
    return out


def clustered(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance of every vector; the centroids), after `rounds` rounds from the k first vectors by hash.

    Vectors of another length, null ones and those with null or non-finite components take no part.  Ties go to the
    smaller number; repeated rows count each; a null id takes part and starts no cluster unless there are too few others;
    with fewer than k vectors there are as many clusters; an empty table gives no rows.  Other columns are ignored.
    """
    work.prepare(vectors.sparkSession)
    rows = work.pinned(grid(vectors, dims, scale, id_col, vector_col), "grid")
    first = first_by_hash(rows, k + PIVOTS)
    if not len(first):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, dims), np.int64)
    centroids, pivots = first[:k], Pivots.of(first[k:])
    rows = work.pinned(with_pivots(rows, pivots, dims), "pivot-distances")
    for _ in range(rounds):
        centroids = moved(rows, centroids, pivots)
    return work.pinned(assigned(rows, centroids, pivots), "assigned"), centroids


def report(vectors: DataFrame, **how) -> DataFrame:
    """clustered with cluster_inertia, inertia (sums of squared distances) and centroid_sha256 (of the final centroid's components)."""
    found, centroids = clustered(vectors, **how)
    digests = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    names = found.sparkSession.createDataFrame(digests, "cluster int, centroid_sha256 string")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row a centroid
    inertia = found.sparkSession.createDataFrame(list(sums.items()), "cluster int, cluster_inertia long")
    out = found.join(F.broadcast(inertia), "cluster").join(F.broadcast(names), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(sums.values())).cast("long").alias("inertia"), "centroid_sha256")


def oracle(k: int = 16, rounds: int = 3) -> str:
    """The registered query in SQL: each round is two common tables."""
    square = "list_sum(list_transform(list_zip(g.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    near = f"SELECT id, v, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT g.id, g.v, c.k, {square} AS d FROM g, {{}} c) GROUP BY id, v"
    parts = [
        "g AS MATERIALIZED (SELECT vec_id AS id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || id)) - 1 AS k, v FROM g ORDER BY sha256('1:' || id) LIMIT {k})",
    ]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED ({near.format(f'c{i}')})")
        if i < rounds:
            parts.append(f"m{i} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) GROUP BY k, i) GROUP BY k)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m ON m.k = c.k)")
    return (
        f"WITH {', '.join(parts)} SELECT a.id AS vec_id, a.k::INT AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia, "
        f"sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON c.k = a.k"
    )
