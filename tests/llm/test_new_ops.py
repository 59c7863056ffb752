"""Exact duplicates, clusters and hard negatives against brute force, and their odd inputs."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import clusters, exact, negatives

DOCS = "doc_id long, text string, digest string, row string"
VECTORS = "vec_id long, embedding array<float>, label int, row string, v string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault(lower(r[1]), []).append(r[0])
    out = []
    for doc_id, text, *_ in rows:
        own = groups[lower(text)]
        out.append((doc_id, max((i for i in own if i is not None), default=None), len(own), hashlib.sha256(lower(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def odd_docs():
    r = random.Random(5)
    texts = [None, "", " ", "a", "A", "É", "é", "x" * 200_000, "X" * 200_000, "K", "K", "\x00", *(f"t{r.randrange(40)}" for _ in range(300))]
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)] + [(None, "a", None, None), (None, "only nulls", None, None), (None, "only nulls", None, None), (7, "twice", None, None), (7, "twice", None, None)]
    return rows + [(1000 + i, "hot" if i % 2 else "HOT", None, None) for i in range(200)]


@pytest.mark.parametrize(("share", "counters"), [(1 / 1024, 4096), (0.1, 40), (0.02, 200), (1.0, 4)])
def test_exact_duplicates(spark, share, counters):
    """Whatever counts as frequent, the rows are those of brute force, and each group keeps one row."""
    rows = odd_docs()
    got = exact.duplicates(spark.createDataFrame(rows, DOCS).repartition(5), share=share, counters=counters).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == brute_exact(rows)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in got}) == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_deduplicated_keeps_all_columns(spark):
    rows = odd_docs()
    out = exact.deduplicated(spark.createDataFrame(rows, DOCS).withColumnRenamed("row", "_row"))
    assert out.columns == ["doc_id", "text", "digest", "_row"]
    assert out.count() == len({lower(r[1]) for r in rows})
    assert exact.duplicates(spark.createDataFrame([], DOCS)).count() == 0 and exact.deduplicated(spark.createDataFrame([], DOCS)).count() == 0


def test_summaries_never_miss_much():
    """A counter is at most 1.5 / k of the values too low, however they are ordered and cut."""
    r = random.Random(1)
    values = [b"hot"] * 900 + [b"warm"] * 300 + [str(i).encode() for i in range(3000)]
    for seed in range(5):
        r.shuffle(values)
        counts = Counter(values)
        for k in (4, 16, 64):
            summed = Counter()
            for at in range(0, len(values), 700):
                part = values[at : at + 700]
                found = exact.summary((part[i : i + 50] for i in range(0, len(part), 50)), k)
                assert len(found) <= k
                summed.update(dict(found))
            for d in (b"hot", b"warm"):
                assert counts[d] - 1.5 * len(values) / k <= summed[d] <= counts[d]


def test_only_frequent_digests_are_broadcast(spark):
    rows = [(i, "hot" if i < 700 else f"t{i}") for i in range(1000)]
    prints = exact.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).cache()
    heavy = exact.frequent(prints, 0.1, 40).collect()
    assert [(r["n"], r["keep_id"]) for r in heavy] == [(700, 699)]


def on_grid(v, scale):
    return [math.floor(scale * float(np.float32(x))) for x in v]


def usable(v, dims=64):
    return v is not None and (dims is None or len(v) == dims) and all(x is not None and math.isfinite(x) for x in v)


def brute_clusters(rows, k=16, rounds=3, dims=64):
    own = [(i, on_grid(v, 64)) for i, v, *_ in rows if usable(v, dims)]
    start = sorted(own, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [list(v) for _, v in start[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in own]

    for _ in range(rounds):
        now = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(own, now, strict=True) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    now = assign()
    sums = Counter()
    for d, j in now:
        sums[j] += d
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted(((i, j, d, sums[j], sum(sums.values()), digest(centroids[j])) for (i, _), (d, j) in zip(own, now, strict=True)), key=repr)


def odd_vectors(n=260, dims=64, seed=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dims))
    rows = [(i, (centres[i % 6] * 0.3 + r.normal(size=dims) * 0.2).astype(np.float32).tolist(), i % 3, "clash", "clash") for i in range(n)]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] + [0.5] * 63, [float("nan")] + [0.5] * 63, [float("inf")] + [0.5] * 63, [0.0] * 64]
    rows += [(1000 + i, v, 1, None, None) for i, v in enumerate(bad)]
    rows += [(None, rows[0][1], 0, None, None), (5, rows[5][1], 2, None, None), (50, rows[50][1], 1, None, None), (1100, rows[3][1], None, None, None)]
    return rows + [(2000 + i, rows[1][1], i % 2, None, None) for i in range(90)]  # one common vector


def as_tuples(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 7, 20, 260])
def test_clusters(spark, n):
    rows = odd_vectors() if n == 260 else odd_vectors()[:n]
    got = clusters.report(spark.createDataFrame(rows, VECTORS).repartition(3))
    assert as_tuples(got, "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256") == brute_clusters(rows)


def test_bounds_are_never_too_high_and_prune():
    r = np.random.default_rng(0)
    for spread in (1, 50, 1 << 20):
        v = r.integers(-spread, spread + 1, (400, 64))
        centroids = v[:16] + (r.integers(-2, 3, (16, 64)) if spread > 1 else 0)
        pivots = clusters.Pivots.of(v[20:28])
        to_pivots, of_centroids = pivots.distances(v), pivots.distances(centroids)
        low = pivots.bounds(to_pivots, of_centroids)
        true = ((v[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
        assert (low <= true).all()
        best, least, measured = clusters.nearest(v, to_pivots, centroids, of_centroids, pivots)
        assert (best == true.argmin(axis=1)).all() and (least == true.min(axis=1)).all() and measured <= true.size
    tight = np.concatenate([c + r.integers(-3, 4, (50, 64)) for c in r.integers(-300, 300, (16, 64))])
    centroids, pivots = tight[::50], clusters.Pivots.of(tight[25:425:50])
    measured = clusters.nearest(tight, pivots.distances(tight), centroids, pivots.distances(centroids), pivots)[2]
    assert measured < 0.5 * len(tight) * 16


def test_components_beyond_the_grid_raise(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="don't fit a long"):
        clusters.report(frame).collect()


def brute_negatives(rows, every, label_of=lambda i, x: x):
    own = [(k, i, label_of(i, x), on_grid(v, 256)) for k, (i, v, x, *_) in enumerate(rows) if x is not None and usable(v, None)]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for k, i, x, v in own:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), j, y) for m, j, y, w in own if m != k and len(w) == len(v)]
        for ps, p, _ in sorted((s for s in scored if s[2] == x), key=order)[:5]:
            fit = sorted((s for s in scored if s[2] != x and 50 * ps <= 100 * s[0] <= 95 * ps), key=order)[:3]
            out += [(i, p, n + 1, j, ps, s) for n, (s, j, _) in enumerate(fit)]
    return sorted(out, key=repr)


NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize(("anchors", "rows_"), [(256, 4096), (3, 17)])
def test_negatives(spark, monkeypatch, anchors, rows_):
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    monkeypatch.setattr(negatives, "ROWS", rows_)
    rows = odd_vectors()
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    want = brute_negatives(rows, 10)
    assert len(want) > 100
    assert as_tuples(negatives.mine(frame, every=10, id_col="vec_id", vector_col="embedding"), *NAMES) == want


def test_negatives_of_few_rows(spark):
    rows = odd_vectors()
    for some in ([], rows[:1], rows[50:53], [(50, [1.0], 1, None, None), (60, [2.0], 1, None, None), (3, [1.5], 2, None, None), (4, [1.5, 1.0], 2, None, None), (None, [1.2], 2, None, None)]):
        got = negatives.mine(spark.createDataFrame(some, VECTORS), id_col="vec_id", vector_col="embedding")
        assert as_tuples(got, *NAMES) == brute_negatives(some, 50)


def test_tiles_of_any_size_give_the_same_rows(spark, monkeypatch):
    """Several blocks of anchors and rows; one label holds most rows."""
    from keelson.operators import grid

    rows = [(i, v, 0 if i % 7 else 1, None, None) for i, (_, v, *_) in enumerate(odd_vectors()[:200])]
    frame = spark.createDataFrame(rows, VECTORS)
    want = brute_negatives(rows, 5)
    whole = grid.tiled
    monkeypatch.setattr(grid, "tiled", lambda *a, **b: whole(*a, **(b | {"side": 9})))
    assert as_tuples(negatives.mine(frame, every=5, id_col="vec_id", vector_col="embedding"), *NAMES) == want


def test_segment_bounds_hold():
    r = np.random.default_rng(2)
    for width in (1, 3, 16, 64, 70):
        a, b = r.integers(-200, 200, (30, width)), r.integers(-200, 200, (40, width))
        (ma, sa), (mb, sb) = negatives.summaries(a), negatives.summaries(b)
        end, wide = 0, None
        for start in negatives.segments(width):
            at, end = slice(end, end + len(start)), end + len(start)
            mean, rest = ma[:, at].astype(float) @ mb[:, at].T, sa[:, at].astype(float) @ sb[:, at].T
            slack = np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)) * 2.0**-20
            true = a @ b.T
            assert (mean - rest - slack <= true).all() and (true <= mean + rest + slack).all()
            assert wide is None or rest.sum() <= wide * (1 + 1e-6)
            wide = rest.sum()
        if width <= 16:
            assert rest.max() <= 1e-3  # one component a segment: nothing is left


def test_relabelled_query(spark):
    """The registered query shifts the labels of ids divisible by 7 first."""
    from keelson.llm import queries

    data = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    want = brute_negatives(rows, 50, lambda i, x: (x + 1) % 10 if i % 7 == 0 else x)
    assert as_tuples(queries.op13_negatives(spark, data), *NAMES) == want
    assert as_tuples(queries.op12_clusters(spark, data).withColumn("x", F.lit(1)), "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256") == brute_clusters(rows)
