"""Vector search over all query rows against brute force."""

from __future__ import annotations

import math

from keelson.operators import search
from keelson.plans import q_scan

DATA = "/root/testdata/sf0.001"


def brute(rows, queries, n=5):
    def cos(a, b):
        d = lambda x, y: sum(i * j for i, j in zip(x, y, strict=True))
        return d(a, b) / math.sqrt(d(a, a) * d(b, b))

    return sorted((q, i, round(-s, 4)) for q, v in queries for s, i in sorted((-cos(v, w), i) for i, w in rows)[:n])


def test_all_queries(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 100 == 0])
    assert len(want) == 25

    def got():
        return sorted((r["query_id"], r["vec_id"], round(r["score"], 4)) for r in q_scan.k5(spark, DATA).collect())

    assert got() == want
    v = spark.read.parquet(f"{DATA}/embeddings.parquet")
    small = search.vector_top(v, v.where("vec_id % 100 = 0"), "vec_id", "embedding", 5, side=3)  # several tiles each way
    assert sorted((r["query_id"], r["id"], round(r["score"], 4)) for r in small.collect()) == want


def test_ties_and_odd_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(20, 0, -1)] + [(None, [1.0, 2.0]), (30, None), (31, [0.0, 0.0]), (32, [1.0, None]), (33, [1.0]), (34, [float("nan"), 1.0]), (35, [float("inf"), 1.0])]
    frame = spark.createDataFrame(rows, "id long, v array<float>")
    out = search.vector_top(frame, frame.where("id IN (7, 30, 31, 33)"), "id", "v", 5).collect()
    assert sorted((r["query_id"], r["id"]) for r in out) == [(7, 1), (7, 2), (7, 3), (7, 4), (7, 5), (33, 33)]
