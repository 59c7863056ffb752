"""Stored queries on the path of many: tasks get like numbers of pairs, and clauses that must not hold are plain columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from keelson.operators import search
from tests.test_sizes import brute_clauses

DDL = "query_id int, occur string, field string, lo double, hi double, value string, minimum_should_match int"


@pytest.fixture
def shuffled(spark):
    """No side is small enough to be broadcast by its size."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("rows,queries", [(20_000, 100), (100, 20_000), (1, 5_000), (5_000, 1)])
def test_a_hot_key_is_cut_into_tiles(spark, shuffled, rows, queries):
    """All rows and queries share one value and one cell; no task makes all their pairs, and none is lost or made twice."""
    frame = spark.range(rows).select("id", F.lit(1.0).alias("x"), F.lit("a").alias("s"))
    one = spark.range(queries).select(F.col("id").cast("int").alias("query_id"))
    stored = one.selectExpr("query_id", "'must' AS occur", "'x' AS field", "1.0D AS lo", "1.0D AS hi", "CAST(NULL AS string) AS value")
    stored = stored.unionByName(one.selectExpr("query_id", "'must' AS occur", "'s' AS field", "CAST(NULL AS double) AS lo", "CAST(NULL AS double) AS hi", "'a' AS value"))
    got = search.stored_queries(frame, stored, ["x", "s"], most=0)
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(tasks) == rows * queries
    assert got.groupBy("id").count().agg(F.min("count"), F.max("count")).first()[:] == (queries, queries)
    assert got.groupBy("query_id").count().agg(F.min("count"), F.max("count")).first()[:] == (rows, rows)
    assert max(tasks) < 0.75 * rows * queries


@pytest.mark.parametrize("seed", range(3))
def test_clauses_that_must_not_hold(spark, seed):
    """Random queries of must and must_not clauses against brute force, as columns (up to two of the latter) and as a list (up to twelve)."""
    r = random.Random(seed)
    rows = [{"id": i, "x": r.choice([None, *map(float, range(8))]), "s": r.choice([None, "a", "b", "3"]), "y": r.choice([0.0, 1.5, -2.0])} for i in range(80)]
    fields = ["x", "s", "y"]

    def clause(q, occur):
        field, kind = r.choice([*fields, *fields, "absent"]), r.random()
        lo, hi = (r.choice([None, 0.0, 2.0, 3.0]), r.choice([None, 1.0, 4.0, 7.0])) if kind < 0.6 else (None, None)
        return (q, occur, field, lo, hi, r.choice(["a", "b", "3", "1.5", "2.0"]) if kind > 0.5 else None, r.choice([None, 0]))

    frame = spark.createDataFrame([tuple(x.values()) for x in rows], "id int, x double, s string, y double").repartition(3)
    for nots in (2, 12):
        clauses = []
        for q in range(60):
            clauses += [clause(q, r.choice(["must", None])) for _ in range(r.randint(0, 2))] + [clause(q, "must_not") for _ in range(r.randint(1, nots))]
        clauses = [(*c[:6], None) for c in clauses]
        want = brute_clauses(rows, clauses, fields)
        stored = spark.createDataFrame(clauses, DDL).repartition(3)
        assert search._QueryIndex(frame, stored, fields, 1).plain == (nots == 2)
        for most in (10_000, 1):
            assert sorted((x["id"], x["query_id"]) for x in search.stored_queries(frame, stored, fields, most=most).select("id", "query_id").collect()) == want
