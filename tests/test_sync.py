"""The two-run incremental scenario and the three-phase handoff."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import sync, writes

DDL = "_id string, _version long, title string, hash string, batch_date timestamp, last_updated timestamp"


def batch(spark, rows):
    return spark.createDataFrame([(i, 1, t) for i, t in rows], "_id string, seq int, title string").withColumn("hash", F.sha2("title", 256))


def test_incremental_two_runs(spark):
    empty = spark.createDataFrame([], DDL)
    one = sync.incremental_sync(empty, empty, batch(spark, [(f"doc-{i}", f"Title {i}") for i in range(10)]), "2024-01-01", strategy="multiplex")
    assert (one.primary.count(), one.secondary.count()) == (10, 10)
    rows = [(f"doc-{i}", f"Modified title {i}" if i in (5, 6) else f"Title {i}") for i in range(7)]
    two = sync.incremental_sync(one.primary, one.secondary, batch(spark, rows), "2024-01-02")
    assert (two.primary.count(), two.secondary.count()) == (7, 7)
    assert two.secondary.where("_id = 'doc-6'").first()["title"] == "Modified title 6"
    assert {r["result"]: r["count"] for r in two.outcomes.groupBy("result").count().collect()} == {"updated": 7}
    two.remove()


def test_handoff(spark):
    empty = spark.createDataFrame([], DDL)
    first = [(f"d{i}", f"t{i}") for i in range(1000)]
    a = sync.incremental_sync(empty, empty, batch(spark, first), "2024-01-01", strategy="multiplex")
    assert (a.primary.count(), a.secondary.count()) == (1000, 1000)
    second = [(f"d{i}", f"changed{i}") for i in range(150)] + [(f"d{i}", f"t{i}") for i in range(1000, 1150)]
    b = sync.delta_sync(a.primary, a.secondary, batch(spark, second), "2024-01-02")
    assert (b.primary.count(), b.secondary.count()) == (1150, 1150)
    wide = spark.createDataFrame([], DDL + ", tags string")
    p, s = sync.backfill(b.primary, wide), sync.backfill(b.secondary, wide)
    third = batch(spark, [(f"d{i}", f"t{i}") for i in range(1150, 1300)]).withColumn("tags", F.lit("new"))
    c = sync.delta_sync(p, s, third, "2024-01-03")
    assert (c.primary.count(), c.secondary.count()) == (1300, 1300)


def test_stale_and_cutoff(spark):
    empty = spark.createDataFrame([], DDL)
    assert sync.max_batch_date(empty).select(F.col("cutoff").cast("string")).first()[0].startswith("0001-01-01")
    assert writes.index_write(empty, sync.stamp(batch(spark, []), "2024-01-01")).count() == 0
