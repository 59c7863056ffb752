"""Batching and delivery."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.sources.tables import BucketedTable
from keelson.streaming import delivery as D


def rows(spark, n):
    return spark.createDataFrame([(i, i // 100) for i in range(n)], "id long, page long")


def test_byte_batches(spark):
    two = D.byte_batches(rows(spark, 2), "page", "id", F.lit(100), 150)
    assert sorted(r["batch"] for r in two.collect()) == [0, 1]
    big = D.byte_batches(rows(spark, 3), "page", "id", F.when(F.col("id") == 1, 500).otherwise(50), 150)
    assert [r["batch"] for r in big.orderBy("id").collect()] == [0, 1, 2]
    assert [r["id"] for r in D.oversized(rows(spark, 3), F.when(F.col("id") == 1, 500).otherwise(50), 150).collect()] == [1]


def test_retries(spark):
    one = rows(spark, 1)
    ok = D.send_with_retries(one, lambda r, a: [429 if a < 3 else 200] * len(r)).first()
    assert (ok["outcome"], ok["attempts"]) == ("accepted", 4)
    dead = D.send_with_retries(one, lambda r, a: [429] * len(r)).first()
    assert (dead["outcome"], dead["attempts"]) == ("exhausted", 4)
    bad = D.send_with_retries(one, lambda r, a: [400] * len(r)).first()
    assert (bad["outcome"], bad["attempts"]) == ("rejected", 1)
    fatal = D.send_with_retries(one, lambda r, a: 1 / 0).first()
    assert (fatal["outcome"], fatal["status"]) == ("rejected", 0)


def test_overflow(spark):
    kept, dropped = D.overflow(rows(spark, 12), ["id"], 5)
    assert sorted(r["id"] for r in kept.collect()) == list(range(5)) and dropped.count() == 7


def test_upsert_stream_again(spark, tmp_path):
    """A micro-batch that is sent again changes nothing; a later one raises the version of its rows only."""
    source, table = str(tmp_path / "in"), BucketedTable(spark, str(tmp_path / "users"), 4)

    def sent(checkpoint):
        stream = spark.readStream.schema("user string, n long, v int").parquet(source)
        D.drain(D.upsert_stream(stream, table, "user", "n", str(tmp_path / checkpoint)))
        return {r["_id"]: (r["_version"], r["v"]) for r in table.read().collect()}

    spark.createDataFrame([("a", 1, 10), ("a", 2, 11), ("b", 1, 20), (None, 1, 30)], "user string, n long, v int").write.parquet(source)
    assert sent("one") == sent("two") == {"a": (1, 11), "b": (1, 20)}
    spark.createDataFrame([("b", 3, 21)], "user string, n long, v int").write.mode("append").parquet(source)
    assert sent("one") == {"a": (1, 11), "b": (2, 21)}
