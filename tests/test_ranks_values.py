"""Ranks that hold whatever Spark samples, and values that pass through Python unchanged."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from keelson.operators import enrich, maintain
from keelson.sources import readers, tables
from keelson.streaming import delivery as D

BIG = 9007199254740993


@pytest.fixture
def sampled(spark):
    """Range exchanges see one row of each part only, so two of them differ."""
    key = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    spark.conf.set(key, "1")
    yield spark
    spark.conf.unset(key)


def payload(spark, n, parts):
    k = F.xxhash64("id")
    return spark.range(0, n, 1, parts).select(k.alias("k"), F.concat(F.lit("payload "), "id").alias("payload"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("maybe"))


def ranked(df, size):
    return df.withColumn("want", F.floor((F.row_number().over(Window.orderBy("k")) - 1) / size).cast("long"))


def test_pages_carry_a_payload(sampled):
    rows = payload(sampled, 5000, 4)
    got = readers.pages(rows, ["k"], 10)
    assert {r["n"] for r in got.groupBy("page").agg(F.count("*").alias("n")).collect()} == {10}
    assert got.select("total").distinct().collect()[0][0] == 5000
    assert got.select("k", "page").join(ranked(rows, 10), "k").where("page <> want").count() == 0


@pytest.mark.parametrize("parts", [4, 60])
def test_pages_of_a_million_rows(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        rows = payload(spark, 1_000_000, 5)
        with tables.discarding(spark):
            got = readers.pages(rows, ["k"], 1000)
            assert got.select("k", "page").join(ranked(rows.select("k"), 1000), "k").where("page <> want").count() == 0
            assert got.where("payload IS NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_chunks_batches_and_caps(sampled):
    rows = payload(sampled, 3000, 5)
    for got, name, size in ((enrich.chunked(rows, "k", 20), "chunk", 20), (D.count_batches(rows, ["k"], 100), "batch", 100)):
        assert got.join(ranked(rows, size).select("k", "want"), "k").where(f"{name} <> want").count() == 0
    kept, dropped = D.overflow(rows, ["k"], 777)
    assert kept.count() == 777 and dropped.count() == 2223 and kept.agg(F.max("k")).first()[0] < dropped.agg(F.min("k")).first()[0]


def test_discarding_removes_work_tables(spark):
    with tables.discarding(spark):
        _, path = tables.pinned(spark.range(3), "gone")
        assert tables.names(spark, path)
        with tables.discarding(spark):
            _, inner = tables.pinned(spark.range(3), "inner")
        assert not tables.names(spark, inner) and tables.names(spark, path)
    assert not tables.names(spark, path)


SCHEMA = "id long, n long, money decimal(30,4), at timestamp, day date, raw binary, flag boolean, small int, name string, tags array<string>, pair struct<a:long,b:string>"


def values():
    full = (1, BIG, Decimal("12345678901234567890.1234"), dt.datetime(2024, 2, 29, 1, 2, 3, 456789), dt.date(1969, 1, 2), bytearray(b"\x00\xff"), True, 7, "é\x00x", ["a", None], (BIG, "b"))
    return [full, (2, *[None] * 10), (3, -BIG, *full[2:]), (BIG, None, *full[2:6], None, None, None, None, None), (None, BIG, *full[2:])]


def whole(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_byte_batches_keep_values(spark):
    rows = spark.createDataFrame(values(), SCHEMA).coalesce(1)
    out = D.byte_batches(rows.withColumn("page", F.lit(0)), "page", "id", F.lit(60), 100)
    assert out.columns == [*rows.columns, "page", "batch"] and whole(out.select(*rows.columns)) == whole(rows)
    assert [(r["id"], r["batch"]) for r in out.orderBy(F.col("id").asc_nulls_first()).collect()] == [(None, 0), (1, 1), (2, 2), (3, 3), (BIG, 4)]
    maps = rows.select("id", F.create_map(F.lit("k"), "n").alias("m"), F.lit(None).cast("int").alias("page"))
    assert whole(D.byte_batches(maps, "page", "id", F.lit(1), 100).select("id", "m")) == whole(maps.select("id", "m"))


def test_retries_keep_values(spark):
    rows = spark.createDataFrame(values(), SCHEMA).coalesce(1)
    seen_right = lambda r, a: [201 if isinstance(n, int) and abs(n) == BIG else 400 for n in r["n"]]
    out = D.send_with_retries(rows, seen_right)
    assert whole(out.drop("status", "attempts", "outcome")) == whole(rows)
    assert sorted(r["status"] for r in out.collect()) == [201, 201, 201, 400, 400]


def test_client_reindex_keeps_values(spark):
    rows = spark.createDataFrame(values()[:4], SCHEMA).coalesce(1).withColumn("_id", F.col("id").cast("string")).withColumn("_version", F.lit(1).cast("long"))
    empty = rows.limit(0)

    def fn(pdf):
        return pdf.assign(name=pdf["name"].fillna("none"))

    out = maintain.client_reindex(rows, empty, fn).drop("result")
    assert whole(out.select(*rows.columns)) == whole(rows.withColumn("name", F.coalesce("name", F.lit("none"))))


@pytest.mark.parametrize("group", [None, "g"])
def test_answers_keep_their_keys(spark, group):
    for kind, keys in (("long", [BIG, None, BIG - 1, BIG + 2]), ("decimal(30,2)", [Decimal("9007199254740993.01"), None]), ("binary", [bytearray(b"\xff"), None]), ("timestamp", [dt.datetime(2024, 1, 1, 0, 0, 0, 1), None])):
        rows = spark.createDataFrame([(k, f"p{k}", 0) for k in keys], f"_id {kind}, prompt string, g int").coalesce(1)
        out = enrich.complete(rows, lambda prompts: list(prompts), group=group)
        assert out.schema["_id"].dataType == rows.schema["_id"].dataType
        assert whole(out.select("_id", "answer")) == whole(rows.select("_id", "prompt"))
