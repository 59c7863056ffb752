"""Paging, predicates, text analysis, schema and tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions import predicates as P
from keelson.functions import scalars as X
from keelson.operators import analyze as A
from keelson.operators import enrich, schema, search, writes
from keelson.sources import readers, tables


def test_pages(spark):
    rows = spark.createDataFrame([(i, (i + 1) * 5.0) for i in range(25)], "id int, price double")
    out = readers.pages(rows, ["price"], 10)
    assert sorted(r["count"] for r in out.groupBy("page").count().collect()) == [5, 10, 10]
    assert {r["total"] for r in out.collect()} == {25}
    assert rows.where(P.in_range(F.col("price"), gte=100)).count() == 6
    assert readers.pages(rows.limit(0), ["price"], 10).count() == 0


def test_predicates_are_null_safe(spark):
    rows = spark.createDataFrame([(1, "a", [1]), (2, None, []), (3, "b%", None)], "id int, s string, xs array<int>")
    assert [r["id"] for r in rows.where(P.must_not(F.col("s") == "a")).orderBy("id").collect()] == [2, 3]
    assert [r["id"] for r in rows.where(P.exists(F.col("xs"), True)).collect()] == [1]
    assert [r["id"] for r in rows.where(P.wildcard(F.col("s"), "?%")).collect()] == [3]


def test_range_match_large_set(spark):
    rows = spark.createDataFrame([(float(i),) for i in range(20)], "v double")
    ranges = spark.createDataFrame([("a", None, 5.0), ("b", 3.0, 9.0), ("c", 15.0, None)], "name string, gte double, lte double")
    few = sorted((r["v"], r["name"]) for r in search.range_match(rows, "v", ranges).collect())
    many = sorted((r["v"], r["name"]) for r in search.range_match(rows, "v", ranges, most=1).collect())
    assert few == many and len(few) == 6 + 7 + 5


def test_tier_and_normaliser(spark):
    rows = spark.createDataFrame([("Widgets",), ("GADGETS",), ("Café ",)], "s string")
    assert [r[0] for r in rows.select(A.normalise(F.col("s"))).collect()] == ["widgets", "gadgets", "cafe"]


def test_autocomplete_prefix(spark):
    rows = spark.createDataFrame([(1, "Premium Carbon Widget"), (2, "Basic"), (3, None)], "id long, name string")
    q = spark.createDataFrame([(1, "Prem")], "query_id long, text string")
    whole = A.autocomplete_index(rows, "id", "name")
    assert [r["doc_id"] for r in A.autocomplete(whole, q).collect()] == [1]
    for most in (0, 100):
        own = A.autocomplete_index(rows, "id", "name", queries=q, most=most)
        assert [tuple(r) for r in own.collect()] == [("prem", 1)] and [r["doc_id"] for r in A.autocomplete(own, q).collect()] == [1]


def test_shingles_show_gaps(spark):
    t = spark.createDataFrame([(1, 0, "a"), (1, 2, "c"), (1, 3, "d")], "doc_id long, pos int, token string")
    assert sorted(r["token"] for r in A.shingles(t, 2, 2, unigrams=False).collect()) == ["a _", "c d"]


def test_word_delimiter(spark):
    t = spark.createDataFrame([(1, 0, "PowerShot500-x")], "doc_id long, pos int, token string")
    assert sorted(r["token"] for r in A.word_delimiter(t, catenate_all=True).collect()) == sorted(["Power", "Shot", "500", "x", "PowerShot500x"])


def test_clean_and_html(spark):
    t = spark.createDataFrame([(1, 0, "it's"), (1, 0, "it’s"), (1, 1, "٣")], "doc_id long, pos int, token string")
    assert sorted(r["token"] for r in A.clean(t).collect()) == ["3", "it"]
    h = spark.createDataFrame([("<p>a &lt;b&gt;</p>",)], "h string").select(F.trim(A.html_strip(F.col("h")))).first()[0]
    assert h == "a <b>"


def test_response_shapes(spark):
    rows = spark.createDataFrame([('```json\n{"a": "1"}\n```',), ('{"a": "2"}}',), ("[1]",), ("no",), (None,)], "t string")
    assert [r["a"] for r in rows.select(*X.response_fields(F.col("t"), ["a"])).collect()] == ["1", "2", None, None, None]


def test_completion_splits(spark):
    def fails_on_seven(prompts):
        if "7" in prompts:
            raise enrich.CompletionError(503)
        return prompts

    rows = spark.createDataFrame([(i, str(i)) for i in range(20)], "_id long, prompt string").coalesce(1)
    out = {r["_id"]: (r["status"], r["depth"]) for r in enrich.complete(rows, fails_on_seven).collect()}
    assert out[0] == ("ok", 2) and out[7] == ("failed", 2) and out[15] == ("ok", 1)


def test_age_and_orphans(spark):
    cache = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-03-01 00:00:00"), ("orphan", "2024-03-01 00:00:00")], "match string, at string").select("match", F.col("at").cast("timestamp").alias("created_at"))
    table = spark.createDataFrame([("a",), ("b",)], "_id string")
    assert enrich.existing(cache, table, "_id").count() == 2
    assert enrich.younger(cache.where("match <> 'orphan'"), "2024-03-01 00:00:00", 30 * 86400).count() == 1


def test_typed_read_counts_malformed(spark):
    rows = spark.createDataFrame([('{"n": "x", "d": "2024-01-01"}',), ("broken",), (None,)], "j string")
    out = schema.typed_read(rows, "j", {"n": "long", "d": "date"}).collect()
    assert [r["malformed"] for r in out] == [1, 0, 0] and out[0]["n"] is None and out[0]["d"] is not None


def test_table_root(spark, tmp_path):
    root = tables.TableRoot(spark, str(tmp_path / "root"))
    root.write("t-2024.01.01", spark.range(3))
    root.publish(["t-latest"], "t-2024.01.01", "t-%")
    root.write("t-2024.01.02", spark.range(5))
    assert root.read("t", "t-latest").count() == 3
    root.publish(["t-latest", "t"], "t-2024.01.02", "t-%")
    assert root.read("t", "t-latest").count() == 5 and root.latest("t-") == "t-2024.01.02"
    assert root.aliases().count() == 2


def test_bucketed_table_rewrites_touched_buckets_only(spark, tmp_path):
    t = tables.BucketedTable(spark, str(tmp_path / "b"), 8)
    empty = spark.createDataFrame([], "_id string, _version long, v int")

    def put(old, new):
        return writes.index_write(old, new).drop("result")

    first = spark.createDataFrame([*[(str(i), 1, i) for i in range(50)], (None, 1, 9)], "_id string, seq int, v int")
    assert len(t.write(first, put, empty)) == 8
    before = t.state()
    touched = t.write(spark.createDataFrame([("7", 1, 700), ("7", 2, 701)], "_id string, seq int, v int"), put, empty)
    after = t.state()
    assert len(touched) == 1 and [b for b in before if before[b] != after[b]] == touched
    rows = {r["_id"]: (r["_version"], r["v"]) for r in t.read().collect()}
    assert len(rows) == 50 and rows["7"] == (2, 701) and rows["8"] == (1, 8)
    assert t.write(first.limit(0), put, empty) == []
    ids = t.read(touched).select("_id").collect()
    t.write(spark.createDataFrame(ids, "_id string"), writes.delete_ids, empty)
    assert touched[0] not in t.buckets() and t.read().count() == 50 - len(ids) and t.read(touched) is None
