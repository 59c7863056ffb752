"""Operators that change their plan with size give the same rows below and above it; options of text filters."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from keelson.functions import predicates as P
from keelson.operators import analyze as A
from keelson.operators import search, writes
from keelson.sources import readers, tables
from keelson.streaming import delivery


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_ranges_of_numbers(spark):
    rows = spark.createDataFrame([(v,) for v in (None, -5.0, 0.0, 1.0, 1.0, 2.5, 10.0, 99.0)], "v double")
    ranges = spark.createDataFrame([("all", None, None), ("low", None, 1.0), ("mid", 1.0, 2.5), ("high", 2.5, None), ("none", 5.0, 3.0), ("point", 10.0, 10.0)], "name string, gte double, lte double")
    few = bag(search.range_match(rows, "v", ranges).select("v", "name"))
    assert few == bag(search.range_match(rows, "v", ranges, most=2).select("v", "name"))
    assert not any(v is None for v, _ in few) and len([x for x in few if x[1] == "all"]) == 7
    open_ = spark.createDataFrame([("all", None, None)] * 3, "name string, gte double, lte double")
    assert bag(search.range_match(rows, "v", open_, most=1)) == bag(search.range_match(rows, "v", open_))


@pytest.mark.parametrize(("ddl", "make"), [("date", lambda k: dt.date(2024, 1, 1) + dt.timedelta(k)), ("timestamp", lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(hours=k)), ("int", lambda k: k)])
def test_ranges_of_other_types(spark, ddl, make):
    rows = spark.createDataFrame([(make(k),) for k in range(30)] + [(None,)], f"v {ddl}")
    ranges = spark.createDataFrame([(f"r{k}", make(k), make(k + 4) if k % 3 else None) for k in range(0, 30, 2)], f"name string, gte {ddl}, lte {ddl}")
    assert bag(search.range_match(rows, "v", ranges, most=2).select("v", "name")) == bag(search.range_match(rows, "v", ranges).select("v", "name"))


def test_stored_queries(spark):
    rows = spark.createDataFrame([(1, 5.0, "x"), (2, None, "y"), (3, 50.0, None), (4, 5.0, "x")], "id int, n double, s string")
    queries = spark.createDataFrame(
        [(1, "n", 1.0, 10.0, None), (2, "n", None, 5.0, None), (3, "s", None, None, "x"), (4, "n", None, None, None), (5, "s", None, None, None), (6, "n", 5.0, None, "5.0"), (7, "other", 1.0, 2.0, None), (8, "n", 9.0, 2.0, None)],
        "query_id int, field string, lo double, hi double, value string",
    )
    few = search.stored_queries(rows, queries, ["n", "s"]).select("id", "query_id")
    assert bag(few) == bag(search.stored_queries(rows, queries, ["n", "s"], most=1).select("id", "query_id"))
    assert (2, 4) in bag(few) and (1, 6) in bag(few) and not any(q in (7, 8) for _, q in bag(few))


NAN, INF = float("nan"), float("inf")


def test_nan_and_infinity_in_ranges(spark):
    values = [None, -INF, -1.0, 0.0, 1.0, 5.0, 1e300, INF, NAN]
    ranges = [("up", 1.0, None), ("down", None, 1.0), ("all", None, None), ("nan", NAN, NAN), ("to nan", 5.0, NAN), ("inf", -INF, INF), ("high", INF, None), ("low", None, -INF), ("mid", 0.0, 5.0)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    stored = spark.createDataFrame(ranges, "name string, gte double, lte double")
    order = lambda x: (1, 0.0) if math.isnan(x) else (0, x)
    want = sorted(((repr(v), n) for v in values if v is not None for n, lo, hi in ranges if (lo is None or order(v) >= order(lo)) and (hi is None or order(v) <= order(hi))), key=repr)
    for most in (10, 0):
        assert sorted(((repr(r["v"]), r["name"]) for r in search.range_match(rows, "v", stored, most=most).collect()), key=repr) == want
    queries = stored.selectExpr("name AS query_id", "'v' AS field", "gte AS lo", "lte AS hi", "cast(NULL AS string) AS value")
    want = sorted([*want, ("None", "all")], key=repr)
    for most in (10, 0):
        assert sorted(((repr(r["v"]), r["query_id"]) for r in search.stored_queries(rows, queries, ["v"], most=most).collect()), key=repr) == want


def brute_clauses(rows, clauses, fields):
    def holds(row, field, lo, hi, value):
        if field not in fields:
            return False
        own = row[field]
        try:
            num = None if own is None else float(own)
        except ValueError:
            num = None
        text = None if own is None else own if isinstance(own, str) else repr(own)
        return (lo is None or (num is not None and num >= lo)) and (hi is None or (num is not None and num <= hi)) and (value is None or text == value)

    out = []
    for q in dict.fromkeys(c[0] for c in clauses):
        mine = [c for c in clauses if c[0] == q]
        musts, shoulds = [c for c in mine if c[1] in (None, "must")], [c for c in mine if c[1] == "should"]
        least = next((c[6] for c in mine if c[6] is not None), 1 if shoulds and not musts else 0)
        for row in rows:
            met = lambda cs: sum(holds(row, *c[2:6]) for c in cs)  # noqa: B023, E731
            if met(musts) == len(musts) and not met([c for c in mine if c[1] == "must_not"]) and met(shoulds) >= least:
                out.append((row["id"], q))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_stored_queries_of_several_clauses(spark, seed):
    """Random queries against brute force, below and above the broadcast bounds; the rows have columns named as clauses."""
    r = random.Random(seed)
    rows = [{"id": i, "value": r.choice([None, *map(float, range(8))]), "field": r.choice([None, "x", "y", "3"]), "lo": r.choice([0.0, 1.5, -2.0]), "hi": "x" if i % 3 else "h"} for i in range(60)]
    fields = ["value", "field", "lo", "hi"]

    def clause(q, least):
        field = r.choice([*fields, "absent"] if r.random() < 0.1 else fields)
        kind = r.random()
        lo, hi = (r.choice([None, 0.0, 2.0, 3.0]), r.choice([None, 1.0, 4.0, 7.0])) if kind < 0.6 else (None, None)
        return (q, r.choice(["must", "should", "should", "must_not", None]), field, lo, hi, r.choice(["x", "y", "h", "3", "1.5", "2.0"]) if kind > 0.5 else None, least)

    clauses = []
    for q in range(60):
        least = r.choice([None, None, 0, 1, 2, 3])
        clauses += [clause(q, least) for _ in range(r.randint(1, 5))]
    want = brute_clauses(rows, clauses, fields)
    frame = spark.createDataFrame([tuple(x.values()) for x in rows], "id int, value double, field string, lo double, hi string").repartition(3)
    stored = spark.createDataFrame(clauses, "query_id int, occur string, field string, lo double, hi double, value string, minimum_should_match int").repartition(3)
    for most in (10_000, 1):
        assert sorted((x["id"], x["query_id"]) for x in search.stored_queries(frame, stored, fields, most=most).select("id", "query_id").collect()) == want


def test_stored_queries_without_rows_or_queries(spark):
    rows, ddl = spark.createDataFrame([(1.0,)], "v double"), "query_id int, field string, lo double, hi double, value string"
    one = spark.createDataFrame([(1, "v", 0.0, None, None)], ddl)
    assert search.stored_queries(rows, one.limit(0), ["v"]).count() == 0 and search.stored_queries(rows.limit(0), one, ["v"]).count() == 0
    with pytest.raises(ValueError, match="another name"):
        search.stored_queries(rows.withColumnRenamed("v", "query_id"), one, [])
    assert search.stored_queries(rows.withColumn("query_id", F.lit(5)), one, ["v"], name="found").collect()[0]["found"] == 1


@pytest.mark.parametrize("depth", [1, 3, 20])
def test_completions(spark, depth):
    r = random.Random(depth)
    texts = ["".join(r.choice("abé") for _ in range(r.randint(0, 6))) for _ in range(300)] + [None, "same", "same", "same"]
    rows = [(i, t, r.randrange(5)) for i, t in enumerate(texts)]
    asked = ["", "a", "ab", "abé", "ab", "bbbb", "é", "zz", "same", "sam", None, "abababab"]
    index = search.completions(spark.createDataFrame(rows, "id int, t string, w int").repartition(4), "t", [F.col("w").desc(), F.col("id")], 3, depth=depth)
    got = bag(search.completed(index, spark.createDataFrame([(p,) for p in asked], "prefix string")).select("prefix", "rank", "id"))
    want = [(p, k + 1, i) for p in set(asked) - {None} for k, (_, i) in enumerate(sorted((-w, i) for i, t, w in rows if t is not None and t.startswith(p))[:3])]
    assert got == sorted(want, key=repr)


def test_one_winner_of_equal_seq(spark):
    batch = spark.createDataFrame([("a", 1, i) for i in range(20)] + [(None, 1, 5)], "_id string, seq int, v int")
    target = spark.createDataFrame([], "_id string, _version long, v int")
    for pick in (writes.last_per_id, writes.first_per_id):
        assert bag(pick(batch.repartition(7))) == bag(pick(batch.coalesce(1))) and pick(batch).count() == 1
    assert bag(writes.index_write(target, batch.repartition(5))) == bag(writes.index_write(target, batch.repartition(2)))
    made, conflicts = writes.create_write(target, batch)
    assert made.first()["v"] == writes.first_per_id(batch).first()["v"] and conflicts.count() == 19


def test_batches_by_any_order(spark):
    rows = [(1, None, 5), (1, "b", 60), (1, "a", 50), (1, "a", 45), (1, "c", 200), (2, "z", 1)]
    out = delivery.byte_batches(spark.createDataFrame(rows, "page int, k string, bytes int"), "page", "k", F.col("bytes"), 100)
    assert bag(out) == sorted([(1, None, 5, 0), (1, "a", 45, 0), (1, "a", 50, 0), (1, "b", 60, 1), (1, "c", 200, 2), (2, "z", 1, 0)], key=repr)


def test_produced_rows(spark):
    path = tables.scratch(spark, "produced")
    sent = [{"id": i, "name": f"n{i}"} for i in range(7)]
    assert readers.handed_over(spark, iter(sent), "id long, name string", path, most=3) == 7
    spark.createDataFrame([("{broken",), ("",), ('{"id": 9}',)], "value string").coalesce(1).write.mode("append").text(path)
    got = bag(readers.produced(spark, path, "id long, name string"))
    assert got == sorted([(i, f"n{i}", None) for i in range(7)] + [(9, None, None), (None, None, "{broken")], key=repr)
    out = tables.scratch(spark, "streamed")
    delivery.drain(delivery.append_stream(readers.produced(spark, path, "id long, name string", stream=True), out, tables.scratch(spark, "checkpoint")))
    assert bag(spark.read.parquet(out)) == got


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


def test_entities_and_spared_tags(spark):
    text = "a&lt;b&gt; &eacute;&#233;&#xE9;&#x1F642; &amp;lt; &nope; &#0;&#xD800;&#1114112; <b>x</b> <br/><script>no</script>&nbsp;y &"
    assert one(spark, lambda c: A.html_strip(c, ("b",)), text) == "a<b> ééé🙂 &lt; &nope; &#0;&#xD800;&#1114112; <b>x</b>    y &"
    assert one(spark, A.html_strip, None) is None


def test_folding_beyond_latin_1(spark):
    assert one(spark, A.fold, "Łódź žluťoučký İstanbul ığdır Đồng œuvre straße ĳs ø") == "Lodz zlutoucky Istanbul igdir Dong oeuvre strasse ijs o"


def test_word_delimiter_options(spark):
    def cut(token, **how):
        t = spark.createDataFrame([(1, 0, token)], "doc_id int, pos int, token string")
        return [r["token"] for r in A.word_delimiter(t, **how).collect()]

    assert cut("PowerShot500-42's") == ["Power", "Shot", "500", "42"]
    assert cut("wi-fi-4000-12", catenate_words=True, catenate_numbers=True, generate_word_parts=False, generate_number_parts=False) == ["wifi", "400012"]
    assert cut("PowerShot500", split_on_case_change=False, split_on_numerics=False) == ["PowerShot500"]
    assert cut("a-b", preserve_original=True, catenate_all=True) == ["a-b", "a", "b", "ab"]
    assert cut("a-b", protected_words=("a-b",)) == ["a-b"] and cut("--") == []
    assert cut("O'Neil's", stem_english_possessive=False) == ["O", "Neil", "s"]


def test_small_clean_ups(spark):
    assert one(spark, A.decimal_digit, "٣०๔５") == "3045"
    assert one(spark, A.classic, "U.S.A.") == "USA" and one(spark, A.classic, "dog's") == "dog" and one(spark, A.classic, "a.b") == "a.b"
    assert one(spark, lambda c: P.flattened_keys(c, 3), '{"a":{"b":{"c":{"d":1}}},"e":[1],"f":{}}') == ["a.b.c", "e", "f"]
    assert one(spark, A.url_email, "see https://x.y/z?q=1 or a.b@c.de, " + "p." * 20_000)[:4] == ["see", "https://x.y/z?q=1", "or", "a.b@c.de"]


def test_synonyms_of_several_words(spark):
    t = A.tokens(spark.createDataFrame([(1, "the new york times in new york")], "id int, t string"), "id", A.whitespace(F.col("t")))
    rules = spark.createDataFrame([("new york", "nyc"), ("new york times", "nyt"), ("in", "within")], "word string, synonym string")
    got = [(r["pos"], r["token"], r["span"]) for r in A.synonym_graph(t, rules, expand=False).orderBy("pos", "token").collect()]
    assert got == [(0, "the", 1), (1, "nyc", 2), (1, "nyt", 3), (4, "within", 1), (5, "nyc", 2)]
    assert A.synonym_graph(t, rules).count() == 7 + 4
