"""Stored queries that are counted by ranks, and entered by a range together with a value."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from keelson.operators import search

DDL = "query_id long, occur string, field string, lo double, hi double, value string, minimum_should_match int"
NAN = float("nan")


def one(i, field, lo=None, hi=None, value=None, occur="must", least=None):
    return (i, occur, field, lo, hi, value, least)


def stored(spark):
    rows = [
        one(1, "x", 2.0, 5.0), one(2, "x", None, 0.0), one(3, "x", 3.0), one(4, "x", NAN, None), one(5, "x", None, NAN), one(6, "x", 5.0, 2.0), one(7, "x"), one(8, "gone", 1.0), one(9, "s", value="a"),
        one(10, "s", value="nowhere"), one(11, "x", 3.0, 4.0, occur="should"), one(12, "x", 3.0, 4.0, occur="should", least=0), one(13, "x", 3.0, 4.0, least=1), one(14, "x", 3.0, 4.0, occur="must_not"),
        one(15, "x", 1.0, 6.0), one(15, "s", value="a"), one(15, "y", 2.0, occur="must_not"), one(16, "s", value="a"), one(16, "s", value="b"), one(17, "x", 1.0), one(17, "x", None, 3.0), one(18, "y", 2.0, 2.0), one(19, "x", 3.0, None, "3.0"),
        one(20, "x", 1.0, 4.0, occur="should", least=1), one(20, "y", 1.0, 2.0, occur="should", least=1), (None, "must", "x", 1.0, None, None, None),
    ]
    return spark.createDataFrame(rows, DDL)


def table(spark):
    x = F.when(F.col("id") % 11 == 0, F.lit(NAN)).when(F.col("id") % 13 == 0, None).when(F.col("id") % 17 == 0, -0.0).otherwise((F.col("id") % 8).cast("double"))
    return spark.range(400).select("id", x.alias("x"), (F.col("id") % 4).cast("double").alias("y"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None).cast("string")), (F.col("id") % 3 + 1).cast("int")).alias("s"))


def below(a, b):
    """a <= b as Spark orders doubles."""
    return b != b or (a == a and a <= b)


def holds(c, r):
    _, _, field, lo, hi, value, _ = c
    if field not in ("x", "y", "s"):
        return False
    v = r[field]
    if (lo is not None or hi is not None) and (v is None or (lo is not None and not below(lo, v)) or (hi is not None and not below(v, hi))):
        return False
    return value is None or (v is not None and str(v) == value)


def wanted(rows, queries):
    found, by = Counter(), {}
    for c in queries:
        if c[0] is not None:
            by.setdefault(c[0], []).append(tuple(c))
    for q, clauses in by.items():
        musts, shoulds = ([c for c in clauses if c[1] == k] for k in ("must", "should"))
        least = next((c[6] for c in clauses if c[6] is not None), 1 if shoulds and not musts else 0)
        for r in rows:
            if all(holds(c, r) for c in musts) and not any(holds(c, r) for c in clauses if c[1] == "must_not") and sum(holds(c, r) for c in shoulds) >= least:
                found[q] += 1
    return dict(found)


def test_counts_are_those_of_the_pairs(spark):
    rows, queries = table(spark), stored(spark)
    want = wanted(rows.collect(), queries.collect())
    for most in (1, 10_000):
        pairs = search.stored_queries(rows, queries, ["x", "y", "s"], most=most).groupBy("query_id").count()
        assert {r[0]: r[1] for r in pairs.collect()} == want
        assert {r["query_id"]: r["n"] for r in search.stored_counts(rows, queries, ["x", "y", "s"], most=most).collect()} == want


def test_counts_of_ranges_make_no_pairs(spark):
    """100,000 ranges that hold all of 200,000 rows: 20 billion pairs, which are counted without being made."""
    rows = spark.range(200_000).select((F.col("id") % 1000).cast("double").alias("x"))
    ranges = spark.range(100_000).select(F.col("id").alias("query_id"), F.lit("x").alias("field"), F.lit(-1.0).alias("lo"), F.lit(1000.0).alias("hi"), F.lit(None).cast("string").alias("value"))
    assert search.stored_counts(rows, ranges, ["x"], most=10).agg(F.count("*"), F.min("n"), F.max("n")).first()[:] == (100_000, 200_000, 200_000)


def test_wide_ranges_are_entered_with_a_value(spark):
    """Candidates are cut by the value that the query needs too, and the condition has no functions on lambdas, which Spark can't compile."""
    rows, queries = table(spark), spark.createDataFrame([one(q, "x", 0.0, 7.0) for q in range(50)] + [one(q, "s", value="a") for q in range(50)] + [one(q, "y", 1.0, 1.0, occur="must_not") for q in range(50)], DDL)
    index = search._QueryIndex(rows, queries, ["x", "y", "s"], 1)
    entries = index.entries()
    assert {r["_field"] for r in entries.select("_field").distinct().collect()} <= {"x\0s", "s"}
    assert "lambda" not in str(index.met()._jc.toString()).lower()
    got = search.stored_queries(rows, queries, ["x", "y", "s"], most=1)
    assert {r[0]: r[1] for r in got.groupBy("query_id").count().collect()} == wanted(rows.collect(), queries.collect())
