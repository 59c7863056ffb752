"""Token graphs, nested profiles and path templates."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from keelson.operators import analyze as A
from keelson.operators import schema as S


def graph(spark, rows):
    return spark.createDataFrame(rows, "doc_id int, pos int, token string, span int")


def bag(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def walks(rows, n):
    """All paths of n tokens, by following them one by one."""
    out = [[r] for r in rows]
    for _ in range(n - 1):
        out = [[*w, r] for w in out for r in rows if r[0] == w[-1][0] and r[1] == w[-1][1] + w[-1][3]]
    return out


ROWS = [(1, 0, "fresh", 1), (1, 0, "new", 1), (1, 1, "york", 1), (1, 0, "nyc", 2), (1, 2, "times", 1), (1, 2, "paper", 1), (1, 3, "sold", 1), (2, 0, "york", 1), (2, 1, "times", 1)]


def test_phrases_on_stacked_tokens(spark):
    """A rule is found although another token stands on top of its first one, and through a token that spans two."""
    rules = spark.createDataFrame([("new york", "big apple"), ("nyc times", "nyt"), ("new york times", "nyt"), ("york times", "yt"), ("sold", "gone"), ("times york", "no")], "word string, synonym string")
    got = bag(A.phrases(graph(spark, ROWS), rules), "doc_id", "pos", "synonym", "span")
    assert got == [(1, 0, "big apple", 2), (1, 0, "nyt", 3), (1, 0, "nyt", 3), (1, 1, "yt", 2), (1, 3, "gone", 1), (2, 0, "yt", 2)]
    left = bag(A.synonym_graph(graph(spark, ROWS), rules, expand=False), "doc_id", "pos", "token", "span")
    assert left == [(1, 0, "big apple", 2), (1, 0, "fresh", 1), (1, 0, "nyt", 3), (1, 1, "yt", 2), (1, 2, "paper", 1), (1, 3, "gone", 1), (2, 0, "yt", 2)]


@pytest.mark.parametrize("high", [2, 3, 4])
def test_shingles_follow_all_paths(spark, high):
    got = bag(A.shingles(graph(spark, ROWS), 2, high), "doc_id", "pos", "token", "size")
    want = {(w[0][0], w[0][1], " ".join(r[2] for r in w), n) for n in range(1, high + 1) for w in walks(ROWS, n)}
    assert got == sorted(want)


def test_both_kinds_of_shingles_agree_without_stacks(spark):
    rows = [(d, p, f"w{p % 3}") for d in range(3) for p in range(9) if (p + d) % 4]
    t = spark.createDataFrame(rows, "doc_id int, pos int, token string")
    for low, high, unigrams in ((2, 2, True), (2, 4, False), (3, 3, True)):
        one, two = (bag(A.shingles(t, low, high, unigrams=unigrams, stacked=s).distinct(), "doc_id", "pos", "token", "size") for s in (False, True))
        assert one == two
    common = spark.createDataFrame([("w1",)], "word string")
    assert bag(A.common_grams(t, common).distinct(), "doc_id", "pos", "token") == bag(A.common_grams(t, common, stacked=True), "doc_id", "pos", "token")
    assert A.shingles(t.limit(0), stacked=True).count() == 0


def test_nested_profiles(spark):
    texts = [json.dumps(x) for x in ({"a": {"b": {"c": {"d": 1}}}, "n": None}, {"a": [{"b": 1}, {"b": 2.5}, [3, "x"]]}, {"a.b": "2024-01-01", "e": "5"}, {}, [1], {"é": True, "big": 2**80})]
    rows = spark.createDataFrame([(t,) for t in [*texts, None, "", "{broken", '{"a": 1, "a": 2}']], "j string")
    assert bag(S.profile(rows, "j", 3), "field", "type", "n") == sorted([
        ("a", "object", 2), ("a", "long", 1), ("a", "string", 1), ("a.b", "object", 1), ("a.b", "long", 1), ("a.b", "double", 1), ("a.b", "date", 1), ("a.b.c", "object", 1), ("e", "string", 1), ("é", "boolean", 1), ("big", "double", 1),
    ])
    assert bag(S.profile(rows, "j"), "field", "type", "n") == sorted([("a", "object", 1), ("a", "array", 1), ("a.b", "date", 1), ("e", "string", 1), ("é", "boolean", 1), ("big", "double", 1)])
    assert S.profile(rows.limit(0), "j", 3).count() == 0


def test_templates_by_name_and_path(spark):
    fields = spark.createDataFrame([("user.name.first", "string"), ("user.age", "long"), ("long_x", "long"), ("longex", "long"), ("u.name.first", "string"), ("a.b_c", "boolean")], "field string, type string")
    templates = [
        {"match": "long_*", "type": "short"}, {"path_match": "user.*", "path_unmatch": "*.age", "type": "text"}, {"match": "first", "match_mapping_type": "string", "type": "keyword"},
        {"match_mapping_type": "*", "unmatch": "*_c", "unmatch_mapping_type": "string", "type": "other"},
    ]
    got = {r["field"]: r["assigned"] for r in S.dynamic_templates(fields, templates).collect()}
    assert got == {"user.name.first": "text", "user.age": "other", "long_x": "short", "longex": "other", "u.name.first": "keyword", "a.b_c": "boolean"}
    assert S.dynamic_templates(fields, []).where(F.col("type") != F.col("assigned")).count() == 0
