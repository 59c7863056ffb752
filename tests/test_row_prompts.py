"""Prompts of rows with blank and null inputs, against the SQL."""

from __future__ import annotations

from collections import Counter

import duckdb

from keelson.operators import enrich as E
from keelson.plans import q_enrich as Q

TEXTS = ("plain", "", "   ", "\t\n", None, " x ", " ")
LANGS = ("en", "", None, "  ", "de")


def test_blank_inputs_are_those_of_the_sql(spark, tmp_path):
    docs = [(i, TEXTS[i % 7], LANGS[i // 7 % 5], "s", 1) for i in range(-20, 400)] + [(None, "no key", "en", "s", 1), (7, "twice", "en", "s", 1), (7, "twice", "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    sql = duckdb.connect()
    for name in ("documents", "labels"):
        sql.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = Counter(sql.execute(Q.E5).fetchall())
    assert Counter(tuple(r) for r in Q.e5(spark, str(tmp_path)).collect()) == want
    assert any(digest is None for _, digest in want)


def test_all_inputs_are_required_unless_named(spark):
    rows = spark.createDataFrame([(1, "a", "b"), (2, " ", "b"), (3, "a", ""), (4, None, "b"), (5, "a", None)], "id int, a string, b string").selectExpr("*", "CAST(NULL AS string) AS out", "CAST(NULL AS string) AS out_ph")
    ids = lambda **more: [r["id"] for r in rows.where(E.row_prompt(["a", "b"], {"out": "what"}, "Role.", **more).isNotNull()).orderBy("id").collect()]
    assert ids() == [1]
    assert ids(required=["a"]) == [1, 3, 5]
    assert ids(required=[]) == [1, 2, 3, 4, 5]
