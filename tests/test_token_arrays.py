"""Token filters straight from arrays of tokens: the rows of the table's filters, and no token is shuffled."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from keelson.operators import analyze as A

TEXTS = [(1, "the cat of the house"), (2, "of"), (3, ""), (4, None), (5, "plain words only"), (6, "x the"), (7, "the the the"), (7, "a b")]


def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


def array():
    return A.standard(F.lower("text"))


def bag(df):
    return Counter(map(tuple, df.collect()))


def shuffled(df):
    return str(df._jdf.queryExecution().optimizedPlan().toString()), df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_min_hash_is_found_in_the_row(spark):
    """Before, every different token of a document was shuffled, and once more for each seed."""
    md5 = lambda token, seed: F.md5(F.concat_ws(":", seed.cast("string"), token))
    for digest in (F.xxhash64, md5):
        got = A.min_hash_tokens(docs(spark), "doc_id", array(), 5, digest)
        assert shuffled(got)[1] == 1  # before a run, as a plan that has run is shown twice
        assert bag(got) == bag(A.min_hash(A.tokens(docs(spark), "doc_id", array()), 5, digest))
        assert {r[0] for r in got.collect()} == {1, 2, 5, 6, 7}


def test_common_grams_of_neighbours_in_the_array(spark):
    """Before, all tokens were shuffled and sorted to find the next one.  Rows of one id are texts of their own here."""
    words = spark.createDataFrame([("the",), ("of",), ("the",)], "word string")
    apart = docs(spark).where("doc_id <> 7 OR text = 'the the the'")
    got = A.common_gram_tokens(apart, "doc_id", array(), words)
    assert bag(got) == bag(A.common_grams(A.tokens(apart, "doc_id", array()), words))
    assert "Window" not in shuffled(got)[0]
    assert bag(got.where("doc_id = 6")) == Counter({(6, 0, "x"): 1, (6, 0, "x_the"): 1, (6, 1, "the"): 1})


def test_clean_of_one_token_a_position_shuffles_nothing(spark):
    marked = F.array(F.lit("it's"), F.lit("٣०"), F.lit("u.s.a."), F.lit("'"), F.lit("plain"))
    table = A.tokens(docs(spark).where("doc_id <> 7"), "doc_id", marked)
    got = A.clean(table, stacked=False)
    assert shuffled(got)[1] == 0 and bag(got) == bag(A.clean(table))
    assert {r["token"] for r in got.collect()} == {"it", "30", "usa", "plain"}


def test_folding_leaves_ascii_as_it_is(spark):
    df = spark.createDataFrame([("plain",), ("",), (None,), ("Çédille Straße Ærø",), ("日本",), ("é",)], "s string")
    assert [r[0] for r in df.select(A.fold(F.col("s"))).collect()] == ["plain", "", None, "Cedille Strasse AEro", "日本", "e"]
    assert "octet_length" in A.fold(F.col("s"))._jc.toString().lower()
