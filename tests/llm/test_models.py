"""Classifiers: held-out accuracy on the small tables, and odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import grams, langid, quality, queries, rules, toxicity, work

DATA = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a" * 200_000), (5, "1234 !!"), (6, "x y z"), (6, "x y z"), (None, "word"), (7, "🙂 日本語")]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("lang", F.lit("en"))


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    n1 = (y == 1).sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / n1 / (len(y) - n1)


def test_folds_follow_crc32(spark):
    ids = [0, 7, 123456, 99]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").select(work.held_out("doc_id", 5, 0)).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]


def test_quality_held_out(spark, labels):
    out = queries.op2_quality(spark, DATA)
    assert out.count() == 1000
    got = out.join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.93 and auc(got["quality"].to_numpy(), got["score"].to_numpy()) > 0.97
    assert out.where("score < 0 OR score > 1 OR predicted <> CASE WHEN score >= 0.3 THEN 1 ELSE 0 END").count() == 0


def test_toxicity_held_out(spark, labels):
    got = queries.op4_toxicity(spark, DATA).join(labels, "doc_id").where("held_out").toPandas()
    assert auc(got["toxic"].to_numpy(), got["score"].to_numpy()) > 0.85
    assert got[got["toxic"] == 1]["severity"].mean() > 2 * got[got["toxic"] == 0]["severity"].mean()


def test_ordinal_thresholds_rise():
    random = np.random.default_rng(0)
    x = random.integers(0, 2, (600, 5)).astype(float)
    grade = np.clip((x @ np.array([1, 1, 1, 0, 0])).astype(int), 0, 3)
    w, theta = toxicity.fit_ordinal(x, grade, 3)
    assert (np.diff(theta) > 0).all() and w[:3].min() > abs(w[3:]).max()


def test_language_held_out(spark):
    out = queries.op5_language(spark, DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    got = out.join(docs, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_language_counts_match_brute_force(spark):
    rows = [(1, "aB c", "en"), (2, "cd", "fr"), (3, None, "fr"), (4, "x", None)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), orders=(2,), bits=10, smoothing=1.0)
    assert model.languages == ["en", "fr"]
    for k, text in enumerate(("ab c", "cd")):
        table = np.ones(1024)
        for i in range(len(text) - 1):
            table[grams.hashed(np.array([ord(text[i]), ord(text[i + 1])], np.uint32), 2, 10)[0][0]] += 1
        assert np.allclose(model.matrix[:, k], np.log(table / table.sum()))


def test_odd_rows(spark):
    docs = odd(spark)
    model = langid.fit(spark.createDataFrame([(1, "hello there", "en"), (2, "bonjour là", "fr")], "doc_id long, text string, lang string"))
    got = langid.identify(docs, model).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 5)) and by[7]["lang_pred"] != "und"
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (6, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.score(docs, quality.fit(docs, labels)).count() == len(ODD)
    assert toxicity.grade(docs, toxicity.fit(docs, labels, least_docs=1)).count() == len(ODD)
    none = labels.limit(0)
    assert quality.score(docs, quality.fit(docs, none)).where("predicted = 1").count() == len(ODD)
    assert toxicity.grade(docs, toxicity.fit(docs, none)).where("predicted = 1").count() == 0
    empty = docs.limit(0)
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0 and langid.identify(empty, langid.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, langid.fit(empty)).collect()} == {"und"}


def brute_repeats(words):
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    inside = {j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return len(inside)


def test_base_counts_match_brute_force():
    import re

    texts = ["a b c d e f g h " * 3 + "z", "x " * 30, "one\ntwo\none\n\n\none ", "p q r s #|<", "", None, " \n ", " ".join(str(i % 9) for i in range(100)), "é* é* $%&>"]
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), brute_repeats(words))
        assert rules.base_counts(t) == want, t


def test_rules_verdicts(spark):
    docs = odd(spark)
    out = rules.judge(docs, spark.createDataFrame([(4,), (4,), (None,)], "doc_id long"))
    assert out.count() == len(ODD) and out.where("kept AND base_failed").count() == 0
    assert rules.judge(docs.limit(0), docs.select("doc_id")).count() == 0
    assert rules.judge(docs, docs.select("doc_id").limit(0)).where("llr <> 0").count() == 0


def test_rules_keep_labelled_good(spark, labels):
    got = queries.op7_rules(spark, DATA).join(labels, "doc_id")
    good = got.where("quality = 1 AND NOT base_failed")
    assert good.where("kept").count() > 0.97 * good.count()
    bad = got.where("quality = 0 AND NOT base_failed")
    assert bad.where("NOT kept").count() > 0.8 * bad.count()
