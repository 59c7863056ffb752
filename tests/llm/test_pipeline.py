"""Each pipeline stage against brute force on the smallest tables."""

from __future__ import annotations

import corpus_pipeline
from keelson.llm import decontam, work
from keelson.sources import tables

from .test_copies import brute_kept
from .test_pairs import brute_contamination

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").unionByName(spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "12 34", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long"))
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language", "near_duplicates", "decontamination", "pii", "packing"]

    kept = work.pinned(steps["language"](spark, docs, DATA), "t")
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    letters = {r["doc_id"] for r in docs.collect() if r["text"] and any(c.isalpha() for c in r["text"])}
    assert {r["doc_id"] for r in kept.collect()} == letters

    rows = kept.collect()
    first = [rows[i]["doc_id"] for i in brute_kept([(r["doc_id"], r["text"]) for r in rows])]
    unique = work.pinned(steps["near_duplicates"](spark, kept, DATA), "t")
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(first)

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = brute_contamination([(r["doc_id"], r["text"]) for r in unique.collect() if len(r["text"]) < 3000], items)
    clean = work.pinned(steps["decontamination"](spark, unique, DATA), "t")
    left = {r["doc_id"] for r in clean.collect()}
    assert all((d in left) == (not found) for d, found in want.items()) and decontam.words_of("A, b") == ["a", "b"]

    private = work.pinned(steps["pii"](spark, clean, DATA), "t")
    assert private.columns == list(corpus_pipeline.COLUMNS) and {r["doc_id"] for r in private.collect()} == left
    assert private.where("n_chars <> length(text)").count() == clean.where("n_chars <> length(text)").count()

    pieces = steps["packing"](spark, private, DATA)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == left
    assert corpus_pipeline.ORACLE_SQL is None


def test_discarding(spark):
    """Work tables go at the end of their own scope, also if it fails; what is made outside stays."""

    def folder():
        return tables.names(spark, work.shared_dir(spark))

    stays = work.pinned(spark.range(3), "outside")
    before = folder()
    with work.discarding(spark):
        work.pinned(spark.range(3), "one")
        try:
            with work.discarding(spark):
                work.pinned(spark.range(3), "two")
                raise ValueError
        except ValueError:
            assert len(folder()) == len(before) + 1
        kept, path = work.written(spark.range(4), "result")
    assert set(folder()) - set(before) == {path.rsplit("/", 1)[1]} and (kept.count(), stays.count()) == (4, 3)
