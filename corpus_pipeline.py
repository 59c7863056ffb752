"""From documents to packed training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import copies, decontam, langid, packing, pii, tokens, work
from keelson.llm.queries import DEMO_KEY
from keelson.sources import tables

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects rows whose language can't be told (`und`): null, empty and letterless texts.

    Each row is judged by its own text, whatever its id, which may be null or repeated; very long texts are scored in
    blocks.  Equal rows fare alike; other columns than those of documents are dropped; an empty table gives no rows.
    """
    docs = docs.select(*COLUMNS)
    judged = langid.with_language(docs, langid.fit(docs.where(~work.held_out("doc_id", 4, 2))))
    return judged.where(judged["lang_pred"] != langid.UNDETERMINED).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies (5-word shingles, Jaccard 0.8 or more).

    The row with the smallest id stays, nulls last; of equal ids and of equal rows one.  Rows are told apart by a key
    that is written first, so a shared id never drops another group's row.  Null, empty and blank texts are one group;
    a text of under five words is one shingle; very long texts are taken whole.  An empty table gives no rows.
    """
    docs = work.pinned(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "keyed")
    return work.flagged(docs, work.pinned(copies.copies(docs), "rejected"), "row", "_drop").where("NOT _drop").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows whose text holds a benchmark item; the benchmark is `benchmark` of `sf_dir`.

    Each row is judged by its own text, whatever its id; null and empty texts and, with an empty benchmark, all rows
    stay.  Equal rows fare alike; very long texts are read window by window; an empty table gives no rows.
    """
    judged = decontam.with_contamination(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return judged.where("NOT contaminated").select(*COLUMNS)


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces private values by pseudonyms under the key in the setting `keelson.pii.secret`, whose name Spark redacts (a
    demonstration key if unset).

    n_chars follows a text that changed.  Every row stays; null texts stay null; equal values get equal pseudonyms in
    all rows; ids and repeated rows don't matter; an empty table gives no rows.
    """
    key = spark.conf.get("keelson.pii.secret", DEMO_KEY)
    out = pii.pseudonymise(docs.select(*COLUMNS), key).selectExpr("doc_id", "text", "lang", "source", "CASE WHEN size(private) > 0 THEN cast(length(text) AS bigint) ELSE n_chars END AS n_chars")
    return out.select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids, with the ids themselves.

    Every row is packed, repeated ones once each, under its id, which may be null; null and empty texts have the end id
    only; a very long text is cut over sequences; an empty table gives no rows.
    """
    return packing.pack_documents(docs, tokens.default_path(), end_id=1, window=2048)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("pii", privacy), ("packing", pack)]

#: SQL can express neither the model nor the tokenizer; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`; what is between two stages lies in the shared folder.

    A stage's work tables are removed when its rows are written, and its input when the next one's are: the packed
    rows alone stay, for the caller to remove.
    """
    work.prepare(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with work.discarding(spark):
            docs, path = work.written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before:
            tables.remove(spark, before)
        before = path
    return docs
