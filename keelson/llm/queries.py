"""The thirteen queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import binary, chat, clusters, decontam, exact, langid, negatives, packing, pii, quality, rules, simhash, tokens, toxicity, work

#: Key of the registered query only; a user passes a secret of their own.
DEMO_KEY = "keelson-demo-key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    work.prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack_documents(table(spark, sf_dir, "documents"), tokens.default_path(), end_id=1, window=2048))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~work.held_out("doc_id", 5, 0)))
    return quality.score(docs, model).select("doc_id", work.held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(table(spark, sf_dir, "conversations"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~work.held_out("doc_id", 5, 0)))
    return toxicity.grade(docs, model).select("doc_id", work.held_out("doc_id", 5, 0).alias("held_out"), "score", "severity", "grade", "predicted")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~work.held_out("doc_id", 4, 2)))
    return langid.identify(docs, model).select("doc_id", work.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)
    return out.select("doc_id", "text", F.size("private").cast("long").alias("n_replaced"), F.to_json("private").alias("private"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return rules.judge(table(spark, sf_dir, "documents"), trusted)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return binary.read_documents(spark, binary.write_files(docs, work.new_path(spark, "token-files"), tokens.default_path(), end_id=2))


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(table(spark, sf_dir, "documents")).drop("row")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.report(table(spark, sf_dir, "embeddings"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return negatives.mine(rows, id_col="vec_id", vector_col="embedding").drop("anchor_row", "positive_row", "negative_row")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_quality, op3_chat, op4_toxicity, op5_language, op6_pii, op7_rules, op8_decontamination, op9_simhash, op10_binary, op11_exact, op12_clusters, op13_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op3_chat": chat.ORACLE, "op11_exact": exact.ORACLE, "op12_clusters": clusters.oracle(), "op13_negatives": negatives.ORACLE}
