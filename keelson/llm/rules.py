"""Operator 7: base text statistics and a hashed n-gram log-likelihood ratio for every document.

Two multinomials over hashed character n-grams are counted over all rows: the trusted target (documents whose ids are
in a trusted table) and the raw corpus (all documents).  A document's score is the mean of log p_target - log p_raw
over its grams.  It is kept if the score is at least a threshold, a low quantile of the trusted documents' scores
measured on a histogram of fixed width, so the same rows always give the same verdicts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import grams, work

SYMBOLS = "#*$%&|<>"
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_BLANKS = " \t\n\x0b\x0c\r"
_TO_BLANK = str.maketrans(dict.fromkeys(_BLANKS, " "))
#: Scores are binned at this width for the quantile, between -SPAN and SPAN.
BIN, SPAN = 0.001, 16.0


def repeated_words(words: list[str], window: int = 8) -> int:
    """Words that lie in a window of 8 words found twice or more in the text, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    ids = (ids + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    ids ^= ids >> np.uint64(31)
    ids *= np.uint64(0x94D049BB133111EB)
    ids ^= ids >> np.uint64(29)
    key = np.zeros(n, np.uint64)
    for j in range(window):
        key += ids[j : j + n] * _MIX[j]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    step = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(step, at, 1)
    np.add.at(step, at + window, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated windows)."""
    if not text:
        return 0, 0, 0, 0, 0
    words = [w for w in text.translate(_TO_BLANK).split(" ") if w] if not text.isascii() else text.encode().split()
    chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    lines = Counter(x for x in text.split("\n") if x.strip(_BLANKS))
    return len(words), chars, symbols, sum(n - 1 for n in lines.values()), repeated_words(words)


def base_failed(n_words, n_repeat_words):
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def gram_counts(docs: DataFrame, weight_col: str, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(target, raw) counts of all rows; what reaches the driver has one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            trusted, texts = np.array(batch.column(0).to_pylist(), dtype=bool), batch.column(1).to_pylist()
            for a, b in work.slices(texts):
                points, begins = grams.codes(texts[a:b])
                good = trusted[a:b][grams.owners(begins)]
                for order in orders:
                    for at, bucket, inside in grams.blocks(points, order, bits):
                        raw += np.bincount(bucket[inside], minlength=1 << bits)
                        target += np.bincount(bucket[inside & good[at : at + len(bucket)]], minlength=1 << bits)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(target[at]), pa.array(raw[at])], names=["bucket", "target", "raw"])

    got = docs.select(weight_col, "text").mapInArrow(count, "bucket int, target long, raw long").groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toPandas()
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    raw[got["bucket"]], target[got["bucket"]] = got["raw"], got["target"]
    return target, raw


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    quantile: float = 0.01,
    margin: float = 0.02,
    orders: tuple[int, ...] = (1, 2, 3),
    bits: int = 14,
    smoothing: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed, kept of every row.

    `trusted` has the ids of the target documents (repeats and nulls don't count).  The threshold is the `quantile`
    of the trusted documents that pass the base rules, less `margin`.  Null or empty text has no words, llr 0 and
    fails the base rules.  Without trusted rows both multinomials are equal, every llr is 0 and the base rules decide.
    Repeated rows are judged alike; very long texts are counted whole, in slices; other columns are ignored; an empty table
    gives no rows.
    """
    work.prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = work.flagged(rows, trusted, "doc_id", "trusted")  # texts stay where they are
    target, raw = gram_counts(rows, "trusted", orders, bits)
    if not target.sum():
        target = raw
    weights = np.log((target + smoothing) / (target + smoothing).sum()) - np.log((raw + smoothing) / (raw + smoothing).sum())
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    names = ["doc_id", "trusted", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in work.slices(texts):
                points, begins = grams.codes(texts[a:b])
                owner = grams.owners(begins)
                total, number = np.zeros(b - a), np.zeros(b - a)
                for order in orders:
                    for at, bucket, inside in grams.blocks(points, order, bits):
                        who = owner[at : at + len(bucket)][inside]
                        total += np.bincount(who, weights=shared.value[bucket[inside]], minlength=b - a)
                        number += np.bincount(who, minlength=b - a)
                base = np.array([base_counts(t) for t in texts[a:b]], dtype=np.int64).reshape(-1, 5)
                llr = np.round(total / np.maximum(number, 1), 6)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), *(pa.array(base[:, k]) for k in range(5)), pa.array(llr)], names=names)

    scored = work.pinned(rows.select("doc_id", "text", "trusted").mapInArrow(run, "doc_id long, trusted boolean, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double"), "rules")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    least = threshold(scored.where(F.col("trusted") & ~failed).select("llr"), quantile) - margin
    return scored.select("doc_id", *names[2:], failed.alias("base_failed"), (~failed & (F.col("llr") >= F.lit(float(least)))).alias("kept"))


def threshold(scores: DataFrame, quantile: float) -> float:
    """The quantile of a column of scores, exact to BIN: bins are counted by Spark, at most 2 * SPAN / BIN of them."""
    binned = scores.select(F.floor(F.greatest(F.lit(-SPAN), F.least(F.lit(SPAN), F.col("llr"))) / BIN).alias("bin"))
    got = binned.groupBy("bin").count().orderBy("bin").toPandas()
    if got.empty:
        return -SPAN
    at = np.searchsorted(np.cumsum(got["count"].to_numpy()), quantile * got["count"].sum())
    return float(got["bin"].iloc[min(at, len(got) - 1)]) * BIN
