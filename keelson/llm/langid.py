"""Operator 5: language by multinomial naive Bayes over hashed character n-grams.

The counts cover every training row: each task adds up its own (language, bucket) counts, Spark sums them, and the
model that reaches the driver is one row a language and bucket, whatever the input.  The log-probability matrix is
broadcast and texts are scored in numpy, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import grams, work

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray  # buckets x languages: log probabilities
    orders: tuple[int, ...]
    bits: int

    def log_odds(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(log joint by text and language, whether the text has a letter)."""
        points, begins = grams.codes(texts)
        points, letter = grams.letters_only(points)
        owner = grams.owners(begins)
        out = np.tile(self.prior, (len(texts), 1))
        for order in self.orders:
            for at, bucket, inside in grams.blocks(points, order, self.bits):
                inside &= letter[at : at + len(bucket)] | letter[at + order - 1 :][: len(bucket)]
                who, bucket = owner[at : at + len(inside)][inside], bucket[inside]
                for k in range(len(self.languages)):
                    out[:, k] += np.bincount(who, weights=self.matrix[bucket, k], minlength=len(texts))
        has = np.bincount(owner, weights=letter, minlength=len(texts)) > 0
        return out, has

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        joint, has = self.log_odds(texts)
        best = joint.argmax(axis=1)
        share = 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if h else UNDETERMINED for b, h in zip(best, has, strict=True)], np.where(has, share, 0.0)


def fit(docs: DataFrame, orders: tuple[int, ...] = (1, 2, 3), bits: int = 14, smoothing: float = 0.5, lang_col: str = "lang", text_col: str = "text") -> LanguageModel:
    """Fit on the rows of `docs` whose language and text are not null; gram counts are exact sums over all of them.

    A table without such rows gives a model that answers `und` to everything.
    """
    work.prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), dtype=object), batch.column(1).to_pylist()
            for a, b in work.slices(texts):
                names, which = np.unique(langs[a:b].astype(str), return_inverse=True)
                points, begins = grams.codes(texts[a:b])
                points, letter = grams.letters_only(points)
                owner = which[grams.owners(begins)]
                for i, name in enumerate(names):
                    seen[name] = seen.get(name, 0) + int((which == i).sum())
                for order in orders:
                    for at, bucket, inside in grams.blocks(points, order, bits):
                        inside &= letter[at : at + len(bucket)] | letter[at + order - 1 :][: len(bucket)]
                        flat = np.bincount((owner[at : at + len(bucket)][inside] << bits) + bucket[inside], minlength=len(names) << bits)
                        for i, name in enumerate(names):
                            sums[name] = sums.get(name, 0) + flat[i << bits : (i + 1) << bits]
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * (len(at) + 1)), pa.array([-1, *at.tolist()], pa.int32()), pa.array([seen[name], *total[at].tolist()], pa.int64())], names=["lang", "bucket", "n"])

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique().tolist())
    table = np.full((1 << bits, max(1, len(languages))), smoothing)
    docs_of = np.ones(max(1, len(languages)))
    for k, name in enumerate(languages):
        own = counts[counts["lang"] == name]
        grams_of = own[own["bucket"] >= 0]
        table[grams_of["bucket"].to_numpy(), k] += grams_of["n"].to_numpy()
        docs_of[k] = own[own["bucket"] < 0]["n"].sum()
    return LanguageModel(languages or [UNDETERMINED], np.log(docs_of / docs_of.sum()), np.log(table / table.sum(axis=0)), orders, bits)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (posterior share of the best language) of every row, repeated rows included.

    Null text, or text without a letter, gives `und` with score 0; ties go to the first language by name.  Very long texts
    are scored whole, in blocks; other columns are ignored; an empty table gives no rows.
    """
    return _predicted(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), model, ["doc_id"])


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Every row of `docs` as it is, with lang_pred and score beside it (columns of these names are replaced)."""
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return _predicted(docs.select(*rest), model, rest, text_col)


def _predicted(rows: DataFrame, model: LanguageModel, keep: list[str], text_col: str = "text") -> DataFrame:
    work.prepare(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    order = [*keep, *([] if text_col in keep else [text_col])]
    at, names = order.index(text_col), [*keep, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in work.slices(texts):
                lang, score = shared.value.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(len(keep))), pa.array(lang), pa.array(score)], names=names)

    return rows.select(*order).mapInArrow(run, work.carried(rows, keep, "lang_pred string, score double"))
