"""Operator 2: document quality by Bradley-Terry ranking of preference pairs.

A bounded sample of labelled rows gives pairs (a row labelled 1 is preferred to a row labelled 0).  The weights
minimise the logistic loss on the difference of the pair's features, so a document's strength is a weighted sum of its
own features.  The cut is the quantile of the strengths at the share of label 0 among all labelled rows: the sample holds
as many rows of each label as it can, so each of its rows counts for as many as were labelled alike.  A strength is turned
into a score in [0, 1] whose value at the cut is `cut_score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import rules, work

#: Labelled rows that the fit may use at most, and pairs drawn from them.
SAMPLE_ROWS, PAIRS = 6000, 60_000
SHAPES = 256
NAMES = ("words", "word_chars", "upper", "digits", "symbols", "bars", "marks", "stops", "foreign", "dup_lines", "repeats", "adjacent", "distinct", "lines")


def _shape_table() -> np.ndarray:
    """A small class for each code point of the first plane: lower, upper, digit, blank, break, mark by value, other."""
    out = np.full(65536, 5, np.uint32)
    for i in range(65536):
        c = chr(i)
        out[i] = 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if c == " " else 6 if c == "\n" else 5 if c.isalpha() else 8 + i % 64 if i < 128 else 7
    return out


_shapes: list[np.ndarray] = []


def features(text: str | None) -> np.ndarray:
    """Rates that don't grow with the text's length, and the shares of hashed pairs of character shapes."""
    out = np.zeros(len(NAMES) + SHAPES, np.float32)
    if not text:
        return out
    if not _shapes:
        _shapes.append(_shape_table())
    n_words, chars, symbols, dup_lines, repeats = rules.base_counts(text)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    shape = _shapes[0][np.minimum(points, 65535)]
    n = len(points)
    words = text.split()
    lines = text.count("\n") + 1
    kinds = np.bincount(shape, minlength=72)
    out[: len(NAMES)] = (
        min(np.log1p(n_words), 6.0) / 6, chars / max(1, n_words) / 10, kinds[2] / n, kinds[3] / n, 10 * symbols / n, 10 * text.count("|") / n, 10 * text.count("!") / n,
        10 * (text.count(".") + text.count(",")) / n, (points > 127).mean(), dup_lines / lines, repeats / max(1, n_words),
        sum(map(str.__eq__, words, words[1:])) / max(1, len(words)), len(set(words)) / max(1, len(words)) ** 0.9, min(1.0, 40 * lines / n),
    )
    if n > 1:
        pair = (shape[:-1] * np.uint32(73) + shape[1:]) * np.uint32(2654435761) >> np.uint32(24)
        out[len(NAMES) :] = np.bincount(pair, minlength=SHAPES) / (n - 1)
    return out


@dataclass(frozen=True)
class Ranking:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    cut: float
    slope: float
    cut_score: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * (self.strength(x) - self.cut), -60, 60) + np.log(self.cut_score / (1 - self.cut_score))
        return 1 / (1 + np.exp(-z))


def rank(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, ridge: float = 2e-3, steps: int = 400, cut_score: float = 0.3, seed: int = 11, labelled: tuple[int, int] | None = None) -> Ranking:
    """Fit strengths on (features, 0/1 labels); without both labels all strengths are 0.

    `labelled`: rows of label 0 and 1 that the sample stands for (default: the sample itself).
    """
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - mean) / scale, -8, 8).astype(np.float64)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return Ranking(w, mean, scale, 0.0 if len(bad) else -1.0, 1.0, cut_score)
    random = np.random.default_rng(seed)
    first, second = good[random.integers(0, len(good), pairs)], bad[random.integers(0, len(bad), pairs)]
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        s = z @ w
        lost = 1 / (1 + np.exp(np.clip(s[first] - s[second], -60, 60)))  # 1 - P(first beats second)
        pull = np.bincount(second, lost, len(z)) - np.bincount(first, lost, len(z))
        g = z.T @ pull / pairs + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    stands = np.where(label == 1, *((n / m for n, m in zip(labelled[::-1], (len(good), len(bad)), strict=True)) if labelled else (1.0, 1.0)))
    order = np.argsort(z @ w, kind="stable")
    s, below = (z @ w)[order], np.cumsum(stands[order])
    share = stands[bad].sum() / below[-1]
    at = min(int(np.searchsorted(below, share * below[-1] * (1 - 1e-12))) + 1, len(s) - 1)  # the quantile at the share of label 0
    spread = max(1e-6, float(np.median((z @ w)[good]) - np.median((z @ w)[bad])))
    return Ranking(w, mean, scale, float((s[at - 1] + s[at]) / 2), 8 / spread, cut_score)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", most: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", **options) -> Ranking:
    """Fit on at most `most` labelled rows, half of each label, taken in the order of a hash of the id.

    An id with both labels counts as 0, and an id with several rows of text gives one of them.  Labels other than 0 and 1,
    null labels and null ids are left out.  Null and empty texts have zero features.  Without both labels all scores are
    alike.  Other columns are ignored.
    """
    work.prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"))
    few = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2)
        few = part if few is None else few.unionByName(part)
    few = work.pinned(few, "quality-sample")
    counted = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = work.join_counted(rows, few, "doc_id", "inner").select("text", "y", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float32())), batch.column(1), batch.column(2)], names=["x", "y", "doc_id"])

    got = rows.mapInArrow(run, "x array<float>, y int, doc_id long").groupBy("doc_id").agg(F.min("x").alias("x"), F.min("y").alias("y")).toPandas()
    if got.empty:
        got_x, got_y = np.zeros((1, len(NAMES) + SHAPES)), np.ones(1)
    else:
        got_x, got_y = np.stack(got["x"].to_numpy()).astype(np.float64), got["y"].to_numpy()
    order = np.lexsort((*got_x.T[:4], got_y))  # the fit doesn't depend on the order of rows
    return rank(got_x[order], got_y[order], labelled=(counted.get(0, 0), counted.get(1, 0)), **options)


def score(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted of every row.

    Null and empty texts have zero features and get a score as well.  A very long text is read whole.  Equal texts get
    equal scores, repeated rows a row each, null ids stay; other columns are ignored; an empty table gives no rows.
    """
    work.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in batch.column(1).to_pylist()], np.float64).reshape(-1, len(NAMES) + SHAPES)
            s = shared.value.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= shared.value.cut_score).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")
