"""Operator 4: severity grades by cumulative-link ordinal regression on sparse word features.

P(grade >= k) = logistic(w . x - theta_k) with one weight vector for all ordered thresholds theta_1 < theta_2 < ...
The features are hashed lower-case words that are present in the text; a test on the labelled sample picks the buckets
that differ between toxic and other documents.  The labels only say toxic or not, so the training grades above 0 are
terciles of the number of distinct marker words among the toxic rows of the sample.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import work

#: Labelled rows that the fit may use at most (half of each label), and words kept as features.
SAMPLE_ROWS, FEATURES = 6000, 400
BITS = 20
_words = re.compile(r"[^\W\d_]+").findall


def buckets(text: str | None) -> set[int]:
    """Hashed distinct words of a whole text, and the first six letters of longer ones."""
    if not text:
        return set()
    words = set(_words(text.lower()))
    words |= {f"{w[:6]}-" for w in words if len(w) > 6}
    return {zlib.crc32(w.encode("utf-8", "surrogatepass")) >> (32 - BITS) for w in words}


@dataclass(frozen=True)
class Severity:
    features: dict[int, int]
    weights: np.ndarray
    thetas: np.ndarray

    def above(self, texts: list[str | None]) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... by text."""
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            hit = [self.features[b] for b in buckets(text) & self.features.keys()]
            out[i] = self.weights[sorted(hit)].sum() if hit else 0.0
        return 1 / (1 + np.exp(-np.clip(out[:, None] - self.thetas[None, :], -60, 60)))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int, ridge: float = 1e-3, steps: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds that maximise the likelihood of the grades (weighted so that 0 and the rest count alike)."""
    n, d = x.shape
    weight = np.where(grade == 0, 0.5 / max(1, (grade == 0).sum()), 0.5 / max(1, (grade > 0).sum()))
    w, first, gaps = np.zeros(d), 0.0, np.zeros(grades - 1)
    m, v = np.zeros(d + grades), np.zeros(d + grades)
    for step in range(1, steps + 1):
        theta = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        p = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - theta[None, :], -60, 60)))
        hi = np.concatenate([np.ones((n, 1)), p], axis=1)
        lo = np.concatenate([p, np.zeros((n, 1))], axis=1)
        rows = np.arange(n)
        own = np.maximum(hi[rows, grade] - lo[rows, grade], 1e-9)
        slope = p * (1 - p)  # of p_k by its logit
        d_logit = np.zeros((n, grades))
        inner = grade > 0
        d_logit[rows[inner], grade[inner] - 1] += slope[rows[inner], grade[inner] - 1] / own[inner]
        outer = grade < grades
        d_logit[rows[outer], grade[outer]] -= slope[rows[outer], grade[outer]] / own[outer]
        d_logit *= weight[:, None]
        g_w = -(x.T @ d_logit.sum(axis=1)) + ridge * w
        g_theta = d_logit.sum(axis=0)
        g_gaps = np.array([g_theta[k + 1 :].sum() * np.exp(gaps[k]) for k in range(grades - 1)])
        g = np.concatenate([g_w, [g_theta.sum()], g_gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w -= move[:d]
        first -= move[d]
        gaps -= move[d + 1 :]
    return w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", grades: int = 3, most: int = SAMPLE_ROWS, least_docs: int = 8, id_col: str = "doc_id", text_col: str = "text") -> Severity:
    """Fit on at most `most` labelled rows, half of each label, taken in the order of a hash of the id.

    Marker words differ between toxic and other rows by more than 6 deviations; where none does, as in a very small
    sample, all picked words count as markers.  An id with both labels counts as 0, and an id with several rows of text
    gives one of them.  Null and other labels and null ids are left out.  Without both labels nothing is toxic.
    """
    work.prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"))
    few = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2)
        few = part if few is None else few.unionByName(part)
    few = work.pinned(few, "toxicity-sample")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = work.join_counted(rows, few, "doc_id", "inner").select("doc_id", "text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(buckets(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "y", "b"])

    found = work.pinned(rows.mapInArrow(run, "doc_id long, y int, b array<int>").groupBy("doc_id", "y").agg(F.min("b").alias("b")), "toxicity-words")
    totals = {int(r["y"]): int(r["count"]) for r in found.groupBy("y").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    nothing = Severity({}, np.zeros(0), np.full(grades, 60.0) + np.arange(grades))
    if not n1 or not n0:
        return nothing
    words = found.select("y", F.explode("b").alias("b")).groupBy("b").agg(F.sum("y").alias("k1"), F.count("*").alias("k")).where(F.col("k") >= least_docs)
    share = (F.col("k") + 1) / (n1 + n0 + 2)
    z = (F.col("k1") / n1 - (F.col("k") - F.col("k1")) / n0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    best = words.withColumn("z", z).orderBy(F.abs("z").desc(), "b").limit(FEATURES).toPandas()
    if best.empty:
        return nothing
    place = {int(b): i for i, b in enumerate(best["b"])}
    markers = {int(b) for b, s in zip(best["b"], best["z"], strict=True) if s > 6}
    keep = F.array(*[F.lit(b) for b in place])
    few_rows = found.select("doc_id", "y", F.array_intersect("b", keep).alias("b")).toPandas().sort_values(["y", "doc_id"])
    x = np.zeros((len(few_rows), len(place)))
    for i, own in enumerate(few_rows["b"]):
        x[i, [place[int(b)] for b in own]] = 1
    y = few_rows["y"].to_numpy()
    marked = x[:, [place[b] for b in sorted(markers)]].sum(axis=1) if markers else x.sum(axis=1)
    cuts = np.quantile(marked[y == 1], np.arange(1, grades) / grades)
    grade = np.where(y == 1, 1 + (marked[:, None] > cuts[None, :]).sum(axis=1), 0)
    w, thetas = fit_ordinal(x, grade, grades)
    return Severity(place, w, thetas)


def grade(docs: DataFrame, model: Severity, toxic_at: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (P(grade >= 1)), severity (expected grade), grade (most likely), predicted (1 if score >= toxic_at) of every row.

    Null and empty texts have no features and get the model's base severity.  A very long text is read whole.  Equal texts
    fare alike, repeated rows get a row each, null ids stay; a tie between grades goes to the lower one; other columns are
    ignored; an empty table gives no rows.
    """
    work.prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in work.slices(texts):
                p = shared.value.above(texts[a:b])
                each = np.concatenate([np.ones((len(p), 1)), p], axis=1) - np.concatenate([p, np.zeros((len(p), 1))], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(p[:, 0]), pa.array(p.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array((p[:, 0] >= toxic_at).astype(np.int32))], names=["doc_id", "score", "severity", "grade", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double, severity double, grade int, predicted int")
