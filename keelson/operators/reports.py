"""Counts, failure and delivery reports, usage of conversations, and assembly of traces."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from keelson.session import ship
from keelson.sources import readers, tables

#: Item statuses that are sent again: fixed values.
RETRY_STATUS = (429, 502, 503, 504)
#: Spans that a task looks at together.
BLOCK_SPANS = 500_000


def terms(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def classify(status: Column) -> Column:
    """accepted, retry or rejected."""
    return F.when(status.between(200, 299), "accepted").when(status.isin(*RETRY_STATUS), "retry").otherwise("rejected")


def failures(outcomes: DataFrame) -> DataFrame:
    """status, error_type, n and the first reason (by batch and position) of what was not accepted."""
    bad = outcomes.where(classify(F.col("status")) != "accepted")
    return bad.groupBy("status", "error_type").agg(F.count("*").alias("n"), F.min_by("error_reason", F.struct("batch_id", "pos")).alias("first_reason"))


def delivery_columns(outcomes: DataFrame) -> list[Column]:
    """items, accepted, retries, rejected, exhausted as aggregates of outcomes (status and, if it is there, outcome).

    A row counts as exhausted if its outcome says so: its status was retryable when the attempts ran out.
    """
    kind = classify(F.col("status"))
    gone = F.col("outcome").eqNullSafe("exhausted") if "outcome" in outcomes.columns else F.lit(False)
    count = lambda hit: F.coalesce(F.sum(hit.cast("long")), F.lit(0))
    return [F.count(F.lit(1)).alias("items"), count(kind == "accepted").alias("accepted"), count((kind == "retry") & ~gone).alias("retries"), count(kind == "rejected").alias("rejected"), count(gone).alias("exhausted")]


def delivery(outcomes: DataFrame) -> DataFrame:
    """batches, items, accepted, retries, rejected, exhausted, success of outcomes with a batch_id."""
    out = outcomes.agg(F.countDistinct("batch_id").alias("batches"), *delivery_columns(outcomes))
    return out.withColumn("success", (F.col("rejected") == 0) & (F.col("exhausted") == 0) & (F.col("items") > 0))


class DeliveryListener(StreamingQueryListener):
    """Delivery counters of running queries, read from what `observed` sees of each micro-batch as it is sent.

    `totals` adds the micro-batches of each query name up; nothing is computed twice.
    """

    NAME = "delivery"

    def __init__(self) -> None:
        self.totals: dict[str, Counter] = {}
        self.ended: set[str] = set()
        self._names: dict[str, str] = {}

    @classmethod
    def observed(cls, outcomes: DataFrame) -> DataFrame:
        """The same rows, counted on their way."""
        return outcomes.observe(cls.NAME, *delivery_columns(outcomes))

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._names[str(event.id)] = event.name or str(event.id)
        self.totals.setdefault(self._names[str(event.id)], Counter())

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = event.progress.observedMetrics.get(self.NAME)
        if row is not None:
            total = self.totals.setdefault(event.progress.name or str(event.progress.id), Counter())
            total.update({"batches": int(row["items"] > 0), **{k: row[k] for k in ("items", "accepted", "retries", "rejected", "exhausted")}})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.add(self._names.get(str(event.id), str(event.id)))


def zip_outcomes(sent: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The i-th document of a batch with its i-th outcome."""
    return sent.join(outcomes, ["batch_id", "pos"], "inner")


def usage(turns: DataFrame, tokens: Column, where: Column | None = None, order: list[Column] | None = None, page: int = 0, size: int | None = None) -> DataFrame:
    """conv_id, rounds, input_tokens, output_tokens, has_warnings (a round without an answer).

    `where` filters conversations by these columns; with `order` and `size`, one page of them in a total order, by ranks
    (see readers.pages), so that a deep page costs no more than the first.
    """
    t = turns.withColumn("_t", tokens)
    by = lambda r: F.coalesce(F.sum(F.when(F.col("role") == r, F.col("_t"))), F.lit(0)).cast("long")
    out = t.groupBy("conv_id").agg(F.sum((F.col("role") == "user").cast("long")).alias("rounds"), by("user").alias("input_tokens"), by("assistant").alias("output_tokens"), F.sum((F.col("role") == "assistant").cast("long")).alias("_a"))
    out = out.withColumn("has_warnings", F.col("_a") < F.col("rounds")).drop("_a")
    out = out.where(where) if where is not None else out
    if size is None:
        return out
    order = order or [F.col("conv_id")]
    return readers.pages(out, order, size).where(F.col("page") == page).drop("page", "total").orderBy(*order)


def assemble(transactions: DataFrame, spans: DataFrame) -> DataFrame:
    """Each transaction with its spans' count, total duration and depth-one children (see span_trees for deeper ones)."""
    own = spans.groupBy("trace_id", "transaction_id").agg(F.count("*").alias("span_count"), F.sum("duration").alias("span_duration"), F.sum(F.col("parent_id").eqNullSafe(F.col("transaction_id")).cast("long")).alias("children"))
    t = transactions.withColumnRenamed("id", "transaction_id").join(own, ["trace_id", "transaction_id"], "left")
    return t.na.fill(0, ["span_count", "span_duration", "children"])


def _climbed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of spans (t, s, p), each span with the last ancestor in its block: head, depth, above (the head's parent, which
    isn't in the block) and ring (the chain runs in a ring inside the block).

    An id that Arrow doesn't find in the block only counts as outside, where Spark looks for it.
    """

    def climb(block: pa.Table) -> pa.RecordBatch:
        t, s, p = (pa.concat_arrays(c.chunks) for c in block.columns)
        m = len(s)
        up, inside = np.arange(m), np.zeros(m, bool)
        if s.type == p.type and not pa.types.is_nested(s.type) and not pa.types.is_nested(t.type):
            traces, ids = pc.dictionary_encode(t, null_encoding="encode").indices, pc.dictionary_encode(s)
            base = traces.to_numpy().astype(np.int64) * len(ids.dictionary)
            key, at = base + ids.indices.to_numpy(), pc.fill_null(pc.index_in(p, ids.dictionary, skip_nulls=True), -1).to_numpy()
            order = np.argsort(key, kind="stable")
            place = np.minimum(np.searchsorted(key[order], base + at), m - 1)
            inside = (at >= 0) & (key[order[place]] == base + at)
            up = np.where(inside, order[place], up)
        depth, open_ = inside.astype(np.int64), np.flatnonzero(inside)
        open_ = open_[inside[up[open_]]]
        while len(open_):
            over = up[open_]
            depth[open_], up[open_] = depth[open_] + depth[over], up[over]
            still = open_[inside[up[open_]]]
            if len(still) == len(open_):
                break
            open_ = still
        ring, head = np.zeros(m, bool), pa.array(up)
        ring[open_] = True
        above = pc.if_else(pa.array(ring), pa.scalar(None, p.type), p.take(head)) if len(open_) else p.take(head)
        return pa.RecordBatch.from_arrays([t, s, s.take(head), pa.array(depth), above, pa.array(ring)], names=["t", "s", "head", "depth", "above", "ring"])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK_SPANS:
            yield climb(pa.Table.from_batches(held))
            held, n = [], 0
    if n:
        yield climb(pa.Table.from_batches(held))


def _doubled(state: DataFrame, path: bool = False) -> DataFrame:
    """`state` (t, s, up, root, depth, lost and, if asked for, path) with `up` null, or left on a ring or above it.

    Pointer doubling: each round every open span takes over its ancestor's ancestor, so a chain of depth d takes log2(d)
    joins.  If a round settles none, what is open lies on a ring or above it.
    """
    state, _ = tables.pinned(state, "spans")
    open_ = state.where("up IS NOT NULL").count()
    while open_:
        above = state.select(F.col("t").alias("_t"), F.col("s").alias("_s"), F.col("up").alias("_up"), F.col("root").alias("_root"), F.col("depth").alias("_depth"), F.col("lost").alias("_lost"), *([F.col("path").alias("_path")] if path else []))
        joined = state.where("up IS NOT NULL").join(above, F.col("t").eqNullSafe(F.col("_t")) & (F.col("up") == F.col("_s")))
        moved = joined.select("t", "s", F.col("_up").alias("up"), F.col("_root").alias("root"), (F.col("depth") + F.col("_depth")).alias("depth"), (F.col("lost") | F.col("_lost")).alias("lost"), *([F.concat("_path", "path").alias("path")] if path else []))
        state, _ = tables.pinned(state.where("up IS NULL").unionByName(moved), "spans")
        before, open_ = open_, state.where("up IS NOT NULL").count()
        if open_ == before:
            break
    return state


def span_trees(spans: DataFrame, trace: str = "trace_id", span: str = "span_id", parent: str = "parent_id", path: bool = False, most: int = 100_000) -> DataFrame:
    """trace, span, root, depth, status and, if asked for, path (ids from the root on) of every different span of a trace.

    `status` is root (no parent), child, orphan (the chain of parents ends at a span that isn't there; the last one that is
    counts as root) or cycle (the chain runs in a ring: root, depth and path are null).  A span that is repeated counts with
    its least parent, nulls first; spans without an id are left out.

    Spans are dealt by ranges of trace and id, and each task climbs as far as its block goes.  Only spans that others point
    to from outside their block take part in pointer doubling, by joins; up to `most` of them are broadcast.  If all parents
    lie far off, these are all spans.  With `path`, every span takes part.  The rounds' tables go to the work folder.
    """
    keyed = spans.where(F.col(span).isNotNull()).select(F.col(trace).alias("t"), F.col(span).alias("s"), F.col(parent).alias("p"))
    nodes = (keyed if path else keyed.repartitionByRange("t", "s")).groupBy("t", "s").agg(F.min(F.struct("p")).alias("p")).select("t", "s", F.col("p.p").alias("p"))
    if path:
        there = nodes.select(F.col("t").alias("_t"), F.col("s").alias("_s"))
        known = nodes.join(there, F.col("t").eqNullSafe(F.col("_t")) & (F.col("p") == F.col("_s")), "left")
        lost = F.col("p").isNotNull() & F.col("_s").isNull()
        state = _doubled(known.select("t", "s", F.col("_s").alias("up"), F.col("s").alias("root"), F.col("_s").isNotNull().cast("long").alias("depth"), lost.alias("lost"), F.array("s").alias("path")), path)
    else:
        ship(spans.sparkSession)
        kinds = {f.name: f.dataType for f in nodes.schema.fields}
        out = T.StructType().add("t", kinds["t"]).add("s", kinds["s"]).add("head", kinds["s"]).add("depth", T.LongType()).add("above", kinds["p"]).add("ring", T.BooleanType())
        rows, _ = tables.pinned(nodes.sortWithinPartitions("t", "s").mapInArrow(_climbed, out), "spans")
        outside, _ = tables.pinned(rows.where("above IS NOT NULL").select(F.col("t").alias("_t"), F.col("above").alias("_s")).distinct(), "spans")
        few = F.broadcast if outside.limit(most + 1).count() <= most else (lambda x: x)
        same = lambda pointer: F.col("t").eqNullSafe(F.col("_t")) & (F.col(pointer) == F.col("_s"))
        entries, _ = tables.pinned(rows.join(few(outside), same("s")).drop("_t", "_s"), "spans")
        known = entries.join(few(entries.select(F.col("t").alias("_t"), F.col("s").alias("_s"))), same("above"), "left")
        step = F.col("depth") + F.col("_s").isNotNull().cast("long")
        lost = F.col("above").isNotNull() & F.col("_s").isNull()
        ends = _doubled(known.select("t", "s", F.when(F.col("ring"), F.col("s")).otherwise(F.col("_s")).alias("up"), F.col("head").alias("root"), step.alias("depth"), lost.alias("lost")))
        ends = ends.select(F.col("t").alias("_t"), F.col("s").alias("_s"), F.col("up").alias("_up"), F.col("root").alias("_root"), F.col("depth").alias("_depth"), F.col("lost").alias("_lost"))
        found, gone = F.col("_s").isNotNull(), F.col("above").isNotNull() & F.col("_s").isNull()
        up = F.when(F.col("ring"), F.col("s")).otherwise(F.col("_up"))
        state = rows.join(few(ends), same("above"), "left").select("t", "s", up.alias("up"), F.when(found, F.col("_root")).otherwise(F.col("head")).alias("root"), F.when(found, F.col("depth") + 1 + F.col("_depth")).otherwise(F.col("depth")).alias("depth"), F.coalesce(F.col("_lost"), gone).alias("lost"))
    ring = F.col("up").isNotNull()
    status = F.when(ring, "cycle").when(F.col("lost"), "orphan").when(F.col("depth") == 0, "root").otherwise("child")
    unless = lambda c: F.when(~ring, F.col(c)).alias(c)
    return state.select(F.col("t").alias(trace), F.col("s").alias(span), unless("root"), unless("depth"), status.alias("status"), *([unless("path")] if path else []))


def parent_child(parents: DataFrame, children: DataFrame, key: str, relation: str, name: str) -> DataFrame:
    """Children (columns parent and relation) with their parents, for one relation."""
    return children.where(F.col(relation) == name).join(parents, children["parent"] == parents[key], "inner")
