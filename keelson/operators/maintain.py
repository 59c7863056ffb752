"""Table maintenance: copy, delete and update by query, rebuild decisions, rollover, retention, downsampling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.operators import writes
from keelson.session import ship


class ConflictError(RuntimeError):
    """A copy met a conflict and was told to abort."""


def reindex(source: DataFrame, destination: DataFrame, where: Column | None = None, transform: Callable[[DataFrame], DataFrame] | None = None, max_docs: int | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Copy source rows (_id and documents) into a destination; the result has `result` as an index write."""
    rows = source.where(where) if where is not None else source
    rows = transform(rows) if transform else rows
    rows = rows.orderBy("_id").limit(max_docs) if max_docs is not None else rows
    rows = rows.drop(*(exclude or []), "_version")
    for c in destination.columns:
        if c not in rows.columns and c != "_version":
            rows = rows.withColumn(c, F.lit(None).cast(destination.schema[c].dataType))
    return writes.index_write(destination, rows.withColumn("seq", F.lit(0)))


def reindex_script(source: DataFrame, destination: DataFrame, script: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The script adds `_op`: index writes the row, noop leaves it out, delete removes the id from the destination."""
    rows = script(source)
    kept = writes.delete_ids(destination, rows.where("_op = 'delete'"))
    return reindex(rows.where("_op = 'index'").drop("_op"), kept)


def copy_create(source: DataFrame, destination: DataFrame, proceed: bool = True) -> tuple[DataFrame, DataFrame]:
    """Create-only copy: (table, conflicts).  Unless told to proceed, a conflict raises."""
    table, conflicts = writes.create_write(destination, source.drop("_version").withColumn("seq", F.lit(0)))
    if not proceed and not conflicts.isEmpty():
        raise ConflictError(f"document {conflicts.first()['_id']} exists")
    return table, conflicts


def client_reindex(source: DataFrame, destination: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Copy through user code on pandas batches, whose columns have Arrow types: what `fn` leaves alone comes back as it was."""
    ship(source.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(pa.Table.from_batches([batch]).to_pandas(types_mapper=pd.ArrowDtype))
            yield from pa.Table.from_pandas(out, schema=batch.schema, preserve_index=False).to_batches()

    rows = source.drop("_version")
    return reindex(rows.mapInArrow(run, rows.schema), destination)


def delete_by_query(table: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(rows left, one row with the counters total and deleted)."""
    hit = F.coalesce(predicate, F.lit(False))
    counters = table.agg(F.count("*").alias("total"), F.coalesce(F.sum(hit.cast("long")), F.lit(0)).alias("deleted"))
    return table.where(~hit), counters


def update_by_query(table: DataFrame, predicate: Column, changes: dict[str, Column]) -> DataFrame:
    """Columns recomputed on matching rows, whose version rises."""
    hit = F.coalesce(predicate, F.lit(False))
    return table.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in changes.items()} | {"_version": F.col("_version") + hit.cast("long")})


def counters(result: DataFrame, conflicts: int = 0) -> DataFrame:
    """total, created, updated, deleted, noops, conflicts and fraction of a write's `result` column."""
    count = lambda r: F.coalesce(F.sum((F.col("result") == r).cast("long")), F.lit(0))
    out = result.agg(count("created").alias("created"), count("updated").alias("updated"), count("deleted").alias("deleted"), count("noop").alias("noops"))
    out = out.withColumn("conflicts", F.lit(conflicts).cast("long")).withColumn("total", F.expr("created + updated + deleted + noops + conflicts"))
    return out.withColumn("fraction", F.when(F.col("total") > 0, (F.col("created") + F.col("updated") + F.col("deleted")) / F.col("total")).otherwise(F.lit(1.0)))


def version_parts(c: Column) -> Column:
    """1.2.3 as numbers; null when a part is no number."""
    parts = F.transform(F.split(c, "[.]"), lambda p: p.try_cast("int"))
    return F.when(F.forall(parts, lambda p: p.isNotNull()), parts)


def rebuild_decision(declared: DataFrame, stored: DataFrame, always: bool = False) -> DataFrame:
    """name, decision (keep or rebuild) and why.  Both frames have name, hash, version.

    A stored mapping version newer than the declared one is kept; so is an equal hash; anything else is rebuilt.
    Versions that don't parse fall back to the hash.
    """
    d, s = declared.alias("d"), stored.alias("s")
    j = d.join(s, F.col("d.name") == F.col("s.name"), "left")
    newer = F.coalesce(version_parts(F.col("s.version")) > version_parts(F.col("d.version")), F.lit(False))
    same = F.coalesce(F.col("s.hash") == F.col("d.hash"), F.lit(False))
    why = F.when(F.lit(always), "always").when(F.col("s.name").isNull(), "missing").when(newer, "newer").when(same, "same hash").otherwise("changed")
    return j.select(F.col("d.name").alias("name"), F.when(why.isin("newer", "same hash"), "keep").otherwise("rebuild").alias("decision"), why.alias("why"), F.col("d.hash").alias("local_hash"), F.col("s.hash").alias("remote_hash"))


def rollover(table: DataFrame, group: str, ts: str, size: Column, now: str, max_age_seconds: int | None = None, max_docs: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """group, docs, bytes, roll: whether any limit that is given is exceeded; without limits always."""
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.min(ts))
    stats = table.groupBy(group).agg(F.count("*").alias("docs"), F.sum(size).cast("long").alias("bytes"), age.alias("age"))
    tests = [F.col(c) >= v for c, v in (("age", max_age_seconds), ("docs", max_docs), ("bytes", max_bytes)) if v is not None]
    roll = F.lit(not tests)
    for t in tests:
        roll = roll | t
    return stats.withColumn("roll", roll)


def retain(table: DataFrame, ts: str, now: str, period: str) -> DataFrame:
    """Rows not older than an interval such as '7 days'."""
    return table.where(F.col(ts) >= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {period}"))


def deduplicate_points(points: DataFrame, dimensions: list[str], ts: str, order: list[Column]) -> DataFrame:
    """One row for each set of dimensions and timestamp: the first in `order`."""
    w = Window.partitionBy(*dimensions, ts).orderBy(*order)
    return points.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def downsample(points: DataFrame, dimensions: list[str], ts: str, value: str, every: str) -> DataFrame:
    """min, max, sum and count of a value by dimensions and fixed window."""
    w = F.window(ts, every)
    out = points.groupBy(*dimensions, w).agg(F.min(value).alias("min"), F.max(value).alias("max"), F.sum(value).alias("sum"), F.count(value).alias("count"))
    return out.select(*dimensions, F.col("window.start").alias("start"), "min", "max", "sum", "count")
