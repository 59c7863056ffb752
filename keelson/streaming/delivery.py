"""Batching and streaming delivery: count and byte batches, retries with dead letters, upserts and appends."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keelson.operators import reports, writes
from keelson.session import ship
from keelson.sources import readers
from keelson.sources.tables import BucketedTable


def count_batches(df: DataFrame, order: list[str], size: int = 1000) -> DataFrame:
    """`batch`: groups of `size` rows in order."""
    return readers.pages(df, order, size).withColumnRenamed("page", "batch").drop("total")


def byte_batches(df: DataFrame, page: str, order: str, size: Column, budget: int) -> DataFrame:
    """`batch` within each page: cut before the row that would exceed the budget.  A row above it goes alone.

    `order` may be of any type that sorts; rows of equal order go by size, nulls first.  Packing is sequential within a
    page and parallel over pages; pages are bounded (see count_batches).  Rows stay in the JVM, so no value changes.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    pages = df.groupBy(page).agg(F.collect_list(F.struct(row.alias("row"), F.col(order).alias("order"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"))).alias("_rows"))
    keys = F.array_sort(F.transform("_rows", lambda r, i: F.struct(r["order"].alias("order"), r["size"].alias("size"), i.alias("i"))))

    def step(so_far: Column, key: Column) -> Column:
        cut = (so_far["used"] > 0) & (so_far["used"] + key["size"] > budget)
        batch = so_far["batch"] + cut.cast("int")
        return F.struct(batch.alias("batch"), F.when(cut, key["size"]).otherwise(so_far["used"] + key["size"]).alias("used"), F.concat(so_far["out"], F.array(batch)).alias("out"))

    start = F.struct(F.lit(0).alias("batch"), F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("out"))
    numbered = pages.withColumn("_keys", keys).withColumn("_batches", F.aggregate("_keys", start, step)["out"])
    placed = numbered.select(F.inline(F.zip_with("_keys", "_batches", lambda k, b: F.struct(F.get("_rows", k["i"])["row"].alias("row"), b.alias("batch")))))
    return placed.select("row.*", "batch")


def oversized(df: DataFrame, size: Column, budget: int) -> DataFrame:
    return df.where(size > budget)


def overflow(df: DataFrame, order: list[str], cap: int) -> tuple[DataFrame, DataFrame]:
    """Full-buffer policy drop: (rows within the cap, dropped rows)."""
    numbered = readers.pages(df, order, cap).drop("total")
    return numbered.where("page = 0").drop("page"), numbered.where("page > 0").drop("page")


def send_with_retries(rows: DataFrame, send: Callable[[pd.DataFrame, int], list[int]], retries: int = 3, wait: Callable[[int], None] | None = None) -> DataFrame:
    """Every row with status, attempts and outcome (accepted, rejected or exhausted).

    `send(rows, attempt)` returns one status a row.  Rows with a retryable status are sent again, up to `retries`
    times, after `wait(attempt)`; an exception fails the rows for good.  `send` sees pandas columns of Arrow types, in
    which a nullable long is exact; the rows themselves stay in Arrow.
    """
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = pa.Table.from_batches([batch]).to_pandas(types_mapper=pd.ArrowDtype)
            status, attempts = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            open_ = np.arange(batch.num_rows)
            for attempt in range(retries + 1):
                if not len(open_):
                    break
                if attempt and wait:
                    wait(attempt)
                attempts[open_] = attempt + 1
                try:
                    status[open_] = list(send(seen.iloc[open_], attempt))
                except Exception:  # noqa: BLE001  a failed transport is reported, not retried
                    status[open_] = 0
                    break
                open_ = open_[np.isin(status[open_], reports.RETRY_STATUS)]
            outcome = np.where((status >= 200) & (status <= 299), "accepted", np.where(np.isin(status, reports.RETRY_STATUS), "exhausted", "rejected"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(status), pa.array(attempts), pa.array(outcome.tolist(), pa.string())], names=[*batch.schema.names, "status", "attempts", "outcome"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *T.StructType.fromDDL("status int, attempts int, outcome string").fields]))


def upsert_stream(stream: DataFrame, table: BucketedTable, key: str, seq: str, checkpoint: str, processing_time: str | None = None) -> StreamingQuery:
    """Each micro-batch as an index write into the buckets that it touches.

    `_batch` is the micro-batch that last wrote a row: one that is sent again after a failure changes no row twice.
    """

    def put(old: DataFrame, new: DataFrame, batch_id: int) -> DataFrame:
        again = old.where(F.col("_batch") == batch_id).select("_id")
        return writes.index_write(old, new.join(again, "_id", "left_anti")).drop("result")

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumnRenamed(key, "_id").withColumnRenamed(seq, "seq").withColumn("_batch", F.lit(batch_id).cast("long"))
        docs = [c for c in rows.columns if c not in ("_id", "seq")]
        empty = rows.limit(0).select("_id", F.lit(0).cast("long").alias("_version"), *docs)
        table.write(rows, lambda old, new: put(old, new, batch_id), empty)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)).start()


def append_stream(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, processing_time: str | None = None) -> StreamingQuery:
    """Append continuously, every `processing_time`, or all that is there now."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*(partition_by or []))
    return (writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)).start()


def fan_out(stream: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], checkpoint: str) -> StreamingQuery:
    """One stream into several tables, each with its own projection, by batch-numbered directories that are rewritten alike."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for path, project in sinks.items():
                project(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """One row for each key within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def drain(query: StreamingQuery) -> None:
    """Finish what is queued, then stop."""
    query.processAllAvailable() if query.isActive else query.awaitTermination()
    query.stop()
