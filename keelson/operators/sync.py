"""Two-table sync: incremental (reaps what was not sent) and delta (does not), with rollover backfill."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators import maintain, writes
from keelson.sources import tables

FIRST_DATE = "0001-01-01 00:00:00"


def stamp(batch: DataFrame, now: str, batch_col: str = "batch_date", updated_col: str = "last_updated") -> DataFrame:
    """Every incoming row gets the run's time."""
    ts = F.lit(now).cast("timestamp")
    return batch.withColumn(batch_col, ts).withColumn(updated_col, ts)


def max_batch_date(table: DataFrame, batch_col: str = "batch_date") -> DataFrame:
    """One row: the last propagated batch; an empty table gives the first date."""
    return table.agg(F.coalesce(F.max(batch_col), F.lit(FIRST_DATE).cast("timestamp")).alias("cutoff"))


def choose_strategy(decisions: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (label, primary, secondary) with the strategy: reindex when the secondary is kept, else multiplex."""
    p = decisions.select(F.col("name").alias("primary"), F.col("decision").alias("p"))
    s = decisions.select(F.col("name").alias("secondary"), F.col("decision").alias("s"), "local_hash", "remote_hash")
    j = pairs.join(p, "primary", "left").join(s, "secondary", "left")
    return j.select("label", F.when(F.col("s") == "keep", "reindex").otherwise("multiplex").alias("strategy"), "local_hash", "remote_hash", F.coalesce(F.col("s") != "keep", F.lit(True)).alias("rolled_over"))


def conditional_write(primary: DataFrame, stamped: DataFrame, hash_col: str = "hash", batch_col: str = "batch_date") -> DataFrame:
    """An equal hash stamps the batch date only; anything else replaces the row."""
    return writes.hash_upsert(primary, stamped, hash_col, on_match={batch_col: F.col(f"s.{batch_col}")})


def updates_since(primary: DataFrame, secondary: DataFrame, updated_col: str = "last_updated", batch_col: str = "batch_date") -> DataFrame:
    """Primary rows changed strictly after the secondary's last batch, whose date is read first: the scan filters by it."""
    cutoff = max_batch_date(secondary, batch_col).select(F.unix_micros("cutoff")).first()[0]
    return primary.where(F.col(updated_col) > F.timestamp_micros(F.lit(cutoff)))


def stale(primary: DataFrame, now: str, batch_col: str = "batch_date") -> Column:
    return F.col(batch_col) < F.lit(now).cast("timestamp")


@dataclass
class SyncResult:
    """The new tables, and the outcome of each row written to the primary.

    All three read the written primary, which lies in a work folder until `remove` is called.
    """

    primary: DataFrame
    secondary: DataFrame
    outcomes: DataFrame
    work: str

    def remove(self) -> None:
        tables.remove(self.primary.sparkSession, self.work)


def incremental_sync(primary: DataFrame, secondary: DataFrame, batch: DataFrame, now: str, strategy: str = "reindex") -> SyncResult:
    """One run: stamp, write, propagate updates, propagate deletes, then reap the primary.

    Reindex: the primary is written conditionally, and the secondary gets rows updated after its cutoff and loses the
    ids that the primary did not see in this run.  Multiplex: both get plain index writes and only the primary is reaped.
    """
    stamped = stamp(batch, now)
    if strategy == "multiplex":
        written, work = tables.pinned(writes.index_write(primary, stamped), "sync")
        second = writes.index_write(secondary, _fit(stamped, secondary)).drop("result")
        left, _ = maintain.delete_by_query(written.drop("result"), stale(written, now))
        return SyncResult(left, second, _outcomes(written), work)
    written, work = tables.pinned(conditional_write(primary, stamped), "sync")
    table = written.drop("result")
    left, _ = maintain.delete_by_query(table, stale(table, now))
    kept = writes.delete_ids(secondary, table.where(stale(table, now)))  # first, as it keeps the join's partitions
    second = maintain.reindex(updates_since(left, secondary), kept).drop("result")
    return SyncResult(left, second, _outcomes(written), work)


def delta_sync(primary: DataFrame, secondary: DataFrame, batch: DataFrame, now: str) -> SyncResult:
    """A run without reaping: rows that were not sent stay."""
    written, work = tables.pinned(conditional_write(primary, stamp(batch, now)), "sync")
    table = written.drop("result")
    second = maintain.reindex(updates_since(table, secondary), secondary).drop("result")
    return SyncResult(table, second, _outcomes(written), work)


def _outcomes(written: DataFrame) -> DataFrame:
    return written.where("result <> 'untouched'").select("_id", "result")


def backfill(old: DataFrame, new_schema: DataFrame) -> DataFrame:
    """A rolled-over table: all rows of the old snapshot under the new schema, then the new one's own rows win."""
    widened = old.unionByName(new_schema.limit(0), allowMissingColumns=True).select(*new_schema.columns)
    return new_schema.unionByName(widened.join(new_schema.select("_id"), "_id", "left_anti"))


def _fit(batch: DataFrame, table: DataFrame) -> DataFrame:
    for c in table.columns:
        if c not in batch.columns and c not in ("_id", "_version"):
            batch = batch.withColumn(c, F.lit(None).cast(table.schema[c].dataType))
    return batch
