"""Versioned tables: snapshots, a pointer table of aliases, metadata, appends and publishing.

A table root holds `snapshots/<name>` (immutable Parquet directories) and `aliases-<n>` generations of the pointer
table.  Nothing is overwritten in place: a writer adds a directory and then publishes a new generation of pointers,
so a reader that resolved an alias keeps a consistent snapshot.  One writer per root.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_scope = threading.local()
ALIASES = "alias string, index string"
MANIFEST = "bucket int, generation string"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _own:
            _own[context.applicationId] = tempfile.mkdtemp(prefix="spark-")
        base = _own[context.applicationId]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """Names below a directory; none if it doesn't exist."""
    fs, at = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory, if it exists."""
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def pinned(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write `df` once to the work folder; the frame that reads it back, and its path.

    The caller removes it, or it goes at the end of the `discarding` in which it was made.
    """
    path = scratch(df.sparkSession, name)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the work tables that this thread pinned inside: write or collect what is still needed before."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        mine, _scope.paths = _scope.paths, outer
        for path in mine:
            remove(spark, path)


class TableRoot:
    """Snapshots and aliases below one directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write a new snapshot and read it back."""
        df.write.mode("errorifexists").partitionBy(*(partition_by or [])).parquet(f"{self.root}/snapshots/{name}")
        return self.snapshot(name)

    def snapshot(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/snapshots/{name}")

    def snapshots(self) -> list[str]:
        return names(self.spark, f"{self.root}/snapshots")

    def latest(self, prefix: str) -> str | None:
        """The alphabetically last snapshot of a prefix."""
        return max((n for n in self.snapshots() if n.startswith(prefix)), default=None)

    def aliases(self) -> DataFrame:
        found = [n for n in names(self.spark, self.root) if n.startswith("aliases-")]
        return self.spark.read.schema(ALIASES).parquet(f"{self.root}/{found[-1]}") if found else self.spark.createDataFrame([], ALIASES)

    def resolve(self, alias: str) -> str:
        """The snapshot of an alias, or the name itself."""
        hit = self.aliases().where(F.col("alias") == alias).agg(F.max("index")).first()[0]
        return hit or alias

    def read(self, read_alias: str, write_alias: str | None = None) -> DataFrame:
        """Read alias, else write alias, else the name."""
        known = {r["alias"]: r["index"] for r in self.aliases().where(F.col("alias").isin(read_alias, write_alias or read_alias)).collect()}
        return self.snapshot(known.get(read_alias) or known.get(write_alias or "") or read_alias)

    def publish(self, aliases: list[str], index: str, pattern: str) -> DataFrame:
        """Point each alias at one snapshot: its rows that match the pattern go, one row comes."""
        swapped = publish(self.aliases(), aliases, index, pattern)
        generation = sum(n.startswith("aliases-") for n in names(self.spark, self.root))
        swapped.coalesce(1).write.parquet(f"{self.root}/aliases-{generation:06d}")
        return self.aliases()


def publish(current: DataFrame, aliases: list[str], index: str, pattern: str) -> DataFrame:
    """The pointer table after a swap; `pattern` is a LIKE pattern of snapshot names."""
    kept = current.where(~(F.col("alias").isin(aliases) & F.col("index").like(pattern)))
    rows = current.sparkSession.createDataFrame([(a, index) for a in aliases], ALIASES)
    return kept.unionByName(rows)


def append(rows: DataFrame, path: str, ts_col: str) -> DataFrame:
    """Append rows to a stream table partitioned by day, and read it back."""
    rows.withColumn("day", F.date_format(ts_col, "yyyy-MM-dd")).write.mode("append").partitionBy("day").parquet(path)
    return rows.sparkSession.read.parquet(path).withColumn("day", F.col("day").cast("string"))


class BucketedTable:
    """A keyed table dealt by `_bucket`, a hash of _id; a write reads and replaces only the buckets its batch touches.

    The root holds `data/<generation>/_bucket=<n>` directories, which never change, and numbered manifests that say in
    which generation each bucket lies.  A write adds a generation and then a manifest, which counts once Spark has committed it:
    a driver that is lost at any moment leaves the state before the write or the one after it.  Generations
    that the last KEPT manifests don't name are removed after a write, so a frame that was read stays valid for that many
    writes.  `n` buckets is a constant of the table: a batch should touch few of them.  One writer per table.
    """

    KEPT = 3

    def __init__(self, spark: SparkSession, root: str, n: int = 64):
        self.spark, self.root, self.n = spark, root.rstrip("/"), n

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("_id"), F.lit(self.n)).cast("int")

    def _manifests(self) -> list[str]:
        """Committed manifests, oldest first."""
        found = [n for n in names(self.spark, self.root) if n.startswith("manifest-")]
        return [n for n in found if "_SUCCESS" in names(self.spark, f"{self.root}/{n}")]

    def _state(self, manifest: str) -> dict[int, str]:
        """bucket -> generation: n rows at most."""
        return {r["bucket"]: r["generation"] for r in self.spark.read.schema(MANIFEST).parquet(f"{self.root}/{manifest}").collect()}

    def state(self) -> dict[int, str]:
        """The generation in which each bucket that has rows lies now."""
        found = self._manifests()
        return self._state(found[-1]) if found else {}

    def buckets(self) -> list[int]:
        """The buckets that have rows."""
        return sorted(self.state())

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The table, or some of its buckets; None if it has none of them yet."""
        paths = [f"{self.root}/data/{g}/_bucket={b}" for b, g in sorted(self.state().items()) if buckets is None or b in buckets]
        return self.spark.read.parquet(*paths) if paths else None

    def _publish(self, state: dict[int, str]) -> None:
        number = max((int(n.split("-")[1]) for n in names(self.spark, self.root) if n.startswith("manifest-")), default=-1) + 1
        self.spark.createDataFrame(sorted(state.items()), MANIFEST).coalesce(1).write.parquet(f"{self.root}/manifest-{number:012d}")

    def _clean(self) -> None:
        manifests = self._manifests()
        for old in manifests[: -self.KEPT]:
            remove(self.spark, f"{self.root}/{old}")
        named = {g for m in manifests[-self.KEPT :] for g in self._state(m).values()}
        for generation in names(self.spark, f"{self.root}/data"):
            if generation not in named:
                remove(self.spark, f"{self.root}/data/{generation}")

    def write(self, batch: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame], empty: DataFrame) -> list[int]:
        """Apply a keyed write (target, batch) -> new rows; returns the touched buckets.  `empty` gives the table's schema.

        Rows without an id are left out.
        """
        batch = batch.where("_id IS NOT NULL")
        touched = sorted(r[0] for r in batch.select(self._bucket().alias("b")).distinct().collect())  # n values at most
        if not touched:
            return []
        state, generation = self.state(), uuid.uuid4().hex
        current = self.read(touched)
        rows = apply(current if current is not None else empty, batch).withColumn("_bucket", self._bucket())
        rows.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/data/{generation}")
        filled = [int(x.split("=")[1]) for x in names(self.spark, f"{self.root}/data/{generation}") if x.startswith("_bucket=")]
        self._publish({b: g for b, g in state.items() if b not in touched} | dict.fromkeys(filled, generation))
        self._clean()
        return touched
