"""Shared plumbing: the shared work folder, size-checked joins and Arrow batches."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from keelson.session import ship
from keelson.sources import tables

#: Rows of one Arrow batch; very long texts make larger batches too large for small executors.
ARROW_ROWS = 1000
#: A side of a join is broadcast only if it has been counted and has at most this many rows.
BROADCAST_ROWS = 1_000_000
#: A set of ids is broadcast as bitmaps of 32,768 ids and 4 KB each if it has at most this many (64 MB; 536 million dense ids).
BROADCAST_BITMAPS = 16_384

_own_dirs: dict[str, str] = {}
_scope = threading.local()


def prepare(spark: SparkSession) -> None:
    """Ship the package, and keep Arrow batches small (a session setting that is only ever lowered)."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="spark-")
    return _own_dirs[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "zstd") -> tuple[DataFrame, str]:
    """Write `df` once to the shared folder; the frame that reads it back, and its path, which the caller removes."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def pinned(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write `df` once to the shared folder and read it back: lineage ends there, and a lost executor costs nothing.

    The table stays in the folder unless it is made within `discarding`.
    """
    kept, path = written(df, name, compression)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    return kept


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the work tables that this thread pinned inside, the library's own among them: write what is
    still needed before."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        with tables.discarding(spark):
            yield
    finally:
        mine, _scope.paths = _scope.paths, outer
        for path in mine:
            tables.remove(spark, path)


def join_counted(big: DataFrame, small: DataFrame, on: str, how: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast `small` if its counted rows are few, else leave the join to Spark's shuffle.

    `small` should be pinned or cheap: it is counted first.
    """
    if small.limit(most + 1).count() <= most:
        small = F.broadcast(small)
    return big.join(small, on, how)


def flagged(big: DataFrame, ids: DataFrame, on: str, name: str) -> DataFrame:
    """`big` with a boolean column `name`: whether its long column `on` is in the one column of `ids` (null: false).

    The rows of `big`, which may hold texts, stay where they are: few ids are broadcast as they are, more as bitmaps by
    range of ids, which for dense ids take a bit each.  Only ids that are too many for both go through a shuffle join.
    `ids` should be pinned or cheap: it is counted.  All three ways give the same rows.
    """
    ids = ids.select(F.col(ids.columns[0]).cast("long").alias("_id")).where("_id IS NOT NULL")
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        hits = F.broadcast(ids.distinct())
    else:
        maps = ids.groupBy(F.expr("bitmap_bucket_number(_id)").alias("_bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_id))").alias("_bits"))
        maps = pinned(maps, "id-bitmaps")
        if maps.count() <= BROADCAST_BITMAPS:
            joined = big.withColumn("_bucket", F.expr(f"bitmap_bucket_number(`{on}`)")).join(F.broadcast(maps), "_bucket", "left")
            place = F.expr(f"bitmap_bit_position(`{on}`)")
            byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
            bit = F.expr("1L").bitwiseAND(F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7).cast("long")).cast("int")))
            return joined.withColumn(name, F.coalesce(bit == 1, F.lit(False))).select(*[F.col(f"`{c}`") for c in big.columns], name)
        hits = ids.distinct()
    hits = hits.withColumn("_hit", F.lit(True))
    return big.join(hits, big[on] == hits["_id"], "left").select(*[big[f"`{c}`"] for c in big.columns], F.coalesce("_hit", F.lit(False)).alias(name))


def held_out(id_col: str, folds: int, fold: int):
    """True where crc32 of the id's decimal text falls in the held-out fold; a null id is held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(True))


def carried(rows: DataFrame, keep: list[str], added: str) -> StructType:
    """The schema of the columns `keep` of `rows`, followed by those of the DDL `added`."""
    return StructType([StructField(c, rows.schema[c].dataType) for c in keep] + StructType.fromDDL(added).fields)


def slices(texts: list, most_chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into runs of bounded size (a longer text is a run of its own)."""
    at, total = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > at and total + n > most_chars:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(texts):
        yield at, len(texts)
