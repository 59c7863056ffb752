"""Scans: pinned snapshots, pages, keyset continuation, slices, patterns and delimited rows."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.sources import tables

#: Rows of a range of a paged scan, about.
RANGE_ROWS = 1_000_000
#: Rows of a partition that is dealt by keys, about.
DEALT_ROWS = 250_000

STOCK = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("open", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()), T.StructField("volume", T.IntegerType()), T.StructField("symbol", T.StringType()),
])


def pages(df: DataFrame, sort: list[str | Column], size: int) -> DataFrame:
    """`page` (from 0) and `total` (rows of the scan) for each row in the sort order.

    The rows are written once to the work folder, dealt by ranges and sorted, each with the number of its range and its
    place there; counts of the ranges are taken from what was written, so every rank is exact whatever ranges Spark has
    sampled, and no single task sorts the table.  `sort` must be a total order for pages to be repeatable.
    """
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // RANGE_ROWS))
    ordered = df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    marked = ordered.withColumn("_part", F.spark_partition_id()).withColumn("_in_part", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    marked, _ = tables.pinned(marked, "ranges")
    counts = marked.groupBy("_part").agg(F.count("*").alias("_n"))
    shifts = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_shift"), F.sum("_n").over(Window.partitionBy()).alias("total"))  # a row a range
    page = F.floor((F.col("_shift") + F.col("_in_part")) / size).cast("long")
    return marked.join(F.broadcast(shifts), "_part").withColumn("page", page).drop("_part", "_in_part", "_shift")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows by a hash of the keys, in partitions whose number grows with the counted rows.

    For aggregates and joins on keys that seldom repeat: Spark would first gather the keys of a whole file split in a task,
    and then merge partitions down to few large ones.  A number that is asked for is kept.
    """
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // DEALT_ROWS))
    return df.repartition(n, *keys)


def after(df: DataFrame, sort: list[str], last: list, size: int) -> DataFrame:
    """The next `size` rows strictly after the last sort values."""
    cursor = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(sort, last, strict=True)])
    return df.where(F.struct(*sort) > cursor).orderBy(*sort).limit(size)


def sliced(df: DataFrame, key: str, n: int, numeric: bool = False) -> DataFrame:
    """`slice`: n disjoint parts by key, by hash or, for integer keys, by remainder."""
    return df.withColumn("slice", F.pmod(F.col(key), F.lit(n)) if numeric else F.pmod(F.xxhash64(key), F.lit(n)))


def pattern_union(frames: dict[str, DataFrame], pattern: str) -> DataFrame:
    """Rows of all frames whose name matches a * pattern, with `_index`; missing columns read as null."""
    import fnmatch

    out = None
    for name in sorted(frames):
        if fnmatch.fnmatchcase(name, pattern):
            one = frames[name].withColumn("_index", F.lit(name))
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no table matches {pattern}")
    return out


def external(spark: SparkSession, fmt: str, where: str | None = None, columns: list[str] | None = None, **options: str) -> DataFrame:
    """Rows of another system through a Spark reader; the filter and the columns are pushed down where it can."""
    df = spark.read.format(fmt).options(**options).load()
    df = df.where(where) if where else df
    return df.select(*columns) if columns else df


def stock_rows(spark: SparkSession, path: str) -> DataFrame:
    """date, open, high, low, close, volume, symbol from delimited text."""
    return spark.read.schema(STOCK).csv(path)


def stock_columns(line: Column) -> list[Column]:
    """The same from a column of lines."""
    part = F.split(line, ",")
    return [part[i].cast(f.dataType).alias(f.name) for i, f in enumerate(STOCK.fields)]


def produced(spark: SparkSession, path: str, schema: str, stream: bool = False, most_files: int | None = None, consume: bool = False) -> DataFrame:
    """Rows that producers hand over as JSON lines in the files of a folder, as a table or as a stream.

    `_malformed` holds a line that is no object of the schema, else null.  Spark reads a file once it is in the folder,
    so a producer writes it elsewhere and moves it in, as Spark's own writers do.  A stream admits `most_files` in a
    micro-batch and, with `consume`, deletes them once their micro-batch is committed, which makes room for producers
    that wait for it (see wait_for_room).
    """
    wanted = T.StructType.fromDDL(schema)
    reader = (spark.readStream if stream else spark.read).schema("value string")
    if stream and most_files:
        reader = reader.option("maxFilesPerTrigger", most_files)
    if stream and consume:
        reader = reader.option("cleanSource", "delete")
    rows = reader.text(path).where(F.trim("value") != "").withColumn("_row", F.from_json("value", T.StructType([*wanted.fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}))
    return rows.select(*[F.col(f"_row.{f.name}") for f in wanted.fields], F.col("_row._bad").alias("_malformed"))


def waiting_files(spark: SparkSession, path: str) -> int:
    """How many files of the folder no stream has consumed yet."""
    return sum(not n.startswith(("_", ".")) for n in tables.names(spark, path))


def wait_for_room(spark: SparkSession, path: str, most: int, timeout: float | None = None, poll: float = 0.1) -> None:
    """Full-buffer policy `wait`: returns once fewer than `most` files wait in the folder; TimeoutError after `timeout` seconds."""
    began = time.monotonic()
    while waiting_files(spark, path) >= most:
        if timeout is not None and time.monotonic() - began > timeout:
            raise TimeoutError(f"{path} stayed full")
        time.sleep(poll)


def handed_over_frame(rows: DataFrame, path: str, most: int, files: int = 1, timeout: float | None = None) -> None:
    """A producer on Spark: waits for room, then adds the rows as `files` files, so at most `most` + `files` - 1 wait."""
    wait_for_room(rows.sparkSession, path, most, timeout)
    rows.select(F.to_json(F.struct("*")).alias("value")).coalesce(files).write.mode("append").text(path)


def handed_over(spark: SparkSession, rows: Iterable[Mapping], schema: str, path: str, most: int = 10_000, most_files: int | None = None, timeout: float | None = None) -> int:
    """A producer in the driver: rows from an iterator go to the folder in files of `most` rows, so that no more are held
    at a time; returns how many were handed over.  With `most_files` it takes no row from the iterator while that many
    files wait."""
    from itertools import islice

    count, rest = 0, iter(rows)
    while True:
        if most_files:
            wait_for_room(spark, path, most_files, timeout)
        part = [dict(r) for r in islice(rest, most)]
        if not part:
            return count
        frame = spark.createDataFrame([tuple(r.get(f.name) for f in T.StructType.fromDDL(schema).fields) for r in part], schema)
        frame.coalesce(1).select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)
        count += len(part)
