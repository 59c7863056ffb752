"""Each row of a stated query set against each row of a table, in tiles of bounded size.

Both sides are dealt out by a hash of their row number, so neither a hot value nor a hot id fills a tile, and neither side
passes through the driver or a broadcast.  A table of N rows and Q queries moves N * Q / SIDE rows twice, which the
N * Q comparisons inside the tiles outweigh.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from keelson.session import ship

#: Most rows of either side of a tile, on average.
SIDE = 16_384


def tiled(queries: DataFrame, rows: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str, key: str = "row", side: int = SIDE) -> DataFrame:
    """The union of `fn(queries of a tile, rows of a tile)`; each pair of a query and a row meets in one tile.

    Both frames should be pinned, as they are counted, and have a long column `key` that numbers their rows.  There are at
    least as many tiles as Spark has shuffle partitions.  `fn` isn't called for tiles without a query or without a row.
    """
    spark = rows.sparkSession
    ship(spark)
    parts = max(math.ceil(rows.count() / side), int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = max(1, math.ceil(queries.count() / side))
    on = ["_block", "_part"]
    dealt = lambda n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("_block", dealt(blocks)).withColumn("_part", every(parts))
    right = rows.withColumn("_part", dealt(parts)).withColumn("_block", every(blocks))
    empty = to_arrow_schema(StructType.fromDDL(schema)).empty_table()

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return fn(a, b) if a.num_rows and b.num_rows else empty

    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(run, schema)


def by_width(column: pa.ChunkedArray, kind: type = float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the lists of each length in a column without nulls."""
    lengths = np.asarray(pc.list_value_length(column).to_numpy(), np.int64)
    for width in np.unique(lengths):
        at = np.flatnonzero(lengths == width)
        flat = column.take(pa.array(at)).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        yield at, np.asarray(flat, kind).reshape(len(at), width)


def first_of_each(group: np.ndarray, n: int, *order: np.ndarray) -> np.ndarray:
    """Places of the first n of each group in the given order, groups ascending."""
    at = np.lexsort((*order[::-1], group))
    mine = group[at]
    start = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]])) if len(mine) else np.zeros(0, np.int64)
    place = np.arange(len(mine)) - np.repeat(start, np.diff(np.append(start, len(mine))))
    return at[place < n]
