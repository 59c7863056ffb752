"""Operator 10: token ids as Simple-8b words in files ordered by document id.

A file row (a frame) holds up to `frame_ids` ids of whole documents: part and frame number, ids before it in its part,
the documents' ids and lengths, the word offset of each block of 1024 ids, and the words (little-endian u64).  Parquet
is the container, so Spark's committer makes lost tasks harmless and any store that Spark reads will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm import simple8b, tokens, work

FRAME_IDS = 262_144
FRAME = pa.schema([("part", pa.int32()), ("frame", pa.int32()), ("ids_before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("block_offsets", pa.list_(pa.int32())), ("words", pa.binary())])
FRAMES = "part int, frame int, ids_before long, n_ids long, doc_ids array<long>, n_tokens array<long>, block_offsets array<int>, words binary"


def splits(rows: DataFrame, parts: int) -> tuple[int, np.ndarray]:
    """(parts for null ids, upper bounds of the other parts but the last): about equal parts of the rows, which should be cheap.

    An id with more rows than a part is the bound of several.
    """
    share = [k / parts for k in range(1, parts)] or [0.5]
    found = rows.agg(F.count("*").alias("n"), F.count("doc_id").alias("ids"), F.percentile_approx("doc_id", share, max(10_000, 10 * parts)).alias("bounds")).first()
    nulls = -(-(found["n"] - found["ids"]) * parts // found["n"]) if found["n"] else 0
    return nulls, np.array(sorted(found["bounds"] or []) if parts > 1 else [], np.int64)


def placed(ids: pa.Array, nulls: int, bounds: np.ndarray, serial: int) -> np.ndarray:
    """The part of each id; rows of null ids, and of ids that are the bound of several parts, are dealt in turn from `serial`."""
    none, turn = np.asarray(ids.is_null(), bool), serial + np.arange(len(ids))
    number = ids.fill_null(0).to_numpy()
    first, last = np.searchsorted(bounds, number, "left"), np.searchsorted(bounds, number, "right")
    return np.where(none, turn % max(1, nulls), nulls + first + turn % np.maximum(1, last - first)).astype(np.int32)


def encode_frames(docs: DataFrame, tokenizer_path: str, end_id: int = 2, frame_ids: int = FRAME_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Frames in ascending document id (null ids first, repeated ids in any order); null text counts as empty.

    Texts are encoded where they lie; their ids, 2 bytes each where that is enough, are dealt to tasks by ranges of the document
    id, whose bounds are quantiles, and sorted in each task.  Rows that share an id may fill several parts.  A document stays
    within one frame.  Other columns are ignored; an empty table gives no frames.
    """
    work.prepare(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, serial = tokens.encoder(tokenizer_path), TaskContext.get().partitionId()
        for batch in batches:
            texts, held = batch.column(1).to_pylist(), []
            for a, b in work.slices(texts, tokens.SLICE_CHARS):
                ids, size = encoder.encode(texts[a:b], end_id)
                ids = ids.astype("<u2" if int(ids.max(initial=0)) < 65536 else "<u4")
                held += [(ids.itemsize, own.tobytes()) for own in np.split(ids, np.cumsum(size)[:-1])]
            part = placed(batch.column(0), nulls, bounds, serial)
            serial += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(part), batch.column(0), pa.array([w for w, _ in held], pa.int32()), pa.array([x for _, x in held], pa.binary())], names=["part", "doc_id", "width", "ids"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, frame, before, n = TaskContext.get().partitionId(), 0, 0, 0
        keys: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            words, offsets = simple8b.encode(np.concatenate(held))
            row = (part, frame, before, n, keys, sizes, offsets.tolist(), words.astype("<u8").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, FRAME, strict=True)], schema=FRAME)

        for batch in batches:
            for key, width, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(data, f"<u{width}").astype(np.uint64)
                if held and n + len(own) > frame_ids:
                    yield flush()
                    frame, before = frame + 1, before + n
                    keys, sizes, held, n = [], [], [], 0
                keys.append(key)
                sizes.append(len(own))
                held.append(own)
                n += len(own)
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    nulls, bounds = splits(rows.select("doc_id"), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.mapInArrow(encode, "part int, doc_id long, width int, ids binary").repartitionById(nulls + len(bounds) + 1, "part").sortWithinPartitions("doc_id")
    return dealt.select("doc_id", "width", "ids").mapInArrow(gather, FRAMES)


def write_files(docs: DataFrame, path: str, tokenizer_path: str, **options) -> str:
    """Write the frames of `docs` under `path` and return it."""
    encode_frames(docs, tokenizer_path, **options).write.option("compression", "zstd").parquet(path)
    return path


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Frames with `start`, the ids of all documents before the frame.  The totals of the parts are one row a part."""
    frames = spark.read.schema(FRAMES).parquet(path)
    parts = frames.groupBy("part").agg(F.sum("n_ids").alias("total"))
    parts = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("part_start"))
    return frames.join(F.broadcast(parts), "part").withColumn("start", F.col("part_start") + F.col("ids_before"))


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian u32) and, if asked, ids.

    A null or empty text comes back as its end id; null ids come first; repeated ids and rows have a row each; a very long
    text is one document of one frame; files without frames give no rows.
    """
    work.prepare(spark)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), *([("ids", pa.list_(pa.int64()))] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), np.array(row["block_offsets"], np.int64), row["n_ids"])
                data, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(row["n_tokens"])
                begins = ends - row["n_tokens"]
                columns = [row["doc_ids"], (row["start"] + begins).tolist(), row["n_tokens"], [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]]
                if with_ids:
                    columns.append([ids[a:b].astype(np.int64).tolist() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    fields = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return read_frames(spark, path).select("start", "n_ids", "doc_ids", "n_tokens", "block_offsets", "words").mapInArrow(run, fields)
