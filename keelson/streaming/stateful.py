"""Streams with state: batches that close at a number of rows or at an age, and re-sends that wait between micro-batches.

Rows wait in Spark's state store, by lane (a hash of the key), so a restart from the checkpoint finds them; timers run on
processing time, and no task sleeps.  The session needs the RocksDB store: see `use_state`.
"""

from __future__ import annotations

import os
import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keelson.operators import reports
from keelson.session import ship

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Bytes of a slice of rows on its way through the state: Spark hands over up to 10,000 slices at once.
BODY = 16_384
#: Bytes of an entry of the state: each is a call from Python to the JVM.
KEPT = 1_048_576


def use_state(spark: SparkSession) -> None:
    """Ship the package and choose the state store that timers and lists need.

    Spark also loads a processor in a Python process beside the driver, which gets no shipped files: it finds the package
    by its path.
    """
    ship(spark)
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (env.get("PYTHONPATH"), root)))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def laned(stream: DataFrame, key: str, lanes: int) -> DataFrame:
    """`_lane`: rows of a key share one; a hot key fills one lane only as fast as its batches close."""
    return stream.withColumn("_lane", F.pmod(F.xxhash64(key), F.lit(lanes)).cast("int"))


def waking(stream: DataFrame) -> DataFrame:
    """The same rows, with a clock beside them that has none.

    Once started again, Spark runs no micro-batch before a source has something new, so timers of rows that wait in the
    state wouldn't fire until then.  The clock always has.
    """
    clock = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    return stream.unionByName(clock.where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields]))


@contextmanager
def state_partitions(spark: SparkSession, lanes: int) -> Iterator[None]:
    """For the start of a query: no more partitions of the state than its lanes can fill, as each has its own store and
    Python process in every micro-batch.  Spark takes the number at the first start and keeps it in the checkpoint."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 4 * lanes)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _packed(values: tuple) -> bytes:
    """A row as the store keeps it: Spark hands longer lists over by way of pandas, which would change nullable longs."""
    return pickle.dumps(values)


class _Batcher(StatefulProcessor):
    def __init__(self, names: list[str], size: int, age_ms: int):
        self.names, self.size, self.age_ms = [*names, "batch", "closed_by"], size, age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", T.StructType().add("row", T.BinaryType()))
        self.state = handle.getValueState("batch", T.StructType().add("batch", T.LongType()).add("n", T.IntegerType()).add("due", T.LongType()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        batch, n, due = tuple(self.state.get()) if self.state.exists() else (0, 0, 0)
        fresh: list[tuple] = []
        for row in rows:
            if n == 0:
                due = now + self.age_ms
            fresh.append(tuple(row))
            n += 1
            if n == self.size:
                yield from self._closed(key, batch, "count", fresh)
                batch, n, fresh = batch + 1, 0, []
        if fresh:
            self.rows.appendList([(_packed(row),) for row in fresh])
        for timer in list(self.handle.listTimers()):
            if timer != due or n == 0:
                self.handle.deleteTimer(timer)
        if n:
            self.handle.registerTimer(due)
        self.state.update((batch, n, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        batch, n, _ = tuple(self.state.get())
        if n:
            yield from self._closed(key, batch, "age", [])
            self.state.update((batch + 1, 0, 0))

    def _closed(self, key, batch: int, why: str, fresh: list[tuple]) -> Iterator[Row]:
        for row in [pickle.loads(r[0]) for r in self.rows.get()] + fresh:
            yield Row(**dict(zip(self.names, (*row, batch, why), strict=True)))
        self.rows.clear()

    def close(self) -> None:
        pass


def flushed(stream: DataFrame, key: str, size: int, age_seconds: float, lanes: int = 64) -> DataFrame:
    """The rows of a stream with _lane, batch (a number in the lane) and closed_by (count or age), batch by batch.

    A batch closes with its `size`-th row or `age_seconds` after its first one, whichever comes first, and only then do
    its rows leave.  At most `size` rows a lane wait.
    """
    use_state(stream.sparkSession)
    rows = laned(waking(stream), key, lanes)
    out = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("batch long, closed_by string").fields])
    return rows.groupBy("_lane").transformWithState(_Batcher(rows.columns, size, int(age_seconds * 1000)), out, "Append", "ProcessingTime")


class _Sender(StatefulProcessor):
    def __init__(self, send: Callable[[pd.DataFrame, int], list[int]], retries: int, delay: Callable[[int], float], chunk: int):
        self.send, self.retries, self.delay, self.chunk = send, retries, delay, chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", T.StructType().add("due", T.LongType()).add("attempt", T.IntegerType()).add("n", T.LongType()), T.StructType().add("body", T.BinaryType()))
        self.last = handle.getValueState("last", T.StructType().add("n", T.LongType()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        yield from self._sent((bytes(row.body) for row in rows), 0, timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now, due = timerValues.getCurrentProcessingTimeInMs(), {}
        for at, attempt, n in sorted(tuple(k) for k in self.waiting.keys() if k[0] <= now):
            due.setdefault(attempt, []).append((at, attempt, n))
        for attempt, keys in sorted(due.items()):
            yield from self._sent(map(self._taken, keys), attempt, now)

    def _taken(self, key: tuple) -> bytes:
        body = bytes(self.waiting.getValue(key)[0])
        self.waiting.removeKey(key)
        return body

    def _sent(self, bodies: Iterator[bytes], attempt: int, now: int) -> Iterator[Row]:
        due = now + int(1000 * self.delay(attempt)) if attempt < self.retries else None
        n, held, more = (self.last.get()[0] if self.last.exists() else 0), [], False
        for rows in _chunks(bodies, self.chunk):
            try:
                status = np.array(list(self.send(rows.to_pandas(types_mapper=pd.ArrowDtype), attempt)), np.int32)
                assert len(status) == rows.num_rows
            except Exception:  # noqa: BLE001  a failed transport is reported, not retried
                status = np.zeros(rows.num_rows, np.int32)
            again = np.isin(status, reports.RETRY_STATUS)
            if due is not None and again.any():
                held.append(rows.filter(pa.array(again)))
                if sum(t.nbytes for t in held) >= KEPT:
                    n = self._kept(held, due, attempt + 1, n)
                    held, more = [], True
            final = np.ones(len(again), bool) if due is None else ~again
            if final.any():
                outcome = np.where(again, "exhausted", np.where((status >= 200) & (status <= 299), "accepted", "rejected"))[final]
                said = (("status", pa.array(status[final])), ("attempts", pa.array(np.full(len(outcome), attempt + 1, np.int32))), ("outcome", pa.array(outcome.tolist(), pa.string())))
                left = rows.filter(pa.array(final))
                for name, column in said:
                    left = left.append_column(name, column)
                for body in _bodies(left, self.chunk):
                    yield Row(body=body)
        if held or more:
            self.last.update((self._kept(held, due, attempt + 1, n),))
            self.handle.registerTimer(due)

    def _kept(self, held: list[pa.Table], due: int, attempt: int, n: int) -> int:
        for body in _bodies(pa.concat_tables(held), None, KEPT) if held else ():
            n += 1
            self.waiting.updateValue((due, attempt, n), (body,))
        return n

    def close(self) -> None:
        pass


def _bodies(rows: pa.Table, most: int | None, size: int = BODY) -> Iterator[bytes]:
    """The rows in Arrow's stream format, in slices of at most `most` rows and about `size` bytes."""
    step = max(1, min(most or rows.num_rows, rows.num_rows * size // max(1, rows.nbytes)))
    for first in range(0, rows.num_rows, step):
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, rows.schema) as writer:
            writer.write_table(rows.slice(first, step).combine_chunks())
        yield out.getvalue().to_pybytes()


def _chunks(bodies: Iterator[bytes], most: int) -> Iterator[pa.Table]:
    """The rows of bodies, joined to tables of `most` rows; the last one may be smaller."""
    held, n = [], 0
    for body in bodies:
        held.append(pa.ipc.open_stream(body).read_all())
        n += held[-1].num_rows
        while n >= most:
            rows = pa.concat_tables(held)
            yield rows.slice(0, most).combine_chunks()
            held, n = [rows.slice(most)], n - most
    if n:
        yield pa.concat_tables(held).combine_chunks()


def resent(stream: DataFrame, key: str, send: Callable[[pd.DataFrame, int], list[int]], retries: int = 3, delay: Callable[[int], float] = lambda attempt: 2.0 * (attempt + 1), lanes: int = 64, chunk: int = 1000) -> DataFrame:
    """The rows of a stream with _lane, status, attempts and outcome (accepted, rejected or exhausted: the dead letters).

    As delivery.send_with_retries, but a row whose status is retryable waits in the state, `delay(attempt)` seconds, for a
    later micro-batch; other rows go on meanwhile.  A row leaves when its outcome is final.  Rows are shuffled, wait and leave
    as slices in Arrow's format, so that Python handles no single row.
    """
    use_state(stream.sparkSession)
    rows = laned(waking(stream), key, lanes)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, lane = pa.Table.from_batches([batch]), batch.column(batch.schema.get_field_index("_lane"))
            for value in pc.unique(lane):
                bodies = list(_bodies(table.filter(pc.equal(lane, value)), chunk))
                yield pa.RecordBatch.from_arrays([pa.array([value.as_py()] * len(bodies), pa.int32()), pa.array(bodies, pa.binary())], names=["_lane", "body"])

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                yield from pa.ipc.open_stream(body.as_buffer()).read_all().to_batches()

    sent = rows.mapInArrow(packed, "_lane int, body binary").groupBy("_lane").transformWithState(_Sender(send, retries, delay, chunk), "body binary", "Append", "ProcessingTime")
    return sent.mapInArrow(unpacked, T.StructType([*rows.schema.fields, *T.StructType.fromDDL("status int, attempts int, outcome string").fields]))
