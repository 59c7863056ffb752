"""Streams with state: batches by count and age, delayed re-sends, waiting producers, and restarts of each."""

from __future__ import annotations

import threading
import time

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F

from keelson.sources import readers, tables
from keelson.streaming import stateful

BIG = 9007199254740993


def start(rows, out, checkpoint):
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime="200 milliseconds").start()


def read(spark, out):
    try:
        return spark.read.parquet(out).collect() if tables.names(spark, f"{out}/_spark_metadata") else []
    except AnalysisException:  # nothing is committed yet
        return []


def wait_for(spark, query, out, n, seconds=90):
    began = time.monotonic()
    while len(read(spark, out)) < n and time.monotonic() - began < seconds and query.isActive:
        time.sleep(0.2)
    assert query.exception() is None
    return read(spark, out)


def source(spark, path, first, last):
    spark.range(first, last).selectExpr("id", "id % 3 AS k", f"CASE WHEN id % 2 = 0 THEN {BIG} + id END AS big").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("id long, k long, big long").parquet(path)


def test_batches_close_by_count_and_by_age(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows = stateful.flushed(source(spark, path, 0, 250), "k", 20, 3, lanes=2)
    query = start(rows, out, checkpoint)
    early = wait_for(spark, query, out, 200)
    query.stop()  # the rest waits in the state
    assert {r["closed_by"] for r in early} == {"count"} or len(early) == 250
    source(spark, path, 250, 255)
    query = start(rows, out, checkpoint)
    got = wait_for(spark, query, out, 255)
    query.stop()
    assert sorted(r["id"] for r in got) == list(range(255))
    assert all(r["big"] == (BIG + r["id"] if r["id"] % 2 == 0 else None) for r in got)
    batches = {}
    for r in got:
        batches.setdefault((r["_lane"], r["batch"]), []).append(r["closed_by"])
    assert all((set(b), len(b)) == ({"count"}, 20) or (set(b) == {"age"} and len(b) < 20) for b in batches.values())
    assert any(b[0] == "age" for b in batches.values())
    for lane in {k[0] for k in batches}:
        assert sorted(n for x, n in batches if x == lane) == list(range(sum(x == lane for x, _ in batches)))


def send(rows, attempt):
    return [400 if i % 10 == 4 else 429 if i % 6 > attempt else 201 for i in rows["id"]]


def test_resends_wait_in_the_state(spark, tmp_path):
    """Stopped while rows wait and started again: each row leaves once, as the batch operator says."""
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    rows = stateful.resent(source(spark, path, 0, 240), "id", send, retries=3, delay=lambda attempt: 2.0, lanes=3, chunk=50)
    query = start(rows, out, checkpoint)
    early = wait_for(spark, query, out, 1)
    query.stop()
    assert 0 < len(early) < 240 and "exhausted" not in {r["outcome"] for r in early}
    query = start(rows, out, checkpoint)
    got = wait_for(spark, query, out, 240)
    query.stop()
    want = {}
    for i in range(240):
        want[i] = (400, 1, "rejected") if i % 10 == 4 else (429, 4, "exhausted") if i % 6 > 3 else (201, i % 6 + 1, "accepted")
    assert len(got) == 240 and {r["id"]: (r["status"], r["attempts"], r["outcome"]) for r in got} == want
    assert all(r["big"] == (BIG + r["id"] if r["id"] % 2 == 0 else None) for r in got)


@pytest.mark.parametrize("kind", ["resent", "flushed"])
def test_rows_leave_after_a_restart_without_new_rows(spark, tmp_path, kind):
    """Stopped between two micro-batches, so that none is left to be run again: timers fire all the same."""
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    stream = source(spark, path, 0, 60)
    rows = stateful.resent(stream, "id", send, retries=3, delay=lambda attempt: 0.5, lanes=2) if kind == "resent" else stateful.flushed(stream, "k", 1000, 1, lanes=2)
    first = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime="1 hour").start()
    began = time.monotonic()
    while not (tables.names(spark, f"{checkpoint}/commits") and not first.status["isTriggerActive"]) and time.monotonic() - began < 60:
        time.sleep(0.1)
    first.stop()
    assert len(read(spark, out)) < 60
    query = start(rows, out, checkpoint)
    got = wait_for(spark, query, out, 60)
    query.stop()
    assert sorted(r["id"] for r in got) == list(range(60))


class Kept:
    """A map or value of the state, and the handle, in memory."""

    def __init__(self):
        self.entries, self.value, self.timers, self.calls = {}, None, set(), 0

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def keys(self):
        return iter(self.entries)

    def getValue(self, key):  # noqa: N802
        return self.entries[key]

    def updateValue(self, key, value):  # noqa: N802
        assert key not in self.entries
        self.entries[key], self.calls = value, self.calls + 1

    def removeKey(self, key):  # noqa: N802
        del self.entries[key]

    def registerTimer(self, due):  # noqa: N802
        self.timers.add(due)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return self.now


def test_waiting_rows_are_kept_in_large_entries():
    """The state is called for a megabyte of rows, not for each row, and the sender sees whole chunks."""
    n, sizes = 100_000, []
    table = pa.table({"id": pa.array(range(n), pa.int64()), "big": pa.array([BIG + i if i % 2 else None for i in range(n)], pa.int64()), "tags": pa.array([[str(i)] for i in range(n)])})
    sender = stateful._Sender(lambda rows, attempt: [*map(int, sizes.append(len(rows)) or send(rows, attempt))], 3, lambda attempt: 1.0, 1000)
    sender.waiting, sender.last, sender.handle = Kept(), Kept(), Kept()
    got = list(sender.handleInputRows(0, (Row(body=b) for b in stateful._bodies(table, 1000)), Clock(0)))
    assert set(sizes) == {1000} and sender.waiting.calls < 20
    for now in (1000, 2000, 3000):
        assert sender.handle.timers == {t for t in (1000, 2000, 3000) if t <= now}
        got += list(sender.handleExpiredTimer(0, Clock(now), None))
    assert not sender.waiting.entries and sender.waiting.calls < 50 and all(len(r.body) < 40_000 for r in got)
    rows = [r for b in got for r in pa.ipc.open_stream(b.body).read_all().to_pylist()]
    assert len(rows) == n and all(r["big"] == (BIG + r["id"] if r["id"] % 2 else None) and r["tags"] == [str(r["id"])] for r in rows)
    want = {i: (400, 1, "rejected") if i % 10 == 4 else (429, 4, "exhausted") if i % 6 > 3 else (201, i % 6 + 1, "accepted") for i in range(n)}
    assert {r["id"]: (r["status"], r["attempts"], r["outcome"]) for r in rows} == want


def test_a_failed_transport_is_rejected(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    query = start(stateful.resent(source(spark, path, 0, 9), "id", lambda r, a: 1 / 0, lanes=2), out, checkpoint)
    got = wait_for(spark, query, out, 9)
    query.stop()
    assert {(r["status"], r["attempts"], r["outcome"]) for r in got} == {(0, 1, "rejected")}


def test_producers_wait_for_a_slow_sink(spark, tmp_path):
    """No more than two files wait at any time, however slow the sink is, and a restart loses none."""
    path, out, checkpoint = str(tmp_path / "handed"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    taken, most, failed = [], [], []

    def rows():
        for i in range(80):
            taken.append(i)
            yield {"id": i, "name": f"n{i}"}

    def produce():
        try:
            readers.handed_over(spark, rows(), "id long, name string", path, most=10, most_files=2, timeout=90)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    producer = threading.Thread(target=produce)
    producer.start()
    while readers.waiting_files(spark, path) < 2:
        time.sleep(0.05)
    time.sleep(1.0)
    assert len(taken) == 20  # nothing is taken from the producer while the folder is full

    def slow(batch, batch_id):
        most.append(readers.waiting_files(spark, path))
        time.sleep(0.4)
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def run():
        stream = readers.produced(spark, path, "id long, name string", stream=True, most_files=1, consume=True)
        return stream.writeStream.foreachBatch(slow).option("checkpointLocation", checkpoint).trigger(processingTime="100 milliseconds").start()

    query = run()
    while len(most) < 3 and query.isActive:
        time.sleep(0.1)
    query.stop()
    query = run()
    producer.join(120)
    began = time.monotonic()
    while spark.read.parquet(out).count() < 80 and time.monotonic() - began < 60:
        time.sleep(0.2)
    query.stop()
    assert not failed and max(most) <= 2
    assert sorted(r["id"] for r in spark.read.parquet(out).select("id").collect()) == list(range(80))
    assert spark.read.parquet(out).where(F.col("_malformed").isNotNull()).count() == 0
