"""Queries over batching and streaming delivery; streams read events or documents split into files."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

from pyspark.sql import functions as F

from keelson.plans.q_writes import table
from keelson.sources import readers
from keelson.sources.tables import BucketedTable, names, scratch
from keelson.streaming import delivery as D
from keelson.streaming import stateful

BUDGET = 20_000


def stream(spark, d, columns=("event_id", "ts", "user_id", "event_type", "value"), key="user_id", files=4):
    """events as a stream of files; all rows of a key are in one file, so any order of files gives one result."""
    path = scratch(spark, "event-files")
    rows = table(spark, d, "events").select(*columns)
    rows.repartition(files, key).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def t1(spark, d):
    return D.count_batches(table(spark, d, "events").select("event_id"), ["event_id"], 1000).groupBy("batch").agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))


def paged(spark, d):
    return table(spark, d, "documents").select("doc_id", F.floor(F.col("doc_id") / 100).cast("long").alias("page"), F.octet_length("text").alias("bytes"))


def t3(spark, d):
    return D.byte_batches(paged(spark, d), "page", "doc_id", F.col("bytes"), BUDGET).select("doc_id", "page", "batch")


def t3_names(spark, d):
    """The same in the order of names, which are texts."""
    named = paged(spark, d).withColumn("name", F.format_string("doc-%09d", "doc_id"))
    return D.byte_batches(named, "page", "name", F.col("bytes"), BUDGET).select("doc_id", "page", "batch")


T3 = f"""
WITH RECURSIVE d AS (SELECT doc_id, doc_id // 100 AS page, strlen(text) AS bytes, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) AS k FROM documents),
w AS (SELECT doc_id, page, k, bytes AS used, 0 AS batch FROM d WHERE k = 1
  UNION ALL SELECT d.doc_id, d.page, d.k, CASE WHEN w.used > 0 AND w.used + d.bytes > {BUDGET} THEN d.bytes ELSE w.used + d.bytes END, CASE WHEN w.used > 0 AND w.used + d.bytes > {BUDGET} THEN w.batch + 1 ELSE w.batch END
  FROM w JOIN d ON d.page = w.page AND d.k = w.k + 1)
SELECT doc_id, page, batch FROM w
"""


def t2(spark, d):
    """Age batches: appends every second until drained."""
    out = scratch(spark, "aged")
    D.drain(D.append_stream(stream(spark, d), out, scratch(spark, "checkpoint"), processing_time="1 second"))
    return spark.read.parquet(out)


def send(rows, attempt):
    """A receiver: event 4 of 10 is bad; events with number % 6 above the attempt are busy."""
    return [400 if i % 10 == 4 else 429 if i % 6 > attempt else 201 for i in rows["event_id"]]


def t6(spark, d):
    out = D.send_with_retries(table(spark, d, "events").select("event_id", "event_type"), send, retries=3)
    return out.groupBy("outcome", "status", "attempts").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


def t6_dead(spark, d):
    """Dead letters: what a stream of events could not deliver, appended batch by batch."""
    out = scratch(spark, "dead-letters")

    def deliver(batch, batch_id):
        D.send_with_retries(batch, send, retries=3).where("outcome <> 'accepted'").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    D.drain(stream(spark, d, ("event_id", "user_id")).writeStream.foreachBatch(deliver).option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start())
    return spark.read.parquet(out).select("event_id", "outcome")


def emitted(rows, spark, n, lanes=None):
    """What a stream of rows has put into Parquet, with its timers running, once there are n rows; then it is stopped."""
    out = scratch(spark, "sink")
    with stateful.state_partitions(spark, lanes) if lanes else nullcontext():
        query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch(spark, "checkpoint")).trigger(processingTime="500 milliseconds").start()
    written = lambda: spark.read.schema(rows.schema).parquet(out)
    while query.isActive and (not names(spark, f"{out}/_spark_metadata") or written().count() < n):
        time.sleep(0.3)
    for _ in range(100):  # between two micro-batches, if there is a pause
        if not query.status["isTriggerActive"]:
            break
        time.sleep(0.05)
    query.stop()
    if query.exception():
        raise query.exception()
    return written()


def whole_stream(spark, d, *columns):
    """events as a stream of one micro-batch."""
    path = scratch(spark, "event-files")
    rows = table(spark, d, "events").select(*columns)
    rows.coalesce(2).write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def t2_flush(spark, d):
    """Batches of 700 events of a lane; what is left in a lane leaves when it is two seconds old."""
    rows = stateful.flushed(whole_stream(spark, d, "event_id", "user_id"), "user_id", 700, 2, lanes=4)
    found = emitted(rows, spark, table(spark, d, "events").count(), lanes=4)
    lane = found.groupBy("_lane", "closed_by").agg(F.count("*").alias("n"), F.countDistinct("batch").alias("batches"))
    sums = lane.groupBy("_lane").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("closed_by") == "count", F.col("batches"))), F.lit(0)).alias("full"), F.coalesce(F.sum(F.when(F.col("closed_by") == "age", F.col("n"))), F.lit(0)).alias("aged"))
    return found.select("event_id", "_lane").join(sums, "_lane").select("event_id", (F.floor(F.col("n") / 700) == F.col("full")).alias("full"), (F.col("n") % 700 == F.col("aged")).alias("aged"))


def t6_resent(spark, d):
    """Re-sends that wait in the state: the outcomes are those of the batch query."""
    sent = stateful.resent(whole_stream(spark, d, "event_id", "user_id"), "event_id", send, retries=3, delay=lambda attempt: 0.2, lanes=4)
    return emitted(sent, spark, table(spark, d, "events").count(), lanes=4).select("event_id", "status", "attempts", "outcome")


def t10_wait(spark, d):
    """Full-buffer policy wait: a producer adds a file once fewer than two wait; the stream takes one at a time."""
    path, schema = scratch(spark, "handed-over"), "event_id long, user_id long, event_type string"
    events = table(spark, d, "events").select("event_id", "user_id", "event_type")
    readers.handed_over_frame(events.where("event_id % 5 = 0"), path, 2)
    rows = readers.produced(spark, path, schema, stream=True, most_files=1, consume=True)
    with ThreadPoolExecutor(1) as producer:
        sent = producer.submit(lambda: [readers.handed_over_frame(events.where(f"event_id % 5 = {k}"), path, 2, timeout=300) for k in range(1, 5)])
        found = emitted(rows, spark, events.count())
        sent.result()
    return found.drop("_malformed")


OUTCOME = "CASE WHEN event_id % 10 = 4 THEN 'rejected' WHEN event_id % 6 > 3 THEN 'exhausted' ELSE 'accepted' END"


def t7(spark, d):
    users = BucketedTable(spark, scratch(spark, "users"), 16)
    D.drain(D.upsert_stream(stream(spark, d), users, "user_id", "event_id", scratch(spark, "checkpoint")))
    return users.read().select(F.col("_id").alias("user_id"), "_version", "event_type", "value")


def t8(spark, d):
    out = scratch(spark, "appended")
    D.drain(D.append_stream(stream(spark, d), out, scratch(spark, "checkpoint"), ["event_type"]))
    return spark.read.parquet(out).select("event_id", F.col("event_type").cast("string").alias("event_type"))


def t9(spark, d):
    """Drain: every queued event is there once the query has stopped."""
    out = scratch(spark, "drained")
    query = D.append_stream(stream(spark, d, files=7), out, scratch(spark, "checkpoint"))
    D.drain(query)
    return spark.read.parquet(out).select("event_id", "value").withColumn("active", F.lit(query.isActive))


def t10(spark, d):
    kept, dropped = D.overflow(table(spark, d, "events").select("event_id", "event_type"), ["event_id"], 700)
    return kept.withColumn("kept", F.lit(True)).unionByName(dropped.withColumn("kept", F.lit(False))).groupBy("kept", "event_type").agg(F.count("*").alias("n"))


def t12(spark, d):
    a, b = scratch(spark, "first"), scratch(spark, "second")
    D.drain(D.fan_out(stream(spark, d), {a: lambda x: x.select("event_id", F.lit("first").alias("part")), b: lambda x: x.where("value > 10").select("event_id", F.lit("second").alias("part"))}, scratch(spark, "checkpoint")))
    return spark.read.parquet(a).drop("batch").unionByName(spark.read.parquet(b).drop("batch"))


def p13_stream(spark, d):
    """Time-series deduplication on a stream: one event for each user and second."""
    out = scratch(spark, "deduplicated")
    rows = stream(spark, d).withColumn("second", F.date_trunc("second", F.col("ts").cast("timestamp")))
    D.drain(D.append_stream(D.deduplicated(rows, ["user_id", "event_type", "second"], "second", "365 days").select("user_id", "event_type"), out, scratch(spark, "checkpoint")))
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


QUERIES = {
    "T1_count_batches": (t1, "SELECT (rn - 1) // 1000 AS batch, count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn FROM events) GROUP BY 1"),
    "T2_age_batches": (t2, "SELECT event_id, ts, user_id, event_type, value FROM events"),
    "T3_byte_batches": (t3, T3), "T3_byte_batches_by_name": (t3_names, T3),
    "T4_oversize": (lambda s, d: D.oversized(paged(s, d), F.col("bytes"), 10_000).select("doc_id", F.col("bytes").cast("long").alias("bytes")), "SELECT doc_id, strlen(text)::BIGINT AS bytes FROM documents WHERE strlen(text) > 10000"),
    "T6_retry": (t6, f"SELECT {OUTCOME} AS outcome, CASE WHEN event_id % 10 = 4 THEN 400 WHEN event_id % 6 > 3 THEN 429 ELSE 201 END AS status, CASE WHEN event_id % 10 = 4 THEN 1 WHEN event_id % 6 > 3 THEN 4 ELSE event_id % 6 + 1 END AS attempts, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1, 2, 3"),
    "T6_dead_letters": (t6_dead, f"SELECT event_id, {OUTCOME} AS outcome FROM events WHERE {OUTCOME} <> 'accepted'"),
    "T2_flush": (t2_flush, "SELECT event_id, true AS full, true AS aged FROM events"),
    "T6_resent": (t6_resent, f"SELECT event_id, CASE WHEN event_id % 10 = 4 THEN 400 WHEN event_id % 6 > 3 THEN 429 ELSE 201 END AS status, CASE WHEN event_id % 10 = 4 THEN 1 WHEN event_id % 6 > 3 THEN 4 ELSE event_id % 6 + 1 END AS attempts, {OUTCOME} AS outcome FROM events"),
    "T10_wait": (t10_wait, "SELECT event_id, user_id, event_type FROM events"),
    "T7_stream_upsert": (t7, "SELECT user_id, 1::BIGINT AS _version, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1"),
    "T8_stream_append": (t8, "SELECT event_id, event_type FROM events"),
    "T9_drain": (t9, "SELECT event_id, value, false AS active FROM events"),
    "T10_full_buffer": (t10, "SELECT rn <= 700 AS kept, event_type, count(*) AS n FROM (SELECT event_type, row_number() OVER (ORDER BY event_id) AS rn FROM events) GROUP BY 1, 2"),
    "T12_fan_out": (t12, "SELECT event_id, 'first' AS part FROM events UNION ALL SELECT event_id, 'second' FROM events WHERE value > 10"),
    "P13_stream_dedup": (p13_stream, "SELECT event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, date_trunc('second', ts) FROM events) GROUP BY 1"),
}
