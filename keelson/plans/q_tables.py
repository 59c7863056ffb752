"""Queries over maintenance and sync, on orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import maintain as M
from keelson.operators import sync, writes
from keelson.plans.q_writes import CTE, COLUMNS, incoming, table, target
from keelson.sources import tables

OLD, NOW = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def source(spark, d):
    return table(spark, d, "orders").where("o_orderkey % 10 >= 3").select(F.col("o_orderkey").alias("_id"), *COLUMNS)


def dest(spark, d):
    return target(spark, d).drop("hash")


def p1(spark, d):
    out = M.reindex(source(spark, d), dest(spark, d), where=F.col("o_orderstatus") == "F", transform=lambda x: x.withColumn("o_totalprice", F.col("o_totalprice") * 2), exclude=["o_orderpriority"])
    return out.select("_id", "_version", "o_custkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"), "o_orderpriority", "result")


P1 = f"""
WITH s AS (SELECT o_orderkey AS _id, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, NULL AS o_orderpriority FROM orders WHERE o_orderkey % 10 >= 3 AND o_orderstatus = 'F'), t AS (SELECT *, o_orderkey AS _id FROM orders WHERE o_orderkey % 10 < 8)
SELECT coalesce(t._id, s._id) AS _id, CASE WHEN s._id IS NULL OR t._id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version, {", ".join(f"{'round(' if c == 'o_totalprice' else ''}CASE WHEN s._id IS NULL THEN t.{c} ELSE s.{c} END{', 2)' if c == 'o_totalprice' else ''} AS {c}" for c in COLUMNS if c != "o_orderdate")},
  CASE WHEN s._id IS NULL THEN 'untouched' WHEN t._id IS NULL THEN 'created' ELSE 'updated' END AS result FROM t FULL OUTER JOIN s ON t._id = s._id
"""


def p2(spark, d):
    op = F.when(F.col("o_orderstatus") == "F", "index").when(F.col("o_orderstatus") == "O", "delete").otherwise("noop")
    return M.reindex_script(source(spark, d), dest(spark, d), lambda x: x.withColumn("_op", op))


P2 = f"""
WITH s AS (SELECT *, o_orderkey AS _id FROM orders WHERE o_orderkey % 10 >= 3), i AS (SELECT * FROM s WHERE o_orderstatus = 'F'),
t AS (SELECT *, o_orderkey AS _id FROM orders WHERE o_orderkey % 10 < 8 AND o_orderkey NOT IN (SELECT _id FROM s WHERE o_orderstatus = 'O'))
SELECT coalesce(t._id, i._id) AS _id, CASE WHEN i._id IS NULL OR t._id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version, {", ".join(f"coalesce(i.{c}, t.{c}) AS {c}" for c in COLUMNS)},
  CASE WHEN i._id IS NULL THEN 'untouched' WHEN t._id IS NULL THEN 'created' ELSE 'updated' END AS result FROM t FULL OUTER JOIN i ON t._id = i._id
"""


def p3(spark, d):
    made, conflicts = M.copy_create(source(spark, d), dest(spark, d), proceed=True)
    return made.select("_id", *COLUMNS, F.lit("table").alias("part")).unionByName(conflicts.select("_id", *COLUMNS, F.lit("conflict").alias("part")))


def double_price(pdf):
    pdf["o_totalprice"] = pdf["o_totalprice"] * 2
    return pdf


def p4(spark, d):
    return M.client_reindex(source(spark, d), dest(spark, d), double_price)


def p5(spark, d):
    left, count = M.delete_by_query(dest(spark, d), F.col("o_totalprice") < 100000)
    return left.select("_id", "_version", *COLUMNS).crossJoin(F.broadcast(count))


def p6(spark, d):
    return M.update_by_query(dest(spark, d), F.col("o_orderstatus") == "F", {"o_totalprice": F.col("o_totalprice") * 2, "o_orderpriority": F.lit("done")})


def relabelled(rows):
    """A row transform: the status spelled out, and rows of small customers left behind."""
    return rows.where("o_custkey > 20").withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "F", "finished").when(F.col("o_orderstatus") == "O", "open").otherwise("partly"))


def d1(spark, d):
    """Row transform: a copy through the caller's function on the frame."""
    return M.reindex(source(spark, d), dest(spark, d), transform=relabelled)


D1 = f"""
WITH s AS (SELECT o_orderkey AS _id, * REPLACE (CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'partly' END AS o_orderstatus) FROM orders WHERE o_orderkey % 10 >= 3 AND o_custkey > 20), t AS (SELECT *, o_orderkey AS _id FROM orders WHERE o_orderkey % 10 < 8)
SELECT coalesce(t._id, s._id) AS _id, CASE WHEN s._id IS NULL OR t._id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version, {", ".join(f"coalesce(s.{c}, t.{c}) AS {c}" for c in COLUMNS)},
  CASE WHEN s._id IS NULL THEN 'untouched' WHEN t._id IS NULL THEN 'created' ELSE 'updated' END AS result FROM t FULL OUTER JOIN s ON t._id = s._id
"""

def decisions(spark, d):
    """One mapping for each nation: declared from nations, stored from customers' nations; versions by region."""
    n = table(spark, d, "nation")
    declared = n.select(F.col("n_name").alias("name"), F.concat(F.lit("h"), F.col("n_nationkey") % 7).alias("hash"), F.concat(F.lit("1."), F.col("n_nationkey") % 5, F.lit(".0")).alias("version"))
    stored = n.where("n_nationkey % 6 <> 0").select(F.col("n_name").alias("name"), F.concat(F.lit("h"), F.col("n_nationkey") % 3).alias("hash"), F.concat(F.lit("1."), F.col("n_nationkey") % 4, F.lit(".0")).alias("version"))
    return M.rebuild_decision(declared, stored)


def p7(spark, d):
    return decisions(spark, d)


P7 = """
SELECT d.n_name AS name, CASE WHEN why IN ('newer', 'same hash') THEN 'keep' ELSE 'rebuild' END AS decision, why, local_hash, remote_hash FROM (
  SELECT *, 'h' || n_nationkey % 7 AS local_hash, CASE WHEN n_nationkey % 6 <> 0 THEN 'h' || n_nationkey % 3 END AS remote_hash,
    CASE WHEN n_nationkey % 6 = 0 THEN 'missing' WHEN n_nationkey % 4 > n_nationkey % 5 THEN 'newer' WHEN n_nationkey % 7 = n_nationkey % 3 THEN 'same hash' ELSE 'changed' END AS why FROM nation) d
"""


def s2(spark, d):
    pairs = table(spark, d, "nation").select(F.concat(F.lit("pair-"), F.col("n_nationkey")).alias("label"), F.col("n_name").alias("primary"), F.concat(F.lit("NATION_"), (F.col("n_nationkey") + 1) % 25).alias("secondary"))
    return sync.choose_strategy(decisions(spark, d), pairs)


S2 = f"""
WITH p7 AS ({P7})
SELECT 'pair-' || n_nationkey AS label, CASE WHEN decision = 'keep' THEN 'reindex' ELSE 'multiplex' END AS strategy, local_hash, remote_hash, decision <> 'keep' AS rolled_over
FROM nation JOIN p7 ON name = 'NATION_' || (n_nationkey + 1) % 25
"""


def p9(spark, d):
    """Publish: the first 10 days of events as snapshots, two aliases swapped twice."""
    names = table(spark, d, "events").select(F.concat(F.lit("ev-"), F.date_format("ts", "yyyy.MM.dd")).alias("index")).distinct()
    current = names.select(F.lit("ev-latest").alias("alias"), "index").unionByName(names.select(F.lit("other").alias("alias"), "index"))
    return tables.publish(current, ["ev-latest", "search"], "ev-2024.01.31", "ev-%")


P9 = "SELECT DISTINCT 'other' AS alias, 'ev-' || strftime(ts, '%Y.%m.%d') AS index FROM events UNION ALL VALUES ('ev-latest', 'ev-2024.01.31'), ('search', 'ev-2024.01.31')"


def p10(spark, d):
    return M.rollover(table(spark, d, "events"), "event_type", "ts", F.octet_length("props"), "2024-02-01 00:00:00", max_docs=2100, max_bytes=10**9).select("event_type", "docs", "bytes", "roll")


def p13(spark, d):
    e = table(spark, d, "events").withColumn("hour", F.date_trunc("hour", "ts"))
    out = M.deduplicate_points(e, ["user_id", "event_type"], "hour", [F.col("event_id")])
    return out.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def p14(spark, d):
    out = M.downsample(table(spark, d, "events"), ["event_type"], "ts", "value", "6 hours")
    return out.select("event_type", F.date_format("start", "yyyy-MM-dd HH").alias("start"), "min", "max", F.round("sum", 2).alias("sum"), "count")


# ---- sync ------------------------------------------------------------------------------------------------------------


def primary(spark, d):
    ts = F.lit(OLD).cast("timestamp")
    return target(spark, d).withColumn("batch_date", ts).withColumn("last_updated", ts)


def secondary(spark, d):
    """Half of the primary, with a column of its own."""
    return primary(spark, d).where("_id % 10 < 6").withColumn("summary", F.concat(F.lit("s"), F.col("_id")))


COLS = "_id, p AS price, k AS o_custkey, st AS o_orderstatus, pr AS o_orderpriority, b = 1 AS new_batch, u = 1 AS new_update, v::BIGINT AS _version"


def digest(df, name):
    """Every row: its content, and which dates are of this run."""
    now = F.lit(NOW).cast("timestamp")
    return df.select("_id", F.col("o_totalprice").alias("price"), "o_custkey", "o_orderstatus", "o_orderpriority", (F.col("batch_date") == now).alias("new_batch"), (F.col("last_updated") == now).alias("new_update"), "_version", F.lit(name).alias("part"))


#: One row a primary id after the conditional write: p price, b batch is new, u row was replaced, v version; c the same as a copied row.
SYNC = f"""
WITH {CTE},
w AS (SELECT coalesce(t._id, l._id) AS _id, CASE WHEN l._id IS NULL OR t.hash = l.hash THEN t.o_totalprice ELSE l.o_totalprice END AS p, CASE WHEN l._id IS NULL OR t.hash = l.hash THEN t.o_custkey ELSE l.o_custkey END AS k, coalesce(l.o_orderstatus, t.o_orderstatus) AS st, coalesce(l.o_orderpriority, t.o_orderpriority) AS pr, (l._id IS NOT NULL)::INT AS b,
        (l._id IS NOT NULL AND coalesce(t.hash <> l.hash, true))::INT AS u, CASE WHEN t._id IS NOT NULL AND l._id IS NOT NULL THEN 2 ELSE 1 END AS v FROM t FULL OUTER JOIN l ON t._id = l._id),
z AS (SELECT _id, o_totalprice AS p, o_custkey AS k, o_orderstatus AS st, o_orderpriority AS pr, 0 AS b, 0 AS u, 1 AS v FROM t WHERE _id % 10 < 6),
c AS (SELECT coalesce(z._id, x._id) AS _id, coalesce(x.p, z.p) AS p, coalesce(x.k, z.k) AS k, coalesce(x.st, z.st) AS st, coalesce(x.pr, z.pr) AS pr, coalesce(x.b, 0) AS b, coalesce(x.u, 0) AS u, CASE WHEN x._id IS NULL OR z._id IS NULL THEN 1 ELSE 2 END AS v FROM z FULL OUTER JOIN (SELECT * FROM w WHERE u = 1) x ON z._id = x._id)
"""


def both(r):
    return digest(r.primary, "primary").unionByName(digest(r.secondary, "secondary"))


def s8(spark, d):
    return both(sync.incremental_sync(primary(spark, d), secondary(spark, d), incoming(spark, d), NOW))


S8 = f"{SYNC} SELECT 'primary' AS part, {COLS} FROM w WHERE b = 1 UNION ALL SELECT 'secondary', {COLS} FROM c WHERE _id NOT IN (SELECT _id FROM w WHERE b = 0)"


def s9(spark, d):
    return both(sync.delta_sync(primary(spark, d), secondary(spark, d), incoming(spark, d), NOW))


S9 = f"{SYNC} SELECT 'primary' AS part, {COLS} FROM w UNION ALL SELECT 'secondary', {COLS} FROM c"


def s7(spark, d):
    return both(sync.incremental_sync(primary(spark, d), secondary(spark, d), incoming(spark, d), NOW, strategy="multiplex"))


S7 = f"""{SYNC},
m AS (SELECT l._id, l.o_totalprice AS p, l.o_custkey AS k, l.o_orderstatus AS st, l.o_orderpriority AS pr, 1 AS b, 1 AS u, CASE WHEN t._id IS NULL THEN 1 ELSE 2 END AS v FROM l LEFT JOIN t ON t._id = l._id),
y AS (SELECT coalesce(z._id, l._id) AS _id, coalesce(l.o_totalprice, z.p) AS p, coalesce(l.o_custkey, z.k) AS k, coalesce(l.o_orderstatus, z.st) AS st, coalesce(l.o_orderpriority, z.pr) AS pr, (l._id IS NOT NULL)::INT AS b, (l._id IS NOT NULL)::INT AS u, CASE WHEN z._id IS NOT NULL AND l._id IS NOT NULL THEN 2 ELSE 1 END AS v FROM z FULL OUTER JOIN l ON z._id = l._id)
SELECT 'primary' AS part, {COLS} FROM m UNION ALL SELECT 'secondary', {COLS} FROM y"""


def s10(spark, d):
    old = primary(spark, d)
    new = sync.stamp(writes.last_per_id(incoming(spark, d)), NOW).withColumn("_version", F.lit(1).cast("long")).withColumn("tags", F.lit("v2")).select(*old.columns, "tags")
    return sync.backfill(old, new).select("_id", "_version", *COLUMNS, F.date_format("batch_date", "yyyy-MM-dd").alias("batch"), F.coalesce("tags", F.lit("old")).alias("tags"))


S10 = f"WITH {CTE} SELECT _id, 1::BIGINT AS _version, {', '.join(COLUMNS)}, '2024-02-01' AS batch, 'v2' AS tags FROM l UNION ALL SELECT _id, 1, {', '.join(COLUMNS)}, '2024-01-01', 'old' FROM t WHERE _id NOT IN (SELECT _id FROM l)"


def stamped(spark, d):
    out = sync.conditional_write(primary(spark, d), sync.stamp(incoming(spark, d), NOW))
    now = F.lit(NOW).cast("timestamp")
    return out.select("_id", "_version", *COLUMNS, (F.col("batch_date") == now).alias("batch"), (F.col("last_updated") == now).alias("updated"), "result")


S3 = f"""WITH {CTE} SELECT coalesce(t._id, l._id) AS _id, CASE WHEN t._id IS NULL OR l._id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version, {", ".join(f"CASE WHEN l._id IS NULL OR t.hash = l.hash THEN t.{c} ELSE l.{c} END AS {c}" for c in COLUMNS)},
  l._id IS NOT NULL AS batch, l._id IS NOT NULL AND coalesce(t.hash <> l.hash, true) AS updated, CASE WHEN l._id IS NULL THEN 'untouched' WHEN t._id IS NULL THEN 'created' ELSE 'updated' END AS result FROM t FULL OUTER JOIN l ON t._id = l._id"""


def s4(spark, d):
    table_ = sync.conditional_write(primary(spark, d), sync.stamp(incoming(spark, d), NOW)).drop("result")
    return sync.updates_since(table_, secondary(spark, d)).select("_id", "o_totalprice")


def s5(spark, d):
    table_ = sync.conditional_write(primary(spark, d), sync.stamp(incoming(spark, d), NOW)).drop("result")
    return writes.delete_ids(secondary(spark, d), table_.where(sync.stale(table_, NOW))).select("_id", "summary")


def s6(spark, d):
    table_ = sync.conditional_write(primary(spark, d), sync.stamp(incoming(spark, d), NOW)).drop("result")
    left, count = M.delete_by_query(table_, sync.stale(table_, NOW))
    return left.select("_id", "o_totalprice").crossJoin(F.broadcast(count))


QUERIES = {
    "P1_reindex": (p1, P1), "P2_reindex_script": (p2, P2),
    "P3_conflict_policy": (p3, f"SELECT 'table' AS part, o_orderkey AS _id, {', '.join(COLUMNS)} FROM orders UNION ALL SELECT 'conflict', o_orderkey, {', '.join(COLUMNS)} FROM orders WHERE o_orderkey % 10 BETWEEN 3 AND 7"),
    "P4_client_reindex": (p4, f"SELECT o_orderkey AS _id, CASE WHEN o_orderkey % 10 BETWEEN 3 AND 7 THEN 2 ELSE 1 END::BIGINT AS _version, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 10 < 3 THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice, o_orderdate, o_orderpriority, CASE WHEN o_orderkey % 10 < 3 THEN 'untouched' WHEN o_orderkey % 10 >= 8 THEN 'created' ELSE 'updated' END AS result FROM orders"),
    "D1_row_transform": (d1, D1),
    "P5_delete_by_query": (p5, f"SELECT * FROM (SELECT o_orderkey AS _id, 1::BIGINT AS _version, {', '.join(COLUMNS)}, count(*) OVER () AS total, count(CASE WHEN o_totalprice < 100000 THEN 1 END) OVER () AS deleted FROM orders WHERE o_orderkey % 10 < 8) WHERE o_totalprice >= 100000"),
    "P6_update_by_query": (p6, "SELECT o_orderkey AS _id, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END::BIGINT AS _version, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 2 * o_totalprice ELSE o_totalprice END AS o_totalprice, o_orderdate, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 10 < 8"),
    "P7_rebuild_decision": (p7, P7), "P9_publish": (p9, P9),
    "P10_rollover": (p10, "SELECT event_type, count(*) AS docs, sum(strlen(props))::BIGINT AS bytes, count(*) >= 2100 OR sum(strlen(props)) >= 1000000000 AS roll FROM events GROUP BY 1"),
    "P11_retention": (lambda s, d: M.retain(table(s, d, "events"), "ts", "2024-02-01 00:00:00", "7 days").select("event_id", "event_type"), "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-25'"),
    "P13_point_dedup": (p13, "SELECT event_type, count(*) AS n, sum(id)::BIGINT AS ids FROM (SELECT event_type, min(event_id) AS id FROM events GROUP BY user_id, event_type, date_trunc('hour', ts)) GROUP BY 1"),
    "P14_downsample": (p14, "SELECT event_type, strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H') AS start, min(value) AS min, max(value) AS max, round(sum(value), 2) AS sum, count(value) AS count FROM events GROUP BY event_type, time_bucket(INTERVAL 6 HOUR, ts)"),
    "S1_stamp": (lambda s, d: sync.stamp(source(s, d), NOW).select("_id", *COLUMNS, F.date_format("batch_date", "yyyy-MM-dd").alias("batch"), (F.col("batch_date") == F.col("last_updated")).alias("same")), f"SELECT o_orderkey AS _id, {', '.join(COLUMNS)}, '2024-02-01' AS batch, true AS same FROM orders WHERE o_orderkey % 10 >= 3"),
    "S2_strategy": (s2, S2), "S3_conditional_write": (stamped, S3),
    "S4_propagate_updates": (s4, f"{SYNC} SELECT _id, p AS o_totalprice FROM w WHERE u = 1"),
    "S5_propagate_deletes": (s5, f"{SYNC} SELECT _id, 's' || _id AS summary FROM z WHERE _id NOT IN (SELECT _id FROM w WHERE b = 0)"),
    "J5_delete_propagation": (s5, f"{SYNC} SELECT _id, 's' || _id AS summary FROM z WHERE _id NOT IN (SELECT _id FROM w WHERE b = 0)"),
    "S6_stale_cleanup": (s6, f"{SYNC} SELECT _id, o_totalprice, total, deleted FROM (SELECT _id, b, p AS o_totalprice, count(*) OVER () AS total, count(CASE WHEN b = 0 THEN 1 END) OVER () AS deleted FROM w) WHERE b = 1"),
    "S7_multiplex": (s7, S7), "S8_incremental": (s8, S8), "S9_delta": (s9, S9), "S10_backfill": (s10, S10),
    "G1_max_batch_date": (lambda s, d: sync.max_batch_date(table(s, d, "events"), "ts").select(F.date_format("cutoff", "yyyy-MM-dd HH:mm:ss").alias("cutoff")), "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS cutoff FROM events"),
    "G4_max_version": (lambda s, d: writes.index_write(target(s, d), incoming(s, d)).agg(F.max("_version").alias("version")), "SELECT 2::BIGINT AS version FROM orders LIMIT 1"),
    "G5_counters": (lambda s, d: M.counters(writes.hash_upsert(target(s, d), incoming(s, d), "hash").where("result <> 'untouched'")).withColumn("fraction", F.round("fraction", 4)), f"WITH {CTE}, j AS (SELECT CASE WHEN t._id IS NULL THEN 'created' WHEN t.hash = l.hash THEN 'noop' ELSE 'updated' END AS r FROM l LEFT JOIN t ON t._id = l._id) SELECT count(CASE r WHEN 'created' THEN 1 END) AS created, count(CASE r WHEN 'updated' THEN 1 END) AS updated, 0::BIGINT AS deleted, count(CASE r WHEN 'noop' THEN 1 END) AS noops, 0::BIGINT AS conflicts, count(*) AS total, round(count(CASE WHEN r <> 'noop' THEN 1 END) / count(*), 4) AS fraction FROM j"),
}
