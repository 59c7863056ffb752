"""Queries over keyed writes: orders as target and incoming batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators import writes
from keelson.sources import export, tables

COLUMNS = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
HASHED = ("o_custkey", "o_orderstatus", "o_orderpriority")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def content_hash(*columns: str):
    """First 16 hex digits of SHA-256 over the joined parts, nulls as nothing."""
    return F.substring(F.sha2(F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256), 1, 16)


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with key % 10 < 8, at version 1."""
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 10 < 8")
    return rows.select(F.col("o_orderkey").alias("_id"), F.lit(1).cast("long").alias("_version"), *COLUMNS).withColumn("hash", content_hash(*HASHED))


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with key % 10 >= 3; even keys cost 1 more and have another customer.  Every seventh key is sent twice."""
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 10 >= 3")
    rows = rows.withColumn("even", F.col("o_orderkey") % 2 == 0)
    rows = rows.withColumn("o_totalprice", F.when(F.col("even"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    rows = rows.withColumn("o_custkey", F.when(F.col("even"), F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    times = F.when(F.col("o_orderkey") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.withColumn("seq", F.explode(times)).withColumn("o_totalprice", F.col("o_totalprice") + 10 * (F.col("seq") - 1))
    return rows.select(F.col("o_orderkey").alias("_id"), "seq", *COLUMNS).withColumn("hash", content_hash(*HASHED))


#: DuckDB twins of target and incoming, as common table expressions t, s (all sent rows), l (last of each id).
CTE = """
t AS (SELECT o_orderkey AS _id, 1::BIGINT AS _version, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
        substring(sha256(concat(coalesce(o_custkey::VARCHAR,''), coalesce(o_orderstatus,''), coalesce(o_orderpriority,''))), 1, 16) AS hash
      FROM orders WHERE o_orderkey % 10 < 8),
s0 AS (SELECT o_orderkey AS _id, q.seq, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_orderstatus,
        CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END + 10 * (q.seq - 1) AS o_totalprice, o_orderdate, o_orderpriority
      FROM orders, (VALUES (1), (2)) q(seq) WHERE o_orderkey % 10 >= 3 AND (q.seq = 1 OR o_orderkey % 7 = 0)),
s AS (SELECT *, substring(sha256(concat(coalesce(o_custkey::VARCHAR,''), coalesce(o_orderstatus,''), coalesce(o_orderpriority,''))), 1, 16) AS hash FROM s0),
l AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY seq DESC) AS rn FROM s) WHERE rn = 1),
f AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY seq) AS rn FROM s) WHERE rn = 1)
"""


def w5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash-conditional upsert: the whole table after it, with each row's outcome."""
    return writes.hash_upsert(target(spark, sf_dir), incoming(spark, sf_dir), "hash")


def hashed_sql(price: str, matched: str) -> str:
    """The whole table after a hash-conditional upsert; `price` and `matched` are the price and outcome of an equal hash."""
    columns = [f"CASE WHEN l._id IS NULL THEN t.{c} WHEN t.hash = l.hash THEN {price if c == 'o_totalprice' else f't.{c}'} ELSE l.{c} END AS {c}" for c in (*COLUMNS, "hash")]
    result = f"CASE WHEN l._id IS NULL THEN 'untouched' WHEN t._id IS NULL THEN 'created' WHEN t.hash = l.hash THEN '{matched}' ELSE 'updated' END"
    return f"WITH {CTE} SELECT coalesce(t._id, l._id) AS _id, {', '.join(columns)}, {result} AS result, CASE WHEN {result} = 'updated' THEN 2 ELSE 1 END::BIGINT AS _version FROM t FULL OUTER JOIN l ON t._id = l._id"


W5 = hashed_sql("t.o_totalprice", "noop")


DOCS = ", ".join(COLUMNS)


def summary(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("price"))


def w1(spark, sf_dir):
    """Index write: the whole table after it."""
    return writes.index_write(target(spark, sf_dir), incoming(spark, sf_dir)).drop("hash")


W1 = f"""
WITH {CTE}
SELECT coalesce(t._id, l._id) AS _id, CASE WHEN t._id IS NULL THEN 1 WHEN l._id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version,
  {", ".join(f"CASE WHEN l._id IS NULL THEN t.{c} ELSE l.{c} END AS {c}" for c in COLUMNS)},
  CASE WHEN l._id IS NULL THEN 'untouched' WHEN t._id IS NULL THEN 'created' ELSE 'updated' END AS result
FROM t FULL OUTER JOIN l ON t._id = l._id
"""


def w2(spark, sf_dir):
    """Create write: every row of the table and every conflict."""
    made, conflicts = writes.create_write(target(spark, sf_dir), incoming(spark, sf_dir))
    return made.select("_id", *COLUMNS, F.lit("table").alias("part")).unionByName(conflicts.select("_id", *COLUMNS, F.lit("conflict").alias("part")))


W2 = f"""
WITH {CTE}, fresh AS (SELECT * FROM f WHERE _id NOT IN (SELECT _id FROM t))
SELECT 'table' AS part, _id, {DOCS} FROM t UNION ALL SELECT 'table', _id, {DOCS} FROM fresh
UNION ALL SELECT 'conflict', _id, {DOCS} FROM s WHERE NOT EXISTS (SELECT 1 FROM fresh WHERE fresh._id = s._id AND fresh.seq = s.seq)
"""


def w3(spark, sf_dir):
    """Auto write: every fifth row has no id and is created under a generated one."""
    t = target(spark, sf_dir).withColumn("_id", F.col("_id").cast("string"))
    s = incoming(spark, sf_dir).withColumn("_id", F.when(F.col("_id") % 5 == 4, F.lit("  ")).otherwise(F.col("_id").cast("string")))
    return writes.auto_write(t, s).select(F.when(F.length("_id") == 64, "generated").otherwise(F.col("_id")).alias("_id"), "_version", *COLUMNS, "result")


W3 = f"""
WITH {CTE}, g AS (SELECT * FROM s WHERE _id % 5 = 4), k AS (SELECT * FROM l WHERE _id % 5 <> 4)
SELECT coalesce(t._id, k._id)::VARCHAR AS _id, CASE WHEN k._id IS NULL OR t._id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version, {", ".join(f"CASE WHEN k._id IS NULL THEN t.{c} ELSE k.{c} END AS {c}" for c in COLUMNS)},
  CASE WHEN k._id IS NULL THEN 'untouched' WHEN t._id IS NULL THEN 'created' ELSE 'updated' END AS result FROM t FULL OUTER JOIN k ON t._id = k._id
UNION ALL SELECT 'generated', 1, {DOCS}, 'created' FROM g
"""


def sparse(spark, sf_dir):
    """The batch with holes: priority null for odd keys, status null for every third key, and the fields it means to send."""
    s = incoming(spark, sf_dir).drop("hash")
    s = s.withColumn("o_orderpriority", F.when(F.col("_id") % 2 == 0, F.col("o_orderpriority"))).withColumn("o_orderstatus", F.when(F.col("_id") % 3 != 0, F.col("o_orderstatus")))
    return s.withColumn("_fields", F.when(F.col("_id") % 4 == 1, F.array(F.lit("o_orderpriority"), F.lit("o_totalprice"))).otherwise(F.array(*[F.lit(c) for c in COLUMNS])))


SPARSE = """h AS (SELECT _id, o_custkey, CASE WHEN _id % 3 <> 0 THEN o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN _id % 2 = 0 THEN o_orderpriority END AS o_orderpriority FROM l)"""


def w4(spark, sf_dir):
    """Partial update by non-null fields."""
    return writes.partial_update(target(spark, sf_dir).drop("hash"), sparse(spark, sf_dir))


W4 = f"""
WITH {CTE}, {SPARSE}
SELECT coalesce(t._id, h._id) AS _id, CASE WHEN t._id IS NULL OR h._id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version,
  {", ".join(f"coalesce(h.{c}, t.{c}) AS {c}" for c in COLUMNS)},
  CASE WHEN h._id IS NULL THEN 'untouched' WHEN t._id IS NULL THEN 'created' ELSE 'updated' END AS result
FROM t FULL OUTER JOIN h ON t._id = h._id
"""


def w4_mask(spark, sf_dir):
    """Partial update by a presence mask: a null that was sent overwrites."""
    out = writes.partial_update(target(spark, sf_dir).drop("hash"), sparse(spark, sf_dir), fields="_fields")
    return out.withColumn("o_custkey", F.coalesce("o_custkey", F.lit(-1)))


W4_MASK = f"""
WITH {CTE}, {SPARSE}
SELECT coalesce(t._id, h._id) AS _id, CASE WHEN t._id IS NULL OR h._id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version,
  {", ".join(f"CASE WHEN h._id IS NOT NULL AND {'true' if c in ('o_orderpriority', 'o_totalprice') else 'h._id % 4 <> 1'} THEN h.{c} ELSE t.{c} END AS {c}" for c in COLUMNS).replace("CASE WHEN h._id IS NOT NULL AND h._id % 4 <> 1 THEN h.o_custkey ELSE t.o_custkey END", "coalesce(CASE WHEN h._id IS NOT NULL AND h._id % 4 <> 1 THEN h.o_custkey ELSE t.o_custkey END, -1)")},
  CASE WHEN h._id IS NULL THEN 'untouched' WHEN t._id IS NULL THEN 'created' ELSE 'updated' END AS result
FROM t FULL OUTER JOIN h ON t._id = h._id
"""


def w6(spark, sf_dir):
    """Hash match applies a small change: the price is stamped 0 and the version rises."""
    return writes.hash_upsert(target(spark, sf_dir), incoming(spark, sf_dir), "hash", on_match={"o_totalprice": F.lit(0.0)})


W6 = hashed_sql("0.0", "updated")


def w7(spark, sf_dir):
    """Delete actions: what is left of the target."""
    return writes.delete_ids(target(spark, sf_dir), incoming(spark, sf_dir)).select("_id", "o_totalprice")


W7 = f"WITH {CTE} SELECT _id, o_totalprice FROM t WHERE _id NOT IN (SELECT _id FROM s)"


def action_log(spark, sf_dir):
    """lineitem as a log on orders: one action a line, in line order."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("quantity"), F.max("l_shipdate").alias("l_shipdate"))
    action = F.element_at(F.array(F.lit("index"), F.lit("create"), F.lit("update"), F.lit("delete")), (F.col("l_linenumber") % 4 + 1).cast("int"))
    value = F.when(action != "delete", F.col("quantity"))
    note = F.when(F.col("l_linenumber") % 3 != 0, F.concat(action, F.lit("-"), F.col("l_linenumber")))
    return rows.select(F.col("l_orderkey").alias("_id"), F.col("l_linenumber").alias("seq"), action.alias("action"), value.alias("quantity"), note.alias("note"))


def w8(spark, sf_dir):
    """Mixed action log on a table of every second order."""
    t = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("_id"), F.lit(5).cast("long").alias("_version"), F.lit(-1.0).alias("quantity"), F.lit("old").alias("note"))
    return writes.apply_log(t, action_log(spark, sf_dir))


W8 = """
WITH RECURSIVE lg AS (SELECT l_orderkey AS _id, l_linenumber AS seq, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS k,
    ['index', 'create', 'update', 'delete'][l_linenumber % 4 + 1] AS action, max(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey, l_linenumber),
a AS (SELECT _id, k, action, CASE WHEN action <> 'delete' THEN quantity END AS quantity, CASE WHEN seq % 3 <> 0 THEN action || '-' || seq END AS note FROM lg),
st AS (
  SELECT i._id, 0::BIGINT AS k, o.o_orderkey IS NOT NULL AS live, CASE WHEN o.o_orderkey IS NOT NULL THEN 5 ELSE 0 END::BIGINT AS v,
    CASE WHEN o.o_orderkey IS NOT NULL THEN -1.0 END::DOUBLE AS quantity, CASE WHEN o.o_orderkey IS NOT NULL THEN 'old' END AS note
  FROM (SELECT _id FROM a UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0) i LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 2 = 0) o ON i._id = o.o_orderkey
  UNION ALL
  SELECT st._id, a.k,
    CASE WHEN a.action = 'delete' THEN false ELSE true END,
    CASE WHEN a.action = 'delete' THEN 0 WHEN a.action = 'create' AND st.live THEN st.v ELSE st.v + 1 END,
    CASE WHEN a.action = 'delete' THEN NULL WHEN a.action = 'create' AND st.live THEN st.quantity WHEN a.action = 'update' THEN coalesce(a.quantity, st.quantity) ELSE a.quantity END,
    CASE WHEN a.action = 'delete' THEN NULL WHEN a.action = 'create' AND st.live THEN st.note WHEN a.action = 'update' THEN coalesce(a.note, st.note) ELSE a.note END
  FROM st JOIN a ON a._id = st._id AND a.k = st.k + 1)
SELECT _id, v AS _version, quantity, note FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY k DESC) AS rn FROM st) WHERE rn = 1 AND live
"""


def w9(spark, sf_dir):
    """Append write: events added to a stream table partitioned by day, then read back by partition."""
    rows = tables.append(table(spark, sf_dir, "events"), tables.scratch(spark, "events-stream"), "ts")
    return rows.groupBy("day").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


W9 = "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY 1"


def w10(spark, sf_dir):
    """Fixed-target append: every type of event goes to the table logs."""
    rows = tables.append(table(spark, sf_dir, "events"), tables.scratch(spark, "logs"), "ts")
    return rows.groupBy(F.lit("logs").alias("_index"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))


W10 = "SELECT 'logs' AS _index, event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY event_type"


def w11(spark, sf_dir):
    """Time-routed write, 36 hours ahead."""
    return writes.routed(table(spark, sf_dir, "events"), "Metrics-", "ts", "yyyy.MM.dd", 129600).groupBy("_index").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))


W11 = "SELECT 'metrics-' || strftime(ts + INTERVAL 36 HOUR, '%Y.%m.%d') AS _index, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY 1"


def w12(spark, sf_dir):
    """Direct write in create mode: the outcome of every document."""
    _, outcomes = writes.with_outcomes(target(spark, sf_dir), incoming(spark, sf_dir), "create")
    ok = writes.all_persisted(outcomes)
    return outcomes.crossJoin(F.broadcast(ok))


W12 = f"""
WITH {CTE}, o AS (SELECT s._id, s.seq, CASE WHEN s.seq = f.seq AND t._id IS NULL THEN 201 ELSE 409 END AS status FROM s JOIN f ON s._id = f._id LEFT JOIN t ON s._id = t._id)
SELECT _id, seq, status, CASE WHEN status = 409 THEN 'version_conflict_engine_exception' END AS error_type, (SELECT bool_and(status BETWEEN 200 AND 299) FROM o) AS all_persisted FROM o
"""


def w13(spark, sf_dir):
    """Action-log export of the whole documents: header and body lines."""
    docs = table(spark, sf_dir, "documents")
    action = F.element_at(F.array(F.lit("index"), F.lit("create"), F.lit("update"), F.lit("delete")), (F.col("doc_id") % 4 + 1).cast("int"))
    body = F.to_json(F.struct("lang", "source", "n_chars", "text"))
    return export.action_lines(docs, action, F.lit("docs"), F.col("doc_id").cast("string"), body, ["doc_id"]).withColumn("line_no", F.col("line_no").cast("long"))


W13 = """
WITH r AS (SELECT doc_id, ['index', 'create', 'update', 'delete'][doc_id % 4 + 1] AS action, '{"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || ',"text":' || to_json(text)::VARCHAR || '}' AS body FROM documents)
SELECT doc_id, 0::BIGINT AS line_no, '{"' || action || '":{"_index":"docs","_id":"' || doc_id || '"}}' AS line FROM r
UNION ALL SELECT doc_id, 1, CASE WHEN action = 'update' THEN '{"doc":' || body || ',"doc_as_upsert":true}' ELSE body END FROM r WHERE action <> 'delete'
"""


def w14(spark, sf_dir):
    """Export with the caller's own body: a delimited line."""
    orders = table(spark, sf_dir, "orders")
    body = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    out = export.action_lines(orders, F.lit("create"), None, F.col("o_orderkey").cast("string"), body, ["o_orderkey"])
    return out.where("line_no = 1").select("o_orderkey", "line", F.octet_length("line").cast("long").alias("bytes"))


W14 = "SELECT o_orderkey, concat_ws('|', o_orderkey, o_orderstatus, o_orderpriority) AS line, strlen(concat_ws('|', o_orderkey, o_orderstatus, o_orderpriority))::BIGINT AS bytes FROM orders"


def w15(spark, sf_dir):
    """Trace intake lines of orders as transactions, with the metadata line of a file."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.lower("o_orderstatus").alias("type"), F.col("o_custkey").alias("trace"))
    lines = export.trace_lines(orders, "transaction", ["id", "type", "trace"], ["id"])
    first = spark.range(1).select(F.lit("").alias("id"), export.metadata_line("my/service*1", "keelson").alias("line"))
    return first.unionByName(lines)


W15 = """
SELECT '' AS id, '{"metadata":{"service":{"name":"my_service_1","agent":{"name":"keelson"}}}}' AS line
UNION ALL SELECT o_orderkey::VARCHAR, '{"transaction":{"id":"' || o_orderkey || '","type":"' || lower(o_orderstatus) || '","trace":' || o_custkey || '}}' FROM orders
"""


def w16(spark, sf_dir):
    """Multiplex: one batch as rows of a primary and of a secondary schema."""
    first, second = writes.multiplex(incoming(spark, sf_dir), [F.col("_id"), F.col("o_totalprice"), F.lit("primary").alias("target")], [F.col("_id"), F.floor(F.col("o_totalprice")).cast("double").alias("o_totalprice"), F.lit("secondary").alias("target")])
    return first.unionByName(second)


W16 = f"""
WITH {CTE}
SELECT _id, o_totalprice, 'primary' AS target FROM s UNION ALL SELECT _id, floor(o_totalprice), 'secondary' FROM s
"""


def j4(spark, sf_dir):
    """Upsert join: how incoming rows meet the stored ones."""
    t, s = target(spark, sf_dir).select("_id", "hash"), writes.last_per_id(incoming(spark, sf_dir)).select("_id", F.col("hash").alias("sent"))
    j = t.join(s, "_id", "full_outer")
    return j.select("_id", F.col("hash").isNotNull().alias("stored"), F.col("sent").isNotNull().alias("incoming"), F.coalesce(F.col("hash") == F.col("sent"), F.lit(False)).alias("equal"))


J4 = f"WITH {CTE} SELECT coalesce(t._id, l._id) AS _id, t._id IS NOT NULL AS stored, l._id IS NOT NULL AS incoming, coalesce(t.hash = l.hash, false) AS equal FROM t FULL OUTER JOIN l ON t._id = l._id"


def w1_buckets(spark, sf_dir):
    """Index write into a bucketed table: the stored rows first, then a batch that touches some buckets."""
    t = tables.BucketedTable(spark, tables.scratch(spark, "bucketed"), 16)
    empty = target(spark, sf_dir).limit(0)
    t.write(target(spark, sf_dir).withColumn("seq", F.lit(0)), lambda old, new: writes.index_write(old, new).drop("result"), empty)
    t.write(incoming(spark, sf_dir), lambda old, new: writes.index_write(old, new).drop("result"), empty)
    return t.read().drop("hash")


W1_BUCKETS = f"""
WITH {CTE}
SELECT coalesce(t._id, l._id) AS _id, CASE WHEN t._id IS NULL OR l._id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version, {", ".join(f"CASE WHEN l._id IS NULL THEN t.{c} ELSE l.{c} END AS {c}" for c in COLUMNS)}
FROM t FULL OUTER JOIN l ON t._id = l._id
"""



def d2(spark, sf_dir):
    """The caller's own lookups, as columns: key, timestamp, hash and whether a row inserts when it is new."""
    e = table(spark, sf_dir, "events")
    sent = writes.looked_up(e, key=F.concat_ws("-", "event_type", "user_id"), ts=F.col("ts"), content=[F.col("value"), F.col("event_type")], insert=F.col("user_id") % 3 != 0, seq=F.col("event_id"))
    stored = writes.looked_up(e.where("event_id % 2 = 0"), key=F.concat_ws("-", "event_type", "user_id"), ts=F.col("ts"), content=[F.col("value"), F.col("event_type")], seq=F.col("event_id"))
    first = writes.first_per_id(stored).select("_id", F.lit(1).cast("long").alias("_version"), "_ts", "hash", "value")
    return writes.hash_upsert(first, sent, "hash", insert="_insert").select("_id", "_version", F.date_format("_ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "value", "result")


D2 = """
WITH e AS (SELECT event_type || '-' || user_id AS _id, ts, value, event_type, event_id, user_id % 3 <> 0 AS ins FROM events),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY event_id) AS rn FROM e WHERE event_id % 2 = 0) WHERE rn = 1),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY event_id DESC) AS rn FROM e) WHERE rn = 1),
j AS (SELECT coalesce(t._id, l._id) AS _id, t._id IS NOT NULL AS stored, l.ins, t.value IS NOT DISTINCT FROM l.value AS same, t.ts AS tt, l.ts AS lt, t.value AS tv, l.value AS lv FROM t FULL OUTER JOIN l ON t._id = l._id)
SELECT _id, CASE WHEN stored AND NOT same THEN 2 ELSE 1 END::BIGINT AS _version, strftime(CASE WHEN stored AND same THEN tt ELSE lt END, '%Y-%m-%d %H:%M:%S') AS at, CASE WHEN stored AND same THEN tv ELSE lv END AS value,
  CASE WHEN NOT stored THEN 'created' WHEN same THEN 'noop' ELSE 'updated' END AS result FROM j WHERE stored OR ins
"""


def d3(spark, sf_dir):
    """An update script with parameters: on an equal hash the price is what was sent less a discount in whole units, and the priority is stamped."""
    script = {"o_totalprice": F.floor(F.col("s.o_totalprice") * (1 - F.lit(0.25))).cast("double"), "o_orderpriority": F.concat(F.lit("seen-"), F.col("t.o_orderpriority"))}
    return writes.hash_upsert(target(spark, sf_dir), incoming(spark, sf_dir), "hash", on_match=script).select("_id", "_version", "o_totalprice", "o_orderpriority", "result")


D3 = f"""
WITH {CTE} SELECT coalesce(t._id, l._id) AS _id, CASE WHEN t._id IS NULL OR l._id IS NULL THEN 1 ELSE 2 END::BIGINT AS _version,
  CASE WHEN l._id IS NULL THEN t.o_totalprice WHEN t.hash = l.hash THEN floor(l.o_totalprice * 0.75::DOUBLE) ELSE l.o_totalprice END AS o_totalprice,
  CASE WHEN l._id IS NULL THEN t.o_orderpriority WHEN t.hash = l.hash THEN 'seen-' || t.o_orderpriority ELSE l.o_orderpriority END AS o_orderpriority,
  CASE WHEN l._id IS NULL THEN 'untouched' WHEN t._id IS NULL THEN 'created' ELSE 'updated' END AS result FROM t FULL OUTER JOIN l ON t._id = l._id
"""


def d6(spark, sf_dir):
    """A body serialiser of the caller's: an update line whose document is a list of name and value, and its script line."""
    p = table(spark, sf_dir, "part")
    body = F.concat(F.lit('{"script":{"params":'), F.to_json(F.map_from_arrays(F.array(F.lit("name"), F.lit("size")), F.array(F.col("p_name"), F.col("p_size").cast("string")))), F.lit("}}"))
    return export.action_lines(p, F.lit("index"), F.concat(F.lit("part-"), F.lower(F.col("p_brand"))), F.col("p_partkey").cast("string"), body, ["p_partkey"]).withColumn("line_no", F.col("line_no").cast("long"))


D6 = """
SELECT p_partkey, 0::BIGINT AS line_no, '{"index":{"_index":"part-' || lower(p_brand) || '","_id":"' || p_partkey || '"}}' AS line FROM part
UNION ALL SELECT p_partkey, 1, '{"script":{"params":{"name":"' || p_name || '","size":"' || p_size || '"}}}' FROM part
"""

QUERIES = {
    "D2_lookups": (d2, D2), "D3_update_script": (d3, D3), "D6_body_serialiser": (d6, D6),
    "W5_hash_upsert": (w5, W5), "W1_index_write": (w1, W1), "W1_bucketed_write": (w1_buckets, W1_BUCKETS), "W2_create_write": (w2, W2), "W3_auto_write": (w3, W3), "W4_partial_update": (w4, W4), "W4_partial_update_mask": (w4_mask, W4_MASK),
    "W6_hash_match_script": (w6, W6), "W7_delete": (w7, W7), "W8_action_log": (w8, W8), "W9_append": (w9, W9), "W10_fixed_target": (w10, W10), "W11_time_routed": (w11, W11), "W12_outcomes": (w12, W12),
    "W13_action_export": (w13, W13), "W14_custom_body": (w14, W14), "W15_trace_export": (w15, W15), "W16_multiplex": (w16, W16), "J4_upsert_join": (j4, J4),
}
