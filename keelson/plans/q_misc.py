"""Queries over scalar functions, schema operators, joins, reports and traces."""

from __future__ import annotations

import time

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import scalars as X
from keelson.operators import analyze as A
from keelson.operators import reports as R
from keelson.operators import schema as S
from keelson.operators import search
from keelson.plans import q_stream
from keelson.plans.q_writes import table
from keelson.sources import readers, tables
from keelson.streaming import delivery

H = "substring(sha256({}), 1, 16)"


def orders(spark, d):
    return table(spark, d, "orders")


def x9(spark, d):
    """Answers in five shapes, made from orders."""
    shapes = F.array(*[F.lit(x) for x in ('```json\n{"a": "@", "b": ""}\n```', '{"a": "@", "c": "x"}}', '[1, 2]', "no answer @", '`{"b": "@"}`')])
    text = F.replace(F.element_at(shapes, (F.col("o_orderkey") % 5 + 1).cast("int")), F.lit("@"), F.col("o_orderkey").cast("string"))
    return orders(spark, d).select("o_orderkey", *X.response_fields(text, ["a", "b"]))


def x12(spark, d):
    names = F.concat(F.lit("Logs-"), F.col("event_type"), F.when(F.col("user_id") % 3 == 0, "-*bad").when(F.col("user_id") % 3 == 1, "-Default").otherwise(""))
    e = table(spark, d, "events").select(X.stream_name(names).alias("s"))
    return e.groupBy(F.coalesce("s.type", F.lit("-")).alias("type"), F.coalesce("s.dataset", F.lit("-")).alias("dataset"), F.coalesce("s.namespace", F.lit("-")).alias("namespace")).agg(F.count("*").alias("n"))


def x15(spark, d):
    row = table(spark, d, "part").select(F.array(F.lit("id"), F.lit("name"), F.lit("price")).alias("names"), F.array(F.col("p_partkey").cast("string"), F.col("p_name"), F.floor("p_retailprice").cast("string")).alias("values"))
    m = X.tabular(F.col("names"), F.col("values"))
    return row.select(m["id"].cast("long").alias("id"), m["name"].alias("name"), m["price"].cast("long").alias("price"))


def events_json(spark, d):
    e = table(spark, d, "events")
    amount = F.when(F.col("event_id") % 4 == 0, F.lit('"many"')).otherwise(F.col("event_id").cast("string"))
    extra = F.when(F.col("event_id") % 3 == 0, F.lit(', "when": "2024-01-0x"')).when(F.col("event_id") % 3 == 1, F.lit(', "when": "2024-01-05"')).otherwise(F.lit(""))
    return e.select("event_id", F.concat(F.lit('{"amount": '), amount, F.lit(', "type": "'), F.col("event_type"), F.lit('"'), extra, F.lit("}")).alias("json"))


def m1(spark, d):
    out = S.typed_read(events_json(spark, d), "json", {"amount": "long", "type": "keyword", "when": "date"})
    return out.groupBy("type", "malformed").agg(F.count("*").alias("n"), F.coalesce(F.sum("amount"), F.lit(0)).alias("amount"), F.count("when").alias("dated"))


M1 = """
WITH e AS (SELECT event_type AS type, (event_id % 4 = 0)::INT + (event_id % 3 = 0)::INT AS malformed, CASE WHEN event_id % 4 <> 0 THEN event_id END AS amount, event_id % 3 = 1 AS dated FROM events)
SELECT type, malformed, count(*) AS n, coalesce(sum(amount), 0)::BIGINT AS amount, count(CASE WHEN dated THEN 1 END) AS dated FROM e GROUP BY 1, 2
"""


def m4(spark, d):
    t = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("p_name"), F.struct(F.col("p_brand").alias("brand")).alias("info"))
    s = table(spark, d, "part").where("p_partkey % 3 = 0").select("p_partkey", F.upper("p_name").alias("p_name"), F.struct(F.lit("X").alias("brand"), F.col("p_type").alias("type")).alias("info"), "p_size")
    out = S.additive_merge(t, s, "p_partkey")
    return out.select("p_partkey", "p_name", F.col("info.brand").alias("brand"), F.col("info.type").alias("type"), F.coalesce("p_size", F.lit(-1)).alias("p_size"))


M4 = """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name WHEN p_partkey % 3 = 0 THEN upper(p_name) END AS p_name, p_brand AS brand, CASE WHEN p_partkey % 3 = 0 THEN p_type END AS type, CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE -1 END AS p_size FROM part"""


def profile(spark, d):
    return S.profile(events_json(spark, d), "json")


M5 = """
WITH f AS (SELECT 'amount' AS field, CASE WHEN event_id % 4 = 0 THEN 'string' ELSE 'long' END AS type FROM events UNION ALL SELECT 'type', 'string' FROM events
  UNION ALL SELECT 'when', CASE WHEN event_id % 3 = 0 THEN 'string' ELSE 'date' END FROM events WHERE event_id % 3 <> 2)
SELECT field, type, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 4) AS fill FROM f GROUP BY 1, 2
"""


def m6(spark, d):
    return S.dynamic_templates(profile(spark, d), [{"match": "am*", "match_mapping_type": "long", "type": "double"}, {"match_mapping_type": "string", "unmatch": "when", "type": "keyword"}]).select("field", "type", "assigned")


def nested_json(spark, d):
    """events as objects that nest three levels, with arrays of objects and of numbers, nulls and numbers in quotes."""
    e = table(spark, d, "events")
    items = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('[{"price": 1.5, "tags": ["a"]}, {"price": '), "event_id", F.lit("}]"))).otherwise(F.lit('[[1, 2], "x"]'))
    inner = F.concat(F.lit('{"id": '), "user_id", F.lit(', "since": "2024-01-05T10:00:00Z", "deep": {"flag": true, "code": "'), "event_id", F.lit('", "below": {"x": 1}}}'))
    broken = F.when(F.col("event_id") % 11 == 0, "").otherwise("}")
    return e.select(F.concat(F.lit('{"user": '), inner, F.lit(', "items": '), items, F.lit(', "none": null, "kind": "'), "event_type", F.lit('"'), broken).alias("json"))


M5_NESTED = """
WITH e AS (SELECT event_id % 2 = 0 AS even, event_id FROM events WHERE event_id % 11 <> 0),
f AS (SELECT unnest([['user', 'object'], ['user.id', 'long'], ['user.since', 'date'], ['user.deep', 'object'], ['user.deep.flag', 'boolean'], ['user.deep.code', 'string'], ['user.deep.below', 'object'], ['kind', 'string']]) AS p FROM e
  UNION ALL SELECT unnest([['items', 'object'], ['items.price', 'double'], ['items.price', 'long'], ['items.tags', 'string']]) FROM e WHERE even
  UNION ALL SELECT unnest([['items', 'long'], ['items', 'string']]) FROM e WHERE NOT even)
SELECT p[1] AS field, p[2] AS type, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 4) AS fill FROM f GROUP BY 1, 2
"""


def m6_paths(spark, d):
    templates = [
        {"path_match": "user.*", "path_unmatch": "*.deep.*", "match_mapping_type": "long", "type": "integer"}, {"path_match": "*.deep.*", "match": "c*", "type": "wildcard"},
        {"path_match": "items.*", "unmatch": "tags", "unmatch_mapping_type": "long", "type": "float"}, {"match_mapping_type": "string", "type": "keyword"},
    ]
    return S.dynamic_templates(S.profile(nested_json(spark, d), "json", 3), templates).select("field", "type", "assigned")


def m7(spark, d):
    schema = T.StructType().add("id", T.LongType()).add("price", T.IntegerType()).add("note", T.StringType()).add("p_brand", T.StringType())
    return S.conform(table(spark, d, "part"), schema, {"p_partkey": "id", "p_retailprice": "price"}).withColumn("note", F.coalesce("note", F.lit("none")))


def m8(spark, d):
    p = table(spark, d, "part")
    return S.evolve(p.where("p_size < 10").select("p_partkey", "p_name"), p.where("p_size >= 10").select("p_partkey", "p_name", (F.col("p_size") > 30).alias("featured"))).groupBy(F.coalesce(F.col("featured").cast("string"), F.lit("none")).alias("featured")).agg(F.count("*").alias("n"))


def sent(spark, d):
    """lineitem as sent documents: batch = order, position = line; an outcome for each from its quantity."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("batch_id"), F.col("l_linenumber").alias("pos"), "l_quantity")
    li = readers.dealt(lines, "batch_id", "pos").groupBy("batch_id", "pos").agg(F.max("l_quantity").cast("int").alias("q"))
    status = F.when(F.col("q") % 10 == 0, 429).when(F.col("q") % 10 == 1, 500).when(F.col("q") % 10 == 2, 400).when(F.col("q") % 10 == 3, 503).otherwise(201)
    return li.withColumn("status", status).withColumn("error_type", F.when(status >= 300, F.concat(F.lit("e"), status))).withColumn("error_reason", F.when(status >= 300, F.concat(F.lit("quantity "), "q")))


SENT = """o AS (SELECT l_orderkey AS batch_id, l_linenumber AS pos, max(l_quantity)::INT AS q FROM lineitem GROUP BY 1, 2),
s AS (SELECT *, CASE q % 10 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 400 WHEN 3 THEN 503 ELSE 201 END AS status FROM o)"""


def j6(spark, d):
    both = sent(spark, d)
    return R.zip_outcomes(both.select("batch_id", "pos", "q"), both.select("batch_id", "pos", "status"))


def j7(spark, d):
    children = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("parent"), F.when(F.col("l_returnflag") == "R", "return").otherwise("line").alias("relation"), "l_quantity")
    return R.parent_child(orders(spark, d), children, "o_orderkey", "relation", "return").drop("parent")


def j8(spark, d):
    q = spark.createDataFrame([(1, "l_quantity", 45.0, None, None), (2, "l_discount", None, 0.01, None), (3, "l_returnflag", None, None, "R"), (4, "l_tax", 0.02, 0.04, None)], "query_id long, field string, lo double, hi double, value string")
    rows = table(spark, d, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag")
    return search.stored_queries(rows, q, rows.columns).groupBy("query_id").agg(F.count("*").alias("n"))


def j9(spark, d):
    t = orders(spark, d).select((F.col("o_custkey") % 10).alias("trace_id"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"))
    keys = orders(spark, d).select(F.col("o_orderkey").alias("transaction_id"), (F.col("o_custkey") % 10).alias("trace_id"))
    s = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("transaction_id"), F.when(F.col("l_linenumber") <= 2, F.col("l_orderkey")).otherwise(F.lit(-1)).alias("parent_id"), F.col("l_quantity").alias("duration")).join(keys, "transaction_id")
    return R.assemble(t, s).select("transaction_id", "span_count", "span_duration", "children")


def spans(spark, d):
    """Orders as spans: each follows the last order of its trace, or the one before; some parents are missing, some ring."""
    o = orders(spark, d).select((F.col("o_custkey") % 50).alias("trace_id"), F.col("o_orderkey").alias("span_id"))
    w = Window.partitionBy("trace_id").orderBy("span_id")
    key = F.col("span_id")
    parent = F.when(key % 97 == 0, -key).when(key % 1000 == 5, key).when(key % 3 == 0, F.lag("span_id", 2).over(w)).otherwise(F.lag("span_id", 1).over(w))
    return o.withColumn("parent_id", parent)


def j9_trees(spark, d):
    return R.span_trees(spans(spark, d)).na.fill(-1, ["root", "depth"])


J9_TREES = """
WITH RECURSIVE o AS (SELECT o_custkey % 50 AS t, o_orderkey AS s, lag(o_orderkey) OVER w AS a, lag(o_orderkey, 2) OVER w AS b FROM orders WINDOW w AS (PARTITION BY o_custkey % 50 ORDER BY o_orderkey)),
p AS (SELECT t, s, CASE WHEN s % 97 = 0 THEN -s WHEN s % 1000 = 5 THEN s WHEN s % 3 = 0 THEN b ELSE a END AS p FROM o),
r AS (SELECT t, s, s AS root, 0::BIGINT AS depth, p IS NOT NULL AS lost FROM p WHERE p IS NULL OR p NOT IN (SELECT s FROM p q WHERE q.t = p.t)
  UNION ALL SELECT p.t, p.s, r.root, r.depth + 1, r.lost FROM r JOIN p ON p.t = r.t AND p.p = r.s)
SELECT p.t AS trace_id, p.s AS span_id, coalesce(r.root, -1) AS root, coalesce(r.depth, -1) AS depth, CASE WHEN r.s IS NULL THEN 'cycle' WHEN r.lost THEN 'orphan' WHEN r.depth = 0 THEN 'root' ELSE 'child' END AS status
FROM p LEFT JOIN r ON p.t = r.t AND p.s = r.s
"""


def g7_observed(spark, d):
    """Counters of a running stream: events are sent with retries, and each micro-batch is counted on its way to the sink."""
    listener = R.DeliveryListener()
    spark.streams.addListener(listener)
    try:
        sent_ = listener.observed(delivery.send_with_retries(q_stream.stream(spark, d, ("event_id", "user_id")), q_stream.send, retries=3))
        query = sent_.writeStream.queryName("deliveries").format("parquet").option("path", tables.scratch(spark, "outcomes")).option("checkpointLocation", tables.scratch(spark, "checkpoint")).trigger(availableNow=True).start()
        delivery.drain(query)
        while "deliveries" not in listener.ended:
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(listener)
    total = listener.totals["deliveries"]
    return spark.createDataFrame([(total["items"], total["accepted"], total["retries"], total["rejected"], total["exhausted"])], "items long, accepted long, retries long, rejected long, exhausted long")


def g7_exhausted(spark, d):
    out = delivery.send_with_retries(table(spark, d, "events").select("event_id", (F.col("event_id") % 9).alias("batch_id")), q_stream.send, retries=3)
    return R.delivery(out)


G7_COUNTS = "count(*) AS items, count(CASE WHEN o = 'accepted' THEN 1 END) AS accepted, 0::BIGINT AS retries, count(CASE WHEN o = 'rejected' THEN 1 END) AS rejected, count(CASE WHEN o = 'exhausted' THEN 1 END) AS exhausted"
G7_OUTCOMES = f"(SELECT event_id, {q_stream.OUTCOME} AS o FROM events)"


def g8(spark, d):
    c = table(spark, d, "conversations")
    return R.usage(c, F.size(A.whitespace(F.col("text"))))


def g8_page(spark, d):
    """The second page of ten of the conversations with over two rounds, most output first."""
    c = table(spark, d, "conversations")
    return R.usage(c, F.size(A.whitespace(F.col("text"))), where=F.col("rounds") > 2, order=[F.col("output_tokens").desc(), F.col("conv_id")], page=1, size=10)


def j8_many(spark, d):
    """A stored range for each of many orders and a value for each flag, beyond what is broadcast."""
    o = table(spark, d, "orders").where("o_orderkey % 50 = 0").select(F.col("o_orderkey").alias("query_id"), F.lit("l_extendedprice").alias("field"), F.floor("o_totalprice").cast("double").alias("lo"), (F.floor("o_totalprice") + 500).cast("double").alias("hi"), F.lit(None).cast("string").alias("value"))
    flags = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("value")).distinct().select((-F.ascii("value")).cast("long").alias("query_id"), F.lit("l_returnflag").alias("field"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), "value")
    rows = table(spark, d, "lineitem").select("l_extendedprice", "l_returnflag")
    return search.stored_counts(rows, o.withColumn("query_id", F.col("query_id").cast("long")).unionByName(flags), rows.columns, most=10)


def clauses(spark):
    """Stored queries of several clauses over lineitem."""
    ddl = "query_id long, occur string, field string, lo double, hi double, value string, minimum_should_match int"
    return spark.createDataFrame([
        (1, "must", "l_returnflag", None, None, "R", None), (1, "must", "l_quantity", 45.0, None, None, None), (1, "must_not", "l_linestatus", None, None, "O", None),
        (2, "should", "l_quantity", None, 5.0, None, 2), (2, "should", "l_discount", 0.08, None, None, 2), (2, "should", "l_returnflag", None, None, "A", 2),
        (3, "must", "l_tax", 0.02, 0.04, None, None), (3, "should", "l_quantity", 40.0, None, None, None),
        (4, "must_not", "l_returnflag", None, None, "N", None), (4, "must_not", "l_discount", 0.01, None, None, None),
        (5, "should", "l_returnflag", None, None, "R", None), (5, "should", "l_tax", 0.08, None, None, None), (5, "must_not", "l_quantity", None, 30.0, None, None),
    ], ddl)


def j8_clauses(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return search.stored_queries(rows, clauses(spark), rows.columns[2:]).select("l_orderkey", "l_linenumber", "query_id")


J8_CLAUSES = """
SELECT l_orderkey, l_linenumber, q AS query_id FROM lineitem, (VALUES (1), (2), (3), (4), (5)) v(q) WHERE
  (q = 1 AND l_returnflag = 'R' AND l_quantity >= 45 AND l_linestatus <> 'O') OR (q = 2 AND (l_quantity <= 5)::INT + (l_discount >= 0.08)::INT + (l_returnflag = 'A')::INT >= 2)
  OR (q = 3 AND l_tax BETWEEN 0.02 AND 0.04) OR (q = 4 AND l_returnflag <> 'N' AND l_discount < 0.01) OR (q = 5 AND (l_returnflag = 'R' OR l_tax >= 0.08) AND l_quantity > 30)
"""


def j8_clauses_many(spark, d):
    """A query for each of many orders, of two must clauses and one that must not hold, on the shuffle path."""
    o = table(spark, d, "orders").where("o_orderkey % 20 = 0")
    key = F.col("o_orderkey").alias("query_id")
    lo, none = F.floor("o_totalprice").cast("double"), F.lit(None)
    clause = lambda occur, field, lo, hi, value: o.select(key, F.lit(occur).alias("occur"), F.lit(field).alias("field"), lo.cast("double").alias("lo"), hi.cast("double").alias("hi"), value.cast("string").alias("value"))
    parts = clause("must", "l_extendedprice", lo, lo + 2000, none).unionByName(clause("must", "l_returnflag", none, none, F.substring("o_orderstatus", 1, 1).cast("string"))).unionByName(clause("must_not", "l_quantity", F.lit(10.0), F.lit(20.0), none))
    flags = F.when(F.col("value") == "F", "A").when(F.col("value") == "O", "N").when(F.col("value") == "P", "R").otherwise(F.col("value"))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag")
    return search.stored_queries(rows, parts.withColumn("value", flags), rows.columns[2:], most=10).select("l_orderkey", "l_linenumber", "query_id")


J8_CLAUSES_MANY = """
SELECT l_orderkey, l_linenumber, o_orderkey AS query_id FROM lineitem JOIN orders ON o_orderkey % 20 = 0 AND l_extendedprice BETWEEN floor(o_totalprice) AND floor(o_totalprice) + 2000
  AND l_returnflag = CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' WHEN 'P' THEN 'R' END AND NOT l_quantity BETWEEN 10 AND 20
"""


QUERIES = {
    "M5_nested_profile": (lambda s, d: S.profile(nested_json(s, d), "json", 3), M5_NESTED),
    "M6_path_templates": (m6_paths, f"WITH p AS ({M5_NESTED}) SELECT field, type, CASE WHEN field LIKE 'user.%' AND field NOT LIKE '%.deep.%' AND type = 'long' THEN 'integer' WHEN field = 'user.deep.code' THEN 'wildcard' WHEN field = 'items.price' AND type <> 'long' THEN 'float' WHEN type = 'string' THEN 'keyword' ELSE type END AS assigned FROM p"),
    "J9_span_trees": (j9_trees, J9_TREES),
    "G7_observed": (g7_observed, f"SELECT {G7_COUNTS} FROM {G7_OUTCOMES}"),
    "G7_exhausted": (g7_exhausted, f"SELECT count(DISTINCT event_id % 9) AS batches, {G7_COUNTS}, false AS success FROM {G7_OUTCOMES}"),
    "J8_clauses": (j8_clauses, J8_CLAUSES), "J8_clauses_many": (j8_clauses_many, J8_CLAUSES_MANY),
    "X1_content_hash": (lambda s, d: orders(s, d).select("o_orderkey", X.content_hash(F.col("o_custkey"), F.col("o_orderstatus"), F.lit(None)).alias("h")), f"SELECT o_orderkey, {H.format('concat(o_custkey, o_orderstatus)')} AS h FROM orders"),
    "X2_combined_hash": (lambda s, d: orders(s, d).select("o_orderkey", X.combined_hash(X.schema_hash('{"a": 1}'), X.content_hash(F.col("o_orderkey"))).alias("h")), f"SELECT o_orderkey, {H.format(chr(39) + X.schema_hash(chr(123) + chr(34) + 'a' + chr(34) + ':1}') + chr(39) + ' || ' + H.format('o_orderkey::VARCHAR'))} AS h FROM orders"),
    "X4_cache_key": (lambda s, d: table(s, d, "pages").select("page_id", X.cache_key(F.col("url")).alias("k")), "SELECT page_id, sha256(url) AS k FROM pages"),
    "X6_dated_name": (lambda s, d: table(s, d, "events").select(X.dated_name("Logs", F.col("ts"), "yyyy.MM").alias("name")).groupBy("name").agg(F.count("*").alias("n")), "SELECT 'logs-' || strftime(ts, '%Y.%m') AS name, count(*) AS n FROM events GROUP BY 1"),
    "X7_name_policies": (lambda s, d: X.rename_all(table(s, d, "nation").toDF("nationKey", "nationName", "regionKey"), "snake_lower"), "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key FROM nation"),
    "X8_prompt": (lambda s, d: orders(s, d).select("o_orderkey", X.prompt(F.lit("<"), F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")), F.lit(">")).alias("p")), "SELECT o_orderkey, '<' || o_orderstatus || coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END::VARCHAR, '') || '>' AS p FROM orders"),
    "X9_response": (x9, "SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1) THEN o_orderkey::VARCHAR END AS a, CASE WHEN o_orderkey % 5 = 4 THEN o_orderkey::VARCHAR END AS b FROM orders"),
    "X10_epoch_micros": (lambda s, d: table(s, d, "events").select("event_id", X.epoch_micros(F.col("ts")).alias("us")), "SELECT event_id, epoch_us(ts) AS us FROM events"),
    "X11_clean_name": (lambda s, d: table(s, d, "pages").select("page_id", X.clean_name(F.col("url")).alias("name")), "SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9 _-]', '_', 'g') AS name FROM pages"),
    "X12_stream_name": (x12, "SELECT CASE WHEN user_id % 3 = 1 THEN 'logs' ELSE '-' END AS type, CASE WHEN user_id % 3 = 1 THEN event_type ELSE '-' END AS dataset, CASE WHEN user_id % 3 = 1 THEN 'default' ELSE '-' END AS namespace, count(*) AS n FROM events GROUP BY 1, 2, 3"),
    "X13_row_bytes": (lambda s, d: orders(s, d).select("o_orderkey", X.row_bytes("o_orderkey", "o_orderstatus").cast("long").alias("bytes")), """SELECT o_orderkey, strlen('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}')::BIGINT AS bytes FROM orders"""),
    "X14_ellipsis": (lambda s, d: table(s, d, "documents").select("doc_id", X.ellipsis(F.col("text"), 40).alias("t")), "SELECT doc_id, CASE WHEN length(text) > 40 THEN substring(text, 1, 40) || '…' ELSE text END AS t FROM documents"),
    "X15_tabular": (x15, "SELECT p_partkey AS id, p_name AS name, floor(p_retailprice)::BIGINT AS price FROM part"),
    "M1_typed_read": (m1, M1), "M4_additive_merge": (m4, M4), "M5_field_profile": (profile, M5),
    "M6_dynamic_templates": (m6, f"WITH p AS ({M5}) SELECT field, type, CASE WHEN field LIKE 'am%' AND type = 'long' THEN 'double' WHEN type = 'string' AND field <> 'when' THEN 'keyword' ELSE type END AS assigned FROM p"),
    "M7_conform": (m7, "SELECT p_partkey AS id, trunc(p_retailprice)::INT AS price, 'none' AS note, p_brand FROM part"),
    "M8_evolution": (m8, "SELECT CASE WHEN p_size < 10 THEN 'none' WHEN p_size > 30 THEN 'true' ELSE 'false' END AS featured, count(*) AS n FROM part GROUP BY 1"),
    "J6_positional_zip": (j6, f"WITH {SENT} SELECT batch_id, pos, q, status FROM s"),
    "J7_parent_child": (j7, "SELECT 'return' AS relation, l_quantity, orders.* FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"),
    "J8_stored_queries": (j8, "SELECT q AS query_id, count(*) AS n FROM lineitem, (VALUES (1), (2), (3), (4)) v(q) WHERE (q = 1 AND l_quantity >= 45) OR (q = 2 AND l_discount <= 0.01) OR (q = 3 AND l_returnflag = 'R') OR (q = 4 AND l_tax BETWEEN 0.02 AND 0.04) GROUP BY 1"),
    "J9_traces": (j9, "SELECT o_orderkey AS transaction_id, count(l_orderkey) AS span_count, coalesce(sum(l_quantity), 0) AS span_duration, count(CASE WHEN l_linenumber <= 2 THEN 1 END) AS children FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"),
    "G2_count": (lambda s, d: orders(s, d).agg(F.count("*").alias("n")), "SELECT count(*) AS n FROM orders"),
    "G3_terms": (lambda s, d: R.terms(orders(s, d), "o_orderpriority"), "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1"),
    "G6_failures": (lambda s, d: R.failures(sent(s, d)), f"WITH {SENT} SELECT status, 'e' || status AS error_type, count(*) AS n, 'quantity ' || arg_min(q, batch_id * 100 + pos) AS first_reason FROM s WHERE status > 299 GROUP BY status"),
    "G7_delivery": (lambda s, d: R.delivery(sent(s, d)), f"WITH {SENT} SELECT count(DISTINCT batch_id) AS batches, count(*) AS items, count(CASE WHEN status < 300 THEN 1 END) AS accepted, count(CASE WHEN status IN (429, 503) THEN 1 END) AS retries, count(CASE WHEN status IN (400, 500) THEN 1 END) AS rejected, 0::BIGINT AS exhausted, false AS success FROM s"),
    "G8_usage": (g8, r"WITH t AS (SELECT conv_id, role, len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS n FROM conversations) SELECT conv_id, count(CASE role WHEN 'user' THEN 1 END) AS rounds, coalesce(sum(CASE role WHEN 'user' THEN n END), 0)::BIGINT AS input_tokens, coalesce(sum(CASE role WHEN 'assistant' THEN n END), 0)::BIGINT AS output_tokens, count(CASE role WHEN 'assistant' THEN 1 END) < count(CASE role WHEN 'user' THEN 1 END) AS has_warnings FROM t GROUP BY 1"),
    "G8_usage_page": (g8_page, r"SELECT * FROM (WITH t AS (SELECT conv_id, role, len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS n FROM conversations) SELECT conv_id, count(CASE role WHEN 'user' THEN 1 END) AS rounds, coalesce(sum(CASE role WHEN 'user' THEN n END), 0)::BIGINT AS input_tokens, coalesce(sum(CASE role WHEN 'assistant' THEN n END), 0)::BIGINT AS output_tokens, count(CASE role WHEN 'assistant' THEN 1 END) < count(CASE role WHEN 'user' THEN 1 END) AS has_warnings FROM t GROUP BY 1) WHERE rounds > 2 ORDER BY output_tokens DESC, conv_id LIMIT 10 OFFSET 10"),
    "J8_stored_queries_many": (j8_many, "SELECT o_orderkey AS query_id, count(*) AS n FROM lineitem JOIN orders ON o_orderkey % 50 = 0 AND l_extendedprice BETWEEN floor(o_totalprice) AND floor(o_totalprice) + 500 GROUP BY 1 UNION ALL SELECT -ascii(l_returnflag), count(*) FROM lineitem GROUP BY 1"),
    "T5_outcomes": (lambda s, d: sent(s, d).groupBy(R.classify(F.col("status")).alias("kind")).agg(F.count("*").alias("n")), f"WITH {SENT} SELECT CASE WHEN status < 300 THEN 'accepted' WHEN status IN (429, 503) THEN 'retry' ELSE 'rejected' END AS kind, count(*) AS n FROM s GROUP BY 1"),
}
