"""Queries over scans, predicates, projections, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions import predicates as P
from keelson.functions import project
from keelson.operators import search
from keelson.plans.q_writes import table
from keelson.sources import readers, tables


def part(spark, d):
    return table(spark, d, "part")


def r1(spark, d):
    """Snapshot scan: the pinned version stays readable after a second one is written."""
    root = tables.TableRoot(spark, tables.scratch(spark, "root"))
    pinned = root.write("part-2024.01.01", part(spark, d))
    root.write("part-2024.01.02", part(spark, d).where("p_size > 25"))
    return pinned.select("p_partkey", "p_size")


def r2(spark, d):
    return readers.pages(part(spark, d).select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"], 100)


def r3(spark, d):
    return readers.after(table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")), ["l_orderkey", "l_linenumber"], [100, 3], 500)


def r4(spark, d):
    return table(spark, d, "customer")


def r5(spark, d):
    return readers.sliced(table(spark, d, "orders"), "o_orderkey", 7, numeric=True).groupBy("slice").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


def r6(spark, d):
    root = tables.TableRoot(spark, tables.scratch(spark, "root"))
    root.write("part-2024.01.01", part(spark, d).where("p_size <= 25"))
    root.write("part-2024.01.02", part(spark, d).where("p_size > 25"))
    root.publish(["part-latest", "part"], "part-2024.01.01", "part-%")
    root.publish(["part-latest", "part"], "part-2024.01.02", "part-%")
    return root.read("part", "part-latest").select("p_partkey", "p_size")


def generations(spark, d):
    p = part(spark, d)
    return {"part-a": p.where("p_size < 20").select("p_partkey", "p_name"), "part-b": p.where("p_size >= 20").select("p_partkey", "p_name", "p_size"), "other": p.select("p_partkey")}


def r7(spark, d):
    return readers.pattern_union(generations(spark, d), "part-*").groupBy("_index").agg(F.count("*").alias("n"), F.count("p_size").alias("sizes"), F.min("p_partkey").alias("first"))


def r8(spark, d):
    return readers.external(spark, "parquet", "c_acctbal > 5000 AND c_mktsegment = 'BUILDING'", ["c_custkey", "c_acctbal"], path=f"{d}/customer.parquet")


def r9(spark, d):
    """Producer source: events as JSON lines in a folder, every seventh line broken, read back as rows and malformed lines."""
    path = tables.scratch(spark, "produced")
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    table(spark, d, "events").select(F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("not json "), F.col("event_id"))).otherwise(line)).write.text(path)
    return readers.produced(spark, path, "event_id long, user_id long, event_type string")


def r10(spark, d):
    lines = table(spark, d, "orders").select(F.concat_ws(",", F.date_format("o_orderdate", "yyyy-MM-dd"), *[F.format_string("%.2f", F.col("o_totalprice") + i) for i in range(4)], F.col("o_custkey").cast("string"), "o_orderstatus").alias("line"))
    out = lines.select(*readers.stock_columns(F.col("line")))
    return out.groupBy("symbol").agg(F.min("date").cast("string").alias("first"), F.round(F.sum("close") - F.sum("open"), 2).alias("moved"), F.sum("volume").alias("volume"))


def f1(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.struct("o_orderstatus", "o_orderpriority").alias("state"), "o_custkey", "o_totalprice")
    return project.include(rows, ["o_*key", "state.o_orderpriority"]).select("o_orderkey", "o_custkey", F.to_json("state").alias("state"))


def f2(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.struct("o_orderstatus", "o_orderpriority").alias("state"), "o_totalprice")
    return project.exclude(rows, ["o_total*", "state.o_orderstatus"]).select("o_orderkey", F.to_json("state").alias("state"))


def f5(spark, d):
    rich = table(spark, d, "customer").where("c_acctbal > 9000").select("c_custkey")
    return P.terms(table(spark, d, "orders"), "o_custkey", rich).unionByName(P.terms(table(spark, d, "orders"), "o_custkey", [1, 2, 3])).groupBy("o_custkey").agg(F.count("*").alias("n"))


def f6(spark, d):
    keys = table(spark, d, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return P.ids(table(spark, d, "orders"), keys, "o_orderkey").select("o_orderkey", "o_orderstatus")


def sizes(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.when(F.col("l_quantity") > 40, F.col("l_quantity")))).alias("large"), F.max(F.when(F.col("l_discount") > 0.09, F.col("l_discount"))).alias("cut"))


def f7(spark, d):
    return sizes(spark, d).groupBy(P.exists(F.col("large"), True).alias("has_large"), P.exists(F.col("cut")).alias("has_cut")).agg(F.count("*").alias("n"))


def f8(spark, d):
    c = [F.col("p_size") > 40, F.col("p_retailprice") > 950, P.term(F.col("p_type"), "ECONOMY")]
    return part(spark, d).where(P.should(c, 2) & P.must_not(F.col("p_brand") == "Brand#2")).select("p_partkey", "p_brand")


def f12(spark, d):
    return search.collapse(table(spark, d, "orders"), "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


def f13(spark, d):
    tier = "CASE WHEN p_retailprice < 950 THEN 'budget' WHEN p_retailprice < 1000 THEN 'mid' ELSE 'premium' END"
    return project.runtime(part(spark, d), {"price_tier": (tier, "string"), "is_large": ("p_size > 40", "boolean")}).groupBy("price_tier", "is_large").agg(F.count("*").alias("n"))


def f14(spark, d):
    return project.copy_to(part(spark, d), ["p_name", "p_brand", "p_size"], "all_text").select("p_partkey", "all_text")


def f17(spark, d):
    return project.multi_field(table(spark, d, "documents"), "text", ignore_above=256).groupBy(F.col("text__keyword").isNotNull().alias("kept")).agg(F.count("*").alias("n"))


def f19(spark, d):
    ranges = spark.createDataFrame([("small", None, 10.0), ("middle", 8.0, 30.0), ("large", 30.0, None)], "name string, gte double, lte double")
    rows = table(spark, d, "lineitem").select("l_quantity")
    return search.range_match(rows, "l_quantity", ranges).groupBy("name").agg(F.count("*").alias("n"), F.max("l_quantity").alias("most"))


def f20(spark, d):
    return part(spark, d).where(P.wildcard(F.col("p_name"), "*re? w*")).select("p_partkey", "p_name")


def f21(spark, d):
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_quantity", "l_discount")).alias("items"))
    return items.where(P.nested(F.col("items"), lambda e: (e["l_quantity"] > 45) & (e["l_discount"] >= 0.09))).select("l_orderkey")


def f22(spark, d):
    e = table(spark, d, "events")
    return e.where(P.flattened(F.col("props"), "k").cast("int") > 90).select("event_id", P.flattened(F.col("props"), "k").alias("k"), F.array_join(P.flattened_keys(F.col("props")), ",").alias("keys"))


def f22_depth(spark, d):
    """Keys down to two levels of objects that nest three."""
    nested = F.concat(F.lit('{"a":{"b":{"c":'), F.col("event_id"), F.lit('},"d":2},"e":'), F.col("props"), F.lit(',"f":{}}'))
    return table(spark, d, "events").select("event_id", F.array_join(P.flattened_keys(nested, 2), ",").alias("keys"))


def f19_dates(spark, d):
    """Ranges of days, one for each day of events, by way of cells."""
    e = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    days = e.select(F.date_trunc("day", "ts").alias("gte")).distinct().select(F.date_format("gte", "yyyy-MM-dd").alias("name"), "gte", (F.col("gte") + F.expr("INTERVAL 36 HOURS")).alias("lte"))
    return search.range_match(e, "ts", days, most=5).groupBy("name").agg(F.count("*").alias("n"))


def k5(spark, d):
    v = table(spark, d, "embeddings")
    found = search.vector_top(v, v.where("vec_id % 100 = 0"), "vec_id", "embedding", 5)
    return found.select("query_id", F.col("id").alias("vec_id"), F.round("score", 4).alias("score"))


def k6(spark, d):
    return search.complete(part(spark, d), "p_name", "re", [F.col("p_retailprice").desc(), F.col("p_partkey")], 10).select("p_partkey", "p_name")


def k6_index(spark, d):
    """All prefixes that are words of part names or of documents, or the first letters of such words, in one join with an
    index of the words of documents: the three most frequent words of each."""
    words = F.explode(F.array_distinct(F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w != "")))
    counted = table(spark, d, "documents").select(words.alias("word")).groupBy("word").agg(F.count("*").alias("docs"))
    index = search.completions(counted, "word", [F.col("docs").desc(), F.col("word")], 3, depth=4)
    names = part(spark, d).select(F.explode(F.split("p_name", " ")).alias("word"))
    all_words = counted.select("word").unionByName(names)
    prefixes = all_words.select(F.explode(F.array("word", F.substring("word", 1, 2), F.substring("word", 1, 5))).alias("prefix"))
    return search.completed(index, prefixes).select("prefix", "rank", "word", "docs")


K6_INDEX = """
WITH w AS MATERIALIZED (SELECT word, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1),
a AS (SELECT word FROM w UNION SELECT unnest(string_split(p_name, ' ')) FROM part),
p AS (SELECT DISTINCT unnest([word, substr(word, 1, 2), substr(word, 1, 5)]) AS prefix FROM a),
e AS (SELECT word, docs, substr(word, 1, k) AS prefix FROM (SELECT word, docs, unnest(range(1, length(word) + 1)) AS k FROM w))
SELECT prefix, rank::INT AS rank, word, docs FROM (SELECT prefix, word, docs, row_number() OVER (PARTITION BY prefix ORDER BY docs DESC, word) AS rank FROM p JOIN e USING (prefix)) WHERE rank <= 3
"""


def k7(spark, d):
    v = part(spark, d).select("p_partkey", F.concat_ws(".", F.col("p_size"), F.pmod(F.col("p_partkey"), F.lit(13)), F.lit(1)).alias("version"))
    return search.top(v, [search.version_key(F.col("version")).desc(), F.col("p_partkey")], 20)


def u2(spark, d):
    a, b = table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return b.distinct().join(a, "k", "left_anti").select("k", F.lit("only customers").alias("side")).unionByName(b.distinct().join(a, "k", "left_semi").select("k", F.lit("both").alias("side")))


def d4(spark, d):
    """Runtime field scripts of the caller's: SQL expressions over the row, one of them over an earlier one's inputs."""
    scripts = {"unit_price": ("floor(l_extendedprice / l_quantity)", "long"), "late": ("CASE WHEN l_shipdate > timestamp'1998-01-01' THEN 'late' ELSE 'early' END", "string"), "lines": ("concat_ws(':', l_orderkey, l_linenumber)", "string")}
    return project.runtime(table(spark, d, "lineitem"), scripts).select("l_orderkey", "l_linenumber", "unit_price", "late", "lines")


QUERIES = {
    "D4_runtime_script": (d4, "SELECT l_orderkey, l_linenumber, floor(l_extendedprice / l_quantity)::BIGINT AS unit_price, CASE WHEN l_shipdate > TIMESTAMP '1998-01-01' THEN 'late' ELSE 'early' END AS late, l_orderkey || ':' || l_linenumber AS lines FROM lineitem"),
    "R1_snapshot_scan": (r1, "SELECT p_partkey, p_size FROM part"),
    "R2_paged_scan": (r2, "SELECT p_partkey, p_retailprice, (row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1) // 100 AS page, (SELECT count(*) FROM part) AS total FROM part"),
    "R3_keyset": (r3, "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE (l_orderkey, l_linenumber) > (100, 3) GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 500"),
    "R4_flat_scan": (r4, "SELECT * FROM customer"),
    "R5_sliced_scan": (r5, "SELECT o_orderkey % 7 AS slice, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1"),
    "R6_alias_read": (r6, "SELECT p_partkey, p_size FROM part WHERE p_size > 25"),
    "R7_pattern_read": (r7, "SELECT CASE WHEN p_size < 20 THEN 'part-a' ELSE 'part-b' END AS _index, count(*) AS n, count(CASE WHEN p_size >= 20 THEN 1 END) AS sizes, min(p_partkey) AS first FROM part GROUP BY 1"),
    "R8_external_source": (r8, "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000 AND c_mktsegment = 'BUILDING'"),
    "R9_producer_source": (r9, "SELECT CASE WHEN event_id % 7 <> 0 THEN event_id END AS event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type, CASE WHEN event_id % 7 = 0 THEN 'not json ' || event_id END AS _malformed FROM events"),
    "R10_stock_rows": (r10, "SELECT o_orderstatus AS symbol, min(strftime(o_orderdate, '%Y-%m-%d')) AS first, round(sum(round(o_totalprice + 3, 2)) - sum(round(o_totalprice, 2)), 2) AS moved, sum(o_custkey)::BIGINT AS volume FROM orders GROUP BY 1"),
    "F1_include": (f1, """SELECT o_orderkey, o_custkey, '{"o_orderpriority":"' || o_orderpriority || '"}' AS state FROM orders"""),
    "F2_exclude": (f2, """SELECT o_orderkey, '{"o_orderpriority":"' || o_orderpriority || '"}' AS state FROM orders"""),
    "F3_range": (lambda s, d: table(s, d, "lineitem").where(P.in_range(F.col("l_quantity"), gte=10, lt=12) & P.in_range(F.col("l_shipdate"), gt=F.lit("1997-01-01").cast("timestamp"))).groupBy("l_quantity").agg(F.count("*").alias("n")), "SELECT l_quantity, count(*) AS n FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 12 AND l_shipdate > TIMESTAMP '1997-01-01' GROUP BY 1"),
    "F4_term": (lambda s, d: table(s, d, "orders").where(P.term(F.col("o_orderstatus"), "F")).select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'"),
    "F5_terms": (f5, "SELECT o_custkey, count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000) UNION ALL SELECT o_custkey FROM orders WHERE o_custkey IN (1, 2, 3)) GROUP BY 1"),
    "F6_ids": (f6, "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)"),
    "F7_exists": (f7, "SELECT large > 0 AS has_large, cut > 0 AS has_cut, count(*) AS n FROM (SELECT count(CASE WHEN l_quantity > 40 THEN 1 END) AS large, count(CASE WHEN l_discount > 0.09 THEN 1 END) AS cut FROM lineitem GROUP BY l_orderkey) GROUP BY 1, 2"),
    "F8_bool": (f8, "SELECT p_partkey, p_brand FROM part WHERE (p_size > 40)::INT + (p_retailprice > 950)::INT + (p_type = 'ECONOMY')::INT >= 2 AND p_brand <> 'Brand#2'"),
    "F9_match_all": (lambda s, d: table(s, d, "nation").where(P.match_all()), "SELECT * FROM nation"),
    "F11_relative_date": (lambda s, d: table(s, d, "events").where(P.older_than(F.col("ts"), "2024-01-10 00:00:00", 86400)).groupBy("event_type").agg(F.count("*").alias("n")), "SELECT event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-09' GROUP BY 1"),
    "F12_collapse": (f12, "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1"),
    "F13_runtime_field": (f13, "SELECT CASE WHEN p_retailprice < 950 THEN 'budget' WHEN p_retailprice < 1000 THEN 'mid' ELSE 'premium' END AS price_tier, p_size > 40 AS is_large, count(*) AS n FROM part GROUP BY 1, 2"),
    "F14_copy_to": (f14, "SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_size) AS all_text FROM part"),
    "F15_field_alias": (lambda s, d: project.alias(part(s, d), "price", "p_retailprice").select("p_partkey", "price"), "SELECT p_partkey, p_retailprice AS price FROM part"),
    "F16_constant": (lambda s, d: project.constant(part(s, d), "env", "prod").select("p_partkey", "env"), "SELECT p_partkey, 'prod' AS env FROM part"),
    "F17_multi_field": (f17, "SELECT length(text) <= 256 AS kept, count(*) AS n FROM documents GROUP BY 1"),
    "F18_ignored": (lambda s, d: project.ignored(part(s, d), ["p_retailprice", "p_size"]), "SELECT p_partkey, p_name, p_brand, p_type FROM part"),
    "F19_range_containment": (f19, "SELECT name, count(*) AS n, max(l_quantity) AS most FROM lineitem, (VALUES ('small', NULL, 10.0), ('middle', 8.0, 30.0), ('large', 30.0, NULL)) r(name, lo, hi) WHERE (lo IS NULL OR l_quantity >= lo) AND (hi IS NULL OR l_quantity <= hi) GROUP BY 1"),
    "F20_wildcard": (f20, "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%re_ w%'"),
    "F21_nested": (f21, "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45 AND l_discount >= 0.09"),
    "F22_flattened": (f22, "SELECT event_id, props->>'$.k' AS k, array_to_string(json_keys(props), ',') AS keys FROM events WHERE (props->>'$.k')::INT > 90"),
    "F19_date_ranges": (f19_dates, "SELECT strftime(d, '%Y-%m-%d') AS name, count(*) AS n FROM events, (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS d FROM events) WHERE ts::TIMESTAMP >= d AND ts::TIMESTAMP <= d + INTERVAL 36 HOUR GROUP BY 1"),
    "F22_flattened_depth": (f22_depth, "SELECT event_id, 'a.b,a.d,' || array_to_string(list_transform(json_keys(props), lambda k: 'e.' || k), ',') || ',f' AS keys FROM events"),
    "K1_sort": (lambda s, d: search.top(table(s, d, "orders"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 50).select("o_orderkey"), "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50"),
    "K2_max_docs": (lambda s, d: search.top(table(s, d, "orders"), [F.col("o_orderkey")], 25).select("o_orderkey", "o_custkey"), "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 25"),
    "K4_latest": (lambda s, d: search.latest(table(s, d, "events").select(F.concat(F.lit("logs-"), F.date_format("ts", "yyyy.MM.dd")).alias("name")), "name", "logs-%"), "SELECT max('logs-' || strftime(ts, '%Y.%m.%d')) AS latest FROM events"),
    "K5_vector_top_k": (k5, "SELECT query_id, vec_id, round(s, 4) AS score FROM (SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, e.vec_id) AS rn FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0) WHERE rn <= 5"),
    "K6_completion": (k6, "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 're%' ORDER BY p_retailprice DESC, p_partkey LIMIT 10"),
    "K6_prefix_index": (k6_index, K6_INDEX),
    "K7_version_order": (k7, "SELECT p_partkey, p_size || '.' || p_partkey % 13 || '.1' AS version FROM part ORDER BY p_size DESC, p_partkey % 13 DESC, p_partkey LIMIT 20"),
    "U1_pattern_union": (lambda s, d: readers.pattern_union(generations(s, d), "part-*").select("p_partkey", "p_name", F.coalesce("p_size", F.lit(-1)).alias("p_size"), "_index"), "SELECT p_partkey, p_name, CASE WHEN p_size >= 20 THEN p_size ELSE -1 END AS p_size, CASE WHEN p_size < 20 THEN 'part-a' ELSE 'part-b' END AS _index FROM part"),
    "U2_key_sets": (u2, "SELECT c_custkey AS k, 'only customers' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT c_custkey, 'both' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)"),
}
