"""Collapse, range matching, top-k, completion, vectors and stored queries."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.operators import grid
from keelson.sources import tables

#: Cells of a field's bounds in which many stored ranges are looked up.
CELLS = 4096
#: Keys over which rows are dealt that meet queries which any row may satisfy.
SALTS = 64
#: Clauses of a query up to which a match is judged clause by clause.
UNROLLED = 8
#: Pairs of a row and an entry that a task judges, about, and the most tasks to which pairs are dealt.
PAIRS, TASKS = 2**25, 4096


def collapse(df: DataFrame, field: str, order: list[Column]) -> DataFrame:
    """The first row of each value of a field; tasks keep one row a value before anything is shuffled (WindowGroupLimit)."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(field).orderBy(*order))).where("_rn = 1").drop("_rn")


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows of a total order; each task keeps n rows only."""
    return df.orderBy(*order).limit(n)


def latest(names: DataFrame, column: str, pattern: str) -> DataFrame:
    return names.where(F.col(column).like(pattern)).agg(F.max(column).alias("latest"))


def version_key(version: Column) -> Column:
    """Dotted versions in number order; parts that are no numbers count as 0."""
    return F.transform(F.split(version, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(0)))


def number(c: Column, kind: str) -> Column:
    """A column of numbers, dates or times as a double that keeps their order."""
    return F.unix_micros(c.cast("timestamp")).cast("double") if kind in ("date", "timestamp", "timestamp_ntz") else c.cast("double")


def _finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def _cell(c: Column, low: float | Column, width: float | Column) -> Column:
    """The cell of a double: -1 below the bounds, CELLS above them and for NaN, which sorts above every number."""
    at = F.floor((c - low) / width)
    return F.when(F.isnan(c), CELLS).otherwise(F.greatest(F.lit(-1), F.least(F.lit(CELLS), at))).cast("int")


def range_match(rows: DataFrame, value: str, ranges: DataFrame, most: int = 10_000) -> DataFrame:
    """Each row with every stored range (name, gte, lte; an open end is null) that holds its value; null values are in none.

    The ranges are a stated set: up to `most` are broadcast; more are cut at their ends into disjoint cells first, so
    that rows find theirs by an equi-join on the cell.  Both give the same rows, for numbers, dates and times.  NaN is
    above every number, as in Spark's order, so it is in ranges that are open above.
    """
    if clash := {"name", "gte", "lte"} & set(rows.columns):
        raise ValueError(f"rename the columns {sorted(clash)} of the rows, which ranges have too")
    inside = (F.col("gte").isNull() | (F.col(value) >= F.col("gte"))) & (F.col("lte").isNull() | (F.col(value) <= F.col("lte"))) & F.col(value).isNotNull()
    if ranges.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(ranges), inside, "inner")
    low, high = (number(F.col(c), ranges.schema[c].dataType.simpleString()) for c in ("gte", "lte"))
    bounds = ranges.agg(F.min(F.least(_finite(low), _finite(high))).alias("lo"), F.max(F.greatest(_finite(low), _finite(high))).alias("hi")).first()
    lo = bounds["lo"] or 0.0
    width = max(1e-12, ((bounds["hi"] or 0.0) - lo) / CELLS)
    first = F.when(F.col("gte").isNull(), -1).otherwise(_cell(low, lo, width))
    last = F.when(F.col("lte").isNull(), CELLS).otherwise(_cell(high, lo, width))
    cells = ranges.where(first <= last).withColumn("_cell", F.explode(F.sequence(first, last)))
    own = _cell(number(F.col(value), rows.schema[value].dataType.simpleString()), lo, width)
    return rows.where(F.col(value).isNotNull()).withColumn("_cell", own).join(cells, "_cell").where(inside).drop("_cell")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0).cast("double"), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0).cast("double"), lambda s, x: s + x))


SIMILARITY = {"cosine": cosine, "dot_product": dot, "l2_norm": lambda a, b: 1 / (1 + l2(a, b) * l2(a, b))}


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of rows, summed from left to right as `dot` does, so equal vectors get equal scores."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


def vector_top(rows: DataFrame, queries: DataFrame, id_col: str, vector_col: str, n: int = 5, side: int = grid.SIDE) -> DataFrame:
    """query_id, id, score: the n rows most similar (cosine) to each row of `queries`; ties go to the lowest id, nulls last.

    Both sides are written once and meet in tiles (see grid), each of which keeps n rows for each of its queries; the
    driver holds no vector.  A product of matrices picks what can be among the n best, and only that is scored in the
    order of `dot`.  Null and zero vectors, null or non-finite components and other lengths than the query's have no
    similarity and are left out.
    """
    ok = F.forall(vector_col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(vector_col, lambda x: x != 0)
    plain = [F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")]
    sides = [tables.pinned(df.where(F.col(vector_col).isNotNull() & ok).select(*plain), name)[0] for df, name in ((queries, "queries"), (rows, "vectors"))]
    found = grid.tiled(*sides, _nearest(n), "query long, query_id long, row long, id long, score double", side=side)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row"))
    return found.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n).select("query_id", "id", "score")


def _nearest(n: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        theirs, parts = {v.shape[1]: (at, v) for at, v in grid.by_width(rows.column("v"))}, []
        for at, q in grid.by_width(queries.column("v")):
            if q.shape[1] in theirs:
                parts.append(width(queries.take(pa.array(at)), q, rows.take(pa.array(theirs[q.shape[1]][0])), theirs[q.shape[1]][1]))
        return pa.concat_tables(parts) if parts else pa.table({"query": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "row": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    def width(queries: pa.Table, q: np.ndarray, rows: pa.Table, v: np.ndarray) -> pa.Table:
        none, ids, row = np.asarray(rows.column("id").is_null().to_numpy(), bool), rows.column("id").fill_null(0).to_numpy(), rows.column("row").to_numpy()
        qq, vv = _dots(q, q), _dots(v, v)
        unit_q, unit_v = q / np.sqrt(qq)[:, None], v / np.sqrt(vv)[:, None]
        best_q, best_v, best_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        bar = np.full(len(q), -2.0)
        for x in range(0, len(q), 256):
            for y in range(0, len(v), 4096):
                near = unit_q[x : x + 256] @ unit_v[y : y + 4096].T
                low = np.partition(near, -n, axis=1)[:, -n] if near.shape[1] > n else np.full(len(near), -2.0)
                i, j = np.nonzero(near >= (np.maximum(low, bar[x : x + 256]) - 1e-9)[:, None])
                i, j = i + x, j + y
                scores = np.concatenate([_dots(q[i[k : k + 50_000]], v[j[k : k + 50_000]]) / np.sqrt(qq[i[k : k + 50_000]] * vv[j[k : k + 50_000]]) for k in range(0, len(i), 50_000)]) if len(i) else np.zeros(0)
                best_q, best_v, best_s = np.concatenate([best_q, i]), np.concatenate([best_v, j]), np.concatenate([best_s, scores])
                kept = grid.first_of_each(best_q, n, -best_s, none[best_v], ids[best_v], row[best_v])
                best_q, best_v, best_s = best_q[kept], best_v[kept], best_s[kept]
                worst = np.full(len(q), 2.0)
                np.minimum.at(worst, best_q, best_s)
                full = np.bincount(best_q, minlength=len(q)) == n
                bar[full] = worst[full]
        take = queries.take(pa.array(best_q))
        return pa.table({"query": take.column("row"), "query_id": take.column("id"), "row": pa.array(row[best_v]), "id": pa.array(ids[best_v], mask=none[best_v]), "score": pa.array(best_s)})

    return run


def complete(df: DataFrame, text_col: str, prefix: str, order: list[Column], n: int) -> DataFrame:
    """The best n rows whose text starts with one prefix (case kept), by a scan."""
    return top(df.where(F.col(text_col).startswith(prefix)), order, n)


@dataclass(frozen=True)
class Completions:
    """An index of prefixes: `tops` has the best rows of each prefix of up to `depth` characters, with prefix and rank;
    `stems` has every row with the first `depth` characters of its text, for longer prefixes."""

    tops: DataFrame
    stems: DataFrame
    text: str
    order: list[Column]
    n: int
    depth: int


def _ranked(df: DataFrame, by: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each value of `by` with their rank; tasks keep n rows a value before anything is shuffled."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= n)


def completions(df: DataFrame, text_col: str, order: list[Column], n: int = 10, depth: int = 8) -> Completions:
    """Index the rows of `df` for completion; `order` is total, rows without a text are left out.

    First the best n rows of each stem (the first `depth` characters) are found; what is best for a shorter prefix is
    among those, so only they are entered under their prefixes.  No prefix gathers more than n rows of a task.
    """
    stems = df.where(F.col(text_col).isNotNull()).withColumn("_stem", F.substring(text_col, 1, depth))
    best = _ranked(stems, "_stem", order, n).drop("rank")
    prefixes = best.withColumn("prefix", F.explode(F.transform(F.sequence(F.lit(0), F.length("_stem")), lambda k: F.substring(F.col("_stem"), F.lit(1), k)))).drop("_stem")
    return Completions(_ranked(prefixes, "prefix", order, n), stems, text_col, order, n, depth)


def completed(index: Completions, prefixes: DataFrame) -> DataFrame:
    """prefix, rank and the columns of the best rows for every different prefix of the column `prefix`, in one join.

    Prefixes longer than the index is deep meet the rows of their stem and are checked there.
    """
    wanted = prefixes.select("prefix").where("prefix IS NOT NULL").distinct()
    short = index.tops.join(wanted.where(F.length("prefix") <= index.depth), "prefix")
    stems = wanted.where(F.length("prefix") > index.depth).select(F.col("prefix").alias("_prefix"), F.substring("prefix", 1, index.depth).alias("_stem"))
    long = index.stems.join(stems, "_stem").where(F.col(index.text).startswith(F.col("_prefix"))).withColumnRenamed("_prefix", "prefix").drop("_stem")
    return short.unionByName(_ranked(long, "prefix", index.order, index.n))


def stored_queries(rows: DataFrame, queries: DataFrame, fields: list[str], most: int = 10_000, name: str = "query_id") -> DataFrame:
    """Each row with the id (column `name`) of every stored query that it satisfies.

    `queries` has a row a clause: query_id, field, lo, hi, value and, if wanted, occur (must, which is the default, should
    or must_not) and minimum_should_match, the same in all rows of a query (null: 1 for a query of should clauses without a must, else 0).
    Null parts of a clause don't bind; one without any holds for every row; one on a field that isn't among `fields` for
    none.  NaN is above every number.

    Each query is entered in an index under the clause that fewest rows meet: a must clause (a range together with a value that
    is needed too), or as many of its should clauses as a row can't all miss.  Entries carry their query's clauses, so a row is shuffled once, to its values and cells,
    and is judged where it meets an entry by counting the clauses that it meets; wide clauses are never expanded to pairs.
    Rows and clauses meet as plain columns, as all the time goes into pairs if queries and rows are many.
    The index is broadcast if it is counted and small, else both sides are dealt out by counted pairs; both ways give the same rows.
    """
    if name in rows.columns:
        raise ValueError(f"the rows have a column {name}: pass another name")
    index = _QueryIndex(rows, queries, fields, most)
    entries, _ = tables.pinned(index.entries(), "query-entries")
    used = {r["_field"] for r in entries.select("_field").distinct().collect()}
    on, keyed = ["_cell", "_value", "_field"], index.keyed(used)
    found = keyed.join(F.broadcast(entries), on) if entries.count() <= most * 4 else _dealt(keyed, entries, on)
    return found.where(index.met()).select(*[F.col(f"_row{i}").alias(c) for i, c in enumerate(rows.columns)], F.col("_query").alias(name))


def _dealt(rows: DataFrame, entries: DataFrame, on: list[str]) -> DataFrame:
    """Rows joined with the entries (pinned) of their key, in tasks of about as many pairs.

    Pairs are counted by key first, as neither side's size tells how many there will be.  A key with over a quarter of a
    task's share is cut into tiles: its rows into `_rows` parts, its entries into `_entries`, by the sizes of both.
    """
    counts = rows.groupBy(*on).agg(F.count("*").alias("r")).join(entries.groupBy(*on).agg(F.count("*").alias("e")), on)
    counts, _ = tables.pinned(counts.withColumn("pairs", F.col("r").cast("double") * F.col("e")), "query-pairs")
    total = counts.agg(F.sum("pairs")).first()[0] or 0.0
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(math.ceil(total / PAIRS), TASKS))
    tiles, r, e = F.ceil(F.col("pairs") / max(1.0, total / parts / 4)), F.col("r"), F.col("e")
    cut = F.least(r, F.greatest(F.lit(1), F.ceil(F.sqrt(tiles * r / e))))
    hot = counts.where(tiles > 1).select(*on, cut.cast("int").alias("_rows"), F.least(e, F.ceil(tiles / cut)).cast("int").alias("_entries"))  # 4 keys a task at most
    if not hot.isEmpty():

        def tiled(df: DataFrame, cut: str, other: str) -> DataFrame:
            part = F.pmod(F.monotonically_increasing_id(), F.coalesce(cut, F.lit(1))).cast("int")
            every = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
            return df.join(F.broadcast(hot), on, "left").withColumn(f"_in{cut}", part).withColumn(f"_in{other}", every).drop(cut, other)

        rows, entries, on = tiled(rows, "_rows", "_entries"), tiled(entries, "_entries", "_rows"), [*on, "_in_rows", "_in_entries"]
    return rows.repartition(parts, *on).join(entries.repartition(parts, *on).hint("merge"), on)


def stored_counts(rows: DataFrame, queries: DataFrame, fields: list[str], most: int = 10_000, name: str = "query_id") -> DataFrame:
    """How many rows satisfy each stored query (column `name`, n), as counting the rows of `stored_queries` would say.

    A query of one range is counted by the ranks of its ends among the values of its field, one of a value by the value's
    count: no pair is made, so this grows as rows and queries do.  Queries of several clauses are matched and counted.
    """
    index = _QueryIndex(rows, queries, fields, most)
    one = (F.col("_musts") + F.size("_clauses") == 1) & (((F.col("_musts") == 1) & (F.col("_least") <= 0)) | ((F.col("_shoulds") == 1) & (F.col("_least") == 1)))
    plain = index.queries.where(one & F.col("_query").isNotNull()).select("_query").join(index.clauses.where("kind <> 'value' OR (lo IS NULL AND hi IS NULL)"), "_query")
    plain, _ = tables.pinned(plain.select("_query", "field", "lo", "hi", "value", "kind"), "plain-queries")
    value = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value")) for f in index.exact] or [F.lit(None).cast("struct<field:string,value:string>")]))
    values = rows.select(value.alias("v")).select("v.*").where("value IS NOT NULL").groupBy("field", "value").agg(F.count("*").alias("n"))
    by_value = plain.where("kind = 'value'").select("_query", "field", "value").join(values, ["field", "value"]).select("_query", "n")
    by_any = plain.where("kind = 'any'").select("_query").crossJoin(rows.agg(F.count("*").alias("n")))
    counts = by_value.unionByName(by_any).unionByName(_ranged(rows, plain.where("kind = 'range'"), list(index.spans)))
    others = queries.join(plain.select(F.col("_query").alias("query_id")), "query_id", "left_anti").where("query_id IS NOT NULL")
    if not others.isEmpty():
        matched = stored_queries(rows, others, fields, most, "_query" if name in rows.columns else name)
        counts = counts.unionByName(matched.groupBy(F.col(matched.columns[-1]).alias("_query")).agg(F.count("*").alias("n")))
    return counts.where("n > 0").select(F.col("_query").alias(name), "n")


def _ranged(rows: DataFrame, ranges: DataFrame, fields: list[str]) -> DataFrame:
    """_query, n of queries of one range (lo, hi): rows up to hi less those below lo, by running counts over a sorted table.

    Values come counted, and sort between low ends and high ends that are equal to them; an open low end is null and an open high
    one NaN, which are first and last in Spark's order.
    """
    number = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").try_cast("double").alias("x")) for f in fields] or [F.lit(None).cast("struct<field:string,x:double>")]))
    values = rows.select(number.alias("v")).select("v.*").where("x IS NOT NULL").groupBy("field", "x").agg(F.count("*").alias("n"))
    end = lambda x, side: F.struct(x.alias("x"), F.lit(side).alias("side"))
    ends = ranges.select("field", "_query", F.explode(F.array(end(F.col("lo"), 0), end(F.coalesce("hi", F.lit(float("nan"))), 2))).alias("e")).select("field", "e.x", "e.side", F.lit(0).cast("long").alias("n"), "_query")
    places = values.select("field", "x", F.lit(1).alias("side"), "n", F.lit(None).cast(ranges.schema["_query"].dataType).alias("_query")).unionByName(ends)
    order = ["field", "x", "side", "_query"]
    dealt, _ = tables.pinned(places.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "query-ends")
    before = F.sum("all").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row a partition
    starts = dealt.groupBy("_part").agg(F.sum("n").alias("all")).select("_part", F.coalesce(before, F.lit(0)).alias("start"))
    running = F.sum("n").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = dealt.withColumn("upto", running).where("side <> 1").join(F.broadcast(starts), "_part").select("_query", F.when(F.col("side") == 0, -F.col("upto") - F.col("start")).otherwise(F.col("upto") + F.col("start")).alias("upto"))
    return ranked.groupBy("_query").agg(F.sum("upto").alias("n"))


def _both(ranged: str, exact: str) -> str:
    """The key's field of a range that is entered together with a value that the same query needs."""
    return f"{ranged}\0{exact}"


def _key(field: str, value: Column, cell: Column) -> Column:
    return F.struct(F.lit(field).alias("_field"), value.alias("_value"), cell.cast("int").alias("_cell"))


def _looked_up(rows: DataFrame, keys: list[Column], *columns: Column) -> DataFrame:
    """`columns` of each row with each of its keys that isn't null."""
    every = F.array(*keys) if keys else F.array().cast("array<struct<_field:string,_value:string,_cell:int>>")
    return rows.select(*columns, F.explode(every).alias("_key")).where("_key IS NOT NULL").select("*", "_key.*").drop("_key")


class _QueryIndex:
    """The clauses of stored queries, how rare they are in the rows, and where each query is entered."""

    def __init__(self, rows: DataFrame, queries: DataFrame, fields: list[str], most: int):
        self.rows, self.fields = rows, fields
        given = lambda c, kind: F.col(c).cast(kind) if c in queries.columns else F.lit(None).cast(kind)
        self.clauses = queries.select(
            F.col("query_id").alias("_query"), F.coalesce(given("occur", "string"), F.lit("must")).alias("occur"), F.col("field"), F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"),
            F.col("value").cast("string").alias("value"), given("minimum_should_match", "int").alias("least"), F.monotonically_increasing_id().alias("clause"),
        )
        self.clauses, _ = tables.pinned(self.clauses, "clauses")
        sizes = self.clauses.groupBy("_query").agg(F.count("*").alias("n"), F.count(F.when(F.col("occur") != "must", 1)).alias("others"), F.count(F.when(F.col("occur") == "should", 1)).alias("shoulds")).agg(F.sum("n").alias("all"), F.max("others").alias("most"), F.max("shoulds").alias("shoulds")).first()
        self.few, self.longest, self.shoulds = (sizes["all"] or 0) <= most, sizes["most"] or 0, sizes["shoulds"] or 0
        kind = F.when(F.col("value").isNotNull(), "value").when(F.col("lo").isNull() & F.col("hi").isNull(), "any").otherwise("range")
        at = F.array_position(F.array(*map(F.lit, fields)) if fields else F.array().cast("array<string>"), F.col("field")).cast("int") - 1
        self.clauses = self.clauses.withColumn("kind", F.when(at >= 0, kind).otherwise("never")).withColumn("at", at)
        entered = "occur <> 'must_not'"  # no query is looked up under what must not hold
        spans = self.clauses.where("kind = 'range'").where(entered).groupBy("field").agg(F.min(F.least(_finite(F.col("lo")), _finite(F.col("hi")))).alias("low"), F.max(F.greatest(_finite(F.col("lo")), _finite(F.col("hi")))).alias("high"))
        #: Low end and width of a cell of each ranged field: a row a field of the rows.
        self.spans = {r["field"]: (r["low"] or 0.0, max(1e-12, ((r["high"] or 0.0) - (r["low"] or 0.0)) / CELLS)) for r in spans.collect()}
        within = self.clauses.where("kind <> 'never'")
        has = [F.bool_or(F.col(c).isNotNull()).alias(c) for c in ("lo", "hi", "value")]
        named = {r["field"]: r for r in within.groupBy("field").agg(*has, F.bool_or(F.expr(f"value IS NOT NULL AND {entered}")).alias("exact")).collect()}
        self.exact = [f for f, r in named.items() if r["exact"]]
        texts = [F.col(f"`{f}`").cast("string") if f in named and named[f]["value"] else F.lit(None).cast("string") for f in fields]
        numbers = [F.col(f"`{f}`").try_cast("double") if f in named and (named[f]["lo"] or named[f]["hi"]) else F.lit(None).cast("double") for f in fields]
        self.flat = [(n.alias(f"_n{k}"), t.alias(f"_s{k}")) for k, (n, t) in enumerate(zip(numbers, texts, strict=True))]
        #: What clauses are judged on, in the order of the fields.
        self.has = F.array(*[F.struct(n.alias("num"), t.alias("str")) for n, t in zip(numbers, texts, strict=True)]) if fields else F.array().cast("array<struct<num:double,str:string>>")
        first, last = F.lit(-1), F.lit(CELLS)
        for f, (low, width) in self.spans.items():
            mine = F.col("field") == f
            first = F.when(mine & F.col("lo").isNotNull(), _cell(F.col("lo"), low, width)).otherwise(first)
            last = F.when(mine & F.col("hi").isNotNull(), _cell(F.col("hi"), low, width)).otherwise(last)
        self.clauses = self.clauses.withColumn("first", first).withColumn("last", last)
        must = F.col("occur") == "must"
        others = F.collect_list(F.when(~must, F.struct("clause", "occur", "at", "lo", "hi", "value")))
        count = lambda occur: F.sum((F.col("occur") == occur).cast("int"))
        #: Fields with must clauses, which become one lo, hi and value a field: two values of a field can't both hold.
        self.fixed = {r["at"]: [c for c in ("lo", "hi", "value") if r[c]] for r in within.where(must).groupBy("at").agg(*has).orderBy("at").collect()}
        #: Fields with clauses that must not hold, the parts these bind, and how many of a query there are at most.
        per = within.where("occur = 'must_not'").groupBy("at", "_query").agg(*has, F.count("*").alias("n"))
        self.barred = {r["at"]: ([c for c in ("lo", "hi", "value") if r[c]], r["n"]) for r in per.groupBy("at").agg(*[F.bool_or(c).alias(c) for c in ("lo", "hi", "value")], F.max("n").alias("n")).orderBy("at").collect()}
        #: Whether clauses that must not hold are columns of the entries, as must clauses are.
        self.plain = not self.shoulds and sum(n for _, n in self.barred.values()) <= UNROLLED
        bounds = [F.collect_list(F.when((F.col("occur") == "must_not") & (F.col("at") == k), F.struct("lo", "hi", "value"))).alias(f"_barred{k}") for k in self.barred if self.plain]
        for k in self.fixed:
            of = lambda c, k=k: F.when(must & (F.col("at") == k), F.col(c))
            bounds += [F.max(of("lo")).alias(f"_lo{k}"), F.min(of("hi")).alias(f"_hi{k}"), F.min(of("value")).alias(f"_value{k}"), F.max(of("value")).alias(f"_other{k}")]
        asked = self.clauses.groupBy("_query").agg(others.alias("_clauses"), count("must").alias("_musts"), count("should").alias("_shoulds"), F.max("least").alias("_least"), *bounds)
        for k in self.fixed:
            asked = asked.where(F.col(f"_value{k}").eqNullSafe(F.col(f"_other{k}"))).drop(f"_other{k}")
        for k, (parts, n) in self.barred.items() if self.plain else ():
            own = [F.get(f"_barred{k}", F.lit(i)) for i in range(n)]
            asked = asked.withColumns({f"_bar{k}_{i}": c.isNotNull() for i, c in enumerate(own)} | {f"_bar{k}_{i}_{p}": c[p] for i, c in enumerate(own) for p in parts}).drop(f"_barred{k}")
        self.queries = asked.withColumn("_least", F.coalesce("_least", F.when((F.col("_musts") == 0) & (F.col("_shoulds") > 0), 1).otherwise(0)))

    def values(self, used: set[str] | None = None) -> list[Column]:
        """What a row is looked up by in the exact clauses: its value of each field that has such, of `used` fields only, if given."""
        return [F.when(F.col(f"`{f}`").isNotNull(), _key(f, F.col(f"`{f}`").cast("string"), F.lit(-2))) for f in self.exact if used is None or f in used]

    def cells(self, used: set[str] | None = None) -> list[Column]:
        """The same in ranges: its cell of each field that has such, and the cell together with a value if `used` names both."""
        keys = []
        for f, (low, width) in self.spans.items():
            num = F.col(f"`{f}`").try_cast("double")
            if used is None or f in used:
                keys.append(F.when(num.isNotNull(), _key(f, F.lit(""), _cell(num, low, width))))
            for g in (g for g in self.exact if used and _both(f, g) in used):
                keys.append(F.when(num.isNotNull() & F.col(f"`{g}`").isNotNull(), _key(_both(f, g), F.col(f"`{g}`").cast("string"), _cell(num, low, width))))
        return keys

    def keyed(self, used: set[str]) -> DataFrame:
        """The rows' columns as _row0, _row1 and so on, what clauses are judged on, and a key; an empty name among `used` stands for queries that any row may satisfy."""
        keys = self.values(used) + self.cells(used) + [_key("", F.lit(""), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))] * ("" in used)
        row = [F.col(f"`{c}`").alias(f"_row{i}") for i, c in enumerate(self.rows.columns)]
        judged = [self.has.alias("_has")] * (self.longest > 0 and not self.plain) + [c for k in sorted({*self.fixed, *(self.barred if self.plain else ())}) for c in self.flat[k]]
        return _looked_up(self.rows, keys, *row, *judged)

    def rarity(self) -> DataFrame:
        """clause, rare: how many rows meet an exact clause; for a range the rows of its cells."""
        exact = self.clauses.where("kind = 'value'").select("clause", F.col("field").alias("_field"), F.col("value").alias("_value"))
        values = exact.select("_field", "_value").distinct()
        by_value = _looked_up(self.rows, self.values()).join(values, ["_field", "_value"], "left_semi").groupBy("_field", "_value").agg(F.count("*").alias("rare"))
        of_exact = exact.join(by_value, ["_field", "_value"], "left").select("clause", F.coalesce("rare", F.lit(0)).alias("rare"))
        by_cell = _looked_up(self.rows, self.cells()).groupBy("_field", "_cell").agg(F.count("*").alias("n"))
        named = F.explode(F.array(*map(F.lit, self.spans)).cast("array<string>")).alias("_field")
        every = self.rows.sparkSession.range(1).select(named).select("_field", F.explode(F.sequence(F.lit(-1), F.lit(CELLS))).alias("_cell"))
        running = F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy("_field").orderBy("_cell"))  # CELLS + 2 rows a field
        upto = every.join(by_cell, ["_field", "_cell"], "left").select(F.col("_field").alias("field"), F.struct(F.col("_cell").alias("cell"), running.alias("upto")).alias("s"))
        sums = upto.groupBy("field").agg(F.sort_array(F.collect_list("s"))["upto"].alias("sums"))
        upto = lambda c: F.coalesce(F.get("sums", c + 1), F.lit(0))
        ranges = self.clauses.where("kind = 'range'").join(F.broadcast(sums), "field", "left")
        return of_exact.unionByName(ranges.select("clause", (upto(F.col("last")) - upto(F.col("first") - 1)).alias("rare")))

    def entries(self) -> DataFrame:
        """_query, what its clauses bind (less a value that the key holds) and, with should clauses, their counts, _entry (the number of the clause) and _entered (all such of the query); and the keys under which rows find it."""
        all_rows = F.lit(2**62).cast("long")  # more than any count: a clause without bounds comes last
        known = self.clauses.withColumn("rare", F.lit(None).cast("long")) if self.few else self.clauses.join(self.rarity(), "clause", "left")
        rare = known.withColumn("rare", F.when(F.col("kind") == "never", -1).when(F.col("kind") == "any", all_rows).otherwise(F.coalesce("rare", F.lit(0))))
        place = F.row_number().over(Window.partitionBy("_query", "occur").orderBy("rare", "clause"))
        ranked = rare.withColumn("place", place).join(self.queries.drop("_clauses"), "_query")
        of_must = (F.col("occur") == "must") & (F.col("place") == 1)
        of_should = (F.col("occur") == "should") & (F.col("_musts") == 0) & (F.col("_least") > 0) & (F.col("place") <= F.col("_shoulds") - F.col("_least") + 1)
        chosen = ranked.where((of_must | of_should) & (F.col("kind") != "never"))
        chosen = chosen if self.few else chosen.where(~of_must | (F.col("rare") > 0))  # what no row meets needs no entry
        everywhere = F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda k: F.struct(F.lit("").alias("_field"), F.lit("").alias("_value"), k.cast("int").alias("_cell")))
        needed = [F.when(of_must & F.col(f"_value{k}").isNotNull(), F.struct(F.concat("field", F.lit(_both("", self.fields[k]))).alias("field"), F.col(f"_value{k}").alias("value"))) for k in self.fixed]
        at = F.coalesce(*needed, F.struct("field", F.lit("").alias("value")))
        cells = F.when(F.col("first") <= F.col("last"), F.transform(F.sequence(F.col("first"), F.greatest("first", "last")), lambda k: F.struct(at["field"].alias("_field"), at["value"].alias("_value"), k.alias("_cell"))))
        keys = F.when(F.col("kind") == "value", F.array(F.struct(F.col("field").alias("_field"), F.col("value").alias("_value"), F.lit(-2).alias("_cell")))).when(F.col("kind") == "range", cells).otherwise(everywhere)
        entered = F.collect_list("clause").over(Window.partitionBy("_query"))
        held = F.when(of_must & (F.col("kind") == "value"), F.col("at")).when(of_must & (F.col("kind") == "range"), F.coalesce(*[F.when(F.col(f"_value{k}").isNotNull(), k) for k in self.fixed], F.lit(None)))
        named = chosen.select("_query", F.col("clause").alias("_entry"), entered.alias("_entered"), keys.alias("k"), held.cast("int").alias("_held"))
        open_ = self.queries.where("_musts = 0 AND _least <= 0").select("_query", F.lit(None).cast("long").alias("_entry"), F.array().cast("array<long>").alias("_entered"), everywhere.alias("k"), F.lit(None).cast("int").alias("_held"))
        found = named.unionByName(open_).join(self.queries.where("_least <= _shoulds"), "_query").withColumn("k", F.explode("k"))
        found = found.withColumns({f"_value{k}": F.when(~F.col("_held").eqNullSafe(F.lit(k)), F.col(f"_value{k}")) for k in self.fixed})
        unread = {"k", "_held", "_musts", "_shoulds"} | ({"_clauses"} if self.plain else set()) | (set() if self.shoulds else {"_least", "_entry", "_entered"})
        return found.select(*[c for c in found.columns if c not in unread], "k.*")

    def met(self) -> Column:
        """Whether a candidate row satisfies its query, and was found by the first entry that can find it."""

        def holds(c: Column) -> Column:
            own = F.get("_has", c["at"])
            bound = (c["lo"].isNull() | (own["num"] >= c["lo"])) & (c["hi"].isNull() | (own["num"] <= c["hi"])) & (c["value"].isNull() | (own["str"] == c["value"]))
            return F.coalesce(own.isNotNull() & bound, F.lit(False))

        def bound(k: int, parts: list[str], name: str) -> Column:
            number, text = F.col(f"_n{k}"), F.col(f"_s{k}")
            holds = {"lo": lambda c: number >= c, "hi": lambda c: number <= c, "value": lambda c: text == c}
            return reduce(lambda a, b: a & b, [F.col(name.format(p)).isNull() | holds[p](F.col(name.format(p))) for p in parts], F.lit(True))

        met = reduce(lambda a, b: a & b, [bound(k, parts, f"_{{}}{k}") for k, parts in self.fixed.items()], F.lit(True))
        if self.plain:
            barred = [F.col(f"_bar{k}_{i}") & bound(k, parts, f"_bar{k}_{i}_{{}}") for k, (parts, n) in self.barred.items() for i in range(n)]
            return reduce(lambda a, b: a & ~F.coalesce(b, F.lit(False)), barred, met)
        if self.longest > UNROLLED:
            held = F.filter("_clauses", holds)
            count = lambda occur: F.size(F.filter(held, lambda c: c["occur"] == occur))
            no, should = count("must_not") == 0, count("should")
        else:  # the same clause by clause, which Spark compiles
            own = [F.get("_clauses", F.lit(i)) for i in range(self.longest)]
            of = lambda c, occur: F.coalesce(c["occur"] == occur, F.lit(False)) & holds(c)
            no = reduce(lambda a, b: a & b, [~of(c, "must_not") for c in own])
            should = sum((F.when(of(c, "should"), 1).otherwise(0) for c in own), F.lit(0))
        if not self.shoulds:
            return met & no
        first = F.array_min(F.array_intersect(F.transform(F.filter("_clauses", holds), lambda c: c["clause"]), "_entered"))
        return met & no & ((F.col("_least") <= 0) | (should >= F.col("_least"))) & ((F.size("_entered") <= 1) | first.eqNullSafe(F.col("_entry")))
