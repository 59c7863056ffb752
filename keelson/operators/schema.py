"""Schema operators: typed reads, merges, profiles, dynamic templates, conforming and evolution."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Index type names and the Spark types they are stored as: fixed values.
SPARK_TYPES = {
    "text": "string", "keyword": "string", "wildcard": "string", "constant_keyword": "string", "version": "string", "ip": "string", "semantic_text": "string", "completion": "string",
    "long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint", "double": "double", "float": "float", "boolean": "boolean", "date": "timestamp",
    "binary": "binary", "dense_vector": "array<float>", "flattened": "map<string,string>", "geo_point": "struct<lat:double,lon:double>", "geo_shape": "string",
    "integer_range": "struct<gte:int,lte:int>", "long_range": "struct<gte:bigint,lte:bigint>", "float_range": "struct<gte:float,lte:float>", "double_range": "struct<gte:double,lte:double>",
    "date_range": "struct<gte:timestamp,lte:timestamp>", "ip_range": "struct<gte:string,lte:string>", "join": "struct<name:string,parent:string>", "token_count": "int",
    "rank_feature": "double", "rank_features": "map<string,double>", "histogram": "struct<values:array<double>,counts:array<bigint>>", "search_as_you_type": "string", "percolator": "string", "raw": "variant",
}


def struct(fields: dict[str, str]) -> T.StructType:
    """A struct type from field name -> index type; the index type is kept as field metadata."""
    out = T.StructType()
    for name, kind in fields.items():
        out.add(T.StructField(name, T.DataType.fromDDL(SPARK_TYPES[kind]), True, {"index_type": kind}))
    return out


def typed_read(rows: DataFrame, json_col: str, fields: dict[str, str]) -> DataFrame:
    """Typed columns from JSON objects; a value that doesn't fit is null, and `malformed` counts those of a row."""
    raw = F.from_json(json_col, ", ".join(f"`{f}` string" for f in fields))
    rows = rows.withColumn("_raw", raw)
    bad, out = F.lit(0), []
    for name, kind in fields.items():
        value = F.col(f"_raw.{name}")
        typed = value.try_cast(SPARK_TYPES[kind])
        bad = bad + (value.isNotNull() & typed.isNull()).cast("int")
        out.append(typed.alias(name))
    return rows.select(*[c for c in rows.columns if c not in ("_raw", *fields)], *out, bad.alias("malformed"))


def additive_merge(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Columns and nested fields that the target lacks are added from the source; what it has wins unless null."""
    s = source.select(F.col(key), *[F.col(c).alias(f"_s_{c}") for c in source.columns if c != key])
    j = target.join(s, key, "left")

    def merged(have: Column, got: Column, a: T.DataType, b: T.DataType) -> Column:
        if isinstance(a, T.StructType) and isinstance(b, T.StructType):
            names = {f.name for f in a.fields}
            parts = [merged(have[f.name], got[f.name], f.dataType, b[f.name].dataType).alias(f.name) if f.name in b.names else have[f.name].alias(f.name) for f in a.fields]
            return F.struct(*parts, *[got[f.name].alias(f.name) for f in b.fields if f.name not in names])
        return F.coalesce(have, got)

    out = []
    for c in target.columns:
        both = c != key and c in source.columns
        out.append(merged(F.col(c), F.col(f"_s_{c}"), target.schema[c].dataType, source.schema[c].dataType).alias(c) if both else F.col(c))
    return j.select(*out, *[F.col(f"_s_{c}").alias(c) for c in source.columns if c not in target.columns])


def value_type(v: Column) -> Column:
    """The detected type of a variant value: long, double, boolean, date or string, object or array; null for a null."""
    kind = F.schema_of_variant(v)
    text = F.when(kind == "STRING", v.try_cast("string"))
    return (
        F.when(kind == "BIGINT", "long").when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "double").when(kind == "BOOLEAN", "boolean").when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
        .when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9:.]+Z?)?$"), "date").when(kind == "STRING", "string")
    )


def _at(path: Column, v: Column) -> Column:
    return F.struct(path.alias("path"), v.alias("v"))


def _elements(entries: Column) -> Column:
    """Arrays among entries (path, v) replaced by their elements, which have the same path."""
    return F.flatten(F.transform(entries, lambda e: F.when(F.schema_of_variant(e["v"]).startswith("ARRAY"), F.transform(e["v"].try_cast("array<variant>"), lambda x: _at(e["path"], x))).otherwise(F.array(_at(e["path"], e["v"])))))


def _members(entries: Column, prefix: Callable[[Column, Column], Column]) -> Column:
    """The fields of the objects among entries."""
    objects = F.filter(entries, lambda e: F.schema_of_variant(e["v"]).startswith("OBJECT"))
    return F.flatten(F.transform(objects, lambda e: F.transform(F.map_entries(e["v"].try_cast("map<string,variant>")), lambda m: _at(prefix(e["path"], m["key"]), m["value"]))))


def profile(rows: DataFrame, json_col: str, depth: int = 1) -> DataFrame:
    """field, type, n, fill: detected types of dynamic fields, the rows that have them, and their share of all rows.

    Fields of objects down to `depth` levels have dotted names; beyond one level arrays are looked through (also arrays in
    an array, two deep), so the fields of their objects count, once a row.  A null has no type; a text that is no JSON
    object or that repeats a key has no fields.  A row's fields are found in one pass over its text.
    """
    total = F.broadcast(rows.agg(F.count("*").alias("_total")))
    level = _members(F.array(_at(F.lit(""), F.try_parse_json(json_col))), lambda _, key: key)
    found = []
    for _ in range(depth):
        level = level if depth == 1 else _elements(_elements(level))
        found.append(F.transform(level, lambda e: F.struct(e["path"].alias("field"), value_type(e["v"]).alias("type"))))
        level = _members(level, lambda path, key: F.concat_ws(".", path, key))
    pairs = rows.select(F.explode(F.array_distinct(F.flatten(F.array(*found)))).alias("f")).where("f.type IS NOT NULL").select("f.*")
    return pairs.groupBy("field", "type").agg(F.count("*").alias("n")).crossJoin(total).select("field", "type", "n", F.round(F.col("n") / F.col("_total"), 4).alias("fill"))


def _glob(c: Column, pattern: str) -> Column:
    return c.rlike("^(?s:" + ".*".join(map(re.escape, pattern.split("*"))) + ")$")


def dynamic_templates(fields: DataFrame, templates: list[dict[str, str]]) -> DataFrame:
    """`assigned`: the type of the first template that fits, else the detected type.

    A template fits if all that it names does: match and unmatch (the last part of the name), path_match and path_unmatch
    (the whole dotted name), in which * stands for any characters, and match_mapping_type and unmatch_mapping_type (the detected type).
    """
    name = F.substring_index("field", ".", -1)
    tests = {
        "match": lambda p: _glob(name, p), "unmatch": lambda p: ~_glob(name, p), "path_match": lambda p: _glob(F.col("field"), p), "path_unmatch": lambda p: ~_glob(F.col("field"), p),
        "match_mapping_type": lambda t: F.lit(t == "*") | (F.col("type") == t), "unmatch_mapping_type": lambda t: F.col("type") != t,
    }
    out = F.lit(None).cast("string")
    for t in reversed(templates):
        hit = F.lit(True)
        for key, test in tests.items():
            if key in t:
                hit = hit & test(t[key])
        out = F.when(hit, F.lit(t["type"])).otherwise(out)
    return fields.withColumn("assigned", F.coalesce(out, F.col("type")))


def conform(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Project to a schema: rename, cast (null where it doesn't fit), add nulls, drop extras."""
    old = {v: k for k, v in (renames or {}).items()}
    return df.select(*[(F.col(old.get(f.name, f.name)).try_cast(f.dataType) if old.get(f.name, f.name) in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of two schema generations; columns that one lacks read as null."""
    return old.unionByName(new, allowMissingColumns=True)
