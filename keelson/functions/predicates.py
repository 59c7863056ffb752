"""Predicates as columns.  All of them are safe in filters: null never matches, and negation keeps nulls."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_range(c: Column, gt=None, gte=None, lt=None, lte=None) -> Column:
    """Bounds that are given must hold."""
    out = F.lit(True)
    for value, test in ((gt, c.__gt__), (gte, c.__ge__), (lt, c.__lt__), (lte, c.__le__)):
        if value is not None:
            out = out & test(value)
    return F.coalesce(out & c.isNotNull(), F.lit(False))


def term(c: Column, value) -> Column:
    return F.coalesce(c == value, F.lit(False))


def terms(df: DataFrame, c: str, values: list | DataFrame) -> DataFrame:
    """Rows whose column is among the values: a short list inline, a frame (one column) by semi join."""
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(c)).distinct()
        return df.join(keys, c, "left_semi")
    return df.where(F.col(c).isin(values))


def ids(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def exists(c: Column, is_array: bool = False) -> Column:
    """Present; an empty array, or one of nulls only, counts as missing."""
    return F.coalesce(c.isNotNull() & (F.size(F.array_compact(c)) > 0), F.lit(False)) if is_array else c.isNotNull()


def should(clauses: list[Column], minimum: int = 1) -> Column:
    """At least `minimum` clauses match."""
    total = F.lit(0)
    for c in clauses:
        total = total + F.coalesce(c, F.lit(False)).cast("int")
    return total >= minimum


def must_not(*clauses: Column) -> Column:
    return ~should(list(clauses))


def match_all() -> Column:
    return F.lit(True)


def older_than(ts: Column, now: str, seconds: int) -> Column:
    """ts before now less a span; `now` is always given."""
    return F.coalesce(ts < F.lit(now).cast("timestamp") - F.make_dt_interval(secs=F.lit(seconds)), F.lit(False))


def wildcard(c: Column, pattern: str) -> Column:
    """* is any run, ? one character."""
    translated = "".join({"*": "%", "?": "_", "%": "\\%", "_": "\\_", "\\": "\\\\"}.get(x, x) for x in pattern)
    return F.coalesce(c.like(translated), F.lit(False))


def nested(array: Column, predicate) -> Column:
    """Any element satisfies all conditions together."""
    return F.coalesce(F.exists(array, predicate), F.lit(False))


def flattened(json: Column, key: str) -> Column:
    """The value under a key of a JSON object, as text; nested keys by dots."""
    parts = key.split(".")
    path = "$" + "".join(f"['{p}']" for p in parts)
    if any(re.search(r"['\]]", p) for p in parts):
        raise ValueError(f"unsupported key {key!r}")
    return F.get_json_object(json, path)


def flattened_keys(json: Column, depth_limit: int = 1) -> Column:
    """Keys of a JSON object down to `depth_limit` levels, joined by dots; objects below that count as one value."""
    if depth_limit < 1:
        raise ValueError("at least one level")
    fields = F.map_entries(F.from_json(json, "map<string,string>"))
    if depth_limit == 1:
        return F.transform(fields, lambda e: e["key"])

    def below(e: Column) -> Column:
        inner = flattened_keys(e["value"], depth_limit - 1)
        has = e["value"].startswith("{") & (F.size(inner) > 0)
        return F.when(has, F.transform(inner, lambda k: F.concat(e["key"], F.lit("."), k))).otherwise(F.array(e["key"]))

    return F.flatten(F.transform(fields, below))


def within(value: Column, low: Column, high: Column) -> Column:
    """value inside a stored range; an open end is null."""
    return F.coalesce((low.isNull() | (value >= low)) & (high.isNull() | (value <= high)) & value.isNotNull(), F.lit(False))


def ip(c: Column) -> Column:
    """A valid dotted IPv4 address."""
    octet = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return F.coalesce(c.rlike(rf"^{octet}(\.{octet}){{3}}$"), F.lit(False))
