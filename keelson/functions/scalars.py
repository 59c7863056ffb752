"""Scalar functions as columns."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often and wherever the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def content_hash(*parts: Column, separator: str = "") -> Column:
    """First 16 hex digits of SHA-256 over the parts; nulls count as nothing."""
    return F.substring(F.sha2(F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, 16)


def schema_hash(text: str) -> str:
    """The hash of a declared schema: 16 hex digits over v1: and the text without blanks."""
    return hashlib.sha256(("v1:" + re.sub(r"\s+", "", text)).encode()).hexdigest()[:16]


def combined_hash(schema: str, content: Column) -> Column:
    """A change of the schema changes every row's hash."""
    return content_hash(F.lit(schema), content)


def cache_key(value: Column) -> Column:
    return F.sha2(value.cast("string"), 256)


def dated_name(target: str, ts: Column, pattern: str = "yyyy.MM.dd") -> Column:
    return F.lower(F.concat(F.lit(f"{target}-"), F.date_format(ts, pattern)))


def renamed(name: str, policy: str) -> str:
    """A field name under camel, snake_lower, snake_upper, kebab_lower or kebab_upper; every capital starts a part."""
    if policy == "camel":
        return name[:1].lower() + name[1:]
    mark = "_" if policy.startswith("snake") else "-"
    parts = re.sub(r"(?<!^)(?=[A-Z])", mark, name)
    return parts.lower() if policy.endswith("lower") else parts.upper()


def rename_all(df: DataFrame, policy: str) -> DataFrame:
    return df.toDF(*[renamed(c, policy) for c in df.columns])


def prompt(*parts: Column) -> Column:
    """Parts in a row; nulls count as nothing."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def response_object(text: Column) -> Column:
    """The JSON object in a model's answer, or null: fences and back-ticks go, and one stray closing brace."""
    edges = r"^[\s`]+|[\s`]+$"
    bare = F.regexp_replace(F.regexp_replace(text, r"(?i)^\s*```(?:json)?", ""), edges, "")
    stray = bare.endswith("}}") & ~bare.contains("{{") & F.try_parse_json(bare).isNull()
    bare = F.when(stray, F.left(bare, F.length(bare) - 1)).otherwise(bare)
    return F.when(bare.startswith("{") & bare.endswith("}"), bare)


def response_fields(text: Column, fields: list[str]) -> list[Column]:
    """The wanted fields of an answer; empty values are null."""
    parsed = F.from_json(response_object(text), ", ".join(f"`{f}` string" for f in fields))
    return [F.when(F.trim(parsed[f]) != "", parsed[f]).alias(f) for f in fields]


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def clean_name(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-zA-Z0-9 _-]", "_")


def stream_name(c: Column) -> Column:
    """struct(type, dataset, namespace) of type-dataset-namespace in lower case; null for forbidden characters."""
    low = F.lower(c)
    part = F.split(low, "-", 3)
    ok = ~low.rlike(r'[\\/*?"<>| ,#:]') & (F.size(part) == 3) & ~F.exists(part, lambda p: p == "")
    return F.when(ok, F.struct(part[0].alias("type"), part[1].alias("dataset"), part[2].alias("namespace")))


def row_bytes(*columns: str) -> Column:
    return F.octet_length(F.to_json(F.struct(*columns)))


def ellipsis(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("…"))).otherwise(c)


def tabular(names: Column, values: Column) -> Column:
    """Column names and one row of values as a map."""
    return F.map_from_arrays(names, values)
