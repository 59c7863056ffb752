"""Column sets and derived columns: include, exclude, runtime fields, copies, aliases, constants, multi-fields."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def include(df: DataFrame, fields: list[str]) -> DataFrame:
    """Keep fields; names may hold * and dotted paths keep only that part of a struct."""
    out: list[Column] = []
    for name in df.columns:
        own = [f for f in fields if fnmatch.fnmatchcase(name, f)]
        inner = [f.split(".", 1)[1] for f in fields if f.startswith(f"{name}.")]
        if own:
            out.append(F.col(name))
        elif inner and isinstance(df.schema[name].dataType, T.StructType):
            out.append(F.struct(*[F.col(f"{name}.{i}").alias(i) for i in inner]).alias(name))
    return df.select(*out)


def exclude(df: DataFrame, fields: list[str]) -> DataFrame:
    """Drop fields; names may hold *, dotted paths drop that part of a struct."""
    for f in fields:
        if "." in f:
            head, rest = f.split(".", 1)
            df = df.withColumn(head, F.col(head).dropFields(rest))
        else:
            df = df.drop(*[c for c in df.columns if fnmatch.fnmatchcase(c, f)])
    return df


def runtime(df: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Computed columns: name -> (SQL expression, type)."""
    return df.withColumns({n: F.expr(e).cast(t) for n, (e, t) in fields.items()})


def copy_to(df: DataFrame, sources: list[str], name: str, separator: str = " ") -> DataFrame:
    """Values of several fields under one name; nulls are left out."""
    return df.withColumn(name, F.concat_ws(separator, *[F.col(c).cast("string") for c in sources]))


def alias(df: DataFrame, name: str, path: str) -> DataFrame:
    return df.withColumn(name, F.col(path))


def constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def multi_field(df: DataFrame, field: str, kind: str = "keyword", ignore_above: int = 256) -> DataFrame:
    """`field__kind`: the value, or null when it is longer."""
    return df.withColumn(f"{field}__{kind}", F.when(F.length(field) <= ignore_above, F.col(field)))


def ignored(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)
