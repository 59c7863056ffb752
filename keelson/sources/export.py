"""Newline JSON for other systems: action logs, custom bodies and trace intake lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def header(action: Column, index: Column | None, id_: Column | None) -> Column:
    """{"action":{"_index":..,"_id":..}} with what is null left out."""
    fields = F.struct(*[c.alias(n) for n, c in (("_index", index), ("_id", id_)) if c is not None])
    return F.concat(F.lit('{"'), action, F.lit('":'), F.to_json(fields), F.lit("}"))


def action_lines(rows: DataFrame, action: Column, index: Column | None, id_: Column, body: Column, keep: list[str]) -> DataFrame:
    """Two lines for each row (line 0: header, line 1: body; a delete has no body), with the columns `keep`.

    `body` is any string column: to_json(struct(...)) or the caller's own serialisation.  An update wraps it.
    """
    wrapped = F.when(action == "update", F.concat(F.lit('{"doc":'), body, F.lit(',"doc_as_upsert":true}'))).otherwise(body)
    lines = F.when(action == "delete", F.array(header(action, index, id_))).otherwise(F.array(header(action, index, id_), wrapped))
    return rows.select(*keep, F.posexplode(lines).alias("line_no", "line"))


def trace_lines(rows: DataFrame, kind: str, fields: list[str], keep: list[str]) -> DataFrame:
    """One {"kind":{...}} line for each row."""
    return rows.select(*keep, F.concat(F.lit(f'{{"{kind}":'), F.to_json(F.struct(*fields)), F.lit("}")).alias("line"))


def metadata_line(name: str, agent: str) -> Column:
    """The first line of a trace file; characters outside [a-zA-Z0-9 _-] of the name become _."""
    clean = F.regexp_replace(F.lit(name), "[^a-zA-Z0-9 _-]", "_")
    return F.concat(F.lit('{"metadata":{"service":{"name":"'), clean, F.lit(f'","agent":{{"name":"{agent}"}}}}}}}}'))


def write_lines(lines: DataFrame, path: str, order: list[str]) -> None:
    """Write the column `line` as text; each file holds its lines in order."""
    lines.sortWithinPartitions(*order).select("line").write.mode("append").text(path)
