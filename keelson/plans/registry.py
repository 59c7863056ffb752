"""All registered queries of the library and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keelson.plans import q_analyze, q_enrich, q_misc, q_scan, q_stream, q_tables, q_writes

MODULES = (q_writes, q_scan, q_tables, q_enrich, q_misc, q_stream, q_analyze)
Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {name: q for m in MODULES for name, (q, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
