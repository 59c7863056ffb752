"""Cached column enrichment: stale rows, prompts, model calls, parsing, cache, lookup join, clean-up."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import scalars
from keelson.operators import writes
from keelson.session import ship
from keelson.sources import readers

#: Statuses after which a chunk is halved and sent again: fixed values.
RETRYABLE = (408, 429)


class CompletionError(Exception):
    """A model call failed with a status."""

    def __init__(self, status: int, reason: str = ""):
        super().__init__(reason)
        self.status = status

    @property
    def retryable(self) -> bool:
        return self.status in RETRYABLE or 500 <= self.status <= 599


def prompt_hash(description: str) -> str:
    """The hash stored beside a field: what it was asked with."""
    return hashlib.sha256(description.encode()).hexdigest()[:16]


def is_stale(outputs: Mapping[str, str]) -> Column:
    """Any output missing, or asked with another description (stored in <field>_ph; null differs)."""
    out = F.lit(False)
    for field, description in outputs.items():
        out = out | F.col(field).isNull() | ~F.col(f"{field}_ph").eqNullSafe(F.lit(prompt_hash(description)))
    return out


def candidates(table: DataFrame, outputs: Mapping[str, str], most: int | None = 100, key: str = "_id", after: str | None = None) -> DataFrame:
    """At most `most` stale rows in key order (None: all, in no order), after a key if given."""
    rows = table.where(is_stale(outputs))
    rows = rows.where(F.col(key) > after) if after is not None else rows
    return rows.orderBy(key).limit(most) if most is not None else rows


def chunked(rows: DataFrame, key: str = "_id", size: int = 20) -> DataFrame:
    """`chunk`: groups of `size` rows in key order."""
    return readers.pages(rows, [key], size).withColumnRenamed("page", "chunk").drop("total")


def _schema(outputs: Mapping[str, str]) -> str:
    return "{" + ", ".join(f'"{f}": "{d}"' for f, d in outputs.items()) + "}"


def batch_prompt(inputs: list[str], outputs: Mapping[str, str], role: str) -> Column:
    """Role, task, the schema of all outputs, and the inputs in tags."""
    head = f"{role}\nReturn one JSON object with these fields: {_schema(outputs)}\n"
    return scalars.prompt(F.lit(head), *[p for i in inputs for p in (F.lit(f"<{i}>"), F.col(i), F.lit(f"</{i}>\n"))])


def row_prompt(inputs: list[str], outputs: Mapping[str, str], role: str, required: list[str] | None = None) -> Column:
    """The same with the stale outputs only; null when a required column (all inputs, if not given) is blank or nothing is stale."""
    asked = F.filter(F.array(*[F.when(is_stale({f: d}), F.lit(f'"{f}": "{d}"')) for f, d in outputs.items()]), lambda x: x.isNotNull())
    blank = F.lit(False)
    for i in inputs if required is None else required:
        blank = blank | F.col(i).isNull() | (F.trim(i) == "")
    body = [p for i in inputs for p in (F.lit(f"<{i}>"), F.col(i), F.lit(f"</{i}>\n"))]
    text = scalars.prompt(F.lit(f"{role}\nReturn one JSON object with these fields: {{"), F.array_join(asked, ", "), F.lit("}\n"), *body)
    return F.when(~blank & (F.size(asked) > 0), text)


def complete(rows: DataFrame, fn: Callable[[list[str]], list[str | None]], chunk: int = 20, least: int = 5, levels: int = 2, key: str = "_id", prompt: str = "prompt", deadline: float | None = None, group: str | None = None) -> DataFrame:
    """_id, answer, status (ok, failed or skipped), depth: calls `fn` on chunks of prompts.

    Chunks are runs of rows within each task, which moves no text, or, with `group` (see chunked), the rows of equal
    groups in key order, which don't depend on how the table is dealt out.
    A retryable CompletionError halves the chunk, not below `least` rows and at most `levels` times; any other error
    fails the chunk's rows.  After `deadline` (epoch seconds) rows are skipped.  Calls are not repeatable: persist the
    result before using it twice.
    """
    ship(rows.sparkSession)

    def call(at: list[int], prompts: list[str], depth: int, out: list) -> None:
        import time

        if deadline is not None and time.time() > deadline:
            out += [(i, None, "skipped", depth) for i in at]
            return
        try:
            answers = fn(prompts)
        except CompletionError as e:
            half = len(at) // 2
            if e.retryable and depth < levels and half >= least:
                call(at[:half], prompts[:half], depth + 1, out)
                call(at[half:], prompts[half:], depth + 1, out)
            else:
                out += [(i, None, "failed", depth) for i in at]
            return
        answers = list(answers) + [None] * (len(at) - len(answers))
        out += [(i, a, "ok" if a is not None else "failed", depth) for i, a in zip(at, answers, strict=False)]

    def answered(rows: pa.RecordBatch | pa.Table) -> pa.Table:
        """The keys stay in Arrow, whatever their type; only places and prompts are Python values."""
        prompts, out = rows.column(prompt).to_pylist(), []
        for first in range(0, len(prompts), chunk):
            call(list(range(first, min(first + chunk, len(prompts)))), prompts[first : first + chunk], 0, out)
        at, answers, status, depth = zip(*out, strict=True) if out else ((),) * 4
        keys = rows.column(key).take(pa.array(at, pa.int64()))
        return pa.table({key: keys, "answer": pa.array(answers, pa.string()), "status": pa.array(status, pa.string()), "depth": pa.array(depth, pa.int32())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from answered(batch).to_batches()

    def run_group(table: pa.Table) -> pa.Table:
        return answered(table.sort_by(key).combine_chunks())

    schema = T.StructType([T.StructField(key, rows.schema[key].dataType), *T.StructType.fromDDL("answer string, status string, depth int").fields])
    if group:
        return rows.select(key, prompt, group).groupBy(group).applyInArrow(run_group, schema)
    return rows.select(key, prompt).mapInArrow(run, schema)


def parse(answers: DataFrame, outputs: Mapping[str, str], key: str = "_id") -> DataFrame:
    """Fields and their prompt hashes from answers; `parsed` is false where no object or no wanted field was found."""
    found = answers.select(key, *scalars.response_fields(F.col("answer"), list(outputs)))
    hashed = found.select(key, *[c for f, d in outputs.items() for c in (F.col(f), F.when(F.col(f).isNotNull(), prompt_hash(d)).alias(f"{f}_ph"))])
    return hashed.withColumn("parsed", F.coalesce(*outputs).isNotNull())


def cache_upsert(cache: DataFrame, parsed: DataFrame, now: str, key: str = "_id") -> DataFrame:
    """Merge parsed answers into a cache table keyed by the SHA-256 of the match value."""
    rows = parsed.where("parsed").drop("parsed").withColumn("match", F.col(key).cast("string"))
    rows = rows.withColumn("_id", scalars.cache_key(F.col("match"))).withColumn("created_at", F.lit(now).cast("timestamp")).withColumn("seq", F.lit(0))
    return writes.partial_update(cache, rows.select("_id", "seq", *[c for c in cache.columns if c not in ("_id", "_version")])).drop("result")


def lookup_join(table: DataFrame, cache: DataFrame, on: str, fields: list[str], match: str = "match", order: str = "created_at") -> DataFrame:
    """Each row with at most one cache row; a field and its hash are copied together where the cache has the field."""
    newest = cache.groupBy(F.col(match).alias("_m")).agg(F.max_by(F.struct(*fields, *[f"{f}_ph" for f in fields]), order).alias("_l"))
    j = table.join(newest, table[on].cast("string") == F.col("_m"), "left")
    for f in fields:
        hit = F.col(f"_l.{f}").isNotNull()
        j = j.withColumns({f: F.when(hit, F.col(f"_l.{f}")).otherwise(F.col(f)), f"{f}_ph": F.when(hit, F.col(f"_l.{f}_ph")).otherwise(F.col(f"{f}_ph"))})
    return j.drop("_l", "_m")


def backfill(table: DataFrame, cache: DataFrame, on: str, fields: list[str], only: DataFrame | None = None) -> DataFrame:
    """The lookup join on the whole table, or on the ids in `only`."""
    if only is None:
        return lookup_join(table, cache, on, fields)
    picked = only.select(F.col(only.columns[0]).alias(on)).distinct()
    return lookup_join(table.join(picked, on, "left_semi"), cache, on, fields).unionByName(table.join(picked, on, "left_anti"))


def orphans(cache: DataFrame, table: DataFrame, on: str, match: str = "match") -> DataFrame:
    return cache.join(table.select(F.col(on).cast("string").alias(match)).distinct(), match, "left_anti")


def existing(cache: DataFrame, table: DataFrame, on: str, match: str = "match") -> DataFrame:
    return cache.join(table.select(F.col(on).cast("string").alias(match)).distinct(), match, "left_semi")


def younger(cache: DataFrame, now: str, seconds: int) -> DataFrame:
    """The cache without rows older than a span."""
    return cache.where(F.col("created_at") >= F.lit(now).cast("timestamp") - F.make_dt_interval(secs=F.lit(seconds)))


def purge(cache: DataFrame) -> DataFrame:
    return cache.limit(0)


def progress(parsed: DataFrame, statuses: DataFrame, key: str = "_id") -> DataFrame:
    """candidates, enriched, failed, skipped of one run; rows absent from the answers count as failed."""
    j = statuses.join(parsed.select(key, "parsed"), key, "left")
    ok = F.coalesce(F.col("parsed"), F.lit(False))
    return j.agg(F.count("*").alias("candidates"), F.sum(ok.cast("long")).alias("enriched"), F.sum((~ok & (F.col("status") != "skipped")).cast("long")).alias("failed"), F.sum((F.col("status") == "skipped").cast("long")).alias("skipped"))
