"""Keyed writes as join-and-rewrite.  A target T has _id, _version and document columns; a batch S has _id, seq and the same columns.

A row of a batch without an _id has no place in a keyed table and is left out (auto_write gives it one first).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions import scalars
from keelson.sources import tables


def looked_up(rows: DataFrame, key: Column, ts: Column | None = None, content: list[Column] | None = None, insert: Column | None = None, seq: Column | None = None) -> DataFrame:
    """Rows with what a writer looks up in them: _id, _ts, hash (of the content parts), _insert and seq, where given."""
    given = {"_id": key.cast("string"), "_ts": ts, "hash": scalars.content_hash(*content) if content else None, "_insert": insert, "seq": seq}
    return rows.withColumns({name: c for name, c in given.items() if c is not None})


def last_per_id(batch: DataFrame, seq: str = "seq") -> DataFrame:
    """The last write of each id in a batch; of equal `seq` always the same row, by a hash.  Rows without an id go."""
    return _pick(batch, F.max_by, seq)


def first_per_id(batch: DataFrame, seq: str = "seq") -> DataFrame:
    """The first write of each id in a batch; of equal `seq` always the same row, by a hash.  Rows without an id go."""
    return _pick(batch, F.min_by, seq)


def _pick(batch: DataFrame, by: Callable[[Column, Column], Column], seq: str) -> DataFrame:
    """One row of each id by an aggregate, so that an id's rows are reduced before they are shuffled."""
    rest = [c for c in batch.columns if c != "_id"]
    row = F.struct(*rest)
    picked = batch.where("_id IS NOT NULL").groupBy("_id").agg(by(row, F.struct(F.col(seq), F.xxhash64(F.to_json(row)))).alias("_row"))
    return picked.select(*[F.col("_id") if c == "_id" else F.col(f"_row.{c}") for c in batch.columns])


def hash_upsert(target: DataFrame, batch: DataFrame, hash_col: str, on_match: Mapping[str, Column] | None = None, seq: str = "seq", insert: str | None = None) -> DataFrame:
    """Upsert by content hash.  `result` is created, updated, noop or untouched.

    An equal hash keeps the stored row.  With `on_match`, columns over the aliases t and s, those columns change and
    the version rises instead.  Batches with repeated ids count as their last write.  With `insert`, a boolean column
    of the batch, a row of an unknown id is created only where it is true.
    """
    docs = [c for c in target.columns if c not in ("_id", "_version")]
    t, s = target.alias("t"), last_per_id(batch, seq).alias("s")
    joined = t.join(s, F.col("t._id") == F.col("s._id"), "full_outer")
    in_t, in_s = F.col("t._id").isNotNull(), F.col("s._id").isNotNull()
    same = in_t & in_s & F.col(f"t.{hash_col}").eqNullSafe(F.col(f"s.{hash_col}"))
    change = on_match or {}
    result = F.when(~in_s, "untouched").when(~in_t, "created").when(same, "updated" if change else "noop").otherwise("updated")
    columns = []
    for c in docs:
        stored, sent = F.col(f"t.{c}"), F.col(f"s.{c}")
        columns.append(F.when(~in_s, stored).when(same, change.get(c, stored)).otherwise(sent).alias(c))
    if insert:
        joined = joined.where(in_t | F.col(f"s.{insert}"))
    version = F.when(~in_t, F.lit(1)).when(~in_s | (same & F.lit(not change)), F.col("t._version")).otherwise(F.col("t._version") + 1)
    return joined.select(F.coalesce("t._id", "s._id").alias("_id"), version.cast("long").alias("_version"), *columns, result.alias("result"))


def _docs(target: DataFrame) -> list[str]:
    return [c for c in target.columns if c not in ("_id", "_version")]


def index_write(target: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    """The last write of each id inserts or replaces the whole row.  `result`: created, updated or untouched."""
    t, s = target.alias("t"), last_per_id(batch, seq).alias("s")
    joined = t.join(s, F.col("t._id") == F.col("s._id"), "full_outer")
    in_t, in_s = F.col("t._id").isNotNull(), F.col("s._id").isNotNull()
    columns = [F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in _docs(target)]
    version = F.when(~in_t, F.lit(1)).when(in_s, F.col("t._version") + 1).otherwise(F.col("t._version"))
    result = F.when(~in_s, "untouched").when(~in_t, "created").otherwise("updated")
    return joined.select(F.coalesce("t._id", "s._id").alias("_id"), version.cast("long").alias("_version"), *columns, result.alias("result"))


def _marked(target: DataFrame, batch: DataFrame, seq: str) -> DataFrame:
    """Rows of a batch with `_fresh`: whether the row is the first write of an id that the target doesn't know.

    The batch is written once with a number for each row; the first row of an id is found by an aggregate and joined back, so
    an id may have any share of the batch.
    """
    numbered, _ = tables.pinned(batch.where("_id IS NOT NULL").withColumn("_row", F.monotonically_increasing_id()), "batch")
    content = F.xxhash64(F.to_json(F.struct(*[c for c in batch.columns if c != "_id"])))  # as first_per_id
    first = numbered.groupBy("_id").agg(F.min(F.struct(F.col(seq), content, F.col("_row").alias("row"))).alias("_first")).select("_id", F.col("_first.row").alias("_first"))
    known = target.select("_id", F.lit(True).alias("_known"))
    marked = numbered.join(first.join(known, "_id", "left"), "_id")
    return marked.withColumn("_fresh", (F.col("_row") == F.col("_first")) & F.col("_known").isNull()).drop("_row", "_first", "_known")


def create_write(target: DataFrame, batch: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(table, conflicts): the first write of a new id is appended; writes to a known id and later repeats are conflicts."""
    marked = _marked(target, batch, seq)
    added = marked.where("_fresh").select("_id", F.lit(1).cast("long").alias("_version"), *_docs(target))
    return target.unionByName(added), marked.where("NOT _fresh").select(*batch.columns)


def generated_id(batch: DataFrame, seq: str = "seq") -> Column:
    """A deterministic id of a row without one."""
    docs = [c for c in batch.columns if c not in ("_id", seq)]
    return F.sha2(F.concat_ws("#", F.to_json(F.struct(*docs)), F.col(seq).cast("string")), 256)


def auto_write(target: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows with an id are indexed; rows with a blank or null id are created under a generated id."""
    blank = F.col("_id").isNull() | (F.trim("_id") == "")
    return index_write(target, batch.withColumn("_id", F.when(blank, generated_id(batch, seq)).otherwise(F.col("_id"))), seq)


def partial_update(target: DataFrame, batch: DataFrame, fields: str | None = None, seq: str = "seq") -> DataFrame:
    """Merge the fields that the incoming document has; an unknown id is inserted.

    A field counts as present if it isn't null, or, with `fields`, if its name is in that array column: then a null
    in it overwrites.
    """
    t, s = target.alias("t"), last_per_id(batch, seq).alias("s")
    joined = t.join(s, F.col("t._id") == F.col("s._id"), "full_outer")
    in_t, in_s = F.col("t._id").isNotNull(), F.col("s._id").isNotNull()

    def merged(c: str) -> Column:
        present = F.array_contains(F.col(f"s.{fields}"), c) if fields else F.col(f"s.{c}").isNotNull()
        return F.when(in_s & present, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    version = F.when(~in_t, F.lit(1)).when(in_s, F.col("t._version") + 1).otherwise(F.col("t._version"))
    result = F.when(~in_s, "untouched").when(~in_t, "created").otherwise("updated")
    return joined.select(F.coalesce("t._id", "s._id").alias("_id"), version.cast("long").alias("_version"), *[merged(c) for c in _docs(target)], result.alias("result"))


def delete_ids(target: DataFrame, ids: DataFrame) -> DataFrame:
    """The target without the given ids."""
    return target.join(ids.select("_id"), "_id", "left_anti")


def apply_log(target: DataFrame, log: DataFrame, seq: str = "seq", action: str = "action") -> DataFrame:
    """Apply interleaved actions per id in order: index replaces, create inserts if absent, update merges non-null
    fields or inserts, delete removes.  The version counts the writes since the row last came into being.

    After any action but delete the row exists, so of the actions since the last delete only the first can be a create
    that takes effect; the others fold by aggregates that merge in any order.  Tasks fold an id's actions before they are
    shuffled, so an id may have any share of the log.  Actions of one id and equal `seq` apply in a fixed order, by a
    hash.  Actions without an id go.
    """
    docs = _docs(target)
    at = F.struct(F.col(seq).alias("seq"), F.xxhash64(F.to_json(F.struct(*[c for c in log.columns if c != "_id"]))).alias("hash"))
    rows = log.where("_id IS NOT NULL").select("_id", F.col(action).alias("_action"), at.alias("_at"), *docs)
    deleted = rows.where("_action = 'delete'").groupBy("_id").agg(F.max("_at").alias("_delete"))
    since = rows.join(deleted, "_id", "left").where("_delete IS NULL OR _at > _delete")
    lasting = lambda c: (F.col("_action") == "index") | ((F.col("_action") == "update") & F.col(c).isNotNull())
    folded = since.groupBy("_id").agg(
        F.min_by(F.struct(F.col("_action").alias("action"), *docs), "_at").alias("_first"), F.sum((F.col("_action") != "create").cast("long")).alias("_writes"),
        F.bool_or(F.col("_action") == "index").alias("_replaced"), *[F.max_by(F.struct(F.col(c).alias("v")), F.when(lasting(c), F.col("_at"))).alias(f"_{c}") for c in docs],
    )
    t, s = target.withColumn("_known", F.lit(True)).alias("t"), deleted.join(folded, "_id", "full_outer").alias("s")
    joined = t.join(s, F.col("t._id") == F.col("s._id"), "full_outer").where("s._first IS NOT NULL OR s._delete IS NULL")
    gone = F.col("t._known").isNull() | F.col("s._delete").isNotNull()  # the row wasn't there when the folded actions began
    made = F.coalesce(gone & (F.col("s._first.action") == "create"), F.lit(False))
    version = F.when(gone, F.lit(0)).otherwise(F.col("t._version")) + F.coalesce("s._writes", F.lit(0)) + made.cast("long")
    columns = []
    for c in docs:
        before = F.when(made, F.col(f"s._first.{c}")).when(~gone & ~F.coalesce("s._replaced", F.lit(False)), F.col(f"t.{c}"))
        columns.append(F.when(F.col(f"s._{c}").isNotNull(), F.col(f"s._{c}.v")).otherwise(before).alias(c))
    return joined.select(F.coalesce("t._id", "s._id").alias("_id"), version.cast("long").alias("_version"), *columns)


def routed(rows: DataFrame, prefix: str, ts_col: str, pattern: str = "yyyy.MM.dd", offset_seconds: int = 0, now: str | None = None) -> DataFrame:
    """`_index` from each row's timestamp (and offset), else from `now`."""
    ts = F.coalesce(F.col(ts_col), F.lit(now).cast("timestamp")) if now else F.col(ts_col)
    return rows.withColumn("_index", F.lower(F.concat(F.lit(prefix), F.date_format(ts + F.make_dt_interval(secs=F.lit(offset_seconds)), pattern))))


def with_outcomes(target: DataFrame, batch: DataFrame, mode: str = "index", seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(table, outcomes): one outcome (_id, seq, status, error_type) for each document sent.

    Of equal `seq` the first is the one that create_write takes.  A document without an id is refused with 400.
    """
    marked = _marked(target, batch, seq)
    fresh = F.col("_fresh")
    if mode == "create":
        added = marked.where("_fresh").select("_id", F.lit(1).cast("long").alias("_version"), *_docs(target))
        table = target.unionByName(added)
        status = F.when(fresh, 201).otherwise(409)
    else:
        table = index_write(target, batch, seq).drop("result")
        status = F.when(fresh, 201).otherwise(200)
    error = F.when(status == 409, "version_conflict_engine_exception")
    refused = batch.where("_id IS NULL").select("_id", seq, F.lit(400).alias("status"), F.lit("missing_id").alias("error_type"))
    return table, marked.select("_id", seq, status.alias("status"), error.alias("error_type")).unionByName(refused)


def all_persisted(outcomes: DataFrame) -> DataFrame:
    """One row: whether every status is 2xx (true for none)."""
    return outcomes.agg(F.coalesce(F.bool_and(F.col("status").between(200, 299)), F.lit(True)).alias("all_persisted"))


def multiplex(batch: DataFrame, *projections: list[Column]) -> list[DataFrame]:
    """One frame for each target's schema from the same batch."""
    return [batch.select(*p) for p in projections]
