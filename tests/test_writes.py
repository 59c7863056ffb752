"""Keyed writes on small tables, with the known scenarios."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import maintain, sync, writes


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def by_id(df):
    return {r["_id"]: r.asDict() for r in df.collect()}


EMPTY = "_id string, _version long, price double"


def test_index_mode_last_write_wins(spark):
    out = by_id(writes.index_write(frame(spark, [], EMPTY), frame(spark, [("OM-001", 1, 10.0), ("OM-001", 2, 99.0)], "_id string, seq int, price double")))
    assert len(out) == 1 and out["OM-001"]["price"] == 99 and out["OM-001"]["result"] == "created"


def test_create_mode_first_write_wins(spark):
    table, conflicts = writes.create_write(frame(spark, [], EMPTY), frame(spark, [("OM-002", 1, 10.0), ("OM-002", 2, 99.0)], "_id string, seq int, price double"))
    assert [r["price"] for r in table.collect()] == [10.0]
    assert [r["price"] for r in conflicts.collect()] == [99.0]


def hashed(spark, n, changed=lambda i: False):
    return frame(spark, [(str(i), 1, f"t{i}{'x' if changed(i) else ''}") for i in range(n)], "_id string, seq int, title string").withColumn("hash", F.sha2("title", 256))


def test_hash_upsert_versions(spark):
    empty = frame(spark, [], "_id string, _version long, title string, hash string")
    one = writes.hash_upsert(empty, hashed(spark, 100), "hash").drop("result")
    two = writes.hash_upsert(one, hashed(spark, 100), "hash")
    assert two.agg(F.max("_version")).first()[0] == 1
    three = writes.hash_upsert(two.drop("result"), hashed(spark, 100, lambda i: i % 2 == 0), "hash")
    assert {r["_version"]: r["count"] for r in three.groupBy("_version").count().collect()} == {1: 50, 2: 50}


def test_hash_match_with_stamp(spark):
    def batch(ids, now, changed=lambda i: False):
        rows = frame(spark, [(str(i), 1, f"t{i}{'x' if changed(i) else ''}") for i in ids], "_id string, seq int, title string").withColumn("hash", F.sha2("title", 256))
        return sync.stamp(rows, now)

    empty = frame(spark, [], "_id string, _version long, title string, hash string, batch_date timestamp, last_updated timestamp")
    table = empty
    for ids, now, changed in ((range(100), "2024-01-01", lambda i: False), (range(100), "2024-01-02", lambda i: False), (range(10, 100), "2024-01-03", lambda i: i % 2 == 0)):
        table = sync.conditional_write(table, batch(ids, now, changed)).drop("result")
    assert table.agg(F.max("_version")).first()[0] == 3
    assert sorted(r["count"] for r in table.groupBy("batch_date").count().collect()) == [10, 90]
    assert sorted(r["count"] for r in table.groupBy("last_updated").count().collect()) == [45, 55]


def test_action_log(spark):
    t = frame(spark, [("a", 3, 1.0), ("b", 1, 2.0)], EMPTY)
    log = frame(spark, [("a", 1, "delete", None), ("a", 2, "create", 5.0), ("a", 3, "create", 6.0), ("b", 1, "update", None), ("c", 1, "update", 7.0), ("d", 1, "index", 1.0), ("d", 2, "delete", None)], "_id string, seq int, action string, price double")
    out = by_id(writes.apply_log(t, log))
    assert {k: (v["price"], v["_version"]) for k, v in out.items()} == {"a": (5.0, 1), "b": (2.0, 2), "c": (7.0, 1)}


def test_partial_update_null_and_mask(spark):
    t = frame(spark, [("a", 1, 1.0)], EMPTY)
    s = frame(spark, [("a", 1, None, ["price"])], "_id string, seq int, price double, _fields array<string>")
    assert by_id(writes.partial_update(t, s))["a"]["price"] == 1.0
    assert by_id(writes.partial_update(t, s, fields="_fields"))["a"]["price"] is None


def test_empty_batch_and_ids(spark):
    t = frame(spark, [("a", 1, 1.0)], EMPTY)
    none = frame(spark, [], "_id string, seq int, price double")
    assert by_id(writes.index_write(t, none))["a"]["result"] == "untouched"
    assert writes.delete_ids(t, none).count() == 1
    assert writes.all_persisted(writes.with_outcomes(t, none)[1]).first()[0] is True


def test_copy_and_delete_counts(spark):
    src = frame(spark, [(f"p{i}", 1, (i + 1) * 5.0) for i in range(10)], EMPTY)
    none = frame(spark, [], EMPTY)
    c = maintain.counters(maintain.reindex(src, none)).first()
    assert c["created"] + c["updated"] == 10 and c["fraction"] == 1.0
    assert maintain.reindex(src, none, where=F.col("price") >= 25).count() == 6
    left, count = maintain.delete_by_query(src, F.col("price") < 25)
    assert (left.count(), count.first()["deleted"]) == (6, 4)


def test_conflict_abort(spark):
    src = frame(spark, [("a", 1, 1.0)], EMPTY)
    try:
        maintain.copy_create(src, src, proceed=False)
    except maintain.ConflictError:
        return
    raise AssertionError("no conflict raised")


def test_rebuild_decision(spark):
    declared = frame(spark, [("a", "h", "1.0"), ("b", "h", "1.0"), ("c", "h", "1.0"), ("d", "h", "x")], "name string, hash string, version string")
    stored = frame(spark, [("a", "g", "2.0"), ("b", "h", "1.0"), ("c", "g", "1.0"), ("d", "g", "1.0")], "name string, hash string, version string")
    assert {r["name"]: r["decision"] for r in maintain.rebuild_decision(declared, stored).collect()} == {"a": "keep", "b": "keep", "c": "rebuild", "d": "rebuild"}


def test_log_and_outcomes_of_ties_and_missing_ids(spark):
    t = frame(spark, [("a", 3, 1.0)], EMPTY)
    rows = [("a", 1, "index", 5.0), ("a", 1, "index", 6.0), (None, 1, "index", 7.0), (None, 2, "create", 8.0), ("b", 1, "create", 1.0), ("b", 1, "create", 2.0)]
    ddl = "_id string, seq int, action string, price double"
    one, two = (by_id(writes.apply_log(t, frame(spark, r, ddl))) for r in (rows, rows[::-1]))
    assert one == two and set(one) == {"a", "b"} and (one["a"]["_version"], one["b"]["_version"]) == (5, 1)
    s = frame(spark, rows, ddl).drop("action")
    for mode, status in (("create", [201, 400, 400, 409, 409, 409]), ("index", [200, 200, 200, 201, 400, 400])):
        table, outcomes = writes.with_outcomes(t, s, mode)
        assert sorted(r["status"] for r in outcomes.collect()) == status
        assert set(by_id(table)) == {"a", "b"} and not writes.all_persisted(outcomes).first()[0]
