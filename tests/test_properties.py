"""Random inputs against plain Python models."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.functions import scalars as X
from keelson.operators import writes


def replay(target, log):
    """Actions in order on a dict: id -> (version, price, note)."""
    rows = dict(target)
    for id_, _, action, price, note in sorted(log, key=lambda r: (r[0], r[1])):
        have = rows.get(id_)
        if action == "delete":
            rows.pop(id_, None)
        elif action == "index" or (action == "create" and have is None):
            rows[id_] = ((have[0] if have else 0) + 1, price, note)
        elif action == "update":
            old = have or (0, None, None)
            rows[id_] = (old[0] + 1, price if price is not None else old[1], note if note is not None else old[2])
    return rows


def test_action_log_against_a_model(spark):
    r = random.Random(7)
    target = {f"id{i}": (r.randint(1, 4), r.random(), "old") for i in range(0, 400, 2)}
    log = [(f"id{i}", k, r.choice(["index", "create", "update", "delete"]), r.choice([None, r.random()]), r.choice([None, f"n{k}"])) for i in range(400) for k in r.sample(range(50), r.randint(0, 7))]
    t = spark.createDataFrame([(k, *v) for k, v in target.items()], "_id string, _version long, price double, note string")
    out = writes.apply_log(t, spark.createDataFrame(log, "_id string, seq int, action string, price double, note string"))
    assert {x["_id"]: (x["_version"], x["price"], x["note"]) for x in out.collect()} == replay(target, log)


def test_upserts_against_a_model(spark):
    r = random.Random(9)
    target = {f"id{i}": (r.randint(1, 4), i % 3) for i in range(200)}
    batch = [(f"id{r.randrange(300)}", k, r.randrange(3)) for k in range(400)]
    t = spark.createDataFrame([(k, *v) for k, v in target.items()], "_id string, _version long, v int").withColumn("hash", X.content_hash(F.col("v")))
    s = spark.createDataFrame(batch, "_id string, seq int, v int").withColumn("hash", X.content_hash(F.col("v")))
    last = {i: v for i, _, v in batch}
    want = {}
    for i in target.keys() | last.keys():
        if i not in last:
            want[i] = (*target[i], "untouched")
        elif i not in target:
            want[i] = (1, last[i], "created")
        elif target[i][1] == last[i]:
            want[i] = (*target[i], "noop")
        else:
            want[i] = (target[i][0] + 1, last[i], "updated")
    assert {x["_id"]: (x["_version"], x["v"], x["result"]) for x in writes.hash_upsert(t, s, "hash").collect()} == want


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="abcABC1", min_size=1, max_size=12))
def test_name_policies_keep_letters(name):
    for policy in ("snake_lower", "kebab_upper", "camel"):
        out = X.renamed(name, policy)
        assert out.replace("_", "").replace("-", "").lower() == name.lower()


def test_schema_hash_ignores_blanks():
    assert X.schema_hash('{"a": 1}') == X.schema_hash('{ "a":1 }\n') != X.schema_hash('{"a":2}')
