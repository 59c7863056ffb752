"""Pseudonyms: formats, links, inversion; chat collapse against SQL and brute force."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from keelson.llm import chat, pii

KEY = "k1"


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def run(spark, texts, **how):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("private", F.lit("clash")).withColumn("keep", F.lit(7))
    return [r for r in pii.pseudonymise(rows, how.pop("key", KEY), **how).orderBy("doc_id").collect()]


def test_kinds_and_formats(spark):
    text = 'mail a.b@c.org tel +1 (017) 555-7713 card 4417744280351547 or 4417-7442-8035-1547, bad 1234567890123456; ip 97.51.17.173. on 2024-02-29 and 29.02.2024 not 2023-02-29; 123-45-6789 000-12-3456 token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'
    out = run(spark, [text])[0]
    got = out["text"]
    assert re.fullmatch(r'mail u[0-9a-f]{12}@c\.org tel \+1 \(\d{3}\) \d{3}-\d{4} card \d{16} or \d{4}-\d{4}-\d{4}-\d{4}, bad 1234567890123456; ip \d+\.\d+\.\d+\.\d+\. on \d{4}-\d\d-\d\d and \d\d\.\d\d\.\d{4} not 2023-02-29; \d{3}-\d\d-\d{4} 000-12-3456 token = "[0-9a-f]{40}"', got)
    cards = re.findall(r"card (\d{16}) or ([\d-]+),", got)[0]
    assert cards[0] == cards[1].replace("-", "") and luhn(cards[0]) and cards[0] != "4417744280351547"
    iso, dotted = re.findall(r"on (\S+) and (\S+) not", got)[0]
    assert iso == "-".join(dotted.split(".")[::-1])
    for private in ("a.b@c.org", "555-7713", "4417744280351547", "97.51.17.173", "2024-02-29", "123-45-6789", "04dbebab"):
        assert private not in got
    assert out["keep"] == 7 and len(out["private"]) == 9


def test_linked_keyed_and_inverted(spark):
    texts = ["ip 10.0.0.1 card 4417744280351547", "again 10.0.0.1.", "x 10.0.0.2"]
    one = [r["text"] for r in run(spark, texts)]
    assert re.search(r"ip (\S+)", one[0])[1] == re.search(r"again (\S+)\.$", one[1])[1] != one[2].split()[1]
    assert [r["text"] for r in run(spark, texts, key="k2")] != one
    assert [r["text"] for r in run(spark, one, inverse=True)] == texts


def test_odd_texts(spark):
    texts = [None, "", "plain words only", "12 34", "@", "a@b", "1.2.3", "7" * 40, "x" * 200_000 + " 10.0.0.1", "10.0.0.1" , "10.0.0.1 10.0.0.1"]
    got = run(spark, texts)
    assert [r["text"] for r in got][:8] == texts[:8] and all(r["private"] == [] for r in got[:8])
    assert got[8]["text"].startswith("x" * 200_000) and len(got[10]["private"]) == 2
    assert run(spark, ["x"])[0]["text"] == "x"
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.pseudonymise(empty, KEY).count() == 0


@pytest.mark.parametrize(("a", "b"), [(189, 773), (10, 100), (1, 7)])
def test_feistel_permutes_its_domain(spark, a, b):
    n = a * b
    out = pii.keyed(spark.range(n), KEY, "k").select(pii.feistel(F.col("id"), F.lit(a), F.lit(b), F.col("k"), "t").alias("v"))
    s = out.agg(F.countDistinct("v"), F.min("v"), F.max("v")).first()
    assert tuple(s) == (n, 0, n - 1)


def test_no_python_on_the_main_path(spark):
    plan = pii.pseudonymise(spark.createDataFrame([(1, "x")], "doc_id long, text string"), KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("key", ["a-secret-nobody-may-read", "long " * 40])
def test_no_plan_shows_the_key(spark, key):
    """Neither the key nor what is derived from it is in a plan, parsed to generated."""
    rows = pii.pseudonymise(spark.createDataFrame([(1, "call +1 555 123 4567", "clash")], "doc_id long, text string, _key string"), key)
    assert rows.first()["text"] != "call +1 555 123 4567" and rows.columns == ["doc_id", "text", "_key", "private"]
    block = (hashlib.sha256(key.encode()).digest() if len(key) > 64 else key.encode()).ljust(64, b"\0")
    telling = [key, key.encode().hex(), *(bytes(b ^ p for b in block).hex() for p in (0x36, 0x5C))]
    execution = rows._jdf.queryExecution()
    texts = [execution.toString(), *(execution.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(m)) for m in ("extended", "codegen", "cost", "formatted"))]
    assert not any(t.lower() in text.lower() for t in telling for text in texts)


# ---- chat ------------------------------------------------------------------------------------------------------------


def conversations(spark):
    logs = {1: "abc", 2: "ab", 3: "abc", 4: "abd", 5: "a", 6: "x", 7: "", 8: "ba"}
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", m) for c, s in logs.items() for t, m in enumerate(s)]
    rows += [(9, 0, None, None), (9, 1, "user", ""), (10, 0, None, ""), (11, 5, "user", "q"), (11, 5, "user", "q"), (12, 5, "user", "q"), (None, 0, "user", "lost")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_collapse(spark):
    out = {r["conv_id"]: r for r in chat.collapse(conversations(spark)).collect()}
    assert set(out) == {1, 4, 6, 8, 9, 10, 11}
    assert out[1]["n_copies"] == 2 and out[1]["rendered"] == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n<|user|>\nc<|end|>\n"
    assert chat.collapse(conversations(spark).limit(0)).count() == 0


def test_chat_matches_sql(spark):
    path = "/root/testdata/sf0.001/conversations.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    want = sorted(con.execute(chat.ORACLE).fetchall())
    got = sorted(tuple(r) for r in chat.collapse(spark.read.parquet(path)).collect())
    assert got == want
