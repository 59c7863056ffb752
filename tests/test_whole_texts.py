"""Enrichment and the action export read whole texts, not prefixes."""

from __future__ import annotations

import hashlib
import json

import pytest

from keelson.plans import q_enrich as Q
from keelson.plans import q_writes

TAIL = "x" * 300


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """Texts that differ after 300 characters only."""
    d = str(tmp_path_factory.mktemp("whole"))
    docs = [(i, TAIL + "y" * i + '"\n', "en", "s", 302 + i) for i in range(1, 41)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 0, 1) for i in range(1, 41)], "doc_id long, toxic int, quality int").write.parquet(f"{d}/labels.parquet")
    return d, {i: t for i, t, *_ in docs}


def stale(i):
    return not (i % 3 == 0 and i % 10 == 0)


def test_prompts_hold_the_whole_text(spark, data):
    d, texts = data
    head = "You label texts.\nReturn one JSON object with these fields: {"
    both = ", ".join(f'"{f}": "{x}"' for f, x in Q.OUTPUTS.items())

    def digest(asked, i):
        return hashlib.md5(f"{head}{asked}}}\n<lang>en</lang>\n<body>{texts[i]}</body>\n".encode()).hexdigest()

    assert {r["_id"]: r["digest"] for r in Q.e4(spark, d).collect()} == {i: digest(both, i) for i in texts}

    def asked(i):
        parts = {"summary": i % 3 != 0, "kind": i % 10 != 0}
        return ", ".join(f'"{f}": "{Q.OUTPUTS[f]}"' for f, on in parts.items() if on)

    assert {r["_id"]: r["digest"] for r in Q.e5(spark, d).collect()} == {i: digest(asked(i), i) for i in texts if stale(i) and i % 11}


def test_answers_come_from_the_whole_text(spark, data):
    d, texts = data
    n = {i: len("p" + t) for i, t in texts.items() if stale(i)}
    good = {i for i in n if n[i] % 7}
    assert {r["_id"]: r["digest"] for r in Q.e6(spark, d).collect()} == {i: hashlib.md5(Q.stub(["p" + texts[i]])[0].encode()).hexdigest() for i in n}
    assert {r["_id"]: (r["summary"], r["kind"], r["parsed"]) for r in Q.e8(spark, d).collect()} == {i: (f"n{n[i]}" if i in good else None, "good" if i in good and n[i] % 2 else None, i in good) for i in n}
    e15 = Q.e15(spark, d).first()
    assert (e15["candidates"], e15["enriched"], e15["failed"], e15["skipped"]) == (len(n), len(good), len(n) - len(good), 0)
    e9 = [r for r in Q.e9(spark, d).collect() if r["_version"] == 2]
    assert {(r["match"], r["summary"], r["created"]) for r in e9} == {(str(i), f"n{n[i]}", "2024-04-01 00:00:00") for i in good}
    assert sorted(r["_id"] for r in Q.e7(spark, d).collect()) == sorted(n)


def test_export_holds_the_text(spark, data):
    d, texts = data
    lines = q_writes.w13(spark, d).where("line_no = 1").collect()
    got = {r["doc_id"]: json.loads(r["line"]) for r in lines}
    assert {i: (g.get("doc") or g)["text"] for i, g in got.items()} == {i: t for i, t in texts.items() if i % 4 != 3}
