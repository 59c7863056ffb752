"""A benchmark of several blocks gives the rows that one block gives."""

from __future__ import annotations

import pytest

from keelson.llm import decontam

from .test_pairs import DDL, corpus

COLUMNS = ("doc_id", "contaminated", "item_ids", "similarity", "start_word")


@pytest.mark.parametrize(("name", "value"), [("BLOCK_ITEMS", 1), ("BLOCK_ITEMS", 4), ("BLOCK_CHARS", 200)])
def test_blocks_keep_rows(spark, monkeypatch, name, value):
    docs, items = corpus()
    a, b = (" ".join(f"{x}{i}" for i in range(20)) for x in "ab")
    items += [(201, b), (200, a), (200, a + " z"), (None, a)]
    docs += [(None, a), (None, "clean"), (300, b), (300, "clean"), (300, f"x {b} y {a}"), (301, f"{a} q {b}")]  # the last two tie
    frame, bench = spark.createDataFrame(docs, DDL), spark.createDataFrame(items, "item_id long, text string").repartition(3)

    def rows():
        return sorted((tuple(r[c] for c in COLUMNS) for r in decontam.contamination(frame, bench).collect()), key=repr)

    one = rows()
    assert (300, True, [200, 200, 201], 1.0, 22) in one and (None, False, [], 0.0, None) in one and (300, False, [], 0.0, None) in one
    monkeypatch.setattr(decontam, name, value)
    assert rows() == one
