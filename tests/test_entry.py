"""The driver contract."""

from __future__ import annotations

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
