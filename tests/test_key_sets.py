"""Both sides of the key sets are whole."""

from __future__ import annotations

from keelson.plans import q_scan

DATA = "/root/testdata/sf0.001"


def test_all_common_keys(spark):
    have = {r[0] for r in spark.read.parquet(f"{DATA}/customer.parquet").select("c_custkey").collect()}
    used = {r[0] for r in spark.read.parquet(f"{DATA}/orders.parquet").select("o_custkey").collect()}
    assert any(k >= 50 for k in have & used)
    want = sorted([(k, "only customers") for k in have - used] + [(k, "both") for k in have & used])
    assert sorted((r["k"], r["side"]) for r in q_scan.u2(spark, DATA).collect()) == want
