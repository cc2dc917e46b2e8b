"""Driver contract: entry runs; every oracle key is a registered query."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "target_host_sold_today" in df.columns and "van_rank" in df.columns


def test_registry_consistent():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
