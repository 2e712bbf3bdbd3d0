"""Driver contract: entry(), queries() and oracle_sql()."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["tenant", "device_id", "application", "resource_type", "impact_score", "n_metrics",
                          "calculation_method"]
    assert len(rows) >= 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
