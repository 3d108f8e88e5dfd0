"""Driver contract: entry, queries, oracle keys."""
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 150 and df.columns == ["entity_key", "stability_score", "stability_label"]


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 40
