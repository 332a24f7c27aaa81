import __spark_entry__ as entry


def test_registry_and_oracle_aligned():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(entry.QUERIES) == set(entry.SQL) and len(entry.QUERIES) >= 64
    assert set(o) <= set(q) and set(entry.QUERIES) <= set(q)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "sentiment", "cnt"]
    assert df.count() >= 0
