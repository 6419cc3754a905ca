import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "pii_types_detected" in df.columns


def test_every_query_of_the_library_has_an_oracle():
    from doclake.plans import registry

    q, o = E.queries(), E.oracle_sql()
    assert set(registry.QUERIES) <= set(q) and set(o) <= set(q)
    assert not set(registry.QUERIES) - set(o)
