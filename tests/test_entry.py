import __spark_entry__ as E


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "score"]
    assert df.count() > 0
