import sparkretrieve


def test_version():
    assert sparkretrieve.__version__ == "0.1.0"


def test_entry_contract():
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) >= 30
