"""Driver contract: registry shape and naming rules."""
import __spark_entry__ as E


def test_oracle_keys_are_registered_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 120 and len(o) >= 110
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())


def test_oracle_sql_reads_driver_tables_only():
    tables = ("region nation customer supplier part orders lineitem events "
              "documents embeddings pages benchmark labels conversations").split()
    for name, sql in E.oracle_sql().items():
        low = sql.lower()
        assert any(f" {t}" in low for t in tables), name
        assert "read_parquet" not in low and "/root/" not in low, name
