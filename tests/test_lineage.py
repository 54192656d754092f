"""Resource lineage over rows of its own: runs named by text, items exchanged once."""
import datetime as dt

import pytest

from costweave.plans import ingest_ops, registry

registry.load_all()


@pytest.fixture
def root(spark, tmp_path):
    at = dt.datetime(2001, 5, 3)
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "JAPAN", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, 0, "BUILDING"), (2, 0, "MACHINERY")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        # run 7 comes twice, for two pipelines
        "orders": ([(7, 1, "O", "1-URGENT", at), (7, 2, "O", "1-URGENT", at), (8, 1, "O", "1-URGENT", at)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"),
        "lineitem": ([(7, p, 1, n, 1.0, 10.01 * p, 0.05, 0.0, "N", "O", at) for n, p in enumerate((14, 15, 16, 22, 12), 1)]
                     + [(8, 14, 1, 1, 1.0, 33.33, 0.0, 0.0, "R", "F", at)] * 2,
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["resource_lineage", "lineage_conservation"])
def test_lineage_of_repeated_runs_equals_its_sql(spark, root, name):
    import duckdb
    from tests.harness import _rows
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet/*.parquet')")
    want = con.execute(registry.ORACLE[name])
    names = [d[0] for d in want.description]
    got = registry.QUERIES[name](spark, root)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(names, want.fetchall())


def test_work_items_are_exchanged_by_their_join_alone(spark, root):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ingest_ops._lineage(spark, root)[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning(run") == 1         # of the tags; it was that and the items'
