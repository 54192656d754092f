import json
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from costweave.operators import landing as L
from costweave.sources.store import TableStore
from costweave.sources.tables import read_external, scan_or_empty, scan_table
from tests.conftest import SF001


def test_scan_prunes_and_pushes(spark):
    df = scan_table(spark, SF001, "lineitem", ["l_orderkey", "l_shipdate"], F.col("l_orderkey") < 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_orderkey), LessThan(l_orderkey,10)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_scan_or_empty(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    missing = scan_or_empty(spark, tempfile.mkdtemp(prefix="cw-") + "/nope", schema)
    assert missing.count() == 0 and missing.schema == schema


def test_read_external_gzip_csv(spark):
    out = tempfile.mkdtemp(prefix="cw-ext-") + "/nation_csv"
    scan_table(spark, SF001, "nation").write.option("header", "true").option("compression", "gzip").csv(out)
    schema = "n_nationkey int, n_name string, n_regionkey int"
    df = read_external(spark, out, "csv", T._parse_datatype_string(schema))
    assert df.count() == 25 and df.schema.simpleString() == f"struct<{schema.replace(' ', ':').replace(',:', ',')}>"


def test_land_pages_from_files(spark):
    d = tempfile.mkdtemp(prefix="cw-pages-")
    rows = [r.asDict() for r in scan_table(spark, SF001, "region").collect()]
    for i in range(0, len(rows), 2):                      # pages of two records
        with open(os.path.join(d, f"page_{i}.json"), "w") as fh:
            json.dump({"data": rows[i:i + 2], "skipToken": None}, fh)
    schema = T.StructType([T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())]))),
        T.StructField("skipToken", T.StringType())])
    landed = L.land_pages(spark, d, schema, "data")
    assert landed.count() == 5 and landed.select("source_file").distinct().count() == 3
    stamped = L.add_audit(L.stamp_tenant(landed, "t1", "Tenant 1"), "2024-01-01 06:00:00")
    assert {"tenant_id", "tenant_label", "ingestion_timestamp", "snapshot_date"} <= set(stamped.columns)


def test_compact_keeps_rows(spark):
    st = TableStore(spark, tempfile.mkdtemp(prefix="cw-store-"))
    df = scan_table(spark, SF001, "orders", ["o_orderkey", "o_orderdate"])
    st.write_overwrite(df, "orders")
    st.compact("orders", ["o_orderdate"], 4)
    assert st.read("orders").count() == df.count()


def test_scans_add_no_exchange(spark):
    plan = scan_table(spark, SF001, "orders", ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "RoundRobin" not in plan
