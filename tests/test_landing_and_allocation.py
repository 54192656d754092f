import datetime as dt
import json
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from costweave.operators import datasets as D
from costweave.operators import edges as E
from costweave.operators import gates as G
from costweave.operators.allocate import allocate_or_keep, share_exactly


def _pages(lines, multi_line=False):
    folder = tempfile.mkdtemp(prefix="cw-pages-")
    if multi_line:
        for i, line in enumerate(lines):
            with open(f"{folder}/p{i}.json", "w") as fh:
                fh.write(line)
    else:
        with open(f"{folder}/pages.json", "w") as fh:
            fh.write("\n".join(lines))
    return folder


RECORD = {"id": "r1", "name": "n", "sku": {"name": "S1"}, "zones": ["1", "2"], "identity": None, "tags": {}, "size": "12"}


@pytest.mark.parametrize("multi_line", [False, True])
def test_registry_lands_good_pages_and_quarantines_others(spark, multi_line):
    indent = 2 if multi_line else None
    good = json.dumps({"data": [RECORD, {"id": "r2", "size": "large", "extra": 1}], "nextLink": "x"}, indent=indent)
    bad = [json.dumps({"data": [RECORD]})[:-9], json.dumps({"error": "throttled"}), json.dumps({"data": [{"id": "x", "zones": "no list"}]})]
    folder = _pages([good, *bad, json.dumps({"data": []})], multi_line)
    rows, quarantine = D.land(spark, folder, D.dataset("resources"), ("t1", "Tenant 1"), "2024-01-02 03:04:05", multi_line)
    got = {r.id: r for r in rows.collect()}
    assert set(got) == {"r1", "r2"}
    assert (got["r1"].sku, got["r1"].zones, got["r1"].size, got["r1"].tenant_id) == ("S1", '["1","2"]', 12, "t1")
    assert got["r2"].size is None and got["r2"].sku is None and got["r2"].snapshot_date == dt.date(2024, 1, 2)
    lost = sorted((r.reason, r.page) for r in quarantine.collect())
    assert lost == sorted([("malformed", bad[0]), ("no_records", bad[1]), ("malformed", bad[2])])
    counts = {r.outcome: (r.pages, r.records) for r in D.page_counts(spark, {("t1", "T"): folder}, D.dataset("resources"), multi_line).collect()}
    assert counts == {"landed": (2, 2), "malformed": (2, 0), "no_records": (1, 0)}


def test_registry_unions_tenants_and_knows_its_names(spark):
    folders = {(t, t.upper()): _pages([json.dumps({"data": [RECORD | {"id": t}]})]) for t in ("a", "b")}
    rows, quarantine = D.land_tenants(spark, folders, D.dataset("resources"), "2024-01-02 03:04:05")
    assert sorted((r.id, r.tenant_id, r.tenant_label) for r in rows.collect()) == [("a", "a", "A"), ("b", "b", "B")]
    assert quarantine.count() == 0
    with pytest.raises(ValueError):
        D.dataset("nope")


def plain_shares(amount, weights):
    total = sum(weights) or len(weights)
    w = weights if sum(weights) else [1] * len(weights)
    whole = [amount * x // total for x in w]
    order = sorted(range(len(w)), key=lambda i: (-(amount * w[i] - whole[i] * total), i))
    for i in order[:amount - sum(whole)]:
        whole[i] += 1
    return whole


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 6), st.lists(st.integers(0, 10 ** 15), min_size=1, max_size=7)), min_size=1, max_size=5))
def test_shares_add_up(spark, groups):
    rows = [(g, i, w, amount) for g, (amount, ws) in enumerate(groups) for i, w in enumerate(ws)]
    out = share_exactly(spark.createDataFrame(rows, "g int, i int, w long, amount long"), ["g"], ["i"], "w", "amount", "units")
    got = {(r.g, r.i): r.units for r in out.collect()}
    for g, (amount, ws) in enumerate(groups):
        assert [got[g, i] for i in range(len(ws))] == plain_shares(amount, ws)
        assert sum(got[g, i] for i in range(len(ws))) == amount


def test_allocate_or_keep_keeps_what_nobody_carries(spark):
    amounts = spark.createDataFrame([("r1", 10.0), ("r2", 6.0), ("r3", 4.0)], "r string, e double")
    shares = spark.createDataFrame([("r1", "a", 1.0), ("r1", "b", 3.0), ("r3", "a", 0.0)], "r string, s string, c double")
    got = sorted((x.r, x.s, x.e) for x in allocate_or_keep(amounts, shares, ["r"], "s", "c", "e").collect())
    assert got == [("r1", "a", 2.5), ("r1", "b", 7.5), ("r2", "unallocated", 6.0), ("r3", "unallocated", 4.0)]


def test_validated_rows_and_verdicts(spark):
    df = spark.createDataFrame([(1.0, "x"), (-1.0, None), (2.0, None)], "cost double, dep string")
    rules = {"negative": F.col("cost") < 0, "no_department": F.col("dep").isNull()}
    v = G.validated(df, rules)
    assert sorted((r.validation_errors, r.is_valid) for r in v.collect()) == [
        ([], True), (["negative", "no_department"], False), (["no_department"], False)]
    assert G.verdict(v, "t").first()[1:] == (3, 1, 33.33, "FAILED")
    assert G.verdict(v.filter("is_valid"), "t").first().verdict == "PASSED"
    assert G.verdict(v.limit(0), "t").first().verdict == "EMPTY"
    report = {r.rule: (r.checked, r.violations, r.passed) for r in G.rule_verdicts(
        {"a": (df, F.col("cost") < 0), "b": (df.limit(0), F.col("cost") < 0), "c": (df, F.col("cost") > 100)}).collect()}
    assert report == {"a": (3, 1, False), "b": (0, 0, False), "c": (3, 0, True)}
    report = {r.table_name: (r.rows, r.all_empty) for r in G.all_empty_report(df.withColumn("t", F.lit("x")), "t", ["x", "y"]).collect()}
    assert report == {"x": (3, False), "y": (0, False)}
    assert all(r.all_empty for r in G.all_empty_report(df.limit(0).withColumn("t", F.lit("x")), "t", ["x", "y"]).collect())


def test_tagged_build_equals_one_build_per_table_and_scans_once(spark):
    src = {"lineitems": spark.createDataFrame([("L1", "O1", "P1", "S1"), ("l1", "o1", None, ""), ("L2", "O9", "P1", "S1")],
                                              "line_id string, order_id string, part_id string, supplier_id string"),
           "orders": spark.createDataFrame([("o1", "C1"), ("o2", "C7")], "order_id string, customer_id string")}
    names = ["lineitem_order", "lineitem_part", "lineitem_supplier", "order_customer"]
    for clean in (True, False):
        one = E.tagged_union(E.build_all(src, "b", "2024-01-01 00:00:00", names, clean)).collect()
        tagged = E.build_tagged(src, "b", "2024-01-01 00:00:00", names, clean).select(*[*E.EDGE_COLUMNS, "edge_table"])
        assert sorted(map(str, one)) == sorted(map(str, tagged.collect()))
    plan = E.build_tagged(src, "b", "2024-01-01 00:00:00", names)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2                        # one scan an extract
    assert len(E.EDGE_SPECS) == 11 and len({s.extract for s in E.EDGE_SPECS}) == 9


def test_orphan_endpoints(spark):
    nodes = spark.createDataFrame([("order", "o1"), ("customer", "c1")], "label string, node_id string")
    src = {"orders": spark.createDataFrame([("o1", "C1"), ("o2", "C7")], "order_id string, customer_id string")}
    edges = E.build_tagged(src, "b", "2024-01-01 00:00:00", ["order_customer"])
    assert sorted((r.endpoint, r.node_id) for r in E.orphan_edges(edges, nodes).collect()) == [("source", "o2"), ("target", "c7")]


def test_contract_report(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 50)], "id int, name string, n int")
    contract = [("id", "int", None, None), ("name", "string", None, None), ("n", "int", "0", "10"), ("gone", "int", None, None), ("id", "bigint", None, None)]
    got = [(r.column_name, r.status, r.rows, r.nulls, r.out_of_range) for r in G.contract_report(df, "t", contract).collect()]
    assert got == [("id", "ok", 2, 0, 0), ("name", "nulls", 2, 1, 0), ("n", "out_of_range", 2, 0, 1), ("gone", "missing", 2, None, None),
                   ("id", "wrong_type", 2, 0, 0)]


def test_scratch_is_remembered_and_removed(spark, tmp_path):
    import os
    from costweave import session
    before = dict(session._scratch)
    session._scratch.clear()
    try:
        df = session.cut_lineage(spark.range(5))
        path = session._scratch[spark.sparkContext.applicationId][0]
        local = path.removeprefix("file://").removeprefix("file:")
        assert df.count() == 5 and os.path.isdir(local)
        assert session.clean_scratch(spark) == 1 and not os.path.exists(local) and session.clean_scratch(spark) == 0
    finally:
        session._scratch.update(before)


def _exchanges(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()
    return plan.count("RepartitionByExpression"), df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_edges_are_exchanged_once_and_without_their_hash(spark):
    src = {"lineitems": spark.createDataFrame([("L|1", "O1", "P1", "S1"), ("l|1", "o1", None, ""), (None, "O1", "P1", "S1"), ("", "O1", "P1", "S1"),
                                               ("", "o1", "P2", None), ("|x", "O1", "P1", "S1"), (None, None, None, None)],
                                              "line_id string, order_id string, part_id string, supplier_id string"),
           "orders": spark.createDataFrame([("o", "C|1"), ("o|C", "1"), ("o2", None), ("", "|x|c")], "order_id string, customer_id string")}
    names = ["lineitem_order", "lineitem_part", "lineitem_supplier", "order_customer"]
    for clean in (True, False):
        one = E.tagged_union(E.build_all(src, "b", "2024-01-01 00:00:00", names, clean))
        tagged = E.build_tagged(src, "b", "2024-01-01 00:00:00", names, clean, keep_place=True)
        columns = [*E.EDGE_COLUMNS, "edge_table"]
        assert sorted(map(str, one.select(*columns).collect())) == sorted(map(str, tagged.select(*columns).collect()))
        # the report needs no further exchange of edges: one to their place, one of sums by table
        assert _exchanges(E.edge_report(tagged)) == (1, 2)
        assert sorted(map(str, E.edge_report(tagged).collect())) == sorted(map(str, E.edge_report(one).collect()))
    assert _exchanges(E.build_tagged(src, "b", "2024-01-01 00:00:00", names)) == (1, 1)


def test_orphans_of_written_edges_and_null_ids(spark):
    src = {"orders": spark.createDataFrame([("o1", "C1"), ("O1", "c1"), ("o2", "C7"), ("o|C", "1"), ("o", "C|1")], "order_id string, customer_id string")}
    nodes = spark.createDataFrame([("order", "o1"), ("customer", "c1")], "label string, node_id string")
    read = lambda df: sorted((r.edge_id or "", r.endpoint, r.node_id or "") for r in df.collect())
    plain, kept = (E.build_tagged(src, "b", "2024-01-01 00:00:00", ["order_customer"], written=w) for w in (False, True))
    assert sorted(map(str, plain.collect())) == sorted(map(str, kept.collect()))
    found = E.orphan_edges(kept, nodes)
    assert read(found) == read(E.orphan_edges(plain, nodes)) and len(read(found)) == 4
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan                             # edges and missing nodes are read where they were written
    raw = E.raw_edges(spark.createDataFrame([(None, "C1")], "order_id string, customer_id string"), E.select_specs(["order_customer"])[0], "b", "2024-01-01 00:00:00")
    assert [r.endpoint for r in E.orphan_edges({"order_customer": raw}, nodes).collect()] == ["source"]


def test_stored_edges_lie_by_source_and_take_less_room(spark, tmp_path):
    import re

    from costweave.plans import registry
    from tests.conftest import SF001
    registry.load_all()
    names = ["lineitem_order", "lineitem_part", "lineitem_supplier", "order_customer"]
    schema = "line_id string, order_id string, part_id string, supplier_id string"
    n = F.col("id") * 7919 % 30000 + 100000                   # lines and their orders come in no order
    lines = spark.range(30000).select(F.concat(F.lit("LI-"), n.cast("string")), F.concat(F.lit("ORD-"), (n / 4).cast("long").cast("string")),
                                      F.concat(F.lit("PART-"), (n * 31 % 1999).cast("string")), F.concat(F.lit("SUPP-"), (n * 31 % 97).cast("string")))
    odd = spark.createDataFrame([("L|1", "O1", "P1", "S1"), ("l|1", "o1", None, ""), (None, "O1", "P1", "S1"), ("", "O1", "P1", "S1"),
                                 ("|x", "O1", "P1", "S1"), ("|X", "o1", "P2", "S1"), ("LI-100001", "ORD-25000", "", None), ("li-100001", "ord-25000", "P", "S")], schema)
    src = {"lineitems": odd.union(lines), "orders": spark.createDataFrame([("o", "C|1"), ("o|C", "1"), ("O", "c|1"), ("", "C")], "order_id string, customer_id string")}
    plain, kept = (E.build_tagged(src, "b", "2024-01-01 00:00:00", names, ordered=x) for x in (False, True))
    assert re.findall(r"Exchange (\w+)", kept._jdf.queryExecution().executedPlan().toString()) == ["rangepartitioning"]
    assert sorted(map(str, plain.collect())) == sorted(map(str, kept.collect()))
    # the partitions are ranges
    ends = kept.filter(F.col("edge_table").startswith("lineitem") & ~F.col("source_id").contains("|")).groupBy(F.spark_partition_id().alias("p")).agg(
        F.min("source_id_normalized").alias("low"), F.max("source_id_normalized").alias("high")).orderBy("low").collect()
    assert len(ends) > 2 and all(a.high < b.low for a, b in zip(ends, ends[1:]))

    def room(df, name):
        df.drop("edge_id").write.option("compression", "snappy").parquet(str(tmp_path / name))
        return sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))
    assert room(kept, "kept") < 0.9 * room(plain, "plain")
    # the query stores its edges so
    assert "rangepartitioning" in registry.QUERIES["build_edges"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
