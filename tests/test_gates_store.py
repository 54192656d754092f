import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from costweave.operators import edges as E
from costweave.operators import gates as G
from costweave.operators import landing as L
from costweave.sources.store import TableStore, guard_empty, verify_written


def _ts(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


@pytest.mark.parametrize("start,fails", [(11, True), (10, False)])   # prior max = hour 9
def test_continuity_gate_hours(spark, start, fails):
    prior = spark.createDataFrame([("s1", _ts(h)) for h in range(0, 10)] + [("s2", _ts(3))], "k string, ts timestamp_ntz")
    new = spark.createDataFrame([("s1", _ts(start)), ("s3", _ts(50))], "k string, ts timestamp_ntz")
    v = G.continuity_gate(prior, new, ["k"], "ts", "1 HOUR")
    assert (v.count() == 1) is fails   # s2 vanished and s3 is new: neither reported (inner join)


@pytest.mark.parametrize("newest,status", [(dt.date(2024, 1, 8), "STALE"), (dt.date(2024, 1, 9), "FRESH")])
def test_freshness_gate(spark, newest, status):
    df = spark.createDataFrame([(newest,)], "usage_date date")
    r = G.freshness_gate(df, "usage_date", "2024-01-11", 2).first()
    assert r.status == status


def test_length_gate_and_unpack(spark):
    df = spark.createDataFrame([("a", _ts(0), [1.0, 2.0], 2), ("b", _ts(0), [1.0, 2.0], 3)],
                               "k string, first timestamp_ntz, charges array<double>, hours int")
    assert [r.k for r in G.length_gate(df, "hours", "charges", ["k"]).collect()] == ["b"]
    out = L.hourly_from_array(df.filter("k = 'a'"), ["k"], "first", "charges", "hours").collect()
    assert [(r.hour_utc, r.hourly_charge) for r in out] == [(_ts(0), 1.0), (_ts(1), 2.0)]
    with pytest.raises(Exception):
        L.hourly_from_array(df, ["k"], "first", "charges", "hours").collect()


def test_edge_gate_catches_seeded_violations(spark):
    src = spark.createDataFrame([("A", "x"), ("a", "X"), ("b", ""), ("c", None)], "s string, t string")
    spec = E.EdgeSpec("t1", "x", "n", "s", "rel", "m", "t")
    raw = {"t1": E.raw_edges(src, spec, "b1", "2024-01-01 00:00:00")}
    rep = E.edge_report(raw).first()
    assert (rep.null_target, rep.duplicate_edge_ids) == (2, 1)
    assert E.edge_gate(E.edge_report(raw)).count() == 1
    built = {"t1": E.build_edges(src, spec, "b1", "2024-01-01 00:00:00")}
    assert E.edge_gate(E.edge_report(built)).count() == 0
    assert built["t1"].count() == 1


def test_schema_contract(spark):
    from costweave.operators.joins import schema_contract, schema_frame
    live = schema_frame(spark, {"t": spark.createDataFrame([(1, 2)], "a int, b int")}).drop("data_type")
    exp = spark.createDataFrame([("t", "a"), ("t", "renamed")], "table_name string, column_name string")
    assert [r.column_name for r in schema_contract(exp, live).collect()] == ["renamed"]


def test_rule_report(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-2.0,)], "cost double")
    r = {x.rule: x.violations for x in G.rule_report(df, {"not_null": F.col("cost").isNull(),
                                                          "non_negative": F.col("cost") < 0}).collect()}
    assert r == {"not_null": 1, "non_negative": 1}


def test_rule_report_fails_an_empty_frame(spark):
    rules = {"not_null": F.col("cost").isNull()}
    for rows, failed in (([], 1), ([(1.0,)], 0)):
        df = spark.createDataFrame(rows, "cost double")
        got = {x.rule: x.violations for x in G.rule_report(df, rules, non_empty="non_empty").collect()}
        assert got == {"not_null": 0, "non_empty": failed}


def test_store_idempotent_writes(spark):
    root = tempfile.mkdtemp(prefix="cw-store-")
    st = TableStore(spark, root)
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, snapshot_date string")
    for _ in range(2):
        st.append_snapshot(df, "seats")
    assert st.read("seats").count() == 2                    # rerun replaces, never doubles
    st.replace_partition(spark.createDataFrame([(9, "2024-01-02")], "v int, snapshot_date string"), "seats",
                         ["snapshot_date"])
    got = sorted((r.v, str(r.snapshot_date)) for r in st.read("seats").collect())
    assert got == [(1, "2024-01-01"), (9, "2024-01-02")]     # other partition untouched
    st.write_overwrite(df, "t")
    st.write_merge_schema(spark.createDataFrame([(3,)], "v int"), "t")
    assert set(st.read("t").columns) == {"v", "snapshot_date"}
    st.upsert(spark.createDataFrame([(3, "new")], "v int, snapshot_date string"), "t", ["v"])
    assert st.read("t").count() == 1
    assert st.register("t") == 1
    assert verify_written(df, df, ["snapshot_date"]).count() == 0
    assert guard_empty(spark.createDataFrame([], "v int"), "skip") is False
    with pytest.raises(RuntimeError):
        guard_empty(spark.createDataFrame([], "v int"), "fail")


def _rows(df, *cols):
    return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())


def test_store_writers_mixed_on_one_table(spark):
    st = TableStore(spark, tempfile.mkdtemp(prefix="cw-store-"))
    day = "v int, snapshot_date string"
    st.write_overwrite(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")], day), "t",
                       ["snapshot_date"])
    st.replace_partition(spark.createDataFrame([(9, "2024-01-02")], day), "t", ["snapshot_date"])
    assert _rows(st.read("t"), "v") == [("1",), ("3",), ("9",)]
    st.upsert(spark.createDataFrame([(3, "2024-01-03"), (4, "2024-01-03")], day), "t", ["v"])
    st.upsert(spark.createDataFrame([(1, "2024-01-01"), (5, "2024-01-01")], day), "t", ["v", "snapshot_date"])
    st.compact("t", ["v"], 2)
    st.append_snapshot(spark.createDataFrame([(7, "2024-01-04")], day), "t")
    st.save_append_merge(spark.createDataFrame([(8, "2024-01-04", "x")], day + ", note string"), "t")
    assert _rows(st.read("t"), "v", "snapshot_date", "note") == [
        ("1", "2024-01-01", "None"), ("3", "2024-01-03", "None"), ("4", "2024-01-03", "None"), ("5", "2024-01-01", "None"),
        ("7", "2024-01-04", "None"), ("8", "2024-01-04", "x"), ("9", "2024-01-02", "None")]
    assert st.partition_columns("t") == ["snapshot_date"]
    with pytest.raises(ValueError):
        st.replace_partition(spark.createDataFrame([(9, "2024-01-02")], day), "t", ["v"])
    assert st.register("t") == 7
    assert spark.table("t").filter("note = 'x' and snapshot_date = '2024-01-04'").count() == 1


def test_store_run_dates_and_absent_tables(spark):
    st = TableStore(spark, tempfile.mkdtemp(prefix="cw-store-"))
    assert not st.exists("runs")
    st.replace_run_date(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, run_date string"), "runs")
    st.replace_run_date(spark.createDataFrame([(5, "2024-01-02")], "v int, run_date string"), "runs")
    assert _rows(st.read("runs"), "v") == [("1",), ("5",)]
    st.save_append_merge(spark.createDataFrame([(1,)], "v int"), "fresh")
    st.save_append_merge(spark.createDataFrame([(2, "b")], "v int, w string"), "fresh")
    assert _rows(st.read("fresh"), "v", "w") == [("1", "None"), ("2", "b")]


def test_upsert_keeps_null_partitions_and_null_keys(spark):
    st = TableStore(spark, tempfile.mkdtemp(prefix="cw-store-"))
    schema = "v int, part string"
    st.write_overwrite(spark.createDataFrame([(1, "a"), (2, None), (3, None), (None, "a")], schema), "t", ["part"])
    st.upsert(spark.createDataFrame([(4, None)], schema), "t", ["v", "part"])
    assert _rows(st.read("t"), "v", "part") == [("1", "a"), ("2", "None"), ("3", "None"), ("4", "None"), ("None", "a")]
    st.upsert(spark.createDataFrame([(2, ""), (None, "a"), (5, "b")], schema), "t", ["v", "part"])
    assert _rows(st.read("t"), "v", "part") == [("1", "a"), ("2", "None"), ("3", "None"), ("4", "None"), ("5", "b"), ("None", "a")]
    st.upsert(spark.createDataFrame([(1, None), (9, "b")], schema), "t", ["v"])
    assert _rows(st.read("t"), "v", "part") == [("1", "None"), ("2", "None"), ("3", "None"), ("4", "None"), ("5", "b"),
                                                ("9", "b"), ("None", "a")]
