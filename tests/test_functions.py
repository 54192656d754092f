import datetime as dt

import pytest
from pyspark.sql import functions as F

from costweave.functions.rules import activity_band, days_since, fiscal_year, horizon_bucket, lifecycle_class
from costweave.functions.tags import UNTAGGED_ID, is_tagged, service_id, with_hierarchy_cols


def test_service_id_rules(spark):
    rows = [('{"Service_ID":"a/b/c/d"}',), ('{"Service_ID":"a///d"}',), ('{"Service_ID":"a/b/c"}',),
            ('{"Service_ID":"a/b/c/d/e"}',), ('{bad',), (None,), ('{"other":1}',)]
    out = [r[0] for r in spark.createDataFrame(rows, "Tags string").select(service_id("Tags")).collect()]
    assert out == ["a/b/c/d", "a///d", UNTAGGED_ID, UNTAGGED_ID, UNTAGGED_ID, UNTAGGED_ID, UNTAGGED_ID]


def test_hierarchy_cols_and_unknown_depth(spark):
    df = spark.createDataFrame([("total",), ("total/a",), ("total/a//c/d",)], "unique_id string")
    got = {r.unique_id: (r.level, r.division, r.platform, r.workload, r.component)
           for r in with_hierarchy_cols(df).collect()}
    assert got["total"] == ("total", None, None, None, None)
    assert got["total/a"] == ("division", "a", None, None, None)
    assert got["total/a//c/d"] == ("component", "a", "", "c", "d")
    bad = spark.createDataFrame([("total/a/b/c/d/e",)], "unique_id string")
    with pytest.raises(Exception):
        with_hierarchy_cols(bad).collect()


def test_activity_bands_and_days(spark):
    now = dt.datetime(2024, 3, 31, 12, 0)
    rows = [(None,), (now - dt.timedelta(days=5),), (now - dt.timedelta(days=45),), (now - dt.timedelta(days=75),),
            (now - dt.timedelta(days=200),), (now - dt.timedelta(hours=13),)]
    df = spark.createDataFrame(rows, "last timestamp_ntz")
    nowc = F.lit(now).cast("timestamp_ntz")
    out = df.select(activity_band("last", nowc).alias("b"), days_since("last", nowc).alias("d")).collect()
    assert [r.b for r in out] == ["Never Active", "Active (< 30 days)", "Inactive (30-60 days)",
                                  "Inactive (60-90 days)", "Inactive (> 90 days)", "Active (< 30 days)"]
    assert [r.d for r in out] == [None, 5, 45, 75, 200, 0]   # truncated whole days


def test_buckets_lifecycle_fiscal(spark):
    df = spark.createDataFrame([(0,), (1,), (28,), (29,), (182,), (183,)], "d int")
    assert [r[0] for r in df.select(horizon_bucket("d")).collect()] == [None, "01-28d", "01-28d", "29-91d", "92-182d", None]
    lc = spark.createDataFrame([(100.0, 1.0), (1.0, 100.0), (10.0, 20.0), (20.0, 10.0)], "b double, a double")
    assert [r[0] for r in lc.select(lifecycle_class("b", "a")).collect()] == ["shutdown", "launch", "increase", "decrease"]
    fy = spark.createDataFrame([(dt.date(2025, 8, 31),), (dt.date(2025, 9, 1),)], "d date")
    assert [r[0] for r in fy.select(fiscal_year("d")).collect()] == [2025, 2026]


def test_is_tagged(spark):
    df = spark.createDataFrame([(None,), ("null",), ("{}",), ('{"a":1}',)], "t string")
    assert [r[0] for r in df.select(is_tagged("t")).collect()] == [False, False, False, True]


def test_landing_helpers(spark):
    from costweave.operators.landing import batch_id, normalise_headers, select_available, select_tenants
    df = spark.createDataFrame([(1, 2, 3)], "`Capacity[Capacity Id]` int, `[Total CU]` int, x int")
    assert normalise_headers(df, {"Total CU": "total_cu"}).columns == ["Capacity Id", "total_cu", "x"]
    assert select_available(df.toDF("a", "b", "c"), ["c", "zz", "a"]).columns == ["c", "a"]
    cfg = spark.createDataFrame([("t1", "alpha"), ("00000000-0000-0000-0000-000000000000", "beta")],
                                "tenant_id string, label string")
    assert [r.label for r in select_tenants(cfg).collect()] == ["alpha"]
    assert select_tenants(cfg, ["beta"]).count() == 0
    with pytest.raises(ValueError):
        select_tenants(cfg, ["gamma"])
    assert batch_id("2001-11-04T06:07:08Z") == "batch_20011104_060708"


def test_iso_timestamps_with_fractions_and_offsets(spark):
    from costweave.functions.rules import parse_iso_ts
    texts = ["2024-03-01T10:20:30.1234567Z", "2024-03-01T12:20:30+02:00", "2024-03-01T12:20:30.5+0200",
             "2024-03-01 10:20:30", "2024-03-01", "2024", "nonsense", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", parse_iso_ts("t").cast("string").alias("ts")).orderBy("i").collect()
    assert [r["ts"] for r in rows] == ["2024-03-01 10:20:30.123456", "2024-03-01 10:20:30", "2024-03-01 10:20:30.5",
                                      "2024-03-01 10:20:30", "2024-03-01 00:00:00", None, None, None]


def test_strict_iso_and_horizon_label(spark):
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F
    from costweave.functions.rules import horizon_label, parse_iso_strict
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), (None,)], "t string")
    assert [str(r[0]) for r in df.select(parse_iso_strict("t").cast("timestamp_ntz")).collect()] == ["2024-01-02 03:04:05", "None"]
    try:
        spark.createDataFrame([("yesterday",)], "t string").select(parse_iso_strict("t")).collect()
        raised = False
    except PySparkException as e:
        raised = "not an ISO time: yesterday" in str(e)
    assert raised
    days = spark.createDataFrame([("2025-08-31",), ("2025-09-01",), ("2025-12-31",), ("2026-08-31",), ("2026-09-01",)], "d string").select(F.to_date("d").alias("d"))
    got = [r[0] for r in days.select(horizon_label("d", F.lit("2025-12-01").cast("date"))).collect()]
    assert got == ["FY2025 actual", "FY2026 actual", "FY2026 to go", "FY2026 to go", "FY2027 plan"]
