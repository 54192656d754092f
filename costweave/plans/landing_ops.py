"""Queries over landed files: JSON pages by the dataset registry, mounted
external files, tables that may be missing, month modes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from ..operators import datasets as D
from ..operators import landing as L
from ..session import scratch_path
from ..sources import fixtures as X
from ..sources.tables import read_external, scan_or_empty, scan_table
from . import oracle_adapters as O
from .registry import query

w = O.with_ctes
RUN_TS = "2001-11-04 06:00:00"
TENANTS = {"tenant-a": "Tenant A", "tenant-b": "Tenant B"}


def _folder(spark) -> str:
    return scratch_path(spark, "landing")


def _write_pages(pages, spark):
    """Pages (tenant, page) as text files, a page a line, in a folder for each tenant;
    to each tenant's comes a copy of a page cut off in the middle and an error reply."""
    base = _folder(spark)
    first = pages.groupBy("tenant").agg(F.min("page").alias("page"))
    cut = first.select("tenant", F.expr("substring(page, 1, cast(length(page) / 2 as int))").alias("page"))
    reply = first.select("tenant", F.lit('{"error":"throttled"}').alias("page"))
    rows = pages.select("tenant", "page").unionByName(cut).unionByName(reply)
    rows.select("tenant", F.col("page").alias("value")).write.partitionBy("tenant").text(base)
    return {(t, label): f"{base}/tenant={t}" for t, label in TENANTS.items()}


_RESOURCES = """
SELECT '/subscriptions/sub-' || CAST(p_partkey % 7 AS VARCHAR) || '/res-' || CAST(p_partkey AS VARCHAR) AS id,
       p_name AS name, p_type AS type, 'region-' || CAST(p_partkey % 5 AS VARCHAR) AS location,
       'sub-' || CAST(p_partkey % 7 AS VARCHAR) AS subscriptionId, p_brand AS sku,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(to_json(list_slice(['1', '2', '3'], 1, p_size % 3)) AS VARCHAR) END AS zones,
       CASE WHEN p_size % 2 = 0 THEN 'SystemAssigned' END AS identity_type,
       CASE WHEN p_size % 4 = 0 THEN '{"env":"prod"}' END AS tags, p_size AS size,
       CASE WHEN p_partkey % 2 = 0 THEN 'tenant-a' ELSE 'tenant-b' END AS tenant_id,
       CASE WHEN p_partkey % 2 = 0 THEN 'Tenant A' ELSE 'Tenant B' END AS tenant_label,
       TIMESTAMP '2001-11-04 06:00:00' AS ingestion_timestamp, DATE '2001-11-04' AS snapshot_date
FROM part"""


@query("land_resources", _RESOURCES)
def q_land_resources(spark, root):
    """Inventory pages of two tenants -> typed rows, by the registry."""
    tenants = _write_pages(X.resource_pages(spark, root), spark)
    rows, _ = D.land_tenants(spark, tenants, D.dataset("resources"), RUN_TS)
    return rows.drop("source_file")


@query("landing_pages", """
WITH p AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'tenant-a' ELSE 'tenant-b' END AS tenant_id, p_partkey // 1000 AS page FROM part)
SELECT tenant_id, 'landed' AS outcome, count(DISTINCT page) AS pages, count(*) AS records FROM p GROUP BY 1
UNION ALL SELECT DISTINCT tenant_id, 'malformed', 1, 0 FROM p
UNION ALL SELECT DISTINCT tenant_id, 'no_records', 1, 0 FROM p""")
def q_landing_pages(spark, root):
    """Pages and records by tenant: landed, and quarantined by reason."""
    tenants = _write_pages(X.resource_pages(spark, root), spark)
    return D.page_counts(spark, tenants, D.dataset("resources"))


def seat_pages(spark, root, size: int = 100):
    """Seats API pages, at most ``size`` seats each, by tenant."""
    s = X.seats(spark, root)
    n = F.regexp_extract("user_login", r"(\d+)$", 1).cast("long")
    rec = F.struct(F.struct(F.col("user_login").alias("login"), F.col("user_email").alias("email")).alias("assignee"),
                   F.struct(F.col("organization").alias("login")).alias("organization"),
                   F.struct(F.col("assigning_team").alias("name")).alias("assigning_team"),
                   F.date_format("last_activity_at", "yyyy-MM-dd'T'HH:mm:ss").alias("last_activity_at"), "last_activity_editor")
    tenant = F.when(n % 2 == 0, "tenant-a").otherwise("tenant-b")
    pages = s.groupBy(tenant.alias("tenant"), F.floor(n / (2 * size)).alias("page_no")).agg(F.collect_list(rec).alias("seats"))
    return pages.select("tenant", F.to_json(F.struct("seats")).alias("page"))


@query("land_seats", w(("seats", O.SEATS)) + """
SELECT user_login, user_email, organization, assigning_team, date_trunc('second', last_activity_at)::TIMESTAMP AS last_activity_at, last_activity_editor,
       CASE WHEN CAST(regexp_extract(user_login, '([0-9]+)$', 1) AS BIGINT) % 2 = 0 THEN 'tenant-a' ELSE 'tenant-b' END AS tenant_id,
       TIMESTAMP '2001-11-04 06:00:00' AS ingestion_timestamp, DATE '2001-11-04' AS snapshot_date FROM seats""")
def q_land_seats(spark, root):
    """Seat pages with nested people and teams -> flat rows; a seat never used has a null."""
    rows, _ = D.land_tenants(spark, _write_pages(seat_pages(spark, root), spark), D.dataset("seats"), RUN_TS)
    return rows.drop("source_file", "tenant_label")


@query("read_external", """
SELECT n_name, count(*) AS suppliers, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def q_read_external(spark, root):
    """Suppliers from a mounted folder of gzip CSV files, read with a declared schema."""
    folder = _folder(spark)
    scan_table(spark, root, "supplier", ["s_suppkey", "s_nationkey", "s_acctbal"]).write.option("header", "true").option(
        "compression", "gzip").csv(folder)
    schema = _parse_datatype_string("s_suppkey bigint, s_nationkey int, s_acctbal decimal(18,2)")
    ext = read_external(spark, folder, "csv", schema)
    nation = scan_table(spark, root, "nation", ["n_nationkey", "n_name"])
    return ext.join(nation, ext["s_nationkey"] == nation["n_nationkey"]).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("suppliers"), F.sum("s_acctbal").cast("double").alias("balance"))


@query("scan_or_empty", """
SELECT 'orders' AS extract, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows FROM orders GROUP BY 2""")
def q_scan_or_empty(spark, root):
    """Two extracts, of which one has not landed yet, counted by year."""
    base = _folder(spark)
    scan_table(spark, root, "orders", ["o_orderkey", "o_orderdate"]).write.parquet(f"{base}/orders")
    schema = _parse_datatype_string("o_orderkey bigint, o_orderdate timestamp_ntz")
    both = [scan_or_empty(spark, f"{base}/{name}", schema).select(F.lit(name).alias("extract"), F.year("o_orderdate").alias("year"))
            for name in ("orders", "returns")]
    return both[0].unionByName(both[1]).groupBy("extract", "year").agg(F.count(F.lit(1)).alias("rows"))


@query("resolve_months_all", w(("carbon", O.EMISSIONS)) + "SELECT DISTINCT report_month FROM carbon")
def q_resolve_months_all(spark, root):
    return L.resolve_months(X.emissions(spark, root), "all")


@query("resolve_months_one", w(("carbon", O.EMISSIONS)) + """
SELECT report_month, count(*) AS records FROM carbon WHERE strftime(report_month, '%Y-%m') = '1995-06' GROUP BY 1""")
def q_resolve_months_one(spark, root):
    """One month by name (YYYY-MM), and what would be loaded for it."""
    c = X.emissions(spark, root)
    month = L.resolve_months(c, "1995-06")
    return c.join(month, "report_month", "left_semi").groupBy("report_month").agg(F.count(F.lit(1)).alias("records"))
