"""Adapters: driver tables -> the shapes the cost products read.

The reference's inputs (FOCUS billing export, hourly usage, seats,
capacity telemetry, inventories ...) are not shipped, so each input is
derived from the driver tables by a fixed rule.  Every adapter is a lazy
DataFrame plan over whole tables; the oracle SQL in ``plans.oracle``
rebuilds the same rule in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .tables import scan_table

MONEY = "decimal(18,2)"
MONEY4 = "decimal(18,4)"


def _t(spark, root, name, *cols):
    return scan_table(spark, root, name, list(cols) if cols else None)


def customer_dim(spark: SparkSession, root: str) -> DataFrame:
    """customer + nation + region; the two tiny dims are broadcast."""
    region = _t(spark, root, "region", "r_regionkey", "r_name")
    nation = _t(spark, root, "nation", "n_nationkey", "n_name", "n_regionkey")
    cust = _t(spark, root, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return cust.join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey)


def focus(spark: SparkSession, root: str) -> DataFrame:
    """FOCUS-shaped cost fact: one row per lineitem.

    Tags carry ``Service_ID = region/segment/linestatus/returnflag`` except
    line 7 (no tags), line 6 (two parts only) and line 5 with partkey%10=0
    (malformed JSON).  Returned rows (flag R) are commitment-covered:
    EffectiveCost takes a further 10 points of discount, except committed
    'Used' rows on partkey%50=0 where it equals BilledCost (a seeded export
    error for the amortisation check).
    """
    li = _t(spark, root, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = _t(spark, root, "orders", "o_orderkey", "o_custkey")
    cust = customer_dim(spark, root).select("c_custkey", "c_mktsegment", "r_name")
    # orders x customer is keyed on custkey, then lineitem x that on orderkey:
    # both are shuffle (or AQE-broadcast) equi-joins, never a cross product.
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey)
    f = li.join(oc, li.l_orderkey == oc.o_orderkey)

    list_cost = F.col("l_extendedprice").cast(MONEY)
    disc = F.col("l_discount").cast("decimal(4,2)")
    billed = (list_cost * (F.lit(1) - disc)).cast(MONEY4)
    committed = (list_cost * (F.lit(0.9).cast("decimal(2,1)") - disc)).cast(MONEY4)
    is_r = F.col("l_returnflag") == "R"
    status = (F.when(is_r & (F.col("l_linestatus") == "F"), F.lit("Used"))
              .when(is_r & (F.col("l_linestatus") == "O"), F.lit("Unused")))
    effective = (F.when(is_r & (F.col("l_linestatus") == "F") & (F.col("l_partkey") % 50 == 0), billed)
                 .when(is_r, committed).otherwise(billed))
    sid4 = F.concat_ws("/", "r_name", "c_mktsegment", "l_linestatus", "l_returnflag")
    sid2 = F.concat_ws("/", "r_name", "c_mktsegment")
    tags = (F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
            .when(F.col("l_linenumber") == 6, F.concat(F.lit('{"Service_ID":"'), sid2, F.lit('"}')))
            .when((F.col("l_linenumber") == 5) & (F.col("l_partkey") % 10 == 0), F.lit("{bad"))
            .otherwise(F.concat(F.lit('{"Service_ID":"'), sid4, F.lit('"}'))))
    currency = (F.when(F.col("r_name") == "EUROPE", F.lit("EUR"))
                .when(F.col("r_name") == "MIDDLE EAST", F.lit("GBP")).otherwise(F.lit("USD")))
    sub = F.concat(F.lit("sub-"), F.col("l_suppkey").cast("string"))
    return f.select(
        F.col("l_shipdate").alias("ChargePeriodStart"),
        (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("ChargePeriodEnd"),
        billed.alias("BilledCost"),
        effective.alias("EffectiveCost"),
        list_cost.alias("ListCost"),
        billed.alias("ContractedCost"),
        sub.alias("SubAccountId"),
        F.concat(F.lit("Subscription "), F.col("l_suppkey").cast("string")).alias("SubAccountName"),
        tags.alias("Tags"),
        currency.alias("Currency"),
        (F.dayofmonth("l_shipdate") > 28).alias("IsPartialMonthRecord"),
        F.col("l_returnflag").alias("ServiceName"),
        F.concat(F.lit("res-"), F.col("l_partkey").cast("string")).alias("ResourceId"),
        F.when(is_r, F.concat(F.lit("cd-"), F.col("l_suppkey").cast("string"))).alias("CommitmentDiscountId"),
        status.alias("CommitmentDiscountStatus"),
        F.col("r_name").alias("RegionName"),
    )


# --------------------------------------------------------------- usage
USAGE_SNAPSHOTS = 3        # snapshot_date = hour's day + 0..2
RESTATE_MOD = 50           # events with event_id % 50 = 0 are restated x1.01 in the last snapshot


def usage_hourly(spark: SparkSession, root: str) -> DataFrame:
    """Hourly eligible usage per subscription, landed in three overlapping
    daily snapshots; the last snapshot restates some hours (x1.01).
    Events are aggregated to user x hour first (map-side partial
    aggregate), and only the small hourly result is replicated."""
    ev = _t(spark, root, "events", "event_id", "ts", "user_id", "value")
    v = F.col("value").cast("decimal(12,2)")
    factor = F.when(F.col("event_id") % RESTATE_MOD == 0, F.lit("1.01")).otherwise(F.lit("1.00")).cast("decimal(3,2)")
    restated = v * factor
    hourly = (ev.groupBy("user_id", F.date_trunc("hour", "ts").alias("hour_utc"))
              .agg(F.sum(v).alias("_c0"), F.sum(restated).alias("_c2")))
    snaps = hourly.select("*", F.explode(F.sequence(F.lit(0), F.lit(USAGE_SNAPSHOTS - 1))).alias("_k"))
    snap_date = F.date_add(F.to_date("hour_utc"), F.col("_k"))
    return snaps.select(
        F.concat(F.lit("tenant-"), (F.col("user_id") % 3).cast("string")).alias("tenant_id"),
        F.concat(F.lit("sub-"), F.col("user_id").cast("string")).alias("subscription_id"),
        F.col("hour_utc").cast("timestamp_ntz").alias("hour_utc"),
        F.when(F.col("_k") == USAGE_SNAPSHOTS - 1, F.col("_c2")).otherwise(F.col("_c0"))
        .cast(MONEY4).alias("hourly_charge"),
        F.lit("USD").alias("currency_code"),
        snap_date.alias("snapshot_date"),
        (snap_date.cast("timestamp_ntz") + F.expr("INTERVAL 6 HOURS")).alias("ingestion_timestamp"),
    )


# --------------------------------------------------------------- seats
SEATS_NOW = "2001-08-02 00:00:00"


def seats(spark: SparkSession, root: str) -> DataFrame:
    """One seat per customer; last activity = newest order."""
    cust = customer_dim(spark, root).select("c_custkey", "c_mktsegment", "n_name", "r_name")
    orders = _t(spark, root, "orders", "o_custkey", "o_orderdate")
    last = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_activity_at"))
    s = cust.join(last, cust.c_custkey == last.o_custkey, "left")
    key = F.col("c_custkey").cast("string")
    return s.select(
        F.concat(F.lit("user-"), key).alias("user_login"),
        F.concat(F.lit("User "), key).alias("user_name"),
        F.concat(F.lit("user"), key, F.lit("@example.com")).alias("user_email"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.col("last_activity_at").cast("timestamp_ntz").alias("last_activity_at"),
        F.col("c_mktsegment").alias("last_activity_editor"),
        F.col("n_name").alias("assigning_team"),
        F.col("r_name").alias("organization"),
        F.lit(SEATS_NOW[:10]).cast("date").alias("snapshot_date"),
    )


# --------------------------------------------------------------- two grains
def grains(spark: SparkSession, root: str) -> DataFrame:
    """Same cost at two grains in one table: per order ('subscription') and
    per order x line ('environment', line 7 never attributed)."""
    li = _t(spark, root, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    price = F.col("l_extendedprice").cast(MONEY)
    sub = li.groupBy("l_orderkey").agg(F.sum(price).alias("cost_value"), F.count(F.lit(1)).alias("rows"))
    env = (li.filter(F.col("l_linenumber") != 7).groupBy("l_orderkey", "l_linenumber")
           .agg(F.sum(price).alias("cost_value"), F.count(F.lit(1)).alias("rows")))
    sid = F.concat(F.lit("sub-"), F.col("l_orderkey").cast("string"))
    a = sub.select(sid.alias("subscription_uuid"), F.lit(None).cast("string").alias("environment_id"),
                   F.lit("subscription").alias("grain"), "cost_value", "rows")
    b = env.select(sid.alias("subscription_uuid"),
                   F.concat(F.lit("env-"), F.col("l_linenumber").cast("string")).alias("environment_id"),
                   F.lit("environment").alias("grain"), "cost_value", "rows")
    return a.unionByName(b)


# --------------------------------------------------------------- capacity telemetry
CAPACITY_AS_OF = "2001-11-04"


def capacity_fact(spark: SparkSession, root: str) -> DataFrame:
    li = _t(spark, root, "lineitem", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    op = (F.when(F.col("l_returnflag") == "A", F.lit("Query"))
          .when(F.col("l_returnflag") == "N", F.lit("Refresh")).otherwise(F.lit("Copy")))
    return li.select(
        F.concat(F.lit("cap-"), (F.col("l_suppkey") % 4).cast("string")).alias("capacity_id"),
        F.concat(F.lit("ws-"), F.col("l_suppkey").cast("string")).alias("workspace_id"),
        F.concat(F.lit("item-"), F.col("l_partkey").cast("string")).alias("item_id"),
        op.alias("operation_name"),
        F.to_date("l_shipdate").alias("usage_date"),
        F.col("l_quantity").cast(MONEY).alias("cu_s"),
        F.col("l_extendedprice").cast(MONEY).alias("duration_s"),
        F.lit(1).cast("long").alias("operation_count"),
        (F.col("l_linestatus") == "F").cast("long").alias("success_count"),
        (F.col("l_linestatus") == "O").cast("long").alias("failure_count"),
        F.col("l_tax").cast("decimal(6,2)").alias("throttling_s"),
        F.col("l_linenumber").cast("long").alias("user_count"),
    )


def capacity_dims(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    sup = _t(spark, root, "supplier", "s_suppkey", "s_name")
    part = _t(spark, root, "part", "p_partkey", "p_name", "p_type")
    caps = (sup.select((F.col("s_suppkey") % 4).alias("k")).distinct()
            .select(F.concat(F.lit("cap-"), F.col("k").cast("string")).alias("capacity_id"),
                    F.concat(F.lit("Capacity "), F.col("k").cast("string")).alias("capacity_name"),
                    F.concat(F.lit("F"), (F.col("k") * 2 + 2).cast("string")).alias("sku")))
    ws = sup.select(F.concat(F.lit("ws-"), F.col("s_suppkey").cast("string")).alias("workspace_id"),
                    F.col("s_name").alias("workspace_name"))
    item = F.concat(F.lit("item-"), F.col("p_partkey").cast("string"))
    cur = part.select(item.alias("item_id"), F.col("p_name").alias("item_name"),
                      F.col("p_type").alias("item_kind"),
                      F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("Timestamp"))
    old = part.filter(F.col("p_partkey") % 10 == 0).select(
        item.alias("item_id"), F.concat(F.col("p_name"), F.lit(" (old)")).alias("item_name"),
        F.col("p_type").alias("item_kind"),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("Timestamp"))
    return {"capacities": caps, "workspaces": ws, "items": cur.unionByName(old)}


# --------------------------------------------------------------- inventories
CONTAINER_TYPES = {
    # Container type strings (matched case-insensitively).
    "management_group": "Microsoft.Management/managementGroups",
    "subscription": "Microsoft.Resources/subscriptions",
    "resource_group": "Microsoft.Resources/subscriptions/resourceGroups",
}


def containers(spark: SparkSession, root: str) -> DataFrame:
    region = _t(spark, root, "region", "r_regionkey", "r_name")
    nation = _t(spark, root, "nation", "n_nationkey", "n_name")
    cust = _t(spark, root, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    mg = region.select(
        F.concat(F.lit("/providers/Microsoft.Management/managementGroups/"), F.col("r_name")).alias("id"),
        F.col("r_name").alias("name"),
        F.when(F.col("r_regionkey") < 3, F.lit(CONTAINER_TYPES["management_group"]))
        .otherwise(F.lit(None).cast("string")).alias("type"),
        F.lit(None).cast("string").alias("subscriptionId"),
        F.lit(None).cast("string").alias("resourceGroup"),
        F.lit(None).cast("string").alias("tags"))
    odd = region.select(
        F.concat(F.lit("/providers/Other/"), F.col("r_name")).alias("id"),
        F.col("r_name").alias("name"),
        F.when(F.col("r_regionkey") < 3, F.concat(F.lit("Microsoft.Unknown/type"), F.col("r_regionkey").cast("string")))
        .alias("type"),
        F.lit(None).cast("string").alias("subscriptionId"),
        F.lit(None).cast("string").alias("resourceGroup"),
        F.lit(None).cast("string").alias("tags")).filter(F.col("type").isNotNull())
    subs = nation.select(
        F.concat(F.lit("/subscriptions/sub-"), F.col("n_nationkey").cast("string")).alias("id"),
        F.col("n_name").alias("name"),
        F.lower(F.lit(CONTAINER_TYPES["subscription"])).alias("type"),
        F.concat(F.lit("sub-"), F.col("n_nationkey").cast("string")).alias("subscriptionId"),
        F.lit(None).cast("string").alias("resourceGroup"),
        F.lit('{"owner":"finance"}').alias("tags"))
    rg_type = F.when(F.col("c_custkey") % 2 == 0, F.upper(F.lit(CONTAINER_TYPES["resource_group"]))) \
        .otherwise(F.lit(CONTAINER_TYPES["resource_group"]))
    rgs = cust.select(
        F.concat(F.lit("/subscriptions/sub-"), F.col("c_nationkey").cast("string"),
                 F.lit("/resourceGroups/rg-"), F.col("c_custkey").cast("string")).alias("id"),
        F.concat(F.lit("rg-"), F.col("c_custkey").cast("string")).alias("name"),
        rg_type.alias("type"),
        F.concat(F.lit("sub-"), F.col("c_nationkey").cast("string")).alias("subscriptionId"),
        F.concat(F.lit("rg-"), F.col("c_custkey").cast("string")).alias("resourceGroup"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(None).cast("string"))
        .when(F.col("c_custkey") % 3 == 1, F.lit("{}"))
        .otherwise(F.concat(F.lit('{"env":"'), F.lower("c_mktsegment"), F.lit('"}'))).alias("tags"))
    return mg.unionByName(odd).unionByName(subs).unionByName(rgs)


def emissions(spark: SparkSession, root: str) -> DataFrame:
    """Carbon rows: lineitem by month of shipdate; tenant = linestatus."""
    li = _t(spark, root, "lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
            "l_linestatus", "l_shipdate")
    return li.select(
        F.col("l_linestatus").alias("tenant_id"),
        F.concat(F.lit("Tenant "), F.col("l_linestatus")).alias("tenant_label"),
        F.to_date(F.date_trunc("month", "l_shipdate")).alias("report_month"),
        F.lit("Resource").alias("category_type"),
        F.concat(F.lit("sub-"), F.col("l_suppkey").cast("string")).alias("subscription_id"),
        F.concat(F.lit("res-"), F.col("l_partkey").cast("string")).alias("resource_id"),
        F.concat(F.lit("region-"), (F.col("l_partkey") % 5).cast("string")).alias("location"),
        F.col("l_returnflag").alias("resource_type"),
        F.col("l_quantity").alias("latest_month_emissions"),
    )


def pipeline_items(spark: SparkSession, root: str) -> DataFrame:
    """Pipeline run (order) x work item (lineitem)."""
    o = _t(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    li = _t(spark, root, "lineitem", "l_orderkey", "l_partkey", "l_returnflag")
    j = o.join(li, o.o_orderkey == li.l_orderkey)
    return j.select(
        F.col("o_orderkey").alias("run_id"),
        (F.col("o_custkey") % 25).alias("pipeline_id"),
        F.concat(F.lit("pipeline-"), (F.col("o_custkey") % 25).cast("string")).alias("pipeline_name"),
        F.col("o_orderpriority").alias("folder"),
        F.col("o_orderstatus").alias("result"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_date"),
        F.col("l_partkey").alias("work_item_id"),
        F.col("l_returnflag").alias("work_item_type"),
    )


def directory(spark: SparkSession, root: str) -> DataFrame:
    """Hosting directory: one ServiceID per nation, padded and mixed case."""
    n = _t(spark, root, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = _t(spark, root, "region", "r_regionkey", "r_name")
    j = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    sid = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("  "), F.lower("n_name"), F.lit(" "))) \
        .otherwise(F.col("n_name"))
    return j.select(sid.alias("ServiceID"),
                    F.concat(F.lit("plat-"), F.col("n_regionkey").cast("string")).alias("PlatformID"),
                    F.col("r_name").alias("DivisionID"),
                    F.concat(F.lit("CC"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0")).alias("CostCentre"))


def service_requests(spark: SparkSession, root: str) -> DataFrame:
    """Deployment requests (customer x nation name), some to unknown ids."""
    c = _t(spark, root, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    n = _t(spark, root, "nation", "n_nationkey", "n_name")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    sid = F.when(F.col("c_custkey") % 50 == 0, F.concat(F.lit("unknown-"), F.col("c_nationkey").cast("string"))) \
        .otherwise(F.col("n_name"))
    env = (F.when(F.col("c_custkey") % 7 == 0, F.lit(" Production"))
           .when(F.col("c_mktsegment") == "BUILDING", F.lit(" PROD "))
           .when(F.col("c_mktsegment") == "MACHINERY", F.lit("dev"))
           .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("Test"))
           .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("qa"))
           .otherwise(F.lit("staging")))
    return j.select(F.col("c_custkey").alias("request_id"), sid.alias("service_id"), env.alias("environment"))


def edge_sources(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Bronze extracts feeding the edge specs; an extract can hold several relationships."""
    li = _t(spark, root, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = _t(spark, root, "orders", "o_orderkey", "o_custkey")
    c = _t(spark, root, "customer", "c_custkey", "c_nationkey")
    n = _t(spark, root, "nation", "n_nationkey", "n_regionkey")
    s = _t(spark, root, "supplier", "s_suppkey", "s_nationkey")
    p = _t(spark, root, "part", "p_partkey", "p_brand")
    e = _t(spark, root, "events", "event_id", "user_id")
    g = _t(spark, root, "pages", "page_id", "url")
    lab = _t(spark, root, "labels", "doc_id", "quality")

    def key(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    line_id = F.concat(key("LI-", "l_orderkey"), key("-", "l_linenumber"))
    cust_t = (F.when(F.col("o_orderkey") % 97 == 0, F.lit(""))
              .when(F.col("o_orderkey") % 89 == 0, F.lit(None).cast("string")).otherwise(key("CUST-", "o_custkey")))
    return {
        "lineitems": li.select(line_id.alias("line_id"), key("ORD-", "l_orderkey").alias("order_id"),
                               key("PART-", "l_partkey").alias("part_id"), key("SUPP-", "l_suppkey").alias("supplier_id")),
        "orders": o.select(key("ord-", "o_orderkey").alias("order_id"), cust_t.alias("customer_id")),
        "customers": c.select(key("CUST-", "c_custkey").alias("customer_id"), key("NAT-", "c_nationkey").alias("nation_id")),
        "nations": n.select(key("NAT-", "n_nationkey").alias("nation_id"), key("REG-", "n_regionkey").alias("region_id")),
        "suppliers": s.select(key("SUPP-", "s_suppkey").alias("supplier_id"), key("NAT-", "s_nationkey").alias("nation_id")),
        "parts": p.select(key("PART-", "p_partkey").alias("part_id"), F.col("p_brand").alias("brand_id")),
        "events": e.select(key("EV-", "event_id").alias("event_id"), key("CUST-", "user_id").alias("customer_id")),
        "pages": g.select(key("PAGE-", "page_id").alias("page_id"), F.regexp_extract("url", "://([^/?#]*)", 1).alias("host_id")),
        "labels": lab.select(key("DOC-", "doc_id").alias("document_id"), key("Q-", "quality").alias("quality_id")),
    }


def resource_tags(spark: SparkSession, root: str) -> DataFrame:
    """Resource inventory with JSON tags: the run (order) that deployed the resource
    (part) is its first one.  Some have no tags, malformed ones, or a run that nobody knows."""
    li = _t(spark, root, "lineitem", "l_partkey", "l_orderkey")
    r = li.groupBy("l_partkey").agg(F.min("l_orderkey").alias("run"))
    run = F.col("run").cast("string")
    tags = (F.when(F.col("l_partkey") % 11 == 0, F.lit(None).cast("string"))
            .when(F.col("l_partkey") % 11 == 1, F.lit('{"pipeline_run_id":'))
            .when(F.col("l_partkey") % 11 == 2, F.concat(F.lit('{"pipeline_run_id":"gone-'), run, F.lit('"}')))
            .otherwise(F.concat(F.lit('{"owner":"team","pipeline_run_id":"'), run, F.lit('"}'))))
    return r.select(F.concat(F.lit("res-"), F.col("l_partkey").cast("string")).alias("ResourceId"), tags.alias("tags"))


def two_clouds(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Provider 1 = orders, provider 2 = events, each with its own names."""
    o = _t(spark, root, "orders", "o_orderdate", "o_orderpriority", "o_totalprice")
    e = _t(spark, root, "events", "ts", "event_type", "value")
    p1 = o.select(F.col("o_orderdate").alias("UsageDate"), F.col("o_orderpriority").alias("ServiceName"),
                  F.col("o_totalprice").cast(MONEY).alias("PreTaxCost"))
    p2 = e.select(F.col("ts").alias("usage_start_time"), F.col("event_type").alias("product_code"),
                  F.col("value").cast(MONEY).alias("unblended_cost"))
    return {"cloud_a": p1, "cloud_b": p2}


def usage_packed(spark: SparkSession, root: str, seeded: bool = True) -> DataFrame:
    """Latest-snapshot usage per subscription-day packed as a 24-slot
    charges array (gaps filled with 0) + first hour + declared hours.
    ``seeded``: the declared count is wrong (23) for users % 7 = 0 on 2024-01-15.
    Groups are bounded: at most 24 values per subscription-day."""
    u = usage_hourly(spark, root)
    u = u.groupBy("subscription_id", "hour_utc").agg(
        F.max_by(F.struct("tenant_id", "hourly_charge"), "snapshot_date").alias("u")).select("subscription_id", "hour_utc", "u.*")
    u = cut_lineage(u)                      # feeds the days and the filled slots
    days = u.select("tenant_id", "subscription_id", F.to_date("hour_utc").alias("usage_day")).distinct()
    slots = days.select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
    slots = slots.withColumn("hour_utc", F.col("usage_day").cast("timestamp_ntz") + F.make_interval(hours=F.col("h")))
    filled = slots.join(u.select("subscription_id", "hour_utc", "hourly_charge"), ["subscription_id", "hour_utc"], "left")
    packed = filled.groupBy("tenant_id", "subscription_id", "usage_day").agg(
        F.sort_array(F.collect_list(F.struct("h", F.coalesce("hourly_charge", F.lit(0)).cast(MONEY4).alias("c")))).alias("_s"))
    uid = F.regexp_extract("subscription_id", r"(\d+)$", 1).cast("int")
    declared = F.when(F.lit(seeded) & (uid % 7 == 0) & (F.col("usage_day") == F.lit("2024-01-15").cast("date")), 23).otherwise(24)
    return packed.select("tenant_id", "subscription_id", "usage_day",
                         F.col("usage_day").cast("timestamp_ntz").alias("first_hour"),
                         F.transform("_s", lambda x: x["c"]).alias("charges"), declared.alias("total_hours"))


# --------------------------------------------------------------- commitments
TERMS = [("P1Y", "1.00", 6), ("P3Y", "0.80", 4)]   # term, amount factor, recommended level


def alternatives_pages(spark: SparkSession, root: str) -> DataFrame:
    """One recommendation page (JSON text) per region x term, carrying ten
    alternative commitment levels on an equal-width ladder between the
    region's smallest and largest order total.  A page holds at most ten
    alternatives, so the per-page collect is bounded."""
    o = _t(spark, root, "orders", "o_custkey", "o_totalprice")
    cust = customer_dim(spark, root).select("c_custkey", "r_name")
    j = o.join(cust, o.o_custkey == cust.c_custkey)
    price = F.col("o_totalprice").cast(MONEY)
    b = j.groupBy("r_name").agg(F.min(price).alias("lo"), F.max(price).alias("hi"))
    terms = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(f).alias("factor"), F.lit(r).alias("rec"))
                      for t, f, r in TERMS])
    b = b.select("*", F.explode(terms).alias("_t")).select("r_name", "lo", "hi", "_t.*")
    lv = b.select("*", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("i"))
    step = F.col("i").cast("decimal(3,0)") * F.lit("0.1").cast("decimal(2,1)")
    amount = F.round((F.col("lo") + (F.col("hi") - F.col("lo")) * step) * F.lit("0.001").cast("decimal(4,3)")
                     * F.col("factor").cast("decimal(3,2)"), 2)
    alt = F.struct(amount.alias("commitmentAmount"), (F.col("i") * 10).alias("coveragePercentage"),
                   (F.col("i").cast("decimal(4,1)") * F.lit("2.5").cast("decimal(2,1)")).alias("savingsPercentage"),
                   (amount * F.greatest(F.col("i") - 5, F.lit(0))).alias("wastageCost"))
    lv = lv.withColumn("alt", alt)
    rec_amount = F.max(F.when(F.col("i") == F.col("rec"), F.col("alt.commitmentAmount")))
    pages = lv.groupBy("r_name", "term").agg(F.sort_array(F.collect_list(F.struct("i", "alt"))).alias("_alts"),
                                             rec_amount.alias("rec_amount"))
    props = F.struct(F.col("term"), F.lit("Shared").alias("scope"), F.lit("Last30Days").alias("lookBackPeriod"),
                     F.lit("USD").alias("currencyCode"),
                     F.struct(F.col("rec_amount").alias("commitmentAmount")).alias("recommendationDetails"),
                     F.struct(F.transform("_alts", lambda x: x["alt"]).alias("value")).alias("allRecommendationDetails"))
    return pages.select(F.col("r_name").alias("tenant_label"),
                        F.to_json(F.struct(F.array(F.struct(props.alias("properties"))).alias("value"))).alias("page"))


# --------------------------------------------------------------- inventory pages
def resource_pages(spark: SparkSession, root: str) -> DataFrame:
    """Graph-inventory result pages (JSON text, <= 1000 records each) built
    from ``part``: nested sku / identity objects, a zones array and tags."""
    p = _t(spark, root, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    zones = F.slice(F.array(F.lit("1"), F.lit("2"), F.lit("3")), 1, F.col("p_size") % 3)
    rec = F.struct(
        F.concat(F.lit("/subscriptions/sub-"), (F.col("p_partkey") % 7).cast("string"), F.lit("/res-"),
                 F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_name").alias("name"), F.col("p_type").alias("type"),
        F.concat(F.lit("region-"), (F.col("p_partkey") % 5).cast("string")).alias("location"),
        F.concat(F.lit("sub-"), (F.col("p_partkey") % 7).cast("string")).alias("subscriptionId"),
        F.struct(F.col("p_brand").alias("name")).alias("sku"),
        zones.alias("zones"),
        F.struct(F.when(F.col("p_size") % 2 == 0, F.lit("SystemAssigned")).alias("type")).alias("identity"),
        F.when(F.col("p_size") % 4 == 0, F.struct(F.lit("prod").alias("env"))).alias("tags"),
        F.col("p_size").cast("string").alias("size"),
    )
    page_no = (F.col("p_partkey") / 1000).cast("long")
    tenant = F.when(F.col("p_partkey") % 2 == 0, F.lit("tenant-a")).otherwise(F.lit("tenant-b"))
    pages = p.groupBy(tenant.alias("tenant"), page_no.alias("page_no")).agg(F.collect_list(rec).alias("data"))
    return pages.select("tenant", "page_no", F.to_json(F.struct("data")).alias("page"))
