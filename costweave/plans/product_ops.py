"""Landing pipelines over JSON pages, commitment recommendations, allocation
and chargeback designs, multi-provider union and history synthesis."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..forecast.synth import synthesise_history
from ..functions.tags import UNTAGGED_ID, service_id, split_path
from ..operators import landing as L
from ..operators.allocate import allocate_or_keep
from ..sources import fixtures as X
from . import oracle_adapters as O
from .registry import query

w = O.with_ctes
RUN_TS = "2001-11-04 06:00:00"


def _d(c):
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _month(c="ChargePeriodStart"):
    return F.to_date(F.date_trunc("month", c))


# ------------------------------------------------------------------ recommendations
ALT = T.StructType([T.StructField("commitmentAmount", T.DecimalType(18, 2)),
                    T.StructField("coveragePercentage", T.IntegerType()),
                    T.StructField("savingsPercentage", T.DecimalType(7, 2)),
                    T.StructField("wastageCost", T.DecimalType(20, 2))])
REC_PAGE = T.StructType([T.StructField("value", T.ArrayType(T.StructType([T.StructField("properties", T.StructType([
    T.StructField("term", T.StringType()), T.StructField("scope", T.StringType()),
    T.StructField("lookBackPeriod", T.StringType()), T.StructField("currencyCode", T.StringType()),
    T.StructField("recommendationDetails", T.StructType([T.StructField("commitmentAmount", T.DecimalType(18, 2))])),
    T.StructField("allRecommendationDetails", T.StructType([T.StructField("value", T.ArrayType(ALT))])),
]))])))])


def _alternatives(spark, root):
    pages = X.alternatives_pages(spark, root)
    parsed = pages.select("tenant_label", F.from_json("page", REC_PAGE).alias("p"))
    # every recommendation of a page, not only the first
    each = parsed.select("tenant_label", F.explode("p.value").alias("rec")).select("tenant_label", "rec.properties")
    hdr = each.withColumnRenamed("properties", "props").select("tenant_label", "props.term", "props.scope", "props.lookBackPeriod", "props.currencyCode",
                       F.col("props.recommendationDetails.commitmentAmount").alias("recommended"),
                       F.col("props.allRecommendationDetails.value").alias("alts"))
    return L.explode_alternatives(hdr, ["tenant_label", "term", "scope", "lookBackPeriod", "currencyCode"],
                                  "alts", "recommended")


_ALT_SQL = """
, b AS (SELECT r.r_name, min(CAST(o.o_totalprice AS DECIMAL(18,2))) AS lo, max(CAST(o.o_totalprice AS DECIMAL(18,2))) AS hi
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1)
, t AS (SELECT * FROM (VALUES ('P1Y', CAST(1.00 AS DECIMAL(3,2)), 6), ('P3Y', CAST(0.80 AS DECIMAL(3,2)), 4)) v(term, factor, rec))
, lv AS (SELECT b.r_name, t.term, t.rec, i,
                round((lo + (hi - lo) * (CAST(i AS DECIMAL(3,0)) * CAST(0.1 AS DECIMAL(2,1)))) * CAST(0.001 AS DECIMAL(4,3)) * factor, 2) AS amount
         FROM b CROSS JOIN t CROSS JOIN (SELECT unnest(range(1, 11)) AS i))
, alts AS (SELECT l.r_name AS tenant_label, l.term, 'Shared' AS scope, 'Last30Days' AS lookBackPeriod, 'USD' AS currencyCode,
                  l.amount AS commitmentAmount, CAST(l.i * 10 AS INTEGER) AS coveragePercentage,
                  CAST(l.i * 2.5 AS DECIMAL(7,2)) AS savingsPercentage,
                  l.amount * greatest(l.i - 5, 0) AS wastageCost,
                  l.amount = r.amount AS is_recommended
           FROM lv l JOIN lv r ON l.r_name = r.r_name AND l.term = r.term AND r.i = r.rec)
"""


@query("explode_alternatives", "WITH x AS (SELECT 1)" + _ALT_SQL + """
SELECT tenant_label, term, scope, lookBackPeriod, currencyCode, CAST(commitmentAmount AS DOUBLE) AS commitmentAmount,
       coveragePercentage, CAST(savingsPercentage AS DOUBLE) AS savingsPercentage,
       CAST(wastageCost AS DOUBLE) AS wastageCost, is_recommended FROM alts""")
def q_explode_alternatives(spark, root):
    """Recommendation pages (JSON) -> one row per alternative commitment
    level, header repeated, flag on the recommended amount."""
    a = _alternatives(spark, root)
    return a.select("tenant_label", "term", "scope", "lookBackPeriod", "currencyCode",
                    _d("commitmentAmount").alias("commitmentAmount"), "coveragePercentage",
                    _d("savingsPercentage").alias("savingsPercentage"), _d("wastageCost").alias("wastageCost"),
                    "is_recommended")


@query("commitment_lever", "WITH x AS (SELECT 1)" + _ALT_SQL + """
SELECT tenant_label, term, CAST(commitmentAmount AS DOUBLE) AS commitment_amount, coveragePercentage AS coverage_percentage,
       is_recommended FROM alts""")
def q_commitment_lever(spark, root):
    a = _alternatives(spark, root)
    return a.select("tenant_label", "term", _d("commitmentAmount").alias("commitment_amount"),
                    F.col("coveragePercentage").alias("coverage_percentage"), "is_recommended") \
        .orderBy("tenant_label", "term", "commitment_amount")


@query("wastage_variance", w(("focus", O.FOCUS)) + _ALT_SQL + """
SELECT a.tenant_label AS region, u.month, CAST(a.wastageCost AS DOUBLE) AS predicted_wastage,
       CAST(coalesce(u.unused, 0) AS DOUBLE) AS realised_unused,
       CAST(coalesce(u.unused, 0) - a.wastageCost AS DOUBLE) AS variance
FROM alts a LEFT JOIN (SELECT RegionName, date_trunc('month', ChargePeriodStart)::DATE AS month, sum(EffectiveCost) AS unused
                       FROM focus WHERE CommitmentDiscountStatus = 'Unused' GROUP BY 1, 2) u ON a.tenant_label = u.RegionName
WHERE a.term = 'P1Y' AND a.is_recommended""")
def q_wastage_variance(spark, root):
    """Predicted wastage of the recommended 1-year level vs realised unused
    commitment cost of every month (joined by region; a null month: no unused cost)."""
    a = _alternatives(spark, root).filter((F.col("term") == "P1Y") & F.col("is_recommended"))
    f = X.focus(spark, root).filter(F.col("CommitmentDiscountStatus") == "Unused")
    month = F.to_date(F.date_trunc("month", "ChargePeriodStart")).alias("month")
    u = f.groupBy(F.col("RegionName").alias("tenant_label"), month).agg(F.sum("EffectiveCost").alias("unused"))
    j = a.join(u, "tenant_label", "left")
    un = F.coalesce(F.col("unused"), F.lit(0))
    return j.select(F.col("tenant_label").alias("region"), "month", _d("wastageCost").alias("predicted_wastage"),
                    _d(un).alias("realised_unused"), _d(un - F.col("wastageCost")).alias("variance"))


# ------------------------------------------------------------------ inventory landing
RES = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("location", T.StringType()), T.StructField("subscriptionId", T.StringType()),
    T.StructField("sku", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("zones", T.ArrayType(T.StringType())),
    T.StructField("identity", T.StructType([T.StructField("type", T.StringType())])),
    T.StructField("tags", T.StructType([T.StructField("env", T.StringType())])),
    T.StructField("size", T.StringType()),
])
RES_PAGE = T.StructType([T.StructField("data", T.ArrayType(RES))])


@query("resources_landing", """
SELECT '/subscriptions/sub-' || CAST(p_partkey % 7 AS VARCHAR) || '/res-' || CAST(p_partkey AS VARCHAR) AS id,
       p_name AS name, p_type AS type, 'region-' || CAST(p_partkey % 5 AS VARCHAR) AS location,
       'sub-' || CAST(p_partkey % 7 AS VARCHAR) AS subscriptionId, p_brand AS sku,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(to_json(list_slice(['1', '2', '3'], 1, p_size % 3)) AS VARCHAR) END AS zones,
       CASE WHEN p_size % 2 = 0 THEN 'SystemAssigned' END AS identity_type,
       CASE WHEN p_size % 4 = 0 THEN '{"env":"prod"}' END AS tags,
       p_size AS size,
       CASE WHEN p_partkey % 2 = 0 THEN 'tenant-a' ELSE 'tenant-b' END AS tenant_id,
       TIMESTAMP '2001-11-04 06:00:00' AS ingestion_timestamp, DATE '2001-11-04' AS snapshot_date
FROM part""")
def q_resources_landing(spark, root):
    """Inventory pages -> typed bronze rows: parse with a declared schema,
    explode, flatten nested fields, JSON-encode arrays/objects (empty ->
    null), cast text columns, stamp tenant and audit columns."""
    pages = X.resource_pages(spark, root)
    rows = pages.select("tenant", F.explode(F.from_json("page", RES_PAGE)["data"]).alias("r")).select("tenant", "r.*")
    flat = rows.select("id", "name", "type", "location", "subscriptionId", F.col("sku.name").alias("sku"), "zones",
                       F.col("identity.type").alias("identity_type"), "tags", "size", "tenant")
    flat = L.stringify_nested(flat)
    flat = L.cast_existing(flat, {"size": "int"}, text_source=True)
    flat = flat.withColumnRenamed("tenant", "tenant_id")
    return L.add_audit(flat, RUN_TS)


ENV_PAGE = T.StructType([T.StructField("environmentId", T.StringType()),
                         T.StructField("cost", T.ArrayType(T.StructType([
                             T.StructField("capabilityKey", T.StringType()),
                             T.StructField("value", T.DecimalType(18, 2)),
                             T.StructField("bookingDate", T.StringType())])))])


@query("explode_nested", """
SELECT 'env-' || CAST(l_orderkey AS VARCHAR) AS environmentId, 'line-' || CAST(l_linenumber AS VARCHAR) AS capabilityKey,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS value, CAST(l_shipdate AS DATE) AS bookingDate
FROM lineitem""")
def q_explode_nested(spark, root):
    """Environment pages carrying a cost[] array -> one row per cost entry,
    parent id repeated.  Pages are built per order (at most seven lines)."""
    li = X.scan_table(spark, root, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"])
    entry = F.struct(F.concat(F.lit("line-"), F.col("l_linenumber").cast("string")).alias("capabilityKey"),
                     F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
                     F.date_format("l_shipdate", "yyyy-MM-dd").alias("bookingDate"))
    pages = li.groupBy("l_orderkey").agg(F.collect_list(entry).alias("cost")).select(
        F.to_json(F.struct(F.concat(F.lit("env-"), F.col("l_orderkey").cast("string")).alias("environmentId"),
                           "cost")).alias("page"))
    env = pages.select(F.from_json("page", ENV_PAGE).alias("e")).select("e.*")
    out = L.explode_nested(env, ["environmentId"], "cost")
    return out.select("environmentId", "capabilityKey", _d("value").alias("value"),
                      F.to_date("bookingDate").alias("bookingDate"))


# ------------------------------------------------------------------ allocation and chargeback
@query("department_chargeback", w(("focus", O.FOCUS)) + f"""
, s AS (SELECT CAST(date_trunc('month', ChargePeriodStart) AS DATE) AS month, {O.SERVICE_ID_EXPR} AS sid, EffectiveCost FROM focus)
, direct AS (SELECT month, split_part(sid, '/', 1) AS department, split_part(sid, '/', 2) AS cost_centre,
                    sum(EffectiveCost) AS direct_cost FROM s WHERE sid <> '{UNTAGGED_ID}' GROUP BY 1, 2, 3)
, pool AS (SELECT month, sum(EffectiveCost) AS shared_pool FROM s WHERE sid = '{UNTAGGED_ID}' GROUP BY 1)
, tot AS (SELECT month, sum(direct_cost) AS total_direct FROM direct GROUP BY 1)
SELECT d.month, d.department, d.cost_centre, CAST(d.direct_cost AS DOUBLE) AS direct_cost,
       CAST(coalesce(p.shared_pool, 0) AS DOUBLE) AS shared_pool,
       CAST(coalesce(p.shared_pool, 0) AS DOUBLE) * CAST(d.direct_cost AS DOUBLE) / CAST(t.total_direct AS DOUBLE) AS allocated_cost,
       CAST(d.direct_cost AS DOUBLE) + CAST(coalesce(p.shared_pool, 0) AS DOUBLE) * CAST(d.direct_cost AS DOUBLE) / CAST(t.total_direct AS DOUBLE) AS total_cost
FROM direct d JOIN tot t ON d.month = t.month LEFT JOIN pool p ON d.month = p.month""")
def q_department_chargeback(spark, root):
    """Direct cost by department (division) and cost centre (platform); the
    Untagged pool is shared in proportion to direct cost each month."""
    # month x Service_ID once; pool and totals are windows over its few rows of a month
    f = X.focus(spark, root).groupBy(_month().alias("month"), service_id("Tags").alias("sid")).agg(F.sum("EffectiveCost").alias("cost"))
    untagged = F.col("sid") == UNTAGGED_ID
    g = f.withColumn("department", F.when(~untagged, F.split("sid", "/")[0])).withColumn(
        "cost_centre", F.when(~untagged, F.split("sid", "/")[1]))
    g = g.groupBy("month", "department", "cost_centre").agg(F.sum("cost").alias("direct_cost"))
    own = Window.partitionBy("month")
    shared = F.col("department").isNull()
    g = g.withColumns({"shared_pool": F.sum(F.when(shared, F.col("direct_cost"))).over(own),
                       "total_direct": F.sum(F.when(~shared, F.col("direct_cost"))).over(own)})
    j = g.filter(~shared)
    sp = _d(F.coalesce(F.col("shared_pool"), F.lit(0)))
    alloc = sp * _d("direct_cost") / _d("total_direct")
    return j.select("month", "department", "cost_centre", _d("direct_cost").alias("direct_cost"),
                    sp.alias("shared_pool"), alloc.alias("allocated_cost"),
                    (_d("direct_cost") + alloc).alias("total_cost"))


# Fixed allocation rules: service -> business unit shares (sum to 1 per service).
ALLOCATION_RULES = [("A", "BU1", "0.60"), ("A", "BU2", "0.40"), ("N", "BU2", "1.00"),
                    ("R", "BU1", "0.50"), ("R", "BU3", "0.50")]
BUSINESS_UNITS = [("BU1", "Retail"), ("BU2", "Wholesale"), ("BU3", "Services")]
_RULES_SQL = " UNION ALL ".join(f"SELECT '{s}' AS service, '{b}' AS bu_id, CAST({x} AS DECIMAL(3,2)) AS share"
                                for s, b, x in ALLOCATION_RULES)
_BU_SQL = " UNION ALL ".join(f"SELECT '{b}' AS bu_id, '{n}' AS bu_name" for b, n in BUSINESS_UNITS)


def _rules(spark, rules=ALLOCATION_RULES):
    r = spark.createDataFrame(rules, "service string, bu_id string, share string")
    return r.select("service", "bu_id", F.col("share").cast("decimal(3,2)").alias("share"))


@query("allocate_by_rule", w(("focus", O.FOCUS)) + f"""
SELECT b.bu_name, CAST(date_trunc('month', f.ChargePeriodStart) AS DATE) AS month,
       CAST(sum(f.EffectiveCost * r.share) AS DOUBLE) AS allocated_cost
FROM focus f JOIN ({_RULES_SQL}) r ON f.ServiceName = r.service JOIN ({_BU_SQL}) b ON r.bu_id = b.bu_id
GROUP BY 1, 2""")
def q_allocate_by_rule(spark, root):
    """Cost x allocation rules (on service) x business unit, summed.  The
    rule table is a handful of rows, broadcast with a fixed size bound."""
    bu = spark.createDataFrame(BUSINESS_UNITS, "bu_id string, bu_name string")
    f = X.focus(spark, root).select("ServiceName", "ChargePeriodStart", "EffectiveCost")
    j = f.join(F.broadcast(_rules(spark)), f.ServiceName == F.col("service")).join(F.broadcast(bu), "bu_id")
    return j.groupBy("bu_name", _month().alias("month")).agg(
        _d(F.sum(F.col("EffectiveCost") * F.col("share"))).alias("allocated_cost"))


# A draft of the rules with one share mistyped and one service forgotten, for the check.
DRAFT_RULES = [r if r != ("A", "BU1", "0.60") else ("A", "BU1", "0.06") for r in ALLOCATION_RULES if r[0] != "N"]
_DRAFT_SQL = " UNION ALL ".join(f"SELECT '{s}' AS service, '{b}' AS bu_id, CAST({x} AS DECIMAL(3,2)) AS share" for s, b, x in DRAFT_RULES)


def _rule_check(rules):
    return f"""SELECT s.service, CAST(coalesce(sum(r.share), 0) AS DOUBLE) AS share_total, CAST(s.cost AS DOUBLE) AS cost
FROM (SELECT ServiceName AS service, sum(EffectiveCost) AS cost FROM focus GROUP BY 1) s LEFT JOIN ({rules}) r ON s.service = r.service
GROUP BY 1, 3 HAVING coalesce(sum(r.share), 0) <> 1"""


def _check_rules(spark, root, rules):
    svc = X.focus(spark, root).groupBy(F.col("ServiceName").alias("service")).agg(F.sum("EffectiveCost").alias("cost"))
    s = svc.join(_rules(spark, rules), "service", "left").groupBy("service", "cost").agg(F.coalesce(F.sum("share"), F.lit(0)).alias("t"))
    return s.filter(F.col("t") != 1).select("service", _d("t").alias("share_total"), _d("cost").alias("cost"))


@query("allocation_rule_check", w(("focus", O.FOCUS)) + _rule_check(_RULES_SQL))
def q_allocation_rule_check(spark, root):
    """Services billed in the fact whose rule shares do not sum to 1 (cost
    would be dropped or duplicated), and the cost at stake."""
    return _check_rules(spark, root, ALLOCATION_RULES)


@query("allocation_draft_check", w(("focus", O.FOCUS)) + _rule_check(_DRAFT_SQL))
def q_allocation_draft_check(spark, root):
    """The same check on a draft that has two faults."""
    return _check_rules(spark, root, DRAFT_RULES)


@query("enrich_org", w(("focus", O.FOCUS)) + """
SELECT o.org_name, CAST(date_trunc('month', f.ChargePeriodStart) AS DATE) AS month, CAST(sum(f.BilledCost) AS DOUBLE) AS cost
FROM focus f
JOIN (SELECT 'res-' || CAST(p_partkey AS VARCHAR) AS resource_id, 'org-' || CAST(p_size % 5 AS VARCHAR) AS org_id FROM part) m
  ON f.ResourceId = m.resource_id
JOIN (SELECT DISTINCT 'org-' || CAST(p_size % 5 AS VARCHAR) AS org_id, 'Organisation ' || CAST(p_size % 5 AS VARCHAR) AS org_name FROM part) o
  ON m.org_id = o.org_id
GROUP BY 1, 2""")
def q_enrich_org(spark, root):
    """Cost joined to a resource mapping and the organisation table."""
    p = X.scan_table(spark, root, "part", ["p_partkey", "p_size"])
    org_id = F.concat(F.lit("org-"), (F.col("p_size") % 5).cast("string"))
    mapping = p.select(F.concat(F.lit("res-"), F.col("p_partkey").cast("string")).alias("ResourceId"), org_id.alias("org_id"))
    orgs = p.select(org_id.alias("org_id"),
                    F.concat(F.lit("Organisation "), (F.col("p_size") % 5).cast("string")).alias("org_name")).distinct()
    f = X.focus(spark, root).select("ResourceId", "ChargePeriodStart", "BilledCost")
    j = f.join(mapping, "ResourceId").join(orgs, "org_id")
    return j.groupBy("org_name", _month().alias("month")).agg(_d(F.sum("BilledCost")).alias("cost"))


@query("emissions_allocated", w(("focus", O.FOCUS), ("carbon", O.EMISSIONS)) + f"""
, rc AS (SELECT ResourceId AS resource_id, CAST(date_trunc('month', ChargePeriodStart) AS DATE) AS month,
                {O.SERVICE_ID_EXPR} AS service_id, sum(BilledCost) AS cost FROM focus GROUP BY 1, 2, 3)
, rt AS (SELECT resource_id, month, sum(cost) AS total FROM rc GROUP BY 1, 2)
, em AS (SELECT resource_id, report_month AS month, sum(CAST(latest_month_emissions AS DECIMAL(38,6))) AS emissions
         FROM carbon GROUP BY 1, 2)
SELECT coalesce(rc.service_id, 'unallocated') AS service_id, em.month,
       CAST(sum(CAST(CAST(em.emissions AS DOUBLE) * coalesce(CAST(rc.cost AS DOUBLE) / CAST(rt.total AS DOUBLE), 1.0) AS DECIMAL(38,6))) AS DOUBLE) AS allocated_emissions
FROM em LEFT JOIN (SELECT * FROM rt WHERE total <> 0) rt ON rt.resource_id = em.resource_id AND rt.month = em.month
LEFT JOIN rc ON rc.resource_id = rt.resource_id AND rc.month = rt.month
GROUP BY 1, 2""")
def q_emissions_allocated(spark, root):
    """Each resource's monthly emissions split over the Service_IDs that
    carry its cost, in proportion to cost; without cost that month they stay
    as unallocated.  Both sides are aggregated to resource x month before the join."""
    f = X.focus(spark, root)
    rc = f.groupBy(F.col("ResourceId").alias("resource_id"), _month().alias("month"),
                   service_id("Tags").alias("service_id")).agg(F.sum("BilledCost").alias("cost"))
    em = X.emissions(spark, root).groupBy("resource_id", F.col("report_month").alias("month")).agg(
        F.sum(F.col("latest_month_emissions").cast("decimal(38,6)")).alias("emissions"))
    out = allocate_or_keep(em, rc, ["resource_id", "month"], "service_id", "cost", "emissions")
    return out.groupBy("service_id", "month").agg(_d(F.sum(F.col("emissions").cast("decimal(38,6)"))).alias("allocated_emissions"))


@query("utilisation_bands", w(("fact", O.CAPACITY_FACT), ("items", O.ITEMS)) + """
, per AS (SELECT item_id, CAST(sum(success_count) AS DOUBLE) * 100.0 / CAST(sum(operation_count) AS DOUBLE) AS util,
                 CAST(sum(duration_s) AS DOUBLE) AS spend FROM fact GROUP BY 1)
, kinds AS (SELECT DISTINCT item_id, item_kind FROM items)
SELECT k.item_kind AS resource_type,
       CASE WHEN util < 40 THEN 'Low' WHEN util < 70 THEN 'Medium' ELSE 'High' END AS utilisation_band,
       count(*) AS resources,
       CAST(sum(CAST(spend * (100.0 - util) / 100.0 AS DECIMAL(38,6))) AS DOUBLE) AS potential_savings
FROM per p JOIN kinds k ON p.item_id = k.item_id GROUP BY 1, 2""")
def q_utilisation_bands(spark, root):
    """Per item: success share of operations as utilisation, banded; idle
    share of spend as potential savings, by resource type and band."""
    f = X.capacity_fact(spark, root)
    per = f.groupBy("item_id").agg(
        (_d(F.sum("success_count")) * 100.0 / _d(F.sum("operation_count"))).alias("util"),
        _d(F.sum("duration_s")).alias("spend"))
    kinds = X.capacity_dims(spark, root)["items"].select("item_id", "item_kind").distinct()
    j = per.join(kinds, "item_id")
    band = F.when(F.col("util") < 40, "Low").when(F.col("util") < 70, "Medium").otherwise("High")
    saving = (F.col("spend") * (100.0 - F.col("util")) / 100.0).cast("decimal(38,6)")
    return j.groupBy(F.col("item_kind").alias("resource_type"), band.alias("utilisation_band")).agg(
        F.count(F.lit(1)).alias("resources"), _d(F.sum(saving)).alias("potential_savings"))


# ------------------------------------------------------------------ unions and synthesis
@query("multi_cloud_union", """
SELECT provider, CAST(date_trunc('month', date) AS DATE) AS month, service, CAST(sum(cost) AS DOUBLE) AS cost, count(*) AS records
FROM (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS service, CAST(o_totalprice AS DECIMAL(18,2)) AS cost,
             'cloud_a' AS provider FROM orders
      UNION ALL
      SELECT CAST(ts AS DATE), event_type, CAST(value AS DECIMAL(18,2)), 'cloud_b' FROM events)
GROUP BY 1, 2, 3""")
def q_multi_cloud_union(spark, root):
    """Two providers' exports renamed to one shape and unioned by name."""
    src = X.two_clouds(spark, root)
    a = src["cloud_a"].select(F.to_date("UsageDate").alias("date"), F.col("ServiceName").alias("service"),
                              F.col("PreTaxCost").alias("cost"), F.lit("cloud_a").alias("provider"))
    b = src["cloud_b"].select(F.to_date("usage_start_time").alias("date"), F.col("product_code").alias("service"),
                              F.col("unblended_cost").alias("cost"), F.lit("cloud_b").alias("provider"))
    return a.unionByName(b).groupBy("provider", F.to_date(F.date_trunc("month", "date")).alias("month"), "service").agg(
        _d(F.sum("cost")).alias("cost"), F.count(F.lit(1)).alias("records"))


_SYN_SQL = """
, daily AS (SELECT SubAccountId AS sub, CAST(ChargePeriodStart AS DATE) AS d, sum(BilledCost) AS c FROM focus GROUP BY 1, 2)
, base AS (SELECT sub, CAST(sum(c) AS DOUBLE) / count(*) AS baseline FROM daily GROUP BY 1)
, start AS (SELECT min(d) AS s FROM daily)
, syn AS (
  SELECT b.sub, CAST((SELECT s FROM start) - CAST(k AS INTEGER) AS DATE) AS ds, k AS days_back, b.baseline
  FROM base b CROSS JOIN (SELECT unnest(range(1, 691)) AS k))
, syn2 AS (SELECT ds AS ChargePeriodStart, ds + 1 AS ChargePeriodEnd, sub AS SubAccountId, 'Subscription-' || sub AS SubAccountName,
       CAST(CAST(greatest(0.0, baseline * pow(1.015, -(days_back / 30.0))
             * CASE month(ds) WHEN 8 THEN 0.90 WHEN 12 THEN 0.85 WHEN 9 THEN 1.05 ELSE 1.0 END
             * CASE WHEN isodow(ds) >= 6 THEN 0.75 ELSE 1.0 END) AS DECIMAL(38,4)) AS DOUBLE) AS BilledCost
       FROM syn)
"""


@query("synthesise_history", w(("focus", O.FOCUS)) + _SYN_SQL + """
SELECT ChargePeriodStart, ChargePeriodEnd, SubAccountId, SubAccountName, BilledCost, BilledCost AS EffectiveCost,
       'USD' AS Currency, false AS IsPartialMonthRecord FROM syn2""")
def q_synthesise_history(spark, root):
    """23 x 30 days of history before the first real day per subscription
    (trend, season and weekend factors; growth and noise draws off so the
    result is exact - see ``forecast.synth`` for the seeded version)."""
    return synthesise_history(X.focus(spark, root), noise=False)


@query("concat_real_synth", w(("focus", O.FOCUS)) + _SYN_SQL + """
SELECT SubAccountId, count(*) AS rows, count(ServiceName) AS rows_with_service,
       CAST(sum(CAST(BilledCost AS DECIMAL(38,4))) AS DOUBLE) AS cost
FROM (SELECT ChargePeriodStart, SubAccountId, BilledCost, CAST(NULL AS VARCHAR) AS ServiceName FROM syn2
      UNION ALL SELECT CAST(ChargePeriodStart AS DATE), SubAccountId, CAST(BilledCost AS DOUBLE), ServiceName FROM focus)
GROUP BY 1""")
def q_concat_real_synth(spark, root):
    """8-column synthetic rows stacked with full FOCUS rows (unequal
    schemas, aligned by name; missing columns null)."""
    f = X.focus(spark, root)
    syn = synthesise_history(f, noise=False)
    real = f.withColumn("ChargePeriodStart", F.to_date("ChargePeriodStart")) \
        .withColumn("BilledCost", _d("BilledCost"))
    u = syn.unionByName(real.select("ChargePeriodStart", "SubAccountId", "BilledCost", "ServiceName"),
                        allowMissingColumns=True)
    return u.groupBy("SubAccountId").agg(F.count(F.lit(1)).alias("rows"), F.count("ServiceName").alias("rows_with_service"),
                                         _d(F.sum(F.col("BilledCost").cast("decimal(38,4)"))).alias("cost"))
