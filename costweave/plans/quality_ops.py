"""Edges, gates, rule reports and packed-array landing, with oracles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.tags import UNTAGGED, service_id
from ..operators import edges as E
from ..operators import gates as G
from ..operators import landing as L
from ..operators.hierarchy import hierarchy_series
from ..session import cut_lineage, scratch_path
from ..sources import fixtures as X
from ..sources.store import TableStore, row_count_match, written_counts
from ..sources.tables import scan_table
from . import oracle_adapters as O
from .registry import query

w = O.with_ctes
BATCH = "batch_20011104_060000"
OBSERVED = "2001-11-04 06:00:00"


def _d(c):
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# ------------------------------------------------------------------ edges
def _edge_sql(spec: E.EdgeSpec, clean: bool) -> str:
    src = f"e_{spec.extract}"
    base = f"""SELECT CASE WHEN {spec.source_col} IS NOT NULL AND {spec.target_col} IS NOT NULL
                     THEN sha256('{spec.relationship_type}|' || lower({spec.source_col}) || '|' || lower({spec.target_col})) END AS edge_id,
       '{spec.source_label}' AS source_label, {spec.source_col} AS source_id, '{spec.relationship_type}' AS relationship_type,
       '{spec.target_label}' AS target_label, {spec.target_col} AS target_id, CAST({spec.confidence} AS DOUBLE) AS confidence,
       '{{"edge":"{spec.name}","extract":"{spec.extract}"}}' AS properties_json,
       lower({spec.source_col}) AS source_id_normalized, lower({spec.target_col}) AS target_id_normalized,
       '{BATCH}' AS batch_id, TIMESTAMP '{OBSERVED}' AS observed_at, '{spec.name}' AS edge_table
FROM {src}"""
    if not clean:
        return base
    return f"""SELECT edge_id, min(source_label) AS source_label, min(source_id) AS source_id,
       min(relationship_type) AS relationship_type, min(target_label) AS target_label, min(target_id) AS target_id,
       min(confidence) AS confidence, min(properties_json) AS properties_json,
       min(source_id_normalized) AS source_id_normalized, min(target_id_normalized) AS target_id_normalized,
       min(batch_id) AS batch_id, min(observed_at) AS observed_at, min(edge_table) AS edge_table
FROM ({base}) WHERE source_id IS NOT NULL AND source_id <> '' AND target_id IS NOT NULL AND target_id <> ''
GROUP BY edge_id"""


def _edges_cte(clean: bool) -> str:
    extracts = dict.fromkeys(s.extract for s in E.EDGE_SPECS)
    return w(*[(f"e_{x}", getattr(O, f"EDGE_{x.upper()}")) for x in extracts],
             ("edges", " UNION ALL ".join(f"({_edge_sql(s, clean)})" for s in E.EDGE_SPECS)))


_REPORT_SQL = """
SELECT edge_table, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(null_source) AS BIGINT) AS null_source,
       CAST(sum(null_target) AS BIGINT) AS null_target,
       CAST(sum(CASE WHEN edge_id IS NOT NULL AND n > 1 THEN n - 1 ELSE 0 END) AS BIGINT) AS duplicate_edge_ids
FROM (SELECT edge_table, edge_id, count(*) AS n,
             count_if(source_id IS NULL OR source_id = '') AS null_source,
             count_if(target_id IS NULL OR target_id = '') AS null_target
      FROM edges GROUP BY 1, 2) GROUP BY 1"""


def _built(spark, root, clean=True, **how):
    return E.build_tagged(X.edge_sources(spark, root), BATCH, OBSERVED, clean=clean, **how)


@query("build_edges", _edges_cte(True) + "SELECT * FROM edges")
def q_build_edges(spark, root):
    """All edge tables, each row with the table it belongs to."""
    return _built(spark, root, ordered=True)


@query("edge_catalogue", _edges_cte(True) + """
SELECT edge_table, min(source_label) AS source_label, min(relationship_type) AS relationship_type,
       min(target_label) AS target_label, count(*) AS edges FROM edges GROUP BY 1""")
def q_edge_catalogue(spark, root):
    u = _built(spark, root)
    return u.groupBy("edge_table").agg(F.min("source_label").alias("source_label"),
                                       F.min("relationship_type").alias("relationship_type"),
                                       F.min("target_label").alias("target_label"),
                                       F.count(F.lit(1)).alias("edges"))


@query("edge_report", _edges_cte(True) + _REPORT_SQL)
def q_edge_report(spark, root):
    return E.edge_report(_built(spark, root, keep_place=True))


@query("edge_gate_raw", _edges_cte(False) + f"""
SELECT * FROM ({_REPORT_SQL}) WHERE null_source > 0 OR null_target > 0 OR duplicate_edge_ids > 0""")
def q_edge_gate_raw(spark, root):
    """The gate applied to un-cleaned edges: seeded empty / null endpoints and
    duplicate lineitem keys must show up."""
    return E.edge_gate(E.edge_report(_built(spark, root, clean=False, keep_place=True)))


@query("orphan_edges", _edges_cte(True) + """
, nodes AS (
  SELECT DISTINCT 'lineitem' AS label, lower(line_id) AS node_id FROM e_lineitems
  UNION SELECT DISTINCT 'order', lower(order_id) FROM e_lineitems
  UNION SELECT DISTINCT 'customer', lower(customer_id) FROM e_customers
  UNION SELECT DISTINCT 'nation', lower(nation_id) FROM e_nations
  UNION SELECT DISTINCT 'supplier', lower(supplier_id) FROM e_suppliers
  UNION SELECT DISTINCT 'part', lower(part_id) FROM e_parts)
SELECT edge_table, edge_id, 'source' AS endpoint, source_label AS label, source_id_normalized AS node_id FROM edges e
WHERE source_label IN (SELECT label FROM nodes)
  AND NOT EXISTS (SELECT 1 FROM nodes n WHERE n.label = e.source_label AND n.node_id = e.source_id_normalized)
UNION ALL
SELECT edge_table, edge_id, 'target', target_label, target_id_normalized FROM edges e
WHERE target_label IN (SELECT label FROM nodes)
  AND NOT EXISTS (SELECT 1 FROM nodes n WHERE n.label = e.target_label AND n.node_id = e.target_id_normalized)""")
def q_orphan_edges(spark, root):
    """Both endpoint checks read the silver edge tables, which are written
    once (checkpoint) as the reference writes them before validating; what can
    be derived from the endpoints (ids, labels) is derived again, not written."""
    src = X.edge_sources(spark, root)
    edges = E.build_tagged(src, BATCH, OBSERVED, written=True)
    return E.orphan_edges(edges, E.node_ids(src))


@query("busiest_edge_table", _edges_cte(True) + """
SELECT edge_table, count(*) AS rows FROM edges GROUP BY 1 ORDER BY rows DESC, edge_table LIMIT 1""")
def q_busiest(spark, root):
    r = _built(spark, root).groupBy("edge_table").agg(F.count(F.lit(1)).alias("rows"))
    return r.orderBy(F.col("rows").desc(), "edge_table").limit(1)


@query("table_summary", _edges_cte(True) + """
SELECT edge_table AS table_name, count(*) AS rows, count(DISTINCT batch_id) AS distinct_batches, 12 AS column_count
FROM edges GROUP BY 1""")
def q_table_summary(spark, root):
    u = _built(spark, root)
    ncols = len(E.EDGE_COLUMNS)
    return u.groupBy(F.col("edge_table").alias("table_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("batch_id").alias("distinct_batches"),
        F.lit(ncols).alias("column_count"))


@query("all_empty_gate", _edges_cte(True) + """
SELECT table_name, count(edge_id) AS rows, sum(count(edge_id)) OVER () = 0 AS all_empty
FROM (SELECT unnest([""" + ", ".join(f"'{s.name}'" for s in E.EDGE_SPECS) + """, 'not_built_yet']) AS table_name)
LEFT JOIN edges ON edge_table = table_name GROUP BY 1""")
def q_all_empty_gate(spark, root):
    """Rows of each expected table (a missing one has none) and the verdict over all."""
    expected = [s.name for s in E.EDGE_SPECS] + ["not_built_yet"]
    return G.all_empty_report(_built(spark, root), "edge_table", expected)


# ------------------------------------------------------------------ usage gates
_UL = w(("usage", O.USAGE_HOURLY), ("latest", O.USAGE_LATEST), ("packed", O.USAGE_PACKED))


@query("continuity_gate", w(("usage", O.USAGE_HOURLY)) + """
SELECT p.subscription_id, p.prior_max, n.new_min
FROM (SELECT subscription_id, max(hour_utc) AS prior_max FROM usage
      WHERE snapshot_date < (SELECT max(snapshot_date) FROM usage) GROUP BY 1) p
JOIN (SELECT subscription_id, min(hour_utc) AS new_min FROM usage
      WHERE snapshot_date = (SELECT max(snapshot_date) FROM usage) GROUP BY 1) n
  ON p.subscription_id = n.subscription_id
WHERE n.new_min > p.prior_max + INTERVAL 1 HOUR""")
def q_continuity_gate(spark, root):
    u = X.usage_hourly(spark, root)
    latest = u.agg(F.max("snapshot_date")).scalar()
    return G.continuity_gate(u.filter(F.col("snapshot_date") < latest), u.filter(F.col("snapshot_date") == latest),
                             ["subscription_id"], "hour_utc", "1 HOUR")


@query("continuity_gate_days", w(("usage", O.USAGE_HOURLY)) + """
SELECT p.subscription_id, p.prior_max, n.new_min
FROM (SELECT subscription_id, max(hour_utc) AS prior_max FROM usage WHERE hour_utc < TIMESTAMP '2024-01-11' GROUP BY 1) p
JOIN (SELECT subscription_id, min(hour_utc) AS new_min FROM usage WHERE hour_utc >= TIMESTAMP '2024-01-13' GROUP BY 1) n
  ON p.subscription_id = n.subscription_id WHERE n.new_min > p.prior_max + INTERVAL 3 DAY""")
def q_continuity_gate_days(spark, root):
    """The same by days: an extract that begins two days after the one before, gaps of more than three days."""
    u = X.usage_hourly(spark, root)
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    return G.continuity_gate(u.filter(F.col("hour_utc") < at("2024-01-11")), u.filter(F.col("hour_utc") >= at("2024-01-13")),
                             ["subscription_id"], "hour_utc", "3 DAYS")


@query("length_gate", _UL + """
SELECT subscription_id, usage_day, total_hours, len(charges) AS array_length FROM packed WHERE total_hours <> len(charges)""")
def q_length_gate(spark, root):
    return G.length_gate(X.usage_packed(spark, root), "total_hours", "charges", ["subscription_id", "usage_day"])


@query("hourly_from_array", w(("usage", O.USAGE_HOURLY), ("latest", O.USAGE_LATEST), ("packed", O.USAGE_PACKED)) + """
SELECT subscription_id, first_hour + to_hours(CAST(pos - 1 AS BIGINT)) AS hour_utc, CAST(charge AS DOUBLE) AS hourly_charge
FROM (SELECT subscription_id, first_hour, unnest(charges) AS charge, unnest(range(1, len(charges) + 1)) AS pos
      FROM packed)""")
def q_hourly_from_array(spark, root):
    """Every packed day unpacked; a declared length that disagrees fails the job (the
    length gate's input has seeded ones, this one has none)."""
    p = X.usage_packed(spark, root, seeded=False)
    out = L.hourly_from_array(p, ["subscription_id"], "first_hour", "charges", "total_hours")
    return out.select("subscription_id", "hour_utc", _d("hourly_charge").alias("hourly_charge"))


# ------------------------------------------------------------------ capacity gates
@query("freshness_gate", w(("fact", O.CAPACITY_FACT)) + f"""
SELECT 'capacity' AS source, max(usage_date) AS newest_date, DATE '{X.CAPACITY_AS_OF}' AS snapshot_date,
       CAST(DATE '{X.CAPACITY_AS_OF}' - max(usage_date) AS INTEGER) AS lag_days,
       CASE WHEN max(usage_date) IS NULL OR DATE '{X.CAPACITY_AS_OF}' - max(usage_date) > 2 THEN 'STALE' ELSE 'FRESH' END AS status
FROM fact""")
def q_freshness_gate(spark, root):
    return G.freshness_gate(X.capacity_fact(spark, root), "usage_date", X.CAPACITY_AS_OF, 2, "capacity")


# Expected capacity fact; it deviates on purpose in a name ("cu_seconds" for "cu_s"), a type and
# a bound, so that the gate has findings.
CAPACITY_CONTRACT = [
    ("capacity_id", "string", None, None), ("workspace_id", "string", None, None), ("item_id", "string", None, None),
    ("operation_name", "string", None, None), ("usage_date", "date", "DATE '1992-01-01'", "DATE '2010-12-31'"),
    ("cu_seconds", "decimal(18,2)", "0", None), ("duration_s", "decimal(18,2)", "0", None), ("operation_count", "bigint", "1", None),
    ("success_count", "bigint", "0", "1"), ("failure_count", "int", "0", "1"), ("throttling_s", "decimal(6,2)", "0", "0.05"),
    ("user_count", "bigint", "1", None)]
_LIVE = {"capacity_id": "string", "workspace_id": "string", "item_id": "string", "operation_name": "string", "usage_date": "date",
         "duration_s": "decimal(18,2)", "operation_count": "bigint", "success_count": "bigint", "failure_count": "bigint",
         "throttling_s": "decimal(6,2)", "user_count": "bigint"}


def _contract_sql(name, kind, least, most):
    live = _LIVE.get(name)
    bad = " OR ".join(b for b in (f"{name} < {least}" if least else "", f"{name} > {most}" if most else "") if b) or "false"
    nulls, out = (f"count(*) FILTER ({name} IS NULL)", f"count(*) FILTER ({bad})") if live else ("NULL", "NULL")
    status = ("'missing'" if live is None else "'wrong_type'" if live != kind else
              f"CASE WHEN {nulls} > 0 THEN 'nulls' WHEN {out} > 0 THEN 'out_of_range' ELSE 'ok' END")
    text = f"'{live}'" if live else "NULL"
    return (f"SELECT 'capacity_fact' AS table_name, '{name}' AS column_name, {text} AS live_type, '{kind}' AS expected_type, "
            f"count(*) AS rows, CAST({nulls} AS BIGINT) AS nulls, CAST({out} AS BIGINT) AS out_of_range, {status} AS status FROM fact")


@query("schema_contract", w(("fact", O.CAPACITY_FACT)) + " UNION ALL ".join(_contract_sql(*c) for c in CAPACITY_CONTRACT))
def q_schema_contract(spark, root):
    """The fact against its contract: columns, types, nulls and bounds, over all rows in one pass."""
    return G.contract_report(X.capacity_fact(spark, root), "capacity_fact", CAPACITY_CONTRACT)


@query("contract_gate", w(("fact", O.CAPACITY_FACT)) + "SELECT table_name, column_name, status FROM (" +
       " UNION ALL ".join(_contract_sql(*c) for c in CAPACITY_CONTRACT) + ") WHERE status <> 'ok'")
def q_contract_gate(spark, root):
    """Columns that break the contract; any row fails the gate."""
    r = G.contract_report(X.capacity_fact(spark, root), "capacity_fact", CAPACITY_CONTRACT)
    return r.filter(F.col("status") != "ok").select("table_name", "column_name", "status")


# ------------------------------------------------------------------ rule reports
def _bronze_rules():
    return {
        "cost_not_null": F.col("BilledCost").isNull(),
        "date_in_range": ~F.col("ChargePeriodStart").between(F.lit("1990-01-01").cast("timestamp_ntz"),
                                                             F.lit("2030-12-31").cast("timestamp_ntz")),
        "id_length_36": F.coalesce(F.length("SubAccountId") != 36, F.lit(True)),
    }


@query("bronze_rules", w(("focus", O.FOCUS)) + """
SELECT rule, rows, violations, violations = 0 AS passed FROM (
  SELECT count(*) AS rows, count_if(BilledCost IS NULL) AS cost_not_null,
         count_if(NOT (ChargePeriodStart BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2030-12-31')) AS date_in_range,
         count_if(coalesce(length(SubAccountId) <> 36, true)) AS id_length_36, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS non_empty FROM focus)
UNPIVOT (violations FOR rule IN (cost_not_null, date_in_range, id_length_36, non_empty))""".replace(
    "SELECT rule, rows, violations, violations = 0 AS passed", "SELECT rule, rows, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed"))
def q_bronze_rules(spark, root):
    return G.rule_report(X.focus(spark, root), _bronze_rules(), non_empty="non_empty")


_SILVER_SQL = w(("focus", O.FOCUS)) + f"""
, s AS (SELECT *, {O.SERVICE_ID_EXPR} AS sid FROM focus)
, v AS (SELECT *, list_filter([CASE WHEN coalesce(EffectiveCost < 0, true) THEN 'negative_cost' END,
                               CASE WHEN split_part(sid, '/', 1) = 'Untagged' THEN 'missing_department' END,
                               CASE WHEN split_part(sid, '/', 2) = 'Untagged' THEN 'missing_cost_centre' END,
                               CASE WHEN EffectiveCost > BilledCost THEN 'effective_above_billed' END,
                               CASE WHEN IsPartialMonthRecord THEN 'partial_month' END], lambda x: x IS NOT NULL) AS validation_errors FROM s)
"""


def _silver_rules():
    return {"negative_cost": F.coalesce(F.col("EffectiveCost") < 0, F.lit(True)),
            "missing_department": F.split("sid", "/")[0] == UNTAGGED,
            "missing_cost_centre": F.split("sid", "/")[1] == UNTAGGED,
            "effective_above_billed": F.col("EffectiveCost") > F.col("BilledCost"),
            "partial_month": F.col("IsPartialMonthRecord")}


def _silver(spark, root):
    f = X.focus(spark, root).withColumn("sid", service_id("Tags"))
    return G.validated(f, _silver_rules())


@query("silver_rules", _SILVER_SQL + """
SELECT error, count(*) AS rows FROM (SELECT unnest(validation_errors) AS error FROM v) GROUP BY 1""")
def q_silver_rules(spark, root):
    f = _silver(spark, root).select(F.explode("validation_errors").alias("error"))
    return f.groupBy("error").agg(F.count(F.lit(1)).alias("rows"))


@query("silver_validated", _SILVER_SQL + """
SELECT array_to_string(validation_errors, ',') AS validation_errors, len(validation_errors) = 0 AS is_valid, count(*) AS rows,
       CAST(sum(EffectiveCost) AS DOUBLE) AS cost FROM v GROUP BY 1, 2""")
def q_silver_validated(spark, root):
    """Rows and cost by their list of violations; the valid flag is an empty list."""
    v = _silver(spark, root)
    return v.groupBy(F.array_join("validation_errors", ",").alias("validation_errors"), "is_valid").agg(
        F.count(F.lit(1)).alias("rows"), _d(F.sum("EffectiveCost")).alias("cost"))


@query("silver_verdict", _SILVER_SQL + """
SELECT 'silver_cost' AS table_name, count(*) AS rows, count_if(len(validation_errors) = 0) AS valid_rows,
       round(count_if(len(validation_errors) = 0) * 100.0 / count(*), 2) AS valid_pct,
       CASE WHEN count(*) = 0 THEN 'EMPTY' WHEN count_if(len(validation_errors) = 0) = count(*) THEN 'PASSED' ELSE 'FAILED' END AS verdict FROM v""")
def q_silver_verdict(spark, root):
    return G.verdict(_silver(spark, root), "silver_cost")


VARIANCE_LEAST, VARIANCE_MOST = -100.0, 500.0

_GOLD_SQL = w(*O.FLAGSHIP_CTES) + f"""
, parts AS (SELECT ds, max(CASE WHEN level = 'total' THEN y END) AS total, sum(CASE WHEN level = 'component' THEN y END) AS c FROM hier GROUP BY 1)
, m AS (SELECT unique_id, CAST(date_trunc('month', ds) AS DATE) AS month, sum(CAST(y AS DECIMAL(38,4))) AS cost, count(*) AS days
        FROM hier WHERE level = 'component' GROUP BY 1, 2)
, p AS (SELECT *, lag(cost) OVER (PARTITION BY unique_id ORDER BY month) AS before FROM m)
SELECT 'total_equals_parts' AS rule, count(*) AS checked, count_if(NOT coalesce(abs(total - c) < 0.005, false)) AS violations,
       count(*) > 0 AND count_if(NOT coalesce(abs(total - c) < 0.005, false)) = 0 AS passed FROM parts
UNION ALL
SELECT 'variance_in_range', count(*), count_if(CAST(cost - before AS DOUBLE) * 100 / CAST(before AS DOUBLE) NOT BETWEEN {VARIANCE_LEAST} AND {VARIANCE_MOST}),
       count(*) > 0 AND count_if(CAST(cost - before AS DOUBLE) * 100 / CAST(before AS DOUBLE) NOT BETWEEN {VARIANCE_LEAST} AND {VARIANCE_MOST}) = 0 FROM p WHERE before > 0
UNION ALL
SELECT 'month_has_cost', count(*), count_if(cost <= 0), count(*) > 0 AND count_if(cost <= 0) = 0 FROM m"""


@query("gold_rules", _GOLD_SQL)
def q_gold_rules(spark, root):
    """Three rules over the gold tables, checked rows and violations of each: the total of a day
    equals its parts, month-on-month variance of a component lies in [-100, 500] percent,
    every component-month has cost.  A rule that checked nothing doesn't pass."""
    h = cut_lineage(hierarchy_series(X.focus(spark, root)))
    day = h.groupBy("ds").agg(F.sum(F.when(F.col("level") == "total", F.col("y"))).alias("total"),
                              F.sum(F.when(F.col("level") == "component", F.col("y"))).alias("parts"))
    month = h.filter(F.col("level") == "component").groupBy(
        "unique_id", F.to_date(F.date_trunc("month", "ds")).alias("month")).agg(F.sum(F.col("y").cast("decimal(38,4)")).alias("cost"))
    before = F.lag("cost").over(Window.partitionBy("unique_id").orderBy("month"))
    change = month.withColumn("before", before).filter(F.col("before") > 0)
    variance = _d(F.col("cost") - F.col("before")) * 100 / _d("before")
    return G.rule_verdicts({
        "total_equals_parts": (day, ~F.coalesce(F.abs(F.col("total") - F.col("parts")) < 0.005, F.lit(False))),
        "variance_in_range": (change, ~variance.between(VARIANCE_LEAST, VARIANCE_MOST)),
        "month_has_cost": (month, F.col("cost") <= 0)})


@query("lineage_counts", w(("focus", O.FOCUS), ("usage", O.USAGE_HOURLY), ("containers", O.CONTAINERS)) + f"""
SELECT 'bronze' AS layer, 'usage' AS table_name, count(*) AS rows, max(ingestion_timestamp) AS latest FROM usage
UNION ALL
SELECT 'silver', 'containers', count(*), NULL FROM containers WHERE lower(type) IN
  ('microsoft.management/managementgroups', 'microsoft.resources/subscriptions', 'microsoft.resources/subscriptions/resourcegroups')
UNION ALL
SELECT 'gold', 'daily_service', count(*), CAST(max(ds) AS TIMESTAMP) FROM (
  SELECT DISTINCT CAST(ChargePeriodStart AS DATE) AS ds, {O.SERVICE_ID_EXPR} AS sid FROM focus)""")
def q_lineage_counts(spark, root):
    u = X.usage_hourly(spark, root)
    c = X.containers(spark, root)
    known = [t.lower() for t in X.CONTAINER_TYPES.values()]
    d = X.focus(spark, root).select(F.to_date("ChargePeriodStart").alias("ds"), service_id("Tags").alias("sid")).distinct()
    a = u.agg(F.count(F.lit(1)).alias("rows"), F.max("ingestion_timestamp").alias("latest")) \
        .select(F.lit("bronze").alias("layer"), F.lit("usage").alias("table_name"), "rows", "latest")
    b = c.filter(F.lower("type").isin(*known)).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("silver").alias("layer"), F.lit("containers").alias("table_name"), "rows",
                F.lit(None).cast("timestamp_ntz").alias("latest"))
    g = d.agg(F.count(F.lit(1)).alias("rows"), F.max("ds").cast("timestamp_ntz").alias("latest")) \
        .select(F.lit("gold").alias("layer"), F.lit("daily_service").alias("table_name"), "rows", "latest")
    return a.unionByName(b).unionByName(g)


@query("lineage_counts_since", w(("usage", O.USAGE_HOURLY)) + """
SELECT 'bronze' AS layer, 'usage' AS table_name, snapshot_date, count(*) AS rows, max(ingestion_timestamp) AS latest
FROM usage WHERE ingestion_timestamp >= TIMESTAMP '2024-01-30' GROUP BY 3""")
def q_lineage_counts_since(spark, root):
    """Rows of each snapshot ingested since the start of a run's day."""
    u = X.usage_hourly(spark, root).filter(F.col("ingestion_timestamp") >= F.lit("2024-01-30").cast("timestamp_ntz"))
    return u.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"), F.max("ingestion_timestamp").alias("latest")).select(
        F.lit("bronze").alias("layer"), F.lit("usage").alias("table_name"), "snapshot_date", "rows", "latest")


# ------------------------------------------------------------------ written tables
def _written_orders(spark, root):
    """Orders by year, and the same as a partitioned table written and read again."""
    orders = scan_table(spark, root, "orders", ["o_orderkey", "o_totalprice", "o_orderdate"]).withColumn(
        "year", F.year("o_orderdate"))
    store = TableStore(spark, scratch_path(spark, "stores"))
    store.replace_partition(orders, "orders", ["year"])
    return orders, store.read("orders")


@query("verify_written", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS frame_rows, count(*) AS table_rows, true AS matches
FROM orders GROUP BY 1""")
def q_verify_written(spark, root):
    """Rows of each partition in the frame and in the table it was written to."""
    return written_counts(*_written_orders(spark, root), ["year"])


@query("row_count_match", "SELECT count(*) AS frame_rows, count(*) AS table_rows, true AS matches FROM orders")
def q_row_count_match(spark, root):
    return row_count_match(*_written_orders(spark, root))


@query("upsert", """
WITH old AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderdate FROM orders),
new AS (SELECT o_orderkey, status, price + 1 AS price FROM old WHERE o_orderdate >= TIMESTAMP '1998-01-01'
        UNION ALL SELECT -o_orderkey, NULL, price FROM old WHERE o_orderdate >= TIMESTAMP '1998-07-01')
SELECT o_orderkey, status, CAST(price AS DOUBLE) AS price FROM new
UNION ALL
SELECT o_orderkey, status, CAST(price AS DOUBLE) FROM old
WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.o_orderkey = old.o_orderkey AND new.status IS NOT DISTINCT FROM old.status)""")
def q_upsert(spark, root):
    """Orders partitioned by status (pending ones in the null partition), late
    orders corrected and new ones added by key."""
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    old = scan_table(spark, root, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]).select(
        "o_orderkey", status.alias("status"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderdate")
    store = TableStore(spark, scratch_path(spark, "stores"))
    store.write_overwrite(old.drop("o_orderdate"), "orders", ["status"])
    late = old.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    corrected = late.select("o_orderkey", "status", (F.col("price") + 1).cast("decimal(18,2)").alias("price"))
    added = late.filter(F.col("o_orderdate") >= F.lit("1998-07-01").cast("timestamp_ntz")).select(
        (-F.col("o_orderkey")).alias("o_orderkey"), F.lit(None).cast("string").alias("status"), "price")
    store.upsert(corrected.unionByName(added), "orders", ["o_orderkey", "status"])
    return store.read("orders").select("o_orderkey", "status", _d("price").alias("price"))
