"""The adapters of ``sources.fixtures`` restated as DuckDB SQL.

Each constant is a CTE body over the driver views, so an oracle query is
``WITH focus AS (<FOCUS>) SELECT ...``.  They repeat the adapter rules
independently of the Spark code so that the side-by-side check covers the
adapters too.
"""

FOCUS = """
SELECT
  l.l_shipdate AS ChargePeriodStart,
  l.l_shipdate + INTERVAL 1 DAY AS ChargePeriodEnd,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS BilledCost,
  CASE
    WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_partkey % 50 = 0
      THEN CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
    WHEN l.l_returnflag = 'R'
      THEN CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (0.9 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
    ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
  END AS EffectiveCost,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS ListCost,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS ContractedCost,
  'sub-' || CAST(l.l_suppkey AS VARCHAR) AS SubAccountId,
  'Subscription ' || CAST(l.l_suppkey AS VARCHAR) AS SubAccountName,
  CASE
    WHEN l.l_linenumber = 7 THEN NULL
    WHEN l.l_linenumber = 6 THEN '{"Service_ID":"' || r.r_name || '/' || c.c_mktsegment || '"}'
    WHEN l.l_linenumber = 5 AND l.l_partkey % 10 = 0 THEN '{bad'
    ELSE '{"Service_ID":"' || r.r_name || '/' || c.c_mktsegment || '/' || l.l_linestatus || '/' || l.l_returnflag || '"}'
  END AS Tags,
  CASE r.r_name WHEN 'EUROPE' THEN 'EUR' WHEN 'MIDDLE EAST' THEN 'GBP' ELSE 'USD' END AS Currency,
  day(l.l_shipdate) > 28 AS IsPartialMonthRecord,
  l.l_returnflag AS ServiceName,
  'res-' || CAST(l.l_partkey AS VARCHAR) AS ResourceId,
  CASE WHEN l.l_returnflag = 'R' THEN 'cd-' || CAST(l.l_suppkey AS VARCHAR) END AS CommitmentDiscountId,
  CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'Used'
       WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 'Unused' END AS CommitmentDiscountStatus,
  r.r_name AS RegionName
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

# Service_ID rule: JSON path value with exactly three slashes, else Untagged.
SERVICE_ID_EXPR = """CASE
  WHEN json_valid(Tags) AND json_extract_string(Tags, '$.Service_ID') IS NOT NULL
   AND length(json_extract_string(Tags, '$.Service_ID')) - length(replace(json_extract_string(Tags, '$.Service_ID'), '/', '')) = 3
  THEN json_extract_string(Tags, '$.Service_ID')
  ELSE 'Untagged/Untagged/Untagged/Untagged' END"""

DAILY_SERVICE = f"""
SELECT CAST(ChargePeriodStart AS DATE) AS ds, {SERVICE_ID_EXPR} AS service_id, sum(BilledCost) AS y
FROM focus GROUP BY 1, 2
"""

FILLED = """
SELECT s.service_id, s.ds, coalesce(d.y, 0) AS y
FROM (
  SELECT service_id, CAST(unnest(generate_series(min(ds), (SELECT max(ds) FROM daily), INTERVAL 1 DAY)) AS DATE) AS ds
  FROM daily GROUP BY service_id
) s LEFT JOIN daily d ON s.service_id = d.service_id AND s.ds = d.ds
"""

HIER = """
SELECT concat_ws('/', 'total', division, platform, workload, component) AS unique_id,
       ds, CAST(sum(y) AS DOUBLE) AS y,
       CASE grouping(division) + grouping(platform) + grouping(workload) + grouping(component)
         WHEN 0 THEN 'component' WHEN 1 THEN 'workload' WHEN 2 THEN 'platform'
         WHEN 3 THEN 'division' ELSE 'total' END AS level,
       division, platform, workload, component
FROM (
  SELECT ds, y,
         split_part(service_id, '/', 1) AS division, split_part(service_id, '/', 2) AS platform,
         split_part(service_id, '/', 3) AS workload, split_part(service_id, '/', 4) AS component
  FROM filled
) GROUP BY ds, ROLLUP(division, platform, workload, component)
"""


def with_ctes(*pairs: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in pairs) + "\n"


FLAGSHIP_CTES = [("focus", FOCUS), ("daily", DAILY_SERVICE), ("filled", FILLED), ("hier", HIER)]

USAGE_HOURLY = """
SELECT 'tenant-' || CAST(user_id % 3 AS VARCHAR) AS tenant_id,
       'sub-' || CAST(user_id AS VARCHAR) AS subscription_id,
       hour_utc,
       CASE WHEN k = 2 THEN CAST(c2 AS DECIMAL(18,4)) ELSE CAST(c0 AS DECIMAL(18,4)) END AS hourly_charge,
       'USD' AS currency_code,
       CAST(hour_utc AS DATE) + k AS snapshot_date,
       CAST(CAST(hour_utc AS DATE) + k AS TIMESTAMP) + INTERVAL 6 HOUR AS ingestion_timestamp
FROM (
  SELECT user_id, date_trunc('hour', ts) AS hour_utc,
         sum(CAST(value AS DECIMAL(12,2))) AS c0,
         sum(CAST(value AS DECIMAL(12,2)) * CASE WHEN event_id % 50 = 0 THEN CAST(1.01 AS DECIMAL(3,2))
                                                 ELSE CAST(1.00 AS DECIMAL(3,2)) END) AS c2
  FROM events GROUP BY 1, 2
) h, (SELECT unnest([0, 1, 2]) AS k) s
"""

SEATS = """
SELECT 'user-' || CAST(c.c_custkey AS VARCHAR) AS user_login,
       'User ' || CAST(c.c_custkey AS VARCHAR) AS user_name,
       'user' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS user_email,
       TIMESTAMP '1995-01-01 00:00:00' AS created_at,
       h.last_activity_at,
       c.c_mktsegment AS last_activity_editor,
       n.n_name AS assigning_team,
       r.r_name AS organization,
       DATE '2001-08-02' AS snapshot_date
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_activity_at FROM orders GROUP BY o_custkey) h ON c.c_custkey = h.o_custkey
"""

GRAINS = """
SELECT 'sub-' || CAST(l_orderkey AS VARCHAR) AS subscription_uuid, CAST(NULL AS VARCHAR) AS environment_id,
       'subscription' AS grain, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS cost_value, count(*) AS rows
FROM lineitem GROUP BY l_orderkey
UNION ALL
SELECT 'sub-' || CAST(l_orderkey AS VARCHAR), 'env-' || CAST(l_linenumber AS VARCHAR),
       'environment', sum(CAST(l_extendedprice AS DECIMAL(18,2))), count(*)
FROM lineitem WHERE l_linenumber <> 7 GROUP BY l_orderkey, l_linenumber
"""

CAPACITY_FACT = """
SELECT 'cap-' || CAST(l_suppkey % 4 AS VARCHAR) AS capacity_id,
       'ws-' || CAST(l_suppkey AS VARCHAR) AS workspace_id,
       'item-' || CAST(l_partkey AS VARCHAR) AS item_id,
       CASE l_returnflag WHEN 'A' THEN 'Query' WHEN 'N' THEN 'Refresh' ELSE 'Copy' END AS operation_name,
       CAST(l_shipdate AS DATE) AS usage_date,
       CAST(l_quantity AS DECIMAL(18,2)) AS cu_s,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS duration_s,
       CAST(1 AS BIGINT) AS operation_count,
       CAST(l_linestatus = 'F' AS BIGINT) AS success_count,
       CAST(l_linestatus = 'O' AS BIGINT) AS failure_count,
       CAST(l_tax AS DECIMAL(6,2)) AS throttling_s,
       CAST(l_linenumber AS BIGINT) AS user_count
FROM lineitem
"""

CAPACITIES = """
SELECT DISTINCT 'cap-' || CAST(s_suppkey % 4 AS VARCHAR) AS capacity_id,
       'Capacity ' || CAST(s_suppkey % 4 AS VARCHAR) AS capacity_name,
       'F' || CAST((s_suppkey % 4) * 2 + 2 AS VARCHAR) AS sku
FROM supplier
"""

WORKSPACES = """
SELECT 'ws-' || CAST(s_suppkey AS VARCHAR) AS workspace_id, s_name AS workspace_name FROM supplier
"""

ITEMS = """
SELECT 'item-' || CAST(p_partkey AS VARCHAR) AS item_id, p_name AS item_name, p_type AS item_kind,
       TIMESTAMP '2001-01-01 00:00:00' AS "Timestamp" FROM part
UNION ALL
SELECT 'item-' || CAST(p_partkey AS VARCHAR), p_name || ' (old)', p_type, TIMESTAMP '2000-01-01 00:00:00'
FROM part WHERE p_partkey % 10 = 0
"""

CONTAINERS = """
SELECT '/providers/Microsoft.Management/managementGroups/' || r_name AS id, r_name AS name,
       CASE WHEN r_regionkey < 3 THEN 'Microsoft.Management/managementGroups' END AS type,
       CAST(NULL AS VARCHAR) AS subscriptionId, CAST(NULL AS VARCHAR) AS resourceGroup, CAST(NULL AS VARCHAR) AS tags
FROM region
UNION ALL
SELECT '/providers/Other/' || r_name, r_name, 'Microsoft.Unknown/type' || CAST(r_regionkey AS VARCHAR),
       NULL, NULL, NULL FROM region WHERE r_regionkey < 3
UNION ALL
SELECT '/subscriptions/sub-' || CAST(n_nationkey AS VARCHAR), n_name, 'microsoft.resources/subscriptions',
       'sub-' || CAST(n_nationkey AS VARCHAR), NULL, '{"owner":"finance"}' FROM nation
UNION ALL
SELECT '/subscriptions/sub-' || CAST(c_nationkey AS VARCHAR) || '/resourceGroups/rg-' || CAST(c_custkey AS VARCHAR),
       'rg-' || CAST(c_custkey AS VARCHAR),
       CASE WHEN c_custkey % 2 = 0 THEN 'MICROSOFT.RESOURCES/SUBSCRIPTIONS/RESOURCEGROUPS'
            ELSE 'Microsoft.Resources/subscriptions/resourceGroups' END,
       'sub-' || CAST(c_nationkey AS VARCHAR), 'rg-' || CAST(c_custkey AS VARCHAR),
       CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '{}' ELSE '{"env":"' || lower(c_mktsegment) || '"}' END
FROM customer
"""

EMISSIONS = """
SELECT l_linestatus AS tenant_id, 'Tenant ' || l_linestatus AS tenant_label,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS report_month, 'Resource' AS category_type,
       'sub-' || CAST(l_suppkey AS VARCHAR) AS subscription_id, 'res-' || CAST(l_partkey AS VARCHAR) AS resource_id,
       'region-' || CAST(l_partkey % 5 AS VARCHAR) AS location, l_returnflag AS resource_type,
       l_quantity AS latest_month_emissions
FROM lineitem
"""

PIPELINE_ITEMS = """
SELECT o.o_orderkey AS run_id, o.o_custkey % 25 AS pipeline_id,
       'pipeline-' || CAST(o.o_custkey % 25 AS VARCHAR) AS pipeline_name,
       o.o_orderpriority AS folder, o.o_orderstatus AS result,
       strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_date,
       l.l_partkey AS work_item_id, l.l_returnflag AS work_item_type
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
"""

DIRECTORY = """
SELECT CASE WHEN n.n_nationkey % 2 = 0 THEN '  ' || lower(n.n_name) || ' ' ELSE n.n_name END AS ServiceID,
       'plat-' || CAST(n.n_regionkey AS VARCHAR) AS PlatformID, r.r_name AS DivisionID,
       'CC' || lpad(CAST(n.n_nationkey AS VARCHAR), 4, '0') AS CostCentre
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""

SERVICE_REQUESTS = """
SELECT c.c_custkey AS request_id,
       CASE WHEN c.c_custkey % 50 = 0 THEN 'unknown-' || CAST(c.c_nationkey AS VARCHAR) ELSE n.n_name END AS service_id,
       CASE WHEN c.c_custkey % 7 = 0 THEN ' Production'
            WHEN c.c_mktsegment = 'BUILDING' THEN ' PROD '
            WHEN c.c_mktsegment = 'MACHINERY' THEN 'dev'
            WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'Test'
            WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'qa'
            ELSE 'staging' END AS environment
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

EDGE_LINEITEMS = """
SELECT 'LI-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_id,
       'ORD-' || CAST(l_orderkey AS VARCHAR) AS order_id, 'PART-' || CAST(l_partkey AS VARCHAR) AS part_id,
       'SUPP-' || CAST(l_suppkey AS VARCHAR) AS supplier_id
FROM lineitem
"""
EDGE_ORDERS = """
SELECT 'ord-' || CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN NULL
            ELSE 'CUST-' || CAST(o_custkey AS VARCHAR) END AS customer_id
FROM orders
"""
EDGE_CUSTOMERS = """
SELECT 'CUST-' || CAST(c_custkey AS VARCHAR) AS customer_id, 'NAT-' || CAST(c_nationkey AS VARCHAR) AS nation_id FROM customer
"""
EDGE_NATIONS = """
SELECT 'NAT-' || CAST(n_nationkey AS VARCHAR) AS nation_id, 'REG-' || CAST(n_regionkey AS VARCHAR) AS region_id FROM nation
"""

EDGE_SUPPLIERS = """
SELECT 'SUPP-' || CAST(s_suppkey AS VARCHAR) AS supplier_id, 'NAT-' || CAST(s_nationkey AS VARCHAR) AS nation_id FROM supplier
"""
EDGE_PARTS = "SELECT 'PART-' || CAST(p_partkey AS VARCHAR) AS part_id, p_brand AS brand_id FROM part"
EDGE_EVENTS = "SELECT 'EV-' || CAST(event_id AS VARCHAR) AS event_id, 'CUST-' || CAST(user_id AS VARCHAR) AS customer_id FROM events"
EDGE_PAGES = "SELECT 'PAGE-' || CAST(page_id AS VARCHAR) AS page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host_id FROM pages"
EDGE_LABELS = "SELECT 'DOC-' || CAST(doc_id AS VARCHAR) AS document_id, 'Q-' || CAST(quality AS VARCHAR) AS quality_id FROM labels"

RESOURCE_TAGS = """
SELECT 'res-' || CAST(l_partkey AS VARCHAR) AS ResourceId,
       CASE l_partkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '{"pipeline_run_id":'
            WHEN 2 THEN '{"pipeline_run_id":"gone-' || CAST(min(l_orderkey) AS VARCHAR) || '"}'
            ELSE '{"owner":"team","pipeline_run_id":"' || CAST(min(l_orderkey) AS VARCHAR) || '"}' END AS tags
FROM lineitem GROUP BY l_partkey
"""

USAGE_PACKED = """
SELECT tenant_id, subscription_id, usage_day, CAST(usage_day AS TIMESTAMP) AS first_hour,
       list(CAST(coalesce(hourly_charge, 0) AS DECIMAL(18,4)) ORDER BY h) AS charges,
       CASE WHEN CAST(regexp_extract(subscription_id, '(\\d+)$', 1) AS INTEGER) % 7 = 0 AND usage_day = DATE '2024-01-15'
            THEN 23 ELSE 24 END AS total_hours
FROM (
  SELECT d.tenant_id, d.subscription_id, d.usage_day, s.h, l.hourly_charge
  FROM (SELECT DISTINCT tenant_id, subscription_id, CAST(hour_utc AS DATE) AS usage_day FROM latest) d
  CROSS JOIN (SELECT unnest(range(0, 24)) AS h) s
  LEFT JOIN latest l ON l.subscription_id = d.subscription_id
                    AND l.hour_utc = CAST(d.usage_day AS TIMESTAMP) + to_hours(s.h)
) GROUP BY 1, 2, 3
"""

USAGE_LATEST = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subscription_id, hour_utc ORDER BY snapshot_date DESC) AS rn
               FROM usage) WHERE rn = 1
"""
