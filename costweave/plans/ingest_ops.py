"""Bronze-side products: usage snapshots, seats, capacity telemetry,
containers, emissions, pipelines, directory and two-grain cost."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.rules import activity_band, days_since, parse_iso_ts
from ..functions.tags import is_tagged
from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import windows as W
from ..sources import fixtures as X
from . import oracle_adapters as O
from .registry import query

w = O.with_ctes


def _d(c):
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# ------------------------------------------------------------------ usage
_U = w(("usage", O.USAGE_HOURLY))


@query("usage_hourly_landing", _U + """
SELECT tenant_id, subscription_id, hour_utc, CAST(hourly_charge AS DOUBLE) AS hourly_charge, currency_code,
       snapshot_date, ingestion_timestamp FROM usage""")
def q_usage_landing(spark, root):
    return X.usage_hourly(spark, root).withColumn("hourly_charge", _d("hourly_charge"))


@query("latest_snapshot", _U + """
SELECT subscription_id, hour_utc, tenant_id, CAST(hourly_charge AS DOUBLE) AS hourly_charge, currency_code,
       snapshot_date, ingestion_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY subscription_id, hour_utc
                                   ORDER BY snapshot_date DESC, ingestion_timestamp DESC) AS rn FROM usage)
WHERE rn = 1""")
def q_latest_snapshot(spark, root):
    u = X.usage_hourly(spark, root)
    out = W.latest_per_key(u, ["subscription_id", "hour_utc"], ["snapshot_date", "ingestion_timestamp"])
    return out.withColumn("hourly_charge", _d("hourly_charge"))


@query("restatements", _U + """
SELECT subscription_id, hour_utc, snapshot_date, CAST(hourly_charge AS DOUBLE) AS hourly_charge,
       CAST(previous_value AS DOUBLE) AS previous_value, previous_snapshot
FROM (SELECT subscription_id, hour_utc, snapshot_date, hourly_charge,
             lag(hourly_charge) OVER (PARTITION BY subscription_id, hour_utc ORDER BY snapshot_date) AS previous_value,
             lag(snapshot_date) OVER (PARTITION BY subscription_id, hour_utc ORDER BY snapshot_date) AS previous_snapshot
      FROM usage)
WHERE previous_value IS NOT NULL AND hourly_charge <> previous_value""")
def q_restatements(spark, root):
    u = X.usage_hourly(spark, root)
    out = W.restatements(u, ["subscription_id", "hour_utc"], "snapshot_date", "hourly_charge")
    return out.select("subscription_id", "hour_utc", "snapshot_date", _d("hourly_charge").alias("hourly_charge"),
                      _d("previous_value").alias("previous_value"), "previous_snapshot")


@query("coverage_stats", _U + """
SELECT tenant_id, subscription_id, count(*) AS rows, min(hour_utc) AS first_hour_utc, max(hour_utc) AS last_hour_utc,
       CAST(sum(hourly_charge) AS DOUBLE) AS total_hourly_charge
FROM usage WHERE snapshot_date = (SELECT max(snapshot_date) FROM usage) GROUP BY 1, 2""")
def q_coverage_stats(spark, root):
    u = X.usage_hourly(spark, root)
    u = u.filter(F.col("snapshot_date") == u.agg(F.max("snapshot_date")).scalar())
    out = A.coverage_stats(u, ["tenant_id", "subscription_id"], "hour_utc", "hourly_charge")
    return out.withColumnsRenamed({"first_hour_utc": "first_hour_utc", "last_hour_utc": "last_hour_utc"})


@query("continuity_join", _U + """
SELECT p.subscription_id, p.prior_max, n.new_min, CAST(date_diff('hour', p.prior_max, n.new_min) AS BIGINT) AS gap_hours
FROM (SELECT subscription_id, max(hour_utc) AS prior_max FROM usage
      WHERE snapshot_date < (SELECT max(snapshot_date) FROM usage) GROUP BY 1) p
JOIN (SELECT subscription_id, min(hour_utc) AS new_min FROM usage
      WHERE snapshot_date = (SELECT max(snapshot_date) FROM usage) GROUP BY 1) n
  ON p.subscription_id = n.subscription_id""")
def q_continuity_join(spark, root):
    u = X.usage_hourly(spark, root)
    latest = u.agg(F.max("snapshot_date")).scalar()
    j = J.continuity_join(u.filter(F.col("snapshot_date") < latest), u.filter(F.col("snapshot_date") == latest),
                          ["subscription_id"], "hour_utc")
    return j.select("subscription_id", "prior_max", "new_min",
                    F.timestamp_diff("HOUR", "prior_max", "new_min").alias("gap_hours"))


@query("hourly_demand", _U + """
SELECT hour_utc, count(*) AS subscriptions, CAST(sum(hourly_charge) AS DOUBLE) AS eligible_usage
FROM (SELECT *, row_number() OVER (PARTITION BY subscription_id, hour_utc
                                   ORDER BY snapshot_date DESC, ingestion_timestamp DESC) AS rn FROM usage)
WHERE rn = 1 GROUP BY hour_utc""")
def q_hourly_demand(spark, root):
    u = W.latest_per_key(X.usage_hourly(spark, root), ["subscription_id", "hour_utc"],
                         ["snapshot_date", "ingestion_timestamp"])
    return u.groupBy("hour_utc").agg(F.count(F.lit(1)).alias("subscriptions"),
                                     _d(F.sum("hourly_charge")).alias("eligible_usage"))


# ------------------------------------------------------------------ seats
_S = w(("seats", O.SEATS))
_NOW = f"TIMESTAMP '{X.SEATS_NOW}'"
_BAND_SQL = f"""CASE WHEN last_activity_at IS NULL THEN 'Never Active'
  WHEN last_activity_at >= {_NOW} - INTERVAL 30 DAY THEN 'Active (< 30 days)'
  WHEN last_activity_at >= {_NOW} - INTERVAL 60 DAY THEN 'Inactive (30-60 days)'
  WHEN last_activity_at >= {_NOW} - INTERVAL 90 DAY THEN 'Inactive (60-90 days)'
  ELSE 'Inactive (> 90 days)' END"""
_DAYS_SQL = f"CAST(trunc(epoch({_NOW} - last_activity_at) / 86400) AS BIGINT)"
_SA = w(("seats", O.SEATS), ("act", f"SELECT *, {_DAYS_SQL} AS days_since_activity, {_BAND_SQL} AS activity_status FROM seats"))


def _seat_activity(spark, root):
    s = X.seats(spark, root)
    now = F.lit(X.SEATS_NOW).cast("timestamp_ntz")
    return s.select("*", days_since("last_activity_at", now).alias("days_since_activity"),
                    activity_band("last_activity_at", now).alias("activity_status"))


@query("activity_band", _SA + "SELECT user_login, organization, last_activity_at, days_since_activity, activity_status FROM act")
def q_activity_band(spark, root):
    return _seat_activity(spark, root).select("user_login", "organization", "last_activity_at",
                                              "days_since_activity", "activity_status")


@query("activity_summary", _SA + "SELECT activity_status, count(*) AS seats FROM act GROUP BY 1")
def q_activity_summary(spark, root):
    return _seat_activity(spark, root).groupBy("activity_status").agg(F.count(F.lit(1)).alias("seats"))


@query("inactive_seats", _SA + """
SELECT user_login, assigning_team, days_since_activity, activity_status FROM act
WHERE days_since_activity > 60 OR days_since_activity IS NULL""")
def q_inactive_seats(spark, root):
    """Reclaim list: more than 60 days or never; ordered days desc, nulls first."""
    a = _seat_activity(spark, root)
    out = a.filter((F.col("days_since_activity") > 60) | F.col("days_since_activity").isNull())
    return out.select("user_login", "assigning_team", "days_since_activity", "activity_status") \
        .orderBy(F.col("days_since_activity").desc_nulls_first(), "user_login")


@query("inactive_broad", _SA + """
SELECT organization, count(*) AS inactive_or_never FROM act
WHERE regexp_matches(activity_status, 'Inactive|Never Active') GROUP BY 1""")
def q_inactive_broad(spark, root):
    a = _seat_activity(spark, root).filter(F.col("activity_status").rlike("Inactive|Never Active"))
    return a.groupBy("organization").agg(F.count(F.lit(1)).alias("inactive_or_never"))


@query("seat_buckets", _SA + """
SELECT count_if(last_activity_at IS NULL) AS never_active,
       count_if(days_since_activity > 30 AND days_since_activity <= 60) AS inactive_30_60,
       count_if(days_since_activity > 60) AS inactive_60_plus,
       count_if(activity_status = 'Active (< 30 days)') AS active
FROM act""")
def q_seat_buckets(spark, root):
    a = _seat_activity(spark, root)
    d = F.col("days_since_activity")
    return a.agg(F.count_if(F.col("last_activity_at").isNull()).alias("never_active"),
                 F.count_if((d > 30) & (d <= 60)).alias("inactive_30_60"),
                 F.count_if(d > 60).alias("inactive_60_plus"),
                 F.count_if(F.col("activity_status") == "Active (< 30 days)").alias("active"))


@query("category_share", _S + """
SELECT last_activity_editor, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS percent
FROM seats WHERE last_activity_editor IS NOT NULL AND last_activity_at IS NOT NULL GROUP BY 1""")
def q_category_share(spark, root):
    s = X.seats(spark, root).filter(F.col("last_activity_at").isNotNull())
    return A.category_share(s, "last_activity_editor")


@query("seat_utilisation", _SA + """
SELECT organization, count(*) AS total_seats, count_if(activity_status = 'Active (< 30 days)') AS active_seats,
       coalesce(round(count_if(activity_status = 'Active (< 30 days)') * 100.0 / nullif(count(*), 0), 2), 0.0) AS utilisation_pct
FROM act GROUP BY 1""")
def q_seat_utilisation(spark, root):
    a = _seat_activity(spark, root)
    g = a.groupBy("organization").agg(F.count(F.lit(1)).alias("total_seats"),
                                      F.count_if(F.col("activity_status") == "Active (< 30 days)").alias("active_seats"))
    return g.withColumn("utilisation_pct", A.seat_utilisation(F.col("active_seats"), F.col("total_seats")))


@query("seat_cost", w(("focus", O.FOCUS)) + _SA.replace("WITH ", ", ", 1) + """
SELECT s.organization, c.month, s.inactive_seats, s.total_seats, CAST(c.org_cost AS DOUBLE) AS org_cost,
       CAST(c.org_cost AS DOUBLE) / s.total_seats AS cost_per_seat,
       CAST(c.org_cost AS DOUBLE) / s.total_seats * s.inactive_seats AS inactive_seat_cost
FROM (SELECT organization, count(*) AS total_seats, count_if(days_since_activity > 60 OR days_since_activity IS NULL) AS inactive_seats
      FROM act GROUP BY 1) s
JOIN (SELECT RegionName AS organization, date_trunc('month', ChargePeriodStart)::DATE AS month, sum(BilledCost) AS org_cost
      FROM focus GROUP BY 1, 2) c
  ON s.organization = c.organization""")
def q_seat_cost(spark, root):
    """Inactive seats joined to the organisation's cost of every billing period."""
    a = _seat_activity(spark, root)
    d = F.col("days_since_activity")
    seats = a.groupBy("organization").agg(F.count(F.lit(1)).alias("total_seats"),
                                          F.count_if((d > 60) | d.isNull()).alias("inactive_seats"))
    month = F.to_date(F.date_trunc("month", "ChargePeriodStart")).alias("month")
    cost = X.focus(spark, root).groupBy(F.col("RegionName").alias("organization"), month).agg(F.sum("BilledCost").alias("org_cost"))
    j = seats.join(cost, "organization")
    per = _d("org_cost") / F.col("total_seats")
    return j.select("organization", "month", "inactive_seats", "total_seats", _d("org_cost").alias("org_cost"),
                    per.alias("cost_per_seat"), (per * F.col("inactive_seats")).alias("inactive_seat_cost"))


# ------------------------------------------------------------------ two grains
_G = w(("grains", O.GRAINS))


@query("two_grain_landing", _G + """
SELECT grain, count(*) AS rows, CAST(sum(cost_value) AS DOUBLE) AS cost, CAST(sum(rows) AS BIGINT) AS source_rows
FROM grains GROUP BY 1""")
def q_two_grain(spark, root):
    g = X.grains(spark, root)
    return g.groupBy("grain").agg(F.count(F.lit(1)).alias("rows"), _d(F.sum("cost_value")).alias("cost"),
                                  F.sum("rows").cast("long").alias("source_rows"))


@query("grain_reconcile", _G + """
SELECT subscription_uuid, CAST(subscription AS DOUBLE) AS subscription, CAST(environment AS DOUBLE) AS environment,
       CAST(coalesce(subscription, 0) - coalesce(environment, 0) AS DOUBLE) AS unattributed,
       abs(coalesce(subscription, 0) - coalesce(environment, 0)) > 0.01 AS flagged
FROM (SELECT subscription_uuid, sum(CASE WHEN grain = 'subscription' THEN cost_value END) AS subscription,
             sum(CASE WHEN grain = 'environment' THEN cost_value END) AS environment
      FROM grains GROUP BY 1)""")
def q_grain_reconcile(spark, root):
    return A.grain_reconcile(X.grains(spark, root))


# ------------------------------------------------------------------ capacity
_C = w(("fact", O.CAPACITY_FACT))
CAP_WINDOW_DAYS = 90


@query("summarize_fact", _C + f"""
SELECT capacity_id, workspace_id, item_id, operation_name, usage_date,
       CAST(sum(cu_s) AS DOUBLE) AS total_cu_s, CAST(sum(duration_s) AS DOUBLE) AS total_duration_s,
       CAST(sum(operation_count) AS BIGINT) AS operations, CAST(sum(success_count) AS BIGINT) AS successes,
       CAST(sum(failure_count) AS BIGINT) AS failures, CAST(sum(throttling_s) AS DOUBLE) AS throttling_s,
       CAST(sum(user_count) AS BIGINT) AS users
FROM fact WHERE usage_date >= DATE '{X.CAPACITY_AS_OF}' - INTERVAL {CAP_WINDOW_DAYS} DAY
GROUP BY 1, 2, 3, 4, 5""")
def q_summarize_fact(spark, root):
    return _summarize(spark, root)


def _summarize(spark, root):
    f = X.capacity_fact(spark, root)
    f = f.filter(F.col("usage_date") >= F.date_sub(F.lit(X.CAPACITY_AS_OF).cast("date"), CAP_WINDOW_DAYS))
    return f.groupBy("capacity_id", "workspace_id", "item_id", "operation_name", "usage_date").agg(
        _d(F.sum("cu_s")).alias("total_cu_s"), _d(F.sum("duration_s")).alias("total_duration_s"),
        F.sum("operation_count").cast("long").alias("operations"), F.sum("success_count").cast("long").alias("successes"),
        F.sum("failure_count").cast("long").alias("failures"), _d(F.sum("throttling_s")).alias("throttling_s"),
        F.sum("user_count").cast("long").alias("users"))


@query("select_dim", w(("items", O.ITEMS)) +
       'SELECT item_id AS "Item Id", item_name AS "Item Name", item_kind AS "Item Kind" FROM items')
def q_select_dim(spark, root):
    items = X.capacity_dims(spark, root)["items"]
    return items.select(F.col("item_id").alias("Item Id"), F.col("item_name").alias("Item Name"),
                        F.col("item_kind").alias("Item Kind"))


@query("select_dims", w(("capacities", O.CAPACITIES), ("workspaces", O.WORKSPACES)) + """
SELECT 'capacity' AS dim, capacity_id AS "Id", capacity_name AS "Name", sku AS "Kind" FROM capacities
UNION ALL SELECT 'workspace', workspace_id, workspace_name, NULL FROM workspaces""")
def q_select_dims(spark, root):
    """The other two dimensions under their display names, stacked by name."""
    dims = X.capacity_dims(spark, root)
    c = dims["capacities"].select(F.lit("capacity").alias("dim"), F.col("capacity_id").alias("Id"),
                                  F.col("capacity_name").alias("Name"), F.col("sku").alias("Kind"))
    ws = dims["workspaces"].select(F.lit("workspace").alias("dim"), F.col("workspace_id").alias("Id"), F.col("workspace_name").alias("Name"))
    return c.unionByName(ws, allowMissingColumns=True)


@query("dedupe_dim", w(("items", O.ITEMS)) + """
SELECT item_id, item_name, item_kind, "Timestamp" FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY "Timestamp" DESC, item_name DESC) AS rn FROM items)
WHERE rn = 1""")
def q_dedupe_dim(spark, root):
    return W.dedupe_dim(X.capacity_dims(spark, root)["items"], "item_id", ["Timestamp", "item_name"])


@query("star_enrich", w(("fact", O.CAPACITY_FACT), ("capacities", O.CAPACITIES), ("workspaces", O.WORKSPACES),
                        ("items", O.ITEMS)) + f"""
SELECT s.*, c.capacity_name, c.sku, w.workspace_name, i.item_name, i.item_kind
FROM (SELECT capacity_id, workspace_id, item_id, operation_name, usage_date, CAST(sum(cu_s) AS DOUBLE) AS total_cu_s
      FROM fact WHERE usage_date >= DATE '{X.CAPACITY_AS_OF}' - INTERVAL {CAP_WINDOW_DAYS} DAY GROUP BY 1, 2, 3, 4, 5) s
LEFT JOIN capacities c ON s.capacity_id = c.capacity_id
LEFT JOIN workspaces w ON s.workspace_id = w.workspace_id
LEFT JOIN (SELECT item_id, item_name, item_kind FROM (
             SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY "Timestamp" DESC, item_name DESC) AS rn FROM items)
           WHERE rn = 1) i ON s.item_id = i.item_id""")
def q_star_enrich(spark, root):
    s = _summarize(spark, root).select("capacity_id", "workspace_id", "item_id", "operation_name", "usage_date",
                                       "total_cu_s")
    dims = X.capacity_dims(spark, root)
    items = W.dedupe_dim(dims["items"], "item_id", ["Timestamp", "item_name"]).drop("Timestamp")
    return J.star_enrich(s, [(dims["capacities"], ["capacity_id"]), (dims["workspaces"], ["workspace_id"]),
                             (items, ["item_id"])])


@query("capacity_daily", _C + """
SELECT capacity_id, usage_date, CAST(sum(cu_s) AS DOUBLE) AS cu_seconds FROM fact GROUP BY 1, 2""")
def q_capacity_daily(spark, root):
    f = X.capacity_fact(spark, root)
    return f.groupBy("capacity_id", "usage_date").agg(_d(F.sum("cu_s")).alias("cu_seconds"))


@query("capacity_chargeback", _C + """
SELECT usage_date, capacity_id, workspace_id, CAST(ws_cu AS DOUBLE) AS workspace_cu_s,
       CAST(ws_cu AS DOUBLE) / CAST(sum(ws_cu) OVER (PARTITION BY usage_date, capacity_id) AS DOUBLE) AS cu_share,
       CAST(ws_cu AS DOUBLE) / CAST(sum(ws_cu) OVER (PARTITION BY usage_date, capacity_id) AS DOUBLE) * 100.0 AS charged_amount
FROM (SELECT usage_date, capacity_id, workspace_id, sum(cu_s) AS ws_cu FROM fact GROUP BY 1, 2, 3)""")
def q_capacity_chargeback(spark, root):
    """Daily capacity price (100 per capacity-day) shared to workspaces by CU
    share.  Aggregate to workspace-day first; the share window then runs
    over a capacity-day's workspaces only."""
    f = X.capacity_fact(spark, root)
    ws = f.groupBy("usage_date", "capacity_id", "workspace_id").agg(F.sum("cu_s").alias("ws_cu"))
    cap = ws.groupBy("usage_date", "capacity_id").agg(F.sum("ws_cu").alias("cap_cu"))
    j = ws.join(cap, ["usage_date", "capacity_id"])
    share = _d("ws_cu") / _d("cap_cu")
    return j.select("usage_date", "capacity_id", "workspace_id", _d("ws_cu").alias("workspace_cu_s"),
                    share.alias("cu_share"), (share * 100.0).alias("charged_amount"))


# a capacity-day costs 100.00: cents to workspaces, then each workspace's cents to its items
CAPACITY_CENTS = 10000
_SHARES_SQL = _C + """
, it AS (SELECT usage_date, capacity_id, workspace_id, item_id, CAST(sum(cu_s) * 100 AS HUGEINT) AS wt FROM fact GROUP BY 1, 2, 3, 4)
, ws AS (SELECT usage_date, capacity_id, workspace_id, sum(wt) AS wt FROM it GROUP BY 1, 2, 3)
, w1 AS (SELECT *, sum(wt) OVER g AS tot, count(*) OVER g AS k FROM ws WINDOW g AS (PARTITION BY usage_date, capacity_id))
, w2 AS (SELECT *, CASE WHEN tot > 0 THEN wt ELSE 1 END AS v, CASE WHEN tot > 0 THEN tot ELSE k END AS t FROM w1)
, w3 AS (SELECT *, 10000 * v // t AS whole, 10000 * v - (10000 * v // t) * t AS rest FROM w2)
, w4 AS (SELECT *, 10000 - sum(whole) OVER g AS spare, row_number() OVER (PARTITION BY usage_date, capacity_id ORDER BY rest DESC, workspace_id) AS nth
         FROM w3 WINDOW g AS (PARTITION BY usage_date, capacity_id))
, wsc AS (SELECT usage_date, capacity_id, workspace_id, whole + CASE WHEN nth <= spare THEN 1 ELSE 0 END AS cents FROM w4)
, i1 AS (SELECT it.*, cents, sum(wt) OVER g AS tot, count(*) OVER g AS k FROM it JOIN wsc USING (usage_date, capacity_id, workspace_id)
         WINDOW g AS (PARTITION BY usage_date, capacity_id, workspace_id))
, i2 AS (SELECT *, CASE WHEN tot > 0 THEN wt ELSE 1 END AS v, CASE WHEN tot > 0 THEN tot ELSE k END AS t FROM i1)
, i3 AS (SELECT *, cents * v // t AS whole, cents * v - (cents * v // t) * t AS rest FROM i2)
, i4 AS (SELECT *, cents - sum(whole) OVER g AS spare,
                row_number() OVER (PARTITION BY usage_date, capacity_id, workspace_id ORDER BY rest DESC, item_id) AS nth
         FROM i3 WINDOW g AS (PARTITION BY usage_date, capacity_id, workspace_id))
, itc AS (SELECT usage_date, capacity_id, workspace_id, item_id, wt, cents, whole + CASE WHEN nth <= spare THEN 1 ELSE 0 END AS item_cents FROM i4)
"""


def _item_shares(spark, root):
    from ..operators.allocate import share_exactly
    f = X.capacity_fact(spark, root)
    day = ["usage_date", "capacity_id"]
    items = f.groupBy(*day, "workspace_id", "item_id").agg((F.sum("cu_s") * 100).cast("decimal(38,0)").alias("weight"))
    ws = items.groupBy(*day, "workspace_id").agg(F.sum("weight").alias("ws_weight")).withColumn("price", F.lit(CAPACITY_CENTS))
    ws = share_exactly(ws, day, ["workspace_id"], "ws_weight", "price", "workspace_cents")
    j = items.join(ws.select(*day, "workspace_id", "workspace_cents"), [*day, "workspace_id"])
    return share_exactly(j, [*day, "workspace_id"], ["item_id"], "weight", "workspace_cents", "item_cents")


@query("capacity_chargeback_items", _SHARES_SQL + """
SELECT usage_date, capacity_id, workspace_id, item_id, CAST(wt AS DOUBLE) / 100 AS cu_s, CAST(cents AS DOUBLE) / 100 AS workspace_amount,
       CAST(item_cents AS DOUBLE) / 100 AS amount FROM itc""")
def q_capacity_chargeback_items(spark, root):
    """The capacity's money by workspace and item, largest remainders first: shares add
    up to the cent at both levels."""
    return _item_shares(spark, root).select(
        "usage_date", "capacity_id", "workspace_id", "item_id", (_d("weight") / 100).alias("cu_s"),
        (_d("workspace_cents") / 100).alias("workspace_amount"), (_d("item_cents") / 100).alias("amount"))


@query("capacity_chargeback_check", _SHARES_SQL + """
SELECT usage_date, capacity_id, count(*) AS items, CAST(sum(item_cents) AS DOUBLE) / 100 AS charged, sum(item_cents) = 10000 AS conserved
FROM itc GROUP BY 1, 2""")
def q_capacity_chargeback_check(spark, root):
    """Items' money of every capacity-day against the capacity's price."""
    g = _item_shares(spark, root).groupBy("usage_date", "capacity_id").agg(
        F.count(F.lit(1)).alias("items"), F.sum("item_cents").alias("cents"))
    return g.select("usage_date", "capacity_id", "items", (_d("cents") / 100).alias("charged"),
                    (F.col("cents") == CAPACITY_CENTS).alias("conserved"))


# ------------------------------------------------------------------ containers
_K = w(("containers", O.CONTAINERS))
_CAT_SQL = """CASE lower(type) WHEN 'microsoft.management/managementgroups' THEN 'management_group'
  WHEN 'microsoft.resources/subscriptions' THEN 'subscription'
  WHEN 'microsoft.resources/subscriptions/resourcegroups' THEN 'resource_group' END"""


def _category(col="type"):
    lt = F.lower(F.col(col))
    expr = None
    for cat, t in X.CONTAINER_TYPES.items():
        expr = F.when(lt == t.lower(), F.lit(cat)) if expr is None else expr.when(lt == t.lower(), F.lit(cat))
    return expr


@query("split_by_type", _K + f"""
SELECT id, name, type, subscriptionId, resourceGroup, tags, {_CAT_SQL} AS container_category
FROM containers WHERE {_CAT_SQL} IS NOT NULL""")
def q_split_by_type(spark, root):
    c = X.containers(spark, root).withColumn("container_category", _category())
    return c.filter(F.col("container_category").isNotNull())


@query("unknown_types", _K + f"""
SELECT type, count(*) AS containers FROM containers WHERE {_CAT_SQL} IS NULL GROUP BY 1""")
def q_unknown_types(spark, root):
    """Types matching no known value, plus the null type (counted as skipped)."""
    c = X.containers(spark, root).filter(_category().isNull())
    return c.groupBy("type").agg(F.count(F.lit(1)).alias("containers")).orderBy(F.col("type").asc_nulls_last())


@query("count_by_type", _K + "SELECT type, count(*) AS count FROM containers GROUP BY 1")
def q_count_by_type(spark, root):
    return A.count_by(X.containers(spark, root), "type")


@query("is_tagged", _K + f"""
SELECT {_CAT_SQL} AS container_category, count(*) AS containers,
       avg(CASE WHEN tags IS NOT NULL AND tags <> 'null' AND tags <> '{{}}' THEN 1 ELSE 0 END) AS tagged_share
FROM containers GROUP BY 1""")
def q_is_tagged(spark, root):
    c = X.containers(spark, root)
    return c.groupBy(_category().alias("container_category")).agg(
        F.count(F.lit(1)).alias("containers"), F.avg(is_tagged("tags").cast("int")).alias("tagged_share"))


@query("multi_key_order", _K + """
SELECT subscriptionId, type, count(*) AS count FROM containers WHERE subscriptionId IS NOT NULL GROUP BY 1, 2""")
def q_multi_key_order(spark, root):
    c = X.containers(spark, root).filter(F.col("subscriptionId").isNotNull())
    g = c.groupBy("subscriptionId", "type").agg(F.count(F.lit(1)).alias("count"))
    return g.orderBy(F.col("subscriptionId").asc(), F.col("count").desc(), F.col("type").asc())


# ------------------------------------------------------------------ emissions
_E = w(("carbon", O.EMISSIONS))


@query("count_sum_by", _E + """
SELECT tenant_id, report_month, count(*) AS records, CAST(round(sum(CAST(latest_month_emissions AS DECIMAL(38,6))), 4) AS DOUBLE) AS total
FROM carbon GROUP BY 1, 2""")
def q_count_sum_by(spark, root):
    return A.count_sum_by(X.emissions(spark, root), ["tenant_id", "report_month"], "latest_month_emissions")


@query("distinct_stats", _E + """
SELECT tenant_id, count(*) AS rows, count(DISTINCT report_month) AS distinct_report_month,
       count(DISTINCT subscription_id) AS distinct_subscription_id, count(DISTINCT resource_type) AS distinct_resource_type,
       count(DISTINCT location) AS distinct_location,
       CAST(sum(CAST(latest_month_emissions AS DECIMAL(38,6))) AS DOUBLE) AS total_latest_month_emissions
FROM carbon GROUP BY 1""")
def q_distinct_stats(spark, root):
    return A.distinct_stats(X.emissions(spark, root), "tenant_id",
                            ["report_month", "subscription_id", "resource_type", "location"], "latest_month_emissions")


@query("resolve_months", _E + """
SELECT report_month FROM (SELECT report_month, dense_rank() OVER (ORDER BY report_month DESC) AS r
                          FROM (SELECT DISTINCT report_month FROM carbon)) WHERE r <= 2""")
def q_resolve_months(spark, root):
    from ..operators.landing import resolve_months
    return resolve_months(X.emissions(spark, root), "")


@query("top_emitters", _E + """
SELECT subscription_id, resource_id, report_month,
       CAST(round(sum(CAST(latest_month_emissions AS DECIMAL(38,6))), 4) AS DOUBLE) AS emissions
FROM carbon WHERE report_month = (SELECT max(report_month) FROM carbon)
GROUP BY 1, 2, 3 ORDER BY emissions DESC, resource_id, subscription_id LIMIT 10""")
def q_top_emitters(spark, root):
    c = X.emissions(spark, root)
    latest = c.agg(F.max("report_month")).scalar()
    g = c.filter(F.col("report_month") == latest).groupBy("subscription_id", "resource_id", "report_month").agg(
        _d(F.round(F.sum(F.col("latest_month_emissions").cast("decimal(38,6)")), 4)).alias("emissions"))
    return g.orderBy(F.col("emissions").desc(), "resource_id", "subscription_id").limit(10)


@query("lookup_default", w(("carbon", O.EMISSIONS), ("containers", O.CONTAINERS)) + """
SELECT c.subscription_id, coalesce(n.name, 'Unknown') AS subscription_name, count(*) AS records
FROM carbon c LEFT JOIN (SELECT lower(subscriptionId) AS k, min(name) AS name FROM containers
                         WHERE lower(type) = 'microsoft.resources/subscriptions' GROUP BY 1) n
  ON lower(c.subscription_id) = n.k
GROUP BY 1, 2""")
def q_lookup_default(spark, root):
    subs = X.containers(spark, root).filter(F.lower("type") == "microsoft.resources/subscriptions")
    subs = subs.groupBy(F.lower("subscriptionId").alias("sid")).agg(F.min("name").alias("name"))
    c = J.lookup_default(X.emissions(spark, root), subs, "subscription_id", "sid", "name", "subscription_name")
    return c.groupBy("subscription_id", "subscription_name").agg(F.count(F.lit(1)).alias("records"))


# ------------------------------------------------------------------ pipelines
_P = w(("items", O.PIPELINE_ITEMS))
PIPE_NOW = "2001-08-02 00:00:00"


@query("recent_runs", _P + f"""
SELECT DISTINCT run_id, pipeline_name, result, CAST(strptime(created_date, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS created_at
FROM items WHERE strptime(created_date, '%Y-%m-%dT%H:%M:%SZ') >= TIMESTAMP '{PIPE_NOW}' - INTERVAL 90 DAY""")
def q_recent_runs(spark, root):
    p = X.pipeline_items(spark, root).select("run_id", "pipeline_name", "result",
                                             parse_iso_ts("created_date").alias("created_at"))
    now = F.lit(PIPE_NOW).cast("timestamp_ntz")
    return p.filter(F.col("created_at") >= now - F.expr("INTERVAL 90 DAYS")).distinct()


@query("pipeline_stats", _P + """
SELECT pipeline_name, count(*) AS associations, count(DISTINCT work_item_id) AS distinct_work_items,
       count(DISTINCT run_id) AS runs, CAST(count(*) AS DOUBLE) / count(DISTINCT run_id) AS items_per_run
FROM items GROUP BY 1""")
def q_pipeline_stats(spark, root):
    p = X.pipeline_items(spark, root)
    return p.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("associations"), F.count_distinct("work_item_id").alias("distinct_work_items"),
        F.count_distinct("run_id").alias("runs"),
        (F.count(F.lit(1)).cast("double") / F.count_distinct("run_id")).alias("items_per_run"))


@query("pipeline_top_results", _P + """
SELECT result, count(*) AS associations, count(DISTINCT work_item_id) AS distinct_work_items
FROM items GROUP BY 1 ORDER BY associations DESC, result LIMIT 10""")
def q_pipeline_top_results(spark, root):
    p = X.pipeline_items(spark, root)
    g = p.groupBy("result").agg(F.count(F.lit(1)).alias("associations"),
                                F.count_distinct("work_item_id").alias("distinct_work_items"))
    return g.orderBy(F.col("associations").desc(), "result").limit(10)


# cost of a resource in a month, shared over the work items of the run that deployed it: units
# of 1/10000, the first work items take the units that do not divide evenly; what no known
# run carries stays as "unallocated"
_LINEAGE = w(("items", O.PIPELINE_ITEMS), ("focus", O.FOCUS), ("tagged", O.RESOURCE_TAGS)) + """
, deployed AS (SELECT ResourceId, CASE WHEN json_valid(tags) THEN json_extract_string(tags, '$.pipeline_run_id') END AS run FROM tagged)
, work AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY work_item_id) AS nth, count(*) OVER (PARTITION BY run) AS n
           FROM (SELECT DISTINCT CAST(run_id AS VARCHAR) AS run, pipeline_name, work_item_id FROM items))
, cost AS (SELECT ResourceId, date_trunc('month', ChargePeriodStart)::DATE AS month,
                  CAST(sum(BilledCost) * 10000 AS BIGINT) AS units FROM focus GROUP BY 1, 2)
, shared AS (SELECT c.month, coalesce(w.pipeline_name, 'unallocated') AS pipeline_name, w.work_item_id,
                    CASE WHEN w.n IS NULL THEN c.units ELSE (c.units - ((c.units % w.n) + w.n) % w.n) // w.n
                         + CASE WHEN w.nth <= ((c.units % w.n) + w.n) % w.n THEN 1 ELSE 0 END END AS units
             FROM cost c LEFT JOIN deployed d ON c.ResourceId = d.ResourceId LEFT JOIN work w ON d.run = w.run)
"""
UNALLOCATED = "unallocated"


def _lineage(spark, root):
    """((month, pipeline_name, work_item_id, units), cost): each resource's monthly cost, by its
    run tag, shared over the run's work items.  Only left joins, so nothing is lost."""
    tags = X.resource_tags(spark, root).select("ResourceId", F.get_json_object("tags", "$.pipeline_run_id").alias("run"))
    # by the run's own id, by which the items come out of their join: the distinct rows, the window and
    # the join with the tags need no further exchange of them
    work = X.pipeline_items(spark, root).select("run_id", "pipeline_name", "work_item_id").distinct()
    mine = Window.partitionBy("run_id")                    # the work items of one run
    work = work.withColumn("nth", F.row_number().over(mine.orderBy("work_item_id"))).withColumn("n", F.count(F.lit(1)).over(mine))
    # a tag names a run if it is the run's id as text ("7", not "07")
    tags = tags.withColumn("run_id", F.col("run").try_cast(work.schema["run_id"].dataType)).filter(F.col("run_id").cast("string") == F.col("run"))
    # BilledCost has four decimals, so a row's units are whole and add up as long
    cost = X.focus(spark, root).groupBy("ResourceId", F.to_date(F.date_trunc("month", "ChargePeriodStart")).alias("month")).agg(
        F.sum((F.col("BilledCost") * 10000).cast("long")).alias("units"))
    # a resource without a usable tag joins no run: null never equals, and no window sees it
    owners = tags.join(work, "run_id").select("ResourceId", "pipeline_name", "work_item_id", "nth", "n")
    share = F.expr("(units - pmod(units, n)) div n") + (F.col("nth") <= F.pmod("units", "n")).cast("long")
    shared = cost.join(owners, "ResourceId", "left").select(
        "month", F.coalesce("pipeline_name", F.lit(UNALLOCATED)).alias("pipeline_name"), "work_item_id",
        F.coalesce(share, F.col("units")).alias("units"))
    return shared, cost


@query("resource_lineage", _LINEAGE + """
SELECT month, pipeline_name, count(DISTINCT work_item_id) AS work_items, CAST(sum(units) AS DOUBLE) / 10000 AS cost
FROM shared GROUP BY 1, 2""")
def q_resource_lineage(spark, root):
    """Resources -> pipeline run (JSON tag) -> work items: the month's cost by pipeline,
    with a line for what is unallocated."""
    # once per work item first, so the count below is a count and not a distinct over raw shares
    per = _lineage(spark, root)[0].groupBy("month", "pipeline_name", "work_item_id").agg(F.sum("units").alias("units"))
    return per.groupBy("month", "pipeline_name").agg(F.count("work_item_id").alias("work_items"),
                                                     (_d(F.sum("units")) / 10000).alias("cost"))


@query("lineage_conservation", _LINEAGE + """
SELECT c.month, c.units AS billed_units, CAST(s.a AS BIGINT) AS attributed_units, CAST(s.u AS BIGINT) AS unallocated_units,
       c.units = s.a + s.u AS conserved
FROM (SELECT month, CAST(sum(units) AS BIGINT) AS units FROM cost GROUP BY 1) c
JOIN (SELECT month, coalesce(sum(units) FILTER (pipeline_name <> 'unallocated'), 0) AS a,
             coalesce(sum(units) FILTER (pipeline_name = 'unallocated'), 0) AS u FROM shared GROUP BY 1) s ON c.month = s.month""")
def q_lineage_conservation(spark, root):
    """billed = attributed + unallocated for every month, in units of 1/10000."""
    shared, cost = _lineage(spark, root)
    none = F.col("pipeline_name") == UNALLOCATED
    part = lambda p: F.coalesce(F.sum(F.when(p, F.col("units"))), F.lit(0)).cast("long")
    lines = shared.groupBy("month").agg(part(~none).alias("attributed_units"), part(none).alias("unallocated_units"))
    billed = cost.groupBy("month").agg(F.sum("units").alias("billed_units"))
    return billed.join(lines, "month", "left").select(
        "month", "billed_units", "attributed_units", "unallocated_units",
        (F.col("billed_units") == F.col("attributed_units") + F.col("unallocated_units")).alias("conserved"))


# ------------------------------------------------------------------ directory
_D = w(("directory", O.DIRECTORY), ("requests", O.SERVICE_REQUESTS))


@query("directory_resolve", _D + """
SELECT r.request_id, r.service_id, r.environment, d.sid IS NOT NULL AS exists,
       d.PlatformID AS platform_id, d.DivisionID AS division_id, d.CostCentre AS cost_centre
FROM requests r LEFT JOIN (SELECT upper(trim(ServiceID)) AS sid, * FROM directory) d ON upper(trim(r.service_id)) = d.sid""")
def q_directory_resolve(spark, root):
    return J.directory_resolve(X.service_requests(spark, root), X.directory(spark, root))


@query("tag_gate", _D + """
SELECT request_id, service_id, environment, reason IS NULL AS accepted, reason,
       CASE WHEN reason IS NULL THEN 'tags: {' || chr(10) || '  ServiceID: ''' || upper(trim(service_id)) || '''' || chr(10)
            || '  Environment: ''' || lower(trim(environment)) || '''' || chr(10) || '}' END AS tag_block
FROM (SELECT r.*, CASE WHEN lower(trim(r.environment)) NOT IN ('dev', 'test', 'qa', 'staging', 'prod')
                         THEN 'environment not allowed: ' || coalesce(r.environment, '')
                       WHEN d.sid IS NULL THEN 'service id does not resolve: ' || r.service_id END AS reason
      FROM requests r LEFT JOIN (SELECT upper(trim(ServiceID)) AS sid FROM directory) d
        ON upper(trim(r.service_id)) = d.sid)""")
def q_tag_gate(spark, root):
    return J.tag_gate(X.service_requests(spark, root), X.directory(spark, root))


@query("run_summary", _E + """
SELECT tenant_id, count(*) AS records, count(DISTINCT report_month) AS months,
       CAST(round(sum(CAST(latest_month_emissions AS DECIMAL(38,6))), 4) AS DOUBLE) AS total_emissions
FROM carbon GROUP BY 1
UNION ALL
SELECT NULL, count(*), count(DISTINCT report_month),
       CAST(round(sum(CAST(latest_month_emissions AS DECIMAL(38,6))), 4) AS DOUBLE) FROM carbon""")
def q_run_summary(spark, root):
    """Structured run result: one row per tenant plus an overall row (null
    tenant), computed in one grouping-sets aggregate."""
    c = X.emissions(spark, root)
    g = c.groupingSets([["tenant_id"], []], "tenant_id").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("report_month").alias("months"),
        _d(F.round(F.sum(F.col("latest_month_emissions").cast("decimal(38,6)")), 4)).alias("total_emissions"))
    return g
