"""Cost-fact products over the FOCUS adapter: daily, monthly, fiscal,
chargeback and commitment views.  Each has DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import fiscal_year, fiscal_year_start
from ..functions.tags import LEVELS, TOTAL_LABEL, service_id, split_path
from ..operators import aggregate as A
from ..operators import windows as W
from ..operators.hierarchy import daily_by_key
from ..sources.fixtures import focus
from .oracle_adapters import FOCUS, SERVICE_ID_EXPR, with_ctes
from .registry import query

_F = with_ctes(("focus", FOCUS))
AS_OF = "2001-11-04"          # last charge day in the driver data; report "today"
# Currency conversion factors to USD.
FX_RATES = [("USD", 1.0), ("EUR", 1.1), ("GBP", 1.3)]
EDP_RATE = "0.12"              # uniform enterprise discount scalar


def _d(c):
    return F.col(c).cast("double") if isinstance(c, str) else c.cast("double")


@query("daily_by_account", _F + """
SELECT SubAccountId AS unique_id, CAST(ChargePeriodStart AS DATE) AS ds, CAST(sum(BilledCost) AS DOUBLE) AS y
FROM focus GROUP BY 1, 2""")
def q_daily_by_account(spark, root):
    d = daily_by_key(focus(spark, root), "SubAccountId")
    return d.select("unique_id", "ds", _d("y").alias("y"))


def _month_dims(df):
    return df.select(
        fiscal_year(F.to_date("ChargePeriodStart")).alias("fiscal_year"),
        F.month("ChargePeriodStart").alias("month"),
        F.col("RegionName").alias("department"), F.col("ServiceName").alias("category"),
        F.coalesce(F.col("CommitmentDiscountStatus"), F.lit("OnDemand")).alias("environment"),
        F.col("Currency").alias("region"), "BilledCost", "ResourceId")


@query("monthly_summary", _F + """
SELECT CAST(year(ChargePeriodStart) + CASE WHEN month(ChargePeriodStart) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
       CAST(month(ChargePeriodStart) AS INTEGER) AS month, RegionName AS department, ServiceName AS category,
       coalesce(CommitmentDiscountStatus, 'OnDemand') AS environment, Currency AS region,
       CAST(sum(BilledCost) AS DOUBLE) AS total_cost, CAST(sum(BilledCost) AS DOUBLE) / count(*) AS avg_cost,
       CAST(max(BilledCost) AS DOUBLE) AS max_cost, count(DISTINCT ResourceId) AS resources
FROM focus WHERE BilledCost IS NOT NULL AND BilledCost >= 0
GROUP BY ALL""")
def q_monthly_summary(spark, root):
    f = focus(spark, root).filter(F.col("BilledCost").isNotNull() & (F.col("BilledCost") >= 0))
    keys = ["fiscal_year", "month", "department", "category", "environment", "region"]
    return _month_dims(f).groupBy(*keys).agg(
        _d(F.sum("BilledCost")).alias("total_cost"), (_d(F.sum("BilledCost")) / F.count(F.lit(1))).alias("avg_cost"),
        _d(F.max("BilledCost")).alias("max_cost"), F.count_distinct("ResourceId").alias("resources"))


@query("monthly_trend", _F + f"""
SELECT CAST(date_trunc('month', ChargePeriodStart) AS DATE) AS month, SubAccountId AS resource_group,
       CAST(sum(BilledCost) AS DOUBLE) AS cost, count(*) AS records
FROM focus WHERE ChargePeriodStart >= TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY
GROUP BY 1, 2""")
def q_monthly_trend(spark, root):
    f = focus(spark, root).filter(F.col("ChargePeriodStart") >= F.lit(AS_OF).cast("timestamp_ntz") - F.expr("INTERVAL 90 DAYS"))
    return f.groupBy(F.to_date(F.date_trunc("month", "ChargePeriodStart")).alias("month"),
                     F.col("SubAccountId").alias("resource_group")).agg(
        _d(F.sum("BilledCost")).alias("cost"), F.count(F.lit(1)).alias("records"))


@query("mom_change", _F + """
SELECT department, year, month, cost, previous_cost,
       CAST(round((cost - previous_cost) * 100 / previous_cost, 2) AS DOUBLE) AS mom_change_pct
FROM (
  SELECT department, year, month, cost, lag(cost) OVER (PARTITION BY department ORDER BY year, month) AS previous_cost
  FROM (SELECT RegionName AS department, CAST(year(ChargePeriodStart) AS INTEGER) AS year,
               CAST(month(ChargePeriodStart) AS INTEGER) AS month, sum(BilledCost) AS cost
        FROM focus GROUP BY 1, 2, 3)
) WHERE previous_cost IS NOT NULL""".replace("SELECT department, year, month, cost, previous_cost,",
                                            "SELECT department, year, month, CAST(cost AS DOUBLE) AS cost, CAST(previous_cost AS DOUBLE) AS previous_cost,"))
def q_mom_change(spark, root):
    f = focus(spark, root)
    m = f.groupBy(F.col("RegionName").alias("department"), F.year("ChargePeriodStart").alias("year"),
                  F.month("ChargePeriodStart").alias("month")).agg(F.sum("BilledCost").alias("cost"))
    out = W.mom_change(m, "department", "year", "month", "cost")
    return out.select("department", "year", "month", _d("cost").alias("cost"),
                      _d("previous_cost").alias("previous_cost"), "mom_change_pct")


@query("fy_to_date", _F + """
SELECT ds, fiscal_year, fy_start, CAST(daily_cost AS DOUBLE) AS daily_cost,
       CAST(sum(daily_cost) OVER (PARTITION BY fiscal_year ORDER BY ds ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS fytd_cost
FROM (SELECT CAST(ChargePeriodStart AS DATE) AS ds,
             CAST(year(ChargePeriodStart) + CASE WHEN month(ChargePeriodStart) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
             make_date(CAST(year(ChargePeriodStart) + CASE WHEN month(ChargePeriodStart) >= 9 THEN 1 ELSE 0 END AS INTEGER) - 1, 9, 1) AS fy_start,
             sum(BilledCost) AS daily_cost
      FROM focus GROUP BY 1, 2, 3)""")
def q_fy_to_date(spark, root):
    d = (focus(spark, root).groupBy(F.to_date("ChargePeriodStart").alias("ds"))
         .agg(F.sum("BilledCost").alias("daily_cost")))
    d = d.select("ds", fiscal_year("ds").alias("fiscal_year"), fiscal_year_start("ds").alias("fy_start"), "daily_cost")
    out = W.running_total(d, ["fiscal_year"], "ds", "daily_cost", "fytd_cost")
    return out.select("ds", "fiscal_year", "fy_start", _d("daily_cost").alias("daily_cost"),
                      _d("fytd_cost").alias("fytd_cost"))


_FX_SQL = " UNION ALL ".join(f"SELECT '{c}' AS currency, CAST({r} AS DECIMAL(4,2)) AS rate" for c, r in FX_RATES)


@query("currency_normalise", _F + f"""
SELECT f.Currency AS currency, count(*) AS records, CAST(sum(f.BilledCost) AS DOUBLE) AS billed_local,
       CAST(sum(f.BilledCost * coalesce(r.rate, 1)) AS DOUBLE) AS billed_usd
FROM focus f LEFT JOIN ({_FX_SQL}) r ON f.Currency = r.currency
WHERE f.BilledCost IS NOT NULL GROUP BY 1""")
def q_currency_normalise(spark, root):
    rates = spark.createDataFrame([(c, str(r)) for c, r in FX_RATES], "fx_currency string, rate string") \
        .select("fx_currency", F.col("rate").cast("decimal(4,2)").alias("rate"))
    f = focus(spark, root).filter(F.col("BilledCost").isNotNull())
    # three-row rate table: broadcast has a fixed size bound
    j = f.join(F.broadcast(rates), f.Currency == rates.fx_currency, "left")
    return j.groupBy(F.col("Currency").alias("currency")).agg(
        F.count(F.lit(1)).alias("records"), _d(F.sum("BilledCost")).alias("billed_local"),
        _d(F.sum(F.col("BilledCost") * F.coalesce(F.col("rate"), F.lit(1)))).alias("billed_usd"))


@query("edp_effective", _F + f"""
SELECT CAST(date_trunc('month', ChargePeriodStart) AS DATE) AS month, CAST(sum(ListCost) AS DOUBLE) AS list_cost,
       CAST(sum(ListCost * (1 - CAST({EDP_RATE} AS DECIMAL(4,2)))) AS DOUBLE) AS edp_effective_cost
FROM focus GROUP BY 1""")
def q_edp_effective(spark, root):
    f = focus(spark, root)
    rate = F.lit(EDP_RATE).cast("decimal(4,2)")
    return f.groupBy(F.to_date(F.date_trunc("month", "ChargePeriodStart")).alias("month")).agg(
        _d(F.sum("ListCost")).alias("list_cost"),
        _d(F.sum(F.col("ListCost") * (F.lit(1) - rate))).alias("edp_effective_cost"))


@query("chargeback_monthly", _F + f"""
SELECT month, concat_ws('/', 'total', division, platform, workload, component) AS unique_id,
       CASE grouping(division) + grouping(platform) + grouping(workload) + grouping(component)
         WHEN 0 THEN 'component' WHEN 1 THEN 'workload' WHEN 2 THEN 'platform'
         WHEN 3 THEN 'division' ELSE 'total' END AS level,
       CAST(sum(EffectiveCost) AS DOUBLE) AS effective_cost, CAST(sum(BilledCost) AS DOUBLE) AS billed_cost
FROM (SELECT CAST(date_trunc('month', ChargePeriodStart) AS DATE) AS month, EffectiveCost, BilledCost,
             split_part(sid, '/', 1) AS division, split_part(sid, '/', 2) AS platform,
             split_part(sid, '/', 3) AS workload, split_part(sid, '/', 4) AS component
      FROM (SELECT *, {SERVICE_ID_EXPR} AS sid FROM focus))
GROUP BY month, ROLLUP(division, platform, workload, component)""")
def q_chargeback_monthly(spark, root):
    # Pre-aggregate to month x Service_ID before the 5x grouping-sets Expand,
    # so the expand runs over months x series rows, not over the fact.
    f = focus(spark, root)
    m = f.groupBy(F.to_date(F.date_trunc("month", "ChargePeriodStart")).alias("month"),
                  service_id("Tags").alias("sid")).agg(F.sum("EffectiveCost").alias("EffectiveCost"),
                                                       F.sum("BilledCost").alias("BilledCost"))
    p = m.select("month", "EffectiveCost", "BilledCost", *split_path("sid", LEVELS))
    sets = [["month"] + LEVELS[:i] for i in range(len(LEVELS), -1, -1)]
    rolled = sum(F.grouping(c) for c in LEVELS)
    names = ["component", "workload", "platform", "division", "total"]
    level = F.element_at(F.array(*[F.lit(n) for n in names]), (rolled + 1).cast("int"))
    out = p.groupingSets(sets, "month", *LEVELS).agg(
        level.alias("level"), _d(F.sum("EffectiveCost")).alias("effective_cost"),
        _d(F.sum("BilledCost")).alias("billed_cost"))
    return out.select("month", F.concat_ws("/", F.lit(TOTAL_LABEL), *LEVELS).alias("unique_id"), "level",
                      "effective_cost", "billed_cost")


@query("unused_variance", _F + """
SELECT CAST(date_trunc('month', ChargePeriodStart) AS DATE) AS month, CommitmentDiscountId AS commitment_id,
       CAST(sum(EffectiveCost) AS DOUBLE) AS unused_cost, count(*) AS records
FROM focus WHERE CommitmentDiscountStatus = 'Unused' GROUP BY 1, 2""")
def q_unused_variance(spark, root):
    f = focus(spark, root).filter(F.col("CommitmentDiscountStatus") == "Unused")
    return f.groupBy(F.to_date(F.date_trunc("month", "ChargePeriodStart")).alias("month"),
                     F.col("CommitmentDiscountId").alias("commitment_id")).agg(
        _d(F.sum("EffectiveCost")).alias("unused_cost"), F.count(F.lit(1)).alias("records"))


@query("list_vs_effective", _F + """
SELECT CAST(date_trunc('month', ChargePeriodStart) AS DATE) AS month, ServiceName AS service,
       CAST(sum(ListCost) AS DOUBLE) AS list_cost, CAST(sum(ContractedCost) AS DOUBLE) AS contracted_cost,
       CAST(sum(EffectiveCost) AS DOUBLE) AS effective_cost,
       CAST(sum(ListCost) - sum(EffectiveCost) AS DOUBLE) AS saving_vs_list,
       CAST(sum(ContractedCost) - sum(EffectiveCost) AS DOUBLE) AS saving_vs_contracted
FROM focus GROUP BY 1, 2""")
def q_list_vs_effective(spark, root):
    f = focus(spark, root)
    g = f.groupBy(F.to_date(F.date_trunc("month", "ChargePeriodStart")).alias("month"),
                  F.col("ServiceName").alias("service")).agg(
        F.sum("ListCost").alias("l"), F.sum("ContractedCost").alias("c"), F.sum("EffectiveCost").alias("e"))
    return g.select("month", "service", _d("l").alias("list_cost"), _d("c").alias("contracted_cost"),
                    _d("e").alias("effective_cost"), _d(F.col("l") - F.col("e")).alias("saving_vs_list"),
                    _d(F.col("c") - F.col("e")).alias("saving_vs_contracted"))


@query("amortisation_check", _F + """
SELECT CommitmentDiscountId AS commitment_id, CAST(date_trunc('month', ChargePeriodStart) AS DATE) AS month,
       count(*) AS suspect_rows, CAST(sum(BilledCost) AS DOUBLE) AS suspect_cost
FROM focus WHERE CommitmentDiscountStatus = 'Used' AND EffectiveCost = BilledCost GROUP BY 1, 2""")
def q_amortisation_check(spark, root):
    f = focus(spark, root).filter((F.col("CommitmentDiscountStatus") == "Used") &
                                  (F.col("EffectiveCost") == F.col("BilledCost")))
    return f.groupBy(F.col("CommitmentDiscountId").alias("commitment_id"),
                     F.to_date(F.date_trunc("month", "ChargePeriodStart")).alias("month")).agg(
        F.count(F.lit(1)).alias("suspect_rows"), _d(F.sum("BilledCost")).alias("suspect_cost"))


@query("invoice_bridge", _F + """
SELECT commitment_id, month, CAST(billed AS DOUBLE) AS billed, CAST(effective_used AS DOUBLE) AS effective_used,
       CAST(effective_unused AS DOUBLE) AS effective_unused, CAST(prepayment_movement AS DOUBLE) AS prepayment_movement,
       CAST(billed - (effective_used + effective_unused + prepayment_movement) AS DOUBLE) AS residual,
       billed - (effective_used + effective_unused + prepayment_movement) <> 0 AS failed
FROM (SELECT CommitmentDiscountId AS commitment_id, CAST(date_trunc('month', ChargePeriodStart) AS DATE) AS month,
             sum(BilledCost) AS billed,
             coalesce(sum(CASE WHEN CommitmentDiscountStatus = 'Used' THEN EffectiveCost END), 0) AS effective_used,
             coalesce(sum(CASE WHEN CommitmentDiscountStatus = 'Unused' THEN EffectiveCost END), 0) AS effective_unused,
             sum(ListCost * CAST(0.1 AS DECIMAL(2,1))) AS prepayment_movement
      FROM focus WHERE CommitmentDiscountId IS NOT NULL GROUP BY 1, 2)""")
def q_invoice_bridge(spark, root):
    """Per commitment x month: billed = effective(used) + effective(unused)
    + prepayment movement (the 10-point list-price share the commitment
    prepaid).  A non-zero residual marks rows whose amortisation is wrong."""
    f = focus(spark, root).filter(F.col("CommitmentDiscountId").isNotNull())
    g = f.groupBy(F.col("CommitmentDiscountId").alias("commitment_id"),
                  F.to_date(F.date_trunc("month", "ChargePeriodStart")).alias("month")).agg(
        F.sum("BilledCost").alias("billed"),
        F.coalesce(F.sum(F.when(F.col("CommitmentDiscountStatus") == "Used", F.col("EffectiveCost"))), F.lit(0)).alias("eu"),
        F.coalesce(F.sum(F.when(F.col("CommitmentDiscountStatus") == "Unused", F.col("EffectiveCost"))), F.lit(0)).alias("en"),
        F.sum(F.col("ListCost") * F.lit("0.1").cast("decimal(2,1)")).alias("pm"))
    resid = F.col("billed") - (F.col("eu") + F.col("en") + F.col("pm"))
    return g.select("commitment_id", "month", _d("billed").alias("billed"), _d("eu").alias("effective_used"),
                    _d("en").alias("effective_unused"), _d("pm").alias("prepayment_movement"),
                    _d(resid).alias("residual"), (resid != 0).alias("failed"))


@query("baselines", _F + """
SELECT SubAccountId AS subscription_id, count(*) AS days, CAST(sum(cost) AS DOUBLE) / count(*) AS mean_daily_cost
FROM (SELECT SubAccountId, CAST(ChargePeriodStart AS DATE) AS ds, sum(BilledCost) AS cost FROM focus GROUP BY 1, 2)
GROUP BY 1""")
def q_baselines(spark, root):
    d = daily_by_key(focus(spark, root), "SubAccountId", key_name="subscription_id")
    return d.groupBy("subscription_id").agg(F.count(F.lit(1)).alias("days"),
                                            (_d(F.sum("y")) / F.count(F.lit(1))).alias("mean_daily_cost"))


@query("weekday_profile", _F + """
SELECT weekday, count(*) AS days, CAST(sum(cost) AS DOUBLE) / count(*) AS mean_cost
FROM (SELECT CAST(isodow(CAST(ChargePeriodStart AS DATE)) - 1 AS INTEGER) AS weekday, CAST(ChargePeriodStart AS DATE) AS ds,
             sum(BilledCost) AS cost FROM focus GROUP BY 1, 2)
GROUP BY 1""")
def q_weekday_profile(spark, root):
    d = (focus(spark, root).groupBy(F.to_date("ChargePeriodStart").alias("ds"))
         .agg(F.sum("BilledCost").alias("cost")))
    return d.groupBy(F.weekday("ds").alias("weekday")).agg(
        F.count(F.lit(1)).alias("days"), (_d(F.sum("cost")) / F.count(F.lit(1))).alias("mean_cost"))


@query("period_bounds", _F + """
SELECT CAST(min(ChargePeriodStart) AS DATE) AS min_date, CAST(max(ChargePeriodStart) AS DATE) AS max_date,
       count(*) AS rows, count(DISTINCT SubAccountId) AS distinct_SubAccountId,
       count(DISTINCT CAST(ChargePeriodStart AS DATE)) AS distinct_days
FROM focus""")
def q_period_bounds(spark, root):
    f = focus(spark, root).select(F.to_date("ChargePeriodStart").alias("d"), "SubAccountId")
    return f.agg(F.min("d").alias("min_date"), F.max("d").alias("max_date"), F.count(F.lit(1)).alias("rows"),
                 F.count_distinct("SubAccountId").alias("distinct_SubAccountId"),
                 F.count_distinct("d").alias("distinct_days"))


@query("fiscal_year", _F + """
SELECT fiscal_year, min(ds) AS first_day, max(ds) AS last_day, count(*) AS days
FROM (SELECT DISTINCT CAST(ChargePeriodStart AS DATE) AS ds,
             CAST(year(ChargePeriodStart) + CASE WHEN month(ChargePeriodStart) >= 9 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year
      FROM focus) GROUP BY 1""")
def q_fiscal_year(spark, root):
    d = focus(spark, root).select(F.to_date("ChargePeriodStart").alias("ds")).distinct()
    return d.groupBy(fiscal_year("ds").alias("fiscal_year")).agg(
        F.min("ds").alias("first_day"), F.max("ds").alias("last_day"), F.count(F.lit(1)).alias("days"))
