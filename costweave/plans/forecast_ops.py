"""Forecast, backtest, accuracy, reconciliation and budget products over the
hierarchy series, each with DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..forecast import baseline as B
from ..forecast.reconcile import structural_weights, wls_tree
from ..functions.rules import HORIZON_BUCKETS
from ..functions.tags import LEVELS, with_hierarchy_cols
from ..operators import aggregate as A
from ..operators import windows as W
from ..operators.hierarchy import daily_by_key, hierarchy_bridge, hierarchy_series
from ..session import cut_lineage, scratch_path
from ..sources.fixtures import focus
from ..sources.store import TableStore
from . import oracle_adapters as O
from .registry import query

RUN_DATE = "2001-11-05"
BUCKET_SQL = "CASE " + " ".join(f"WHEN days_ahead BETWEEN {lo} AND {hi} THEN '{lab}'"
                                for lo, hi, lab in HORIZON_BUCKETS) + " END"
MODELS = [B.NAIVE, B.MEDIAN]


def _d(c):
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _hist(spark, root, cost_col="BilledCost"):
    """gold.forecast_input: every level's zero-filled daily series, written
    once (checkpoint) and read by every forecast step of the query, as the
    reference writes the actuals table before fitting."""
    return cut_lineage(hierarchy_series(focus(spark, root), cost_col=cost_col))


def _bridge(h):
    """(ancestor, leaf) links of the written series; the fact isn't read again."""
    leaves = h.filter(F.col("level") == "component").select(F.expr("substring(unique_id, 7)").alias("service_id"))
    return hierarchy_bridge(leaves)


def _forecasts(h):
    """Live forecasts of both baselines."""
    h = h.select("unique_id", "ds", "y")
    return B.seasonal_naive(h).unionByName(B.weekday_median(h))


def _two_models(spark, root):
    return _forecasts(_hist(spark, root))


_DEPTH = "length(unique_id) - length(replace(unique_id, '/', ''))"
_ANCESTORS = """unnest(['total', 'total/' || split_part(unique_id, '/', 2),
                     'total/' || split_part(unique_id, '/', 2) || '/' || split_part(unique_id, '/', 3),
                     'total/' || split_part(unique_id, '/', 2) || '/' || split_part(unique_id, '/', 3) || '/' || split_part(unique_id, '/', 4),
                     unique_id])"""
_MIDDLE = "(list_sort(list(y)))[(count(*) + 1) // 2]"
_SN_SQL = f"""
, hist AS MATERIALIZED (SELECT unique_id, ds, y FROM hier)
, last AS (SELECT unique_id, max(ds) AS cutoff FROM hist GROUP BY 1)
, tail AS (SELECT h.unique_id, h.ds, h.y, l.cutoff FROM hist h JOIN last l ON h.unique_id = l.unique_id
           WHERE h.ds > l.cutoff - 7 AND h.ds <= l.cutoff)
, sn AS (SELECT unique_id, CAST(cutoff + CAST(step AS INTEGER) AS DATE) AS ds, 'SeasonalNaive' AS model_id, y AS yhat
         FROM (SELECT *, unnest(range(date_diff('day', cutoff - 7, ds), {B.HORIZON_DAYS + 1}, 7)) AS step FROM tail))
, wmid AS (SELECT unique_id, cutoff, phase, {_MIDDLE} AS yhat
           FROM (SELECT h.unique_id, h.y, l.cutoff, (date_diff('day', l.cutoff - 63, h.ds) - 1) % 7 + 1 AS phase
                 FROM hist h JOIN last l ON h.unique_id = l.unique_id WHERE h.ds > l.cutoff - 63 AND h.ds <= l.cutoff) GROUP BY 1, 2, 3)
, wm AS (SELECT unique_id, CAST(cutoff + CAST(step AS INTEGER) AS DATE) AS ds, 'WeekdayMedian' AS model_id, yhat
         FROM (SELECT *, unnest(range(phase, {B.HORIZON_DAYS + 1}, 7)) AS step FROM wmid))
, fc AS (SELECT * FROM sn UNION ALL SELECT * FROM wm)
"""
_FC = O.with_ctes(*O.FLAGSHIP_CTES) + _SN_SQL


def _windows_sql(h: int, live: bool = False) -> str:
    """cuts and bt2: both baselines from each cutoff."""
    first = f"SELECT CAST((SELECT m FROM gmax) - CAST({B.BT_HORIZON_DAYS} + 28 * k AS INTEGER) AS DATE) AS cutoff FROM (SELECT unnest(range(0, {B.N_WINDOWS})) AS k)"
    return f"""
, gmax AS (SELECT max(ds) AS m FROM hist)
, cuts AS MATERIALIZED ({first}{" UNION ALL SELECT m FROM gmax" if live else ""})
, bt AS (SELECT unique_id, cutoff, CAST(cutoff + CAST(step AS INTEGER) AS DATE) AS ds, 'SeasonalNaive' AS model_id, y AS yhat
         FROM (SELECT h.unique_id, h.y, c.cutoff, unnest(range(date_diff('day', c.cutoff - 7, h.ds), {h + 1}, 7)) AS step
               FROM hist h JOIN cuts c ON h.ds > c.cutoff - 7 AND h.ds <= c.cutoff))
, bmid AS (SELECT unique_id, cutoff, phase, {_MIDDLE} AS yhat
           FROM (SELECT h.unique_id, h.y, c.cutoff, (date_diff('day', c.cutoff - 63, h.ds) - 1) % 7 + 1 AS phase
                 FROM hist h JOIN cuts c ON h.ds > c.cutoff - 63 AND h.ds <= c.cutoff) GROUP BY 1, 2, 3)
, btm AS (SELECT unique_id, cutoff, CAST(cutoff + CAST(step AS INTEGER) AS DATE) AS ds, 'WeekdayMedian' AS model_id, yhat
          FROM (SELECT *, unnest(range(phase, {h + 1}, 7)) AS step FROM bmid))
, bt2 AS MATERIALIZED (SELECT * FROM bt UNION ALL SELECT * FROM btm)
"""


def _cv_sql(table: str) -> str:
    return f"""
, cv AS (SELECT b.*, h.y, date_diff('day', b.cutoff, b.ds) AS days_ahead FROM {table} b
         LEFT JOIN hist h ON b.unique_id = h.unique_id AND b.ds = h.ds)
, cvl AS (SELECT *, {BUCKET_SQL} AS horizon_bucket,
                 CASE {_DEPTH} WHEN 0 THEN 'total' WHEN 1 THEN 'division'
                      WHEN 2 THEN 'platform' WHEN 3 THEN 'workload' ELSE 'component' END AS level FROM cv)
"""


_WINDOWS = _FC + _windows_sql(B.BT_HORIZON_DAYS)
_BT = _WINDOWS + _cv_sql("bt2")
_VARIANCE = f"greatest(coalesce(avg((y - fitted) * (y - fitted)), avg(y * y)), {B.LEAST_VARIANCE})"
_FIT_SQL = f"""
, ins AS MATERIALIZED (
    SELECT unique_id, ds, y, 'SeasonalNaive' AS model_id, lag(y, 7) OVER (PARTITION BY unique_id ORDER BY ds) AS fitted FROM hist
    UNION ALL SELECT unique_id, ds, y, 'WeekdayMedian', a[(len(a) + 1) // 2] FROM (
      SELECT unique_id, ds, y, list_sort(list_filter([{", ".join(f"lag(y, {7 * k}) OVER w" for k in range(1, B.MEDIAN_WEEKS + 1))}],
                                                     lambda x: x IS NOT NULL)) AS a
      FROM hist WINDOW w AS (PARTITION BY unique_id ORDER BY ds)))
, wvar AS (SELECT unique_id, model_id, {_VARIANCE} AS w FROM ins GROUP BY 1, 2)
"""
_FITC_SQL = _FIT_SQL + f"""
, wvarc AS MATERIALIZED (SELECT unique_id, model_id, cutoff, {_VARIANCE} AS w FROM ins JOIN cuts ON ds <= cutoff GROUP BY 1, 2, 3)
"""


def _wls_sql(p: str, base: str, weights: str, on: str, keys: str, nonnegative: bool = False) -> str:
    """The two tree passes as joins level by level; the result is ``{p}out`` (unique_id, keys, yhat)."""
    names = keys.split(", ")
    k = lambda t: ", ".join(f"{t}.{n}" for n in names)
    same = lambda a, b: " AND ".join(f"{a}.{n} = {b}.{n}" for n in names)
    sql = f"""
, {p}n AS MATERIALIZED (SELECT unique_id, {keys}, yhat, w, {_DEPTH} AS depth, regexp_extract(unique_id, '^(.*)/[^/]*$', 1) AS parent
                        FROM {base} JOIN {weights} USING ({on}))
, {p}u4 AS MATERIALIZED (SELECT unique_id, parent, {keys}, yhat AS est, w AS v FROM {p}n WHERE depth = 4)"""
    for d in range(3, -1, -1):
        sql += f"""
, {p}k{d} AS (SELECT parent, {keys}, sum(est) AS se, sum(v) AS sv FROM {p}u{d + 1} GROUP BY ALL)
, {p}u{d} AS MATERIALIZED (SELECT n.unique_id, n.parent, {k("n")},
     CASE WHEN sv IS NULL THEN yhat ELSE 1 / (1 / w + 1 / sv) * (yhat / w + se / sv) END AS est,
     CASE WHEN sv IS NULL THEN w ELSE 1 / (1 / w + 1 / sv) END AS v
   FROM {p}n n LEFT JOIN {p}k{d} k ON k.parent = n.unique_id AND {same("k", "n")} WHERE depth = {d})"""
    sql += f"\n, {p}f0 AS (SELECT unique_id, {keys}, est AS yhat FROM {p}u0)"
    for d in range(1, 5):
        sql += f"""
, {p}f{d} AS MATERIALIZED (SELECT u.unique_id, {k("u")}, est + v / sv * (f.yhat - se) AS yhat
   FROM {p}u{d} u JOIN {p}k{d - 1} s ON s.parent = u.parent AND {same("s", "u")}
   JOIN {p}f{d - 1} f ON f.unique_id = u.parent AND {same("f", "u")})"""
    if nonnegative:
        return sql + f"""
, {p}out AS MATERIALIZED (SELECT anc AS unique_id, {keys}, sum(yhat) AS yhat FROM (
     SELECT {_ANCESTORS} AS anc, {keys}, greatest(yhat, 0) AS yhat FROM {p}f4) GROUP BY ALL)"""
    return sql + f"\n, {p}out AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT unique_id, {keys}, yhat FROM {p}f{d}" for d in range(5)) + ")"


_LEAVES_SQL = f"""
, wleaf AS (SELECT anc AS unique_id, CAST(count(*) AS DOUBLE) AS w FROM (
     SELECT {_ANCESTORS} AS anc FROM (SELECT DISTINCT unique_id FROM hist WHERE {_DEPTH} = 4)) GROUP BY 1)"""


def _windows(h, horizon=B.BT_HORIZON_DAYS, cutoffs=None, n=B.N_WINDOWS):
    """Forecasts of both baselines from every cutoff, training on days up to it."""
    h = h.select("unique_id", "ds", "y")
    cut = B.backtest_cutoffs(h) if cutoffs is None else cutoffs
    rows = h.select("*", F.explode(cut).alias("cutoff"))
    naive = rows.filter((F.col("ds") > F.date_sub("cutoff", B.SEASON)) & (F.col("ds") <= F.col("cutoff")))
    step = F.explode(F.sequence(F.datediff("ds", F.date_sub("cutoff", B.SEASON)), F.lit(horizon), F.lit(B.SEASON)))
    naive = naive.select("unique_id", "cutoff", "y", step.alias("step")).select(
        "unique_id", "cutoff", F.date_add("cutoff", F.col("step")).alias("ds"), F.lit(B.NAIVE).alias("model_id"), F.col("y").alias("yhat"))
    return naive.unionByName(B.weekday_median_from(rows, horizon)), cut


def _scored(bt, h):
    return with_hierarchy_cols(B.attach_actuals(bt, h.select("unique_id", "ds", "y"))).drop(*LEVELS)


def _backtest(spark, root):
    h = _hist(spark, root)
    return _scored(_windows(h)[0], h)


def _reconciled_windows(h):
    """Base windows, and each window reconciled on its own residuals."""
    bt, cut = _windows(h)
    bt = cut_lineage(bt)
    weights = B.residual_variances(B.in_sample(h), cut)
    return bt, wls_tree(bt, weights, extra_keys=["cutoff"], nonnegative=True).select(*bt.columns)


@query("seasonal_naive", _FC + "SELECT unique_id, ds, model_id, yhat FROM sn")
def q_seasonal_naive(spark, root):
    return B.seasonal_naive(_hist(spark, root).select("unique_id", "ds", "y"))


@query("unpivot_models", _FC + """
SELECT unique_id, ds, model_id, yhat FROM (
  SELECT unique_id, ds, max(CASE WHEN model_id = 'SeasonalNaive' THEN yhat END) AS SeasonalNaive,
         max(CASE WHEN model_id = 'WeekdayMedian' THEN yhat END) AS WeekdayMedian FROM fc GROUP BY 1, 2)
UNPIVOT (yhat FOR model_id IN (SeasonalNaive, WeekdayMedian))""")
def q_unpivot_models(spark, root):
    """Wide model columns (one per model) -> long (model_id, yhat)."""
    fc = _two_models(spark, root)
    wide = fc.groupBy("unique_id", "ds").pivot("model_id", ["SeasonalNaive", "WeekdayMedian"]).agg(F.max("yhat"))
    return wide.unpivot(["unique_id", "ds"], ["SeasonalNaive", "WeekdayMedian"], "model_id", "yhat")


@query("bottom_up", _FC + """
SELECT anc AS unique_id, ds, model_id || '/BottomUp' AS model_id, CAST(sum(CAST(yhat AS DECIMAL(38,6))) AS DOUBLE) AS yhat
FROM (SELECT unnest(['total', 'total/' || split_part(unique_id, '/', 2),
                     'total/' || split_part(unique_id, '/', 2) || '/' || split_part(unique_id, '/', 3),
                     'total/' || split_part(unique_id, '/', 2) || '/' || split_part(unique_id, '/', 3) || '/' || split_part(unique_id, '/', 4),
                     unique_id]) AS anc, ds, model_id, yhat
      FROM sn WHERE length(unique_id) - length(replace(unique_id, '/', '')) = 4)
GROUP BY 1, 2, 3""")
def q_bottom_up(spark, root):
    h = _hist(spark, root)
    fc = B.seasonal_naive(h.select("unique_id", "ds", "y"))
    leaves = fc.filter(F.regexp_count("unique_id", F.lit("/")) == 4)
    bridge = _bridge(h)
    out = B.bottom_up(leaves.withColumn("yhat", F.col("yhat").cast("decimal(38,6)")), bridge)
    return out.withColumn("yhat", _d("yhat"))


@query("backtest_windows", _BT + """
SELECT c.cutoff, count(DISTINCT h.unique_id) AS series,
       count_if(h.ds <= c.cutoff) AS train_rows, count_if(h.ds > c.cutoff AND h.ds <= c.cutoff + 182) AS test_rows
FROM cuts c, hist h GROUP BY 1""".replace("FROM cuts c, hist h", "FROM cuts c JOIN hist h ON h.ds <= c.cutoff + 182"))
def q_backtest_windows(spark, root):
    """Per cutoff: series and train / test row counts (the split itself)."""
    h = _hist(spark, root).select("unique_id", "ds")
    rows = h.select("*", F.explode(B.backtest_cutoffs(h)).alias("cutoff"))
    rows = rows.filter(F.col("ds") <= F.date_add("cutoff", B.BT_HORIZON_DAYS))
    return rows.groupBy("cutoff").agg(F.count_distinct("unique_id").alias("series"),
                                      F.count_if(F.col("ds") <= F.col("cutoff")).alias("train_rows"),
                                      F.count_if(F.col("ds") > F.col("cutoff")).alias("test_rows"))


@query("backtest_actuals", _BT + "SELECT unique_id, cutoff, ds, model_id, yhat, y, days_ahead, horizon_bucket, level FROM cvl")
def q_backtest_actuals(spark, root):
    return _backtest(spark, root).select("unique_id", "cutoff", "ds", "model_id", "yhat", "y", "days_ahead",
                                         "horizon_bucket", "level")


_WAPE_SQL = """CASE WHEN sum(CAST(abs(y) AS DECIMAL(38,6))) <> 0 THEN
  CAST(sum(CAST(abs(yhat - y) AS DECIMAL(38,6))) AS DOUBLE) / CAST(sum(CAST(abs(y) AS DECIMAL(38,6))) AS DOUBLE) END"""


@query("wape", _BT + f"SELECT level, model_id, {_WAPE_SQL} AS wape FROM cvl GROUP BY 1, 2")
def q_wape(spark, root):
    return A.wape(_backtest(spark, root), ["level", "model_id"])


@query("wape_by_bucket", _BT + f"SELECT level, model_id, horizon_bucket, {_WAPE_SQL} AS wape FROM cvl GROUP BY 1, 2, 3")
def q_wape_by_bucket(spark, root):
    return A.wape(_backtest(spark, root), ["level", "model_id", "horizon_bucket"])


@query("mape_rmse", _BT + """
SELECT level, model_id,
       CAST(sum(CAST(CASE WHEN y <> 0 THEN abs(yhat - y) / abs(y) END AS DECIMAL(38,10))) AS DOUBLE)
         / count(CASE WHEN y <> 0 THEN 1 END) AS mape,
       sqrt(CAST(sum(CAST((yhat - y) * (yhat - y) AS DECIMAL(38,6))) AS DOUBLE) / count(*)) AS rmse
FROM cvl GROUP BY 1, 2""")
def q_mape_rmse(spark, root):
    return A.mape_rmse(_backtest(spark, root), ["level", "model_id"])


@query("pivot_metric", _BT + f"""
SELECT level, max(CASE WHEN model_id = 'SeasonalNaive' THEN wape END) AS SeasonalNaive,
       max(CASE WHEN model_id = 'WeekdayMedian' THEN wape END) AS WeekdayMedian
FROM (SELECT level, model_id, {_WAPE_SQL} AS wape FROM cvl GROUP BY 1, 2) GROUP BY 1""")
def q_pivot_metric(spark, root):
    w = A.wape(_backtest(spark, root), ["level", "model_id"])
    return w.groupBy("level").pivot("model_id", ["SeasonalNaive", "WeekdayMedian"]).agg(F.first("wape"))


@query("pivot_bucket", _BT + f"""
SELECT level, model_id, max(CASE WHEN horizon_bucket = '01-28d' THEN wape END) AS "01-28d",
       max(CASE WHEN horizon_bucket = '29-91d' THEN wape END) AS "29-91d", max(CASE WHEN horizon_bucket = '92-182d' THEN wape END) AS "92-182d"
FROM (SELECT level, model_id, horizon_bucket, {_WAPE_SQL} AS wape FROM cvl WHERE level IN ('total', 'division') GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def q_pivot_bucket(spark, root):
    """WAPE by horizon bucket as columns, for the total and the divisions."""
    cv = _backtest(spark, root).filter(F.col("level").isin("total", "division"))
    w = A.wape(cv, ["level", "model_id", "horizon_bucket"])
    return w.groupBy("level", "model_id").pivot("horizon_bucket", [b for _, _, b in HORIZON_BUCKETS]).agg(F.first("wape"))


@query("best_per_level", _BT + f"""
SELECT level, model_id, wape FROM (
  SELECT *, row_number() OVER (PARTITION BY level ORDER BY wape, model_id) AS rn
  FROM (SELECT level, model_id, {_WAPE_SQL} AS wape FROM cvl GROUP BY 1, 2) WHERE wape IS NOT NULL)
WHERE rn = 1""")
def q_best_per_level(spark, root):
    w = A.wape(_backtest(spark, root), ["level", "model_id"])
    return W.best_per_group(w, ["level"], "wape", "model_id")


_METRICS_SQL = f"""SELECT level, model_id, horizon_bucket,
  {_WAPE_SQL} AS wape,
  CAST(sum(CAST(CASE WHEN y <> 0 THEN abs(yhat - y) / abs(y) END AS DECIMAL(38,10))) AS DOUBLE) / count(CASE WHEN y <> 0 THEN 1 END) AS mape,
  sqrt(CAST(sum(CAST((yhat - y) * (yhat - y) AS DECIMAL(38,6))) AS DOUBLE) / count(y)) AS rmse
FROM cvl GROUP BY GROUPING SETS ((level, model_id), (level, model_id, horizon_bucket))
HAVING grouping(horizon_bucket) = 1 OR horizon_bucket IS NOT NULL"""


def _accuracy(spark, cv):
    """WAPE, MAPE and RMSE overall (null bucket) and by bucket in one grouping-sets
    pass, stamped with the run parameters, written by run date and read back."""
    m = A.accuracy(cv, ["level", "model_id"], "horizon_bucket").select("level", "model_id", "horizon_bucket", F.expr(
        "stack(3, 'wape', wape, 'mape', mape, 'rmse', rmse) AS (metric, value)"))
    m = m.select("level", "model_id", "metric", "horizon_bucket", "value", F.lit(B.BT_HORIZON_DAYS).alias("bt_horizon_days"),
                 F.lit(B.N_WINDOWS).alias("n_windows"), F.lit(B.STEP_SIZE_DAYS).alias("step_size_days"),
                 F.lit(RUN_DATE).cast("date").alias("run_date"))
    store = TableStore(spark, scratch_path(spark, "stores"))
    store.replace_run_date(m, "forecast_accuracy")
    return store.read("forecast_accuracy")


@query("accuracy_table", _WINDOWS + _FITC_SQL + _wls_sql("r", "bt2", "wvarc", "unique_id, model_id, cutoff", "cutoff, ds, model_id", True) + f"""
, bt3 AS (SELECT unique_id, cutoff, ds, model_id, yhat FROM bt2
          UNION ALL SELECT unique_id, cutoff, ds, model_id || '/WLS', yhat FROM rout
          UNION ALL SELECT anc, cutoff, ds, model_id || '/BottomUp', sum(yhat) FROM (
            SELECT {_ANCESTORS} AS anc, cutoff, ds, model_id, yhat FROM bt2 WHERE {_DEPTH} = 4) GROUP BY 1, 2, 3, 4)
""" + _cv_sql("bt3") + f"""
SELECT level, model_id, metric, horizon_bucket, value, {B.BT_HORIZON_DAYS} AS bt_horizon_days, {B.N_WINDOWS} AS n_windows,
       {B.STEP_SIZE_DAYS} AS step_size_days, DATE '{RUN_DATE}' AS run_date
FROM (SELECT level, model_id, horizon_bucket, unnest(['wape', 'mape', 'rmse']) AS metric, unnest([wape, mape, rmse]) AS value
      FROM ({_METRICS_SQL}))""")
def q_accuracy_table(spark, root):
    """gold.forecast_accuracy of the base models, bottom-up and WLS on each
    window's residuals, persisted by run_date."""
    h = _hist(spark, root)
    bt, wls = _reconciled_windows(h)
    leaves = bt.filter(F.regexp_count("unique_id", F.lit("/")) == 4)
    bottom_up = B.bottom_up(leaves, _bridge(h)).select(*bt.columns)
    return _accuracy(spark, _scored(bt.unionByName(wls).unionByName(bottom_up), h))


@query("coherence_gap", _FC + """
SELECT t.model_id, max(abs(t.yhat - c.s)) AS max_gap,
       CAST(sum(CAST(abs(t.yhat - c.s) AS DECIMAL(38,6))) AS DOUBLE) / count(*) AS mean_gap
FROM (SELECT model_id, ds, yhat FROM fc WHERE unique_id = 'total') t
JOIN (SELECT model_id, ds, CAST(sum(CAST(yhat AS DECIMAL(38,6))) AS DOUBLE) AS s FROM fc
      WHERE length(unique_id) - length(replace(unique_id, '/', '')) = 4 GROUP BY 1, 2) c
  ON t.model_id = c.model_id AND t.ds = c.ds GROUP BY 1""")
def q_coherence_gap(spark, root):
    """Per model: max and mean |total - sum of components| over days
    (inner join of total rows with component sums on model x day)."""
    fc = _two_models(spark, root)
    t = fc.filter(F.col("unique_id") == "total").select("model_id", "ds", "yhat")
    c = (fc.filter(F.regexp_count("unique_id", F.lit("/")) == 4).groupBy("model_id", "ds")
         .agg(_d(F.sum(F.col("yhat").cast("decimal(38,6)"))).alias("s")))
    gap = F.abs(F.col("yhat") - F.col("s"))
    return t.join(c, ["model_id", "ds"]).groupBy("model_id").agg(
        F.max(gap).alias("max_gap"), (_d(F.sum(gap.cast("decimal(38,6)"))) / F.count(F.lit(1))).alias("mean_gap"))


@query("mean_forecast", _FC + """
SELECT unique_id, model_id, CAST(sum(CAST(yhat AS DECIMAL(38,6))) AS DOUBLE) / count(*) AS mean_yhat FROM fc GROUP BY 1, 2""")
def q_mean_forecast(spark, root):
    fc = _two_models(spark, root)
    return fc.groupBy("unique_id", "model_id").agg(
        (_d(F.sum(F.col("yhat").cast("decimal(38,6)"))) / F.count(F.lit(1))).alias("mean_yhat"))


@query("unified_view", _FC + f"""
SELECT 'actual' AS record_type, unique_id, ds, y, CAST(NULL AS DOUBLE) AS yhat, CAST(NULL AS VARCHAR) AS model_id,
       level, division, platform, workload, component FROM hier
UNION ALL
SELECT 'forecast', f.unique_id, f.ds, CAST(NULL AS DOUBLE), f.yhat, f.model_id, n.level, n.division, n.platform,
       n.workload, n.component
FROM fc f JOIN (SELECT DISTINCT unique_id, level, division, platform, workload, component FROM hier) n
  ON f.unique_id = n.unique_id""")
def q_unified_view(spark, root):
    h = _hist(spark, root)
    fc = with_hierarchy_cols(_two_models(spark, root))
    a = h.select(F.lit("actual").alias("record_type"), "unique_id", "ds", "y", F.lit(None).cast("double").alias("yhat"),
                 F.lit(None).cast("string").alias("model_id"), "level", *LEVELS)
    f = fc.select(F.lit("forecast").alias("record_type"), "unique_id", "ds", F.lit(None).cast("double").alias("y"),
                  "yhat", "model_id", "level", *LEVELS)
    return a.unionByName(f)


@query("unified_view_account", O.with_ctes(("focus", O.FOCUS)) + f"""
, acc AS (SELECT SubAccountId AS subscription_id, CAST(ChargePeriodStart AS DATE) AS ds, CAST(sum(BilledCost) AS DOUBLE) AS y
          FROM focus GROUP BY 1, 2)
, last AS (SELECT subscription_id, max(ds) AS cutoff FROM acc GROUP BY 1)
, tail AS (SELECT a.*, l.cutoff FROM acc a JOIN last l ON a.subscription_id = l.subscription_id
           WHERE a.ds > l.cutoff - 7 AND a.ds <= l.cutoff)
SELECT 'actual' AS record_type, subscription_id, ds AS date, y AS cost, CAST(NULL AS VARCHAR) AS model_id FROM acc
UNION ALL
SELECT 'forecast', subscription_id, CAST(cutoff + CAST(step AS INTEGER) AS DATE), y, 'SeasonalNaive'
FROM (SELECT *, unnest(range(date_diff('day', cutoff - 7, ds), {B.HORIZON_DAYS + 1}, 7)) AS step FROM tail)""")
def q_unified_view_account(spark, root):
    """Subscription version (no zero fill, as the account path has none);
    ordered by subscription_id, date."""
    acc = daily_by_key(focus(spark, root), "SubAccountId", key_name="subscription_id") \
        .withColumn("y", _d("y"))
    fc = B.seasonal_naive(acc, key="subscription_id")
    a = acc.select(F.lit("actual").alias("record_type"), "subscription_id", F.col("ds").alias("date"),
                   F.col("y").alias("cost"), F.lit(None).cast("string").alias("model_id"))
    f = fc.select(F.lit("forecast").alias("record_type"), "subscription_id", F.col("ds").alias("date"),
                  F.col("yhat").alias("cost"), "model_id")
    return a.unionByName(f).orderBy("subscription_id", "date")


# ------------------------------------------------------------------ budgets
# Budgets are kept on EffectiveCost: history, forecasts, targets and actuals alike.
_EFFECTIVE_CTES = [(n, body.replace("sum(BilledCost)", "sum(EffectiveCost)") if n == "daily" else body) for n, body in O.FLAGSHIP_CTES]
_BUDGET_SQL = (O.with_ctes(*_EFFECTIVE_CTES) + "\n, hist AS MATERIALIZED (SELECT unique_id, ds, y FROM hier)" +
               _windows_sql(B.HORIZON_DAYS, live=True) + _FITC_SQL +
               "\n, med AS (SELECT * FROM bt2 WHERE model_id = 'WeekdayMedian')" +
               _wls_sql("g", "med", "wvarc", "unique_id, model_id, cutoff", "cutoff, ds, model_id", True) + f"""
, plan AS MATERIALIZED (
    SELECT unique_id, cutoff AS version, CAST(date_trunc('month', ds) AS DATE) AS month, sum(CAST(round(yhat, 4) AS DECIMAL(38,4))) AS amount
    FROM gout GROUP BY 1, 2, 3
    HAVING CAST(date_trunc('month', min(ds)) AS DATE) > cutoff AND last_day(min(ds)) <= cutoff + {B.HORIZON_DAYS})
, target AS MATERIALIZED (SELECT unique_id, month, max(version) AS version, max_by(amount, version) AS budget
            FROM plan WHERE version < (SELECT m FROM gmax) GROUP BY 1, 2)
, actual AS MATERIALIZED (SELECT unique_id, CAST(date_trunc('month', ds) AS DATE) AS month, sum(CAST(y AS DECIMAL(38,4))) AS actual
            FROM hist GROUP BY 1, 2)
, rolling AS MATERIALIZED (SELECT unique_id, month, amount AS forecast FROM plan WHERE version = (SELECT m FROM gmax))
""")


def _plans(spark, root):
    """(written history, month amounts of each version).  A version is the reconciled
    forecast of the weekday median from one cutoff, each on its own residuals; the
    newest one, from the last day, is the rolling forecast, the others are frozen
    and serve as targets.  Only whole months count."""
    h = _hist(spark, root, "EffectiveCost")
    s = h.select("unique_id", "ds", "y")
    last = s.agg(F.max("ds")).scalar()
    cut = F.array(*[F.date_sub(last, B.BT_HORIZON_DAYS + k * B.STEP_SIZE_DAYS) for k in range(B.N_WINDOWS)], last)
    n = B.N_WINDOWS + 1
    fc = B.weekday_median_from(s.select("*", F.explode(cut).alias("cutoff")), B.HORIZON_DAYS)
    weights = B.residual_variances(B.in_sample(s), cut, n)
    rec = wls_tree(fc, weights, extra_keys=["cutoff"], nonnegative=True)
    month = F.to_date(F.date_trunc("month", "ds"))
    plan = rec.groupBy("unique_id", F.col("cutoff").alias("version"), month.alias("month")).agg(
        F.sum(F.round("yhat", 4).cast("decimal(38,4)")).alias("amount"))
    whole = (F.col("month") > F.col("version")) & (F.last_day("month") <= F.date_add("version", B.HORIZON_DAYS))
    return h, cut_lineage(plan.filter(whole).withColumn("live", F.col("version") == last))


def _targets(plan):
    """The target in force for a month: the newest frozen version that covers it."""
    return plan.filter(~F.col("live")).groupBy("unique_id", "month").agg(
        F.max("version").alias("version"), F.max_by("amount", "version").alias("budget"))


def _monthly_actuals(h):
    return h.groupBy("unique_id", F.to_date(F.date_trunc("month", "ds")).alias("month")).agg(
        F.sum(F.col("y").cast("decimal(38,4)")).alias("actual"))


def _money(c):
    return _d(F.round(c, 2))


@query("budget_targets", _BUDGET_SQL + """
SELECT unique_id, month, version, CAST(round(amount, 2) AS DOUBLE) AS budget FROM plan WHERE version < (SELECT m FROM gmax)""")
def q_budget_targets(spark, root):
    """Monthly amounts per node and version, seeded from the reconciled forecast."""
    _, plan = _plans(spark, root)
    return plan.filter(~F.col("live")).select("unique_id", "month", "version", _money("amount").alias("budget"))


@query("budget_variance", _BUDGET_SQL + """
SELECT unique_id, month, version, CAST(round(actual, 2) AS DOUBLE) AS actual, CAST(round(budget, 2) AS DOUBLE) AS budget,
       CAST(round(actual, 2) - round(budget, 2) AS DOUBLE) AS variance,
       CASE WHEN round(budget, 2) <> 0 THEN round(CAST(round(actual, 2) - round(budget, 2) AS DOUBLE) * 100 / CAST(round(budget, 2) AS DOUBLE), 2) END AS variance_pct
FROM target JOIN actual USING (unique_id, month)""")
def q_budget_variance(spark, root):
    """actual - budget and percent (round 2, null for a zero budget) of every month that has both."""
    h, plan = _plans(spark, root)
    j = _targets(plan).join(_monthly_actuals(h), ["unique_id", "month"])
    j = j.select("unique_id", "month", "version", F.round("actual", 2).alias("a"), F.round("budget", 2).alias("b"))
    v = F.col("a") - F.col("b")
    return j.select("unique_id", "month", "version", _d("a").alias("actual"), _d("b").alias("budget"), _d(v).alias("variance"),
                    F.when(F.col("b") != 0, F.round(_d(v) * 100 / _d("b"), 2)).alias("variance_pct"))


@query("budget_vs_forecast", _BUDGET_SQL + """
SELECT unique_id, month, t.version AS budget_version, CAST(round(budget, 2) AS DOUBLE) AS budget,
       CAST(round(actual, 2) AS DOUBLE) AS actual, CAST(round(forecast, 2) AS DOUBLE) AS forecast,
       round(actual, 2) > round(budget, 2) AS breach, round(forecast, 2) > round(budget, 2) AS predicted_breach
FROM target t FULL OUTER JOIN actual USING (unique_id, month) FULL OUTER JOIN rolling USING (unique_id, month)""")
def q_budget_vs_forecast(spark, root):
    """Node x month: target in force, EffectiveCost actual and rolling forecast;
    a node or month that only one side has stays, with nulls for the others."""
    h, plan = _plans(spark, root)
    rolling = plan.filter("live").select("unique_id", "month", F.col("amount").alias("forecast"))
    j = (_targets(plan).join(_monthly_actuals(h), ["unique_id", "month"], "full_outer")
         .join(rolling, ["unique_id", "month"], "full_outer"))
    r = lambda c: F.round(c, 2)
    return j.select("unique_id", "month", F.col("version").alias("budget_version"), _money("budget").alias("budget"),
                    _money("actual").alias("actual"), _money("forecast").alias("forecast"),
                    (r("actual") > r("budget")).alias("breach"), (r("forecast") > r("budget")).alias("predicted_breach"))


# ------------------------------------------------------------------ anomalies
ANOMALY_DAYS, ANOMALY_SCORE, ANOMALY_HIGH = 28, 3.5, 7.0


@query("cost_anomalies", O.with_ctes(*O.FLAGSHIP_CTES) + f"""
, f AS (SELECT unique_id, level, ds, y, list_sort(list(y) OVER w) AS a
        FROM hier WINDOW w AS (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN {ANOMALY_DAYS} PRECEDING AND 1 PRECEDING))
, m AS (SELECT *, (a[14] + a[15]) / 2 AS median_28 FROM f WHERE len(a) = {ANOMALY_DAYS})
, v AS (SELECT *, list_sort(list_transform(a, lambda x: abs(x - median_28))) AS dev FROM m)
, s AS (SELECT *, (dev[14] + dev[15]) / 2 AS mad, list_sum(dev) / {ANOMALY_DAYS} AS mean_dev FROM v)
, z AS (SELECT *, CASE WHEN mad > 0 THEN 'mad' WHEN mean_dev > 0 THEN 'mean' ELSE 'flat' END AS basis,
               CASE WHEN mad > 0 THEN 1.4826 * mad WHEN mean_dev > 0 THEN 1.2533 * mean_dev END AS spread FROM s)
SELECT unique_id, level, ds, y, median_28, basis, spread, (y - median_28) / spread AS anomaly_score, y - median_28 AS impact,
       CASE WHEN spread IS NULL OR abs((y - median_28) / spread) > {ANOMALY_HIGH} THEN 'high' ELSE 'medium' END AS severity
FROM z WHERE CASE WHEN spread IS NULL THEN y <> median_28 ELSE abs((y - median_28) / spread) > {ANOMALY_SCORE} END""")
def q_cost_anomalies(spark, root):
    """Daily anomaly score of every node of all five levels."""
    return A.anomalies(_hist(spark, root).select("unique_id", "level", "ds", "y"), ["unique_id"], ["level"], ANOMALY_DAYS,
                       ANOMALY_SCORE, ANOMALY_HIGH)


# ------------------------------------------------------------------ reconciliation
# Base forecasts have four decimals, and a reconciled one can equal its base but for rounding:
# the shift keeps exact halves of a cent off the edge, where the last bit would decide.
OFF_EDGE = 0.00003


def _cents(df):
    return df.withColumn("yhat", F.round(F.col("yhat") + OFF_EDGE, 2))


@query("wls_reconcile", _FC + _LEAVES_SQL + _wls_sql("r", "fc", "wleaf", "unique_id", "ds, model_id") + """
SELECT unique_id, ds, model_id || '/WLS' AS model_id, round(yhat + 0.00003, 2) AS yhat FROM rout""")
def q_wls_reconcile(spark, root):
    """Base forecasts of all levels reconciled by structural WLS on the tree."""
    h = _hist(spark, root)
    return _cents(wls_tree(_forecasts(h), structural_weights(_bridge(h))))


@query("wls_var", _FC + _FIT_SQL + _wls_sql("r", "fc", "wvar", "unique_id, model_id", "ds, model_id", True) + """
SELECT unique_id, ds, model_id || '/WLS' AS model_id, round(yhat + 0.00003, 2) AS yhat FROM rout""")
def q_wls_var(spark, root):
    """min_trace(wls_var), non-negative: weights are each node's own residual variance."""
    h = _hist(spark, root)
    return _cents(wls_tree(_forecasts(h), B.residual_variances(B.in_sample(h)), nonnegative=True))


@query("reconcile_windows", _WINDOWS + _FITC_SQL + _wls_sql("r", "bt2", "wvarc", "unique_id, model_id, cutoff", "cutoff, ds, model_id", True) + """
, bt3 AS (SELECT * FROM bt2 UNION ALL SELECT unique_id, cutoff, ds, model_id || '/WLS', yhat FROM rout)
""" + _cv_sql("bt3") + f"SELECT cutoff, level, model_id, {_WAPE_SQL} AS wape FROM cvl GROUP BY 1, 2, 3")
def q_reconcile_windows(spark, root):
    """Every cutoff reconciled on the residuals of its own training days, scored
    next to the base forecasts."""
    h = _hist(spark, root)
    bt, rec = _reconciled_windows(h)
    return A.wape(_scored(bt.unionByName(rec), h), ["cutoff", "level", "model_id"])


COHERENT_WITHIN = 1e-6          # of the largest total


@query("coherence_gate", _FC + _FIT_SQL + _wls_sql("r", "fc", "wvar", "unique_id, model_id", "ds, model_id", True) + f"""
, allfc AS (SELECT unique_id, ds, model_id, yhat FROM fc UNION ALL SELECT unique_id, ds, model_id || '/WLS', yhat FROM rout)
SELECT model_id, round(max(abs(t.yhat - c.s)), 2) AS max_gap,
       max(abs(t.yhat - c.s)) <= {COHERENT_WITHIN} * greatest(1.0, max(abs(t.yhat))) AS coherent,
       NOT (max(abs(t.yhat - c.s)) <= {COHERENT_WITHIN} * greatest(1.0, max(abs(t.yhat)))) AND model_id LIKE '%/%' AS failed
FROM (SELECT model_id, ds, yhat FROM allfc WHERE unique_id = 'total') t
JOIN (SELECT model_id, ds, sum(yhat) AS s FROM allfc WHERE {_DEPTH} = 4 GROUP BY 1, 2) c USING (model_id, ds) GROUP BY 1""")
def q_coherence_gate(spark, root):
    """Largest gap of total and components by model: a base forecast may have one, a
    reconciled one (``/WLS``) fails by it."""
    h = _hist(spark, root)
    base = cut_lineage(_forecasts(h))
    rec = wls_tree(base, B.residual_variances(B.in_sample(h)), nonnegative=True)
    fc = base.unionByName(rec.select(*base.columns))
    # one aggregate: the total and the sum of components of a day are two conditional sums
    day = fc.groupBy("model_id", "ds").agg(
        F.sum(F.when(F.col("unique_id") == "total", F.col("yhat"))).alias("total"),
        F.sum(F.when(F.regexp_count("unique_id", F.lit("/")) == 4, F.col("yhat"))).alias("parts"))
    gap = F.max(F.abs(F.col("total") - F.col("parts")))
    g = day.groupBy("model_id").agg(gap.alias("gap"), F.max(F.abs("total")).alias("size"))
    coherent = F.col("gap") <= COHERENT_WITHIN * F.greatest(F.lit(1.0), F.col("size"))
    return g.select("model_id", F.round("gap", 2).alias("max_gap"), coherent.alias("coherent"),
                    (~coherent & F.col("model_id").contains("/")).alias("failed"))


# ------------------------------------------------------------------ change points
DETECTED_AT = "2001-11-05 06:00:00"


def _stamp_detection(df):
    from ..forecast.changepoint import MIN_SIZE, PENALTY
    out = with_hierarchy_cols(df)
    return out.withColumns({"detected_at": F.lit(DETECTED_AT).cast("timestamp_ntz"),
                            "penalty": F.lit(PENALTY), "min_segment_days": F.lit(MIN_SIZE)})


@query("changepoints")
def q_changepoints(spark, root):
    """gold.forecast_changepoints: PELT change points on every hierarchy
    series, classified, with level / path columns and the run parameters."""
    from ..forecast.changepoint import classify_changes, segments
    return _stamp_detection(classify_changes(segments(_hist(spark, root))))


@query("segments")
def q_segments(spark, root):
    """gold.forecast_segments (skipped series keep one row with the reason)."""
    from ..forecast.changepoint import segments
    return _stamp_detection(segments(_hist(spark, root)))


# Breakpoints by the calendar (first day of a series, then every fiscal quarter): the
# operators after detection, on breaks that SQL can make too.
_SEG_SQL = O.with_ctes(*O.FLAGSHIP_CTES) + """
, first AS (SELECT unique_id, min(ds) AS f, max(ds) AS l FROM hier GROUP BY 1)
, brk AS (SELECT unique_id, f AS s FROM first UNION SELECT unique_id, CAST(unnest(generate_series(
            CAST(date_trunc('quarter', f - INTERVAL 2 MONTH) AS DATE) + INTERVAL 5 MONTH, l::TIMESTAMP, INTERVAL 3 MONTH)) AS DATE) FROM first)
, rng AS (SELECT unique_id, s, lead(s) OVER (PARTITION BY unique_id ORDER BY s) AS n FROM brk)
, seg AS (SELECT r.unique_id, r.s AS segment_start, max(h.ds) AS segment_end, CAST(count(*) AS INTEGER) AS segment_days,
                 CAST(sum(CAST(h.y AS DECIMAL(38,6))) AS DOUBLE) / count(*) AS daily_mean_cost
          FROM rng r JOIN hier h ON h.unique_id = r.unique_id AND h.ds >= r.s AND (r.n IS NULL OR h.ds < r.n) GROUP BY 1, 2)
, pair AS (SELECT unique_id, segment_start AS changepoint_date, lag(daily_mean_cost) OVER (PARTITION BY unique_id ORDER BY segment_start) AS b,
                  daily_mean_cost AS a FROM seg)
, chg AS (SELECT unique_id, changepoint_date, b AS before_daily_mean, a AS after_daily_mean, abs(a - b) AS abs_change,
                 CASE WHEN b <> 0 THEN (a - b) / b END AS pct_change,
                 CASE WHEN a < b * 0.05 THEN 'shutdown' WHEN b < a * 0.05 THEN 'launch' WHEN a > b THEN 'increase' ELSE 'decrease' END AS change_type
          FROM pair WHERE b IS NOT NULL)
"""


def _quarter_segments(h):
    """Fiscal quarters start in March, June, September and December."""
    from ..forecast.changepoint import segments_at
    span = h.groupBy("unique_id").agg(F.min("ds").alias("f"), F.max("ds").alias("l"))
    quarter = F.to_date(F.add_months(F.date_trunc("quarter", F.add_months("f", -2)), 5))
    later = F.when(quarter <= F.col("l"), F.sequence(quarter, F.col("l"), F.expr("INTERVAL 3 MONTHS"))).otherwise(F.array().cast("array<date>"))
    starts = F.array_distinct(F.concat(F.array("f"), later))
    return segments_at(h.select("unique_id", "ds", "y"), span.select("unique_id", F.explode(starts).alias("segment_start")))


@query("segment_means", _SEG_SQL + "SELECT * FROM seg")
def q_segment_means(spark, root):
    """Segments between given breakpoints: start, inclusive end, days, mean of the raw cost."""
    return _quarter_segments(_hist(spark, root))


@query("classify_changes", _SEG_SQL + "SELECT * FROM chg")
def q_classify_changes(spark, root):
    """Neighbouring segments paired: change, ratio and lifecycle class."""
    from ..forecast.changepoint import classify_changes
    return classify_changes(_quarter_segments(_hist(spark, root)).withColumn("skip_reason", F.lit(None).cast("string")))


@query("top_movers", _SEG_SQL + "SELECT * FROM chg ORDER BY abs_change DESC, unique_id, changepoint_date LIMIT 20")
def q_top_movers(spark, root):
    """The twenty largest changes between segments."""
    from ..forecast.changepoint import classify_changes, top_movers
    return top_movers(classify_changes(_quarter_segments(_hist(spark, root)).withColumn("skip_reason", F.lit(None).cast("string"))))


@query("changepoint_movers")
def q_changepoint_movers(spark, root):
    """The twenty largest changes at detected change points."""
    from ..forecast.changepoint import classify_changes, segments, top_movers
    return top_movers(classify_changes(segments(_hist(spark, root))))


# ------------------------------------------------------------------ MSTL + ARIMA (rows-checked)
@query("mstl_decompose")
def q_mstl_decompose(spark, root):
    """Trend + weekly + yearly seasonal + remainder of every hierarchy series
    (yearly only where two full years exist)."""
    from ..forecast.mstl_forecast import components
    return components(_hist(spark, root), periods=(7, 365))


def _mstl(spark, root, h=B.HORIZON_DAYS):
    from ..forecast.mstl_forecast import mstl_arima
    return mstl_arima(_hist(spark, root).select("unique_id", "ds", "y"), h)


@query("mstl_forecast")
def q_mstl_forecast(spark, root):
    """365-day MSTL forecasts: ARIMA (order by AICc) on the seasonally
    adjusted series plus the last weekly season repeated."""
    fc, _ = _mstl(spark, root)
    return fc.drop("cutoff")


@query("fitted_values")
def q_fitted_values(spark, root):
    _, fit = _mstl(spark, root)
    h = _hist(spark, root).select("unique_id", "ds", "y")
    return fit.drop("cutoff").join(h, ["unique_id", "ds"]).withColumn("residual", F.col("y") - F.col("fitted"))


@query("mstl_backtest_accuracy")
def q_mstl_backtest_accuracy(spark, root):
    """Walk-forward MSTL backtest (6 cutoffs x 182 days, training up to each
    cutoff only), reconciled on each window's own residuals and bottom-up, next to
    seasonal naive: the accuracy table of the fitted models."""
    from ..forecast.mstl_forecast import mstl_arima
    full = _hist(spark, root)
    h = full.select("unique_id", "ds", "y")
    cut = B.backtest_cutoffs(h)
    fc, fit = mstl_arima(h, B.BT_HORIZON_DAYS, cutoffs=cut)
    fc = cut_lineage(fc.select("unique_id", "cutoff", "ds", "model_id", "yhat"))
    weights = _residual_weights(fit, h, ["cutoff"])
    rec = wls_tree(fc, weights, extra_keys=["cutoff"], nonnegative=True).select(*fc.columns)
    bottom_up = B.bottom_up(fc.filter(F.regexp_count("unique_id", F.lit("/")) == 4), _bridge(full)).select(*fc.columns)
    return _accuracy(spark, _scored(fc.unionByName(rec).unionByName(bottom_up).unionByName(B.backtest_seasonal_naive(h)), full))


def _residual_weights(fit, h, keys):
    """Mean squared in-sample residual of each fitted series (and cutoff)."""
    e = F.col("y") - F.col("fitted")
    # outer from the history: a series without a fitted day keeps a weight, from its values
    rows = h.join(fit.select("unique_id", *keys, "ds", "fitted"), ["unique_id", "ds"], "left") if not keys else \
        fit.select("unique_id", *keys, "ds", "fitted").join(h, ["unique_id", "ds"])
    w = F.greatest(F.coalesce(F.avg(e * e), F.avg(F.col("y") * F.col("y"))), F.lit(B.LEAST_VARIANCE))
    return rows.groupBy("unique_id", *keys).agg(w.alias("w"))


@query("mstl_reconciled")
def q_mstl_reconciled(spark, root):
    """MSTL base forecasts of all levels reconciled by wls_var on the tree, non-negative."""
    h = _hist(spark, root)
    s = h.select("unique_id", "ds", "y")
    from ..forecast.mstl_forecast import mstl_arima
    fc, fit = mstl_arima(s, B.HORIZON_DAYS)
    return wls_tree(fc.select("unique_id", "ds", "model_id", "yhat"), _residual_weights(fit, s, []), nonnegative=True)


@query("mint_shrink")
def q_mint_shrink(spark, root):
    """MSTL forecasts reconciled by MinT with a shrunk covariance of the
    in-sample residuals (training data only)."""
    from ..forecast.mint import apply_mint, mint_weights, residual_gram
    from ..forecast.mstl_forecast import mstl_arima
    h = _hist(spark, root)
    fc, fit = mstl_arima(h.select("unique_id", "ds", "y"), B.HORIZON_DAYS)
    resid = fit.join(h.select("unique_id", "ds", "y"), ["unique_id", "ds"]).select(
        "unique_id", "ds", (F.col("y") - F.col("fitted")).alias("residual"))
    bridge = _bridge(h)
    weights = cut_lineage(mint_weights(residual_gram(resid), bridge))
    return apply_mint(fc.select("unique_id", "ds", "model_id", "yhat"), weights, bridge)
