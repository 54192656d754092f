"""Grouped aggregations.

All of these are plain ``groupBy().agg()`` plans: Spark runs a partial
(map-side) aggregate before the shuffle, so a hot key costs one partial
row per task, not one task holding a third of the data.  Money columns
are summed as decimals (exact, order-independent) and cast to double at
the very end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _dbl(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def count_by(df: DataFrame, *keys: str, name: str = "count", top: int | None = None) -> DataFrame:
    """Group count, count descending with key tie-break, optional top-n."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    out = out.orderBy(F.col(name).desc(), *[F.col(k).asc_nulls_first() for k in keys])
    return out.limit(top) if top else out


def count_sum_by(df: DataFrame, keys: list[str], value: str, digits: int | None = 4,
                 count_name: str = "records", sum_name: str = "total") -> DataFrame:
    s = F.sum(F.col(value).cast("decimal(38,6)"))
    s = F.round(s, digits) if digits is not None else s
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name), _dbl(s).alias(sum_name))


def distinct_stats(df: DataFrame, key: str, distinct_cols: list[str], value: str | None = None,
                   approx: bool = False) -> DataFrame:
    """Rows and exact distinct counts per key (``approx`` -> HLL sketch).  Several exact
    distinct counts copy every row once for each of them, so rows are first
    reduced to the combinations that occur."""
    total = [_dbl(F.sum("_value")).alias(f"total_{value}")] if value else []
    if approx:
        rows, n = df.withColumn("_value", F.col(value).cast("decimal(38,6)")) if value else df, F.count(F.lit(1))
        counts = [F.approx_count_distinct(c).alias(f"distinct_{c}") for c in distinct_cols]
    else:
        sums = [F.sum(F.col(value).cast("decimal(38,6)")).alias("_value")] if value else []
        rows, n = df.groupBy(key, *distinct_cols).agg(F.count(F.lit(1)).alias("_rows"), *sums), F.sum("_rows")
        counts = [F.count_distinct(c).alias(f"distinct_{c}") for c in distinct_cols]
    return rows.groupBy(key).agg(n.alias("rows"), *counts, *total)


def coverage_stats(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias(f"first_{ts}"),
                                 F.max(ts).alias(f"last_{ts}"), _dbl(F.sum(value)).alias(f"total_{value}"))


def category_share(df: DataFrame, key: str) -> DataFrame:
    """Count and percent of all (non-null) rows per category, rounded to 1.

    Aggregates first, then takes the grand total over the few category rows
    (a scalar subquery), so no unpartitioned window over raw rows."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(key, "count", F.round(F.col("count") * 100.0 / total, 1).alias("percent"))


def grain_reconcile(df: DataFrame, key: str = "subscription_uuid", grain: str = "grain",
                    value: str = "cost_value", tol: float = 0.01) -> DataFrame:
    """Sum by key x grain, pivot the two grains, unattributed = subscription -
    environment (nulls as 0), flagged when |gap| > tol.  Conditional sums
    stand in for a pivot so the column set is fixed."""
    s = df.groupBy(key).agg(
        F.sum(F.when(F.col(grain) == "subscription", F.col(value))).alias("subscription"),
        F.sum(F.when(F.col(grain) == "environment", F.col(value))).alias("environment"))
    gap = F.coalesce("subscription", F.lit(0)) - F.coalesce("environment", F.lit(0))
    return s.select(key, _dbl("subscription").alias("subscription"), _dbl("environment").alias("environment"),
                    _dbl(gap).alias("unattributed"), (F.abs(gap) > tol).alias("flagged"))


def _exact(c, scale=6) -> Column:
    """Per-row double -> decimal so that sums are exact and order-free."""
    return c.cast(f"decimal(38,{scale})")


def wape(df: DataFrame, keys: list[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """sum|yhat - y| / sum|y|; null when every actual is zero."""
    num = F.sum(_exact(F.abs(F.col(yhat) - F.col(y)))).cast("double")
    den = F.sum(_exact(F.abs(F.col(y)))).cast("double")
    return df.groupBy(*keys).agg(F.when(den != 0, num / den).alias("wape"))


def mape_rmse(df: DataFrame, keys: list[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Pooled MAPE (rows with zero actuals are skipped) and RMSE."""
    err = F.col(yhat) - F.col(y)
    ape = F.try_divide(F.abs(err), F.abs(F.col(y)))
    return df.groupBy(*keys).agg(
        (F.sum(_exact(ape, 10)).cast("double") / F.count(ape)).alias("mape"),
        F.sqrt(F.sum(_exact(err * err)).cast("double") / F.count(F.lit(1))).alias("rmse"))


def accuracy(df: DataFrame, keys: list[str], bucket: str, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """WAPE, MAPE and RMSE by keys (null bucket) and by keys and bucket; rows without an
    actual don't count, nor a null bucket.  Rows are summed once by keys and bucket; the
    grouping sets run over those few sums, so no row is copied for the overall figures."""
    err = F.col(yhat) - F.col(y)
    ape = F.try_divide(F.abs(err), F.abs(F.col(y)))
    sums = df.groupBy(*keys, bucket).agg(
        F.sum(_exact(F.abs(err))).alias("_e"), F.sum(_exact(F.abs(F.col(y)))).alias("_y"), F.sum(_exact(ape, 10)).alias("_a"),
        F.count(ape).alias("_na"), F.sum(_exact(err * err)).alias("_q"), F.count(err).alias("_n"))
    total = lambda c: F.sum(c).cast("double")
    g = sums.groupingSets([keys, [*keys, bucket]], *keys, bucket).agg(
        F.when(total("_y") != 0, total("_e") / total("_y")).alias("wape"), F.try_divide(total("_a"), F.sum("_na")).alias("mape"),
        F.sqrt(F.try_divide(total("_q"), F.sum("_n"))).alias("rmse"), F.grouping(bucket).alias("_overall"))
    return g.filter((F.col("_overall") == 1) | F.col(bucket).isNotNull()).drop("_overall")


def anomalies(series: DataFrame, keys: list[str], carry: list[str], days: int = 28, least: float = 3.5, high: float = 7.0,
              ds: str = "ds", y: str = "y") -> DataFrame:
    """Days that stand out from the ``days`` before (an even number; days with a shorter past aren't judged).

    Robust score: distance to the median over 1.4826 times the median absolute
    deviation; where more than half of the past days are equal (that deviation is zero) over 1.2533 times the
    mean absolute deviation; where all are equal any other value is an anomaly, with a
    null score and severity high.  ``basis`` says which (mad, mean, flat)."""
    past = Window.partitionBy(*keys).orderBy(ds).rowsBetween(-days, -1)
    half = days // 2
    mid = lambda a: (F.get(a, half - 1) + F.get(a, half)) / 2
    once = lambda df, *cols: df.select(*keys, *carry, ds, y, F.explode(F.array(F.struct(*cols))).alias("_v")).select(
        *keys, *carry, ds, y, "_v.*")           # a generator keeps the optimizer from repeating an expression where it is used
    f = once(series.withColumn("_a", F.collect_list(y).over(past)).filter(F.size("_a") == days), F.sort_array("_a").alias("_a"))
    f = once(f, F.col("_a"), mid(F.col("_a")).alias(f"median_{days}"))
    f = once(f, F.col(f"median_{days}"), F.sort_array(F.transform("_a", lambda x: F.abs(x - F.col(f"median_{days}")))).alias("_dev"))
    mean = F.aggregate("_dev", F.lit(0.0), lambda s, x: s + x) / days
    f = once(f, F.col(f"median_{days}"), mid(F.col("_dev")).alias("_mad"), mean.alias("_mean"))
    f = f.withColumns({"basis": F.when(F.col("_mad") > 0, "mad").when(F.col("_mean") > 0, "mean").otherwise("flat"),
                       "spread": F.when(F.col("_mad") > 0, 1.4826 * F.col("_mad")).when(F.col("_mean") > 0, 1.2533 * F.col("_mean"))})
    impact = F.col(y) - F.col(f"median_{days}")
    f = f.withColumns({"anomaly_score": impact / F.col("spread"), "impact": impact})
    flat = F.col("spread").isNull()
    f = f.filter(F.when(flat, F.col("impact") != 0).otherwise(F.abs("anomaly_score") > least))
    return f.drop("_mad", "_mean").withColumn("severity", F.when(flat | (F.abs("anomaly_score") > high), "high").otherwise("medium"))


def period_bounds(df: DataFrame, date_col: str, distinct_cols: list[str]) -> DataFrame:
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                  F.count(F.lit(1)).alias("rows"),
                  *[F.count_distinct(c).alias(f"distinct_{c}") for c in distinct_cols])


def seat_utilisation(active: Column, total: Column) -> Column:
    """active / total x 100, 0 when there are no seats."""
    return F.coalesce(F.round(F.try_divide(active * 100.0, total), 2), F.lit(0.0))
