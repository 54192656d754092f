"""Baseline forecasts, their in-sample fit, backtest windows and bottom-up
reconciliation, all as DataFrame plans (no per-series Python).

Seasonal naive repeats each series' last full season: a row on one of the
last ``m`` days explodes into every future step with the same phase, so no
join is needed.  The weekday median does the same with the lower median of the
last nine values of a weekday; unlike seasonal naive it does not add up over
the hierarchy, which is what reconciliation is for.  Backtest cutoffs are an array built from a scalar
subquery; each history row is replicated only into the windows whose
training tail it belongs to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import horizon_bucket

SEASON = 7
HORIZON_DAYS = 365
BT_HORIZON_DAYS = 182
N_WINDOWS = 6
STEP_SIZE_DAYS = 28
MEDIAN_WEEKS = 9
NAIVE, MEDIAN = "SeasonalNaive", "WeekdayMedian"


def seasonal_naive(history: DataFrame, h: int = HORIZON_DAYS, m: int = SEASON, key: str = "unique_id",
                   model_id: str = "SeasonalNaive", cutoff=None) -> DataFrame:
    """yhat(cutoff + s) = y(cutoff - m + 1 + (s - 1) % m) for s = 1..h.

    ``cutoff`` defaults to each series' last day (all series end on the
    global last day after zero fill)."""
    if cutoff is None:
        last = history.groupBy(key).agg(F.max("ds").alias("cutoff"))
        hist = history.join(last, key)
    else:
        hist = history.withColumn("cutoff", F.lit(cutoff).cast("date") if isinstance(cutoff, str) else cutoff)
    tail = hist.filter((F.col("ds") > F.date_sub("cutoff", m)) & (F.col("ds") <= F.col("cutoff")))
    phase = F.datediff("ds", F.date_sub("cutoff", m))           # 1..m
    steps = F.sequence(phase, F.lit(h), F.lit(m))
    out = tail.select(key, "cutoff", "y", F.explode(steps).alias("step"))
    return out.select(key, F.date_add("cutoff", F.col("step")).alias("ds"), F.lit(model_id).alias("model_id"),
                      F.col("y").alias("yhat"))


def _middle(values):
    """Lower median of an array (an element of it, so no rounding)."""
    ordered = F.sort_array(values)
    return F.get(ordered, F.floor((F.size(ordered) - 1) / 2).cast("int"))


def weekday_median_from(rows: DataFrame, h: int, key: str = "unique_id", m: int = SEASON,
                        model_id: str = MEDIAN) -> DataFrame:
    """``rows`` carry their cutoff; one forecast per (series, cutoff).  A group is
    the at most nine values of one weekday."""
    span = MEDIAN_WEEKS * m
    tail = rows.filter((F.col("ds") > F.date_sub("cutoff", span)) & (F.col("ds") <= F.col("cutoff")))
    phase = F.pmod(F.datediff("ds", F.date_sub("cutoff", span)) - 1, F.lit(m)) + 1
    mid = tail.groupBy(key, "cutoff", phase.alias("phase")).agg(_middle(F.collect_list("y")).alias("yhat"))
    out = mid.select(key, "cutoff", "yhat", F.explode(F.sequence(F.col("phase"), F.lit(h), F.lit(m))).alias("step"))
    return out.select(key, "cutoff", F.date_add("cutoff", F.col("step")).alias("ds"), F.lit(model_id).alias("model_id"), "yhat")


def weekday_median(history: DataFrame, h: int = HORIZON_DAYS, key: str = "unique_id") -> DataFrame:
    last = history.groupBy(key).agg(F.max("ds").alias("cutoff"))
    return weekday_median_from(history.join(last, key), h, key).drop("cutoff")


def in_sample(history: DataFrame, key: str = "unique_id", m: int = SEASON) -> DataFrame:
    """(key, ds, y, model_id, fitted) of both baselines on their own past: the value
    a week before, the lower median of the nine weeks before (null in the first week).
    The history has no gaps, so a lag is a number of days."""
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy("ds")
    lags = F.filter(F.array(*[F.lag("y", m * k).over(w) for k in range(1, MEDIAN_WEEKS + 1)]), lambda x: x.isNotNull())
    both = history.select(key, "ds", "y", F.lag("y", m).over(w).alias("a"), F.when(F.size(lags) > 0, _middle(lags)).alias("b"))
    models = F.array(F.struct(F.lit(NAIVE).alias("model_id"), F.col("a").alias("fitted")),
                     F.struct(F.lit(MEDIAN).alias("model_id"), F.col("b").alias("fitted")))
    return both.select(key, "ds", "y", F.explode(models).alias("_m")).select(key, "ds", "y", "_m.*")


LEAST_VARIANCE = 1e-4           # a cent squared: a perfect fit still has a finite weight


def residual_variances(fit: DataFrame, cutoffs=None, n_windows: int = N_WINDOWS, key: str = "unique_id") -> DataFrame:
    """(key, model_id[, cutoff], w): mean squared in-sample residual of the days up to
    the cutoff (all days without one); where no day is fitted, the mean squared
    value.  ``cutoffs`` is an array column of ``n_windows`` dates; the windows are
    conditional sums of one aggregate, the rows aren't copied."""
    e2 = (F.col("y") - F.col("fitted")) * (F.col("y") - F.col("fitted"))
    y2 = F.col("y") * F.col("y")

    def weight(upto):
        own = lambda c: F.avg(c) if upto is None else F.avg(F.when(F.col("ds") <= upto, c))
        return F.greatest(F.coalesce(own(e2), own(y2)), F.lit(LEAST_VARIANCE))

    if cutoffs is None:
        return fit.groupBy(key, "model_id").agg(weight(None).alias("w"))
    g = fit.groupBy(key, "model_id").agg(*[weight(cutoffs[k]).alias(f"w{k}") for k in range(n_windows)],
                                         F.min("ds").alias("first"))
    each = F.array(*[F.struct(cutoffs[k].alias("cutoff"), F.col(f"w{k}").alias("w")) for k in range(n_windows)])
    return g.select(key, "model_id", "first", F.explode(each).alias("_e")).select(key, "model_id", "first", "_e.*").filter(
        F.col("first") <= F.col("cutoff")).drop("first")


def backtest_cutoffs(history: DataFrame, n_windows: int = N_WINDOWS, step: int = STEP_SIZE_DAYS,
                     h: int = BT_HORIZON_DAYS):
    """Array column of the N cutoffs (newest first): last day - h - k*step."""
    gmax = history.agg(F.max("ds")).scalar()
    return F.array(*[F.date_sub(gmax, h + k * step) for k in range(n_windows)])


def backtest_seasonal_naive(history: DataFrame, key: str = "unique_id", m: int = SEASON,
                            h: int = BT_HORIZON_DAYS, n_windows: int = N_WINDOWS, step: int = STEP_SIZE_DAYS,
                            model_id: str = "SeasonalNaive") -> DataFrame:
    """Walk-forward seasonal naive: one forecast per (series, cutoff) from
    data up to the cutoff only (no leakage)."""
    cut = backtest_cutoffs(history, n_windows, step, h)
    rows = history.select(key, "ds", "y", F.explode(cut).alias("cutoff"))
    tail = rows.filter((F.col("ds") > F.date_sub("cutoff", m)) & (F.col("ds") <= F.col("cutoff")))
    phase = F.datediff("ds", F.date_sub("cutoff", m))
    out = tail.select(key, "cutoff", "y", F.explode(F.sequence(phase, F.lit(h), F.lit(m))).alias("step"))
    return out.select(key, "cutoff", F.date_add("cutoff", F.col("step")).alias("ds"),
                      F.lit(model_id).alias("model_id"), F.col("y").alias("yhat"))


def backtest_weekday_median(history: DataFrame, key: str = "unique_id", h: int = BT_HORIZON_DAYS,
                            cutoffs=None) -> DataFrame:
    """Walk-forward weekday median, training rows up to each cutoff only."""
    cut = backtest_cutoffs(history) if cutoffs is None else cutoffs
    return weekday_median_from(history.select(key, "ds", "y", F.explode(cut).alias("cutoff")), h, key)


def attach_actuals(fc: DataFrame, history: DataFrame, key: str = "unique_id") -> DataFrame:
    """Forecast LEFT JOIN actuals on (key, ds); days_ahead and bucket added."""
    j = fc.join(history.select(key, "ds", "y"), [key, "ds"], "left")
    d = F.datediff("ds", "cutoff")
    return j.withColumn("days_ahead", d).withColumn("horizon_bucket", horizon_bucket(d))


def bottom_up(fc: DataFrame, bridge: DataFrame, key: str = "unique_id",
              model_suffix: str = "/BottomUp") -> DataFrame:
    """Every node's forecast replaced by the sum of its bottom series:
    bridge (ancestor, bottom) join + groupBy, no summing matrix."""
    bottoms = fc.join(bridge.select(F.col("bottom_id").alias(key), F.col("unique_id").alias("_anc")), key)
    extra = [c for c in ("cutoff",) if c in fc.columns]
    out = bottoms.groupBy(F.col("_anc").alias(key), "ds", "model_id", *extra).agg(F.sum("yhat").alias("yhat"))
    return out.withColumn("model_id", F.concat("model_id", F.lit(model_suffix)))
