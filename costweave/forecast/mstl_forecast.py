"""MSTL + ARIMA forecasting as a Spark plan.

1. ``decompose``: one grouped-map task per series (bounded by the
   calendar, not by data volume) returns the MSTL components as arrays and
   the differencing order chosen by KPSS on the seasonally adjusted part.
2. The 16 (p, q) candidates are an exploded literal array, so each
   (series, order) pair is its own row; ``mapInPandas`` fits them in
   Arrow batches spread over all cores / executors.
3. The best order per series is a ``min_by`` on (AICc, p, q); where no order
   has a score (short series) it is the seasonal naive forecast, with
   ``skip_reason`` set.  The winner's
   forecast of the seasonally adjusted part plus the last season repeated is
   ``posexplode``d into dated rows.  In-sample fitted values come out the
   same way for residual-based reconciliation.

With ``cutoff`` in the key the same plan runs the walk-forward backtest:
every (series, cutoff) trains only on days up to its cutoff.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import arima
from .stl import mstl

SEASON = 7
DECOMP_SCHEMA = ("unique_id string, cutoff date, first_ds date, last_ds date, d int, "
                 "sa array<double>, seasonal array<double>")
FIT_SCHEMA = ("unique_id string, cutoff date, first_ds date, last_ds date, d int, p int, q int, aicc double, "
              "fc array<double>, fitted array<double>, seasonal array<double>")
NO_ORDER = "no_arima_order_scored"


def _naive(sa: np.ndarray, seasonal: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecast and fitted values of the adjusted series that, with the season added,
    repeat the last full season, or the last day of a series shorter than that."""
    y, n = sa + seasonal, len(sa)
    lag = SEASON if n >= SEASON else 1
    fc = sa[n - SEASON + np.arange(h) % SEASON] if n >= SEASON else np.full(h, y[-1])
    fitted = np.full(n, np.nan)
    fitted[lag:] = y[:n - lag] - seasonal[lag:]
    return fc, fitted


def _decompose(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("ds")
    y = pdf["y"].to_numpy(dtype=float)
    comp = mstl(y, [SEASON])
    seas = comp.get(f"seasonal_{SEASON}", np.zeros(len(y)))
    sa = y - seas
    return pd.DataFrame([{"unique_id": pdf["unique_id"].iloc[0], "cutoff": pdf["cutoff"].iloc[0],
                          "first_ds": pdf["ds"].iloc[0], "last_ds": pdf["ds"].iloc[-1],
                          "d": arima.choose_d(sa), "sa": sa.tolist(), "seasonal": seas.tolist()}])


def decompose(series: DataFrame) -> DataFrame:
    """(unique_id, cutoff, ds, y) -> one row per (series, cutoff)."""
    width = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = series.select("unique_id", "cutoff", "ds", "y").repartition(width, "unique_id", "cutoff")
    return s.groupBy("unique_id", "cutoff").applyInPandas(_decompose, DECOMP_SCHEMA)


def _fit_batches(h: int):
    def fit(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                sa = np.asarray(r.sa, dtype=float)
                aicc, fc, fitted = arima.fit_forecast(sa, int(r.p), int(r.q), int(r.d), h)
                if not np.isfinite(aicc):
                    fc, fitted = _naive(sa, np.asarray(r.seasonal, dtype=float), h)
                out.append({"unique_id": r.unique_id, "cutoff": r.cutoff, "first_ds": r.first_ds,
                            "last_ds": r.last_ds, "d": int(r.d), "p": int(r.p), "q": int(r.q),
                            "aicc": aicc if np.isfinite(aicc) else None,
                            "fc": fc.tolist(), "fitted": fitted.tolist(), "seasonal": list(r.seasonal)})
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FIT_SCHEMA.split(", ")])
    return fit


def order_search(decomposed: DataFrame, h: int) -> DataFrame:
    """Every (series, order) candidate fitted; one row each."""
    cands = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in arima.orders()])
    rows = decomposed.select("*", F.explode(cands).alias("_o")).select("*", "_o.p", "_o.q").drop("_o")
    width = int(decomposed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width).mapInPandas(_fit_batches(h), FIT_SCHEMA)


def best_orders(fits: DataFrame) -> DataFrame:
    keep = F.struct("first_ds", "last_ds", "d", "p", "q", "aicc", "fc", "fitted", "seasonal")
    best = fits.groupBy("unique_id", "cutoff").agg(
        F.min_by(keep, F.struct(F.col("aicc").isNull(), "aicc", "p", "q")).alias("b"))
    return best.select("unique_id", "cutoff", "b.*").withColumn(
        "skip_reason", F.when(F.col("aicc").isNull(), F.lit(NO_ORDER)))


def forecast_rows(best: DataFrame, model_id: str = "MSTL") -> DataFrame:
    """Dated forecast rows: ARIMA path of the adjusted series + last season."""
    n = F.size("seasonal")
    out = best.select("unique_id", "cutoff", "last_ds", "seasonal", n.alias("_n"), "p", "q", "d",
                      "skip_reason", F.posexplode("fc").alias("_i", "_fc"))
    phase = (F.col("_n") - SEASON) + (F.col("_i") % SEASON)
    seas = F.when(F.col("_n") >= SEASON, F.element_at("seasonal", (phase + 1).cast("int"))).otherwise(F.lit(0.0))
    return out.select("unique_id", "cutoff", F.date_add("last_ds", (F.col("_i") + 1).cast("int")).alias("ds"),
                      F.lit(model_id).alias("model_id"), (F.col("_fc") + seas).alias("yhat"),
                      F.when(F.col("skip_reason").isNull(), F.format_string("ARIMA(%d,%d,%d)", "p", "d", "q"))
                      .otherwise("SeasonalNaive").alias("order"), "skip_reason")


def fitted_rows(best: DataFrame) -> DataFrame:
    out = best.select("unique_id", "cutoff", "first_ds", "seasonal",
                      F.posexplode("fitted").alias("_i", "_f"))
    out = out.filter(F.col("_f").isNotNull() & ~F.isnan("_f"))   # days before the first scored row
    return out.select("unique_id", "cutoff", F.date_add("first_ds", F.col("_i").cast("int")).alias("ds"),
                      (F.col("_f") + F.element_at("seasonal", (F.col("_i") + 1).cast("int"))).alias("fitted"))


def mstl_arima(history: DataFrame, h: int, cutoffs=None, model_id: str = "MSTL") -> tuple[DataFrame, DataFrame]:
    """(forecasts, fitted) for every series (and every cutoff when given
    an array column of cutoffs: training rows are the days up to each)."""
    if cutoffs is None:
        series = history.withColumn("cutoff", F.lit(None).cast("date"))
    else:
        series = history.select("*", F.explode(cutoffs).alias("cutoff")).filter(F.col("ds") <= F.col("cutoff"))
    # the winners (one row per series, arrays of days) feed both outputs:
    # written once so the order search is not run twice
    best = cut_lineage(best_orders(order_search(decompose(series), h)))
    return forecast_rows(best, model_id), fitted_rows(best)


COMPONENT_SCHEMA = ("unique_id string, ds date, y double, trend double, seasonal_7 double, "
                    "seasonal_365 double, remainder double")


def _components(periods):
    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        y = pdf["y"].to_numpy(dtype=float)
        c = mstl(y, list(periods))
        return pd.DataFrame({"unique_id": pdf["unique_id"].to_numpy(), "ds": pdf["ds"].to_numpy(), "y": y,
                             "trend": c["trend"], "seasonal_7": c.get("seasonal_7", np.zeros(len(y))),
                             "seasonal_365": c.get("seasonal_365", np.full(len(y), np.nan)),
                             "remainder": c["remainder"]})
    return kernel


def components(series: DataFrame, periods=(SEASON,)) -> DataFrame:
    """Long MSTL components per series-day (seasonal_365 null when the
    period is not used or the series is shorter than two years)."""
    width = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = series.select("unique_id", "ds", "y").repartition(width, "unique_id")
    out = s.groupBy("unique_id").applyInPandas(_components(periods), COMPONENT_SCHEMA)
    return out.withColumn("seasonal_365", F.when(~F.isnan("seasonal_365"), F.col("seasonal_365")))
