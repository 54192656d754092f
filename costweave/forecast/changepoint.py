"""Change points per series: a grouped-map numpy kernel (PELT, rbf cost).

Per series: skip if shorter than ``MIN_DAYS``; trend = MSTL trend with
periods 7 and 365 (365 only with two full years); skip if the trend is flat;
z-score with the population std; PELT (Killick et al. 2012) with the
Gaussian-kernel cost of Truong et al. (2020), breakpoints on a ``jump``
grid, ``min_size`` days apart, penalty ``PENALTY``.  Segment means are
taken on the **raw** cost.

The kernel sees one series (at most a few thousand days, bounded by the
calendar, not by data volume), holds arrays linear in its days and returns
breakpoints; Spark distributes series over tasks with
``groupBy(unique_id).applyInPandas``.  Segment ends and means, pairing segments,
classifying changes and picking top movers are DataFrame operations
that take any breakpoints.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import lifecycle_class
from ..session import cut_lineage
from .stl import mstl

# Detection parameters.
MIN_DAYS = 90
MIN_SIZE = 14
JUMP = 7
PENALTY = 10.0

BREAK_SCHEMA = "unique_id string, segment_start date, skip_reason string"


def median_square_gap(x: np.ndarray) -> float:
    """Median of (x_i - x_j)^2 over pairs i < j in linear memory: the order statistics of
    the gaps are found by bisection on their value, counting pairs in the sorted values."""
    x = np.sort(x)
    n = len(x)
    at = np.arange(n)

    def gap(rank: int) -> float:
        low, high = -1.0, float(x[-1] - x[0])           # at least rank + 1 gaps are <= high
        while True:
            mid = (low + high) / 2
            if not low < mid < high:
                break
            if (np.searchsorted(x, x + mid, side="right") - at - 1).sum() > rank:
                high = mid
            else:
                low = mid
        last = np.searchsorted(x, x + high, side="right") - 1
        return float((x[last] - x).max())               # the largest gap that is counted at ``high``

    m = n * (n - 1) // 2
    return 0.5 * (gap((m - 1) // 2) ** 2 + gap(m // 2) ** 2)


def pelt_rbf(x: np.ndarray, pen: float = PENALTY, min_size: int = MIN_SIZE, jump: int = JUMP) -> list[int]:
    """Breakpoint indexes (segment ends, exclusive; last = n).

    Memory is linear in the days: a candidate start keeps the kernel sum of its
    segment up to the current grid point; a step adds the kernel of the ``jump`` new days
    with the days before them, summed into grid cells (a ``jump`` x n block)."""
    n = len(x)
    gamma = 1.0
    if n > 1:
        med = median_square_gap(x)
        gamma = 1.0 / med if med > 0 else 1.0
    edges = np.r_[np.arange(0, n, jump), n]
    G = len(edges)
    best = np.full(G, np.nan)
    best[0] = -pen
    prev = np.full(G, -1)
    cands = np.array([0])                                   # grid indexes
    sums = np.zeros(G)                                      # kernel sum of [edges[s], edges[t])
    for t in range(1, G):
        new = x[edges[t - 1]:edges[t]]
        old = x[:edges[t - 1]]
        inner = np.exp(-gamma * np.subtract.outer(new, new) ** 2).sum()
        if len(old):
            cross = np.exp(-gamma * np.subtract.outer(new, old) ** 2).sum(0)
            cells = np.add.reduceat(cross, edges[:t - 1])   # by grid cell
            sums[:t - 1] += 2 * cells[::-1].cumsum()[::-1]
        sums[:t] += inner
        if edges[t] < min_size and t != G - 1:
            continue
        far = edges[t] - edges[cands] >= min_size
        ok = cands[far]
        if ok.size == 0:
            continue
        length = edges[t] - edges[ok]
        vals = best[ok] + (length - sums[ok] / length) + pen
        i = int(np.argmin(vals))
        f = float(vals[i])
        best[t], prev[t] = f, int(ok[i])
        keep = ~far
        keep[far] = (vals - pen) <= f
        cands = np.append(cands[keep], t)
    if np.isnan(best[G - 1]):
        return [n]
    bkps, t = [], G - 1
    while t > 0:
        bkps.append(int(edges[t]))
        t = int(prev[t])
    return sorted(bkps)


def break_series(pdf: pd.DataFrame) -> pd.DataFrame:
    """Grouped-map kernel: one series in, the first day of each of its segments out."""
    pdf = pdf.sort_values("ds")
    uid = pdf["unique_id"].iloc[0]
    y = pdf["y"].to_numpy(dtype=float)
    ds = pd.to_datetime(pdf["ds"]).dt.date.to_numpy()
    skip = lambda reason: pd.DataFrame([{"unique_id": uid, "segment_start": None, "skip_reason": reason}])
    if len(y) < MIN_DAYS:
        return skip("too_short")
    tr = mstl(y, [7, 365] if len(y) >= 2 * 365 else [7])["trend"]
    sd = tr.std()
    # a constant series can leave float dust in the smoothed trend
    if not np.isfinite(sd) or sd <= 1e-12 * max(1.0, float(np.abs(tr).mean())):
        return skip("flat")
    starts = [0, *pelt_rbf((tr - tr.mean()) / sd)[:-1]]
    return pd.DataFrame({"unique_id": uid, "segment_start": ds[starts], "skip_reason": None})


def breakpoints(series: DataFrame) -> DataFrame:
    """(unique_id, ds, y) -> (unique_id, segment_start, skip_reason); a skipped series
    has one row with a null start and the reason."""
    # Spread series over an explicit number of partitions: the input is
    # small per series, and adaptive coalescing would otherwise run every
    # series in one Python worker.  groupBy reuses this partitioning.
    width = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = series.select("unique_id", "ds", "y").repartition(width, "unique_id")
    return s.groupBy("unique_id").applyInPandas(break_series, BREAK_SCHEMA)


def segments_at(series: DataFrame, breaks: DataFrame) -> DataFrame:
    """Segments between given first days: start, inclusive end, days and mean of the raw
    cost.  A day belongs to the last start that isn't after it (a running maximum over
    days and starts of a series, no range join); days before the first start belong to none."""
    days = series.select("unique_id", "ds", "y", F.lit(None).cast("date").alias("start")).unionByName(
        breaks.filter(F.col("segment_start").isNotNull()).select(
            "unique_id", F.col("segment_start").alias("ds"), F.lit(None).cast("double").alias("y"), F.col("segment_start").alias("start")))
    upto = Window.partitionBy("unique_id").orderBy("ds").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    owned = days.withColumn("segment_start", F.max("start").over(upto)).filter("start is null and segment_start is not null")
    return owned.groupBy("unique_id", "segment_start").agg(
        F.max("ds").alias("segment_end"), F.count(F.lit(1)).cast("int").alias("segment_days"),
        (F.sum(F.col("y").cast("decimal(38,6)")).cast("double") / F.count("y")).alias("daily_mean_cost"))


def segments(series: DataFrame) -> DataFrame:
    """(unique_id, ds, y) -> segments; skipped series keep one row with the reason.  The
    breakpoints (a few rows a series) are written once, so that no branch detects again."""
    breaks = cut_lineage(breakpoints(series))
    skipped = breaks.filter("skip_reason is not null").select("unique_id", "skip_reason")
    found = segments_at(series, breaks).withColumn("skip_reason", F.lit(None).cast("string"))
    return found.unionByName(skipped, allowMissingColumns=True)


def classify_changes(segs: DataFrame) -> DataFrame:
    """Each segment against the one before it: before/after means, change,
    pct as a ratio (null when before is 0) and lifecycle class."""
    s = segs.filter(F.col("skip_reason").isNull())
    w = Window.partitionBy("unique_id").orderBy("segment_start")
    s = s.select("unique_id", F.col("segment_start").alias("changepoint_date"),
                 F.lag("daily_mean_cost").over(w).alias("before_daily_mean"),
                 F.col("daily_mean_cost").alias("after_daily_mean"))
    s = s.filter(F.col("before_daily_mean").isNotNull())
    change = F.col("after_daily_mean") - F.col("before_daily_mean")
    return s.select("*", F.abs(change).alias("abs_change"),
                    F.when(F.col("before_daily_mean") != 0,
                           change / F.col("before_daily_mean")).alias("pct_change"),
                    lifecycle_class("before_daily_mean", "after_daily_mean").alias("change_type"))


def top_movers(changes: DataFrame, n: int = 20) -> DataFrame:
    return changes.orderBy(F.col("abs_change").desc(), "unique_id", "changepoint_date").limit(n)
