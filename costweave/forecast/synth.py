"""History synthesis: extend each subscription's daily cost backwards.

For every subscription, 23 x 30 days before the first real day:
baseline x (1 + g)^(-days_back / 30) x season x weekend x noise, floored
at 0.  Season: August 0.90, December 0.85, September 1.05; weekend 0.75;
g = 0.015 x U(0.8, 1.2) per subscription; noise ~ N(1, 0.05).

Random draws come from ``xxhash64`` of (key, day, seed) rather than a
driver-side generator, so the values do not depend on partitioning or
task order and the job is a pure DataFrame plan (keys x ``sequence``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Synthesis parameters.
MONTHS = 23
DAYS_PER_MONTH = 30
GROWTH = 0.015
NOISE_CV = 0.05
SEED = 42
SEASON = {8: 0.90, 12: 0.85, 9: 1.05}
WEEKEND = 0.75


def _uniform(*cols) -> F.Column:
    """Deterministic U(0,1) from a 64-bit hash."""
    h = F.xxhash64(*cols, F.lit(SEED))
    return (F.pmod(h, F.lit(2 ** 31 - 1)).cast("double") + 0.5) / float(2 ** 31 - 1)


def synthesise_history(fact: DataFrame, noise: bool = True, key: str = "SubAccountId") -> DataFrame:
    daily = fact.groupBy(F.col(key).alias("sub"), F.to_date("ChargePeriodStart").alias("d")).agg(
        F.sum("BilledCost").alias("c"))
    base = daily.groupBy("sub").agg((F.sum("c").cast("double") / F.count(F.lit(1))).alias("baseline"))
    start = daily.agg(F.min("d")).scalar()
    days = base.select("sub", "baseline",
                       F.explode(F.sequence(F.lit(1), F.lit(MONTHS * DAYS_PER_MONTH))).alias("days_back"))
    days = days.withColumn("ds", F.date_sub(start, F.col("days_back")))
    g = (F.lit(GROWTH) * (0.8 + _uniform(F.col("sub")) * 0.4)) if noise else F.lit(GROWTH)
    season = F.lit(1.0)
    for m, v in SEASON.items():
        season = F.when(F.month("ds") == m, F.lit(v)).otherwise(season)
    weekend = F.when(F.dayofweek("ds").isin(1, 7), F.lit(WEEKEND)).otherwise(F.lit(1.0))
    cost = F.col("baseline") * F.pow(1 + g, -(F.col("days_back") / 30.0)) * season * weekend
    if noise:
        u1, u2 = _uniform(F.col("sub"), F.col("ds"), F.lit(1)), _uniform(F.col("sub"), F.col("ds"), F.lit(2))
        z = F.sqrt(-2.0 * F.log(u1)) * F.cos(2 * math.pi * u2)           # Box-Muller
        cost = cost * (1.0 + NOISE_CV * z)
    cost = F.greatest(F.lit(0.0), cost).cast("decimal(38,4)").cast("double")
    return days.select(F.col("ds").alias("ChargePeriodStart"), F.date_add("ds", 1).alias("ChargePeriodEnd"),
                       F.col("sub").alias("SubAccountId"), F.concat(F.lit("Subscription-"), "sub").alias("SubAccountName"),
                       cost.alias("BilledCost"), cost.alias("EffectiveCost"), F.lit("USD").alias("Currency"),
                       F.lit(False).alias("IsPartialMonthRecord"))
