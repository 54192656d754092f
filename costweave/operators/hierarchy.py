"""Daily cost series over the Service_ID hierarchy.

Plan shape (the expensive part runs once, on the raw fact):
  fact --(partial+final hash aggregate on day x service_id)--> daily rows
  daily --(min per key, global max as a scalar subquery)--> scaffold
  scaffold zero rows UNION ALL daily rows
  GROUP BY ds, ROLLUP(division, platform, workload, component) --> 5 levels
(``zero_fill`` keeps the explicit scaffold LEFT JOIN form for callers that
need the filled leaves themselves.)

The first aggregate shrinks the fact (billions of rows) to days x
components (~2,500 x 300), so a hot key such as Untagged is absorbed by
the map-side partial aggregate; raw rows are never repartitioned by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tags import LEVELS, TOTAL_LABEL, service_id, split_path
from ..session import cut_lineage

LEVEL_BY_ROLLED = {0: "component", 1: "workload", 2: "platform", 3: "division", 4: "total"}


def daily_by_key(fact: DataFrame, key, date_col: str = "ChargePeriodStart",
                 cost_col: str = "BilledCost", key_name: str = "unique_id") -> DataFrame:
    """date(ts) x key -> sum(cost) as ``y`` (no zero fill)."""
    return (fact.select(F.to_date(date_col).alias("ds"), (F.col(key) if isinstance(key, str) else key).alias(key_name),
                        F.col(cost_col).alias("_c"))
            .groupBy("ds", key_name).agg(F.sum("_c").alias("y")))


def daily_by_service(fact: DataFrame, date_col="ChargePeriodStart", cost_col="BilledCost") -> DataFrame:
    return daily_by_key(fact, service_id("Tags"), date_col, cost_col, key_name="service_id")


def scaffold(daily: DataFrame, key: str = "service_id") -> DataFrame:
    """Every day from each key's own first day to the global last day.

    The per-key start rows are few (one per series) but explode into
    series x days rows, so they are spread over the shuffle width first
    (an explicit count, which adaptive coalescing leaves alone); otherwise
    one task would generate and aggregate the whole calendar."""
    global_end = daily.agg(F.max("ds")).scalar()
    width = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = daily.groupBy(key).agg(F.min("ds").alias("_start")).repartition(width, key)
    return starts.select(key, F.explode(F.sequence(F.col("_start"), global_end)).alias("ds"))


def zero_fill(daily: DataFrame, key: str = "service_id") -> DataFrame:
    """Scaffold LEFT JOIN facts on (key, ds), missing -> 0."""
    sc = scaffold(daily, key)
    return (sc.join(daily, [key, "ds"], "left")
            .select(key, "ds", F.coalesce(F.col("y"), F.lit(0).cast(daily.schema["y"].dataType)).alias("y")))


def hierarchy_rollup(filled: DataFrame, key: str = "service_id") -> DataFrame:
    """The five prefix levels of the path (not a cube), one row per node-day."""
    # Money is carried as exact integer units (10^-scale) through the
    # 5x Expand: long sums stay on the fast codegen path, while wide
    # decimal sums would box every value.
    ytype = filled.schema["y"].dataType
    scale = getattr(ytype, "scale", None)
    units = (F.col("y") * (10 ** scale)).cast("long") if scale is not None else F.col("y")
    parts = filled.select("ds", units.alias("y"), *split_path(key, LEVELS))
    sets = [["ds"] + LEVELS[:i] for i in range(len(LEVELS), -1, -1)]
    g = parts.groupingSets(sets, "ds", *LEVELS)
    rolled = sum(F.grouping(c) for c in LEVELS)
    level = F.element_at(F.create_map(*[x for k, v in LEVEL_BY_ROLLED.items()
                                        for x in (F.lit(k), F.lit(v))]), rolled.cast("int"))
    out = g.agg(F.sum("y").alias("y"), level.alias("level"))
    y = F.col("y") / (10 ** scale) if scale is not None else F.col("y")
    return out.select(
        F.concat_ws("/", F.lit(TOTAL_LABEL), *LEVELS).alias("unique_id"),
        "ds", y.cast("double").alias("y"), "level", *LEVELS)


def hierarchy_series(fact: DataFrame, date_col="ChargePeriodStart", cost_col="BilledCost") -> DataFrame:
    """Every level's zero-filled daily series (gold.forecast_input).

    Same result as ``hierarchy_rollup(zero_fill(daily))`` without the join:
    the scaffold contributes zero-valued rows, the facts their sums, and a
    single grouping-sets aggregate over the union both fills and rolls up
    (a missing day only needs to *exist*; adding 0 does not change sums).

    The day x component sums (small: days x series, whatever the fact size)
    feed three branches - global end, per-key start and the values - so they
    are checkpointed once instead of re-running the fact scan and joins."""
    daily = cut_lineage(daily_by_service(fact, date_col, cost_col))
    zero = F.lit(0).cast(daily.schema["y"].dataType)
    filled = scaffold(daily).select("service_id", "ds", zero.alias("y")).unionByName(daily.select("service_id", "ds", "y"))
    return hierarchy_rollup(filled)


def hierarchy_bridge(leaves: DataFrame, key: str = "service_id") -> DataFrame:
    """(ancestor unique_id, bottom unique_id) for every leaf: the summing matrix
    kept as a long table.  Built from the distinct leaves only."""
    parts = F.split(F.col(key), "/")
    bottom = F.concat_ws("/", F.lit(TOTAL_LABEL), F.col(key))
    d = leaves.select(key).distinct()
    anc = F.transform(F.sequence(F.lit(0), F.lit(len(LEVELS))),
                      lambda i: F.when(i == 0, F.lit(TOTAL_LABEL)).otherwise(
                          F.concat_ws("/", F.lit(TOTAL_LABEL), F.array_join(F.slice(parts, 1, i), "/"))))
    return d.select(F.explode(anc).alias("unique_id"), bottom.alias("bottom_id"))


def untagged_share(daily: DataFrame, key: str = "service_id") -> DataFrame:
    from ..functions.tags import UNTAGGED_ID
    return daily.agg(
        F.round(F.try_divide(F.sum(F.when(F.col(key) == UNTAGGED_ID, F.col("y")).otherwise(0)) * 100,
                             F.sum("y")), 4).cast("double").alias("untagged_pct"))
