"""Per-key ordering operators.

"Latest row per key" uses ``max_by`` over a struct - a two-phase aggregate
whose map-side step keeps one row per key per task - instead of
``row_number`` over a window, which would shuffle every row of a key to
one task and sort them there; a key holding a third of the rows would then
be one giant sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key by ``order`` (descending, lexicographic)."""
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    packed = F.struct(*[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(F.max_by(packed, ordering).alias("_row"))
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def dedupe_dim(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Unique on key; the survivor is the newest by ``order`` (deterministic)."""
    return latest_per_key(df, [key], order)


def restatements(df: DataFrame, keys: list[str], snapshot: str, value: str) -> DataFrame:
    """Rows whose value changed from the previous snapshot of the same key."""
    w = Window.partitionBy(*keys).orderBy(snapshot)
    prev = F.lag(value).over(w)
    prev_snap = F.lag(snapshot).over(w)
    out = df.select(*keys, snapshot, F.col(value), prev.alias("previous_value"),
                    prev_snap.alias("previous_snapshot"))
    return out.filter(F.col("previous_value").isNotNull() & (F.col(value) != F.col("previous_value")))


def mom_change(df: DataFrame, key: str, year: str, month: str, value: str) -> DataFrame:
    """(value - previous) / previous x 100 rounded to 2; the first month dropped."""
    w = Window.partitionBy(key).orderBy(year, month)
    prev = F.lag(value).over(w)
    out = df.select(key, year, month, value, prev.alias("previous_cost"))
    return (out.filter(F.col("previous_cost").isNotNull())
            .withColumn("mom_change_pct",
                        F.round(F.try_divide((F.col(value) - F.col("previous_cost")) * 100,
                                             F.col("previous_cost")), 2).cast("double")))


def running_total(df: DataFrame, partition: list, order: str, value: str, name: str) -> DataFrame:
    w = (Window.partitionBy(*partition).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(name, F.sum(value).over(w))


def best_per_group(df: DataFrame, keys: list[str], metric: str, tie: str) -> DataFrame:
    """Row with the lowest metric per key; ``tie`` breaks equal metrics."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    out = df.filter(F.col(metric).isNotNull()).groupBy(*keys).agg(
        F.min_by(packed, F.struct(F.col(metric), F.col(tie))).alias("_row"))
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
