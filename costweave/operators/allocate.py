"""Exact allocation of money: shares that add up to what is shared, to the last unit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def share_exactly(df: DataFrame, group: list[str], order: list[str], weight: str, amount: str, out: str) -> DataFrame:
    """``out``: whole units of ``amount`` (the same in all rows of a group) in proportion to ``weight``
    (whole numbers, not negative).  Each row gets the whole part of its share, the units left go one each to
    the largest remainders, ties in ``order``; a group without weight is shared evenly.  A window
    holds the rows of one group."""
    g = Window.partitionBy(*group)
    w = F.when(F.sum(weight).over(g) > 0, F.col(weight)).otherwise(1).cast("decimal(38,0)")
    df = df.withColumn("_w", w).withColumn("_total", F.sum("_w").over(g))
    # whole numbers of up to 38 digits: amount times weight passes 2**63 for large capacities
    df = df.withColumns({"_product": (F.col(amount) * F.col("_w")).cast("decimal(38,0)")})
    df = df.withColumn("_whole", F.expr("_product div _total")).withColumn(
        "_rest", F.col("_product") - F.col("_whole").cast("decimal(38,0)") * F.col("_total"))
    df = df.withColumn("_left", F.col(amount) - F.sum("_whole").over(g)).withColumn(
        "_nth", F.row_number().over(g.orderBy(F.col("_rest").desc(), *order)))
    unit = F.col("_whole") + (F.col("_nth") <= F.col("_left")).cast("long")
    return df.withColumn(out, unit.cast("long")).drop("_w", "_total", "_product", "_whole", "_rest", "_left", "_nth")


def allocate_or_keep(amounts: DataFrame, shares: DataFrame, keys: list[str], receiver: str, weight: str, amount: str,
                     left_over: str = "unallocated") -> DataFrame:
    """``amount`` of each key split over the receivers in ``shares`` in proportion to ``weight``; the
    amount of a key that nobody carries, or only with weight zero, stays under ``left_over``."""
    total = shares.groupBy(*keys).agg(F.sum(weight).alias("_total"))
    carried = shares.join(total, keys).filter(F.col("_total") != 0).select(
        *keys, receiver, (F.col(weight).cast("double") / F.col("_total").cast("double")).alias("_share"))
    j = amounts.join(carried, keys, "left")
    return j.select(*keys, F.coalesce(receiver, F.lit(left_over)).alias(receiver),
                    (F.col(amount).cast("double") * F.coalesce("_share", F.lit(1.0))).alias(amount))
