"""Tree reconciliation with a diagonal weight matrix (WLS), as windows.

With a diagonal W the GLS projection on a tree has a closed form: an
up-pass combines each node's own forecast (variance w) with the sum of its
children's estimates (variance sum v_child) by inverse-variance weighting,
and a down-pass hands each parent's final value back to its children in
proportion to their v.  No summing matrix and no solve, for any number of
series and days.

All rows of one (day, model[, cutoff]) are brought together once; a step of a
pass is a window over a parent and its children inside that partitioning, so
the eight steps are sorts without a further shuffle.  A window holds the
children of one node; days x models x cutoffs spread the work.

``structural_weights`` gives wls_struct (w = number of leaves under the
node); ``baseline.residual_variances`` gives wls_var, per cutoff where asked.
``nonnegative`` clips leaves at 0 and sums up again (coherent and
non-negative, not the constrained optimum).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_DEPTH = 4
KEYS = ["ds", "model_id"]


def _depth():
    return F.regexp_count(F.col("unique_id"), F.lit("/"))


def _parent():
    return F.regexp_extract(F.col("unique_id"), r"^(.*)/[^/]*$", 1)


def structural_weights(bridge: DataFrame) -> DataFrame:
    """w = number of bottom series under each node (from the bridge table)."""
    return bridge.groupBy("unique_id").agg(F.count(F.lit(1)).cast("double").alias("w"))


def wls_tree(fc: DataFrame, weights: DataFrame, suffix: str = "/WLS", extra_keys: list[str] | None = None,
             nonnegative: bool = False) -> DataFrame:
    """``weights``: unique_id, w and any of the keys that w depends on.  ``extra_keys``
    (e.g. ``["cutoff"]``) reconcile every backtest window on its own, as further
    group keys rather than a loop."""
    keys = KEYS + list(extra_keys or [])
    width = int(fc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = fc.join(weights, [c for c in weights.columns if c != "w"]).select(
        "unique_id", *keys, "yhat", F.col("w").alias("v"), _depth().alias("depth"), _parent().alias("parent"))
    rows = rows.withColumn("est", F.col("yhat")).withColumn("w", F.col("v")).repartition(width, *keys)

    def family(d):
        """A node at depth d - 1 and its children (any other row: alone)."""
        return Window.partitionBy(*keys, F.when(F.col("depth") == d, F.col("parent")).otherwise(F.col("unique_id")))

    child = lambda d, c: F.sum(F.when(F.col("depth") == d, F.col(c))).over(family(d))
    for d in range(MAX_DEPTH, 0, -1):
        rows = rows.withColumns({"se": child(d, "est"), "sv": child(d, "v")})
        mine = (F.col("depth") == d - 1) & F.col("sv").isNotNull()
        v = 1.0 / (1.0 / F.col("w") + 1.0 / F.col("sv"))
        rows = rows.select("unique_id", *keys, "yhat", "w", "depth", "parent",
                           F.when(mine, v * (F.col("yhat") / F.col("w") + F.col("se") / F.col("sv"))).otherwise(F.col("est")).alias("est"),
                           F.when(mine, v).otherwise(F.col("v")).alias("v"))
    for d in range(1, MAX_DEPTH + 1):
        above = F.max(F.when(F.col("depth") == d - 1, F.col("est"))).over(family(d))
        rows = rows.withColumns({"above": above, "se": child(d, "est"), "sv": child(d, "v")})
        mine = (F.col("depth") == d) & F.col("above").isNotNull()
        rows = rows.withColumn("est", F.when(mine, F.col("est") + F.col("v") / F.col("sv") * (F.col("above") - F.col("se")))
                               .otherwise(F.col("est")))
    out = rows.select("unique_id", *keys, F.col("est").alias("yhat"))
    if nonnegative:
        out = clip_nonnegative(out, keys)
    return out.withColumn("model_id", F.concat("model_id", F.lit(suffix)))


def ancestors(unique_id):
    """All prefixes of a path, itself included."""
    parts = F.split(unique_id, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def clip_nonnegative(reconciled: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Leaves clipped at 0, every node re-summed from its leaves."""
    keys = keys or KEYS
    leaves = reconciled.filter(_depth() == MAX_DEPTH).select(
        F.explode(ancestors(F.col("unique_id"))).alias("unique_id"), *keys, F.greatest("yhat", F.lit(0.0)).alias("yhat"))
    return leaves.groupBy("unique_id", *keys).agg(F.sum("yhat").alias("yhat"))
