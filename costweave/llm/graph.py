"""Connected components of a link table, by contraction.

Every vertex hooks to its smallest neighbour (or itself); hooks are
followed to their roots by pointer doubling; links are renamed by roots and
those inside a component vanish.  The link table at least halves its
vertices each round, rounds are written to the checkpoint folder, and a hub
with very many links costs one partial aggregate per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _roots(hooks: DataFrame) -> DataFrame:
    """(v, c) with c the last vertex on v's chain of hooks."""
    while True:
        onward = hooks.select(F.col("v").alias("c"), F.col("c").alias("next")).filter("c <> next")
        step = cut_lineage(hooks.join(onward, "c", "left").select("v", F.coalesce("next", "c").alias("c"),
                                                                 F.col("next").isNotNull().alias("moved")))
        hooks = step.select("v", "c")
        if step.filter("moved").isEmpty():
            return hooks


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, c): the smallest vertex that links reach, for each vertex with a link
    to another."""
    spark = links.sparkSession
    links = cut_lineage(links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
                        .filter("a <> b").distinct())
    found = spark.range(0).select(F.col("id").alias("v"), F.col("id").alias("c"))
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("c"))
        roots = _roots(cut_lineage(hooks))
        renamed = roots.select(F.col("v").alias("c"), F.col("c").alias("root"))
        # vertices met before follow their component; new ones are added
        found = cut_lineage(found.join(renamed, "c", "left").select("v", F.coalesce("root", "c").alias("c"))
                            .unionByName(roots.join(found.select("v"), "v", "left_anti")))
        links = cut_lineage(links.join(roots.select(F.col("v").alias("a"), F.col("c").alias("ca")), "a")
                            .join(roots.select(F.col("v").alias("b"), F.col("c").alias("cb")), "b")
                            .filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    return found
