"""Flagship: FOCUS fact -> Service_ID -> daily -> zero fill -> five levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tags import with_hierarchy_cols
from ..operators import hierarchy as H
from ..session import cut_lineage
from ..sources.fixtures import focus
from .oracle_adapters import FLAGSHIP_CTES, FOCUS, DAILY_SERVICE, FILLED, SERVICE_ID_EXPR, with_ctes
from .registry import query

_FLAG = with_ctes(*FLAGSHIP_CTES)


@query("hierarchy_rollup", _FLAG + "SELECT * FROM hier")
def q_hierarchy_rollup(spark, root):
    return H.hierarchy_series(focus(spark, root))


@query("daily_by_service", with_ctes(("focus", FOCUS)) +
       f"SELECT ds, service_id, CAST(y AS DOUBLE) AS y FROM ({DAILY_SERVICE})")
def q_daily_by_service(spark, root):
    d = H.daily_by_service(focus(spark, root))
    return d.select("ds", "service_id", F.col("y").cast("double").alias("y"))


@query("service_id_tags", with_ctes(("focus", FOCUS)) +
       f"SELECT {SERVICE_ID_EXPR} AS service_id, count(*) AS n_rows, "
       "CAST(sum(BilledCost) AS DOUBLE) AS cost FROM focus GROUP BY 1")
def q_service_id(spark, root):
    from ..functions.tags import service_id
    return (focus(spark, root).groupBy(service_id("Tags").alias("service_id"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("BilledCost").cast("double").alias("cost")))


@query("scaffold_zero_fill", with_ctes(("focus", FOCUS), ("daily", DAILY_SERVICE)) +
       f"SELECT service_id, ds, CAST(y AS DOUBLE) AS y FROM ({FILLED})")
def q_zero_fill(spark, root):
    z = H.zero_fill(cut_lineage(H.daily_by_service(focus(spark, root))))     # feeds three branches
    return z.select("service_id", "ds", F.col("y").cast("double").alias("y"))


@query("with_hierarchy_cols", _FLAG +
       """SELECT DISTINCT unique_id,
            CASE length(unique_id) - length(replace(unique_id, '/', ''))
              WHEN 0 THEN 'total' WHEN 1 THEN 'division' WHEN 2 THEN 'platform'
              WHEN 3 THEN 'workload' WHEN 4 THEN 'component' END AS level,
            CASE WHEN length(unique_id) - length(replace(unique_id, '/', '')) >= 1 THEN split_part(unique_id, '/', 2) END AS division,
            CASE WHEN length(unique_id) - length(replace(unique_id, '/', '')) >= 2 THEN split_part(unique_id, '/', 3) END AS platform,
            CASE WHEN length(unique_id) - length(replace(unique_id, '/', '')) >= 3 THEN split_part(unique_id, '/', 4) END AS workload,
            CASE WHEN length(unique_id) - length(replace(unique_id, '/', '')) >= 4 THEN split_part(unique_id, '/', 5) END AS component
          FROM hier""")
def q_with_hierarchy_cols(spark, root):
    ids = H.hierarchy_series(focus(spark, root)).select("unique_id").distinct()
    out = with_hierarchy_cols(ids)
    return out.select("unique_id", "level", "division", "platform", "workload", "component")


@query("hierarchy_bridge", _FLAG +
       """SELECT DISTINCT h.unique_id, 'total/' || f.service_id AS bottom_id
          FROM (SELECT DISTINCT service_id FROM filled) f
          JOIN (SELECT DISTINCT unique_id FROM hier) h
            ON ('total/' || f.service_id) = h.unique_id OR starts_with('total/' || f.service_id, h.unique_id || '/')""")
def q_hierarchy_bridge(spark, root):
    return H.hierarchy_bridge(H.daily_by_service(focus(spark, root)))


@query("untagged_share", with_ctes(("focus", FOCUS), ("daily", DAILY_SERVICE)) +
       """SELECT CAST(round(sum(CASE WHEN service_id = 'Untagged/Untagged/Untagged/Untagged' THEN y ELSE 0 END) * 100
                 / sum(y), 4) AS DOUBLE) AS untagged_pct FROM daily""")
def q_untagged_share(spark, root):
    return H.untagged_share(H.daily_by_service(focus(spark, root)))
