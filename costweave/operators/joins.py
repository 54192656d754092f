"""Equi-joins used by the products.

No join is hinted here: adaptive execution broadcasts a side whose measured
size is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def star_enrich(fact: DataFrame, dims: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """fact LEFT JOIN each (dimension, keys); dimensions must be unique on keys."""
    out = fact
    for dim, keys in dims:
        out = out.join(dim, keys, "left")
    return out


def continuity_join(prior: DataFrame, new: DataFrame, keys: list[str], ts: str,
                    how: str = "inner") -> DataFrame:
    """Prior max per key vs new min per key.  ``inner`` as the reference
    (vanished keys not reported); ``full_outer`` exposes them."""
    p = prior.groupBy(*keys).agg(F.max(ts).alias("prior_max"))
    n = new.groupBy(*keys).agg(F.min(ts).alias("new_min"))
    return p.join(n, keys, how)


def lookup_default(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, value: str,
                   out: str, default: str = "Unknown") -> DataFrame:
    """Lower-cased id -> name via a left join, missing -> default."""
    lk = lookup.select(F.lower(F.col(lookup_key)).alias("_lk"), F.col(value).alias("_lv")).dropDuplicates(["_lk"])
    j = df.join(lk, F.lower(F.col(key)) == F.col("_lk"), "left")
    return j.withColumn(out, F.coalesce(F.col("_lv"), F.lit(default))).drop("_lk", "_lv")


def normalise_service_id(c):
    return F.upper(F.trim(c))


def directory_resolve(requests: DataFrame, directory: DataFrame, key: str = "service_id") -> DataFrame:
    """Bulk ServiceID lookup: trimmed + upper-cased match, exists flag + attributes."""
    d = directory.select(normalise_service_id(F.col("ServiceID")).alias("_sid"),
                         F.col("PlatformID").alias("platform_id"), F.col("DivisionID").alias("division_id"),
                         F.col("CostCentre").alias("cost_centre"))
    j = requests.join(d, normalise_service_id(F.col(key)) == F.col("_sid"), "left")
    return j.select(*requests.columns, F.col("_sid").isNotNull().alias("exists"),
                    "platform_id", "division_id", "cost_centre")


# Environments the tag gate accepts.
ALLOWED_ENVIRONMENTS = ["dev", "test", "qa", "staging", "prod"]


def tag_gate(requests: DataFrame, directory: DataFrame, key: str = "service_id",
             env: str = "environment") -> DataFrame:
    """Validate (ServiceID, environment) pairs in bulk: rejected rows carry a
    reason, accepted rows the rendered tag block."""
    r = directory_resolve(requests, directory, key)
    e = F.lower(F.trim(F.col(env)))
    env_ok = e.isin(*ALLOWED_ENVIRONMENTS)
    reason = (F.when(~env_ok, F.concat(F.lit("environment not allowed: "), F.coalesce(F.col(env), F.lit(""))))
              .when(~F.col("exists"), F.concat(F.lit("service id does not resolve: "), F.col(key))))
    rendered = F.format_string("tags: {\n  ServiceID: '%s'\n  Environment: '%s'\n}",
                               normalise_service_id(F.col(key)), e)
    return r.select(*requests.columns, reason.isNull().alias("accepted"), reason.alias("reason"),
                    F.when(reason.isNull(), rendered).alias("tag_block"))


def schema_contract(expected: DataFrame, live: DataFrame) -> DataFrame:
    """Expected (table, column) pairs absent from the live schema."""
    return expected.join(live, ["table_name", "column_name"], "left_anti")


def schema_frame(spark, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, data_type) rows from DataFrame schemas
    (driver-side metadata only; no data is read)."""
    rows = [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")
