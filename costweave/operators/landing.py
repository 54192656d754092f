"""Landing (bronze) operators: API pages landed as JSON files -> typed rows.

The reference pages through REST APIs in a driver loop; here every page
is a landed file and ``spark.read.json`` reads all pages in parallel with a
declared schema (no inference pass), then ``explode`` unnests the record
array.  Nothing is collected to the driver.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH_RE = r"^\d{4}-(0[1-9]|1[0-2])$"


def land_pages(spark: SparkSession, path: str, page_schema: T.StructType, array_col: str) -> DataFrame:
    """Pages of JSON records -> one row per record, with the source file."""
    pages = spark.read.schema(page_schema).option("multiLine", "true").json(path)
    return pages.select(F.explode(F.col(array_col)).alias("_r"), F.input_file_name().alias("source_file")) \
        .select("_r.*", "source_file")


def stamp_tenant(df: DataFrame, tenant_id: str, tenant_label: str) -> DataFrame:
    return df.withColumns({"tenant_id": F.lit(tenant_id), "tenant_label": F.lit(tenant_label)})


def union_tenants(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def add_audit(df: DataFrame, run_ts: str, source_file: str | Column | None = None,
              snapshot_date: str | None = None) -> DataFrame:
    """ingestion_timestamp / source_file / snapshot_date.  ``run_ts`` is passed
    in once per run (never ``current_timestamp()`` per call), so a rerun of
    the same run writes identical rows."""
    cols = {"ingestion_timestamp": F.lit(run_ts).cast("timestamp_ntz")}
    if source_file is not None:
        cols["source_file"] = F.lit(source_file) if isinstance(source_file, str) else source_file
    cols["snapshot_date"] = F.lit(snapshot_date or run_ts[:10]).cast("date")
    return df.withColumns(cols)


def batch_id(run_ts: str) -> str:
    """``batch_yyyyMMdd_HHmmss`` from an ISO run timestamp."""
    digits = re.sub(r"[^0-9]", "", run_ts)[:14]
    return f"batch_{digits[:8]}_{digits[8:14]}"


def cast_existing(df: DataFrame, casts: dict[str, str], text_source: bool = False) -> DataFrame:
    """Cast columns that exist; ``try_cast`` when the source is free text."""
    def conv(c):
        if c not in casts:
            return F.col(c)
        return (F.col(c).try_cast(casts[c]) if text_source else F.col(c).cast(casts[c])).alias(c)
    return df.select(*[conv(c) for c in df.columns])


def stringify_nested(df: DataFrame) -> DataFrame:
    """Struct / array / map columns -> JSON text, empty -> null; dates -> ISO."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType)):
            c = F.when(F.size(c) > 0, F.to_json(c))
        elif isinstance(f.dataType, T.StructType):
            j = F.to_json(c)
            c = F.when(j != "{}", j)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def flatten_record(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """``{out_name: 'a.b.c'}`` -> null-safe nested field access."""
    return df.select(*[F.col(path).alias(name) for name, path in spec.items()])


def explode_nested(df: DataFrame, parent_cols: list[str], array_col: str) -> DataFrame:
    """Parent row x each element of ``array_col``; parent ids repeated."""
    return df.select(*parent_cols, F.explode(array_col).alias("_e")).select(*parent_cols, "_e.*")


def explode_alternatives(df: DataFrame, header_cols: list[str], alts: str, recommended: str,
                         amount_field: str = "commitmentAmount") -> DataFrame:
    """One row per alternative commitment level, header repeated,
    ``is_recommended = alt.amount == recommended``."""
    e = df.select(*header_cols, F.col(recommended).alias("_rec"), F.explode(alts).alias("_a"))
    return e.select(*header_cols, "_a.*", (F.col(f"_a.{amount_field}") == F.col("_rec")).alias("is_recommended"))


def hourly_from_array(df: DataFrame, keys: list[str], first_hour: str, charges: str,
                      total_hours: str | None = None) -> DataFrame:
    """Packed hourly array + first timestamp -> (hour_utc, charge) rows.
    A declared length that disagrees with the array fails the job."""
    if total_hours is not None:
        # a filter on the assertion keeps it in the plan (a projected-away
        # column would be pruned by the optimizer and never evaluated)
        df = df.filter(F.assert_true(F.col(total_hours) == F.size(charges),
                                     F.lit("totalHours does not match the charges array length")).isNull())
    e = df.select(*keys, first_hour, F.posexplode(charges).alias("_pos", "hourly_charge"))
    return e.select(*keys, (F.col(first_hour) + F.make_interval(hours=F.col("_pos").cast("int"))).alias("hour_utc"),
                    "hourly_charge")


def two_grain_landing(a: DataFrame, a_grain: str, b: DataFrame, b_grain: str) -> DataFrame:
    return a.withColumn("grain", F.lit(a_grain)).unionByName(b.withColumn("grain", F.lit(b_grain)),
                                                             allowMissingColumns=True)


def resolve_months(df: DataFrame, mode: str, month_col: str = "report_month") -> DataFrame:
    """Which months to (re)load: "" -> the last two available; "all"; or a
    ``YYYY-MM`` that is available (else an empty frame).  Bad text raises."""
    months = df.select(month_col).distinct()
    if mode == "all":
        return months
    if mode == "":
        # top-2 of a tiny distinct set; the limit is the feature
        return months.orderBy(F.col(month_col).desc()).limit(2)
    if not re.match(MONTH_RE, mode):
        raise ValueError(f"month must be YYYY-MM, got {mode!r}")
    return months.filter(F.date_format(month_col, "yyyy-MM") == mode)


def normalise_headers(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """``Table[Column]`` / ``[alias]`` headers -> bare names, then an optional
    rename map.  Works on the name list only (no data pass)."""
    names = [re.sub(r"^.*\[(.+)\]$", r"\1", c) for c in df.columns]
    names = [(rename or {}).get(n, n) for n in names]
    return df.toDF(*names)


def select_available(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select(*[c for c in wanted if c in df.columns])


PLACEHOLDER_ID = "00000000-0000-0000-0000-000000000000"


def select_tenants(config: DataFrame, requested: list[str] | None = None) -> DataFrame:
    """Configured tenants with a real id (not the placeholder GUID), filtered
    to the requested labels; an unknown requested label is an error.
    ``config`` has (tenant_id, label)."""
    usable = config.filter(F.col("tenant_id").isNotNull() & (F.col("tenant_id") != PLACEHOLDER_ID))
    if not requested:
        return usable
    req = usable.sparkSession.createDataFrame([(r,) for r in requested], "label string")
    unknown = [r.label for r in req.join(config, "label", "left_anti").collect()]   # a handful of names
    if unknown:
        raise ValueError(f"unknown tenants: {sorted(unknown)}")
    return usable.join(req, "label", "left_semi")
