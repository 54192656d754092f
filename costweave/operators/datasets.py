"""The dataset registry: how the landed JSON pages of each dataset are read.

A dataset declares the schema of a record, the field of a page that holds
the records, and the flat columns.  Pages are read as text and parsed permissively
with that schema (no inference pass); a page that doesn't parse, or a record of which doesn't
fit the declared types, or that has no record array, goes to a quarantine frame with the reason and
its text, all others become typed rows.  Both frames come from one scan each
of the page files, which is the parallel form of the reference's paging loop.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import landing as L

CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Dataset:
    name: str
    record: str                                     # schema of a record
    array: str                                      # field of the page with the records
    fields: dict[str, str]                          # flat column -> path in the record
    casts: dict[str, str] = field(default_factory=dict)     # of free-text columns

    def page_schema(self) -> str:
        return f"{self.array} array<struct<{self.record}>>, {CORRUPT} string"


DATASETS = {d.name: d for d in [
    Dataset("resources",
            "id: string, name: string, type: string, location: string, subscriptionId: string, sku: struct<name: string>, "
            "zones: array<string>, identity: struct<type: string>, tags: struct<env: string>, size: string",
            "data",
            {"id": "id", "name": "name", "type": "type", "location": "location", "subscriptionId": "subscriptionId",
             "sku": "sku.name", "zones": "zones", "identity_type": "identity.type", "tags": "tags", "size": "size"},
            {"size": "int"}),
    Dataset("seats",
            "assignee: struct<login: string, email: string>, organization: struct<login: string>, assigning_team: struct<name: string>, "
            "last_activity_at: string, last_activity_editor: string",
            "seats",
            {"user_login": "assignee.login", "user_email": "assignee.email", "organization": "organization.login",
             "assigning_team": "assigning_team.name", "last_activity_at": "last_activity_at",
             "last_activity_editor": "last_activity_editor"},
            {"last_activity_at": "timestamp_ntz"}),
]}


def dataset(name: str) -> Dataset:
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}, known: {sorted(DATASETS)}")
    return DATASETS[name]


def parse_pages(spark: SparkSession, path: str, ds: Dataset, multi_line: bool = False) -> DataFrame:
    """(page, source_file, p, reason): ``p`` is the parsed page, ``reason`` why it is quarantined.
    ``multi_line``: a page is a whole file, else a line."""
    pages = spark.read.text(path, wholetext=multi_line)
    parsed = F.from_json("value", ds.page_schema(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = pages.select(F.col("value").alias("page"), F.col("_metadata.file_path").alias("source_file"), parsed.alias("p"))
    reason = (F.when(F.trim("page") == "", "empty").when(F.col(f"p.{CORRUPT}").isNotNull() | F.col("p").isNull(), "malformed")
              .when(F.col(f"p.{ds.array}").isNull(), "no_records"))
    return rows.withColumn("reason", reason)


def land(spark: SparkSession, path: str, ds: Dataset, tenant: tuple[str, str], run_ts: str,
         multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of one tenant's pages, stamped with tenant and audit columns."""
    pages = parse_pages(spark, path, ds, multi_line)
    records = pages.filter(F.col("reason").isNull()).select(F.explode(F.col(f"p.{ds.array}")).alias("r"), "source_file")
    rows = L.flatten_record(records, {**{c: f"r.{p}" for c, p in ds.fields.items()}, "source_file": "source_file"})
    rows = L.cast_existing(L.stringify_nested(rows), ds.casts, text_source=True)
    rows = L.add_audit(L.stamp_tenant(rows, *tenant), run_ts)
    bad = pages.filter(F.col("reason").isNotNull()).select("reason", "page", "source_file")
    return rows, L.add_audit(L.stamp_tenant(bad, *tenant), run_ts)


def land_tenants(spark: SparkSession, tenants: dict[tuple[str, str], str], ds: Dataset, run_ts: str,
                 multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """All tenants' pages; ``tenants`` maps (id, label) to the folder of their pages."""
    each = [land(spark, path, ds, tenant, run_ts, multi_line) for tenant, path in tenants.items()]
    return L.union_tenants([r for r, _ in each]), L.union_tenants([q for _, q in each])


def page_counts(spark: SparkSession, tenants: dict[tuple[str, str], str], ds: Dataset, multi_line: bool = False) -> DataFrame:
    """Pages and records by tenant and outcome (landed or the reason of the quarantine)."""
    each = [L.stamp_tenant(parse_pages(spark, path, ds, multi_line), *tenant) for tenant, path in tenants.items()]
    records = F.when(F.col("reason").isNull(), F.size(F.col(f"p.{ds.array}"))).otherwise(0)
    return L.union_tenants([e.select("tenant_id", F.coalesce("reason", F.lit("landed")).alias("outcome"), records.alias("records"))
                            for e in each]).groupBy("tenant_id", "outcome").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("records").alias("records"))
