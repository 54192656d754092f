"""Tables as plain folders: one path per table, written with Spark's own modes.

* ``write_overwrite``: static overwrite, the whole table is replaced.
* ``write_merge_schema``: the same, with stored columns that the frame lacks
  as typed nulls.
* ``replace_partition``: dynamic partition overwrite - only the partition
  values present in the frame are replaced, in one job for all of them;
  ``append_snapshot`` and ``replace_run_date`` are this by a fixed column, so
  a rerun never doubles rows.
* ``save_append_merge``: append; a column that only some files have reads as
  null elsewhere.
* ``upsert``: rows of the stored table whose key is not in the new frame
  (``left_anti``) plus the new frame.  Where the keys hold the partition
  columns only the touched partitions are rewritten.
* ``compact``: rewrite by range, sorted within files.

A writer that reads the table it replaces works from a copy in the shared
checkpoint folder (``cut_lineage``), so a failed write can be run again.
Every writer keeps the partition columns a table has; a partition writer with
other columns raises.  Paths go to Spark as they are: any store it can open
will do, and nothing is opened or listed on the driver's own disk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import cut_lineage

ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class TableStore:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def path(self, name: str) -> str:
        return f"{self.root}/{name.lower()}"

    def exists(self, name: str) -> bool:
        try:
            self.read(name)
        except AnalysisException as e:
            if e.getCondition() in ABSENT:
                return False
            raise
        return True

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.fmt).option("mergeSchema", "true").load(self.path(name))

    def partition_columns(self, name: str) -> list[str] | None:
        """Partition columns of the stored table, from the path of one of its
        files; None where there is no table or it has no rows."""
        if not self.exists(name):
            return None
        row = self.read(name).select("_metadata.file_path").first()
        if row is None:
            return None
        folders = row[0].split(f"/{name.lower()}/")[-1].split("/")[:-1]
        return [f.split("=")[0] for f in folders]

    # ---------------------------------------------------------------- writers
    def _write(self, df: DataFrame, name: str, mode: str, partition_by: list[str] | None, overwrite: str = "static") -> str:
        w = df.write.format(self.fmt).mode(mode).option("partitionOverwriteMode", overwrite)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(self.path(name))
        return self.path(name)

    def write_overwrite(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
        return self._write(df, name, "overwrite", partition_by)

    def align_schema(self, df: DataFrame, name: str) -> DataFrame:
        """New columns kept, stored-but-absent columns added as typed nulls."""
        if not self.exists(name):
            return df
        stored = self.read(name).schema
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in stored.fields if f.name not in df.columns]
        return df.select("*", *missing)

    def write_merge_schema(self, df: DataFrame, name: str) -> str:
        return self.write_overwrite(self.align_schema(df, name), name, self.partition_columns(name))

    def replace_partition(self, df: DataFrame, name: str, partition_by: list[str]) -> str:
        """Replace only the partitions present in ``df`` (created on first write)."""
        stored = self.partition_columns(name)
        if stored is not None and stored != list(partition_by):
            raise ValueError(f"{name} is partitioned by {stored}, not by {list(partition_by)}")
        return self._write(df, name, "overwrite", partition_by, "dynamic")

    def append_snapshot(self, df: DataFrame, name: str, snapshot_col: str = "snapshot_date") -> str:
        """Idempotent append: a same-day rerun replaces that day's snapshot."""
        return self.replace_partition(df, name, [snapshot_col])

    def replace_run_date(self, df: DataFrame, name: str, run_col: str = "run_date") -> str:
        """Rows of the run dates in ``df`` replaced, other runs kept."""
        return self.replace_partition(df, name, [run_col])

    def save_append_merge(self, df: DataFrame, name: str) -> str:
        """Append with schema merge; shared columns take the stored type."""
        if not self.exists(name):
            return self._write(df, name, "append", None)
        return self._write(self._as_stored(df, name), name, "append", self.partition_columns(name))

    def _as_stored(self, df: DataFrame, name: str) -> DataFrame:
        types = {f.name: f.dataType for f in self.read(name).schema.fields}
        return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])

    def upsert(self, df: DataFrame, name: str, keys: list[str], partition_by: list[str] | None = None) -> str:
        """Rows whose key is stored are replaced, others added.  Keys and partition
        values compare null-safe (a null is a value like any other); an empty
        string as partition value is stored as null, as Spark writes both to one folder.
        ``partition_by`` matters for the first write only."""
        if not self.exists(name):
            return self.write_overwrite(df, name, partition_by)
        parts = self.partition_columns(name) or []
        df = self._as_stored(df, name)
        text = [f.name for f in df.schema.fields if f.name in parts and isinstance(f.dataType, StringType)]
        df = cut_lineage(df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text}))
        old = self.read(name)
        touched = bool(parts) and set(parts) <= set(keys)
        if touched:
            old = _null_safe_join(old, df.select(*parts).distinct(), parts, "left_semi")
        keep = _null_safe_join(old, df.select(*keys), keys, "left_anti")
        rows = cut_lineage(keep.unionByName(df, allowMissingColumns=True))
        return self._write(rows, name, "overwrite", parts, "dynamic" if touched else "static")

    def compact(self, name: str, by: list[str], files: int) -> str:
        """Rewrite with range partitioning and sorted files (OPTIMIZE / ZORDER stand-in)."""
        parts = self.partition_columns(name)
        df = cut_lineage(self.read(name))
        return self.write_overwrite(df.repartitionByRange(files, *by).sortWithinPartitions(*by), name, parts)

    def register(self, name: str) -> int:
        """Catalog table over the table's folder; returns its row count."""
        self.spark.sql(f"DROP TABLE IF EXISTS `{name.lower()}`")
        self.spark.catalog.createTable(name.lower(), path=self.path(name), source=self.fmt, mergeSchema="true")
        if self.partition_columns(name):
            self.spark.catalog.recoverPartitions(name.lower())
        return self.spark.table(name.lower()).count()


def _null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    right = right.select(*[F.col(f"`{c}`").alias(f"_right_{i}") for i, c in enumerate(on)])
    return left.join(right, reduce(Column.__and__, [left[f"`{c}`"].eqNullSafe(F.col(f"_right_{i}")) for i, c in enumerate(on)]), how)


def guard_empty(df: DataFrame, policy: str) -> bool:
    """True when the write should go ahead: ``skip`` keeps the old table,
    ``write_empty_typed`` writes the typed empty frame, ``fail`` raises."""
    if not df.isEmpty():
        return True
    if policy == "skip":
        return False
    if policy == "write_empty_typed":
        return True
    raise RuntimeError("empty frame and policy=fail")


def written_counts(frame: DataFrame, table: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Per-partition counts of the frame and the written table, and whether they agree."""
    a = frame.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("frame_rows"))
    b = table.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("table_rows"))
    return a.join(b, partition_cols, "full_outer").withColumn(
        "matches", F.col("frame_rows").eqNullSafe(F.col("table_rows")))


def verify_written(frame: DataFrame, table: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Per-partition counts of the frame vs the written table; mismatches only."""
    return written_counts(frame, table, partition_cols).filter(~F.col("matches")).drop("matches")


def row_count_match(frame: DataFrame, table: DataFrame) -> DataFrame:
    """One row: rows of the frame, rows of the table, whether they agree."""
    both = frame.select(F.lit(1).alias("w"), F.lit(0).alias("r")).unionByName(
        table.select(F.lit(0).alias("w"), F.lit(1).alias("r")))
    counts = both.agg(F.count_if(F.col("w") == 1).alias("frame_rows"), F.count_if(F.col("r") == 1).alias("table_rows"))
    return counts.withColumn("matches", F.col("frame_rows") == F.col("table_rows"))
