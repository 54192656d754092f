"""Balanced contiguous shards from global prefix sums, DataFrame operations only.

Rows are range-partitioned and their partition is recorded; a window inside each
partition gives running bytes and counts, the partitions' totals (one row a
partition) give what lies before each.  The global prefix sum cuts the sequence
at equal byte targets: shard ``k`` of ``n`` holds the rows whose first byte is in
``[k, k+1) * total / n``.

Rows are in order of (group, id, size, checksum), the group being a hash of the text,
so copies of a text lie side by side and at most ``n - 1`` groups meet a cut.  Such a
group stays whole in the shard of its first row if it has at most a ``1 / WHOLE`` part of
a shard's bytes; only a larger one (a hot group may exceed a shard) is cut where the
target says.  Shards differ from the target by less than that part and one row at either end.

Texts don't travel: the exchange carries group, id, size and checksum.

Defined cases: a null text has no bytes; null ids come first; rows that
repeat are rows of their own; an empty table has no shards.  Columns of the input
called shard or slot are replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, fresh, shuffle_width

SHARDS = 16
WHOLE = 64                       # a group of up to a 64th of a shard is never split


def shard(sized: DataFrame, shards: int = SHARDS, order: tuple[str, ...] = ("text_group", "doc_id", "size", "text_crc32"),
          size: str = "size", group: str | None = "text_group") -> DataFrame:
    """All columns plus ``shard`` and ``slot`` (place in the shard); sizes positive.  ``group``
    leads ``order``; without one (None) rows are cut wherever the target falls."""
    spark = sized.sparkSession
    sized = sized.drop("shard", "slot")
    given = [F.col(f"`{c}`") for c in sized.columns]
    part, start, row, place, nbytes, nrows, total, before, above, own, home = (
        fresh([*sized.columns, "shard", "slot"], c) for c in
        ("part_", "start_", "row_", "place_", "bytes_", "rows_", "total_", "bytes_before_", "rows_before_", "group_", "home_"))
    ranged = sized.repartitionByRange(shuffle_width(spark), *order)
    ranged = cut_lineage(ranged.withColumn(part, F.spark_partition_id()))
    inside = Window.partitionBy(part).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn(start, F.coalesce(F.sum(size).over(upto), F.lit(0))).withColumn(
        row, F.row_number().over(inside).cast("long") - 1)
    totals = ranged.groupBy(part).agg(F.sum(size).alias(nbytes), F.count(F.lit(1)).alias(nrows))
    # a row for each partition, so one task and a broadcast hold them
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(part, F.coalesce(F.sum(nbytes).over(earlier), F.lit(0)).alias(before),
                           F.coalesce(F.sum(nrows).over(earlier), F.lit(0)).alias(above),
                           F.sum(nbytes).over(Window.partitionBy()).alias(total))
    rows = rows.join(F.broadcast(totals), part)
    # in decimals: bytes times shards may pass 2**63
    cut = F.floor((F.col(start) + F.col(before)).cast("decimal(20,0)") * shards / F.col(total))
    rows = rows.select(*given, F.least(cut.cast("int"), F.lit(shards - 1)).alias("shard"), (F.col(row) + F.col(above)).alias(place),
                       F.col(total))
    rows = cut_lineage(rows)
    if group is not None:
        # groups that meet a cut: fewer than there are shards
        met = rows.groupBy(F.col(group).alias(own)).agg(F.min("shard").alias(home), F.max("shard").alias("last"),
                                                       F.sum(size).alias(nbytes), F.first(total).alias(total))
        small = F.col(nbytes).cast("decimal(20,0)") * shards * WHOLE <= F.col(total)
        met = met.filter((F.col(home) < F.col("last")) & small).select(own, home)
        rows = rows.join(F.broadcast(met), F.col(group).eqNullSafe(F.col(own)), "left").select(
            *given, F.coalesce(home, "shard").alias("shard"), place)
    first = rows.groupBy("shard").agg(F.min(place).alias(start))            # a row for each shard
    return rows.join(F.broadcast(first), "shard").withColumn("slot", F.col(place) - F.col(start)).select(*given, "shard", "slot")


def sized_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_group"))
