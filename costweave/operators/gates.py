"""Data-quality gates.

Every gate is a DataFrame of violations (an aggregate over the data, so it
scales with the data and runs as one job); ``enforce`` raises when a gate
frame is non-empty.  Only the tiny violation frame ever reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class GateError(RuntimeError):
    pass


def enforce(violations: DataFrame, name: str, sample: int = 5) -> None:
    """Raise with a small sample when the gate found anything."""
    if not violations.isEmpty():
        rows = violations.limit(sample).collect()
        raise GateError(f"{name} failed: {rows}")


def continuity_gate(prior: DataFrame, new: DataFrame, keys: list[str], ts: str,
                    max_gap: str = "1 HOUR") -> DataFrame:
    """Keys whose new data starts more than ``max_gap`` after the prior
    data ends (prior max per key inner join new min per key)."""
    p = prior.groupBy(*keys).agg(F.max(ts).alias("prior_max"))
    n = new.groupBy(*keys).agg(F.min(ts).alias("new_min"))
    j = p.join(n, keys)
    return j.filter(F.col("new_min") > F.col("prior_max") + F.expr(f"INTERVAL {max_gap}"))


def freshness_gate(df: DataFrame, date_col: str, snapshot_date, max_days: int = 2,
                   source: str = "source") -> DataFrame:
    """One report row: newest date, lag in days, STALE / FRESH."""
    snap = F.lit(snapshot_date).cast("date") if isinstance(snapshot_date, str) else snapshot_date
    r = df.agg(F.max(date_col).alias("newest_date"))
    lag = F.datediff(snap, F.col("newest_date"))
    return r.select(F.lit(source).alias("source"), "newest_date", snap.alias("snapshot_date"),
                    lag.alias("lag_days"),
                    F.when(F.col("newest_date").isNull() | (lag > max_days), F.lit("STALE"))
                    .otherwise(F.lit("FRESH")).alias("status"))


def stale(report: DataFrame) -> DataFrame:
    return report.filter(F.col("status") == "STALE")


def length_gate(df: DataFrame, declared: str, array_col: str, keys: list[str]) -> DataFrame:
    return df.filter(F.col(declared) != F.size(array_col)).select(
        *keys, declared, F.size(array_col).alias("array_length"))


def all_empty_gate(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count; the gate fails when all are 0."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
              for n, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)


def rule_report(df: DataFrame, rules: dict[str, Column], non_empty: str | None = None) -> DataFrame:
    """``rules`` maps a name to a per-row *violation* predicate; one pass
    counts each rule's violations.  ``non_empty`` names a further rule that a
    frame without rows violates once."""
    counts = {name: F.count_if(pred) for name, pred in rules.items()}
    if non_empty:
        counts[non_empty] = (F.count(F.lit(1)) == 0).cast("long")
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(name) for name, c in counts.items()])
    stack = F.expr("stack({n}, {pairs}) as (rule, violations)".format(
        n=len(counts), pairs=", ".join(f"'{k}', `{k}`" for k in counts)))
    return agg.select(F.col("_rows").alias("rows"), stack).select(
        "rule", "rows", F.col("violations").cast("long").alias("violations"),
        (F.col("violations") == 0).alias("passed"))


def error_array(rules: dict[str, Column]) -> Column:
    """Per-row list of failed rule names (the silver ``validation_errors``)."""
    arr = F.array(*[F.when(pred, F.lit(name)) for name, pred in rules.items()])
    return F.filter(arr, lambda x: x.isNotNull())


def validated(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Every row with ``validation_errors`` (names of the rules it breaks) and ``is_valid``."""
    return df.withColumn("validation_errors", error_array(rules)).withColumn("is_valid", F.size("validation_errors") == 0)


def verdict(rows: DataFrame, table: str) -> DataFrame:
    """One row over validated rows: PASSED only if there are rows and all are valid."""
    g = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_valid").alias("valid_rows"))
    return g.select(F.lit(table).alias("table_name"), "rows", "valid_rows",
                    F.round(F.try_divide(F.col("valid_rows") * 100.0, F.col("rows")), 2).alias("valid_pct"),
                    F.when(F.col("rows") == 0, "EMPTY").when(F.col("rows") == F.col("valid_rows"), "PASSED").otherwise("FAILED").alias("verdict"))


def rule_verdicts(rules: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row a rule: rows checked, violations, passed (something was checked and nothing found)."""
    each = [df.agg(F.count(F.lit(1)).alias("checked"), F.count_if(pred).alias("violations")).select(F.lit(name).alias("rule"), "*")
            for name, (df, pred) in rules.items()]
    return reduce(lambda a, b: a.unionByName(b), each).withColumn("passed", (F.col("checked") > 0) & (F.col("violations") == 0))


def all_empty_report(rows: DataFrame, table_col: str, expected: list[str]) -> DataFrame:
    """Rows of every expected table and whether all of them are empty, from one pass
    over the tables' union."""
    names = rows.sparkSession.createDataFrame([(n,) for n in expected], "table_name string")
    n = rows.groupBy(F.col(table_col).alias("table_name")).agg(F.count(F.lit(1)).alias("rows"))
    out = names.join(n, "table_name", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    # a row for each expected table
    return out.withColumn("all_empty", F.sum("rows").over(Window.partitionBy()) == 0)


def contract_report(df: DataFrame, table: str, contract: list[tuple]) -> DataFrame:
    """``contract``: (column, type, least, most), bounds as SQL literals or None.  One row a column: rows,
    nulls and values out of bounds counted in one pass over the table, and a status:
    missing, wrong_type, nulls, out_of_range or ok (the first that applies)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, (name, kind, least, most) in enumerate(contract):
        if name in types:
            bad = [b for b in (f"`{name}` < {least}" if least is not None else None, f"`{name}` > {most}" if most is not None else None) if b]
            aggs += [F.count_if(F.col(f"`{name}`").isNull()).alias(f"n{i}"),
                     F.count_if(F.expr(" OR ".join(bad)) if bad else F.lit(False)).alias(f"b{i}")]
        rows.append(F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("column_name"),
                             F.lit(types.get(name)).alias("live_type"), F.lit(kind).alias("expected_type"),
                             (F.col(f"n{i}") if name in types else F.lit(None).cast("long")).alias("nulls"),
                             (F.col(f"b{i}") if name in types else F.lit(None).cast("long")).alias("out_of_range")))
    out = df.agg(*aggs).select("rows", F.explode(F.array(*rows)).alias("c")).select("rows", "c.*")
    status = (F.when(F.col("live_type").isNull(), "missing").when(F.col("live_type") != F.col("expected_type"), "wrong_type")
              .when(F.col("nulls") > 0, "nulls").when(F.col("out_of_range") > 0, "out_of_range").otherwise("ok"))
    return out.withColumn("status", status)
