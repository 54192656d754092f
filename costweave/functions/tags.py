"""Tag and hierarchy column expressions (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's hierarchy convention.
SERVICE_ID_KEY = "Service_ID"
LEVELS = ["division", "platform", "workload", "component"]
TOTAL_LABEL = "total"
UNTAGGED = "Untagged"
UNTAGGED_ID = "Untagged/Untagged/Untagged/Untagged"
LEVEL_NAMES = ["total", "division", "platform", "workload", "component"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def service_id(tags="Tags", key: str = SERVICE_ID_KEY) -> Column:
    """`$.Service_ID` from JSON tag text.

    Valid iff present and containing exactly three slashes (empty parts such
    as ``a///d`` are valid); malformed JSON, missing key and wrong part
    counts all map to the Untagged bucket.
    """
    sid = F.get_json_object(_c(tags), f"$.{key}")
    valid = sid.isNotNull() & (F.regexp_count(sid, F.lit("/")) == len(LEVELS) - 1)
    return F.when(valid, sid).otherwise(F.lit(UNTAGGED_ID))


def split_path(path, names=LEVELS, offset: int = 0) -> list[Column]:
    """``a/b/c/d`` -> one column per name; ``get`` yields null past the end."""
    parts = F.split(_c(path), "/")
    return [F.get(parts, F.lit(i + offset)).alias(n) for i, n in enumerate(names)]


def depth(unique_id="unique_id") -> Column:
    return F.regexp_count(_c(unique_id), F.lit("/"))


def level_name(unique_id="unique_id") -> Column:
    """Depth (slash count) -> level name; an unknown depth is an error."""
    d = depth(unique_id)
    expr = F.when(d == 0, F.lit(LEVEL_NAMES[0]))
    for i, name in enumerate(LEVEL_NAMES[1:], start=1):
        expr = expr.when(d == i, F.lit(name))
    return expr.otherwise(F.raise_error(F.concat(F.lit("unknown hierarchy depth: "), _c(unique_id))))


def with_hierarchy_cols(df, unique_id: str = "unique_id"):
    """Adds ``level`` plus the four path columns (null below the node's depth)."""
    return df.select("*", level_name(unique_id).alias("level"),
                     *split_path(unique_id, LEVELS, offset=1))


def is_tagged(tags="tags") -> Column:
    """Tags present and not the text ``null`` or ``{}``."""
    t = _c(tags)
    return t.isNotNull() & (t != F.lit("null")) & (t != F.lit("{}"))
