"""Classification and date-rule column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Activity band labels and day edges.
ACTIVITY_LABELS = ["Never Active", "Active (< 30 days)", "Inactive (30-60 days)",
                   "Inactive (60-90 days)", "Inactive (> 90 days)"]

# Backtest horizon buckets (first day, last day, label).
HORIZON_BUCKETS = [(1, 28, "01-28d"), (29, 91, "29-91d"), (92, 182, "92-182d")]

# Lifecycle classes and the 5 % ratio.
LIFECYCLE_RATIO = 0.05


def days_since(ts, now) -> Column:
    """Whole elapsed days, truncated (23:00 -> 01:00 next day is 0); null if never."""
    return F.timestamp_diff("DAY", _c(ts), _c(now))


def activity_band(last_activity, now) -> Column:
    last, now = _c(last_activity), _c(now)
    return (F.when(last.isNull(), F.lit(ACTIVITY_LABELS[0]))
            .when(last >= now - F.expr("INTERVAL 30 DAYS"), F.lit(ACTIVITY_LABELS[1]))
            .when(last >= now - F.expr("INTERVAL 60 DAYS"), F.lit(ACTIVITY_LABELS[2]))
            .when(last >= now - F.expr("INTERVAL 90 DAYS"), F.lit(ACTIVITY_LABELS[3]))
            .otherwise(F.lit(ACTIVITY_LABELS[4])))


def horizon_bucket(days_ahead) -> Column:
    d = _c(days_ahead)
    expr = None
    for lo, hi, label in HORIZON_BUCKETS:
        expr = (F.when(d.between(lo, hi), F.lit(label)) if expr is None
                else expr.when(d.between(lo, hi), F.lit(label)))
    return expr


def lifecycle_class(before, after) -> Column:
    """shutdown / launch / increase / decrease, tested in that order."""
    b, a = _c(before), _c(after)
    return (F.when(a < b * LIFECYCLE_RATIO, F.lit("shutdown"))
            .when(b < a * LIFECYCLE_RATIO, F.lit("launch"))
            .when(a > b, F.lit("increase"))
            .otherwise(F.lit("decrease")))


def fiscal_year(ds) -> Column:
    """September-start financial year: FY2026 = 1 Sep 2025 .. 31 Aug 2026."""
    d = _c(ds)
    return F.year(d) + F.when(F.month(d) >= 9, 1).otherwise(0)


def fiscal_year_start(ds) -> Column:
    return F.make_date(fiscal_year(ds) - 1, F.lit(9), F.lit(1))


_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?)?$"


def parse_iso_ts(text) -> Column:
    """ISO-8601 date or date and time, with an optional fraction of a second and
    an optional ``Z`` or numeric offset; bad text -> null."""
    t = F.trim(_c(text))
    with_colon = F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2")
    stamp = F.when(t.contains(":"), with_colon).otherwise(t)
    return F.when(t.rlike(_ISO), stamp.try_cast("timestamp"))


def parse_iso_strict(text) -> Column:
    """As ``parse_iso_ts``, but text that is no ISO time fails the job (null stays null)."""
    t = _c(text)
    parsed = parse_iso_ts(t)
    return F.when(t.isNotNull() & parsed.isNull(), F.raise_error(F.concat(F.lit("not an ISO time: "), t)).cast("timestamp")).otherwise(parsed)


def horizon_label(ds, today) -> Column:
    """``FY2026 actual``, ``FY2026 to go`` (rest of the current fiscal year) or ``FY2027 plan``."""
    d, t = _c(ds), _c(today)
    part = F.when(d <= t, "actual").when(fiscal_year(d) == fiscal_year(t), "to go").otherwise("plan")
    return F.concat(F.lit("FY"), fiscal_year(d).cast("string"), F.lit(" "), part)
