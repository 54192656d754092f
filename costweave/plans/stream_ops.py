"""Streams as queries: extracts land one after the other, each is drained with
``availableNow`` and the same checkpoint (a restart each time), and what the
sink holds at the end is the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import fixtures as X
from ..sources.store import TableStore
from ..sources.tables import scan_table
from ..streaming import streams as S
from . import oracle_adapters as O
from .registry import query

w = O.with_ctes


def _base(spark) -> str:
    return scratch_path(spark, "streams")


def _land(rows, extract: int, base: str):
    """One extract appended to the landing folder; the stream over that folder."""
    rows.filter(F.col("extract") == extract).drop("extract").write.mode("append").parquet(f"{base}/in")
    return S.read_folder(rows.sparkSession, f"{base}/in", rows.drop("extract").schema)


def _halves(rows, ts: str):
    """extract 0: the older half of the time span, extract 1: the newer one."""
    t = F.unix_timestamp(F.col(ts).cast("timestamp"))
    middle = rows.agg(((F.min(t) + F.max(t)) / 2).alias("m")).scalar()
    return rows.withColumn("extract", F.when(t < middle, 0).otherwise(1))


@query("stream_daily_cost", """
SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, event_type,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS cost, count(*) AS rows
FROM (SELECT *, date_trunc('day', ts)::TIMESTAMP AS w FROM events)
GROUP BY 1, 2, 3 HAVING w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def q_stream_daily_cost(spark, root):
    """Windows that the watermark (one day behind the newest event) has closed."""
    base = _base(spark)
    events = _halves(scan_table(spark, root, "events", ["ts", "event_type", "value"]), "ts")
    for extract in (0, 1):
        S.drain(S.stream_daily_cost(_land(events, extract, base)), f"{base}/ckpt", f"{base}/out")
    out = spark.read.parquet(f"{base}/out")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_activity_sessions", """
WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER o <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts
           FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events
FROM s GROUP BY user_id, nth HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_stream_activity_sessions(spark, root):
    """Sessions per user (30 minutes without an event end one) that the watermark has closed."""
    base = _base(spark)
    events = _halves(scan_table(spark, root, "events", ["user_id", "ts"]), "ts")
    for extract in (0, 1):
        S.drain(S.stream_activity_sessions(_land(events, extract, base)), f"{base}/ckpt", f"{base}/out")
    out = spark.read.parquet(f"{base}/out")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query("stream_latest_snapshot", w(("usage", O.USAGE_HOURLY)) + """
SELECT subscription_id, hour_utc, tenant_id, CAST(hourly_charge AS DOUBLE) AS hourly_charge, currency_code,
       snapshot_date, ingestion_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY subscription_id, hour_utc
                                   ORDER BY snapshot_date DESC, ingestion_timestamp DESC) AS rn FROM usage)
WHERE rn = 1""")
def q_stream_latest_snapshot(spark, root):
    """Newest snapshot per (subscription, hour), the rows arriving up to two
    days out of order and the stream restarted in between."""
    base = _base(spark)
    usage = X.usage_hourly(spark, root)
    late = F.pmod(F.xxhash64("subscription_id", "hour_utc", "snapshot_date"), F.lit(3)).cast("int")
    t = F.unix_date(F.date_add("snapshot_date", late))
    middle = usage.agg(F.floor((F.min(F.unix_date("snapshot_date")) + F.max(F.unix_date("snapshot_date"))) / 2)).scalar()
    usage = usage.withColumn("extract", F.when(t < middle, 0).otherwise(1))
    store = TableStore(spark, f"{base}/store")
    sink = S.newest_sink(store, "usage", ["usage_day", "subscription_id", "hour_utc"], ["usage_day"])
    for extract in (0, 1):
        stream = S.stream_latest_snapshot(_land(usage, extract, base), ["subscription_id", "hour_utc"],
                                          ["snapshot_date", "ingestion_timestamp"], "ingestion_timestamp")
        S.drain(stream.withColumn("usage_day", F.to_date("hour_utc")), f"{base}/ckpt", sink, "update")
    out = store.read("usage").drop("usage_day")
    return out.withColumns({"hourly_charge": F.col("hourly_charge").cast("double"),
                            "ingestion_timestamp": F.col("ingestion_timestamp").cast("timestamp_ntz")})


AS_OF = "2024-02-01 00:00:00"


@query("stream_gates", w(("usage", O.USAGE_HOURLY)) + f"""
, u AS (SELECT subscription_id, hour_utc, CASE WHEN day(hour_utc) <= 10 THEN 0 WHEN day(hour_utc) <= 20 THEN 1 ELSE 2 END AS batch_id
        FROM usage WHERE snapshot_date = CAST(hour_utc AS DATE))
, b AS (SELECT batch_id, subscription_id, min(hour_utc) AS first_ts, max(hour_utc) AS last_ts, count(*) AS n FROM u GROUP BY 1, 2)
, s AS (SELECT x.*, (SELECT max(y.last_ts) FROM b y WHERE y.subscription_id = x.subscription_id AND y.batch_id < x.batch_id) AS seen FROM b x)
, r AS (SELECT batch_id, CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, count(*) FILTER (first_ts > seen + INTERVAL 1 HOUR) AS gap_keys FROM s GROUP BY 1)
, f AS (SELECT r.*, (SELECT max(last_ts) FROM b WHERE b.batch_id <= r.batch_id) AS newest FROM r)
SELECT batch_id, rows, keys, newest, TIMESTAMP '{AS_OF}' AS as_of,
       CASE WHEN date_diff('day', newest, TIMESTAMP '{AS_OF}') > 2 THEN 'STALE' ELSE 'FRESH' END AS freshness,
       gap_keys, CASE WHEN gap_keys > 0 THEN 'GAP' ELSE 'CONTINUOUS' END AS continuity FROM f""")
def q_stream_gates(spark, root):
    """Freshness and continuity of three extracts (days 1-10, 11-20 and the rest of the
    months); the last one is handled twice, as after a failure."""
    base = _base(spark)
    usage = X.usage_hourly(spark, root).filter(F.col("snapshot_date") == F.to_date("hour_utc")).select("subscription_id", "hour_utc")
    day = F.dayofmonth("hour_utc")
    usage = usage.withColumn("extract", F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2))
    store = TableStore(spark, f"{base}/store")
    handle = S.gate_batches(store, "gates", ["subscription_id"], "hour_utc", F.lit(AS_OF).cast("timestamp"))
    for extract in (0, 1, 2):
        S.drain(_land(usage, extract, base), f"{base}/ckpt", handle)
    handle(usage.filter(F.col("extract") == 2).drop("extract"), 2)          # a replayed batch
    out = store.read("gates")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("newest", "as_of")}).withColumn(
        "batch_id", F.col("batch_id").cast("long"))
