"""Structured Streaming forms of four batch products.

Sources are folders of Parquet files (landed exports); every query is
incremental with a watermark, so state is bounded by the lateness window
and not by history.  ``drain`` runs a query over what has landed and stops
(``availableNow``); called again with the same checkpoint it goes on where it
ended.  Sinks are safe to replay: a batch that is written twice leaves what
one write leaves.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from ..sources.store import TableStore

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_folder(spark: SparkSession, path: str, schema: StructType, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; landed exports carry wall-clock UTC as
    TIMESTAMP_NTZ, which the UTC session converts without shifting."""
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def drain(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | str, mode: str = "append",
          timeout: int = 900) -> None:
    """All that has landed since the checkpoint, to a folder or a ``foreachBatch`` function."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.foreachBatch(sink).start() if callable(sink) else w.format("parquet").option("path", sink).start()
    if not q.awaitTermination(timeout):
        q.stop()
        raise TimeoutError(f"stream still running after {timeout} s: {checkpoint}")


# ---------------------------------------------------------------- windows
def stream_daily_cost(events: DataFrame, ts: str = "ts", key: str = "event_type", value: str = "value",
                      lateness: str = "1 day") -> DataFrame:
    """Tumbling one-day windows per key; rows later than the watermark are
    dropped (Spark counts them in the progress metrics)."""
    return (event_time(events, ts).withWatermark(ts, lateness)
            .groupBy(F.window(ts, "1 day").alias("w"), F.col(key))
            .agg(F.sum(F.col(value).cast("decimal(18,2)")).alias("cost"), F.count(F.lit(1)).alias("rows"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key,
                    F.col("cost").cast("double").alias("cost"), "rows"))


def stream_activity_sessions(events: DataFrame, user: str = "user_id", ts: str = "ts",
                             gap: str = "30 minutes", lateness: str = "1 hour") -> DataFrame:
    """Activity sessions per user (session windows with an inactivity gap)."""
    return (event_time(events, ts).withWatermark(ts, lateness)
            .groupBy(F.session_window(ts, gap).alias("s"), F.col(user))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(user, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events"))


# ---------------------------------------------------------------- newest row per key
def stream_dedupe_snapshots(rows: DataFrame, keys: list[str], ts: str, lateness: str = "3 days") -> DataFrame:
    """Drop re-landed duplicates of (key, snapshot) within the watermark; the first stays."""
    return event_time(rows, ts).withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)


class KeepNewest(StatefulProcessor):
    """State of a bucket of keys: the newest row so far of each (times as microseconds).  A newer
    row replaces its key's and is emitted; an event-time timer drops rows from the state
    ``keep_ms`` after their own time.

    A call from Python into the state costs far more than the work on a row, so keys share
    one: a bucket's state is read and written once a batch, as one binary value, and has one timer at the time
    its first row goes."""

    def __init__(self, schema: StructType, keys: list[str], order: list[str], ts: str, keep_ms: int):
        self.names, self.keep_ms = schema.names, keep_ms
        names = schema.names
        self.ts = names.index(ts)
        self.keys = [names.index(c) for c in keys]
        # equal in all ordering columns: the larger row, so that any order of arrival ends alike
        self.rank = [names.index(c) for c in [*order, *[n for n in names if n not in order]]]

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "rows binary")

    def _read(self) -> dict:
        held = self.newest.get()
        return {} if held is None else {tuple(row[i] for i in self.keys): row for row in pickle.loads(bytes(held[0]))}

    def _write(self, rows: dict) -> None:
        if rows:
            self.newest.update((pickle.dumps(list(rows.values()), protocol=5),))
        else:
            self.newest.clear()

    def _order(self, row):
        return [(row[i] is not None, row[i]) if row[i] is not None else (False,) for i in self.rank]

    def _expiry(self, row) -> int | None:
        return None if row[self.ts] is None else row[self.ts] // 1000 + self.keep_ms

    def _first_expiry(self, rows: dict) -> int | None:
        return min((x for x in map(self._expiry, rows.values()) if x is not None), default=None)

    def handleInputRows(self, key, rows, timerValues):
        best, changed, at = self._read(), {}, None
        before = self._first_expiry(best)
        for row in rows:
            at = at or [row.__fields__.index(c) for c in self.names]
            row = tuple(row)
            row = tuple([row[i] for i in at])
            k = tuple([row[i] for i in self.keys])
            had = best.get(k)
            if had is None or (row != had and self._order(row) > self._order(had)):
                best[k] = changed[k] = row
        if changed:
            self._write(best)
            # a timer that finds only newer rows moves on to their time; one before it is needed for an older row
            first = self._first_expiry(best)
            if first is not None and (before is None or first < before):
                self.handle.registerTimer(first)
        for row in changed.values():
            yield Row(**dict(zip(self.names, row)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, rows = expiredTimerInfo.getExpiryTimeInMs(), self._read()
        # every row whose time has come by now, not only those of this timer
        now = max(now, timerValues.getCurrentWatermarkInMs())
        kept = {k: row for k, row in rows.items() if self._expiry(row) is None or self._expiry(row) > now}
        if len(kept) < len(rows):
            self._write(kept)
        first = self._first_expiry(kept)
        if first is not None:
            self.handle.registerTimer(first)
        return iter(())

    def close(self) -> None:
        pass


def stream_latest_snapshot(rows: DataFrame, keys: list[str], order: list[str], ts: str,
                           lateness: str = "3 days", keep_ms: int = 4 * 86_400_000, buckets: int = 16_384) -> DataFrame:
    """The newest row of each key as it changes (update mode): the streaming
    form of ``latest_per_key``.  ``ts`` is the time a snapshot was taken; rows more than
    ``lateness`` behind the newest one are late and dropped, state goes after ``keep_ms``.
    ``buckets`` (keys by hash) share a state value; a checkpoint keeps to the number it began with."""
    times = {f.name: f.dataType for f in rows.schema.fields if isinstance(f.dataType, (TimestampType, TimestampNTZType))}
    plain = rows.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in times})
    schema = plain.schema
    # arbitrary state lives in RocksDB: on disk, so not bounded by the executors' memory
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    stream = plain.withColumn("_event_time", F.timestamp_micros(ts)).withWatermark("_event_time", lateness)
    stream = stream.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    out = stream.groupBy("_bucket").transformWithState(KeepNewest(schema, keys, order, ts, keep_ms), schema, "Update", "eventTime")
    return out.withColumns({c: F.timestamp_micros(c).cast(t) for c, t in times.items()})


def newest_sink(store: TableStore, name: str, keys: list[str], partition_by: list[str] | None = None):
    """``foreachBatch``: changed rows replace those of the same key.  The same batch
    again writes the same rows."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        store.upsert(batch, name, keys, partition_by)
    return handle


# ---------------------------------------------------------------- gates
def gate_batches(store: TableStore, name: str, keys: list[str], ts: str, as_of: Column | None = None, max_days: int = 2,
                 max_gap: str = "1 HOUR"):
    """``foreachBatch``: one report row for each micro-batch, and the keys that have a gap.

    Freshness: newest time of all batches so far against ``as_of``, the clock passed in (an
    expression over the batch's ``newest`` column; by default that time itself), never the
    wall clock.  Continuity: a key whose first time in the batch lies more than ``max_gap`` after
    its last time in earlier batches has a gap.

    What earlier batches held is a table of one row a key, written by each batch to the
    slot of its number modulo 2 and read from the other, so a replayed batch finds
    the state it found at first.  Report and gaps are partitioned by batch and
    overwritten by partition: a replay leaves one report row.
    """
    state, gaps = f"{name}_state", f"{name}_gaps"

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = batch.groupBy(*keys).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("rows"))
        now = now.select(*keys, "first_ts", F.col("last_ts").cast("timestamp").alias("last_ts"), "rows")
        if store.exists(state):
            before = store.read(state).filter((F.col("slot") == (batch_id + 1) % 2) & (F.col("batch_id") == batch_id - 1))
        else:
            before = batch.sparkSession.createDataFrame([], StructType([*[now.schema[k] for k in keys], now.schema["last_ts"]]))
        both = now.join(before.select(*keys, F.col("last_ts").alias("seen_ts")), keys, "full_outer")
        gap = F.col("first_ts") > F.col("seen_ts") + F.expr(f"INTERVAL {max_gap}")
        both = both.select(*keys, "first_ts", "seen_ts", F.greatest("last_ts", "seen_ts").alias("last_ts"), "rows",
                           F.coalesce(gap, F.lit(False)).alias("gap"), F.lit(batch_id).cast("long").alias("batch_id"))
        both = both.persist()               # feeds three writes
        found = both.filter("gap").select(*keys, "seen_ts", F.col("first_ts").cast("timestamp").alias("first_ts"), "batch_id")
        store.replace_partition(found, gaps, ["batch_id"])
        report = both.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max("last_ts").alias("newest"),
                          F.count("rows").alias("keys"), F.count_if("gap").alias("gap_keys"))
        clock = (F.col("newest") if as_of is None else as_of).cast("timestamp")
        late = F.col("newest").isNull() | (F.datediff(clock, F.col("newest")) > max_days)
        report = report.select("rows", "keys", "newest", clock.alias("as_of"),
                               F.when(late, F.lit("STALE")).otherwise(F.lit("FRESH")).alias("freshness"), "gap_keys",
                               F.when(F.col("gap_keys") > 0, F.lit("GAP")).otherwise(F.lit("CONTINUOUS")).alias("continuity"),
                               F.lit(batch_id).cast("long").alias("batch_id"))
        store.replace_partition(report, name, ["batch_id"])
        # last: a batch that fails before this line finds the earlier state when it runs again
        store.replace_partition(both.select(*keys, "last_ts", "batch_id", F.lit(batch_id % 2).alias("slot")), state, ["slot"])
        both.unpersist()
    return handle
