import datetime as dt
import tempfile

from pyspark.sql import functions as F

from costweave.sources.store import TableStore
from costweave.streaming import streams as S
from tests.conftest import SF001


def _events_schema(spark):
    return spark.read.parquet(f"{SF001}/events.parquet").schema


def _run(df, fmt_path, mode="append"):
    q = (df.writeStream.format("parquet").option("path", fmt_path)
         .option("checkpointLocation", fmt_path + "_ckpt").outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination(300)


def test_daily_cost_stream_matches_batch(spark):
    out = tempfile.mkdtemp(prefix="cw-stream-") + "/daily"
    ev = S.read_folder(spark, SF001, _events_schema(spark), glob="events.parquet")
    _run(S.stream_daily_cost(ev), out)
    got = spark.read.parquet(out)
    batch = (spark.read.parquet(f"{SF001}/events.parquet")
             .groupBy(F.to_date("ts").alias("d"), "event_type")
             .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("cost")))
    # append mode emits windows closed by the watermark: every emitted
    # window must equal the batch value; only the last day may be pending
    cmp = got.select(F.to_date("window_start").alias("d"), "event_type", F.col("cost").alias("c1")).join(
        batch.withColumnRenamed("cost", "c2"), ["d", "event_type"])
    assert cmp.count() == got.count() > 0
    assert cmp.filter(F.abs(F.col("c1") - F.col("c2")) > 1e-6).count() == 0
    assert batch.count() - got.count() <= 10   # windows ending after the watermark (last 2 days x 5 types) stay open


def test_sessions(spark):
    base = tempfile.mkdtemp(prefix="cw-stream-")
    ev = S.read_folder(spark, SF001, _events_schema(spark), glob="events.parquet")
    _run(S.stream_activity_sessions(ev), base + "/sessions")
    s = spark.read.parquet(base + "/sessions")
    total = spark.read.parquet(f"{SF001}/events.parquet").count()
    assert 0 < s.agg(F.sum("events")).first()[0] <= total


def test_gate_report_survives_replay_and_carries_state(spark):
    base = tempfile.mkdtemp(prefix="cw-stream-")
    store = TableStore(spark, base + "/store")
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    batches = [[("a", at(1, 0)), ("a", at(1, 5)), ("b", at(1, 2))], [("a", at(1, 6)), ("b", at(1, 9))], [], [("a", at(1, 8)), ("c", at(2, 0))]]
    frames = [spark.createDataFrame(b, "k string, ts timestamp") for b in batches]
    handle = S.gate_batches(store, "gates", ["k"], "ts", F.lit("2024-01-05").cast("timestamp"), max_days=2)
    report = lambda: {r.batch_id: (r.rows, r.keys, r.newest, r.freshness, r.gap_keys, r.continuity) for r in store.read("gates").collect()}
    want = {0: (3, 2, at(1, 5), "STALE", 0, "CONTINUOUS"), 1: (2, 2, at(1, 9), "STALE", 1, "GAP"),
            2: (0, 0, at(1, 9), "STALE", 0, "CONTINUOUS"), 3: (2, 2, at(2, 0), "STALE", 1, "GAP")}
    for n, frame in enumerate(frames):
        handle(frame, n)
        handle(frame, n)                                       # the same batch again
        assert report() == {k: v for k, v in want.items() if k <= n}
    assert store.read("gates").count() == 4
    assert sorted((r.batch_id, r.k) for r in store.read("gates_gaps").collect()) == [(1, "b"), (3, "a")]
    fresh = S.gate_batches(store, "other", ["k"], "ts", F.lit("2024-01-03").cast("timestamp"), max_days=2)
    fresh(frames[3], 0)
    assert store.read("other").first().freshness == "FRESH"


def test_newest_row_per_key_out_of_order_and_across_a_restart(spark):
    from costweave.operators.windows import latest_per_key
    base = tempfile.mkdtemp(prefix="cw-stream-")
    schema = "k string, hour timestamp, v double, snap timestamp"
    hour = dt.datetime(2024, 1, 1)
    rows = [(f"k{i % 7}", hour + dt.timedelta(hours=i % 5), float(i), hour + dt.timedelta(hours=(i * 37) % 60)) for i in range(200)]
    rows += [("k0", hour, 1.0, hour + dt.timedelta(hours=70)), ("k0", hour, 2.0, hour + dt.timedelta(hours=70)), ("k9", hour, None, hour)]
    store = TableStore(spark, base + "/store")
    sink = S.newest_sink(store, "newest", ["day", "k", "hour"], ["day"])
    for part in (rows[::2], rows[1::2][:30], rows[1::2][30:]):      # three landings, each drained by a new query
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(base + "/in")
        stream = S.stream_latest_snapshot(S.read_folder(spark, base + "/in", spark.createDataFrame([], schema).schema),
                                          ["k", "hour"], ["snap"], "snap", "5 days")
        S.drain(stream.withColumn("day", F.to_date("hour")), base + "/ckpt", sink, "update")
    want = latest_per_key(spark.createDataFrame(rows, schema), ["k", "hour"], ["snap", "v"])
    read = lambda df: sorted((r.k, r.hour, str(r.v), r.snap) for r in df.collect())
    assert read(store.read("newest")) == read(want)


def test_dedupe_snapshots(spark):
    base = tempfile.mkdtemp(prefix="cw-stream-")
    src = base + "/in"
    df = spark.createDataFrame([("s1", "2024-01-01 00:00:00", 1.0), ("s1", "2024-01-01 00:00:00", 1.0),
                                ("s2", "2024-01-01 01:00:00", 2.0)], "sub string, hour string, v double") \
        .withColumn("hour", F.col("hour").cast("timestamp"))
    df.write.parquet(src)
    st = spark.readStream.schema(df.schema).parquet(src)
    _run(S.stream_dedupe_snapshots(st, ["sub", "hour"], "hour"), base + "/out")
    assert spark.read.parquet(base + "/out").count() == 2


def test_newest_rows_share_state_and_lose_it_one_by_one(spark):
    """Keys in one bucket: dates and decimals outlive a restart, a key's state ends by its own time."""
    import decimal
    base = tempfile.mkdtemp(prefix="cw-stream-")
    schema = "k string, d date, v decimal(18,4), n long, snap timestamp"
    at = lambda day, h=0: dt.datetime(2024, 1, day, h)
    row = lambda k, day, v, n=None: (k, dt.date(2024, 1, day), decimal.Decimal(v), n, at(day))
    landings = [[row("a", 1, "1.5"), row("b", 3, "2", 2**53 + 1), row(None, 3, "7"), row("c", 3, "4")],
                [row("a", 2, "2.5"), row("b", 2, "9"), row("c", 3, "4"), row("c", 3, "3"), row("d", 9, "1")],     # the watermark moves to day 7
                [row("b", 8, "5", 1), row("d", 7, "6"), row("e", 9, "8")]]
    seen = []
    for part in landings:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(base + "/in")
        read = S.read_folder(spark, base + "/in", spark.createDataFrame([], schema).schema)
        stream = S.stream_latest_snapshot(read, ["k"], ["d"], "snap", "2 days", 3 * 86_400_000, buckets=1)
        out = []
        S.drain(stream, base + "/ckpt", lambda b, i, out=out: out.extend(map(tuple, b.collect())), "update")
        seen.append(sorted(out, key=str))
    assert seen == [sorted(landings[0], key=str), sorted([row("a", 2, "2.5"), row("d", 9, "1")], key=str),
                    sorted([row("b", 8, "5", 1), row("e", 9, "8")], key=str)]


def test_calls_into_the_state_do_not_grow_with_the_keys():
    """A bucket's rows are read and written once and share a timer."""
    from collections import Counter
    from pyspark.sql import Row
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    calls, held = Counter(), {}

    class State:
        def get(self): calls["get"] += 1; return held.get("v")
        def update(self, v): calls["update"] += 1; held["v"] = v
        def clear(self): calls["clear"] += 1; held.pop("v", None)

    class Handle:
        def getValueState(self, name, schema): return State()
        def registerTimer(self, ms): calls["timer"] += 1; held["timer"] = ms

    class At:
        def __init__(self, ms): self.ms = ms
        def getExpiryTimeInMs(self): return self.ms
        def getCurrentWatermarkInMs(self): return self.ms

    schema = StructType([StructField("k", StringType()), StructField("t", LongType())])
    keep = S.KeepNewest(schema, ["k"], ["t"], "t", 10)
    keep.init(Handle())
    out = list(keep.handleInputRows((0,), iter([Row(_bucket=0, k=f"k{i}", t=1000 * (100 + i)) for i in range(500)]), None))
    assert len(out) == 500 and calls == {"get": 1, "update": 1, "timer": 1} and held["timer"] == 110
    list(keep.handleExpiredTimer((0,), At(359), At(359)))
    assert len(keep._read()) == 250 and held["timer"] == 360       # those up to 349 + 10 are gone, the next one's time is set
    list(keep.handleExpiredTimer((0,), At(1000), At(1000)))
    assert not keep._read() and "v" not in held
