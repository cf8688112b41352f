"""Streams with state and tables of versions: order across chunks and batches, late rows, restarts between write and commit."""

from __future__ import annotations

import random
import time
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorframe.operators import models
from sensorframe.sources import ingest
from sensorframe.sources.versions import VersionedTable
from sensorframe.streaming import streams
from tests.test_sources_streams import stream_of

T0 = datetime(2024, 3, 4)
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture(autouse=True)
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def run(df, name, tmp_path):
    streams.to_memory(df, name, str(tmp_path / f"c-{name}")).awaitTermination()
    return df.sparkSession.table(name)


ROOM = "room long, event_time timestamp, arrived timestamp, seq long, x double"


def room_by_hand(rows, until=None, idle=None):
    """(bucket, mean, samples) of the closed buckets and the number of late payloads, payload after payload."""
    held, closed, late, out = defaultdict(list), None, 0, []

    def close(before):
        nonlocal closed
        for b in sorted(b for b in held if b < before):
            v = held.pop(b)
            out.append((b, round(sum(v) / len(v), 9), len(v)))
            closed = b

    at = lambda t: int((t - T0).total_seconds())
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        slot = at(r[2]) // 10 * 10
        if until is not None and slot + 10 > until:
            break
        if idle is not None:
            close(slot - idle - 10 + 1)
        b = at(r[1]) // 10 * 10
        close(b)
        if closed is not None and b <= closed:
            late += 1
        else:
            held[b].append(r[4])
    if idle is not None:
        close(until - idle - 10 + 1)
    return sorted(out), late


def rooms(seed, n, step):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        arrived = T0 + timedelta(seconds=100 + i * step)
        out.append((1, arrived - timedelta(seconds=rng.choice([0, 0, 0, 1, 4, 12, 35])), arrived, i, float(rng.randrange(1000))))
    return out


def bucketed(table):
    rows = table.collect()
    got = sorted((int((r["bucket"] - T0).total_seconds()), round(r["x"], 9), r["samples"]) for r in rows if r["bucket"])
    return got, max((r["late"] for r in rows), default=0)


def test_a_busy_room_in_one_shuffled_batch(spark, tmp_path):
    rows = rooms(1, 25_000, 0.1)
    mixed = rows[:]
    random.Random(2).shuffle(mixed)
    got, late = bucketed(run(streams.room_buckets_in_order(stream_of(spark, tmp_path, [mixed], ROOM), ["x"]), "busy", tmp_path))
    want, lost = room_by_hand(rows)
    assert got == want and late == lost > 1000
    assert sum(n for _, _, n in got) + late > 24_900


def test_rooms_do_not_depend_on_batches(spark, tmp_path):
    rows = rooms(3, 1200, 0.7)
    rng = random.Random(4)
    near = sorted(rows, key=lambda r: r[3] + rng.uniform(0, 40))  # out of order by up to 28 seconds
    batches = [near[:500], near[500:520], near[520:900], near[900:]]
    df = streams.room_buckets_in_order(stream_of(spark, tmp_path, batches, ROOM), ["x"], clock="arrived", wait="40 seconds")
    until = int((max(r[2] for r in rows) - T0).total_seconds()) - 40
    got, late = bucketed(run(df, "rooms", tmp_path))
    assert (got, late) == room_by_hand(rows, until) and late > 50


def test_buckets_and_late_payloads_come_out_though_nothing_follows(spark, tmp_path):
    at = lambda s: T0 + timedelta(seconds=s)
    # room 1 falls silent after a late payload; room 2 goes on, so the clock does
    one = [(1, at(0), at(0), 0, 1.0), (1, at(11), at(12), 1, 2.0), (1, at(3), at(14), 2, 9.0)]
    two = [(2, at(s), at(s), 10 + s, 0.0) for s in range(0, 200, 5)]
    df = streams.room_buckets_in_order(stream_of(spark, tmp_path, [one + two[:8], two[8:20], two[20:]], ROOM), ["x"], clock="arrived", idle=30)
    out = [r for r in run(df, "silent", tmp_path).collect() if r["room"] == 1]
    assert sorted((int((r["bucket"] - T0).total_seconds()), r["x"], r["samples"]) for r in out if r["bucket"]) == [(0, 1.0, 1), (10, 2.0, 1)]
    assert max(r["late"] for r in out) == 1 and sum(r["samples"] for r in out) == 2
    with pytest.raises(ValueError):
        streams.room_buckets_in_order(spark.createDataFrame([], ROOM), ["x"], idle=5)


UPDATE = "device_id long, event_time timestamp, seq long, state string, level string"


def filled_by_hand(rows):
    known, out = {}, []
    for d, t, seq, *values in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        last = known.setdefault(d, [None, None])
        known[d] = [v if v is not None else o for v, o in zip(values, last, strict=True)]
        out.append((d, seq, *known[d]))
    return sorted(out)


def updates(n, seed):
    rng = random.Random(seed)
    return [(1 + i % 2, T0 + timedelta(seconds=i // 3), i, rng.choice([None, None, "on", "off"]), rng.choice([None, str(i)])) for i in range(n)]


def test_updates_of_a_busy_device_are_in_order(spark, tmp_path):
    rows = updates(24_000, 5)
    mixed = rows[:]
    random.Random(6).shuffle(mixed)
    got = run(streams.carry_forward_stream(stream_of(spark, tmp_path, [mixed], UPDATE), ["state", "level"]), "updates", tmp_path)
    assert sorted((r["device_id"], r["seq"], r["state"], r["level"]) for r in got.collect()) == filled_by_hand(rows)


def test_updates_wait_for_earlier_ones_of_later_batches(spark, tmp_path):
    rows = updates(900, 7)
    rng = random.Random(8)
    near = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 100))
    df = streams.carry_forward_stream(stream_of(spark, tmp_path, [near[:300], near[300:650], near[650:]], UPDATE), ["state", "level"], wait="60 seconds")
    got = sorted((r["device_id"], r["seq"], r["state"], r["level"]) for r in run(df, "waited", tmp_path).collect())
    until = T0 + timedelta(seconds=(899 // 3 - 60) // 10 * 10)
    assert got == filled_by_hand([r for r in rows if r[1] < until]) and len(got) > 600


READ = "zone_id long, timestamp timestamp, seq long, x double, y double"


def test_live_tail_equals_the_batch(spark, tmp_path):
    rng = random.Random(9)
    at = lambda s: T0 + timedelta(seconds=s)
    rows = [(z, at(10 * i), i, None if rng.random() < 0.2 else rng.gauss(z, 1), float("nan") if rng.random() < 0.1 else rng.random()) for z in (1, 2) for i in range(120) if not (z == 2 and 60 <= i < 95)]
    known = [(z, at(10 * i + 3), str(rng.randrange(2))) for z in (1, 2) for i in range(0, 120, 17)]
    history = spark.createDataFrame([(z, t.replace(tzinfo=None), x or 0.0, 0.0 if y != y else y, int(x is not None and x > 1.5)) for z, t, _, x, y in rows], "zone_id long, timestamp timestamp_ntz, x double, y double, occupied int")
    fitted = models.fit_occupancy(models.window_features(history, ["x", "y"], 6, ["zone_id"]), ["x", "y"])
    fitted.write().overwrite().save(str(tmp_path / "model"))
    model = PipelineModel.load(str(tmp_path / "model"))
    batches = [[r for r in rows if lo <= r[2] < hi] for lo, hi in ((0, 30), (30, 31), (31, 90), (90, 120))]
    readings = stream_of(spark, tmp_path, [*batches, [(9, at(9000), 1, 0.0, 0.0)]], READ)  # a last row brings the watermark past the others
    (tmp_path / "l").mkdir()
    labels = stream_of(spark, tmp_path / "l", [[k for k in known if lo <= (k[1] - T0).total_seconds() / 10 < hi] for lo, hi in ((0, 40), (40, 120))], "zone_id long, label_time timestamp, label string")
    tail = streams.live_tail(readings, labels, ["x", "y"], 6, {"x": 0.7, "y": 0.5}, wait="1300 seconds", grid=10, most_gap=60)
    columns = ["zone_id", "timestamp", "rows", "full", "gate_ok", "in_order", "label", *models.model_columns(["x", "y"])]
    got = {(r["zone_id"], r["timestamp"]): r for r in run(models.predict(model, tail, columns, None), "tail", tmp_path).collect()}
    clean = spark.createDataFrame([(z, t, s, x, None if y != y else y) for z, t, s, x, y in rows], READ).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    want = {(r["zone_id"], r["timestamp"]): r for r in models.predict(model, models.window_features(clean, ["x", "y"], 6, ["zone_id"]), ["zone_id", "timestamp", *models.model_columns(["x", "y"])], None).collect()}
    full = {k: r for k, r in got.items() if r["full"]}
    assert len(got) == len(rows) and full.keys() == want.keys()
    for k, r in full.items():
        assert all(abs(r[c] - want[k][c]) < 1e-9 for c in ["probability", *models.model_columns(["x", "y"])])
    for (z, t), r in got.items():
        own = [q for q in rows if q[0] == z and q[1] <= t][-6:]
        gaps = [(b[1] - a[1]).total_seconds() for a, b in zip(own, own[1:], strict=False)]
        assert r["gate_ok"] == (sum(q[3] is not None for q in own) / len(own) >= 0.7 and sum(q[4] == q[4] for q in own) / len(own) >= 0.5)
        assert r["in_order"] == (not gaps or max(gaps) <= 60)
        assert r["label"] == max(((k[1], k[2]) for k in known if k[0] == z and k[1] <= t + timedelta(seconds=9)), default=(None, None))[1]


DAYS = T.StructType([T.StructField("at", T.TimestampNTZType()), T.StructField("device", T.LongType()), T.StructField("temp", T.DoubleType()), T.StructField("label", T.LongType())])
SPARSE = "at timestamp_ntz, device long, temp double, label long, seq long"


def by_day(spark, path):
    return VersionedTable(spark, str(path), DAYS, F.col("at").cast("date"))


def test_merge_touches_only_the_days_of_the_batch(spark, tmp_path):
    table = by_day(spark, tmp_path / "t")
    merge = streams.merge_days(table, ["at", "device"], "seq", "s")
    row = lambda day, device, temp, label, seq: (T0 + timedelta(days=day), device, temp, label, seq)
    merge(spark.createDataFrame([row(0, 1, 1.0, None, 1), row(1, 1, 2.0, None, 2), row(2, 1, 3.0, None, 3)], SPARSE), 0)
    before = table.current().parts
    merge(spark.createDataFrame([row(1, 1, None, 7, 1), row(1, 2, 5.0, None, 2), row(1, 1, 4.0, None, 3)], SPARSE), 1)
    after = table.current().parts
    assert {p for p in after if after[p] != before[p]} == {"2024-03-05"} and before.keys() == after.keys()
    rows = sorted(tuple(r) for r in table.read().collect())
    assert rows == [(T0, 1, 1.0, None), (T0 + timedelta(days=1), 1, 4.0, 7), (T0 + timedelta(days=1), 2, 5.0, None), (T0 + timedelta(days=2), 1, 3.0, None)]
    merge(spark.createDataFrame([row(1, 1, 99.0, 9, 1)], SPARSE), 1)  # played again
    assert sorted(tuple(r) for r in table.read().collect()) == rows and table.current().number == 1


def test_a_crash_before_the_swap_loses_nothing(spark, tmp_path, monkeypatch):
    table = by_day(spark, tmp_path / "t")
    merge = streams.merge_days(table, ["at", "device"], "seq", "s")
    one = spark.createDataFrame([(T0, 1, 1.0, None, 1)], SPARSE)
    merge(one, 0)
    with monkeypatch.context() as m:
        m.setattr(table, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            merge(spark.createDataFrame([(T0, 1, None, 5, 1)], SPARSE), 1)
    assert [tuple(r) for r in table.read().collect()] == [(T0, 1, 1.0, None)]
    merge(spark.createDataFrame([(T0, 1, None, 5, 1)], SPARSE), 1)
    assert [tuple(r) for r in table.read().collect()] == [(T0, 1, 1.0, 5)]
    table.keep = 1
    assert len(table.clean()) == 2 and [tuple(r) for r in table.read().collect()] == [(T0, 1, 1.0, 5)] and table.clean() == []


def test_two_writers_cannot_commit_one_version(spark, tmp_path):
    a, b = by_day(spark, tmp_path / "t"), by_day(spark, tmp_path / "t")
    old = b.current()
    a.commit(a.current(), {}, "a", 0)
    with pytest.raises(Exception, match="exist"):
        b.commit(old, {}, "b", 0)
    assert a.current().batches == {"a": 0} and not [n for n in a.files.names(f"{a.base}/versions") if n.endswith(".draft")]


BUCKETS = T.StructType([T.StructField("bucket", T.TimestampType()), T.StructField("zone", T.LongType()), T.StructField("n", T.LongType())])


def started(df, sink, checkpoint, trigger=None):
    return df.writeStream.foreachBatch(sink).option("checkpointLocation", str(checkpoint)).trigger(**(trigger or {"availableNow": True})).start()


def test_a_stream_stopped_between_write_and_commit(spark, tmp_path, monkeypatch):
    batches = [[(T0 + timedelta(hours=h + 7 * k), z, h) for h in range(8) for z in range(3)] for k in range(4)]  # each begins with the last bucket of the one before
    df = stream_of(spark, tmp_path, batches, "bucket timestamp, zone long, n long")
    make = lambda: VersionedTable(spark, str(tmp_path / "t"), BUCKETS, F.col("bucket").cast("date"))
    want = sorted({(r[0], r[1]) for b in batches for r in b})
    stop = {"write": 1, "after": 2}

    class Stopping(VersionedTable):
        def commit(self, old, parts, stream, batch):
            if stop.get("write") == batch:  # folders are there, the manifest is not
                del stop["write"]
                raise RuntimeError("stopped before the commit")
            out = super().commit(old, parts, stream, batch)
            if stop.get("after") == batch:  # the manifest is there, Spark's checkpoint does not know
                del stop["after"]
                raise RuntimeError("stopped after the commit")
            return out

    for _ in range(3):
        table = Stopping(spark, str(tmp_path / "t"), BUCKETS, F.col("bucket").cast("date"))
        q = started(df, streams.append_once(table, ["bucket", "zone"], ["n"], "x07"), tmp_path / "c")
        try:
            q.awaitTermination()
        except Exception as e:
            assert "stopped" in str(e)
    assert not stop
    got = make().read().collect()
    assert sorted((r["bucket"], r["zone"]) for r in got) == want and make().current().batches == {"x07": 3}
    # a new checkpoint reads everything again and adds nothing
    started(df, streams.append_once(make(), ["bucket", "zone"], ["n"], "again"), tmp_path / "c2").awaitTermination()
    assert make().read().count() == len(want)


MESSAGE = "timestamp timestamp, topic string, payload string"


def test_two_sinks_take_a_batch_once(spark, tmp_path):
    at = lambda i: T0 + timedelta(seconds=i)
    batches = [[(at(10 * k + i), "air_7", '{"co2":1}' if i % 3 else "{broken") for i in range(9)] for k in range(3)]
    df = stream_of(spark, tmp_path, batches, MESSAGE)
    parse = lambda m: ingest.parse_messages(m, {"air": ["co2"]})
    schema = T.StructType([T.StructField("timestamp", T.TimestampType()), T.StructField("topic", T.StringType()), T.StructField("payload", T.StringType()), T.StructField("device_type", T.StringType())])
    letters = T.StructType([T.StructField("timestamp", T.TimestampType()), T.StructField("device", T.StringType()), T.StructField("payload", T.StringType()), T.StructField("reason", T.StringType())])

    class Failing(VersionedTable):
        left = 1

        def append(self, rows, stream="", batch=None):
            if batch == 1 and Failing.left:
                Failing.left -= 1
                raise RuntimeError("stopped between the sinks")
            return super().append(rows, stream, batch)

    good, bad = VersionedTable(spark, str(tmp_path / "good"), schema), Failing(spark, str(tmp_path / "bad"), letters)
    sink = streams.two_sinks(good, bad, parse, "s10")
    with pytest.raises(Exception, match="stopped between"):
        started(df, sink, tmp_path / "c").awaitTermination()
    assert good.current().batches == {"s10": 1} and bad.current().batches == {"s10": 0}
    started(df, sink, tmp_path / "c").awaitTermination()
    assert good.read().count() == 18 and bad.read().count() == 9 and {r["reason"] for r in bad.read().collect()} == {"unparseable payload"}
    sink(spark.createDataFrame(batches[2], MESSAGE), 2)  # played again
    assert good.read().count() == 18 and bad.read().count() == 9


def ticking(df, sink, checkpoint, until):
    """Run with a trigger by the clock until something holds, for 150 seconds at most."""
    q, end = started(df, sink, checkpoint, {"processingTime": "1 second"}), time.time() + 150
    try:
        while time.time() < end and not until(q) and q.exception() is None:
            time.sleep(0.5)
        assert q.exception() is None
    finally:
        q.stop()


STAGE = T.StructType([T.StructField("table", T.StringType()), T.StructField("k", T.LongType()), T.StructField("seq", T.LongType())])


def test_buffers_flush_by_rows_and_by_age(spark, tmp_path):
    src = tmp_path / "in"
    put = lambda k, rows: spark.createDataFrame(rows, STAGE).coalesce(1).write.parquet(str(src / f"b{k}"))
    put(0, [("full", i, i) for i in range(499)] + [("old", 1, 1000)])
    df = spark.readStream.schema(STAGE).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(src))
    table = VersionedTable(spark, str(tmp_path / "t"), STAGE, F.col("table"))
    sink = streams.flush_to(table, ["table", "k"], ["seq"], "s13")
    staged = streams.staged_rows(df, "table", 500, 3600)
    ticking(staged, sink, tmp_path / "c", lambda q: len(q.recentProgress) > 2)
    assert table.read().count() == 0  # 499 rows wait
    put(1, [("full", 7, 2000), ("full", 5000, 2001)])
    ticking(staged, sink, tmp_path / "c", lambda q: table.read().count() > 0)  # a restart: state goes on
    got = table.read().collect()
    assert len(got) == 500 and {r["table"] for r in got} == {"full"} and {r["seq"] for r in got if r["k"] == 7} == {7}
    ticking(staged, sink, tmp_path / "c", lambda q: len(q.recentProgress) > 2)
    assert table.read().count() == 500  # what was handed over is gone from the state, what waits stays
    # by age
    aged = VersionedTable(spark, str(tmp_path / "t2"), STAGE, F.col("table"))
    ticking(streams.staged_rows(df, "table", 10_000, 4), streams.flush_to(aged, ["table", "k"], ["seq"], "s13"), tmp_path / "c2", lambda q: aged.read().count() >= 501)
    assert sorted((r["table"], r["k"]) for r in aged.read().collect()) == sorted([("old", 1), ("full", 5000), *(("full", i) for i in range(499))])


def test_batches_of_streams_are_several_files(spark, tmp_path, monkeypatch):
    from sensorframe.plans import queries_streams

    monkeypatch.setattr(queries_streams, "FILE_ROWS", 20, raising=False)
    rows = spark.range(138).select("id", F.when(F.col("id") < 95, 0).when(F.col("id") < 98, 1).otherwise(2).alias("_part"))
    df = queries_streams.fed(spark, rows, "_part", 4)
    batches = {}

    def note(batch, number):
        files = batch.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()
        batches[number] = (sorted(r["id"] for r in batch.select("id").collect()), max((r["n"] for r in files), default=0))

    assert queries_streams.played(df.select("id", "_metadata"), note, str(tmp_path / "checkpoint"))
    got = [batches[k][0] for k in sorted(batches)]
    # the last batch has no rows at all, and may be left out
    assert got[:3] == [list(range(95)), [95, 96, 97], list(range(98, 138))] and not any(got[3:])
    assert all(n <= 40 for _, n in batches.values())
