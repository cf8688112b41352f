"""Queries that run as streams over several micro-batches, with late rows, timers, restarts and sinks of versions."""

from __future__ import annotations

import re
import time
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from ..sources import ingest
from ..sources.versions import Files, VersionedTable
from ..streaming import streams
from . import views as v
from .queries_frames import W, _with_rocks
from .queries_rows import ALLOWED, REASON, messages
from .registry import query


def fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Rows of a file that a stream reads.
FILE_ROWS = 100_000


def fed(spark, rows: DataFrame, part: str, parts: int) -> DataFrame:
    """A file stream that brings ``parts`` micro-batches, by a number of each row that the order follows.

    Each batch has equally many files, as many as the largest needs, so that no task reads or writes a whole batch. Rows are dealt to them evenly; a batch of fewer rows than files is filled up with empty ones.
    """
    path = fresh(spark, "fed")
    schema = rows.drop(part).schema
    largest = rows.where(F.col(part).between(0, parts - 1)).groupBy(part).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    files = max(1, -(-largest // FILE_ROWS))
    at = Files(spark, path)
    for k in range(parts):
        rows.where(F.col(part) == k).drop(part).repartition(files).write.parquet(f"{path}/b{k:03d}")
        for n in range(files - sum(name.endswith(".parquet") for name in at.names(f"{path}/b{k:03d}"))):
            spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{path}/b{k:03d}/e{n:03d}")
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files).parquet(path)


def stored(spark, out: DataFrame, name: str) -> DataFrame:
    """What a stream writes, read again."""
    path = fresh(spark, name)
    out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).outputMode("append").start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/out")


def played(df: DataFrame, sink, checkpoint: str) -> bool:
    """Run a sink over what is there; whether it came to the end."""
    try:
        df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    except StreamingQueryException as e:
        if "stopped on purpose" not in str(e):
            raise
        return False
    return True


class StoppingTable(VersionedTable):
    """Stops once, at a batch, either before its manifest is written or after."""

    stops: dict[int, str] = {}

    def commit(self, old, parts, stream, batch):
        when = self.stops.get(batch)
        if when == "before":
            raise RuntimeError(f"stopped on purpose {self.stops.pop(batch)} the commit")
        out = super().commit(old, parts, stream, batch)
        if when == "after":
            raise RuntimeError(f"stopped on purpose {self.stops.pop(batch)} the commit")
        return out


THIRD = "CAST(least(2, extract('day' FROM timestamp) // 11) AS INTEGER)"


def thirds(df: DataFrame, ts: str) -> DataFrame:
    """The batch of each row: the first, second or third part of its month."""
    return df.withColumn("_part", F.least(F.lit(2), F.floor(F.dayofmonth(ts) / 11)).cast("int"))


# for each row the greatest bucket that is closed when it is judged: a later row of a higher bucket closes one, and so does the clock before the row's slot begins
LATE = """
a AS (SELECT zone_id, seq, value, timestamp AS arrived, date_trunc('hour', timestamp - to_seconds(CASE WHEN k % 11 = 0 THEN 14400 WHEN k % 3 = 0 THEN 3600 ELSE 0 END)) AS b, date_trunc('day', timestamp) AS slot,
  (SELECT max(timestamp) - INTERVAL 30 MINUTE FROM readings) AS clock FROM readings),
s AS (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY arrived, seq) AS i FROM a WHERE slot + INTERVAL 1 DAY <= clock),
f AS (SELECT zone_id, b, min(i) AS first, min(slot) AS opened FROM s GROUP BY 1, 2),
j AS (SELECT s.zone_id, s.i, max(f.b) FILTER (f.b < s.b) AS by_row, max(f.b) FILTER (f.opened < s.slot AND f.b + INTERVAL 3 HOUR <= s.slot) AS by_clock FROM s JOIN f ON f.zone_id = s.zone_id AND f.first < s.i GROUP BY 1, 2),
c AS (SELECT s.*, max(greatest(coalesce(by_row, TIMESTAMP '1900-01-01'), coalesce(by_clock, TIMESTAMP '1900-01-01'))) OVER (PARTITION BY s.zone_id ORDER BY s.i) AS closed FROM s LEFT JOIN j USING (zone_id, i)),
l AS (SELECT zone_id, max(closed) AS last FROM c GROUP BY 1)"""


@query(
    f"""{W}, {LATE} SELECT c.zone_id, b AS bucket, round(avg(value), 8) AS value, count(*) AS samples, NULL::BIGINT AS late FROM c JOIN l USING (zone_id)
    WHERE closed IS NULL OR b > closed GROUP BY 1, 2, last HAVING b <= any_value(last) OR b + INTERVAL 3 HOUR <= date_trunc('day', any_value(clock))
    UNION ALL SELECT zone_id, NULL, NULL, NULL, count(*) FILTER (b <= closed) FROM c GROUP BY 1"""
)
def x03_late_rooms(spark, sf):
    """Hourly means of zones by the order of arrival, in three micro-batches: a third of the payloads are an hour old, some four; buckets also close two hours after their end. The number of late payloads of each zone has a row of its own."""
    r = v.readings(spark, sf)
    age = F.when(F.col("k") % 11 == 0, 14400).when(F.col("k") % 3 == 0, 3600).otherwise(0)
    rows = thirds(r, "timestamp").select("zone_id", F.col("timestamp").cast("timestamp").alias("arrived"), F.timestamp_add("SECOND", -age, F.col("timestamp").cast("timestamp")).alias("event_time"), "seq", "value", "_part")
    df = fed(spark, rows, "_part", 3)
    out = _with_rocks(spark, lambda: stored(spark, streams.room_buckets_in_order(df, ["value"], v.HOUR, "zone_id", clock="arrived", wait="30 minutes", idle=7200, step=86_400), "x03"))
    zone = F.col("room").alias("zone_id")
    buckets = out.where("bucket IS NOT NULL").select(zone, F.col("bucket").cast("timestamp_ntz").alias("bucket"), F.round("value", 8).alias("value"), "samples", F.lit(None).cast("long").alias("late"))
    late = out.groupBy(zone).agg(F.max("late").alias("late")).select("zone_id", F.lit(None).cast("timestamp_ntz").alias("bucket"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("long").alias("samples"), "late")
    return buckets.unionByName(late)


@query(
    f"""{W}, s AS (SELECT *, (SELECT max(timestamp) - INTERVAL 90 MINUTE FROM readings) AS clock FROM readings),
    o AS (SELECT seq, zone_id, last_value(CASE WHEN k % 3 = 0 THEN k::VARCHAR END IGNORE NULLS) OVER l AS brightness, last_value(CASE WHEN k % 5 = 0 THEN device_type END IGNORE NULLS) OVER l AS state, timestamp, clock
      FROM s WINDOW l AS (PARTITION BY zone_id ORDER BY timestamp, seq ROWS UNBOUNDED PRECEDING))
    SELECT seq, zone_id, brightness, state FROM o WHERE date_trunc('day', timestamp) + INTERVAL 1 DAY <= clock"""
)
def x06_stream_reordered(spark, sf):
    """Partial updates of zones filled in the order of time, though a third of each hour comes a batch late; what the watermark has not passed is not out yet."""
    r = v.readings(spark, sf)
    # an update of the first hour of a third may come with the batch before or after
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    moved = at + F.when(F.col("seq") % 3 == 0, 3_600_000_000).otherwise(0)
    rows = r.withColumn("_part", F.least(F.lit(2), F.floor(F.dayofmonth(F.timestamp_micros(moved)) / 11)).cast("int"))
    rows = rows.select("zone_id", F.col("timestamp").cast("timestamp").alias("event_time"), "seq", F.when(F.col("k") % 3 == 0, F.col("k").cast("string")).alias("brightness"), F.when(F.col("k") % 5 == 0, F.col("device_type")).alias("state"), "_part")
    df = fed(spark, rows, "_part", 3)
    out = _with_rocks(spark, lambda: stored(spark, streams.carry_forward_stream(df, ["brightness", "state"], "zone_id", wait="90 minutes", step=86_400), "x06"))
    return out.select("seq", "zone_id", "brightness", "state")


DAYS = T.StructType([T.StructField("device_id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("value", T.DoubleType()), T.StructField("label", T.IntegerType())])


@query(
    f"""{W}, p AS (SELECT device_id, CAST(timestamp AS DATE) AS day, seq, seq % 3 AS part, CASE WHEN k % 4 > 0 THEN value END AS value, CASE WHEN k % 3 = 0 THEN k END AS label FROM readings)
    SELECT device_id, CAST(day AS TIMESTAMP) AS day, arg_max(value, part * 1000000000 + seq) FILTER (value IS NOT NULL) AS value, arg_max(label, part * 1000000000 + seq) FILTER (label IS NOT NULL)::INTEGER AS label FROM p GROUP BY 1, 2"""
)
def x05_stream_day_merge(spark, sf):
    """A table of days into which a stream of three batches is merged column by column; it stops before the manifest of one batch and after that of another and is started again."""
    r = v.readings(spark, sf)
    rows = r.select("device_id", F.col("timestamp").cast("date").alias("day"), "seq", F.when(F.col("k") % 4 > 0, F.col("value")).alias("value"), F.when(F.col("k") % 3 == 0, F.col("k")).alias("label"), (F.col("seq") % 3).alias("_part"))
    df, base = fed(spark, rows, "_part", 3), fresh(spark, "x05")
    table = StoppingTable(spark, f"{base}/table", DAYS, F.col("day"))
    table.stops = {1: "before", 2: "after"}
    sink = streams.merge_days(table, ["device_id", "day"], "seq", "x05")
    while not played(df, sink, f"{base}/checkpoint"):
        pass
    return table.read().withColumn("day", F.col("day").cast("timestamp_ntz"))


HOURS = T.StructType([T.StructField("bucket", T.TimestampNTZType()), T.StructField("zone_id", T.LongType()), T.StructField("n", T.LongType())])


@query(f"{W} SELECT date_trunc('hour', timestamp) AS bucket, zone_id, count(*) AS n FROM readings GROUP BY 1, 2")
def x07_stream_once(spark, sf):
    """Hourly counts that a stream adds to a table: each batch brings the last day of the one before once more, and the stream is stopped on either side of a commit and started again, at last with a new checkpoint."""
    r = v.readings(spark, sf)
    n = r.groupBy(F.date_trunc("HOUR", "timestamp").cast("timestamp_ntz").alias("bucket"), "zone_id").agg(F.count(F.lit(1)).alias("n"))
    again = thirds(n, "bucket").unionByName(thirds(n, "bucket").where(F.dayofmonth("bucket").isin(10, 21)).withColumn("_part", F.col("_part") + 1))
    df, base = fed(spark, again, "_part", 3), fresh(spark, "x07")
    table = StoppingTable(spark, f"{base}/table", HOURS, F.col("bucket").cast("date"))
    table.stops = {0: "after", 1: "before"}
    while not played(df, streams.append_once(table, ["bucket", "zone_id"], ["n"], "x07"), f"{base}/checkpoint"):
        pass
    played(df, streams.append_once(table, ["bucket", "zone_id"], ["n"], "x07 anew"), f"{base}/anew")
    return table.read()


GOOD = T.StructType([T.StructField("seq", T.LongType()), T.StructField("device_type", T.StringType())])
LETTERS = T.StructType([T.StructField("timestamp", T.TimestampNTZType()), T.StructField("device", T.StringType()), T.StructField("payload", T.StringType()), T.StructField("reason", T.StringType())])


@query(
    f"""{W} SELECT 'good' AS part, device_type AS name, count(*) AS n, min(seq) AS first, NULL::TIMESTAMP AS first_time FROM readings WHERE {REASON} IS NULL GROUP BY 2
    UNION ALL SELECT 'dead', {REASON}, count(*), NULL, min(timestamp) FROM readings WHERE {REASON} IS NOT NULL GROUP BY 2"""
)
def s10_stream_two_sinks(spark, sf):
    """Messages as a stream into a table of good ones and one of dead letters; the second sink stops once behind the first, and the batch is played again."""
    df, base = fed(spark, messages(spark, sf).withColumn("_part", (F.col("seq") % 3).cast("int")), "_part", 3), fresh(spark, "s10")
    good, bad = VersionedTable(spark, f"{base}/good", GOOD), StoppingTable(spark, f"{base}/bad", LETTERS)
    bad.stops = {1: "before"}
    sink = streams.two_sinks(good, bad, lambda m: ingest.parse_messages(m, ALLOWED), "s10")
    while not played(df, sink, f"{base}/checkpoint"):
        pass
    rows = good.read().groupBy(F.lit("good").alias("part"), F.col("device_type").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"), F.lit(None).cast("timestamp_ntz").alias("first_time"))
    return rows.unionByName(bad.read().groupBy(F.lit("dead").alias("part"), F.col("reason").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("first"), F.min("timestamp").alias("first_time")))


STAGED = T.StructType([T.StructField("device_type", T.StringType()), T.StructField("device_id", T.LongType()), T.StructField("seq", T.LongType())])


@query(
    f"""{W}, n AS (SELECT device_type, seq % 3 AS part, count(*) AS n FROM readings GROUP BY 1, 2), b AS (SELECT device_type, coalesce(sum(n) FILTER (part = 0), 0) AS a, coalesce(sum(n) FILTER (part = 1), 0) AS b, coalesce(sum(n) FILTER (part = 2), 0) AS c FROM n GROUP BY 1),
    w AS (SELECT *, CASE WHEN a >= 700 THEN 0 ELSE a END AS p FROM b), x AS (SELECT *, CASE WHEN p + b >= 700 THEN 0 ELSE p + b END AS q FROM w),
    t AS (SELECT device_type, CASE WHEN q + c >= 700 THEN 2 END AS t2, CASE WHEN p + b >= 700 THEN 1 ELSE t2 END AS t1, CASE WHEN a >= 700 THEN 0 ELSE t1 END AS t0 FROM x),
    u AS (SELECT device_type, device_id, seq, [t0, t1, t2][seq % 3 + 1] AS t FROM readings JOIN t USING (device_type))
    SELECT device_type, device_id, arg_min(seq, (t, seq)) AS seq FROM u WHERE t IS NOT NULL GROUP BY 1, 2"""
)
def s13_stream_flush(spark, sf):
    """Buffers of device types in state that are flushed at 700 rows, by a stream that is stopped and started again between batches: the first row of each device goes into the table, what waits does not."""
    r = v.readings(spark, sf)
    df, base = fed(spark, r.select("device_type", "device_id", "seq", (F.col("seq") % 3).cast("int").alias("_part")), "_part", 3), fresh(spark, "s13")
    table = VersionedTable(spark, f"{base}/table", STAGED, F.col("device_type"))
    sink = streams.flush_to(table, ["device_type", "device_id"], ["seq"], "s13")

    def run():
        for files in (1, 3):
            q = streams.staged_rows(df, "device_type", 700, 86_400).writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/checkpoint").trigger(processingTime="100 milliseconds").start()
            try:  # timers by the clock keep such a stream going, so it is stopped when it has read so many files
                while q.isActive and not ((p := q.lastProgress) and (at := re.search(r"logOffset\D+(\d+)", str(p.sources[0].endOffset))) and int(at[1]) >= files - 1):
                    time.sleep(0.05)
            finally:
                q.stop()
            if error := q.exception():
                raise error
        return table.read()

    return _with_rocks(spark, run)


#: A saved model of fixed weights, so that SQL can tell its scores.
SCORE = "0.02 * value_avg - 0.01 * value_sd + 0.005 * value_now - 0.001 * value_max - 0.5"


@query(
    f"""{W}, r AS (SELECT zone_id, seq, timestamp, date_trunc('day', timestamp) AS tick, CASE WHEN k % 10 <> 0 THEN value END AS value FROM readings WHERE device_type <> 'click'),
    p AS (SELECT *, avg(value) OVER w AS a, stddev_pop(value) OVER w AS s, max(value) OVER w AS m, count(value) OVER w AS c, count(*) OVER w AS n, max(gap) OVER g AS big, min(gap) OVER g AS small
      FROM (SELECT *, epoch_us(timestamp) - epoch_us(lag(timestamp) OVER o) AS gap FROM r WINDOW o AS (PARTITION BY zone_id ORDER BY timestamp, seq))
      WINDOW w AS (PARTITION BY zone_id ORDER BY timestamp, seq ROWS 11 PRECEDING), g AS (PARTITION BY zone_id ORDER BY timestamp, seq ROWS 10 PRECEDING)),
    z AS (SELECT *, row_number() OVER (PARTITION BY zone_id, tick ORDER BY timestamp DESC, seq DESC) AS d FROM p WHERE tick + INTERVAL 1 DAY <= (SELECT max(timestamp) - INTERVAL 1 HOUR FROM readings)),
    b AS (SELECT zone_id, tick, arg_max(source_topic, (timestamp, source_topic)) AS label FROM l GROUP BY 1, 2),
    t AS (SELECT z.*, b.label FROM z ASOF LEFT JOIN b ON b.zone_id = z.zone_id AND z.tick >= b.tick WHERE d = 1)
    SELECT zone_id, timestamp, n AS rows, c / n >= 0.8 AS gate_ok, (big IS NULL OR (n > 1 AND big <= 21600000000 AND small >= 5000000)) AND epoch_us(tick + INTERVAL 1 DAY) - epoch_us(timestamp) <= 14400000000 AS in_order, label,
      round(1 / (1 + exp(-(0.02 * coalesce(a, 0) - 0.01 * coalesce(s, 0) + 0.005 * coalesce(value, a, 0) - 0.001 * coalesce(m, 0) - 0.5))), 8) AS probability FROM t""".replace(
        "b AS (SELECT zone_id, tick,", "l AS (SELECT zone_id, timestamp, date_trunc('day', timestamp) AS tick, 'topic' || (k % 3) AS source_topic FROM readings WHERE device_type = 'click'), b AS (SELECT zone_id, tick,"
    )
)
def x10_live_stream(spark, sf):
    """A daily tick for each zone from three micro-batches of readings and labels: the window of the last 12 rows out of state, gate, cadence, the label as of the tick, and the score of a saved model."""
    r = thirds(v.readings(spark, sf), "timestamp").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    readings = fed(spark, r.where("device_type <> 'click'").select("zone_id", "timestamp", "seq", F.when(F.col("k") % 10 != 0, F.col("value")).alias("value"), "_part"), "_part", 3)
    labels = r.where("device_type = 'click'").select("zone_id", F.col("timestamp").alias("label_time"), F.concat(F.lit("topic"), F.col("k") % 3).alias("label"), "_part")
    path = fresh(spark, "x10")
    PipelineModel([SQLTransformer(statement=f"SELECT *, 1 / (1 + exp(-({SCORE}))) AS probability FROM __THIS__")]).write().save(path)
    model = PipelineModel.load(path)
    tail = streams.live_tail(readings, fed(spark, labels, "_part", 3), ["value"], 12, {"value": 0.8}, wait="1 hour", tick=86_400, grid=10, most_gap=21_600, most_age=14_400)
    out = _with_rocks(spark, lambda: stored(spark, model.transform(tail), "x10"))
    return out.select("zone_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "rows", "gate_ok", "in_order", "label", F.round("probability", 8).alias("probability"))

