"""Sensor tables derived from the driver's ``events``, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import buckets, joins

HOUR = 3600


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Readings: each user is a device, in one of 15 zones."""
    e = load(spark, sf, "events")
    return e.select(
        F.col("ts").cast("timestamp_ntz").alias("timestamp"), F.col("user_id").alias("device_id"), F.col("event_type").alias("device_type"), (F.col("user_id") % 15 + 1).alias("zone_id"),
        "value", F.col("props").alias("payload"), F.col("event_id").alias("seq"), F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


READINGS = """readings AS (SELECT ts AS timestamp, user_id AS device_id, event_type AS device_type, user_id % 15 + 1 AS zone_id, value, props AS payload,
  event_id AS seq, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with nulls (k % 10 = 0), NaN (1) and repeated rows with a later seq and another value (2)."""
    r = readings(spark, sf)
    base = r.withColumn("value", F.when(F.col("k") % 10 == 0, None).when(F.col("k") % 10 == 1, float("nan")).otherwise(F.col("value")))
    again = r.where("k % 10 = 2").withColumn("seq", F.col("seq") + 100_000_000).withColumn("value", F.col("value") + 1)
    return base.unionByName(again)


GAPPY = READINGS + """, gappy AS (
  SELECT timestamp, device_id, device_type, zone_id, CASE WHEN k % 10 IN (0, 1) THEN NULL ELSE value END AS value, k % 10 = 1 AS is_nan, payload, seq, k FROM readings
  UNION ALL SELECT timestamp, device_id, device_type, zone_id, value + 1, false, payload, seq + 100000000, k FROM readings WHERE k % 10 = 2)"""


def states(spark: SparkSession, sf: str) -> DataFrame:
    """Occupancy changes: a view is 1, an error 0."""
    return readings(spark, sf).where(F.col("device_type").isin("view", "error")).withColumn("state", (F.col("device_type") == "view").cast("int"))


STATES = READINGS + ", states AS (SELECT *, CAST(device_type = 'view' AS INTEGER) AS state FROM readings WHERE device_type IN ('view', 'error'))"


def labels_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of persons from clicks: k % 4, null where k % 7 = 0."""
    r = readings(spark, sf).where("device_type = 'click'")
    return r.withColumn("occupancy_count", F.when(F.col("k") % 7 != 0, F.col("k") % 4)).withColumn("source_topic", F.concat(F.lit("topic"), F.col("k") % 3))


LABELS = READINGS + """, labels_raw AS (SELECT *, CASE WHEN k % 7 <> 0 THEN k % 4 END AS occupancy_count, 'topic' || (k % 3) AS source_topic
  FROM readings WHERE device_type = 'click')"""


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Mean value of each zone and hour."""
    return buckets.bucket_mean(readings(spark, sf), {"value": F.col("value")}, HOUR, ["zone_id"])


HOURLY = READINGS + ", hourly AS (SELECT date_trunc('hour', timestamp) AS timestamp, zone_id, avg(value) AS value FROM readings GROUP BY ALL)"


def hourly_labels(spark: SparkSession, sf: str) -> DataFrame:
    """0 or 1 for each zone and hour by the median count."""
    s = buckets.occupancy_stats(labels_raw(spark, sf), HOUR, ["zone_id"], "seq")
    return s.select(F.col("bucket").alias("timestamp"), "zone_id", "occupied", "sample_count", F.col("median_count").alias("occupancy_count"))


HOURLY_LABELS = """hourly_labels AS (SELECT date_trunc('hour', timestamp) AS timestamp, zone_id, CAST(median(occupancy_count) >= 1 AS INTEGER) AS occupied,
  count(occupancy_count) AS sample_count, round(CAST(median(occupancy_count) AS DOUBLE), 3) AS occupancy_count FROM labels_raw GROUP BY ALL)"""


def bounds(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Hour of the first event and the hour after the last: two values."""
    hour = lambda c: F.date_trunc("HOUR", c).cast("timestamp_ntz").cast("string")
    r = load(spark, sf, "events").agg(hour(F.min("ts")), hour(F.max("ts") + F.expr("INTERVAL 1 HOUR"))).first()
    return r[0], r[1]


def zones(spark: SparkSession) -> DataFrame:
    return spark.range(1, 16).select(F.col("id").alias("zone_id"))


def grid(spark: SparkSession, sf: str) -> DataFrame:
    """All hours of all zones with the means there are."""
    return joins.dense_grid(hourly(spark, sf), *bounds(spark, sf), HOUR, zones(spark))


GRID = HOURLY + """, slots AS (SELECT unnest(generate_series(min(date_trunc('hour', timestamp)), max(date_trunc('hour', timestamp)), INTERVAL 1 HOUR)) AS timestamp FROM readings),
  grid AS (SELECT s.timestamp, z.zone_id, h.value FROM slots s CROSS JOIN (SELECT unnest(range(1, 16)) AS zone_id) z LEFT JOIN hourly h ON h.timestamp = s.timestamp AND h.zone_id = z.zone_id)"""


def frame(spark: SparkSession, sf: str) -> DataFrame:
    """The grid with labels."""
    return joins.with_labels(grid(spark, sf), hourly_labels(spark, sf).select("timestamp", "zone_id", "occupied"), ["timestamp", "zone_id"])


FRAME = GRID + LABELS[len(READINGS) :] + ", " + HOURLY_LABELS + ", frame AS (SELECT g.*, l.occupied FROM grid g LEFT JOIN hourly_labels l USING (timestamp, zone_id))"


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Probabilities with ties, and labels: odd k, or a value among the highest."""
    return readings(spark, sf).where("value IS NOT NULL").select("seq", "timestamp", "zone_id", F.least(F.lit(1.0), F.floor(F.abs("value") / 5) / 100).alias("probability"), (F.col("k") % 2).alias("y"))


SCORED = READINGS + ", scored AS (SELECT seq, timestamp, zone_id, least(1.0::DOUBLE, floor(abs(value) / 5) / 100) AS probability, k % 2 AS y FROM readings WHERE value IS NOT NULL)"


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Detections: a box for each event."""
    s = F.col("seq")
    return readings(spark, sf).select(
        s.alias("box_id"), (s % 500).alias("frame"), (s * 37 % 1900 - 20).cast("int").alias("x1"), (s * 53 % 1000 - 10).cast("int").alias("y1"),
        (s * 37 % 1900 - 20 + 20 + s % 180).cast("int").alias("x2"), (s * 53 % 1000 - 10 + 30 + s % 140).cast("int").alias("y2"),
    )


def rectangles(spark: SparkSession) -> DataFrame:
    """Sixteen tables of 400 x 240 pixels, four in a row, with some overlap."""
    z = F.col("id")
    x, y = (z % 4) * 380 + 150, F.floor(z / 4) * 220 + 100
    return spark.range(16).select((z + 1).alias("zone_id"), z.alias("zone_order"), x.alias("zx1"), y.alias("zy1"), (x + 400).alias("zx2"), (y + 240).alias("zy2"))


BOXES = READINGS + """, boxes AS (SELECT seq AS box_id, seq % 500 AS frame, greatest(0, least(1920, seq * 37 % 1900 - 20)) AS x1, greatest(0, least(1080, seq * 53 % 1000 - 10)) AS y1,
    greatest(0, least(1920, seq * 37 % 1900 + seq % 180)) AS x2, greatest(0, least(1080, seq * 53 % 1000 + 20 + seq % 140)) AS y2 FROM readings),
  rect AS (SELECT z + 1 AS zone_id, z AS zone_order, z % 4 * 380 + 150 AS zx1, z // 4 * 220 + 100 AS zy1, z % 4 * 380 + 550 AS zx2, z // 4 * 220 + 340 AS zy2 FROM (SELECT unnest(range(0, 16)) AS z)),
  met AS (SELECT b.*, r.*, (least(x2, zx2) - greatest(x1, zx1)) * (least(y2, zy2) - greatest(y1, zy1))::DOUBLE / greatest(1, (x2 - x1) * (y2 - y1)) AS ratio
    FROM boxes b JOIN rect r ON x1 < zx2 AND x2 > zx1 AND y1 < zy2 AND y2 > zy1)"""
