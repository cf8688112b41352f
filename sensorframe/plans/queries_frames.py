"""Queries of aggregations, windows, splits, scalar functions, metrics, models and streams."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars
from ..functions import time as ft
from ..operators import buckets, joins, metrics, models, reports, splits, windows
from ..streaming import streams
from ..session import shared_dir
from . import views as v
from .registry import query

W = "WITH " + v.READINGS
KEYS = ["timestamp", "zone_id"]


def rounded(*names: str):
    """Both sides of a comparison add floats up in their own order."""
    return lambda df: df.select(*(F.round(c, 8).alias(c) if c in names else F.col(c) for c in df.columns))


@query(f"WITH {v.GAPPY} SELECT date_trunc('hour', timestamp) AS timestamp, zone_id, round(avg(value), 8) AS value, round(avg(k), 8) AS k FROM gappy WHERE timestamp >= TIMESTAMP '2024-01-03' AND timestamp < TIMESTAMP '2024-01-20' GROUP BY 1, 2")
def a01_bucket_mean(spark, sf):
    k = F.get_json_object("payload", "$.k").try_cast("double")
    return buckets.bucket_mean(v.gappy(spark, sf), {"value": F.col("value"), "k": k}, v.HOUR, ["zone_id"], "2024-01-03 00:00:00", "2024-01-20 00:00:00").transform(rounded("value", "k"))


@query(f"{W} SELECT date_trunc('second', timestamp) AS timestamp, " + ", ".join(f"arg_max(value, (timestamp, seq)) FILTER (zone_id = {z}) AS temp_s{z}" for z in range(1, 16)) + " FROM readings GROUP BY 1")
def a02_wide_positions(spark, sf):
    return buckets.wide_positions(v.readings(spark, sf), {"temp": "value"}, list(range(1, 16)), "seq")


@query(f"{W}, d AS (SELECT date_trunc('day', timestamp) AS timestamp, zone_id, device_id, avg(value) AS x FROM readings GROUP BY ALL) SELECT timestamp, zone_id, round(sum(x), 8) AS power FROM d GROUP BY ALL")
def a03_bucket_power(spark, sf):
    return buckets.bucket_power(v.readings(spark, sf), F.col("value"), 86400).transform(rounded("power"))


@query(f"{W} SELECT date_trunc('hour', timestamp) AS timestamp, round(avg(value), 8) AS power FROM readings WHERE device_id = 5 GROUP BY 1")
def a04_single_power(spark, sf):
    r = v.readings(spark, sf).where("device_id = 5")
    return buckets.bucket_mean(r, {"power": buckets.power_column(r)}, v.HOUR, []).transform(rounded("power"))


@query(
    f"""WITH {v.GRID}{v.STATES[len(v.READINGS):]}, s AS (SELECT date_trunc('hour', timestamp) AS h, zone_id, max(state) AS m, arg_max(state, (timestamp, seq)) AS l, max(timestamp) AS t FROM states GROUP BY 1, 2),
    j AS (SELECT g.timestamp, g.zone_id, s.m, s.l, s.t, last_value(s.l IGNORE NULLS) OVER w AS cl, last_value(s.t IGNORE NULLS) OVER w AS ct
      FROM grid g LEFT JOIN s ON s.h = g.timestamp AND s.zone_id = g.zone_id WINDOW w AS (PARTITION BY g.zone_id ORDER BY g.timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT timestamp, zone_id, CASE WHEN timestamp + INTERVAL 1 HOUR - coalesce(t, ct) <= INTERVAL 18000 SECOND THEN greatest(cl, m) END AS state FROM j"""
)
def a05_state_carry(spark, sf):
    return buckets.state_carry(v.states(spark, sf), v.grid(spark, sf), v.HOUR, 18000, ["zone_id"], "seq")


@query(f"{W} SELECT date_trunc('hour', timestamp) AS timestamp, zone_id, max(greatest(CAST(device_type = 'view' AS INTEGER), CASE WHEN k % 5 > 0 THEN CAST(k > 90 AS INTEGER) END)) AS occupied FROM readings GROUP BY 1, 2")
def a06_bucket_flags(spark, sf):
    flags = [(F.col("device_type") == "view").cast("int"), F.when(F.col("k") % 5 > 0, (F.col("k") > 90).cast("int"))]
    return buckets.bucket_flags(v.readings(spark, sf), flags, v.HOUR, ["zone_id"])


@query(
    f"""WITH {v.GAPPY}, u AS (SELECT *, CASE WHEN k % 3 > 0 THEN device_type ELSE ' ' END AS room FROM gappy QUALIFY row_number() OVER (PARTITION BY timestamp, device_id ORDER BY seq DESC) = 1)
    SELECT date_trunc('hour', timestamp) AS timestamp, round(avg(value), 8) AS value, arg_max(room, (timestamp, seq)) FILTER (room <> ' ') AS room FROM u GROUP BY 1"""
)
def a07_bucket_room(spark, sf):
    g = v.gappy(spark, sf).withColumn("sensor_id", F.col("device_id")).withColumn("room", F.when(F.col("k") % 3 > 0, F.col("device_type")).otherwise(" "))
    return buckets.bucket_room(g, ["value"], ["room"], v.HOUR, "seq").transform(rounded("value"))


STATS = """count(occupancy_count) AS sample_count, round(min(occupancy_count)::DOUBLE, 3) AS min_count, round(max(occupancy_count)::DOUBLE, 3) AS max_count, round(avg(occupancy_count), 3) AS mean_count,
  round(median(occupancy_count)::DOUBLE, 3) AS median_count, round((arg_max(occupancy_count, (timestamp, seq)) FILTER (occupancy_count IS NOT NULL))::DOUBLE, 3) AS last_count, min(timestamp) AS first_message_time, max(timestamp) AS last_message_time"""


@query(f"WITH {v.LABELS} SELECT date_trunc('day', timestamp) AS bucket, {STATS}, round(max(occupancy_count)::DOUBLE, 3) AS occupancy_count, CAST(median(occupancy_count) >= 1 AS INTEGER) AS occupied FROM labels_raw GROUP BY 1")
def a08_occupancy_stats(spark, sf):
    return buckets.occupancy_stats(v.labels_raw(spark, sf), 86400, [], "seq", mode="max")


@query(f"WITH {v.LABELS} SELECT date_trunc('hour', timestamp) AS bucket, zone_id, {STATS}, string_agg(DISTINCT source_topic, '|' ORDER BY source_topic) AS source_topic, round(median(occupancy_count)::DOUBLE, 3) AS occupancy_count, CAST(median(occupancy_count) >= 1 AS INTEGER) AS occupied FROM labels_raw GROUP BY 1, 2")
def a09_zone_occupancy(spark, sf):
    return buckets.occupancy_stats(v.labels_raw(spark, sf), v.HOUR, ["zone_id"], "seq", texts=("source_topic",))


def _label_rows(spark, sf):
    r = v.labels_raw(spark, sf)
    c = F.col("occupancy_count").cast("double")
    return r.select(
        buckets.floor_to(F.col("timestamp"), 86400).alias("timestamp"), "zone_id", "seq", c.alias("occupancy_count"), F.when(c.isNotNull(), F.col("k")).alias("sample_count"), c.alias("min_count"), (c + 1).alias("max_count"), c.alias("mean_count"),
        c.alias("median_count"), c.alias("last_count"), F.col("timestamp").alias("first_message_time"), F.col("timestamp").alias("last_message_time"), "source_topic", F.when(F.col("k") % 5 == 0, F.col("k") % 2).alias("target"),
    )


@query(
    f"""WITH {v.LABELS}, t AS (SELECT timestamp, zone_id, string_agg(source_topic, '|' ORDER BY s) AS source_topic FROM (SELECT date_trunc('day', timestamp) AS timestamp, zone_id, source_topic, min(seq) AS s FROM labels_raw GROUP BY 1, 2, 3) GROUP BY 1, 2)
    SELECT date_trunc('day', l.timestamp) AS timestamp, l.zone_id, median(occupancy_count)::DOUBLE AS occupancy_count, coalesce(sum(CASE WHEN occupancy_count IS NOT NULL THEN k END), 0)::BIGINT AS sample_count, round(avg(occupancy_count), 8) AS mean_count, max(occupancy_count + 1)::DOUBLE AS max_count,
      min(l.timestamp) FILTER (l.seq = f.s0) AS first_message_time, max(l.timestamp) FILTER (l.seq = f.s1) AS last_message_time, any_value(t.source_topic) AS source_topic,
      coalesce(any_value(f.tgt), CAST(median(occupancy_count) >= 1 AS INTEGER)) AS explicit, CAST(median(occupancy_count) >= 1 AS INTEGER) AS threshold, coalesce(CAST(median(occupancy_count) >= 1 AS INTEGER), any_value(f.tgt)) AS fallback
    FROM labels_raw l JOIN (SELECT date_trunc('day', timestamp) AS d, zone_id, min(seq) AS s0, max(seq) AS s1, arg_max(k % 2, seq) FILTER (k % 5 = 0) AS tgt FROM labels_raw GROUP BY 1, 2) f ON f.d = date_trunc('day', l.timestamp) AND f.zone_id = l.zone_id
    JOIN t ON t.timestamp = f.d AND t.zone_id = l.zone_id GROUP BY 1, 2"""
)
def a10_a11_regroup_labels(spark, sf):
    rows = _label_rows(spark, sf)
    out = buckets.regroup_labels(rows, KEYS, "seq", rule="explicit", target="target").withColumnRenamed("occupied", "explicit")
    more = rows.groupBy(*KEYS).agg(F.median("median_count").alias("m"), F.max_by("target", F.when(F.col("target").isNotNull(), F.col("seq"))).alias("t"))
    rules = more.select(*KEYS, *(buckets.occupied(F.col("m"), F.col("t"), rule).alias(rule) for rule in ("threshold", "fallback")))
    return out.join(rules, KEYS).select(*KEYS, "occupancy_count", "sample_count", F.round("mean_count", 8).alias("mean_count"), "max_count", "first_message_time", "last_message_time", "source_topic", "explicit", "threshold", "fallback")


@query(
    f"""{W}, s AS (SELECT device_id, value AS a, lead(value) OVER w AS b, epoch_us(lead(timestamp) OVER w) - epoch_us(timestamp) AS dt FROM readings WINDOW w AS (PARTITION BY device_id ORDER BY timestamp, seq))
    SELECT device_id, round(sum((a + b) / 2 * dt) / sum(dt), 8) AS time_weighted_avg, count(*) AS samples FROM s GROUP BY 1"""
)
def a12_time_weighted_average(spark, sf):
    return buckets.time_weighted_average(v.readings(spark, sf), ["device_id"]).transform(rounded("time_weighted_avg"))


@query(f"{W} SELECT count(*) AS rows, min(timestamp) AS first_time, max(timestamp) AS last_time FROM readings")
def a13_time_summary(spark, sf):
    return reports.time_summary(v.readings(spark, sf))


@query(f"WITH {v.GAPPY} SELECT 'value' AS \"column\", 'double' AS type, count(*) FILTER (value IS NULL AND NOT is_nan) AS nulls, count(*) FILTER (is_nan) AS nans, count(*) FILTER (is_nan) AS not_finite FROM (SELECT value, coalesce(is_nan, false) AS is_nan FROM gappy) UNION ALL SELECT 'k', 'int', count(*) FILTER (k IS NULL), 0, 0 FROM gappy")
def a14_quality_report(spark, sf):
    return reports.quality_report(v.gappy(spark, sf), ["value", "k"])


@query(f"WITH {v.GAPPY} SELECT zone_id, round(100 * count(value) / count(*), 8) AS value, round(100 * count(k) / count(*), 8) AS k FROM gappy GROUP BY 1")
def a15_availability(spark, sf):
    return reports.availability(v.gappy(spark, sf), ["value", "k"], ["zone_id"]).transform(rounded("value", "k"))


COVERAGE = "d AS (SELECT CAST(timestamp AS DATE) AS date, zone_id, count(DISTINCT timestamp) AS n FROM hourly GROUP BY 1, 2), coverage AS (SELECT date, min(n) AS rows, min(n) >= 5 AS eligible FROM d GROUP BY 1)"


@query(f"WITH {v.HOURLY}, {COVERAGE} SELECT CAST(date AS VARCHAR) AS date, rows, eligible FROM coverage")
def a16_date_coverage(spark, sf):
    return reports.date_coverage(v.hourly(spark, sf), v.HOUR, 0.2, "zone_id").withColumn("date", F.col("date").cast("string"))


@query(f"WITH {v.GAPPY} SELECT round(coalesce(median(value), 0), 8) AS value FROM gappy WHERE timestamp < TIMESTAMP '2024-01-20'")
def a17_fill_values(spark, sf):
    return reports.fill_values(v.gappy(spark, sf).where("timestamp < TIMESTAMP_NTZ '2024-01-20'"), ["value"]).transform(rounded("value"))


@query(f"WITH {v.GAPPY} SELECT round(avg(value), 8) AS value_mean, round(stddev_pop(value), 8) AS value_std FROM gappy")
def a18_scaler_stats(spark, sf):
    return reports.scaler_stats(v.gappy(spark, sf), ["value"]).transform(rounded("value_mean", "value_std"))


@query(f"{W} SELECT device_id, count(*) AS rows FROM readings GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def a19_most_frequent_device(spark, sf):
    return reports.most_frequent_device(v.readings(spark, sf))


@query(f"WITH {v.GAPPY} SELECT timestamp, seq, value AS pm2_5, coalesce(CASE WHEN k % 4 > 0 THEN k::DOUBLE END, value) AS pm4_0, coalesce(CASE WHEN k % 3 = 0 THEN 1 WHEN k % 3 = 1 THEN 0 END, 0) AS occupied FROM gappy WHERE NOT coalesce(is_nan, false)")
def a20_seed_tables(spark, sf):
    g = v.gappy(spark, sf).where("value IS NULL OR NOT isnan(value)").withColumn("four", F.when(F.col("k") % 4 > 0, F.col("k").cast("double"))).withColumn("flag", F.when(F.col("k") % 3 == 0, "on").when(F.col("k") % 3 == 1, "clear").otherwise("?"))
    room = reports.seed_room_table(g, {"seq": "seq", "value": "pm2_5", "four": "pm4_0"})
    labels = reports.seed_labels(g.withColumn("timestamp", F.col("seq")), ["flag"]).withColumnRenamed("timestamp", "seq")
    return room.join(labels, "seq").select("timestamp", "seq", "pm2_5", "pm4_0", "occupied")


@query(f"WITH {v.GAPPY} SELECT timestamp, device_id, round(value, 8) AS temp FROM gappy QUALIFY row_number() OVER (PARTITION BY timestamp, device_id ORDER BY seq DESC) = 1")
def a21_seed_from_csv(spark, sf):
    rows = v.gappy(spark, sf).withColumn("value", scalars.no_nan(F.col("value")))
    return reports.seed_from_csv(rows, {"value": "temp"}, ["timestamp", "device_id"], "seq").select("timestamp", "device_id", F.round("temp", 8).alias("temp"))


@query(f"WITH {v.LABELS}, {v.HOURLY_LABELS} SELECT timestamp, sum(occupancy_count) AS total_count, max(occupied) AS occupied, count(*) AS zones FROM hourly_labels WHERE timestamp = (SELECT max(timestamp) FROM hourly_labels) GROUP BY 1")
def a22_label_snapshot(spark, sf):
    return reports.label_snapshot(v.hourly_labels(spark, sf))


@query(f"{W}, l AS (SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY timestamp DESC) = 1) SELECT round(avg(value), 8) AS value, round(avg(k), 8) AS k FROM l")
def a23_environment_summary(spark, sf):
    return reports.environment_summary(windows.latest_rows(v.readings(spark, sf)), ["value", "k"]).transform(rounded("value", "k"))


@query(f"WITH {v.SCORED} SELECT seq, round((probability - y) * (probability - y), 8) AS squared_error FROM scored WHERE y IS NOT NULL")
def a24_squared_error(spark, sf):
    return reports.squared_error(v.scored(spark, sf)).select("seq", F.round("squared_error", 8).alias("squared_error"))


@query(
    f"""WITH {v.BOXES}, a AS (SELECT box_id, frame, zone_id FROM met WHERE zone_id <> 16 AND ratio >= 0.3 QUALIFY row_number() OVER (PARTITION BY box_id ORDER BY ratio DESC, zone_order) = 1)
    SELECT f.frame, z.zone_id, count(a.box_id) AS persons, (SELECT count(*) FROM a b WHERE b.frame = f.frame) AS total FROM (SELECT DISTINCT frame FROM boxes) f CROSS JOIN rect z LEFT JOIN a ON a.frame = f.frame AND a.zone_id = z.zone_id WHERE z.zone_id <> 16 GROUP BY 1, 2"""
)
def a25_zone_head_counts(spark, sf):
    b, z = v.boxes(spark, sf), v.rectangles(spark)
    return buckets.zone_head_counts(joins.assign_zone(b, z).join(b.select("box_id", "frame"), "box_id"), b, z.where("zone_id <> 16"))


LAST = "last AS (SELECT * FROM gappy ORDER BY timestamp DESC, seq DESC LIMIT 400)"


def _last(spark, sf):
    return v.gappy(spark, sf).orderBy(F.desc("timestamp"), F.desc("seq")).limit(400)


@query(f"WITH {v.GAPPY}, {LAST} SELECT feature, present, required, present >= required AS passes FROM (SELECT 'value' AS feature, round(count(value) / count(*), 6) AS present, CAST(0.8 AS DOUBLE) AS required FROM last UNION ALL SELECT 'k', round(count(k) / count(*), 6), CAST(0.95 AS DOUBLE) FROM last)")
def a26_live_gate(spark, sf):
    return reports.live_gate(_last(spark, sf), reports.gate_requirements(["value"], ["k"]))


@query(f"WITH {v.GAPPY}, {LAST} SELECT min(timestamp) AS window_start, max(timestamp) AS window_end, round(avg(value), 8) AS value_mean, round(avg(k), 8) AS k_mean, round(least(count(value) / count(*), count(k) / count(*)), 8) AS min_present FROM last")
def a27_live_context(spark, sf):
    return reports.live_context(_last(spark, sf), ["value", "k"]).select("window_start", "window_end", F.round("value_mean", 8).alias("value_mean"), F.round("k_mean", 8).alias("k_mean"), F.round("min_present", 8).alias("min_present"))


@query(f"WITH {v.HOURLY} SELECT min(n) AS min_rows FROM (SELECT zone_id, count(*) AS n FROM hourly GROUP BY 1)")
def a28_least_rows(spark, sf):
    return reports.least_rows(v.hourly(spark, sf))


@query(
    f"""WITH {v.FRAME}, f AS (SELECT count(*) AS feature_rows, min(timestamp) AS feature_first, max(timestamp) AS feature_last FROM hourly), l AS (SELECT count(*) AS label_rows, min(timestamp) AS label_first, max(timestamp) AS label_last FROM hourly_labels),
    j AS (SELECT count(*) AS joined_rows, min(timestamp) AS joined_first, max(timestamp) AS joined_last, count(occupied) AS labelled, count(*) - count(occupied) AS unlabelled, count(*) - count(value) AS value_nulls FROM frame) SELECT * FROM f, l, j"""
)
def a29_dataset_summary(spark, sf):
    return reports.dataset_summary(v.hourly(spark, sf), v.hourly_labels(spark, sf), v.frame(spark, sf), ["value"])


WQ = "q AS (SELECT *, row_number() OVER l AS n, avg(CASE WHEN value IS NULL THEN 0 ELSE 1 END) OVER (l ROWS 11 PRECEDING) AS p FROM frame WINDOW l AS (PARTITION BY zone_id ORDER BY timestamp))"


@query(f"WITH {v.FRAME}, {WQ} SELECT timestamp, zone_id, CASE WHEN n >= 12 THEN round(p, 8) END AS window_present, n >= 12 AND p >= 0.5 AS quality_ok FROM q")
def w01_window_quality(spark, sf):
    return windows.window_quality(v.frame(spark, sf), ["value"], 12, 0.5, ["zone_id"]).select(*KEYS, F.round("window_present", 8).alias("window_present"), F.coalesce("quality_ok", F.lit(False)).alias("quality_ok"))


@query(f"WITH {v.FRAME}, {WQ} SELECT timestamp, zone_id, occupied FROM q WHERE n >= 12 AND p >= 0.5 AND occupied IS NOT NULL")
def w02_window_labels(spark, sf):
    return windows.window_labels(v.frame(spark, sf), ["value"], 12, 0.5, ["zone_id"]).select(*KEYS, "occupied")


@query(f"WITH {v.FRAME}, m AS (SELECT *, row_number() OVER l AS n, first_value(CAST(value AS FLOAT)) OVER (l ROWS 11 PRECEDING) AS f, count(value) OVER (l ROWS 11 PRECEDING) AS c FROM frame WINDOW l AS (PARTITION BY zone_id ORDER BY timestamp)) SELECT timestamp, zone_id, occupied, CAST(12 AS INTEGER) AS rows, round(CAST(f AS DOUBLE), 3) AS first, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 3) AS last, c AS present FROM m WHERE n >= 12 AND occupied IS NOT NULL")
def w03_make_windows(spark, sf):
    w = windows.make_windows(v.frame(spark, sf), ["value", "zone_id"], 12, ["zone_id"])
    one = lambda i: F.round(F.get(F.get("window", F.lit(i)), F.lit(0)).cast("double"), 3)
    return w.select(*KEYS, "occupied", F.size("window").alias("rows"), one(0).alias("first"), one(11).alias("last"), F.size(F.filter("window", lambda x: F.get(x, F.lit(0)).isNotNull())).cast("long").alias("present"))


RUNS = "e AS (SELECT *, CAST(occupied = 1 AND (coalesce(lag(occupied) OVER l, 0) <> 1 OR timestamp - lag(timestamp) OVER l > INTERVAL 1 HOUR) AS INTEGER) AS s FROM frame WINDOW l AS (PARTITION BY zone_id ORDER BY timestamp))"


@query(f"WITH {v.FRAME}, {RUNS} SELECT count(*) FILTER (occupied = 1) AS positive_buckets, count(*) FILTER (occupied = 0) AS negative_buckets, sum(s)::BIGINT AS positive_events FROM e")
def w04_positive_events(spark, sf):
    return windows.evidence(v.frame(spark, sf), ["zone_id"], v.HOUR)


@query(f"{W}, d AS (SELECT zone_id, timestamp AS t, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY zone_id ORDER BY timestamp))) / 1e6 AS gap FROM readings), a AS (SELECT zone_id, max(gap) AS max_gap, min(gap) AS min_gap, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(t))) / 1e6 AS age FROM d GROUP BY 1) SELECT *, max_gap <= 30000 AND min_gap >= 5 AND age <= 9000 AS in_order FROM a")
def w05_cadence(spark, sf):
    return windows.cadence(v.readings(spark, sf), ["zone_id"], "2024-01-31 00:00:00", 10, 30000, 9000)


@query(f"WITH {v.FRAME}, q AS (SELECT *, row_number() OVER l AS n FROM frame WINDOW l AS (PARTITION BY zone_id ORDER BY timestamp)), b AS (SELECT unnest([6, 24, 72]) AS lookback) SELECT lookback, count(*) FILTER (n >= lookback AND occupied IS NOT NULL) AS windows, count(*) FILTER (n >= lookback AND occupied = 1) AS positive_windows FROM q, b GROUP BY 1")
def w06_windows_by_lookback(spark, sf):
    return windows.windows_by_lookback(v.frame(spark, sf), ["value"], [6, 24, 72], None, ["zone_id"])


@query(f"{W} SELECT seq, device_id, last_value(CASE WHEN k % 3 = 0 THEN k END IGNORE NULLS) OVER l AS brightness, last_value(CASE WHEN k % 5 = 0 THEN device_type END IGNORE NULLS) OVER l AS state FROM readings WINDOW l AS (PARTITION BY device_id ORDER BY timestamp, seq ROWS UNBOUNDED PRECEDING)")
def w07_carry_forward(spark, sf):
    r = v.readings(spark, sf).select("seq", "device_id", "timestamp", F.when(F.col("k") % 3 == 0, F.col("k")).alias("brightness"), F.when(F.col("k") % 5 == 0, F.col("device_type")).alias("state"))
    return windows.carry_forward(r, ["brightness", "state"], ["device_id"], ["timestamp", "seq"]).drop("timestamp")


@query(
    f"""WITH RECURSIVE {v.READINGS}, n AS (SELECT zone_id, seq, i, CASE WHEN i % 400 BETWEEN 20 AND 180 OR k % 10 = 1 THEN NULL ELSE value END AS x FROM (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY timestamp, seq) AS i FROM readings)),
    e AS (SELECT zone_id, seq, i, x AS ema FROM n WHERE i = 1 UNION ALL SELECT n.zone_id, n.seq, n.i, CASE WHEN n.x IS NULL THEN e.ema WHEN e.ema IS NULL THEN n.x ELSE n.x / 3 + e.ema * 2 / 3 END FROM e JOIN n ON n.zone_id = e.zone_id AND n.i = e.i + 1) SELECT seq, zone_id, round(ema, 8) AS ema FROM e"""
)
def w08_ema(spark, sf):
    """With over 150 missing values in a row, and infinite ones."""
    r = v.readings(spark, sf).withColumn("i", F.row_number().over(Window.partitionBy("zone_id").orderBy("timestamp", "seq")) % 400)
    x = F.when(F.col("i").between(20, 180), None).when(F.col("k") % 10 == 1, float("inf")).otherwise(F.col("value"))
    return windows.ema(r.withColumn("value", x), "value", ["zone_id"], ["timestamp", "seq"]).select("seq", "zone_id", F.round("ema", 8).alias("ema"))


@query(f"{W} SELECT device_id, max(timestamp) AS timestamp, arg_max(value, timestamp) AS value FROM readings GROUP BY 1")
def w09_latest_rows(spark, sf):
    return windows.latest_rows(v.readings(spark, sf)).select("device_id", "timestamp", "value")


@query(f"{W}, s AS (SELECT zone_id, timestamp, coalesce(lag(timestamp) OVER (PARTITION BY zone_id ORDER BY seq) < timestamp, true) AS up FROM readings) SELECT zone_id, bool_and(up) AS rising, count(DISTINCT timestamp) = count(*) AS \"unique\" FROM s GROUP BY 1")
def w10_strictly_rising(spark, sf):
    return windows.strictly_rising(v.readings(spark, sf), ["zone_id"])


DATES = "dates AS (SELECT d, row_number() OVER (ORDER BY d) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT CAST(timestamp AS DATE) AS d FROM frame))"


@query(f"WITH {v.FRAME}, {DATES} SELECT timestamp, zone_id, CASE WHEN i > n - 3 THEN 'test' ELSE 'pre_test' END AS split FROM frame JOIN dates ON d = CAST(timestamp AS DATE)")
def t01_blind_last_days(spark, sf):
    return splits.blind_last_days(v.frame(spark, sf), 3).select(*KEYS, "split")


@query(f"WITH {v.FRAME} SELECT timestamp, zone_id, CASE WHEN CAST(timestamp AS DATE) < DATE '2024-01-20' THEN 'pre_test' WHEN CAST(timestamp AS DATE) = DATE '2024-01-20' THEN 'test' ELSE 'excluded' END AS split FROM frame")
def t02_blind_date(spark, sf):
    return splits.blind_date(v.frame(spark, sf), "2024-01-20").select(*KEYS, "split")


@query(
    f"""WITH {v.HOURLY}, {COVERAGE}, e AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM coverage WHERE eligible), f AS (SELECT *, least(3, (n - 1) // 2) AS u FROM e),
    x AS (SELECT fold::INTEGER AS fold, date, i, n - u * 2 + (fold - 1) * 2 AS a FROM f, (SELECT unnest(range(1, 8)) AS fold) WHERE fold <= u)
    SELECT fold, CAST(date AS VARCHAR) AS date, CASE WHEN i < a THEN 'train' ELSE 'validation' END AS role FROM x WHERE i < a + 2"""
)
def t03_rolling_folds(spark, sf):
    return splits.rolling_folds(reports.date_coverage(v.hourly(spark, sf), v.HOUR, 0.2, "zone_id"), 3, 2).withColumn("date", F.col("date").cast("string"))


@query(f"WITH {v.HOURLY}, r AS (SELECT *, dense_rank() OVER (ORDER BY timestamp) AS i, (SELECT count(DISTINCT timestamp) FROM hourly) AS n FROM hourly) SELECT timestamp, zone_id, CASE WHEN i > n - least(greatest(1, ceil(n * 0.2)), n - 1) THEN 'validation' ELSE 'train' END AS role FROM r")
def t04_chronological_fold(spark, sf):
    return splits.chronological_fold(v.hourly(spark, sf), 0.2, True).select(*KEYS, "role")


@query(f"{W}, r AS (SELECT seq, row_number() OVER (ORDER BY timestamp, seq) AS i, count(*) OVER () AS n FROM readings) SELECT seq, CASE WHEN i <= floor(n * 0.70) THEN 'train' WHEN i <= floor(n * 0.85) THEN 'validation' ELSE 'test' END AS split FROM r")
def t05_split_70_15_15(spark, sf):
    return splits.split_70_15_15(v.readings(spark, sf), False, order=["timestamp", "seq"]).select("seq", "split")


@query(f"{W}, c AS (SELECT count(DISTINCT CAST(timestamp AS DATE)) - 1 AS dates FROM readings) SELECT dates, CASE WHEN dates >= 2 THEN 'rolling' ELSE 'emergency' END AS strict, 'bootstrap' AS without FROM c")
def t06_choose_mode(spark, sf):
    """How to validate on the dates before the last, with and without a look-back that strict rules allow."""
    dates = v.readings(spark, sf).select(F.col("timestamp").cast("date")).distinct().count() - 1
    return spark.createDataFrame([(dates, splits.choose_mode(dates, True), splits.choose_mode(dates, False))], "dates long, strict string, without string")


VIABLE = "c AS (SELECT lookback, CASE WHEN CAST(timestamp AS DATE) < DATE '2024-01-20' THEN 'train' ELSE 'validation' END AS role, zone_id, timestamp, occupied FROM frame, (SELECT unnest([6, 24, 2000]) AS lookback)), q AS (SELECT *, row_number() OVER (PARTITION BY lookback, role, zone_id ORDER BY timestamp) AS n FROM c), g AS (SELECT 1 AS fold, role, lookback, count(*) FILTER (n >= lookback AND occupied IS NOT NULL) AS windows, count(*) FILTER (n >= lookback AND occupied = 1) AS positive_windows FROM q GROUP BY 2, 3)"


@query(f"WITH {v.FRAME}, {VIABLE} SELECT *, positive_windows > 0 AND positive_windows < windows AS viable, CASE WHEN windows = 0 THEN 'no windows' WHEN positive_windows = 0 THEN 'no positive windows' WHEN positive_windows = windows THEN 'no negative windows' END AS reason FROM g")
def t07_lookback_viability(spark, sf):
    f = v.frame(spark, sf)
    day = F.col("timestamp").cast("date") < F.lit("2024-01-20").cast("date")
    return splits.lookback_viability({(1, "train"): f.where(day), (1, "validation"): f.where(~day)}, ["value"], [6, 24, 2000], None, ["zone_id"])


@query(f"WITH {v.FRAME}, {DATES} SELECT CASE WHEN i > n - 3 THEN 'test' ELSE 'pre_test' END AS split, count(*) AS rows, min(timestamp) AS first_time, max(timestamp) AS last_time, count(DISTINCT d) AS dates FROM frame JOIN dates ON d = CAST(timestamp AS DATE) GROUP BY 1")
def t08_split_report(spark, sf):
    return splits.split_report(splits.blind_last_days(v.frame(spark, sf), 3), ["split"])


@query(f"{W} SELECT seq, to_timestamp(epoch_us(timestamp) // 10000000 * 10)::TIMESTAMP AS slot, date_trunc('hour', timestamp) AS hour FROM readings")
def f01_floor(spark, sf):
    t = F.col("timestamp")
    return v.readings(spark, sf).select("seq", ft.floor_to(t).alias("slot"), ft.floor_to(t, 3600).alias("hour"))


@query(f"{W}, s AS (SELECT seq, date_trunc('second', timestamp) AS t FROM readings) SELECT seq, t + INTERVAL 8 HOUR AS aware, t AS local, t + INTERVAL 8 HOUR AS utc FROM s")
def f02_to_local(spark, sf):
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    return v.readings(spark, sf).select("seq", ft.to_local_naive(F.concat(text, F.lit("Z"))).alias("aware"), ft.to_local_naive(text).alias("local"), ft.to_local_naive(text, naive_means="utc").alias("utc"))


@query(f"{W} SELECT seq, CASE WHEN seq % 7 < 3 THEN date_trunc('second', timestamp) WHEN seq % 7 < 5 THEN date_trunc('second', timestamp) + INTERVAL 8 HOUR WHEN seq % 7 = 5 THEN date_trunc('second', timestamp) + INTERVAL 3 HOUR END AS t FROM readings")
def f03_message_time(spark, sf):
    """Three forms without a zone, which are local; seconds since 1970, Z and +05:00, which are instants; and no time."""
    kind, t = F.col("seq") % 7, F.col("timestamp")
    iso = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(kind == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss")).when(kind == 1, F.date_format(t, "yyyy-MM-dd_HH-mm-ss")).when(kind == 2, iso)
        .when(kind == 3, F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), t).cast("string")).when(kind == 4, F.concat(iso, F.lit("Z"))).when(kind == 5, F.concat(iso, F.lit("+05:00"))).otherwise("no time")
    )
    return v.readings(spark, sf).select("seq", ft.message_time(text).alias("t"))


@query(f"{W} SELECT seq, CASE WHEN seq % 3 = 0 THEN k::VARCHAR WHEN seq % 3 = 1 THEN (k + 1)::VARCHAR END AS found, CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN 1.0 ELSE k + 0.5 END::DOUBLE AS number, CASE WHEN k % 4 = 0 THEN 1 WHEN k % 4 = 1 THEN 0 WHEN k % 4 = 2 THEN 1 END AS state FROM readings")
def f04_f05_f06_parsers(spark, sf):
    r = v.readings(spark, sf)
    payload = F.when(F.col("seq") % 3 == 0, F.concat(F.lit('{"a.b":'), "k", F.lit(',"a":{"b":-1}}'))).when(F.col("seq") % 3 == 1, F.concat(F.lit('{"a":{"b":'), F.col("k") + 1, F.lit("}}"))).otherwise("{}")
    number = F.when(F.col("k") % 10 == 0, "").when(F.col("k") % 10 == 1, " True").otherwise(F.concat(F.lit(" "), "k", F.lit(".5")))
    state = F.when(F.col("k") % 4 == 0, " Occupied").when(F.col("k") % 4 == 1, "CLEAR").when(F.col("k") % 4 == 2, "2.5").otherwise("unheard of")
    return r.select("seq", scalars.first_present(payload, ["a.b", "c"]).alias("found"), scalars.to_float(number).alias("number"), scalars.to_binary(state).alias("state"))


@query(f"{W} SELECT seq, CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k % 3 = 1 OR k % 5 = 0 AS INTEGER) END AS anyone, CASE WHEN k % 2 = 0 THEN 0 WHEN k % 3 > 0 THEN CAST(k % 3 = 1 OR k % 5 = 0 AS INTEGER) END AS configured FROM readings")
def f07_radar_state(spark, sf):
    a = F.when(F.col("k") % 3 == 1, "true").when(F.col("k") % 3 == 2, "false")
    b = F.when((F.col("k") % 5 == 0) & (F.col("k") % 3 > 0), "on")
    return v.readings(spark, sf).select("seq", scalars.radar_state([a, b]).alias("anyone"), scalars.radar_state([a, b], F.when(F.col("k") % 2 == 0, "off")).alias("configured"))


@query(f"{W} SELECT seq, CASE WHEN k % 4 = 0 THEN k WHEN k % 4 = 1 THEN 0 WHEN k % 4 = 2 THEN k END AS persons FROM readings")
def f08_person_count(spark, sf):
    k = F.col("k")
    payload = F.when(k % 4 == 0, F.concat(F.lit('{"count":'), k, F.lit(".9}"))).when(k % 4 == 1, '{"occupancy_count":-3}').when(k % 4 == 2, F.concat(F.lit('{"counted_persons":"'), k, F.lit('","count":7}'))).otherwise('{"counted_persons":"many","count":3}')
    return v.readings(spark, sf).select("seq", scalars.person_count(payload).alias("persons"))


@query(f"{W} SELECT seq, zone_id::VARCHAR AS zone, k AS n FROM readings UNION ALL SELECT seq, '3', NULL FROM readings WHERE zone_id <> 3")
def f09_zone_counts(spark, sf):
    payload = F.concat(F.lit('{"counts_by_zone":{"'), "zone_id", F.lit('":'), "k", F.lit(',"99":1},"unlabeled_zones":[3,77]}'))
    return v.readings(spark, sf).select("seq", F.explode(scalars.zone_counts(payload)).alias("zone", "n"))


@query(f"{W} SELECT seq, CASE WHEN k BETWEEN 1 AND 16 THEN k END AS table_zone, 'air_1_' || device_id AS device, CASE WHEN k % 2 = 0 THEN 'co2' ELSE 'pm_2_5' END AS field FROM readings")
def f10_f11_names(spark, sf):
    entity = F.concat(F.lit("sensor.air_1_"), "device_id", F.when(F.col("k") % 2 == 0, "_co2").otherwise("_pm_2_5"))
    parts = scalars.entity_parts(entity)
    return v.readings(spark, sf).select("seq", scalars.zone_of_table(F.concat(F.lit("Table "), "k")).alias("table_zone"), parts["device_id"].alias("device"), parts["field"].alias("field"))


@query(f"WITH {v.GAPPY} SELECT seq, CASE WHEN k % 7 <> 0 THEN value END AS value, CAST(value IS NULL OR k % 7 = 0 AS INTEGER) AS value_missing FROM gappy")
def f12_missing_flags(spark, sf):
    g = v.gappy(spark, sf).select("seq", "value", F.when(F.col("k") % 7 == 0, 1).alias("value_missing"))
    once = scalars.with_missing_flags(g, ["value"])
    return scalars.with_missing_flags(once, ["value"])


@query(f"{W}, h AS (SELECT seq, hour(timestamp) + minute(timestamp) / 60 + floor(second(timestamp)) / 3600 AS h, isodow(timestamp) - 1 AS d FROM readings) SELECT seq, round(sin(2 * pi() * h / 24), 8) AS hour_sin, round(cos(2 * pi() * h / 24), 8) AS hour_cos, round(sin(2 * pi() * (d + h / 24) / 7), 8) AS dow_sin, round(cos(2 * pi() * (d + h / 24) / 7), 8) AS dow_cos FROM h")
def f13_cyclic_time(spark, sf):
    return v.readings(spark, sf).select("seq", *(F.round(c, 8).alias(n) for n, c in scalars.cyclic_time(F.col("timestamp")).items()))


@query(f"{W} SELECT seq, CASE WHEN k % 8 IN (0, 1) THEN 0 WHEN k % 8 IN (2, 3) THEN 1 END AS label FROM readings")
def f14_clean_label(spark, sf):
    k = F.col("k") % 8
    label = F.when(k == 0, 0.2).when(k == 1, 0.5).when(k == 2, 0.7).when(k == 3, 1.4).when(k == 4, 1.5).when(k == 5, 2.0).when(k == 6, float("nan"))
    return v.readings(spark, sf).select("seq", scalars.clean_label(label).alias("label"))


@query(f"WITH {v.GAPPY}, m AS (SELECT coalesce(median(value), 0) AS f, avg(value) AS a, stddev_pop(value) AS s FROM gappy) SELECT seq, round((coalesce(value, f) - a) / s, 8) AS value, CAST(value IS NULL AS INTEGER) AS value_missing FROM gappy, m")
def f15_f16_impute_standardise(spark, sf):
    g = scalars.with_missing_flags(v.gappy(spark, sf).select("seq", "value"), ["value"])
    fill = reports.fill_values(g, ["value"]).first()["value"]
    return scalars.standardise(scalars.impute(g, {"value": fill}), reports.scaler_stats(g, ["value"]), ["value"]).transform(rounded("value"))


@query(f"{W} SELECT zone_id, k % 2 AS occupied, round(sum(value), 2) AS temp_s5, max(k) AS rh_s5 FROM readings GROUP BY 1, 2")
def f18_f20_aliases(spark, sf):
    r = v.readings(spark, sf).withColumn("cv_is_occupied", F.col("k") % 2).groupBy("zone_id", "cv_is_occupied").agg(F.round(F.sum("value"), 2).alias("temperature_s5"), F.max("k").alias("humidity_s5"))
    return scalars.ordered_columns(scalars.rename_aliases(r), ["occupied", "temp_s5"])


@query(f"{W} SELECT seq, value AS temperature, k::DOUBLE AS humidity, device_type AS mode, CAST(NULL AS DOUBLE) AS target FROM readings")
def f19_hvac_state(spark, sf):
    payload = F.to_json(F.struct(F.struct(F.col("value").alias("current_temperature"), F.col("k").alias("current_humidity")).alias("attributes"), F.col("device_type").alias("state")))
    return v.readings(spark, sf).select("seq", *(c.alias(n) for n, c in scalars.hvac_state(payload).items()))


@query(f"{W} SELECT CASE WHEN k % 20 = 0 THEN 'unknown' WHEN k * 16 < 800 THEN 'good' WHEN k * 16 < 1200 THEN 'moderate' ELSE 'poor' END AS band, count(*) AS n FROM readings GROUP BY 1")
def f21_co2_band(spark, sf):
    co2 = F.when(F.col("k") % 20 != 0, F.col("k") * 16)
    return v.readings(spark, sf).groupBy(scalars.co2_band(co2).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH {v.SCORED}, c AS (SELECT *, greatest(1e-7, least(1 - 1e-7, probability)) AS p FROM scored) SELECT zone_id, count(*) AS n, count(*) FILTER (y = 1) AS positives, count(*) FILTER (y = 0) AS negatives, round(avg(y), 8) AS rate, round(avg(probability), 8) AS mean_probability, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 8) AS log_loss, round(avg((probability - y) * (probability - y)), 8) AS brier FROM c GROUP BY 1"
)
def l01_binary_metrics(spark, sf):
    return metrics.binary_metrics(v.scored(spark, sf), ["zone_id"]).transform(rounded("rate", "mean_probability", "log_loss", "brier"))


@query(
    f"WITH {v.SCORED}, g AS (SELECT zone_id, probability AS s, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM scored GROUP BY 1, 2), c AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER (PARTITION BY zone_id) AS a FROM g WINDOW w AS (PARTITION BY zone_id ORDER BY s DESC)) SELECT zone_id, round(sum(p / a * tp / (tp + fp))::DOUBLE, 8) AS pr_auc FROM c GROUP BY 1"
)
def l02_average_precision(spark, sf):
    return metrics.average_precision(v.scored(spark, sf), ["zone_id"]).transform(rounded("pr_auc"))


@query(
    f"WITH {v.SCORED}, g AS (SELECT zone_id, probability AS s, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM scored GROUP BY 1, 2), c AS (SELECT *, coalesce(sum(p + n) OVER (PARTITION BY zone_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM g) SELECT zone_id, round(((sum(p * (b + (p + n + 1) / 2)) - sum(p) * (sum(p) + 1) / 2) / (sum(p) * sum(n)))::DOUBLE, 8) AS roc_auc FROM c GROUP BY 1"
)
def l03_roc_auc(spark, sf):
    return metrics.roc_auc(v.scored(spark, sf), ["zone_id"]).transform(rounded("roc_auc"))


@query(f"WITH {v.SCORED} SELECT count(*) FILTER (y = 0) / greatest(count(*) FILTER (y = 1), 1) AS positive_weight FROM scored")
def l04_class_weight(spark, sf):
    return metrics.class_weight(v.scored(spark, sf))


def _occupancy(spark, sf):
    """The frame as numbers with missing flags, and its window features."""
    f = scalars.with_missing_flags(v.frame(spark, sf), ["value"])
    return models.window_features(f, ["value", "value_missing"], 6, ["zone_id"])


FEATURES = ["value", "value_missing"]


@query()
def l05_cross_validation(spark, sf):
    """Average precision of each rolling fold."""
    folds = splits.rolling_folds(reports.date_coverage(v.hourly(spark, sf), v.HOUR, 0.2, "zone_id"), 2, 2)
    return models.cross_validate(_occupancy(spark, sf), folds, FEATURES)


@query()
def l06_predictions(spark, sf):
    """Predictions for the blind days of a model fitted to those before."""
    rows = splits.blind_last_days(_occupancy(spark, sf), 3)
    model = models.fit_occupancy(rows.where("split = 'pre_test'"), FEATURES)
    return models.predict(model, rows.where("split = 'test' AND occupied IS NOT NULL"), KEYS, split="test")


@query()
def l07_score_latest(spark, sf):
    """The latest window of each zone, scored."""
    rows = _occupancy(spark, sf)
    return models.score_latest(models.fit_occupancy(rows, FEATURES), rows)


BLIND = f"q AS (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY timestamp) AS n FROM frame), {DATES.replace('FROM frame', 'FROM q WHERE n >= 6')}, blind AS (SELECT q.* FROM q JOIN dates ON d = CAST(timestamp AS DATE) WHERE q.n >= 6 AND occupied IS NOT NULL AND i > dates.n - 3)"


@query(f"WITH {v.FRAME}, {BLIND} SELECT timestamp, zone_id, 'test' AS split, occupied AS y_true, true AS within FROM blind")
def l06_prediction_rows(spark, sf):
    """The rows of the prediction table, and whether each probability is one."""
    return l06_predictions(spark, sf).select(*KEYS, "split", "y_true", F.col("probability").between(0.0, 1.0).alias("within"))


@query(f"WITH {v.GRID} SELECT zone_id, max(timestamp) AS timestamp, true AS within FROM grid GROUP BY 1")
def l07_scored_zones(spark, sf):
    """The latest window of each zone, and whether its probability is one."""
    return l07_score_latest(spark, sf).select("zone_id", "timestamp", F.col("probability").between(0.0, 1.0).alias("within"))


@query(f"WITH {v.FRAME}, {COVERAGE}, {BLIND}, p AS (SELECT count(*) AS n FROM coverage WHERE eligible AND date <= (SELECT max(date) FROM coverage) - 3) SELECT greatest(0, least(2, (n - 1) // 2))::INTEGER AS folds, true AS best_mean, true AS within, (SELECT count(*) FROM blind) AS test_rows FROM p")
def l05_selection(spark, sf):
    """Of two candidates the one of the better mean fold score, fitted again to all days before the blind ones and scored on those."""
    coverage = reports.date_coverage(v.hourly(spark, sf), v.HOUR, 0.2, "zone_id")
    last = coverage.agg(F.max("date")).first()[0]
    folds = splits.rolling_folds(coverage.where(F.col("date") <= F.date_sub(F.lit(last), 3)), 2, 2)
    chosen = models.select_and_test(_occupancy(spark, sf), folds, {"level": ["value"], "level and flag": FEATURES}, 3)
    best = chosen["mean"][chosen["candidate"]] >= max(chosen["mean"].values())
    scores = [x for fold in chosen["folds"].values() for x in fold] + [chosen["test_pr_auc"]]
    return spark.createDataFrame([(len(chosen["folds"][chosen["candidate"]]), best, all(0 <= x <= 1 for x in scores), chosen["test_rows"])], "folds int, best_mean boolean, within boolean, test_rows long")


RUN = """r AS (SELECT device_id AS run, CASE WHEN device_id % 11 = 0 THEN 'bootstrap' WHEN device_id % 13 = 0 THEN 'degenerate' ELSE 'strict' END AS mode, CASE WHEN device_id % 17 > 0 THEN 1 + device_id % 3 END AS folds,
    CASE WHEN device_id % 19 = 0 THEN 'NaN'::DOUBLE ELSE avg(value) / 100 END AS pr_auc, CASE WHEN device_id % 23 > 0 THEN avg(k) / 100 END AS cv_pr_auc, CASE WHEN device_id % 29 > 0 THEN count(*) END AS positive_windows,
    CASE WHEN device_id % 31 > 0 THEN max(k) END AS positive_buckets, CASE WHEN device_id % 37 > 0 THEN min(k) END AS positive_events, CASE WHEN device_id % 41 = 0 THEN 'Infinity'::DOUBLE ELSE min(value) / 10 END AS brier, CASE WHEN device_id % 43 > 0 THEN avg(k) / 80 END AS log_loss,
    CASE WHEN device_id % 4 = 1 THEN 'bootstrap' WHEN device_id % 4 > 1 THEN 'strict' END AS production_mode, 1 + device_id % 2 AS production_folds, CASE WHEN device_id % 7 = 0 THEN avg(value) / 100 ELSE max(k) / 250 END AS production_reported,
    CASE WHEN device_id % 5 = 0 THEN avg(value) / 100 WHEN device_id % 9 > 0 THEN max(k) / 250 END AS production_pr_auc FROM readings GROUP BY 1)"""
BAD = lambda name, least: f"{name} IS NULL OR NOT isfinite({name}::DOUBLE) OR {name} < {least}"
OVER = lambda name, most: f"{name} IS NULL OR NOT isfinite({name}::DOUBLE) OR {name} > {most}"


@query(
    f"""{W}, {RUN}, q AS (SELECT *, CASE WHEN production_mode = 'strict' THEN least(production_folds + 1, 3) ELSE 1 END AS required,
      coalesce(mode = 'strict' AND production_mode = 'strict' AND folds = 1 AND production_folds = 1 AND isfinite(pr_auc) AND isfinite(production_reported) AND pr_auc > production_reported + 0.01, false) AS better FROM r),
    p AS (SELECT *, CASE WHEN better AND folds < required THEN production_reported ELSE production_pr_auc END AS against FROM q),
    x AS (SELECT *, CASE WHEN mode = 'bootstrap' AND production_mode IS NOT NULL THEN 'bootstrap only without production' WHEN mode = 'degenerate' THEN 'degenerate validation' WHEN mode <> 'bootstrap' AND folds IS NULL THEN 'no strict folds'
      WHEN mode = 'strict' AND folds < required AND NOT better THEN 'too few folds' WHEN {BAD('pr_auc', 0.4)} THEN 'test score too low' WHEN {BAD('cv_pr_auc', 0.4)} THEN 'fold score too low' WHEN {BAD('positive_windows', 50)} THEN 'too few positive windows'
      WHEN {BAD('positive_buckets', 50)} THEN 'too few positive buckets' WHEN {BAD('positive_events', 1)} THEN 'too few positive events' WHEN {OVER('brier', 0.25)} THEN 'brier score too high' WHEN {OVER('log_loss', 0.7)} THEN 'log loss too high'
      WHEN production_mode IS NOT NULL AND (against IS NULL OR NOT isfinite(against)) THEN 'no production score' WHEN production_mode IS NOT NULL AND pr_auc <= against + 0.01 THEN 'not better than production' END AS z FROM p)
    SELECT run, CASE WHEN z IS NULL THEN 'promote' WHEN z = 'not better than production' THEN 'skip' ELSE 'fail' END AS decision, coalesce(z, 'all thresholds met') AS reason FROM x"""
)
def l08_promotion(spark, sf):
    """Runs of devices, with missing, NaN and infinite evidence and production of every kind."""
    k, val, d = F.col("k"), F.col("value"), F.col("device_id")
    some = lambda n, x: F.when(F.first(d) % n > 0, x)
    runs = v.readings(spark, sf).groupBy(d.alias("run")).agg(
        F.when(F.first(d) % 19 == 0, float("nan")).otherwise(F.avg(val) / 100).alias("pr_auc"), some(23, F.avg(k) / 100).alias("cv_pr_auc"), some(29, F.count(F.lit(1))).alias("positive_windows"), some(31, F.max(k)).alias("positive_buckets"), some(37, F.min(k)).alias("positive_events"),
        F.when(F.first(d) % 41 == 0, float("inf")).otherwise(F.min(val) / 10).alias("brier"), some(43, F.avg(k) / 80).alias("log_loss"), (F.max(k) / 250).alias("mk"), (F.avg(val) / 100).alias("mean"),
    )
    r = F.col("run")
    runs = runs.withColumns({
        "mode": F.when(r % 11 == 0, "bootstrap").when(r % 13 == 0, "degenerate").otherwise("strict"), "folds": F.when(r % 17 > 0, 1 + r % 3), "production_mode": F.when(r % 4 == 1, "bootstrap").when(r % 4 > 1, "strict"), "production_folds": 1 + r % 2,
        "production_reported": F.when(r % 7 == 0, F.col("mean")).otherwise(F.col("mk")), "production_pr_auc": F.when(r % 5 == 0, F.col("mean")).when(r % 9 > 0, F.col("mk")),
    })
    return metrics.promotion(runs, {"positive_windows": 50, "positive_buckets": 50, "pr_auc": 0.4, "cv_pr_auc": 0.4, "brier": 0.25, "log_loss": 0.7, "delta": 0.01}).select("run", "decision", "reason")


@query(
    f"""{W} SELECT zone_id, coalesce(round(avg(value) FILTER (k % 10 > 1), 8), -1) AS mean_score, round(stddev_pop(value) FILTER (k % 10 > 1), 8) AS std_score,
    least(45, greatest(1, coalesce(ceil(median(k) FILTER (k > 0))::BIGINT, 45)))::BIGINT AS epochs FROM readings GROUP BY 1"""
)
def l09_fold_summary(spark, sf):
    """Scores some of which are NaN or infinite, and best epochs some of which are 0."""
    score = F.when(F.col("k") % 10 == 0, float("nan")).when(F.col("k") % 10 == 1, float("inf")).otherwise(F.col("value"))
    return metrics.fold_summary(v.readings(spark, sf).withColumn("value", score), "value", "k", ["zone_id"], 45).transform(rounded("mean_score", "std_score"))


def _fixed(spark, weights: str):
    """A model of fixed weights, saved and loaded, so that SQL can tell its probabilities."""
    path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    score = f"1 / (1 + exp(-({weights})))"
    PipelineModel([SQLTransformer(statement=f"SELECT *, array(1 - {score}, {score}) AS _both FROM __THIS__"), SQLTransformer(statement="SELECT *, _both[1] AS probability FROM __THIS__")]).write().save(path)
    return PipelineModel.load(path)


PAIR = """q AS (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY timestamp) AS n, avg(value) OVER w AS a, max(value) OVER w AS m FROM frame WINDOW w AS (PARTITION BY zone_id ORDER BY timestamp ROWS 5 PRECEDING)),
    d AS (SELECT max(CAST(timestamp AS DATE)) AS last FROM q), z AS (SELECT q.*, round(1 / (1 + exp(-(0.01 * coalesce(a, 0) - 1))), 3) AS c, round(1 / (1 + exp(-(1 - 0.01 * coalesce(m, 0)))), 3) AS p FROM q, d WHERE n >= 6 AND occupied IS NOT NULL AND CAST(timestamp AS DATE) > last - 3),
    t AS (SELECT zone_id % 3 AS run, occupied AS y, c, p FROM z), u AS (SELECT run, c AS s, y, 'c' AS who FROM t UNION ALL SELECT run, p, y, 'p' FROM t),
    g AS (SELECT run, who, s, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM u GROUP BY 1, 2, 3), h AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER (PARTITION BY run, who) AS a FROM g WINDOW w AS (PARTITION BY run, who ORDER BY s DESC)),
    ap AS (SELECT run, sum(p / a * tp / (tp + fp)) FILTER (who = 'c')::DOUBLE AS pr_auc, sum(p / a * tp / (tp + fp)) FILTER (who = 'p')::DOUBLE AS production_pr_auc FROM h GROUP BY 1)"""


@query(
    f"""WITH {v.FRAME}, {PAIR} SELECT run, (SELECT count(*) FROM t WHERE t.run = ap.run) AS rows, round(pr_auc, 8) AS pr_auc, round(production_pr_auc, 8) AS production_pr_auc, CASE WHEN pr_auc > production_pr_auc + 0.01 THEN 'promote' ELSE 'skip' END AS decision FROM ap"""
)
def l08_same_window(spark, sf):
    """Two saved models, loaded and scored on the same blind windows of three groups of zones, and what is decided from that."""
    rows = splits.blind_last_days(models.window_features(v.frame(spark, sf), ["value"], 6, ["zone_id"]), 3).where("split = 'test' AND occupied IS NOT NULL")
    candidate, production = _fixed(spark, "0.01 * value_avg - 1"), _fixed(spark, "1 - 0.01 * value_max")
    scored = lambda m, run: m.transform(rows.where(F.col("zone_id") % 3 == run)).select(*KEYS, F.col("occupied").alias("y_true"), F.round("probability", 3).alias("probability"))
    out = None
    for run in range(3):
        pair = models.same_window(scored(candidate, run), scored(production, run), KEYS).withColumn("run", F.lit(run))
        out = pair if out is None else out.unionByName(pair)
    full = out.withColumns({"mode": F.lit("strict"), "folds": F.lit(3), "cv_pr_auc": F.lit(0.5), "positive_buckets": F.lit(99), "positive_events": F.lit(9), "production_mode": F.lit("strict"), "production_folds": F.lit(2), "production_reported": F.lit(0.9)})
    decided = metrics.promotion(full, {"positive_windows": 1, "delta": 0.01})
    return decided.select(F.col("run").cast("long").alias("run"), "rows", F.round("pr_auc", 8).alias("pr_auc"), F.round("production_pr_auc", 8).alias("production_pr_auc"), "decision")


LEVEL = "0.004 * value_avg - 0.003 * value_sd + 0.002 * value_min - 0.001 * value_max + 0.005 * value_now - 0.6"
WINDOWS = """u AS (SELECT *, row_number() OVER o AS n, avg(value) OVER w AS a, stddev_pop(value) OVER w AS s, min(value) OVER w AS lo, max(value) OVER w AS hi FROM frame WINDOW o AS (PARTITION BY zone_id ORDER BY timestamp), w AS (PARTITION BY zone_id ORDER BY timestamp ROWS 5 PRECEDING)),
    s AS (SELECT *, round(1 / (1 + exp(-(0.004 * coalesce(a, 0) - 0.003 * coalesce(s, 0) + 0.002 * coalesce(lo, 0) - 0.001 * coalesce(hi, 0) + 0.005 * coalesce(value, a, 0) - 0.6))), 8) AS probability FROM u WHERE n >= 6)"""


@query(f"WITH {v.FRAME}, {WINDOWS}, d AS (SELECT max(CAST(timestamp AS DATE)) AS last FROM s) SELECT timestamp, zone_id, 'test' AS split, occupied AS y_true, probability FROM s, d WHERE occupied IS NOT NULL AND CAST(timestamp AS DATE) > last - 3")
def l06_stored_model(spark, sf):
    """The prediction table of a saved model for the blind days, probabilities included."""
    rows = splits.blind_last_days(models.window_features(v.frame(spark, sf), ["value"], 6, ["zone_id"]), 3).where("split = 'test' AND occupied IS NOT NULL")
    return models.predict(_fixed(spark, LEVEL), rows, KEYS, split="test").withColumn("probability", F.round("probability", 8))


@query(f"WITH {v.FRAME}, {WINDOWS} SELECT zone_id, max(timestamp) AS timestamp, arg_max(probability, timestamp) AS probability FROM s GROUP BY 1")
def l07_stored_model(spark, sf):
    """The latest window of each zone, scored by a saved model."""
    windows_ = models.window_features(v.grid(spark, sf), ["value"], 6, ["zone_id"])
    return models.score_latest(_fixed(spark, LEVEL), windows_).withColumn("probability", F.round("probability", 8))


@query()
def l05_best_rounds(spark, sf):
    """Best boosting round and average precision of each rolling fold, and the rounds that the model of all folds is fitted for."""
    folds = splits.rolling_folds(reports.date_coverage(v.hourly(spark, sf), v.HOUR, 0.2, "zone_id"), 2, 2)
    model, found, summary = models.fit_at_best_round(_occupancy(spark, sf), folds, FEATURES, 8)
    return found.withColumns({"rounds": F.lit(model.stages[-1].getNumTrees), "mean_score": F.lit(summary["mean_score"])})


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _with_rocks(spark, run):
    """Operators with their own state keep it in RocksDB."""
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, ROCKS)
    try:
        return run()
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _streamed(spark, sf, name, make):
    """Run a streaming query over the events as a file stream into Parquet and read it back."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = v.load(spark, sf, "events").schema
    # a file stream takes a folder; the glob leaves the other tables out
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = e.select(F.col("ts").cast("timestamp").alias("event_time"), (F.col("user_id") % 15 + 1).alias("zone_id"), F.get_json_object("props", "$.k").cast("int").alias("k"), "event_type", F.col("event_id").alias("seq"), "value")
    out = make(rows)
    out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).outputMode("append").start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/out")


@query(f"{W}, m AS (SELECT *, CASE WHEN k % 7 <> 0 THEN k % 4 END AS c FROM readings) SELECT date_trunc('hour', timestamp) AS bucket, zone_id, count(c) AS sample_count, min(c) AS min_count, max(c) AS max_count, round(avg(c), 3) AS mean_count, median(c)::DOUBLE AS median_count, CAST(median(c) >= 1 AS INTEGER) AS occupied FROM m GROUP BY 1, 2 HAVING date_trunc('hour', min(timestamp)) + INTERVAL 1 HOUR <= (SELECT max(timestamp) - INTERVAL 5 SECOND FROM readings)")
def x01_x02_stream_buckets(spark, sf):
    """Hourly counts of zones as a stream; buckets that the watermark has not closed are not out yet."""
    make = lambda rows: streams.count_buckets(rows.withColumn("occupancy_count", F.when(F.col("k") % 7 != 0, F.col("k") % 4)), v.HOUR, 5, ["zone_id"])
    out = _streamed(spark, sf, "x01", make)
    return out.select(F.col("bucket").cast("timestamp_ntz").alias("bucket"), "zone_id", "sample_count", "min_count", "max_count", "mean_count", "median_count", "occupied")


@query(f"{W} SELECT DISTINCT timestamp, zone_id FROM readings")
def x04_stream_once(spark, sf):
    """The rows themselves, each message being there twice."""
    out = _streamed(spark, sf, "x04", lambda rows: streams.once(rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))), ["zone_id", "event_time"]))
    return out.select(F.col("event_time").cast("timestamp_ntz").alias("timestamp"), "zone_id")


@query(
    f"""{W}, p AS (SELECT zone_id, date_trunc('second', timestamp) AS t, timestamp AS u FROM readings WHERE device_type = 'click'), g AS (SELECT *, CASE WHEN u - lag(u) OVER w < INTERVAL 7200 SECOND THEN 0 ELSE 1 END AS s FROM p WINDOW w AS (PARTITION BY zone_id ORDER BY u)),
    i AS (SELECT *, sum(s) OVER (PARTITION BY zone_id ORDER BY u) AS i FROM g) SELECT zone_id, min(u) AS session_start, max(u) AS last_row, count(*) AS rows FROM i GROUP BY zone_id, i HAVING max(u) + INTERVAL 7200 SECOND <= (SELECT max(u) - INTERVAL 5 SECOND FROM p)"""
)
def x09_stream_sessions(spark, sf):
    out = _streamed(spark, sf, "x09", lambda rows: streams.sessions(rows.where("event_type = 'click'"), 7200, ["zone_id"]))
    return out.select("zone_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("last_row").cast("timestamp_ntz").alias("last_row"), "rows")


@query(
    f"""{W}, s AS (SELECT zone_id, seq, value, date_trunc('hour', timestamp) AS b, max(date_trunc('hour', timestamp)) OVER (PARTITION BY zone_id ORDER BY timestamp, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM readings),
    l AS (SELECT zone_id, max(b) AS last FROM s GROUP BY 1) SELECT s.zone_id, b AS bucket, round(avg(value), 8) AS value, count(*) AS samples, 0::BIGINT AS late FROM s JOIN l ON l.zone_id = s.zone_id AND s.b < l.last GROUP BY 1, 2"""
)
def x03_room_buckets(spark, sf):
    """Hourly means of zones in the order of time: a later hour closes those before, the last one stays open, and nothing is late."""
    make = lambda rows: streams.room_buckets_in_order(rows.withColumn("seq", F.unix_micros("event_time") * 4096 + F.col("seq") % 4096), ["value"], v.HOUR, "zone_id")
    out = _with_rocks(spark, lambda: _streamed(spark, sf, "x03", make))
    return out.select(F.col("room").alias("zone_id"), F.col("bucket").cast("timestamp_ntz").alias("bucket"), F.round("value", 8).alias("value"), "samples", "late")


def _batches(spark, sf):
    """Two micro-batches of partial rows: values first, then some labels and newer values of the same keys."""
    r = v.readings(spark, sf).select("device_id", "seq", "value", "k")
    one = r.where("seq % 2 = 0").select("device_id", F.col("seq").alias("at"), F.when(F.col("k") % 4 > 0, F.col("value")).alias("value"), F.lit(None).cast("int").alias("label"))
    two = r.where("seq % 2 = 1").select("device_id", F.col("seq").alias("at"), F.when(F.col("k") % 5 == 0, F.col("value")).alias("value"), F.when(F.col("k") % 3 == 0, F.col("k")).alias("label"))
    return one, two


@query(f"{W} SELECT device_id, coalesce(arg_max(value, seq) FILTER (seq % 2 = 1 AND k % 5 = 0), arg_max(value, seq) FILTER (seq % 2 = 0 AND k % 4 > 0)) AS value, arg_max(k, seq) FILTER (seq % 2 = 1 AND k % 3 = 0) AS label FROM readings GROUP BY 1")
def x05_sparse_appends(spark, sf):
    """A table into which two micro-batches are merged, column by column."""
    path, state = f"{shared_dir(spark)}/x05-{uuid.uuid4().hex}", []

    def replace(df):
        df.write.parquet(f"{path}/{len(state)}")
        state.append(spark.read.schema(df.schema).parquet(f"{path}/{len(state)}"))

    run = streams.merge_sparse(lambda: state[-1] if state else None, replace, ["device_id"], "at")
    for i, batch in enumerate(_batches(spark, sf)):
        run(batch, i)
    return state[-1].select("device_id", "value", "label")


@query(f"{W} SELECT seq, zone_id, last_value(CASE WHEN k % 3 = 0 THEN k::VARCHAR END IGNORE NULLS) OVER l AS brightness, last_value(CASE WHEN k % 5 = 0 THEN device_type END IGNORE NULLS) OVER l AS state FROM readings WINDOW l AS (PARTITION BY zone_id ORDER BY timestamp, seq ROWS UNBOUNDED PRECEDING)")
def x06_stream_carry_forward(spark, sf):
    """Partial updates of zones filled from state."""
    updates = lambda rows: rows.select("zone_id", "event_time", "seq", F.when(F.col("k") % 3 == 0, F.col("k").cast("string")).alias("brightness"), F.when(F.col("k") % 5 == 0, F.col("event_type")).alias("state"))
    out = _with_rocks(spark, lambda: _streamed(spark, sf, "x06", lambda rows: streams.carry_forward_stream(updates(rows), ["brightness", "state"], "zone_id")))
    return out.select("seq", "zone_id", "brightness", "state")


@query(f"{W} SELECT date_trunc('hour', timestamp) AS bucket, zone_id, count(*) AS n FROM readings GROUP BY 1, 2")
def x07_restart(spark, sf):
    """Buckets written by a run that stops half way and is started again from the beginning."""
    path, parts = f"{shared_dir(spark)}/x07-{uuid.uuid4().hex}", []

    def write(df):
        df.write.parquet(f"{path}/{len(parts)}")
        parts.append(f"{path}/{len(parts)}")

    rows = v.readings(spark, sf).groupBy(buckets.floor_to(F.col("timestamp"), v.HOUR).alias("bucket"), "zone_id").agg(F.count(F.lit(1)).alias("n"))
    run = streams.append_new(lambda: spark.read.schema(rows.schema).parquet(*parts) if parts else None, write, ["bucket", "zone_id"], ["n"])
    run(rows.where("zone_id <= 7"), 0)
    run(rows, 0)
    return spark.read.schema(rows.schema).parquet(*parts)


@query(f"{W} SELECT seq, CASE WHEN k % 3 > 0 THEN timestamp ELSE timestamp + INTERVAL 5 SECOND END AS payload_first, timestamp + INTERVAL 5 SECOND AS received FROM readings")
def x08_event_time(spark, sf):
    payload, received = F.when(F.col("k") % 3 > 0, F.col("timestamp")), F.timestamp_add("SECOND", F.lit(5), F.col("timestamp"))
    return v.readings(spark, sf).select("seq", streams.event_time(payload, received).alias("payload_first"), streams.event_time(payload, received, False).alias("received"))


@query(
    f"""WITH {v.GAPPY}{v.LABELS[len(v.READINGS):]}, g AS (SELECT count(value) / count(*) >= 0.7 AND count(k) / count(*) >= 0.95 AS gate_ok FROM gappy), d AS (SELECT zone_id, timestamp, epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY zone_id ORDER BY timestamp)) AS gap FROM gappy),
    c AS (SELECT zone_id, max(timestamp) AS timestamp, max(gap) <= 300000000 AND min(gap) >= 5000000 AND epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(timestamp)) <= 900000000 AS in_order FROM d GROUP BY 1),
    l AS (SELECT timestamp AS lt, zone_id, max(source_topic) AS label FROM labels_raw GROUP BY 1, 2)
    SELECT c.zone_id, c.timestamp, 0.5::DOUBLE AS probability, coalesce(c.in_order, false) AS in_order, g.gate_ok, l.label FROM g, c ASOF LEFT JOIN l ON l.zone_id = c.zone_id AND c.timestamp >= l.lt"""
)
def x10_live_scores(spark, sf):
    """One event for each zone from its newest row: gate, cadence, probability and the label as of then."""
    labels = v.labels_raw(spark, sf).groupBy(F.col("timestamp").alias("label_time"), "zone_id").agg(F.max("source_topic").alias("label"))
    score = lambda df: df.select("zone_id", "timestamp", F.lit(0.5).alias("probability"))
    out = streams.live_scores(v.gappy(spark, sf), score, labels, {"value": 0.7, "k": 0.95}, "2024-01-31 00:00:00", ["zone_id"])
    return out.select("zone_id", "timestamp", "probability", F.coalesce("in_order", F.lit(False)).alias("in_order"), "gate_ok", "label")
