"""Queries of sources, lookups, merges and joins."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars
from ..operators import buckets, joins, merge, windows
from ..operators import query as q
from ..sources import catalog, ingest, io, versions
from ..session import shared_dir
from . import views as v
from .registry import query

DAY1, DAY2 = "2024-01-05 00:00:00", "2024-01-12 12:00:00"
W = "WITH " + v.READINGS
WG = "WITH " + v.GAPPY
COLS = "timestamp, device_id, device_type, value, seq"
C = ["timestamp", "device_id", "device_type", "value", "seq"]


def base(spark, sf):
    return v.readings(spark, sf).select(*C)


@query(f"WITH {v.FRAME} SELECT timestamp, zone_id, round(value, 8) AS value, CAST(value IS NULL AS INTEGER) AS value_missing, occupied FROM frame")
def slice_feature_frame(spark, sf):
    """Readings to hourly means on a dense grid, with missing flags and labels."""
    return scalars.with_missing_flags(v.frame(spark, sf), ["value"]).select("timestamp", "zone_id", F.round("value", 8).alias("value"), "value_missing", "occupied")


@query(f"{W} SELECT CAST(strftime(timestamp, '%Y') AS INTEGER) AS year, CAST(strftime(timestamp, '%m') AS INTEGER) AS month, CAST(strftime(timestamp, '%d') AS INTEGER) AS day, count(*) AS n, sum(seq)::BIGINT AS total FROM readings GROUP BY ALL")
def s01_s02_partitioned_store(spark, sf):
    """Write by day and scan again with the partition columns."""
    path = f"{shared_dir(spark)}/raw-{uuid.uuid4().hex}"
    io.save_by_day(base(spark, sf), path)
    return io.scan_raw(spark, path).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("total"))


def shared_path(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"{W} SELECT CAST(strftime(timestamp, '%Y') AS INTEGER) AS year, CAST(strftime(timestamp, '%m') AS INTEGER) AS month, CAST(strftime(timestamp, '%d') AS INTEGER) AS day, count(*) AS n, sum(seq)::BIGINT AS total, count(DISTINCT device_type) AS types FROM readings GROUP BY ALL")
def s03_convert(spark, sf):
    """CSV files of a device into its store by day."""
    path = shared_path(spark, "convert")
    rows = base(spark, sf).select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"), "device_id", "device_type", "seq")
    rows.write.option("header", True).csv(f"{path}/csv")
    io.convert(spark, f"{path}/csv", "csv", f"{path}/store", device="air-1")
    return io.scan_raw(spark, f"{path}/store/air-1").groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").cast("long").alias("total"), F.countDistinct("device_type").alias("types"))


@query(f"{W} SELECT 'bronze.air_1' AS \"table\", count(*) AS rows, 5 AS columns FROM readings UNION ALL SELECT 'silver.msr_2', 0, 0")
def s05_catalog(spark, sf):
    """A flat table moved to its layer, and one that is not there."""
    catalog.create_layers(spark)
    own = f"bronze_s05_{uuid.uuid4().hex[:12]}"
    base(spark, sf).write.mode("overwrite").saveAsTable(own)
    moved = [t for t in catalog.migrate_flat(spark) if t.endswith(own[len("bronze_") :])]
    rows = [("bronze.air_1", catalog.row_count(spark, moved[0]), len(catalog.column_names(spark, moved[0]))), ("silver.msr_2", catalog.row_count(spark, "silver.no_such_table"), len(catalog.column_names(spark, "silver.no_such_table")))]
    return spark.createDataFrame(rows, "`table` string, rows long, columns int")


@query(
    f"""{W}, l AS (SELECT seq, device_id % 10 AS file, 1 + row_number() OVER (PARTITION BY device_id % 10 ORDER BY seq) AS number, CASE WHEN seq % 97 = 0 THEN 1 WHEN seq % 89 = 0 THEN 4 ELSE 3 END AS width FROM readings)
    SELECT 'bad' AS part, file, number, width FROM l WHERE width <> 3 UNION ALL SELECT 'good', file, count(*), 3 FROM l WHERE width = 3 GROUP BY 2"""
)
def s07_csv_width(spark, sf):
    """Files of lines some of which are too short or too long: where those are, and how many rows of each file are good."""
    path = shared_path(spark, "csv")
    r = v.readings(spark, sf).withColumn("file", F.col("device_id") % 10)
    text = F.when(F.col("seq") % 97 == 0, F.col("seq").cast("string")).when(F.col("seq") % 89 == 0, F.concat_ws(",", "seq", "file", "k", F.lit("more"))).otherwise(F.concat_ws(",", "seq", "file", F.lit('"a, b"')))
    header = r.select("file", F.lit(-1).cast("long").alias("seq"), F.lit("seq,file,text").alias("value")).distinct()
    lines = r.select("file", "seq", text.alias("value")).unionByName(header)
    lines.repartition("file").sortWithinPartitions("file", "seq").select("file", "value").write.partitionBy("file").text(path)
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("file", T.LongType()), T.StructField("text", T.StringType())])
    good, bad = io.read_csv_checked(spark, f"{path}/file=*/*.txt", schema, skip=True)
    bad = bad.select(F.lit("bad").alias("part"), F.regexp_extract("file", r"/file=(\d+)/", 1).cast("long").alias("file"), "number", "width")
    return bad.unionByName(good.where("text = 'a, b'").groupBy("file").agg(F.count(F.lit(1)).alias("number")).select(F.lit("good").alias("part"), "file", "number", F.lit(3).alias("width")))


@query(f"{W} SELECT device_id, CAST(timestamp AS DATE)::VARCHAR AS day, count(*) AS n, round(sum(value), 4) AS total FROM readings GROUP BY 1, 2")
def s04_other_store(spark, sf):
    """A day-partitioned store and a table of versions, written and read through another file system than that of the session: a view with a mount."""
    inner = shared_path(spark, "store")
    store = versions.Files(spark, inner)
    store.fs.mkdirs(store.path(inner))
    name = f"s04{uuid.uuid4().hex[:12]}"
    mount = f"fs.viewfs.mounttable.{name}.link./data"
    spark.conf.set(mount, inner if "://" in inner else f"file://{inner}")
    try:
        base_ = f"viewfs://{name}/data"
        io.save_by_day(base(spark, sf), f"{base_}/raw")
        rows = io.scan_raw(spark, f"{base_}/raw").groupBy("device_id", F.col("timestamp").cast("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
        table = versions.VersionedTable(spark, f"{base_}/table", rows.schema, F.col("day"))
        table.append(rows, "s04", 0)
        # read by its own name, as the mount ends with this call
        return versions.VersionedTable(spark, f"{inner}/table", rows.schema, F.col("day")).read()
    finally:
        spark.conf.unset(mount)


@query(
    f"""{W}, l AS (SELECT seq, device_id % 10 AS file, CASE WHEN seq % 97 = 0 THEN 1 WHEN seq % 89 = 0 THEN 4 WHEN seq % 83 = 0 THEN 0 ELSE 3 END AS width, CASE WHEN seq % 7 = 0 AND seq % 97 > 0 AND seq % 89 > 0 AND seq % 83 > 0 THEN 2 ELSE 1 END AS lines FROM readings),
    n AS (SELECT *, 2 + sum(lines) OVER (PARTITION BY file ORDER BY seq)::BIGINT AS number FROM l)
    SELECT 'bad' AS part, file, number, width FROM n WHERE width <> 3 UNION ALL SELECT DISTINCT 'bad', file, 1::BIGINT, 0 FROM n UNION ALL SELECT CASE lines WHEN 1 THEN 'good' ELSE 'spans lines' END, file, count(*), 3 FROM n WHERE width = 3 GROUP BY 1, 2"""
)
def s07_csv_records(spark, sf):
    """Files that begin with a blank line and have others, and values that span two lines and hold quotes: the number and width of what is malformed, and how many rows are good."""
    path = shared_path(spark, "records")
    r = v.readings(spark, sf).withColumn("file", F.col("device_id") % 10)
    line = lambda text: F.concat_ws(",", "seq", "file", F.lit(text))
    text = F.when(F.col("seq") % 97 == 0, F.col("seq").cast("string")).when(F.col("seq") % 89 == 0, F.concat_ws(",", "seq", "file", "k", F.lit("more"))).when(F.col("seq") % 83 == 0, "").when(F.col("seq") % 7 == 0, line('"a\n""b"", c"')).otherwise(line('5" pipe'))
    first = r.select("file").distinct().select("file", F.explode(F.array(F.struct(F.lit(-2).cast("long").alias("seq"), F.lit("").alias("value")), F.struct(F.lit(-1).cast("long").alias("seq"), F.lit("seq,file,text").alias("value"))))).select("file", "col.*")
    r.select("file", "seq", text.alias("value")).unionByName(first).repartition("file").sortWithinPartitions("file", "seq").select("file", "value").write.partitionBy("file").text(path)
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("file", T.LongType()), T.StructField("text", T.StringType())])
    good, bad = io.read_csv_checked(spark, f"{path}/file=*/*.txt", schema, skip=True)
    bad = bad.select(F.lit("bad").alias("part"), F.regexp_extract("file", r"/file=(\d+)/", 1).cast("long").alias("file"), "number", "width")
    kind = F.when(F.col("text") == 'a\n"b", c', "spans lines").when(F.col("text") == '5" pipe', "good").otherwise("garbled")
    return bad.unionByName(good.groupBy(kind.alias("part"), "file").agg(F.count(F.lit(1)).alias("number")).select("part", "file", "number", F.lit(3).alias("width")))


@query(f"{W}, f AS (SELECT count(*) AS rows, sum(seq)::BIGINT AS total FROM readings) SELECT rows, total, true AS within FROM f")
def s17_parts(spark, sf):
    """A store in files of 50 rows at most, read as one."""
    path = shared_path(spark, "parts")
    rows = base(spark, sf)
    io.save_by_day(rows, path, most_rows=50)
    files = io.scan_raw(spark, path, rows.schema).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("t"))
    return files.agg(F.sum("n").alias("rows"), F.sum("t").alias("total"), (F.max("n") <= 50).alias("within"))


@query(f"{W}, b AS (SELECT device_id, count(*) >= 70 OR epoch_us(TIMESTAMP '2024-01-30 00:00:00') - epoch_us(min(timestamp)) >= 2500000000000 AS due FROM readings GROUP BY 1) SELECT 'flushed' AS part, r.device_id, min(seq) AS seq FROM readings r JOIN b USING (device_id) WHERE due GROUP BY r.device_id, k UNION ALL SELECT 'staged', r.device_id, seq FROM readings r JOIN b USING (device_id) WHERE NOT due")
def s13_flush(spark, sf):
    """Rows of the buffers that are due, the first of each key, and those that stay."""
    staged = v.readings(spark, sf).select("device_id", F.col("timestamp").alias("staged_at"), "k", "seq")
    flush, stay = ingest.flush_due(staged, F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"), ["k"], ["seq"], 70, 2_500_000, by="device_id")
    return flush.select(F.lit("flushed").alias("part"), "device_id", "seq").unionByName(stay.select(F.lit("staged").alias("part"), "device_id", "seq"))


@query(f"{W} SELECT DISTINCT {COLS} FROM readings")
def s06_build_bronze(spark, sf):
    r = base(spark, sf)
    return io.build_bronze(r.where("seq % 3 < 2"), r.where("seq % 3 > 0"))


MESSAGES = "messages AS (SELECT seq, timestamp, device_id, k, value, CASE WHEN seq % 70 = 0 THEN '{broken' ELSE 'ok' END AS shape, CASE WHEN seq % 31 = 0 THEN 'alien' ELSE device_type || '_' || device_id END AS topic FROM readings)"
ALLOWED = {"click": ["device_id", "k"], "view": ["device_id", "k"], "purchase": ["device_id", "k"], "error": ["device_id", "k"], "signup": ["device_id", "k"], "refund": ["device_id", "k"], "scroll": ["device_id", "k"]}


def messages(spark, sf):
    r = v.readings(spark, sf)
    good = F.to_json(F.struct("device_id", "k"))
    odd = F.to_json(F.struct("device_id", "k", F.lit(1).alias("unheard_of")))
    payload = F.when(F.col("seq") % 70 == 0, "{broken").when(F.col("seq") % 50 == 0, odd).otherwise(good)
    return r.select("seq", "timestamp", F.when(F.col("seq") % 31 == 0, "alien").otherwise(F.concat_ws("_", "device_type", F.col("device_id").cast("string"))).alias("topic"), payload.alias("payload"))


REASON = "CASE WHEN seq % 31 = 0 OR device_type NOT IN ('click','view','purchase','error','signup','refund','scroll') THEN 'unknown type' WHEN seq % 70 = 0 THEN 'unparseable payload' WHEN seq % 50 = 0 THEN 'unknown key' END"


@query(f"{W} SELECT seq, device_type, device_id, k FROM readings WHERE {REASON} IS NULL")
def s09_telemetry_ingest(spark, sf):
    good, _ = ingest.split_dead_letters(ingest.parse_messages(messages(spark, sf), ALLOWED))
    return good.select("seq", "device_type", F.col("fields.device_id").cast("long").alias("device_id"), F.col("fields.k").cast("int").alias("k"))


@query(f"{W} SELECT {REASON} AS reason, count(*) AS n, min(timestamp) AS first_time FROM readings WHERE {REASON} IS NOT NULL GROUP BY 1")
def s10_dead_letters(spark, sf):
    _, bad = ingest.split_dead_letters(ingest.parse_messages(messages(spark, sf), ALLOWED))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_time"))


@query(f"{W} SELECT seq, k + i AS k FROM readings, (SELECT unnest(range(0, 3)) AS i) WHERE i = 0 OR seq % 3 < 2")
def s11_envelopes(spark, sf):
    r = v.readings(spark, sf)
    one = lambda i: F.concat(F.lit('{"k":'), F.col("k") + i, F.lit("}"))
    many = F.concat(F.lit("["), F.concat_ws(",", one(0), one(1), one(2)), F.lit("]"))
    payload = F.when(F.col("seq") % 3 == 0, many).when(F.col("seq") % 3 == 1, F.concat(F.lit('{"x":1,"history":'), many, F.lit("}"))).otherwise(one(0))
    return ingest.unwrap(r.select("seq", payload.alias("payload"))).select("seq", F.get_json_object("record", "$.k").cast("long").alias("k"))


@query(f'{W} SELECT seq, device_id, device_type, k AS "reading.k", value AS "reading.raw.value" FROM readings')
def s12_flatten_json(spark, sf):
    r = v.readings(spark, sf)
    return ingest.flatten(r.select("seq", "device_id", "device_type", F.struct("k", F.struct("value").alias("raw")).alias("reading")))


@query(f"{W} SELECT device_type AS \"table\", count(*) AS rows, min(timestamp) AS oldest, count(*) >= 500 OR epoch(TIMESTAMP '2024-01-30 23:59:00' - min(timestamp)) >= 300 AS flush FROM readings GROUP BY 1")
def s13_due_buffers(spark, sf):
    r = v.readings(spark, sf).select(F.col("device_type").alias("table"), F.col("timestamp").alias("staged_at"))
    return ingest.due_buffers(r, F.lit("2024-01-30 23:59:00").cast("timestamp_ntz"))


@query(f"WITH {v.FRAME} SELECT count(*) AS rows, count(*) FILTER (occupied = 1) AS positives, count(*) FILTER (occupied = 0) AS negatives, 0::BIGINT AS timestamp_nulls, 0::BIGINT AS zone_id_nulls, count(*) FILTER (value IS NULL) AS value_nulls FROM frame WHERE occupied IS NOT NULL")
def s14_labelled_snapshot(spark, sf):
    return io.labelled_snapshot(v.frame(spark, sf))[1]


@query(f"WITH {v.FRAME} SELECT count(*) AS rows, count(DISTINCT timestamp) AS timestamps, min(timestamp) AS first_time, max(timestamp) AS last_time FROM frame")
def s15_export_summary(spark, sf):
    return io.export_summary(v.frame(spark, sf))


@query(f"{W}, s AS (SELECT *, sum(strlen(payload)) OVER (PARTITION BY device_id ORDER BY timestamp DESC, seq DESC ROWS UNBOUNDED PRECEDING) AS b FROM readings) SELECT {COLS} FROM s WHERE b <= 200")
def s16_newest_within_bytes(spark, sf):
    r = v.readings(spark, sf).withColumn("bytes", F.octet_length("payload"))
    return io.newest_within_bytes(r, "bytes", 200, ["device_id"], ["timestamp", "seq"]).select(*C)


@query(
    f"""{W}, d AS (SELECT DISTINCT device_type AS source, device_id FROM readings), p AS (SELECT source, device_id, chunk::INTEGER AS chunk,
    TIMESTAMP '2024-01-01' + chunk * INTERVAL 5 DAY AS a FROM d, (SELECT unnest(range(0, 6)) AS chunk))
    SELECT source, device_id, chunk, CASE WHEN chunk = 0 AND source = 'view' THEN a - INTERVAL 600 SECOND ELSE a END AS chunk_start,
    least(TIMESTAMP '2024-01-28', a + INTERVAL 5 DAY) AS chunk_end, CAST(row_number() OVER (PARTITION BY source ORDER BY chunk, device_id) AS INTEGER) AS turn FROM p"""
)
def s19_backfill_plan(spark, sf):
    d = v.readings(spark, sf).select(F.col("device_type").alias("source"), "device_id").distinct()
    early = F.when(F.col("source") == "view", 600).otherwise(0)
    return ingest.backfill_plan(spark, d, datetime(2024, 1, 1), datetime(2024, 1, 28), 5, early)


@query(
    f"""{W}, n AS (SELECT *, row_number() OVER (ORDER BY timestamp, seq) AS rn FROM readings), b AS (SELECT 'start' AS part, min(rn) FILTER (timestamp >= TIMESTAMP '2024-01-03') AS first, count(*) AS n FROM n UNION ALL SELECT 'none', 1, count(*) FROM n),
    t AS (SELECT unnest(range(0, 40))::BIGINT AS tick UNION ALL SELECT unnest(range(1000000000, 1000000003))), c AS (SELECT part, tick, least(n, greatest(first, 10) + tick) AS last FROM t, b)
    SELECT part, tick, seq, rn FROM c JOIN n ON n.rn BETWEEN last - 11 AND last"""
)
def s20_replay(spark, sf):
    """From a time, and from the first row, where the first tick waits for a whole window; ticks beyond the end repeat the last window."""
    ticks = spark.range(40).union(spark.range(1_000_000_000, 1_000_000_003)).select(F.col("id").alias("tick"))
    of = lambda part, start: windows.replay(v.readings(spark, sf), ticks, 10, 2, start, ["timestamp", "seq"]).select(F.lit(part).alias("part"), "tick", "seq", F.col("rn").cast("long").alias("rn"))
    return of("start", "2024-01-03 00:00:00").union(of("none", None))


@query(f"WITH {v.GRID}, c AS (SELECT date_trunc('hour', timestamp) AS timestamp, zone_id, CAST(count(*) AS DOUBLE) AS n FROM readings GROUP BY ALL), j AS (SELECT g.*, c.n FROM grid g LEFT JOIN c USING (timestamp, zone_id)) SELECT timestamp, " + ", ".join(f"round(max(value) FILTER (zone_id = {z}), 8) AS value_s{z}, max(n) FILTER (zone_id = {z}) AS n_s{z}" for z in range(1, 16)) + " FROM j GROUP BY 1")
def s21_wide_export(spark, sf):
    n = v.readings(spark, sf).groupBy(buckets.floor_to(F.col("timestamp"), v.HOUR).alias("timestamp"), "zone_id").agg(F.count(F.lit(1)).cast("double").alias("n"))
    rows = joins.join_sources(v.grid(spark, sf), [n], ["timestamp", "zone_id"], check=False).withColumn("value", F.round("value", 8))
    return io.check_width(io.wide_export(rows, ["value", "n"], list(range(1, 16))), ["value", "n"], list(range(1, 16)))


@query(f"{W} SELECT timestamp, device_id, value FROM readings ORDER BY timestamp")
def p01_load_all(spark, sf):
    return q.load_all(v.readings(spark, sf), ["timestamp", "device_id", "value"])


@query(f"{W} SELECT {COLS} FROM readings WHERE timestamp BETWEEN TIMESTAMP '{DAY1}' AND TIMESTAMP '{DAY2}'")
def p02_time_range(spark, sf):
    return q.time_range(base(spark, sf), DAY1, DAY2)


@query(f"{W} SELECT {COLS} FROM readings WHERE timestamp >= TIMESTAMP '{DAY2}'")
def p03_since(spark, sf):
    return q.since(base(spark, sf), DAY2)


@query(f"{W} SELECT {COLS} FROM readings WHERE timestamp >= TIMESTAMP '{DAY1}' AND device_id IN (3, 5, 8)")
def p04_by_region(spark, sf):
    return q.by_region(base(spark, sf), DAY1, None, [3, 5, 8])


@query(f"{W} SELECT {COLS} FROM readings WHERE device_type = 'click' AND device_id IN (1, 2, 4)")
def p05_filters(spark, sf):
    return q.filtered(base(spark, sf), {"device_type": "click", "device_id": [1, 2, 4]})


@query(f"{W} SELECT * FROM (SELECT {COLS} FROM readings WHERE device_type = 'view' ORDER BY timestamp DESC, seq DESC LIMIT 25) ORDER BY timestamp, seq")
def p06_latest_n(spark, sf):
    return q.latest_n(base(spark, sf), 25, {"device_type": "view"}, ["timestamp", "seq"])


@query(f"{W} SELECT {COLS} FROM readings ORDER BY timestamp, seq LIMIT 100")
def p07_bronze_default(spark, sf):
    return q.bronze_default(base(spark, sf), order=["timestamp", "seq"])


@query(f"{W} SELECT device_id, count(*) AS n, round(avg(value), 8) AS mean FROM readings WHERE k > 20 GROUP BY 1")
def p08_load_sql(spark, sf):
    return q.load_sql(spark, "SELECT device_id, count(*) AS n, round(avg(value), 8) AS mean FROM {table} WHERE k > :least GROUP BY 1", v.readings(spark, sf), {"least": 20})


@query(f"{W} SELECT timestamp, value FROM (SELECT * FROM readings WHERE timestamp >= TIMESTAMP '{DAY1}' AND device_id IN (1, 2, 3) ORDER BY timestamp DESC, seq DESC LIMIT 50)")
def p09_configured(spark, sf):
    config = {"layer": "gold", "device": "air-1", "start": DAY1, "sensors": [1, 2, 3], "latest_n": 50, "order": ["timestamp", "seq"], "columns": ["timestamp", "value"]}
    return q.configured(spark, {("gold", "air-1"): base(spark, sf)}, config)


@query("SELECT o_orderdate, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
def p10_load_table(spark, sf):
    return q.load_all(q.filtered(v.load(spark, sf, "orders"), {"o_orderstatus": ["F", "P"]}), ["o_orderdate", "o_orderkey", "o_orderstatus"], "o_orderdate")


@query("SELECT 'events' AS name, count(*) AS rows, 6 AS columns FROM events UNION ALL SELECT 'orders', count(*), (SELECT count(*)::INTEGER FROM information_schema.columns WHERE table_name = 'orders') FROM orders")
def p11_introspection(spark, sf):
    one = lambda t: v.load(spark, sf, t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("name"), "rows", F.lit(len(v.load(spark, sf, t).columns)).alias("columns"))
    return one("events").unionByName(one("orders"))


@query(f"{W} SELECT {COLS} FROM readings WHERE date_trunc('hour', timestamp) >= TIMESTAMP '{DAY1}' AND date_trunc('hour', timestamp) < TIMESTAMP '2024-01-11'")
def p12_half_open(spark, sf):
    return q.half_open(base(spark, sf), DAY1, date(2024, 1, 10), seconds=v.HOUR)


@query(f"{W} SELECT {COLS} FROM readings WHERE device_id = 7 ORDER BY timestamp DESC LIMIT 1")
def p13_latest_of_device(spark, sf):
    return q.latest_of(base(spark, sf), 7)


@query(f"{W} SELECT {COLS} FROM readings WHERE device_id = 7 AND timestamp BETWEEN TIMESTAMP '{DAY1}' AND TIMESTAMP '{DAY2}'")
def p14_device_history(spark, sf):
    return q.time_range(q.filtered(base(spark, sf), {"device_id": 7}), DAY1, DAY2)


@query(f"{W} SELECT {COLS} FROM readings WHERE device_type = 'error' ORDER BY timestamp DESC, seq DESC LIMIT 10")
def p15_audit_log(spark, sf):
    return q.latest_n(base(spark, sf), 10, {"device_type": "error"}, ["timestamp", "seq"])


@query(f"{W} SELECT d AS device_id, d IN (SELECT device_id FROM readings) AS registered FROM (SELECT unnest(range(0, 400, 7)) AS d)")
def p16_registry(spark, sf):
    return q.registered(v.readings(spark, sf), spark.range(0, 400, 7).select(F.col("id").alias("device_id")))


@query(f"{W} SELECT {COLS} FROM readings ORDER BY timestamp DESC, seq DESC LIMIT 105")
def p19_smoke_window(spark, sf):
    return q.smoke_window(base(spark, sf), 90, 15, ["timestamp", "seq"])


@query(f"{WG} SELECT timestamp, device_id, value, seq FROM gappy QUALIFY row_number() OVER (PARTITION BY timestamp, device_id ORDER BY seq DESC) = 1")
def m01_m06_keep_last(spark, sf):
    return merge.keep_last(v.gappy(spark, sf), ["timestamp", "device_id"], ["seq"]).select("timestamp", "device_id", scalars.no_nan(F.col("value")).alias("value"), "seq")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price, o_orderkey % 3 <> 0 AS existing FROM orders")
def m02_insert_if_absent(spark, sf):
    o = v.load(spark, sf, "orders")
    a = o.where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_totalprice").alias("price"), F.lit(True).alias("existing"))
    b = o.select("o_orderkey", (F.col("o_totalprice") + 1).alias("price"), F.lit(False).alias("existing"))
    return merge.insert_if_absent(a, b, ["o_orderkey"])[0]


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice ELSE o_totalprice + 1 END AS price FROM orders")
def m03_upsert(spark, sf):
    o = v.load(spark, sf, "orders")
    return merge.upsert(o.where("o_orderkey % 3 < 2").select("o_orderkey", F.col("o_totalprice").alias("price")), o.where("o_orderkey % 3 <> 1").select("o_orderkey", (F.col("o_totalprice") + 1).alias("price")), ["o_orderkey"])


@query(f"{WG} SELECT timestamp, device_id, value, seq FROM gappy QUALIFY row_number() OVER (PARTITION BY timestamp, device_id ORDER BY seq) = 1")
def m04_first_write_wins(spark, sf):
    return merge.keep_first(v.gappy(spark, sf), ["timestamp", "device_id"], ["seq"]).select("timestamp", "device_id", scalars.no_nan(F.col("value")).alias("value"), "seq")


@query(f"{WG}, g AS (SELECT device_id, timestamp, count(*) AS n FROM gappy GROUP BY ALL) SELECT device_id, sum(n)::BIGINT AS rows, count(*) FILTER (n > 1) AS duplicate_groups FROM g GROUP BY 1 HAVING count(*) FILTER (n > 1) > 0")
def m05_duplicate_probe(spark, sf):
    return merge.duplicate_probe(v.gappy(spark, sf))


@query(f"{W} SELECT timestamp, device_id, value, CASE WHEN seq % 2 = 1 THEN k END AS k FROM readings")
def m07_schema_evolution(spark, sf):
    r = v.readings(spark, sf)
    return merge.evolve(r.where("seq % 2 = 0").select("timestamp", "device_id", "value"), r.where("seq % 2 = 1").select("timestamp", "device_id", "value", "k"))


@query(
    f"""{W}, n AS (SELECT device_id, seq, 0 AS part, value, CAST(NULL AS VARCHAR) AS note FROM readings WHERE seq % 2 = 0
    UNION ALL SELECT device_id, seq, 1, CASE WHEN k % 2 = 0 THEN value END, CASE WHEN k % 3 = 0 THEN '' ELSE 'n' || k END FROM readings WHERE seq % 2 = 1)
    SELECT device_id, arg_max(value, part * 1000000000000 + seq) FILTER (value IS NOT NULL) AS value, arg_max(note, part * 1000000000000 + seq) FILTER (note <> '') AS note FROM n GROUP BY 1"""
)
def m08_sparse_merge(spark, sf):
    r = v.readings(spark, sf)
    a = r.where("seq % 2 = 0").select("device_id", "seq", "value")
    b = r.where("seq % 2 = 1").select("device_id", "seq", F.when(F.col("k") % 2 == 0, F.col("value")).alias("value"), F.when(F.col("k") % 3 == 0, "").otherwise(F.concat(F.lit("n"), "k")).alias("note"))
    return merge.sparse_merge([a, b], ["device_id"], "seq").select("device_id", "value", "note")


@query(
    """WITH a AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 < 2), b AS (SELECT l_orderkey AS k FROM lineitem WHERE l_orderkey % 3 <> 1), n AS (SELECT k, bool_or(s = 1) AS a, bool_or(s = 2) AS b FROM (SELECT k, 1 AS s FROM a UNION ALL SELECT k, 2 FROM b) GROUP BY 1)
    SELECT (SELECT count(*) FROM a) AS existing, (SELECT count(*) FROM b) AS fetched, count(*) FILTER (b AND NOT a) AS inserted, count(*) FILTER (a AND b) AS updated, count(*) AS total FROM n"""
)
def m09_append_stats(spark, sf):
    """A batch that has most keys several times."""
    o, i = v.load(spark, sf, "orders"), v.load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.append_stats(o.where("o_orderkey % 3 < 2"), i.where("o_orderkey % 3 <> 1"), ["o_orderkey"])


@query(f"{WG}, u AS (SELECT timestamp, device_id, value, seq FROM gappy QUALIFY row_number() OVER (PARTITION BY timestamp, device_id ORDER BY seq DESC) = 1) SELECT timestamp, device_id, value FROM u ORDER BY timestamp DESC, device_id DESC LIMIT 500")
def m10_rolling_cache(spark, sf):
    g = v.gappy(spark, sf).withColumn("value", scalars.no_nan(F.col("value")))
    return merge.rolling_cache(g.where("seq < 100000000"), g.where("seq >= 100000000"), ["timestamp", "device_id"], ["seq"], 500, ["timestamp", "device_id"]).select("timestamp", "device_id", "value")


@query(f"{WG} SELECT device_id, timestamp, round(value * 2, 8) AS value FROM gappy QUALIFY row_number() OVER (PARTITION BY timestamp, device_id ORDER BY seq DESC) = 1")
def m11_move_layer(spark, sf):
    g = v.gappy(spark, sf)
    double = {"air-1": lambda df: df.withColumn("value", F.round(scalars.no_nan(F.col("value")) * 2, 8))}
    silver = merge.move_layer(g.where("seq % 2 = 0"), None, "air-1", double, ["timestamp", "device_id"], ["seq"])
    return merge.move_layer(g, silver, "air-1", double, ["timestamp", "device_id"], ["seq"]).select("device_id", "timestamp", "value")


@query(
    f"""{W}, m AS (SELECT date_trunc('second', max(timestamp)) AS s, date_trunc('second', max(timestamp) FILTER (seq % 5 > 0)) AS b, date_trunc('second', max(timestamp) FILTER (timestamp < TIMESTAMP '{DAY2}')) AS c FROM readings),
    l AS (SELECT 'bronze' AS layer, b AS last, s AS before_last FROM m UNION ALL SELECT 'silver', c, b FROM m UNION ALL SELECT 'gold', c, c FROM m)
    SELECT *, CASE WHEN before_last > last THEN 'source is newer' ELSE 'up to date' END AS reason, before_last > last AS needs_update FROM l"""
)
def m12_freshness(spark, sf):
    r = base(spark, sf)
    old = r.where(f"timestamp < TIMESTAMP_NTZ '{DAY2}'")
    return merge.freshness(r, {"bronze": r.where("seq % 5 > 0"), "silver": old, "gold": old})


@query(f"{W} SELECT {COLS} FROM readings WHERE timestamp >= (SELECT max(timestamp) + INTERVAL 1 SECOND FROM readings WHERE timestamp < TIMESTAMP '{DAY2}')")
def m13_new_rows(spark, sf):
    r = base(spark, sf)
    return merge.new_rows(r, r.where(f"timestamp < TIMESTAMP_NTZ '{DAY2}'"), DAY1)


@query(f"{W} SELECT {COLS} FROM readings WHERE timestamp >= greatest(TIMESTAMP '{DAY1}', (SELECT max(timestamp) - INTERVAL 7200 SECOND FROM readings WHERE timestamp < TIMESTAMP '{DAY2}')) AND timestamp < TIMESTAMP '2024-01-20'")
def m14_overlap_rows(spark, sf):
    r = base(spark, sf)
    return merge.overlap_rows(r, r.where(f"timestamp < TIMESTAMP_NTZ '{DAY2}'"), DAY1, "2024-01-20 00:00:00", 7200)


@query(f"{W} SELECT timestamp, 'r' || (seq % 4) AS model_run_id, CASE WHEN seq % 2 = 0 THEN value + 1 ELSE value END AS value FROM readings QUALIFY row_number() OVER (PARTITION BY timestamp, seq % 4 ORDER BY seq) = 1")
def m15_publish(spark, sf):
    r = v.readings(spark, sf).withColumn("model_run_id", F.concat(F.lit("r"), F.col("seq") % 4))
    g = merge.keep_first(r, ["timestamp", "model_run_id"], ["seq"]).select("timestamp", "model_run_id", "value", "seq")
    return merge.upsert(g.drop("seq"), g.where("seq % 2 = 0").select("timestamp", "model_run_id", (F.col("value") + 1).alias("value")), merge.publish_keys(g.columns))


@query(f"{W}, l AS (SELECT device_id, CAST(date_diff('second', date_trunc('second', max(timestamp)), TIMESTAMP '2024-02-05') AS BIGINT) AS lag_seconds FROM readings GROUP BY 1) SELECT *, CASE WHEN lag_seconds < 60 THEN lag_seconds || ' s' WHEN lag_seconds < 3600 THEN lag_seconds // 60 || ' min' WHEN lag_seconds < 86400 THEN lag_seconds // 3600 || ' h' ELSE lag_seconds // 86400 || ' d' END AS lag FROM l")
def m16_source_lag(spark, sf):
    r = v.readings(spark, sf).withColumn("timestamp", F.date_trunc("SECOND", "timestamp").cast("timestamp_ntz"))
    return merge.source_lag(r, "2024-02-05 00:00:00")


@query(f"WITH {v.GRID}, c AS (SELECT date_trunc('hour', timestamp) AS timestamp, zone_id, count(*) AS events FROM readings GROUP BY ALL), x AS (SELECT date_trunc('hour', timestamp) AS timestamp, zone_id, max(k) AS max_k FROM readings GROUP BY ALL) SELECT timestamp, zone_id, round(value, 8) AS value, events, max_k FROM grid LEFT JOIN c USING (timestamp, zone_id) LEFT JOIN x USING (timestamp, zone_id)")
def j01_j10_join_sources(spark, sf):
    r = v.readings(spark, sf).withColumn("timestamp", buckets.floor_to(F.col("timestamp"), v.HOUR))
    c = r.groupBy("timestamp", "zone_id").agg(F.count(F.lit(1)).alias("events"))
    x = r.groupBy("timestamp", "zone_id").agg(F.max("k").alias("max_k"))
    return joins.join_sources(v.grid(spark, sf), [c, x], ["timestamp", "zone_id"]).withColumn("value", F.round("value", 8))


@query(f"WITH {v.GRID}, room AS (SELECT date_trunc('hour', timestamp) AS timestamp, round(avg(k), 8) AS room_k FROM readings GROUP BY 1) SELECT timestamp, zone_id, room_k FROM grid LEFT JOIN room USING (timestamp)")
def j02_enrich_room(spark, sf):
    room = buckets.bucket_mean(v.readings(spark, sf), {"room_k": F.col("k").cast("double")}, v.HOUR, []).withColumn("room_k", F.round("room_k", 8))
    return joins.enrich_room(v.grid(spark, sf), room).select("timestamp", "zone_id", "room_k")


@query(f"WITH {v.HOURLY}{v.LABELS[len(v.READINGS):]}, {v.HOURLY_LABELS} SELECT h.timestamp, h.zone_id, round(h.value, 8) AS value, l.occupied FROM hourly h LEFT JOIN hourly_labels l USING (timestamp, zone_id)")
def j03_feature_label_join(spark, sf):
    return joins.with_labels(v.hourly(spark, sf), v.hourly_labels(spark, sf).select("timestamp", "zone_id", "occupied"), ["timestamp", "zone_id"]).withColumn("value", F.round("value", 8))


@query("SELECT l_orderkey, count(*) AS lines FROM lineitem WHERE l_orderkey % 4 = 0 GROUP BY 1")
def j04_anti_semi(spark, sf):
    lines, orders = v.load(spark, sf, "lineitem"), v.load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    left, _ = joins.delete_using(lines, orders.where("l_orderkey % 2 = 1"), ["l_orderkey"])
    return joins.absent(left, orders.where("l_orderkey % 4 <> 0"), ["l_orderkey"]).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))


@query(f"{W}, m AS (SELECT DISTINCT device_id FROM readings WHERE device_id % 10 > 0), f AS (SELECT device_id, 15 + row_number() OVER (ORDER BY min(timestamp), device_id) AS slot FROM readings WHERE device_id % 10 = 0 GROUP BY 1) SELECT r.seq, r.device_id, CASE WHEN f.slot IS NULL THEN r.device_id % 15 + 1 ELSE f.slot END AS zone_id FROM readings r LEFT JOIN f USING (device_id)")
def j05_device_zone_map(spark, sf):
    r = v.readings(spark, sf)
    m = r.where("device_id % 10 > 0").select("device_id", "zone_id").distinct()
    return joins.to_zone(r.drop("zone_id"), m, fallback=True).select("seq", "device_id", "zone_id")


@query(f"WITH {v.GRID} SELECT timestamp, zone_id, round(value, 8) AS value FROM grid")
def j06_dense_grid(spark, sf):
    return v.grid(spark, sf).withColumn("value", F.round("value", 8))


@query(
    f"""WITH {v.LABELS}, l AS (SELECT timestamp AS lt, zone_id, source_topic AS label FROM labels_raw QUALIFY row_number() OVER (PARTITION BY timestamp, zone_id ORDER BY source_topic DESC) = 1),
    r AS (SELECT * FROM readings WHERE device_type = 'purchase')
    SELECT r.seq, r.zone_id, l.label, l.lt AS label_time, round(date_diff('second', date_trunc('second', l.lt), date_trunc('second', r.timestamp)) / 60, 3) AS age_minutes
    FROM r ASOF LEFT JOIN l ON r.zone_id = l.zone_id AND r.timestamp >= l.lt"""
)
def j07_as_of(spark, sf):
    second = F.date_trunc("SECOND", "timestamp").cast("timestamp_ntz")
    refs = v.readings(spark, sf).where("device_type = 'purchase'").select("seq", "zone_id", "timestamp")
    labels = v.labels_raw(spark, sf).groupBy("timestamp", "zone_id").agg(F.max("source_topic").alias("label")).withColumnRenamed("timestamp", "label_time")
    out = joins.as_of(refs, labels, ["zone_id"], "timestamp", "label_time", "label")
    age = F.round(F.timestamp_diff("SECOND", F.date_trunc("SECOND", "label_time").cast("timestamp_ntz"), second) / 60, 3)
    return out.select("seq", "zone_id", "label", "label_time", age.alias("age_minutes"))


@query(f"WITH {v.BOXES} SELECT box_id, zone_id, round(ratio, 8) AS ratio FROM met WHERE zone_id <> 16 AND ratio >= 0.3 QUALIFY row_number() OVER (PARTITION BY box_id ORDER BY ratio DESC, zone_order) = 1")
def j08_assign_zone(spark, sf):
    return joins.assign_zone(v.boxes(spark, sf), v.rectangles(spark)).withColumn("ratio", F.round("ratio", 8))


@query(f"WITH {v.BOXES} SELECT box_id, zone_id, round(ratio, 8) AS ratio FROM met WHERE (x1 + x2) // 2 >= zx1 AND (x1 + x2) // 2 < zx2 AND (y1 + y2) // 2 >= zy1 AND (y1 + y2) // 2 < zy2")
def j09_zones_of_centre(spark, sf):
    return joins.zones_of(v.boxes(spark, sf), v.rectangles(spark)).withColumn("ratio", F.round("ratio", 8))


@query(f"{W}, g AS (SELECT r_regionkey AS group_id, 'light' AS member_type, n_nationkey * 9 AS device_id FROM region JOIN nation ON n_regionkey = r_regionkey), l AS (SELECT device_id, max(timestamp) AS timestamp, arg_max(value, timestamp) AS value FROM readings GROUP BY 1) SELECT g.device_id::BIGINT AS device_id, group_id::BIGINT AS group_id, member_type, l.timestamp, l.value FROM g LEFT JOIN l USING (device_id)")
def j11_group_members(spark, sf):
    g = v.load(spark, sf, "nation").groupBy(F.col("n_regionkey").cast("long").alias("group_id")).agg(F.collect_list((F.col("n_nationkey") * 9).cast("long")).alias("lights"))
    latest = windows.latest_rows(v.readings(spark, sf).select("timestamp", "device_id", "value"))
    return joins.group_members(g, latest, {"lights": "light"}).select("device_id", "group_id", "member_type", "timestamp", "value")


@query(f"{W}, e AS (SELECT unnest(range(0, 400, 5)) AS device_id) SELECT e.device_id, count(r.seq) AS readings, CASE WHEN count(r.seq) = 0 THEN 'missing' ELSE 'working' END AS status FROM e LEFT JOIN readings r USING (device_id) GROUP BY 1")
def j12_sensor_status(spark, sf):
    return joins.sensor_status(spark.range(0, 400, 5).select(F.col("id").alias("device_id")), v.readings(spark, sf))
