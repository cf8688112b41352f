"""Stores, messages and streams; each stream against its batch form."""

from __future__ import annotations

import csv
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorframe.sources import catalog, ingest, io
from sensorframe.streaming import streams

T0 = datetime(2024, 3, 4)
ROW = "timestamp timestamp_ntz, device_id long, value double"


def rows(spark, n=6, step=43200):
    return spark.createDataFrame([(T0 + timedelta(seconds=step * i), i, float(i)) for i in range(n)], ROW)


def test_partitioned_store_and_schema_evolution(spark, tmp_path):
    base = str(tmp_path / "air-1")
    io.save_by_day(rows(spark), base)
    io.save_by_day(rows(spark, 2).withColumn("extra", F.lit("new")), base, most_rows=1)
    out = io.scan_raw(spark, base)
    assert out.count() == 8 and out.where("extra IS NULL").count() == 6
    assert (tmp_path / "air-1" / "year=2024" / "month=03" / "day=04").exists()


def test_small_files_are_made_without_checksum_files(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(hours=h) if h % 50 else None, h, f"k{h % 3}", None if h % 7 == 0 else h / 3) for h in range(500)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, seq long, kind string, value double").withMetadata("kind", {"unit": "none"})
    base = tmp_path / "parts"
    io.save_by_day(df, f"file://{base}", most_rows=7)
    files = [f for f in base.rglob("*") if f.is_file() and f.suffix == ".parquet"]
    assert not list(base.rglob(".*.crc"))  # Hadoop's local file system makes one with each file, and two processes
    assert {p.name for p in base.iterdir()} == {"_SUCCESS", "year=2024", "year=__HIVE_DEFAULT_PARTITION__"}
    seen = io.scan_raw(spark, str(base))
    most = seen.groupBy(F.col("_metadata.file_path").alias("file")).count().agg(F.max("count"), F.count("file")).first()
    assert tuple(most) == (7, len(files))
    # Spark's own writer gives the same rows, days, schema and metadata
    io.save_by_day(df, str(tmp_path / "plain"))
    plain = io.scan_raw(spark, str(tmp_path / "plain"))
    assert seen.schema.json() == plain.schema.json() and seen.schema["kind"].metadata == {"unit": "none"}
    assert sorted(map(str, seen.collect())) == sorted(map(str, plain.collect())) and seen.count() == 500
    assert io.scan_raw(spark, str(base), df.schema).exceptAll(seen).isEmpty()
    # more is appended, and files are full but for the last of a day in each partition
    io.save_by_day(df.where("seq < 48").coalesce(1), str(base), most_rows=1000)
    assert io.scan_raw(spark, str(base)).count() == 548


def test_small_files_of_a_failed_write_are_not_seen(spark, tmp_path):
    df = spark.range(400).select(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("t"), F.col("id").alias("seq")).withColumn("timestamp", F.col("t") + F.make_dt_interval(hours=F.col("seq").cast("int")))
    base = str(tmp_path / "parts")
    io.save_by_day(df, base, most_rows=5)
    with pytest.raises(Exception, match="odd row"):
        io.save_by_day(df.withColumn("seq", F.when(F.col("seq") == 399, F.raise_error(F.lit("odd row")).cast("long")).otherwise(F.col("seq"))), base, most_rows=5)
    assert io.scan_raw(spark, base).count() == 400 and not list((tmp_path / "parts").glob("_temporary*"))


def test_convert_deals_rows_to_their_own_days(spark, tmp_path):
    rows(spark, 4, 86400).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).coalesce(1).write.option("header", True).csv(str(tmp_path / "csv"))
    io.convert(spark, str(tmp_path / "csv"), "csv", str(tmp_path / "out"))
    assert len(list((tmp_path / "out" / "air-1" / "year=2024" / "month=03").iterdir())) == 4


def test_csv_width(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,2\n3\n4,5,6\n"7",8\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    good, bad = io.read_csv_checked(spark, str(tmp_path / "x.csv"), schema, skip=True)
    assert sorted(r["a"] for r in good.collect()) == [1, 7] and good.count() == 2
    assert sorted((r["number"], r["width"], r["line"]) for r in bad.collect()) == [(3, 1, "3"), (4, 3, "4,5,6")]
    with pytest.raises(ValueError):
        io.read_csv_checked(spark, str(tmp_path / "x.csv"), schema)


def test_csv_lines_are_numbered_in_every_part(spark, tmp_path):
    for part, header in ((1, "a,b"), (2, "a,b,c")):
        lines = [header] + [f'{i},"x,{i}"' if i % 50 else "a,b" if i % 100 else f"{i}" for i in range(1, 2000)]
        (tmp_path / f"p{part}.csv").write_text("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        good, bad = io.read_csv_checked(spark, str(tmp_path / "*.csv"), schema, skip=True)
        want = [(p, i + 1, 1) for p in (1, 2) for i in range(100, 2000, 100)] + [(2, 1, 3)]
        assert sorted((int(r["file"][-5]), r["number"], r["width"]) for r in bad.collect()) == sorted(want)
        rows = good.collect()
        assert len(rows) == 2 * (1999 - 19) and sum(r["a"] == "a" for r in rows) == 40 and {r["b"] for r in rows if r["a"] == "7"} == {"x,7"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_flush_takes_what_is_due_and_leaves_the_rest(spark):
    now = F.lit(str(T0 + timedelta(seconds=400))).cast("timestamp_ntz")
    staged = spark.createDataFrame([("old", T0, 1, 1), ("old", T0 + timedelta(seconds=390), 1, 2), ("new", T0 + timedelta(seconds=350), 1, 3)], "table string, staged_at timestamp_ntz, k int, seq long")
    flush, stay = ingest.flush_due(staged, now, ["k"], ["seq"])
    assert [r["seq"] for r in flush.collect()] == [1] and [r["seq"] for r in stay.collect()] == [3]
    flush, stay = ingest.flush_due(staged, now, ["k"], ["seq"], force=True)
    assert sorted(r["seq"] for r in flush.collect()) == [1, 3] and stay.count() == 0


def test_late_payloads_are_counted_across_batches(spark, tmp_path):
    schema = "room long, event_time timestamp, seq long, x double"
    at = [0, 12, 5, 31, 22, 8, 45, 33, 60]
    rows = [(1, T0 + timedelta(seconds=s), i, float(s)) for i, s in enumerate(at)]
    df = stream_of(spark, tmp_path, [rows[:4], rows[4:]], schema)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = streams.to_memory(streams.room_buckets_in_order(df, ["x"]), "x03", str(tmp_path / "c3"))
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    closed, late, held, want = -1, 0, {}, []
    for s in at:
        for b in sorted(x for x in held if x < s // 10):
            v = held.pop(b)
            want.append((b, sum(v) / len(v), len(v), late))
            closed = b
        if s // 10 <= closed:
            late += 1
        else:
            held.setdefault(s // 10, []).append(s)
    got = [(int((r["bucket"] - T0).total_seconds()) // 10, r["x"], r["samples"], r["late"]) for r in spark.table("x03").orderBy("bucket").collect()]
    assert got == want and late == 3


def test_snapshot_needs_labels(spark, tmp_path):
    df = rows(spark).withColumn("occupied", F.lit(None).cast("int"))
    with pytest.raises(ValueError):
        io.write_snapshot(df, str(tmp_path / "s"))
    assert io.write_snapshot(df.withColumn("occupied", F.lit(1)), str(tmp_path / "s")).first()["rows"] == 6


def test_catalog(spark):
    catalog.reset_layers(spark)
    rows(spark).write.saveAsTable("bronze_air_1")
    assert catalog.migrate_flat(spark) == ["bronze.air_1"]
    assert catalog.available(spark, "bronze") == ["air_1"] and catalog.row_count(spark, "bronze.air_1") == 6
    assert catalog.row_count(spark, "gold.none") == 0 and catalog.column_names(spark, "gold.none") == [] and catalog.available(spark, "nowhere") == []
    assert catalog.device_table("silver", "smart-plug-v2") == "silver.smart_plug_v2" and catalog.pipeline_table("gold", "Zone 5!", "a--b") == "gold.zone_5_a_b"
    for bad in (lambda: catalog.sanitised("--"), lambda: catalog.pipeline_table("bronze", "a", "b")):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(KeyError):
        catalog.device_table("gold", "toaster")
    catalog.reset_layers(spark)
    assert catalog.available(spark, "bronze") == []


def test_flat_tables_move_without_a_copy(spark, tmp_path):
    catalog.reset_layers(spark)
    frame = rows(spark).withColumn("day", F.dayofmonth("timestamp"))
    frame.write.partitionBy("day").saveAsTable("silver_parts")
    frame.write.option("path", str(tmp_path / "own")).saveAsTable("gold_outside")
    frame.createOrReplaceTempView("gold_view")
    names = lambda t: sorted(f.rsplit("/", 1)[1] for f in spark.table(t).inputFiles())
    want, files, outside = sorted(map(str, spark.table("silver_parts").collect())), names("silver_parts"), spark.table("gold_outside").inputFiles()
    assert sorted(catalog.migrate_flat(spark)) == ["gold.outside", "silver.parts"]
    assert sorted(map(str, spark.table("silver.parts").collect())) == want and names("silver.parts") == files  # the same files
    assert sorted(spark.table("gold.outside").inputFiles()) == sorted(outside) and catalog.row_count(spark, "gold.outside") == 6
    assert [c.name for c in spark.catalog.listColumns("silver.parts") if c.isPartition] == ["day"]
    assert catalog.migrate_flat(spark) == [] and not spark.catalog.tableExists("silver_parts")
    catalog.reset_layers(spark)


@pytest.mark.parametrize("renamed", [False, True])
def test_a_move_that_broke_off_goes_on(spark, renamed):
    catalog.reset_layers(spark)
    rows(spark).write.saveAsTable("bronze_b")
    spark.sql(f"CREATE TABLE bronze.b LIKE bronze_b TBLPROPERTIES ('{catalog.MOVING}'='bronze_b')")
    if renamed:
        catalog._take_over(spark, "bronze_b", "bronze.b")
    assert catalog.migrate_flat(spark) == ["bronze.b"] and catalog.row_count(spark, "bronze.b") == 6
    assert catalog.MOVING not in str(spark.sql("SHOW TBLPROPERTIES bronze.b").collect())
    rows(spark).write.saveAsTable("bronze_b")  # a table of that name is there now
    assert catalog.migrate_flat(spark) == [] and catalog.row_count(spark, "bronze_b") == 6
    spark.sql("DROP TABLE bronze_b")
    catalog.reset_layers(spark)


def test_messages(spark):
    allowed = {"air": ["co2"], "air_one": ["co2", "pm"]}
    m = spark.createDataFrame([("air_one_7/data", '{"pm":1}'), ("air_7/data", '{"pm":1}'), ("air_7/data", "{"), ("toaster", "{}"), ("air_7", '{"co2":null}')], "topic string, payload string")
    got = [(r["device_type"], r["reason"]) for r in ingest.parse_messages(m, allowed).collect()]
    assert got == [("air_one", None), ("air", "unknown key"), ("air", "unparseable payload"), (None, "unknown type"), ("air", None)]


def stream_of(spark, tmp_path, batches, schema):
    """A file stream that takes a file a batch, in order."""
    src = tmp_path / "in"
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(str(src / f"batch={i}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(src))


EVENTS = "event_time timestamp, zone_id long, camera string, occupancy_count int"


def ev(s, zone, camera, n):
    return (T0 + timedelta(seconds=s), zone, camera, n)


def test_bucket_stream_equals_batch_and_drops_late(spark, tmp_path):
    batches = [[ev(1, 1, "a", 2), ev(3, 1, "b", 0), ev(4, 2, "a", None)], [ev(12, 1, "a", 1), ev(31, 1, "a", 5)], [ev(33, 1, "a", 5)], [ev(2, 1, "a", 99), ev(60, 1, "a", 0)]]  # Spark drops what is late by the batch before
    make = lambda df: streams.count_buckets(df, 10, 5, ["zone_id"], "camera")
    q = streams.to_memory(make(stream_of(spark, tmp_path, batches, EVENTS)), "x01", str(tmp_path / "ck"))
    q.awaitTermination()
    got = sorted(map(str, spark.table("x01").collect()))
    kept = spark.createDataFrame([r for b in batches for r in b if r[3] != 99], EVENTS)
    want = sorted(map(str, make(kept).where(F.col("bucket") < F.lit(T0 + timedelta(seconds=50))).collect()))
    assert got == want and len(got) == 4


def test_zone_map_and_room_buckets(spark):
    m = spark.createDataFrame([(T0, {"1": 2, "3": None})], "event_time timestamp, zones map<string,int>")
    assert {(r["zone_id"], r["occupancy_count"]) for r in streams.zone_messages(m).collect()} == {("1", 2), ("3", None)}
    r = streams.room_buckets(spark.createDataFrame([(T0, 1.0), (T0, 3.0)], "event_time timestamp, pm double"), ["pm"]).first()
    assert (r["pm"], r["samples"]) == (2.0, 2)


def test_once_and_sessions(spark, tmp_path):
    batches = [[ev(0, 1, "a", 1), ev(10, 1, "a", 1)], [ev(0, 1, "a", 1), ev(20, 1, "a", 1), ev(50, 1, "a", 1)], [ev(500, 1, "a", 1)]]
    df = stream_of(spark, tmp_path, batches, EVENTS)
    streams.to_memory(streams.once(df, ["zone_id", "event_time"]), "x04", str(tmp_path / "c4")).awaitTermination()
    assert spark.table("x04").count() == 5
    streams.to_memory(streams.sessions(df, 11, ["zone_id"]), "x09", str(tmp_path / "c9")).awaitTermination()
    got = sorted((r["session_start"], r["last_row"], r["rows"]) for r in spark.table("x09").collect())
    assert got == [(T0, T0 + timedelta(seconds=20), 4), (T0 + timedelta(seconds=50), T0 + timedelta(seconds=50), 1)]


def test_restart_writes_no_bucket_twice(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "bucket timestamp, n int, seq long"
    read = lambda: spark.read.schema(schema).parquet(path) if (tmp_path / "table").exists() else None
    run = streams.append_new(read, lambda df: df.write.mode("append").parquet(path), ["bucket"], ["seq"])
    b = lambda *x: spark.createDataFrame([(T0 + timedelta(seconds=10 * s), n, s) for s, n in x], schema)
    run(b((0, 1), (1, 2)), 0)
    run(b((1, 9), (2, 3)), 1)
    assert sorted((r["seq"], r["n"]) for r in read().collect()) == [(0, 1), (1, 2), (2, 3)]


def test_sparse_stream_merge(spark):
    store = {}
    run = streams.merge_sparse(lambda: store.get("t"), lambda df: store.update(t=spark.createDataFrame(df.collect(), df.schema)), ["k"], "seq")
    run(spark.createDataFrame([(1, 1, 2.0, None)], "k long, seq long, temp double, label int"), 0)
    run(spark.createDataFrame([(1, 1, None, 1)], "k long, seq long, temp double, label int"), 1)
    assert store["t"].first().asDict() == {"k": 1, "temp": 2.0, "label": 1}


def test_event_time_choice(spark):
    df = spark.createDataFrame([(None, 1), (5, 2)], "a int, b int")
    assert [r[0] for r in df.select(streams.event_time(F.col("a"), F.col("b"))).collect()] == [1, 5]
    assert [r[0] for r in df.select(streams.event_time(F.col("a"), F.col("b"), False)).collect()] == [1, 2]


def test_carry_forward_over_batches(spark, tmp_path):
    schema = "device_id long, event_time timestamp, seq long, state string, level string"
    row = lambda s, state, level: (1, T0 + timedelta(seconds=s), s, state, level)
    df = stream_of(spark, tmp_path, [[row(1, "on", None), row(2, None, "5")], [row(3, None, None), row(4, "off", None)]], schema)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = streams.to_memory(streams.carry_forward_stream(df, ["state", "level"]), "x06", str(tmp_path / "c6"))
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert [(r["state"], r["level"]) for r in spark.table("x06").orderBy("seq").collect()] == [("on", None), ("on", "5"), ("on", "5"), ("off", "5")]


def test_live_scores(spark):
    w = spark.createDataFrame([(1, T0 + timedelta(seconds=10 * i), float(i)) for i in range(9)], "zone_id long, timestamp timestamp_ntz, x double")
    labels = spark.createDataFrame([(1, T0 + timedelta(seconds=70), 1)], "zone_id long, label_time timestamp_ntz, label int")
    out = streams.live_scores(w, lambda df: df.withColumn("probability", F.lit(0.5)), labels, {"x": 0.9}, T0 + timedelta(seconds=100), ["zone_id"]).collect()
    assert len(out) == 1 and out[0]["gate_ok"] and out[0]["in_order"] and out[0]["label"] == 1


def test_records_span_lines_and_pieces(spark, tmp_path):
    rng = random.Random(3)
    value = lambda: rng.choice(['plain', '5" pipe', '"quoted, too"', '"two\nlines"', '"a ""b"", \n\n,"""', '""', '"closed" and more', '"x\n' + "y" * 300 + '\n"'])
    for part in (1, 2):
        lines = ["", "a,b"] + ["" if i % 41 == 0 else ",".join(value() for _ in range(3 if i % 37 == 0 else 2)) for i in range(1, 900)]
        (tmp_path / f"p{part}.csv").write_text("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    want_bad, want = [], []
    for part in (1, 2):
        with open(tmp_path / f"p{part}.csv", newline="") as f:
            reader, header = csv.reader(f), None
            for row in reader:
                if len(row) != 2:
                    want_bad.append((part, reader.line_num, len(row)))
                elif header is None:
                    header = row
                else:
                    want.append(tuple(row))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        good, bad = io.read_csv_checked(spark, str(tmp_path / "*.csv"), schema, skip=True)
        assert sorted((int(r["file"][-5]), r["number"], r["width"]) for r in bad.collect()) == sorted(want_bad)
        assert sorted((r["a"] or "", r["b"] or "") for r in good.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_an_unclosed_quote_is_one_record_of_no_width(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,2\n3,"open\n' + "4,5\n" * 50)
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    good, bad = io.read_csv_checked(spark, str(tmp_path / "x.csv"), schema, skip=True, most_lines=20)
    assert [tuple(r) for r in good.collect()] == [(1, "2")] and [(r["number"], r["width"], r["line"]) for r in bad.collect()] == [(53, None, None)]
