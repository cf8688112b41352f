"""Edge cases of lookups, merges, joins, windows, splits and metrics on hand-made frames."""

from __future__ import annotations

import math
import random
import statistics
from datetime import date, datetime, timedelta

import duckdb
import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorframe.functions import scalars
from sensorframe.functions import time as ft
from sensorframe.operators import buckets, joins, merge, metrics, models, query, reports, splits, windows
from sensorframe.sources import io

T0 = datetime(2024, 3, 4)
ROW = "timestamp timestamp_ntz, device_id long, value double, seq long"


def frame(spark, rows, schema=ROW):
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture()
def readings(spark):
    return frame(spark, [(T0 + timedelta(seconds=10 * i), i % 2, float(i), i) for i in range(12)])


def test_ranges_closed_and_half_open(readings):
    a, b = T0, T0 + timedelta(seconds=50)
    assert query.time_range(readings, a, b).count() == 6
    assert query.half_open(readings, a, b).count() == 5
    assert query.half_open(readings, a, date(2024, 3, 4)).count() == 12
    assert query.since(readings, b).count() == 7
    with pytest.raises(ValueError):
        query.time_range(readings, None, b)


def test_filters(readings):
    assert query.filtered(readings, {"device_id": []}).count() == 0
    assert query.filtered(readings, {}).count() == 12
    assert [r["seq"] for r in query.latest_n(readings, 99).collect()] == list(range(12))
    assert [r["seq"] for r in query.latest_n(readings, 3).collect()] == [9, 10, 11]
    with pytest.raises(ValueError):
        query.smoke_window(readings, 13)
    with pytest.raises(ValueError):
        query.configured(None, {}, {"layer": "bronze", "device": "x"})


def test_insert_twice_adds_nothing(readings):
    table, new = merge.insert_if_absent(readings.limit(0), readings, ["timestamp", "device_id"])
    again, none = merge.insert_if_absent(table, readings, ["timestamp", "device_id"])
    assert new.count() == 12 and none.count() == 0 and again.count() == 12


def test_null_keys_always_go_in(spark):
    rows = frame(spark, [(None, 1, 1.0, 1), (None, 1, 2.0, 2), (T0, 1, 3.0, 3), (T0, 1, 4.0, 4)])
    table, new = merge.insert_if_absent(rows, rows, ["timestamp", "device_id"], ["seq"])
    assert new.count() == 2 and table.count() == 6


def test_upsert_incoming_wins_and_needs_keys(readings):
    out = merge.upsert(readings, readings.where("seq < 3").withColumn("value", F.lit(-1.0)), ["seq"])
    assert out.count() == 12 and out.where("value < 0").count() == 3
    with pytest.raises(ValueError):
        merge.upsert(readings, readings.drop("seq"), ["seq"])


def test_sparse_update_keeps_features(spark):
    a = spark.createDataFrame([(1, 5, 2.0, "x")], "key long, seq long, temp double, note string")
    b = spark.createDataFrame([(1, 1, 1, "")], "key long, seq long, occupied int, note string")
    row = merge.sparse_merge([a, b], ["key"], "seq").first()
    assert (row["temp"], row["occupied"], row["note"]) == (2.0, 1, "x")


def test_freshness_of_empty_layers(readings):
    rows = {r["layer"]: r for r in merge.freshness(readings, {"bronze": readings, "silver": readings.limit(0)}).collect()}
    assert not rows["bronze"]["needs_update"] and rows["silver"]["reason"] == "layer is empty"


def test_unique_join(readings):
    other = readings.select("timestamp", F.lit(1).alias("power"))
    assert joins.join_sources(readings, [other], ["timestamp"]).count() == 12
    with pytest.raises(ValueError):
        joins.join_sources(readings, [other.union(other)], ["timestamp"])


def test_as_of_across_days_and_ties(spark):
    labels = frame(spark, [(1, T0, "a"), (1, T0 + timedelta(days=1), "b"), (2, T0 + timedelta(hours=5), "c")], "zone long, at timestamp_ntz, label string")
    refs = frame(spark, [(1, T0 - timedelta(seconds=1), 0), (1, T0, 1), (1, T0 + timedelta(days=9), 2), (2, T0, 3), (3, T0, 4)], "zone long, ts timestamp_ntz, id long")
    out = {r["id"]: (r["label"], r["age_minutes"]) for r in joins.as_of(refs, labels, ["zone"], "ts", "at", "label").collect()}
    assert out == {0: (None, None), 1: ("a", 0.0), 2: ("b", 8 * 1440.0), 3: (None, None), 4: (None, None)}


def test_largest_overlap_first_zone_on_ties(spark, monkeypatch):
    zones = spark.createDataFrame([(1, 0, 0, 0, 10, 10), (2, 1, 10, 0, 20, 10), (16, 2, 0, 0, 99, 99)], "zone_id long, zone_order long, zx1 long, zy1 long, zx2 long, zy2 long")
    boxes = spark.createDataFrame([(1, 5, 0, 15, 10), (2, 8, 0, 18, 10), (3, 50, 50, 60, 60), (4, -5, -5, 5, 5), (5, 3, 3, 3, 3)], "box_id long, x1 int, y1 int, x2 int, y2 int")
    got = {r["box_id"]: r["zone_id"] for r in joins.assign_zone(boxes, zones, 0.0, 100, 100).collect()}
    assert got == {1: 1, 2: 2, 4: 1}
    for most, cell in ((10_000, 128), (1, 7), (1, 128)):
        monkeypatch.setattr(joins, "MOST_ZONES", most)
        monkeypatch.setattr(joins, "CELL", cell)
        both = sorted((r["box_id"], r["zone_id"]) for r in joins.zones_of(boxes, zones.where("zone_id < 16"), 0.4, 100, 100).collect())
        assert both == [(1, 1), (1, 2), (2, 2), (4, 1)]


def test_state_carry_edges(spark):
    ev = frame(spark, [(T0 - timedelta(seconds=5), 1, 1.0, 1), (T0 + timedelta(seconds=31), 1, 0.0, 2)]).withColumn("state", F.col("value").cast("int"))
    grid = spark.createDataFrame([(T0 + timedelta(seconds=10 * i), 1) for i in range(6)], "timestamp timestamp_ntz, device_id long")
    got = [r["state"] for r in buckets.state_carry(ev, grid, 10, 25, ["device_id"], "seq").orderBy("timestamp").collect()]
    # the carried 1 is 15 and 25 seconds old (equal to the gap is known), then too old; the slot of the change takes the greater; then 0
    assert got == [1, 1, None, 1, 0, None]


def test_time_weighted_average(spark):
    rows = frame(spark, [(T0, 1, 0.0, 1), (T0 + timedelta(seconds=10), 1, 10.0, 2), (T0 + timedelta(seconds=40), 1, 10.0, 3), (T0, 2, 5.0, 4)])
    got = {r["device_id"]: r["time_weighted_avg"] for r in buckets.time_weighted_average(rows, ["device_id"]).collect()}
    assert got == {1: 8.75, 2: None}


def test_windows_do_not_cross_zones_and_need_labels(spark):
    rows = [(T0 + timedelta(seconds=10 * i), z, float(i), (i % 2) if i != 4 else None) for z in (1, 2) for i in range(6)]
    df = frame(spark, rows, "timestamp timestamp_ntz, zone_id long, x double, occupied int")
    w = windows.make_windows(df, ["x", "zone_id"], 3, ["zone_id"]).collect()
    assert len(w) == 6 and all(len(r["window"]) == 3 and {v[1] for v in r["window"]} == {float(r["zone_id"])} for r in w)


def test_events_restart_after_gaps_nulls_and_zones(spark):
    rows = [(0, 1, 1), (10, 1, 1), (20, 1, None), (30, 1, 1), (60, 1, 1), (70, 1, 0), (0, 2, 1)]
    df = frame(spark, [(T0 + timedelta(seconds=s), z, o) for s, z, o in rows], "timestamp timestamp_ntz, zone_id long, occupied int")
    assert windows.evidence(df, ["zone_id"], 10).first().asDict() == {"positive_buckets": 5, "negative_buckets": 1, "positive_events": 4}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@example(values=[5.0] + [None] * 199 + [8.0, float("inf"), float("nan")])
@given(values=st.lists(st.one_of(st.none(), st.floats(-50, 50)), min_size=1, max_size=30))
def test_ema_against_a_loop(spark, values):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k long, i long, v double").repartition(2)
    got = [r["ema"] for r in windows.ema(df, "v", ["k"], ["i"]).orderBy("i").collect()]
    s = None
    for v, g in zip(values, got, strict=True):
        s = s if v is None or not math.isfinite(v) else v if s is None else v / 3 + s * 2 / 3
        assert (g is None and s is None) or abs(g - s) < 1e-9


def test_splits(spark):
    df = frame(spark, [(T0 + timedelta(days=d, hours=h), h, 0.0, d) for d in range(5) for h in range(4)])
    assert {r["split"]: r["n"] for r in splits.blind_last_days(df, 2).groupBy("split").agg(F.count("*").alias("n")).collect()} == {"test": 8, "pre_test": 12}
    with pytest.raises(ValueError):
        splits.blind_last_days(df, 5)
    for day in ("2024-03-04", "2024-03-20"):
        with pytest.raises(ValueError):
            splits.blind_date(df, day)
    for grouped, few in ((False, df.limit(1)), (True, df.where("seq = 0 AND device_id = 0").unionByName(df.where("seq = 0 AND device_id = 0")))):
        with pytest.raises(ValueError):
            splits.chronological_fold(few, 0.2, grouped)
    one = splits.chronological_fold(df.where("seq = 0"), 0.01)
    assert one.where("role = 'validation'").count() == 1
    folds = splits.rolling_folds(spark.createDataFrame([(date(2024, 1, d), d != 3) for d in range(1, 7)], "date date, eligible boolean"), 9, 2)
    roles = sorted((r["fold"], r["date"].day, r["role"]) for r in folds.collect())
    assert [r for r in roles if r[2] == "validation"] == [(1, 2, "validation"), (1, 4, "validation"), (2, 5, "validation"), (2, 6, "validation")]
    assert all(r[1] < 5 for r in roles if r[2] == "train")
    assert [splits.choose_mode(n, ok) for n, ok in ((2, True), (1, True), (3, False))] == ["rolling", "emergency", "bootstrap"]
    with pytest.raises(ValueError):
        splits.choose_mode(0, True)


def test_metrics_of_degenerate_sets(spark):
    of = lambda rows: spark.createDataFrame(rows, "y int, probability double")
    assert metrics.average_precision(of([(0, 0.3), (0, 0.7)])).first()[0] == 0.0
    assert metrics.average_precision(of([(1, 0.3), (1, 0.7)])).first()[0] == 1.0
    assert metrics.average_precision(of([])).first()[0] is None
    assert metrics.roc_auc(of([(1, 0.3)])).first()[0] is None
    assert metrics.roc_auc(of([(1, 0.5), (0, 0.5)])).first()[0] == 0.5
    assert metrics.binary_metrics(of([(1, 0.0), (0, 1.0)])).first()["log_loss"] == pytest.approx(16.118, abs=1e-2)
    assert metrics.class_weight(of([(0, 0.1), (0, 0.2)])).first()[0] == 2.0


def test_blocks_of_a_series_do_not_show(spark, monkeypatch):
    rng = random.Random(8)
    rows = []
    for z in (1, 2, None):
        at = 0
        for i in range(rng.choice([1, 40, 75])):
            at += rng.choice([10, 10, 10, 3600, 40000])
            rows.append((T0 + timedelta(seconds=at), z, rng.choice([None, float(i), float("nan"), 2.5]), rng.choice([None, 0, 1, 1]), len(rows)))
    df = frame(spark, rows, "timestamp timestamp_ntz, zone_id long, value double, occupied int, seq long")

    def all_of():
        k = ["zone_id"]
        frames = [
            windows.window_quality(df, ["value"], 5, 0.5, k), windows.make_windows(df, ["value"], 5, k), windows.positive_runs(df, k, 10), windows.cadence(df, k, T0 + timedelta(days=60)),
            windows.windows_by_lookback(df, ["value"], [2, 5], 0.4, k), windows.carry_forward(df, ["value", "occupied"], k, ["timestamp", "seq"]), windows.ema(df, "value", k, ["timestamp", "seq"]),
            windows.strictly_rising(df, k), buckets.time_weighted_average(df, k),
        ]
        plain = lambda x: round(x, 9) if isinstance(x, float) and x == x else str(x)
        return [(f.columns, sorted(([plain(x) for x in r] for r in f.collect()), key=str)) for f in frames]

    whole = all_of()
    for size in (7, 4):
        monkeypatch.setattr(windows, "BLOCK_ROWS", size)
        assert all_of() == whole
    line = Window.partitionBy("zone_id").orderBy("timestamp")
    want = df.withColumn("w", F.avg(windows.present(df, "value")).over(line.rowsBetween(-4, 0))).where("w IS NOT NULL").agg(F.sum("w")).first()[0]
    assert len(whole[0][1]) == df.count() and want is not None


def test_median_in_rounds(spark, monkeypatch):
    rng = random.Random(2)
    for n in (1, 2, 7, 500, 501):
        values = [rng.choice([rng.gauss(0, 1e6), 3.0, rng.random()]) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in [*values, None, float("nan"), float("inf")]], "x double")
        for few in (10_000, 4):
            monkeypatch.setattr(reports, "FEW_ROWS", few)
            assert reports.exact_median(df, "x") == pytest.approx(statistics.median(values), abs=1e-9)
    assert reports.fill_values(df.where("x IS NULL"), ["x"]).first()["x"] == 0.0
    assert reports.exact_median(spark.createDataFrame([(2.0,)] * 50, "x double"), "x") == 2.0


def test_replay_is_held_at_both_ends(spark):
    df = frame(spark, [(T0 + timedelta(seconds=10 * i), 1, float(i), i) for i in range(20)])
    ticks = spark.range(15).select(F.col("id").alias("tick"))
    got = {}
    for r in windows.replay(df, ticks, 10, 3, None, ["timestamp", "seq"]).collect():
        got.setdefault(r["tick"], []).append(r["seq"])
    assert {t: sorted(x) for t, x in got.items()} == {t: list(range(max(0, min(9 + t, 19) - 12), min(9 + t, 19) + 1)) for t in range(15)}
    for start, lookback in ((T0 + timedelta(days=1), 10), (None, 21)):
        with pytest.raises(ValueError):
            windows.replay(df, ticks, lookback, 3, start, ["timestamp", "seq"])


def test_promotion_refuses_what_is_not_finite(spark):
    good = {"mode": "strict", "folds": 2, "pr_auc": 0.9, "cv_pr_auc": 0.8, "positive_windows": 60.0, "positive_buckets": 60.0, "positive_events": 6.0, "brier": 0.1, "log_loss": 0.3, "production_mode": "strict", "production_folds": 1, "production_reported": 0.5, "production_pr_auc": 0.5}
    evidence = ["pr_auc", "cv_pr_auc", "positive_windows", "positive_buckets", "positive_events", "brier", "log_loss", "production_pr_auc"]
    cases = [(good, "promote")] + [({**good, c: bad}, "fail") for c in evidence for bad in (None, float("nan"), float("inf"))]
    cases += [({**good, "production_pr_auc": 0.9}, "skip"), ({**good, "folds": 1}, "promote"), ({**good, "folds": 1, "production_reported": 0.9}, "fail"), ({**good, "folds": 2, "production_folds": 2}, "fail"), ({**good, "folds": 3, "production_folds": 3}, "promote")]
    cases += [({**good, "mode": "bootstrap"}, "fail"), ({**good, "mode": "bootstrap", "production_mode": None, "folds": None}, "promote"), ({**good, "mode": "degenerate"}, "fail"), ({**good, "folds": None}, "fail"), ({**good, "production_mode": "other"}, "fail"), ({**good, "mode": None}, "fail")]
    names = list(good)
    schema = ", ".join(f"{n} {'string' if 'mode' in n else 'int' if 'folds' in n else 'double'}" for n in names)
    runs = spark.createDataFrame([(i, *(c[n] for n in names)) for i, (c, _) in enumerate(cases)], f"run int, {schema}")
    got = {r["run"]: (r["decision"], r["reason"]) for r in metrics.promotion(runs).collect()}
    assert {i: d for i, (d, _) in got.items()} == {i: d for i, (_, d) in enumerate(cases)}, got


def test_message_times_do_not_depend_on_the_zone_of_the_session(spark):
    texts = ["1704067200", "1704067200.5", "2024-01-01T00:00:00Z", "2024-01-01 05:00:00+05:00", "2024-01-01 08:00:00", "2024-01-01_08-00-00", "2024-01-01T08:00:00", "nan", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = [datetime(2024, 1, 1, 8)] * 7 + [None, None]
    want[1] = datetime(2024, 1, 1, 8, 0, 0, 500000)
    try:
        for zone in ("UTC", "America/New_York", "Asia/Singapore"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r["x"] for r in df.select("i", ft.message_time(F.col("t")).alias("x")).orderBy("i").collect()] == want
            assert [r["x"] for r in df.where("i BETWEEN 2 AND 4").select("i", ft.to_local_naive(F.col("t")).alias("x")).orderBy("i").collect()] == want[2:5]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stores_are_pruned(spark, tmp_path):
    path = str(tmp_path / "store")
    io.save_by_day(frame(spark, [(T0 + timedelta(hours=6 * i), 1, float(i), i) for i in range(40)]), path)
    store = io.scan_raw(spark, path)
    a, b = T0 + timedelta(days=2), T0 + timedelta(days=3)
    hour = buckets.bucket_mean(store, {"value": F.col("value")}, 3600, ["device_id"], a, b)
    for df, n in ((query.half_open(store, a, b), 4), (query.half_open(store, a, b, seconds=3600), 4), (query.half_open(store, a, date(2024, 3, 7)), 8), (query.by_region(store, a, b, [1]), 5), (hour, 4)):
        assert df.count() == n and "PartitionFilters: []" not in df._jdf.queryExecution().toString()


def test_rank_metrics_against_loops(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, probability double").repartition(4)
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for s in sorted({s for _, s in rows}, reverse=True):
        tp, fp = sum(p >= s for p in pos), sum(n >= s for n in neg)
        ap += (tp / len(pos) - last) * tp / (tp + fp)
        last = tp / len(pos)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(auc) and metrics.average_precision(df).first()[0] == pytest.approx(ap)


def test_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(scalars.person_count(F.lit('{"counted_persons":"?","count":3}'))) is None
    assert one(scalars.person_count(F.lit('{"count":-2.5}'))) == 0
    assert one(scalars.to_binary(F.lit("NaN"))) is None and one(scalars.to_float(F.lit(" 1.5 "))) == 1.5
    assert one(ft.to_local_naive(F.lit("2024-01-01T00:00:00+02:00"))) == datetime(2024, 1, 1, 6)
    assert one(ft.to_local_naive(F.lit("nonsense"))) is None
    assert one(ft.floor_to(F.lit("1969-12-31 23:59:59").cast("timestamp_ntz"))) == datetime(1969, 12, 31, 23, 59, 50)
    assert one(scalars.zone_counts(F.lit('{"unlabeled_zones":[1,16]}'))) == {"1": None}
    assert reports.required_rows(10, 0.75) == 6480


def test_model_beats_the_base_rate(spark):
    rng = random.Random(2)
    rows = [(T0 + timedelta(seconds=10 * i), z, (i // 20) % 2 * 3 + rng.random(), (i // 20) % 2) for z in (1, 2) for i in range(200)]
    df = frame(spark, rows, "timestamp timestamp_ntz, zone_id long, x double, occupied int")
    w = models.window_features(df, ["x"], 5, ["zone_id"])
    model = models.fit_occupancy(w, ["x"], iterations=10)
    scored = models.predict(model, w, ["timestamp"]).withColumnRenamed("y_true", "y")
    assert metrics.average_precision(scored).first()[0] > 0.9
    assert models.score_latest(model, w).count() == 2


def test_models_of_rows_of_one_class(spark):
    rows = [(T0 + timedelta(hours=6 * i), float(i % 7)) for i in range(48)]
    base = frame(spark, rows, "timestamp timestamp_ntz, x double").withColumn("zone_id", F.lit(1))
    day = lambda k: (T0 + timedelta(days=k)).date()
    folds = spark.createDataFrame([(1, day(k), "train" if k < 6 else "validation") for k in range(8)], "fold int, date date, role string")
    for y in (1, 0):
        df = models.window_features(base.withColumn("occupied", F.lit(y)), ["x"], 3, ["zone_id"])
        model = models.fit_occupancy(df, ["x"])
        assert {r[0] for r in models.predict(model, df, ["timestamp"]).select("probability").collect()} == {float(y)}
        assert [r["probability"] for r in models.score_latest(model, df).collect()] == [y]
        assert [tuple(r) for r in models.cross_validate(df, folds, ["x"]).select("fold", "pr_auc").collect()] == [(1, y)]
    chosen = models.select_and_test(df.withColumn("occupied", F.lit(1)), folds, {"x": ["x"]}, 3)
    assert (chosen["folds"], chosen["test_pr_auc"], chosen["test_rows"]) == ({"x": [1.0]}, 1.0, 12)
    assert models.loss_by_round(models.fit_boosted(df.withColumn("occupied", F.lit(1)), ["x"], 1), df.withColumn("occupied", F.lit(1)))[0] < 0.7
    with pytest.raises(ValueError, match="no labelled rows"):
        models.fit_occupancy(df.withColumn("occupied", F.lit(None).cast("int")), ["x"])


def test_medians_of_all_columns_in_few_scans(spark, monkeypatch):
    monkeypatch.setattr(reports, "FEW_ROWS", 20)
    rng = random.Random(12)
    for n in (1, 2, 7, 20_000, 20_001):
        columns = {
            "flat": [3.0] * n, "wide": [rng.choice([-1.7e308, 1.7e308]) for _ in range(n)], "ties": [float(rng.randrange(3)) for _ in range(n)],
            "spread": [rng.gauss(0, 1e6) for _ in range(n)], "gaps": [rng.choice([None, float("nan"), float("inf"), 1.0, 2.5]) for _ in range(n)], "none": [None] * n,
        }
        df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(3)
        got = reports.exact_medians(df, list(columns))
        for c, values in columns.items():
            known = sorted(x for x in values if x is not None and math.isfinite(x))
            a, b = (known[(len(known) - 1) // 2], known[len(known) // 2]) if known else (None, None)
            assert got[c] == (None if a is None else (a + b) / 2 if math.isfinite(a + b) else a / 2 + b / 2), (n, c)
    assert reports.fill_values(df, ["none", "flat"]).first().asDict() == {"none": 0.0, "flat": 3.0}
    assert set(reports.exact_medians(df.limit(0), ["flat"]).values()) == {None} and reports.exact_medians(df, []) == {}


def test_append_stats_count_rows_and_keys(spark):
    table = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    batch = spark.createDataFrame([(2,), (2,), (3,), (None,), (4,), (4,)], "k int")
    assert merge.append_stats(table, batch, ["k"]).first().asDict() == {"existing": 4, "fetched": 6, "inserted": 2, "updated": 2, "total": 5}
    assert merge.append_stats(table.limit(0), batch.limit(0), ["k"]).first().asDict() == {"existing": 0, "fetched": 0, "inserted": 0, "updated": 0, "total": 0}


def test_fold_summary_counts_what_is_finite(spark):
    schema = "run int, pr_auc double, best_epoch int"
    rows = [(1, 0.5, 4), (1, float("inf"), 0), (1, float("nan"), 7), (2, float("nan"), 0), (2, None, None), (3, 0.25, 90), (3, 0.75, 80)]
    got = {r["run"]: (r["mean_score"], r["std_score"], r["epochs"]) for r in metrics.fold_summary(spark.createDataFrame(rows, schema), keys=["run"], most_epochs=60).collect()}
    assert got == {1: (0.5, 0.0, 6), 2: (-1.0, None, 60), 3: (0.5, 0.25, 60)}


@pytest.mark.parametrize("span", [1, 2, 5, 100, 3000])
def test_ema_of_any_span(spark, monkeypatch, span):
    monkeypatch.setattr(windows, "BLOCK_ROWS", 500)
    monkeypatch.setattr(windows, "RUN_DECAY", 20.0 if span < 100 else 230.0)
    rng = random.Random(span)
    rows = [(k, i, rng.choice([None, float("inf"), float("nan")]) if rng.random() < 0.3 or 700 < i < 1900 else rng.gauss(5, 50)) for k in (1, 2) for i in range(2500)]
    out = {(r["k"], r["i"]): r["ema"] for r in windows.ema(frame(spark, rows, "k int, i int, v double"), "v", ["k"], ["i"], span).collect()}
    for k in (1, 2):
        s = None
        for _, i, x in (r for r in rows if r[0] == k):
            if x is not None and math.isfinite(x):
                s = x if s is None else 2 / (span + 1) * x + (1 - 2 / (span + 1)) * s
            assert out[k, i] == (None if s is None else pytest.approx(s, abs=1e-9 if span < 100 else 1e-7)), (k, i)


def test_rounds_of_the_folds_drive_the_refit(spark):
    rng = random.Random(21)
    rows = [(T0 + timedelta(hours=h), z, float(h % 24 > 8) * 3 + rng.gauss(0, 1.5), int(h % 24 > 8) if rng.random() > 0.1 else rng.randrange(2)) for h in range(24 * 6) for z in (1, 2, 3)]
    df = models.window_features(spark.createDataFrame(rows, "timestamp timestamp_ntz, zone_id int, x double, occupied int"), ["x"], 3, ["zone_id"]).persist()
    day = lambda k: (T0 + timedelta(days=k)).date()
    folds = spark.createDataFrame([(f, day(k), "train" if k < f + 2 else "validation") for f in (1, 2) for k in range(f + 3)], "fold int, date date, role string")
    model, found, summary = models.fit_at_best_round(df, folds, ["x"], 6)
    got = {r["fold"]: r for r in found.collect()}
    assert got.keys() == {1, 2} and all(1 <= r["best_epoch"] <= 6 and r["pr_auc"] > 0.8 for r in got.values())
    assert summary["epochs"] == math.ceil(statistics.median(r["best_epoch"] for r in got.values())) == model.stages[-1].getNumTrees
    assert summary["mean_score"] == pytest.approx(statistics.mean(r["pr_auc"] for r in got.values()))
    # trees of fewer rounds are the first of those of more, so a model that stops at the best round is the one of the curve
    held = df.where(F.col("timestamp").cast("date") == F.lit(day(3)))
    long, short = (models.fit_boosted(df, ["x"], n) for n in (4, 2))
    curve, again = models.loss_by_round(long, held), models.loss_by_round(short, held)
    assert curve[:2] == pytest.approx(again)
    one = models.best_rounds(df.withColumn("occupied", F.lit(1)), folds.where("fold = 1"), ["x"], 3).first()
    assert (one["best_epoch"], one["pr_auc"]) == (0, None)


def test_models_are_compared_on_the_same_windows(spark):
    rng = random.Random(22)
    rows = [(T0 + timedelta(hours=h), z, rng.randrange(2), rng.random(), rng.random()) for h in range(40) for z in (1, 2)]
    schema = "timestamp timestamp_ntz, zone_id int, y_true int, probability double"
    a = spark.createDataFrame([r[:4] for r in rows], schema)
    b = spark.createDataFrame([(*r[:3], r[4]) for r in rows], schema)
    got = models.same_window(a, b, ["timestamp", "zone_id"]).first()

    def precision(scores):
        ranked, seen, total = sorted(zip(scores, (r[2] for r in rows), strict=True), reverse=True), 0, 0.0
        for k, (_, y) in enumerate(ranked, 1):
            seen += y
            total += y * seen / k
        return total / sum(r[2] for r in rows)

    assert got["rows"] == 80 and got["pr_auc"] == pytest.approx(precision([r[3] for r in rows])) and got["production_pr_auc"] == pytest.approx(precision([r[4] for r in rows]))
    for wrong in (b.where("zone_id = 1"), b.union(b.limit(1)), b.withColumn("y_true", 1 - F.col("y_true"))):
        with pytest.raises(ValueError):
            models.same_window(a, wrong, ["timestamp", "zone_id"])


def test_predictions_from_the_models_coefficients(spark):
    """The stored probabilities are those that SQL gets from the coefficients, on the rows that were left out of the fit."""
    rng = random.Random(23)
    rows = [(T0 + timedelta(minutes=m), z, rng.gauss(z + (m // 30) % 2, 1), (m // 30) % 2) for m in range(400) for z in (1, 2)]
    df = models.window_features(spark.createDataFrame(rows, "timestamp timestamp_ntz, zone_id int, x double, occupied int"), ["x"], 4, ["zone_id"])
    model = models.fit_occupancy(df.where("timestamp < TIMESTAMP_NTZ '2024-03-04 05:00:00'"), ["x"])
    scored = models.predict(model, df.where("timestamp >= TIMESTAMP_NTZ '2024-03-04 05:00:00'"), ["timestamp", "zone_id", *models.model_columns(["x"])]).toPandas()
    scaler, fitted = model.stages[1], model.stages[2]
    terms = " + ".join(f"{w!r} * ({c} - {m!r}) / {s!r}" for c, w, m, s in zip(models.model_columns(["x"]), fitted.coefficients.tolist(), scaler.mean.tolist(), scaler.std.tolist(), strict=True))
    worst = duckdb.sql(f"SELECT max(abs(probability - 1 / (1 + exp(-({fitted.intercept!r} + {terms}))))) FROM scored").fetchall()[0][0]
    assert len(scored) == 200 and worst < 1e-9 and scored["probability"].std() > 0.1
