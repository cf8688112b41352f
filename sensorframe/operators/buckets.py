"""Aggregations on the time grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import clean_label, no_nan
from ..functions.time import floor_to
from .merge import keep_last
from .query import pruned
from .windows import carry_forward, in_blocks


def bucket_mean(readings: DataFrame, values: dict[str, Column], seconds: int, keys: list[str], start=None, end=None, ts: str = "timestamp") -> DataFrame:
    """Mean of each value in each slot and key (A01); NaN counts as missing; times from start to before end."""
    rows = pruned(readings, start, end)
    if start is not None:
        rows = rows.where(F.col(ts) >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        rows = rows.where(F.col(ts) < F.lit(str(end)).cast("timestamp_ntz"))
    slot = rows.select(floor_to(F.col(ts), seconds).alias(ts), *keys, *(no_nan(v).alias(n) for n, v in values.items()))
    return slot.groupBy(ts, *keys).agg(*(F.avg(n).alias(n) for n in values))


def wide_positions(readings: DataFrame, metrics: dict[str, str], positions: list[int], seq: str, position: str = "zone_id", ts: str = "timestamp") -> DataFrame:
    """One row a second with ``<metric>_s<position>`` columns (A02); the last reading of a second wins."""
    second = F.date_trunc("SECOND", F.col(ts)).cast("timestamp_ntz")
    cells = [
        F.max_by(F.when(F.col(position) == p, F.col(c)), F.when((F.col(position) == p) & F.col(c).isNotNull(), F.struct(F.col(ts), F.col(seq)))).alias(f"{m}_s{p}") for m, c in metrics.items() for p in positions
    ]
    return readings.groupBy(second.alias(ts)).agg(*cells)


def bucket_power(readings: DataFrame, value: Column, seconds: int, zone: str = "zone_id", device: str = "device_id", ts: str = "timestamp") -> DataFrame:
    """Mean of each device in a slot, then the sum over a zone's devices."""
    slot = readings.select(floor_to(F.col(ts), seconds).alias(ts), zone, device, no_nan(value).alias("_v"))
    return slot.groupBy(ts, zone, device).agg(F.avg("_v").alias("_v")).groupBy(ts, zone).agg(F.sum("_v").alias("power"))


def power_column(df: DataFrame, candidates: tuple[str, ...] = ("power", "power_w", "active_power", "value")) -> Column:
    """The first of the candidate columns that the table has."""
    found = [c for c in candidates if c in df.columns]
    if not found:
        raise ValueError("no power column")
    return F.col(found[0]).try_cast("double")


def state_carry(events: DataFrame, grid: DataFrame, seconds: int, gap: int, keys: list[str], seq: str, state: str = "state", ts: str = "timestamp") -> DataFrame:
    """Occupancy in each slot of a grid from change events.

    A slot's value is the greatest of the state carried in and the states in it; it is unknown (null) where the newest
    event is more than ``gap`` seconds before the slot's end. Events before the grid seed the carry. Each slot
    with events is one row; the carry goes from row to row within blocks of the key, and from block to block.
    """
    slots = (
        events.where(F.col(state).isNotNull()).withColumn("_slot", floor_to(F.col(ts), seconds)).groupBy(*keys, "_slot")
        .agg(F.max(state).alias("_m"), F.max_by(F.struct(F.col(state).alias("l"), F.col(ts).alias("t")), F.struct(ts, seq)).alias("_last"))
    )
    both = grid.select(*keys, F.col(ts).alias("_slot"), F.lit(True).alias("_grid")).join(slots, [*keys, "_slot"], "full_outer")
    carried = carry_forward(both.withColumn("_carry", F.col("_last")), ["_carry"], keys, ["_slot"], own_row=False).where("_grid")
    newest = F.coalesce(F.col("_last.t"), F.col("_carry.t"))
    age = F.timestamp_diff("MICROSECOND", newest, F.timestamp_add("SECOND", F.lit(seconds), F.col("_slot"))) / 1e6
    return carried.select(F.col("_slot").alias(ts), *keys, F.when(age <= gap, F.greatest("_carry.l", "_m")).alias(state))


def bucket_flags(readings: DataFrame, flags: list[Column], seconds: int, keys: list[str], ts: str = "timestamp") -> DataFrame:
    """Greatest flag of a row, then of a slot; nulls are skipped."""
    row = F.greatest(*flags) if len(flags) > 1 else flags[0]
    return readings.select(floor_to(F.col(ts), seconds).alias(ts), *keys, row.alias("_f")).groupBy(ts, *keys).agg(F.max("_f").alias("occupied"))


def bucket_room(samples: DataFrame, numbers: list[str], texts: list[str], seconds: int, seq: str, sensor: str = "sensor_id", ts: str = "timestamp") -> DataFrame:
    """Mean of the samples of a slot, after keeping the last of each (time, sensor); texts are the latest that are not empty."""
    once = keep_last(samples, [ts, sensor], [seq]).withColumn("_slot", floor_to(F.col(ts), seconds))
    full = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c)) != "")
    return once.groupBy(F.col("_slot").alias(ts)).agg(
        *(F.avg(no_nan(F.col(c).cast("double"))).alias(c) for c in numbers),
        *(F.max_by(F.when(full(c), F.col(c)), F.when(full(c), F.struct(F.col(ts), F.col(seq)))).alias(c) for c in texts),
    )


def occupancy_stats(messages: DataFrame, seconds: int, keys: list[str], seq: str, count: str = "occupancy_count", mode: str = "median", threshold: float = 1.0, texts: tuple[str, ...] = (), ts: str = "timestamp") -> DataFrame:
    """Statistics of counts in each slot and key.

    sample_count, min, max, mean, median and last count, first and last message time, the count of the chosen ``mode``
    (max, last, mean or median), and occupied (median at least the threshold). Numbers have three digits. A slot with messages
    but no counts has 0 samples and nulls. Distinct ``texts`` are joined in order with a bar.
    """
    if mode not in ("max", "last", "mean", "median"):
        raise ValueError("mode is max, last, mean or median")
    c = F.col(count)
    place = F.when(c.isNotNull(), F.struct(F.col(ts), F.col(seq)))
    r = lambda x: F.round(x.cast("double"), 3)
    stats = messages.withColumn("_slot", floor_to(F.col(ts), seconds)).groupBy(F.col("_slot").alias("bucket"), *keys).agg(
        F.count(c).alias("sample_count"), r(F.min(c)).alias("min_count"), r(F.max(c)).alias("max_count"), r(F.avg(c)).alias("mean_count"), r(F.median(c)).alias("median_count"),
        r(F.max_by(c, place)).alias("last_count"), F.min(ts).alias("first_message_time"), F.max(ts).alias("last_message_time"),
        *(F.array_join(F.array_sort(F.collect_set(t)), "|").alias(t) for t in texts),
    )
    return stats.withColumn("occupancy_count", F.col(f"{mode}_count")).withColumn("occupied", (F.col("median_count") >= threshold).cast("int"))


def regroup_labels(labels: DataFrame, keys: list[str], seq: str, texts: tuple[str, ...] = ("source_topic",), rule: str = "threshold", threshold: float = 1.0, target: str | None = None) -> DataFrame:
    """One label row of each key (A10), with the occupied flag by one of three rules.

    ``explicit`` takes the last target given, else the threshold; ``threshold`` always the threshold on the median count;
    ``fallback`` the threshold, and the target only where there is no count.
    """
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq)))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(seq)))
    in_order = lambda c: F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.struct(seq, c)))), lambda x: x[c])), "|")
    out = labels.groupBy(*keys).agg(
        F.median("occupancy_count").alias("occupancy_count"), F.coalesce(F.sum("sample_count"), F.lit(0)).cast("long").alias("sample_count"), F.min("min_count").alias("min_count"),
        F.max("max_count").alias("max_count"), F.avg("mean_count").alias("mean_count"), F.median("median_count").alias("median_count"), last("last_count").alias("last_count"),
        first("first_message_time").alias("first_message_time"), last("last_message_time").alias("last_message_time"), *(in_order(t).alias(t) for t in texts),
        *([last(target).alias("_target")] if target else []),
    )
    return out.withColumn("occupied", occupied(F.col("median_count"), F.col("_target") if target else F.lit(None).cast("int"), rule, threshold)).drop("_target")


def occupied(count: Column, target: Column, rule: str = "threshold", threshold: float = 1.0) -> Column:
    """The label rule."""
    by_count = (count >= threshold).cast("int")
    if rule == "explicit":
        return F.coalesce(clean_label(target), by_count)
    if rule == "threshold":
        return by_count
    if rule == "fallback":
        return F.coalesce(by_count, clean_label(target))
    raise ValueError("rule is explicit, threshold or fallback")


def time_weighted_average(readings: DataFrame, keys: list[str], value: str = "value", ts: str = "timestamp", seq: str = "seq") -> DataFrame:
    """Average of the line through the readings of each key (A12); one reading, or no time between them, gives null."""
    rows = in_blocks(readings.where(no_nan(F.col(value)).isNotNull()), keys, [ts, seq], 1)
    line = Window.partitionBy(*keys, "_block").orderBy("_rn")
    steps = rows.select(*keys, "_halo", F.col(value).alias("v"), F.lag(value).over(line).alias("w"), (F.timestamp_diff("MICROSECOND", F.lag(ts).over(line), F.col(ts)) / 1e6).alias("dt")).where("NOT _halo")
    total = F.sum("dt")
    return steps.groupBy(*keys).agg(F.when(total > 0, F.sum((F.col("v") + F.col("w")) / 2 * F.col("dt")) / total).alias("time_weighted_avg"), F.count(F.lit(1)).alias("samples"))


def zone_head_counts(assigned: DataFrame, frames: DataFrame, zones: DataFrame, frame: str = "frame") -> DataFrame:
    """Boxes of each zone in each frame, 0 for empty zones, and the frame's total."""
    counts = assigned.groupBy(frame, "zone_id").agg(F.count(F.lit(1)).alias("n"))
    totals = assigned.groupBy(frame).agg(F.count(F.lit(1)).alias("t"))
    grid = frames.select(frame).distinct().crossJoin(F.broadcast(zones.select("zone_id").distinct()))  # the zones of one room
    return grid.join(counts, [frame, "zone_id"], "left").join(totals, frame, "left").select(frame, "zone_id", F.coalesce("n", F.lit(0)).alias("persons"), F.coalesce("t", F.lit(0)).alias("total"))
