"""Joins (J01-J12)."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Rectangles that workers hold; pixels of a cell in which more of them meet boxes.
MOST_ZONES, CELL = 10_000, 128


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The frame, if no key repeats; else an error (J10: each side for one-to-one, the right for many-to-one)."""
    if not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError(f"rows repeat for {keys}")
    return df


def join_sources(spine: DataFrame, others: list[DataFrame], keys: list[str], check: bool = True) -> DataFrame:
    """Left joins of several sources on the grid (J01); no key may repeat on either side."""
    out = assert_unique(spine, keys) if check else spine
    for other in others:
        out = out.join(assert_unique(other, keys) if check else other, keys, "left")
    return out


def enrich_room(features: DataFrame, room: DataFrame, key: str = "timestamp") -> DataFrame:
    """One room-level row fans out to all zones of its slot (J02). Which side is broadcast is left to the size that Spark finds."""
    return features.join(room, key, "left")


def with_labels(features: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """Features with the labels of their key (J03): labels without features go, features without labels stay."""
    return features.join(labels, keys, "left")


def absent(batch: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key the table lacks."""
    return batch.join(table.select(*keys), keys, "left_anti")


def delete_using(table: DataFrame, batch: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """What a batch's keys leave of a table, and what they delete."""
    found = batch.select(*keys).distinct()
    return table.join(found, keys, "left_anti"), table.join(found, keys, "left_semi")


def to_zone(readings: DataFrame, zones: DataFrame, device: str = "device_id", ts: str = "timestamp", fallback: bool = False, first_slot: int = 16) -> DataFrame:
    """The zone of each device (J05): rows of devices not in the map go, or get slots from 16 on in order of first appearance."""
    if not fallback:
        return readings.join(zones, device)
    unknown = readings.join(zones, device, "left_anti").groupBy(device).agg(F.min(ts).alias("_first"))
    extra = unknown.withColumn("zone_id", (F.row_number().over(Window.orderBy("_first", device)) + first_slot - 1).cast("long"))  # a row for each unknown device
    return readings.join(zones.select(device, F.col("zone_id").cast("long")).unionByName(extra.drop("_first")), device)


def dense_grid(values: DataFrame, start, end, seconds: int, zones: DataFrame, ts: str = "timestamp", zone: str = "zone_id") -> DataFrame:
    """Every slot of [floor(start), end) for every zone, with the values there are."""
    first, last = (datetime.fromisoformat(str(x)) for x in (start, end))
    first -= timedelta(seconds=(first - datetime(1970, 1, 1)).total_seconds() % seconds)
    count = max(0, math.ceil((last - first).total_seconds() / seconds))
    slots = values.sparkSession.range(count).select(F.timestamp_add("SECOND", F.col("id") * seconds, F.lit(str(first)).cast("timestamp_ntz")).alias(ts))
    grid = slots.crossJoin(zones.select(zone).distinct())  # the grid itself is the result
    return grid.join(values, [ts, zone], "left")


def as_of(references: DataFrame, labels: DataFrame, keys: list[str], ref_ts: str, label_ts: str, value: str) -> DataFrame:
    """For each reference the newest label at or before it, of the same keys, and its age in minutes.

    Both sides are one sorted stream of each key and day, so no pairs are formed; the last label of the days before
    carries over from a table with a row for each key and day.
    """
    day = lambda c: F.date_trunc("DAY", F.col(c)).cast("timestamp_ntz")
    left = references.select("*", F.col(ref_ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(labels.schema[value].dataType).alias("_v"), F.lit(None).cast("timestamp_ntz").alias("_lts"))
    right = labels.select(*keys, F.col(label_ts).alias("_ts"), F.lit(0).alias("_side"), F.col(value).alias("_v"), F.col(label_ts).alias("_lts"))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_day", day("_ts"))
    label = F.when(F.col("_side") == 0, F.struct("_lts", "_v"))
    daily = both.groupBy(*keys, "_day").agg(F.max(label).alias("_d"))
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = daily.withColumn("_carry", F.last("_d", ignorenulls=True).over(before)).drop("_d")
    line = Window.partitionBy(*keys, "_day").orderBy("_ts", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = both.withColumn("_own", F.last(label, ignorenulls=True).over(line)).join(carried, [*keys, "_day"])
    found = F.coalesce("_own", "_carry")
    age = F.round(F.timestamp_diff("SECOND", found["_lts"], F.col(ref_ts)) / 60, 3)
    return own.where("_side = 1").select(*references.columns, found["_v"].alias(value), found["_lts"].alias(label_ts), age.alias("age_minutes"))


def _overlaps(boxes: DataFrame, zones: DataFrame, width: int, height: int) -> DataFrame:
    """Boxes clipped to the frame with the zones they touch; rectangles are half-open in pixels, so the far edge is not in."""
    clip = lambda c, n: F.greatest(F.lit(0), F.least(F.lit(n), F.col(c)))
    box = boxes.withColumns({"x1": clip("x1", width), "x2": clip("x2", width), "y1": clip("y1", height), "y2": clip("y2", height)})
    touch = (F.col("x1") < F.col("zx2")) & (F.col("x2") > F.col("zx1")) & (F.col("y1") < F.col("zy2")) & (F.col("y2") > F.col("zy1"))
    if zones.limit(MOST_ZONES + 1).count() <= MOST_ZONES:
        met = box.join(F.broadcast(zones), touch)
    else:  # both sides meet in cells of the picture; a pair counts in the cell where its common part begins
        cells = lambda df, side, a, b: df.withColumn(side, F.explode(F.sequence(F.floor(F.col(a) / CELL), F.floor(F.greatest(F.col(a), F.col(b) - 1) / CELL))))
        left, right = cells(cells(box, "_cx", "x1", "x2"), "_cy", "y1", "y2"), cells(cells(zones, "_cx", "zx1", "zx2"), "_cy", "zy1", "zy2")
        begins = (F.col("_cx") == F.floor(F.greatest("x1", "zx1") / CELL)) & (F.col("_cy") == F.floor(F.greatest("y1", "zy1") / CELL))
        met = left.join(right, ["_cx", "_cy"]).where(touch & begins).drop("_cx", "_cy")
    side = lambda a, b, c, d: F.greatest(F.lit(0), F.least(b, d) - F.greatest(a, c))
    inside = side(F.col("x1"), F.col("x2"), F.col("zx1"), F.col("zx2")) * side(F.col("y1"), F.col("y2"), F.col("zy1"), F.col("zy2"))
    return met.withColumn("ratio", inside / F.greatest(F.lit(1), (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))))


def assign_zone(boxes: DataFrame, zones: DataFrame, threshold: float = 0.3, width: int = 1920, height: int = 1080, box: str = "box_id", excluded: tuple[int, ...] = (16,)) -> DataFrame:
    """The zone that has the largest share of each box (J08): above 0 and at least the threshold; of equals the first in zone order. Boxes without one go."""
    met = _overlaps(boxes, zones.where(~F.col("zone_id").isin(list(excluded))), width, height)
    good = met.where((F.col("ratio") > 0) & (F.col("ratio") >= max(0.0, threshold)))
    return good.groupBy(box).agg(F.max_by(F.struct("zone_id", "ratio"), F.struct("ratio", -F.col("zone_order"))).alias("_z")).select(box, "_z.zone_id", "_z.ratio")


def zones_of(boxes: DataFrame, zones: DataFrame, threshold: float = 0.0, width: int = 1920, height: int = 1080, box: str = "box_id") -> DataFrame:
    """All zones that hold a box's centre (threshold 0), or that have at least the threshold of it."""
    met = _overlaps(boxes, zones, width, height)
    cx, cy = F.floor((F.col("x1") + F.col("x2")) / 2), F.floor((F.col("y1") + F.col("y2")) / 2)
    centre = (cx >= F.col("zx1")) & (cx < F.col("zx2")) & (cy >= F.col("zy1")) & (cy < F.col("zy2"))
    return met.where(centre if threshold <= 0 else F.col("ratio") >= threshold).select(box, "zone_id", "ratio")


def group_members(groups: DataFrame, latest: DataFrame, members: dict[str, str], device: str = "device_id") -> DataFrame:
    """Group members by type with their latest reading (J11); ``members`` maps array columns to types; unknown members have nulls."""
    out = None
    for column, kind in members.items():
        part = groups.select("group_id", F.lit(kind).alias("member_type"), F.explode(column).alias(device))
        out = part if out is None else out.unionByName(part)
    return out.join(latest, device, "left")


def sensor_status(expected: DataFrame, readings: DataFrame, device: str = "device_id") -> DataFrame:
    """Each expected device with its number of readings: working or missing."""
    active = readings.groupBy(device).agg(F.count(F.lit(1)).alias("n"))
    return expected.join(active, device, "left").select(*expected.columns, F.coalesce("n", F.lit(0)).alias("readings"), F.when(F.col("n").isNull(), "missing").otherwise("working").alias("status"))
