"""Scalar functions on messages and features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words for states, and other names of columns.
TRUE_WORDS = ["true", "on", "occupied", "detected", "yes"]
FALSE_WORDS = ["false", "off", "clear", "unoccupied", "none", "no"]
ALIASES = {"temperature": "temp", "humidity": "rh", "pm_2_5": "pm25"}
TARGET_ALIASES = ["zone_occupied", "cv_is_occupied", "is_occupied"]


def no_nan(col: Column) -> Column:
    """Null for NaN."""
    return F.when(F.isnan(col), None).otherwise(col)


def first_present(payload: Column, paths: list[str]) -> Column:
    """First value present among dotted paths of a JSON text (F04); a key that has the dots in its name goes before the path."""
    tries = [F.get_json_object(payload, p) for path in paths for p in dict.fromkeys((f"$['{path}']", f"$.{path}"))]
    return F.coalesce(*tries)


def to_float(text: Column) -> Column:
    """A number from text (F05): true and false are 1 and 0; what is no number, NaN included, is null."""
    word = F.lower(F.trim(text))
    return F.when(word == "true", 1.0).when(word == "false", 0.0).otherwise(no_nan(F.trim(text).try_cast("double")))


def to_binary(text: Column) -> Column:
    """1 or 0 from a state's text (F06): words, else whether a number is above 0; null where neither."""
    word = F.lower(F.trim(text))
    return F.when(word.isin(TRUE_WORDS), 1).when(word.isin(FALSE_WORDS), 0).otherwise((to_float(text) > 0).cast("int"))


def radar_state(fields: list[Column], configured: Column | None = None) -> Column:
    """Occupied if any radar field says so (F07); with a configured field, that one goes before the others."""
    anyone = F.greatest(*(to_binary(f) for f in fields)) if len(fields) > 1 else to_binary(fields[0])
    return anyone if configured is None else F.coalesce(to_binary(configured), anyone)


def person_count(payload: Column) -> Column:
    """Persons from the first key present of counted_persons, occupancy_count, count (F08): truncated, at least 0; an unreadable first key is null."""
    text = F.coalesce(*(F.get_json_object(payload, f"$.{k}") for k in ("counted_persons", "occupancy_count", "count")))
    number = no_nan(text.try_cast("double"))
    return F.when(number.isNotNull(), F.greatest(F.lit(0), number.try_cast("int")))


def zone_counts(payload: Column) -> Column:
    """Map of zone to nullable count (F09): counts_by_zone, and null for unlabeled_zones that it lacks; zones 1 to 15."""
    counts = F.coalesce(F.from_json(F.get_json_object(payload, "$.counts_by_zone"), "map<string,int>"), F.create_map().cast("map<string,int>"))
    bare = F.coalesce(F.from_json(F.get_json_object(payload, "$.unlabeled_zones"), "array<string>"), F.array().cast("array<string>"))
    missing = F.array_except(bare, F.map_keys(counts))
    more = F.map_from_arrays(missing, F.transform(missing, lambda _: F.lit(None).cast("int")))
    return F.map_filter(F.map_concat(counts, more), lambda k, _: k.try_cast("int").between(1, 15))


def zone_of_table(name: Column) -> Column:
    """Zone number of "Table N" (F10); null for other names and zones outside 1 to 16."""
    number = F.regexp_extract(name, r"^\s*[Tt]able\s+(\d{1,2})\s*$", 1).try_cast("int")
    return F.when(number.between(1, 16), number)


def entity_parts(entity: Column) -> Column:
    """Device and field of an entity name such as sensor.air_1_ab12_co2."""
    pattern = r"^\w+\.([a-z]+_\d+_[0-9a-z]+)_(\w+)$"
    part = lambda i: F.nullif(F.regexp_extract(entity, pattern, i), F.lit(""))
    return F.struct(part(1).alias("device_id"), part(2).alias("field"))


def with_missing_flags(df: DataFrame, features: list[str]) -> DataFrame:
    """Add ``<feature>_missing`` (F12): 1 where the value is null or NaN or a flag already says so; the value is then null. Running it again changes nothing."""
    gone = {}
    for c in features:
        value = F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
        gone[c] = value | (F.coalesce(F.col(f"{c}_missing"), F.lit(0)) > 0) if f"{c}_missing" in df.columns else value
    return df.select(
        *(F.when(~gone[c], F.col(c)).alias(c) if c in gone else F.col(c) for c in df.columns if c not in {f"{f}_missing" for f in features}),
        *(gone[c].cast("int").alias(f"{c}_missing") for c in features),
    )


def cyclic_time(ts: Column) -> dict[str, Column]:
    """Sine and cosine of the fractional hour and of the fractional weekday, Monday 0."""
    hour = F.hour(ts) + F.minute(ts) / 60 + F.second(ts) / 3600
    day = F.weekday(ts) + hour / 24
    turn = lambda x, n: x * (2 * 3.141592653589793 / n)
    return {"hour_sin": F.sin(turn(hour, 24)), "hour_cos": F.cos(turn(hour, 24)), "dow_sin": F.sin(turn(day, 7)), "dow_cos": F.cos(turn(day, 7))}


def clean_label(label: Column) -> Column:
    """0 or 1 from a label rounded half to even (part of F14); anything else is null."""
    value = F.bround(no_nan(label.cast("double")))
    return F.when(value.isin(0.0, 1.0), value.cast("int"))


def impute(df: DataFrame, fills: dict[str, float], drop: bool = True) -> DataFrame:
    """Fill values for null features and 0/1 missing flags (F15); rows that still lack a feature go."""
    out = df.select(
        *(F.coalesce(no_nan(F.col(c).cast("double")), F.lit(float(fills[c]))).alias(c) if c in fills else (F.coalesce(F.col(c), F.lit(0)) > 0).cast("int").alias(c) if c.endswith("_missing") else F.col(c) for c in df.columns)
    )
    return out.dropna(subset=list(fills)) if drop else out


def standardise(df: DataFrame, stats: DataFrame, features: list[str]) -> DataFrame:
    """(x - mean) / std from one row of ``<c>_mean`` and ``<c>_std`` (F16)."""
    joined = df.crossJoin(F.broadcast(stats))  # one row
    return joined.select(*(((F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_std")).alias(c) if c in features else F.col(c) for c in df.columns))


def rename_aliases(df: DataFrame) -> DataFrame:
    """Column aliases such as temperature_s5 to temp_s5, and old names of the target (F18); a name already there is kept."""
    out = {}
    for c in df.columns:
        for old, new in ALIASES.items():
            if c == old or c.startswith(f"{old}_s"):
                out[c] = new + c[len(old) :]
    targets = [c for c in TARGET_ALIASES if c in df.columns]
    if targets and "occupied" not in df.columns:
        out[targets[0]] = "occupied"
    return df.withColumnsRenamed({a: b for a, b in out.items() if b not in df.columns})


def hvac_state(payload: Column) -> dict[str, Column]:
    """Current temperature and humidity, mode and target of an air conditioner's state."""
    get = lambda p: F.get_json_object(payload, p)
    return {"temperature": to_float(get("$.attributes.current_temperature")), "humidity": to_float(get("$.attributes.current_humidity")), "mode": get("$.state"), "target": to_float(get("$.attributes.temperature"))}


def ordered_columns(df: DataFrame, preferred: list[str]) -> DataFrame:
    """Preferred columns first, the others after in their order."""
    first = [c for c in preferred if c in df.columns]
    return df.select(*first, *(c for c in df.columns if c not in first))


def co2_band(co2: Column) -> Column:
    """good under 800, moderate under 1200, else poor; unknown for null."""
    return F.when(no_nan(co2.cast("double")).isNull(), "unknown").when(co2 < 800, "good").when(co2 < 1200, "moderate").otherwise("poor")


def all_of(conditions: list[Column]) -> Column:
    """AND of conditions; true without any."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
