"""Reports on quality, coverage and context."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import no_nan, to_binary
from .merge import keep_last

#: Shares of present values that live scoring needs.
CORE_REQUIRED, RADAR_REQUIRED = 0.80, 0.95


def time_summary(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows, first and last time."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))


def quality_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each column: type, nulls, NaNs and values that are not finite."""
    types = dict(df.dtypes)
    number = lambda c: types[c] in ("double", "float")
    bad = lambda c: F.isnan(c) | F.col(c).isin(float("inf"), float("-inf"))
    cells = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.count_if(F.col(c).isNull()).alias("nulls"), (F.count_if(F.isnan(c)) if number(c) else F.lit(0).cast("long")).alias("nans"), (F.count_if(bad(c)) if number(c) else F.lit(0).cast("long")).alias("not_finite"))
            for c in columns
        )
    )
    return df.agg(cells.alias("_c")).select(F.inline("_c"))


def availability(df: DataFrame, features: list[str], keys: list[str] | None = None) -> DataFrame:
    """Percent of rows that have each feature (A15); NaN is missing."""
    percent = lambda c: 100 * F.count(no_nan(F.col(c).cast("double"))) / F.count(F.lit(1))
    return df.groupBy(*(keys or [])).agg(*(percent(c).alias(c) for c in features))


#: Values that the driver may sort.
FEW_ROWS = 10_000


def required_rows(seconds: int, coverage: float) -> int:
    """Rows that a day needs."""
    slots = -(-86400 // seconds)
    return int(-(-slots * coverage // 1))


def date_coverage(df: DataFrame, seconds: int = 10, coverage: float = 0.75, zone: str | None = None, ts: str = "timestamp") -> DataFrame:
    """Distinct slots of each day, the least of its zones where there are any, and whether they are enough."""
    day = F.col(ts).cast("date").alias("date")
    rows = df.groupBy(day, *([zone] if zone else [])).agg(F.countDistinct(ts).alias("rows"))
    per_day = rows.groupBy("date").agg(F.min("rows").alias("rows"))
    return per_day.withColumn("eligible", F.col("rows") >= required_rows(seconds, coverage))


#: How finely a sketch tells ranks: to one in so many.
ACCURACY = 10_000


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """The medians of the finite values of all columns at once; null for a column without any.

    One scan makes a mergeable sketch of quantiles for each column, which brackets its median; the next counts what is below the bracket and brings the few values within it.
    Where over :data:`FEW_ROWS` values may lie within (from about 15 million rows on), further scans narrow all such brackets to about a hundredth first. No task or driver holds a column,
    and values are only compared, so their range does not matter.
    """
    v = {c: F.when(_finite(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    name = {c: f"c{i}" for i, c in enumerate(columns)}
    values = df.select(*(v[c].alias(name[c]) for c in columns))
    col = lambda c: F.col(name[c])
    spread = 2 / ACCURACY
    first = values.agg(*(F.struct(F.count(col(c)).alias("n"), F.min(col(c)).alias("min"), F.max(col(c)).alias("max"), F.percentile_approx(col(c), [0.5 - spread, 0.5 + spread], ACCURACY).alias("q")).alias(name[c]) for c in columns)).first() if columns else {}
    at = {c: first[name[c]] for c in columns if first[name[c]]["n"]}
    low, high = {c: r["q"][0] for c, r in at.items()}, {c: r["q"][1] for c, r in at.items()}
    within = {c: 3 * spread * r["n"] for c, r in at.items()}  # values strictly between, at most
    wide = lambda: [c for c in at if within[c] > FEW_ROWS and low[c] < high[c]]
    while some := wide():
        inner = {c: (col(c) > low[c]) & (col(c) < high[c]) for c in some}
        steps = [k / 100 for k in range(101)]
        cells = [F.struct(F.count_if(col(c) <= low[c]).alias("below"), F.count_if(inner[c]).alias("n"), F.percentile_approx(F.when(inner[c], col(c)), steps, ACCURACY).alias("q")).alias(name[c]) for c in some]
        got = values.agg(*cells).first()
        for c in some:
            r, n = got[name[c]], at[c]["n"]
            within[c] = r["n"]
            if not r["n"]:
                continue
            ranks = [(n // 2 - (n % 2 == 0) - r["below"]) / r["n"], (n // 2 - r["below"]) / r["n"]]
            least, most = math.floor((ranks[0] - spread) * 100), math.ceil((ranks[1] + spread) * 100)
            low[c] = r["q"][least] if least >= 0 else low[c]
            high[c] = r["q"][most] if most <= 100 else high[c]
            within[c] = r["n"] * (min(most, 100) - max(least, 0) + 2 * 100 / ACCURACY) / 100
    cells = [F.struct(F.count_if(col(c) < low[c]).alias("below"), F.count_if(col(c) == low[c]).alias("low"), F.count_if((col(c) == high[c]) & (col(c) > low[c])).alias("high"), F.collect_list(F.when((col(c) > low[c]) & (col(c) < high[c]), col(c))).alias("inner")).alias(name[c]) for c in at]
    got = values.agg(*cells).first() if at else {}
    out: dict[str, float | None] = dict.fromkeys(columns)
    for c, r in at.items():
        cell = got[name[c]]
        inner = sorted(cell["inner"])

        def nth(k: int, cell=cell, inner=inner, c=c) -> float:
            k -= cell["below"]
            if not 0 <= k < cell["low"] + len(inner) + cell["high"]:
                raise ArithmeticError("the sketch did not bracket the median")
            return low[c] if k < cell["low"] else inner[k - cell["low"]] if k < cell["low"] + len(inner) else high[c]

        a, b = nth((r["n"] - 1) // 2), nth(r["n"] // 2)
        out[c] = (a + b) / 2 if math.isfinite(a + b) else a / 2 + b / 2
    return out


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def exact_median(df: DataFrame, column: str) -> float | None:
    """The median of the finite values of one column (:func:`exact_medians`)."""
    return exact_medians(df, [column])[column]


def fill_values(train: DataFrame, features: list[str]) -> DataFrame:
    """Medians of the training rows, 0 where there is none (A17): one row, which the driver holds."""
    found = exact_medians(train, features)
    return train.sparkSession.createDataFrame([[found[c] or 0.0 for c in features]], T.StructType([T.StructField(c, T.DoubleType()) for c in features]))


def scaler_stats(train: DataFrame, features: list[str]) -> DataFrame:
    """Mean and population deviation of each feature; a deviation of 0 or none is 1."""
    out = []
    for c in features:
        std = F.stddev_pop(no_nan(F.col(c).cast("double")))
        out += [F.avg(no_nan(F.col(c).cast("double"))).alias(f"{c}_mean"), F.when((std > 0) & ~F.isnan(std), std).otherwise(1.0).alias(f"{c}_std")]
    return train.agg(*out)


def most_frequent_device(df: DataFrame, device: str = "device_id") -> DataFrame:
    """The device with most rows, of equals the least."""
    return df.groupBy(device).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), device).limit(1)


def seed_room_table(readings: DataFrame, columns: dict[str, str], pm4: tuple[str, str] = ("pm4_0", "pm2_5")) -> DataFrame:
    """Air-quality rows of another sensor under this table's names; pm4_0 falls back to pm2_5."""
    out = readings.select("timestamp", *(F.col(old).alias(new) for old, new in columns.items()))
    fine = F.col(pm4[1])
    return out.withColumn(pm4[0], F.coalesce(F.col(pm4[0]), fine) if pm4[0] in out.columns else fine)


def seed_labels(readings: DataFrame, flags: list[str]) -> DataFrame:
    """Labels from radar flags, null as 0."""
    state = [to_binary(F.col(f).cast("string")) for f in flags]
    return readings.select("timestamp", F.coalesce(F.greatest(*state) if len(state) > 1 else state[0], F.lit(0)).alias("occupied"))


def seed_from_csv(rows: DataFrame, aliases: dict[str, str], keys: list[str], seq: str) -> DataFrame:
    """CSV rows under known names, the last of each key."""
    return keep_last(rows.withColumnsRenamed({a: b for a, b in aliases.items() if a in rows.columns}), keys, [seq])


def label_snapshot(labels: DataFrame, count: str = "occupancy_count", target: str = "occupied", ts: str = "timestamp") -> DataFrame:
    """Sum of counts and greatest target over the zones at the newest label time."""
    newest = labels.agg(F.max(ts).alias(ts))
    return labels.join(F.broadcast(newest), ts).groupBy(ts).agg(F.sum(count).alias("total_count"), F.max(target).alias("occupied"), F.count(F.lit(1)).alias("zones"))  # one row


def environment_summary(latest: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean of the latest finite values over devices."""
    return latest.agg(*(F.avg(no_nan(F.col(m).cast("double"))).alias(m) for m in metrics))


def squared_error(scored: DataFrame, probability: str = "probability", label: str = "y") -> DataFrame:
    """Squared error of every labelled event."""
    return scored.where(F.col(label).isNotNull()).withColumn("squared_error", F.pow(F.col(probability) - F.col(label), 2))


def live_gate(window: DataFrame, required: dict[str, float]) -> DataFrame:
    """Share of present values of each feature in the last rows against what is required."""
    present = lambda c: F.avg(no_nan(F.col(c).cast("double")).isNotNull().cast("double"))
    cells = F.array(*(F.struct(F.lit(c).alias("feature"), F.round(present(c), 6).alias("present"), F.lit(n).alias("required")) for c, n in required.items()))
    return window.agg(cells.alias("_c")).select(F.inline("_c")).withColumn("passes", F.col("present") >= F.col("required"))


def room_warning(gate: DataFrame, features: list[str]) -> DataFrame:
    """One text that names the room features that fall short; null where none does."""
    short = F.array_sort(F.collect_list(F.when(F.col("feature").isin(features) & ~F.col("passes"), F.col("feature"))))
    return gate.agg(F.when(F.size(short) > 0, F.concat(F.lit("low availability: "), F.array_join(short, ", "))).alias("warning"))


def live_context(window: DataFrame, features: list[str], ts: str = "timestamp") -> DataFrame:
    """Bounds of a window, latest and mean values, and the least share of present values."""
    v = lambda c: no_nan(F.col(c).cast("double"))
    share = [F.avg(v(c).isNotNull().cast("double")) for c in features]
    return window.agg(
        F.min(ts).alias("window_start"), F.max(ts).alias("window_end"), *(F.max_by(v(c), F.when(v(c).isNotNull(), F.col(ts))).alias(f"{c}_latest") for c in features), *(F.avg(v(c)).alias(f"{c}_mean") for c in features),
        (F.least(*share) if len(share) > 1 else share[0]).alias("min_present"),
    )


def least_rows(df: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Rows of the zone that has fewest."""
    return df.groupBy(zone).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n").alias("min_rows"))


def dataset_summary(features: DataFrame, labels: DataFrame, joined: DataFrame, raw: list[str], label: str = "occupied", ts: str = "timestamp") -> DataFrame:
    """Rows of features, labels and their join, labelled or not, nulls of each raw feature, and time bounds."""
    bounds = lambda n: [F.count(F.lit(1)).alias(f"{n}_rows"), F.min(ts).alias(f"{n}_first"), F.max(ts).alias(f"{n}_last")]
    null: Column = F.col(label).isNull()
    j = joined.agg(*bounds("joined"), F.count_if(~null).alias("labelled"), F.count_if(null).alias("unlabelled"), *(F.count_if(no_nan(F.col(c).cast("double")).isNull()).alias(f"{c}_nulls") for c in raw))
    return features.agg(*bounds("feature")).crossJoin(labels.agg(*bounds("label"))).crossJoin(j)  # a row each


def gate_requirements(core: list[str], radar: list[str]) -> dict[str, float]:
    """Shares that the live gate asks for."""
    return {c: CORE_REQUIRED for c in core} | {c: RADAR_REQUIRED for c in radar}
