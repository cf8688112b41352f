"""Projections, filters and point lookups."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import all_of
from ..functions.time import floor_to


def load_all(df: DataFrame, columns: list[str] | None = None, order: str = "timestamp") -> DataFrame:
    """All rows in time order."""
    return (df.select(*columns) if columns else df).orderBy(order)


def time_range(df: DataFrame, start, end, ts: str = "timestamp") -> DataFrame:
    """Rows of the closed range (P02, P14); both bounds are needed. Partition columns year, month and day, if there, are filtered too."""
    if start is None or end is None:
        raise ValueError("both bounds are needed")
    return pruned(df, start, end).where(F.col(ts).between(_ts(start), _ts(end)))


def since(df: DataFrame, start, ts: str = "timestamp") -> DataFrame:
    """Rows from a time on."""
    return pruned(df, start, None).where(F.col(ts) >= _ts(start))


def half_open(df: DataFrame, start, end, ts: str = "timestamp", seconds: int | None = None) -> DataFrame:
    """Rows from start to before end (P12); an end that is a date alone means the whole day. With ``seconds`` times are floored first. Partitions are pruned as in :func:`time_range`."""
    if isinstance(end, date) and not isinstance(end, datetime):
        end = datetime(end.year, end.month, end.day) + timedelta(days=1)
    at = floor_to(F.col(ts), seconds) if seconds else F.col(ts)
    last = end + timedelta(seconds=seconds) if seconds and isinstance(end, datetime) else None if seconds else end  # a time that is floored lies later
    return pruned(df, start, last).where((at >= _ts(start)) & (at < _ts(end)))


def by_region(df: DataFrame, start=None, end=None, devices: list | None = None, ts: str = "timestamp", device: str = "device_id") -> DataFrame:
    """Optional bounds and devices (P04); partitions are pruned as in :func:`time_range`."""
    conditions = ([F.col(ts) >= _ts(start)] if start is not None else []) + ([F.col(ts) <= _ts(end)] if end is not None else []) + ([F.col(device).isin(list(devices))] if devices else [])
    return pruned(df, start, end).where(all_of(conditions))


def filtered(df: DataFrame, filters: dict[str, object]) -> DataFrame:
    """A scalar means equality, a collection membership, an empty collection no rows; all must hold."""
    conditions: list[Column] = []
    for name, want in filters.items():
        if isinstance(want, Iterable) and not isinstance(want, str):
            want = list(want)
            conditions.append(F.col(name).isin(want) if want else F.lit(False))
        else:
            conditions.append(F.col(name) == want)
    return df.where(all_of(conditions))


def latest_n(df: DataFrame, n: int, filters: dict[str, object] | None = None, order: list[str] | None = None) -> DataFrame:
    """The newest n rows after filters, oldest first."""
    order = order or ["timestamp"]
    newest = filtered(df, filters or {}).orderBy(*(F.desc(c) for c in order)).limit(n)
    return newest.orderBy(*order)


def bronze_default(df: DataFrame, limit: int = 100, order: list[str] | None = None) -> DataFrame:
    """Without filters, the oldest rows up to a limit."""
    return df.orderBy(*(order or ["timestamp"])).limit(limit)


def load_sql(spark: SparkSession, sql: str, table: DataFrame, args: dict[str, object] | None = None) -> DataFrame:
    """SQL with {table} in it."""
    return spark.sql(sql, args=args, table=table) if args else spark.sql(sql, table=table)


def configured(spark: SparkSession, tables: dict[tuple[str, str], DataFrame], config: dict[str, object]) -> DataFrame:
    """Load as a configuration says (P09): layer (silver or gold), device, sql or start, end, sensors, columns, latest_n."""
    layer, device = config.get("layer", "silver"), config["device"]
    if layer not in ("silver", "gold"):
        raise ValueError("layer is silver or gold")
    df = tables[(layer, device)]
    if config.get("sql"):
        return load_sql(spark, str(config["sql"]), df)
    df = by_region(df, config.get("start"), config.get("end"), config.get("sensors"))
    if config.get("latest_n"):
        df = latest_n(df, int(config["latest_n"]), order=list(config.get("order", ["timestamp"])))
    return df.select(*config["columns"]) if config.get("columns") else df


def latest_of(df: DataFrame, device_id, device: str = "device_id", ts: str = "timestamp") -> DataFrame:
    """The latest row of a device."""
    return df.where(F.col(device) == device_id).orderBy(F.desc(ts)).limit(1)


def registered(registry: DataFrame, wanted: DataFrame, key: str = "device_id") -> DataFrame:
    """Which of the wanted devices are in the registry."""
    known = registry.select(F.col(key).alias("_known")).distinct()
    return wanted.join(known, F.col(key) == F.col("_known"), "left").select(key, F.col("_known").isNotNull().alias("registered"))


def smoke_window(df: DataFrame, lookback: int, safety: int = 0, order: list[str] | None = None) -> DataFrame:
    """The last lookback + safety rows (P19); fewer than lookback raise an error."""
    out = latest_n(df, lookback + safety, order=order)
    if out.count() < lookback:
        raise ValueError(f"fewer than {lookback} rows")
    return out


def _ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def pruned(df: DataFrame, start, end) -> DataFrame:
    """Filters on year, month and day partitions that follow from the bounds."""
    if not {"year", "month", "day"} <= set(df.columns):
        return df
    start, end = (None if isinstance(x, Column) else x for x in (start, end))
    day = F.col("year").cast("int") * 10000 + F.col("month").cast("int") * 100 + F.col("day").cast("int")
    number = lambda x: int(str(x)[:10].replace("-", ""))
    df = df.where(day >= number(start)) if start is not None else df
    return df.where(day <= number(end)) if end is not None else df
