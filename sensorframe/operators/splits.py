"""Temporal splits without leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .windows import windows_by_lookback


def _dates(df: DataFrame, ts: str) -> DataFrame:
    """Distinct dates with their rank and number; a row a day."""
    days = df.select(F.col(ts).cast("date").alias("_date")).distinct()
    return days.withColumn("_rank", F.row_number().over(Window.orderBy("_date"))).withColumn("_days", F.count(F.lit(1)).over(Window.partitionBy()))


def blind_last_days(df: DataFrame, days: int, ts: str = "timestamp") -> DataFrame:
    """``split``: test for the last ``days`` dates, pre_test before (T01); too few dates raise an error."""
    dates = _dates(df, ts)
    if dates.count() <= days:
        raise ValueError(f"more than {days} dates are needed")
    mark = dates.select("_date", F.when(F.col("_rank") > F.col("_days") - days, "test").otherwise("pre_test").alias("split"))
    return df.withColumn("_date", F.col(ts).cast("date")).join(mark, "_date").drop("_date")


def blind_date(df: DataFrame, day: str, ts: str = "timestamp") -> DataFrame:
    """``split``: pre_test before a date, test on it, excluded after (T02); no rows before it or on it is an error."""
    date, at = F.col(ts).cast("date"), F.lit(day).cast("date")
    for part, rows in (("pre_test", df.where(date < at)), ("test", df.where(date == at))):
        if rows.isEmpty():
            raise ValueError(f"no rows in {part}")
    return df.withColumn("split", F.when(date < at, "pre_test").when(date == at, "test").otherwise("excluded"))


def rolling_folds(coverage: DataFrame, folds: int, days: int) -> DataFrame:
    """(fold, date, role) over eligible dates.

    ``coverage`` has date and eligible. The folds used are the least of ``folds`` and (dates - 1) // days;
    each validates on its ``days`` dates and trains on all before.
    """
    ranked = coverage.where("eligible").withColumn("_rank", F.row_number().over(Window.orderBy("date")) - 1).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy()))  # a row a day
    used = F.least(F.lit(folds), F.floor((F.col("_n") - 1) / days).cast("int"))
    spread = ranked.where(used >= 1).withColumn("fold", F.explode(F.sequence(F.lit(1), used)))
    start = F.col("_n") - used * days + (F.col("fold") - 1) * days
    role = F.when(F.col("_rank") < start, "train").when(F.col("_rank") < start + days, "validation")
    return spread.withColumn("role", role).where("role IS NOT NULL").select("fold", "date", "role")


def _ranked(df: DataFrame, ts: str, grouped: bool, order: list[str]) -> DataFrame:
    """Adds _r (from 1) and _n: over distinct times where ``grouped``, else over rows; counted within days and offset."""
    day = F.col(ts).cast("date")
    base = df.withColumn("_day", day)
    size = F.countDistinct(ts) if grouped else F.count(F.lit(1))
    sizes = base.groupBy("_day").agg(size.alias("_size"))
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)  # a row a day
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).withColumn("_n", F.sum("_size").over(Window.partitionBy())).drop("_size")
    line = Window.partitionBy("_day").orderBy(ts) if grouped else Window.partitionBy("_day").orderBy(*order)
    own = F.dense_rank().over(line) if grouped else F.row_number().over(line)
    return base.withColumn("_own", own).join(offsets, "_day").withColumn("_r", F.col("_own") + F.col("_before")).drop("_own", "_before", "_day")


def chronological_fold(df: DataFrame, share: float = 0.2, grouped: bool = False, ts: str = "timestamp", order: list[str] | None = None) -> DataFrame:
    """``role``: validation for the last share of rows, or of times where ``grouped``, rounded up, at least 1 and at most all but one (T04); fewer than two are an error."""
    if (df.select(ts).distinct() if grouped else df.select(ts)).limit(2).count() < 2:
        raise ValueError("at least 2 rows are needed")
    n = F.col("_n")
    last = F.least(F.greatest(F.lit(1), F.ceil(n * share)), n - 1)
    return _ranked(df, ts, grouped, order or [ts]).withColumn("role", F.when(F.col("_r") > n - last, "validation").otherwise("train")).drop("_r", "_n")


def split_70_15_15(df: DataFrame, grouped: bool = False, ts: str = "timestamp", order: list[str] | None = None) -> DataFrame:
    """``split`` by time order: train to floor(0.70 n), validation to floor(0.85 n), test (T05); rows of a time stay together where ``grouped``."""
    n, r = F.col("_n"), F.col("_r")
    return _ranked(df, ts, grouped, order or [ts]).withColumn("split", F.when(r <= F.floor(n * 0.70), "train").when(r <= F.floor(n * 0.85), "validation").otherwise("test")).drop("_r", "_n")


def choose_mode(pre_test_dates: int, strict_viable: bool) -> str:
    """Rolling folds from two dates on, one chronological fold on one date, bootstrap where strict rules leave no look-back."""
    if pre_test_dates < 1:
        raise ValueError("no dates before the test")
    if not strict_viable:
        return "bootstrap"
    return "rolling" if pre_test_dates >= 2 else "emergency"


def lookback_viability(parts: dict[tuple[int, str], DataFrame], features: list[str], lookbacks: list[int], required: float | None, keys: list[str], label: str = "occupied", ts: str = "timestamp") -> DataFrame:
    """Whether each look-back leaves windows of both classes in every part (fold, role), and why not (T07). All parts are one pass; an empty one has no windows."""
    rows = None
    for (fold, role), df in parts.items():
        own = df.select("*", F.lit(fold).alias("fold"), F.lit(role).alias("role"))
        rows = own if rows is None else rows.unionByName(own)
    own = ["fold", "role"]
    found = windows_by_lookback(rows, features, lookbacks, required, [*own, *keys], label, ts, own)
    asked = rows.sparkSession.createDataFrame([(f, r, n) for f, r in parts for n in lookbacks], "fold int, role string, lookback int")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("windows", "positive_windows")]
    out = asked.join(found, [*own, "lookback"], "left").select(*own, "lookback", *zero)
    both = (F.col("positive_windows") > 0) & (F.col("positive_windows") < F.col("windows"))
    reason = F.when(F.col("windows") == 0, "no windows").when(F.col("positive_windows") == 0, "no positive windows").when(~both, "no negative windows")
    return out.withColumn("viable", both).withColumn("reason", reason)


def split_report(df: DataFrame, by: list[str], ts: str = "timestamp") -> DataFrame:
    """Rows, bounds and dates of each part."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"), F.countDistinct(F.col(ts).cast("date")).alias("dates"))
