"""Row windows and runs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.scalars import no_nan


#: Rows of a series that one task works on.
BLOCK_ROWS = 100_000
#: What blocks add to a frame.
OWN = ("_rn", "_block", "_halo")


def joined_within(df: DataFrame, facts: DataFrame, on: list[str]) -> DataFrame:
    """Left join on columns that may be null; the facts' other columns are added."""
    named = facts.select(*(F.col(c).alias(f"_on{i}") for i, c in enumerate(on)), *(c for c in facts.columns if c not in on))
    same = F.lit(True)
    for i, c in enumerate(on):
        same = same & F.col(c).eqNullSafe(F.col(f"_on{i}"))
    return df.join(named, same, "left").drop(*(f"_on{i}" for i in range(len(on))))


def numbered(df: DataFrame, keys: list[str], order: list[str], piece: Column) -> DataFrame:
    """``_rn``, the row number of each key from 1: rows are numbered within pieces by ``piece``, which has to rise with the order, and offset by the sizes of the pieces before."""
    cut = df.withColumn("_piece", piece)
    sizes = cut.groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # a row a piece
    offsets = sizes.select(*keys, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = cut.withColumn("_own", F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(*order)))
    return joined_within(own, offsets, [*keys, "_piece"]).withColumn("_rn", F.col("_own") + F.col("_before")).drop("_own", "_before", "_piece")


def coarse(df: DataFrame, column: str) -> Column:
    """Pieces that rise with a column: days of times, ranges of numbers; other types are one piece."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.floor(F.col(column) / BLOCK_ROWS)
    return F.col(column).cast("date") if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) else F.lit(0)


def in_blocks(df: DataFrame, keys: list[str], order: list[str], halo: int) -> DataFrame:
    """Adds _rn, _block and _halo: a series is cut into blocks of :data:`BLOCK_ROWS` rows, and each block also holds the ``halo`` rows before it, marked.

    So a series of any length is many tasks; windows that look back ``halo`` rows at most see the same in their block.
    """
    rows = max(BLOCK_ROWS, halo)
    at = numbered(df, keys, order, coarse(df, order[0]))
    block = F.floor((F.col("_rn") - 1) / rows)
    ends = (F.col("_rn") - 1) % rows >= rows - halo
    places = F.array_compact(F.array(F.struct(block.alias("b"), F.lit(False).alias("h")), F.when(ends, F.struct((block + 1).alias("b"), F.lit(True).alias("h")))))
    return at.withColumn("_at", F.explode(places)).withColumns({"_block": F.col("_at.b"), "_halo": F.col("_at.h")}).drop("_at")


def _line(keys: list[str]):
    return Window.partitionBy(*keys, "_block").orderBy("_rn")


def present(df: DataFrame, feature: str) -> Column:
    """1 where a feature is there: by its missing flag if it has one, else by its value."""
    flag = f"{feature}_missing"
    there = (F.coalesce(F.col(flag), F.lit(0)) == 0) if flag in df.columns else no_nan(F.col(feature).cast("double")).isNotNull()
    return there.cast("double")


def window_quality(df: DataFrame, features: list[str], lookback: int, required: float, keys: list[str], ts: str = "timestamp") -> DataFrame:
    """Mean presence over the last ``lookback`` rows of each core feature (W01): ``quality_ok`` needs a full window and all of them at ``required``."""
    last = _line(keys).rowsBetween(-(lookback - 1), Window.currentRow)
    shares = [F.avg(present(df, c)).over(last) for c in features]
    least = F.least(*shares) if len(shares) > 1 else shares[0]
    full = F.col("_rn") >= lookback
    out = in_blocks(df, keys, [ts], lookback - 1).withColumns({"window_full": full, "window_present": F.when(full, least)}).where("NOT _halo")
    return out.withColumn("quality_ok", full & (F.col("window_present") >= required)).drop(*OWN)


def window_labels(df: DataFrame, features: list[str], lookback: int, required: float | None, keys: list[str], label: str = "occupied", ts: str = "timestamp") -> DataFrame:
    """Window ends that have a label and, where asked, the quality."""
    out = window_quality(df, features, lookback, required or 0.0, keys, ts)
    good = F.col("quality_ok") if required is not None else F.col("window_full")
    return out.where(good & F.col(label).isNotNull())


def make_windows(df: DataFrame, features: list[str], lookback: int, keys: list[str], label: str = "occupied", ts: str = "timestamp") -> DataFrame:
    """One row for each labelled end with its lookback x features values as floats (W03); windows stay within their keys."""
    rows = F.collect_list(F.array(*(F.col(c).cast("float") for c in features))).over(_line(keys).rowsBetween(-(lookback - 1), Window.currentRow))
    return in_blocks(df, keys, [ts], lookback - 1).withColumn("window", rows).where((F.size("window") == lookback) & F.col(label).isNotNull() & ~F.col("_halo")).select(*keys, ts, label, "window")


def positive_runs(df: DataFrame, keys: list[str], seconds: int, label: str = "occupied", ts: str = "timestamp") -> DataFrame:
    """Adds ``starts_event`` and ``event`` (a number within the keys) to positive rows (W04): an event starts after a row that is not positive or a gap of more than ``seconds``."""
    line = _line(keys)
    positive = F.coalesce(F.col(label) == 1, F.lit(False))
    gap = F.timestamp_diff("MICROSECOND", F.lag(ts).over(line), F.col(ts)) / 1e6
    starts = positive & (~F.coalesce(F.lag(positive).over(line), F.lit(False)) | (gap > seconds))
    out = in_blocks(df, keys, [ts], 1).withColumn("starts_event", starts.cast("int")).where("NOT _halo")
    sums = out.groupBy(*keys, "_block").agg(F.sum("starts_event").alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    offsets = sums.select(*keys, "_block", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_events"))
    own = F.sum("starts_event").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return joined_within(out.withColumn("_e", own), offsets, [*keys, "_block"]).withColumn("event", F.when(positive, F.col("_e") + F.col("_events"))).drop("_e", "_events", *OWN)


def evidence(df: DataFrame, keys: list[str], seconds: int, label: str = "occupied", ts: str = "timestamp") -> DataFrame:
    """Positive and negative slots and positive events."""
    return positive_runs(df, keys, seconds, label, ts).agg(F.count_if(F.col(label) == 1).alias("positive_buckets"), F.count_if(F.col(label) == 0).alias("negative_buckets"), F.coalesce(F.sum("starts_event"), F.lit(0)).alias("positive_events"))


def cadence(df: DataFrame, keys: list[str], now, step: int = 10, most_gap: int = 300, most_age: int = 900, ts: str = "timestamp") -> DataFrame:
    """Largest and least gap and age of each key in seconds, and whether they are in order."""
    seconds = lambda a, b: F.timestamp_diff("MICROSECOND", a, b) / 1e6
    gaps = in_blocks(df, keys, [ts], 1).withColumn("_gap", seconds(F.lag(ts).over(_line(keys)), F.col(ts))).where("NOT _halo")
    out = gaps.groupBy(*keys).agg(F.max("_gap").alias("max_gap"), F.min("_gap").alias("min_gap"), seconds(F.max(ts), F.lit(str(now)).cast("timestamp_ntz")).alias("age"))
    ok = (F.coalesce("max_gap", F.lit(0.0)) <= most_gap) & (F.coalesce(F.col("min_gap"), F.lit(float(step))) >= step / 2) & (F.col("age") <= most_age)
    return out.withColumn("in_order", ok)


def windows_by_lookback(df: DataFrame, features: list[str], lookbacks: list[int], required: float | None, keys: list[str], label: str = "occupied", ts: str = "timestamp", by: list[str] | None = None) -> DataFrame:
    """Windows and positive windows for each look-back (W06), from one pass over the sorted rows; for each value of ``by``, which are among the keys, where given."""
    line = _line(keys)
    out = in_blocks(df, keys, [ts], max(lookbacks) - 1).withColumn("_n", F.col("_rn"))
    cells = []
    for n in lookbacks:
        shares = [F.avg(present(df, c)).over(line.rowsBetween(-(n - 1), Window.currentRow)) for c in features]
        good = F.col("_n") >= n
        if required is not None:
            good = good & ((F.least(*shares) if len(shares) > 1 else shares[0]) >= required)
        out = out.withColumn(f"_ok{n}", good & F.col(label).isNotNull())
        cells.append(F.struct(F.lit(n).alias("lookback"), F.count_if(F.col(f"_ok{n}")).alias("windows"), F.count_if(F.col(f"_ok{n}") & (F.col(label) == 1)).alias("positive_windows")))
    return out.where("NOT _halo").groupBy(*(by or [])).agg(F.array(*cells).alias("_c")).select(*(by or []), F.inline("_c"))


def carry_forward(df: DataFrame, columns: list[str], keys: list[str], order: list[str], own_row: bool = True) -> DataFrame:
    """Last known value of each column for partial updates (W07), within blocks of a series and from the blocks before; without ``own_row`` that of the rows before."""
    own = in_blocks(df, keys, order, 0)
    known = own.groupBy(*keys, "_block").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_rn"))).alias(f"_k{i}") for i, c in enumerate(columns)))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    carried = known.select(*keys, "_block", *(F.last(f"_k{i}", ignorenulls=True).over(before).alias(f"_c{i}") for i in range(len(columns))))
    line = _line(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow if own_row else -1)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(line), F.col(f"_c{i}")) for i, c in enumerate(columns)}
    return joined_within(own, carried, [*keys, "_block"]).select(*(filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns))


#: The weight that the first row of a run of finite values has against the last is e to the minus this, at least, so that sums of a run stay within doubles.
RUN_DECAY = 230.0


def ema(df: DataFrame, value: str, keys: list[str], order: list[str], span: int = 5) -> DataFrame:
    """Exponential average with factor 2 / (span + 1) over the finite values of each key (W08); it starts at the first and is carried over missing ones, however many.

    A row maps the average s to d s + (1 - d) x; such maps compose to maps of the same form, so averages are prefixes of them. Finite values are numbered, and runs of as many as keep d^n above
    e^-230 are summed up with weights that grow by 1 / d, by one window sum, in the pieces of :func:`coarse`; what a run begins with comes from the two runs before it, older ones weighing less than e^-460. A row
    holds two numbers, whatever the span, and a series is many tasks.
    """
    alpha = 2.0 / (span + 1)
    d = 1 - alpha
    run = max(1, int(RUN_DECAY / -math.log(d))) if d > 0 else 1
    v = no_nan(F.col(value))
    cut = df.withColumn("_v", F.when(~v.isin(float("inf"), float("-inf")), v)).withColumn("_piece", coarse(df, order[0]))
    before = lambda *by: Window.partitionBy(*keys, *by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # noqa: E731  a row a piece
    sizes = cut.groupBy(*keys, "_piece").agg(F.count("_v").alias("_n"))
    offsets = sizes.select(*keys, "_piece", F.coalesce(F.sum("_n").over(before()), F.lit(0)).alias("_before"))
    line = lambda *by: Window.partitionBy(*keys, "_piece", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = joined_within(cut.withColumn("_m", F.count("_v").over(line())), offsets, [*keys, "_piece"])
    at = F.col("_m") + F.col("_before")  # finite values so far: a missing one has the number of the last before it
    own = own.withColumns({"_run": F.floor((at - 1) / run), "_place": F.when(at > 0, F.pmod(at - 1, F.lit(run)) + 1)})
    weighed = F.col("_v") * alpha * F.pow(F.lit(1 / d), F.col("_place")) if d > 0 else F.col("_v")
    own = own.withColumn("_w", weighed).withColumn("_sum", F.sum("_w").over(line("_run")))
    # a row a piece and run
    parts = own.groupBy(*keys, "_run", "_piece").agg(F.sum("_w").alias("_s"), F.min_by("_v", F.when(F.col("_v").isNotNull(), F.struct(*order))).alias("_x"))
    inner = parts.select(*keys, "_run", "_piece", F.coalesce(F.sum("_s").over(before("_run")), F.lit(0.0)).alias("_head"))
    full = F.pow(F.lit(d), F.lit(float(run))) if d > 0 else F.lit(0.0)
    runs = parts.where("_run >= 0").groupBy(*keys, "_run").agg(F.sum("_s").alias("_s"), F.min_by("_x", F.when(F.col("_x").isNotNull(), F.col("_piece"))).alias("_x"))
    ordered = Window.partitionBy(*keys).orderBy("_run")  # a row a run
    first = F.first("_x").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    old = lambda k: F.coalesce(F.lag("_s", k).over(ordered), F.lit(0.0)) * F.pow(full, F.lit(float(k)))
    begins = runs.select(*keys, "_run", (old(1) + old(2) + F.when(F.col("_run") <= 2, first * F.pow(full, F.col("_run"))).otherwise(0.0)).alias("_carry"))
    out = joined_within(joined_within(own, inner, [*keys, "_run", "_piece"]), begins, [*keys, "_run"])
    if d <= 0:  # each finite value is a run of its own: the average is the last of them
        known = parts.where("_x IS NOT NULL").select(*keys, "_run", F.col("_x").alias("_last"))
        return joined_within(own, known, [*keys, "_run"]).select(*(F.col(f"`{c}`") for c in df.columns), F.col("_last").alias("ema"))
    average = F.pow(F.lit(d), F.col("_place")) * (F.coalesce("_sum", F.lit(0.0)) + F.col("_head") + F.col("_carry"))
    return out.select(*(F.col(f"`{c}`") for c in df.columns), F.when(F.col("_place").isNotNull(), average).alias("ema"))


def latest_rows(df: DataFrame, device: str = "device_id", order: list[str] | None = None) -> DataFrame:
    """The latest row of each device (W09), found without a sort."""
    place = F.struct(*(order or ["timestamp"]))
    return df.groupBy(device).agg(F.max_by(F.struct(*df.columns), place).alias("_r")).select("_r.*")


def strictly_rising(df: DataFrame, keys: list[str], ts: str = "timestamp") -> DataFrame:
    """Whether each key's times rise and are unique in arrival order ``seq``."""
    step = in_blocks(df, keys, ["seq"], 1).withColumn("_up", F.coalesce(F.lag(ts).over(_line(keys)) < F.col(ts), F.lit(True))).where("NOT _halo")
    return step.groupBy(*keys).agg(F.every("_up").alias("rising"), (F.countDistinct(ts) == F.count(F.lit(1))).alias("unique"))


def replay(df: DataFrame, ticks: DataFrame, lookback: int, slack: int, start, order: list[str], ts: str = "timestamp") -> DataFrame:
    """Rows that the n-th tick returns (S20): the last ``lookback + slack`` up to the cursor.

    The cursor begins at the first row from ``start`` on (the first of all where it is None) or the ``lookback``-th row, whichever is later, moves a row a tick and stays at the last row. A start after all rows
    and a table of fewer rows than ``lookback`` are errors. Ticks are spread over the row numbers that they want, so the join is on equal numbers.
    """
    take = lookback + slack
    ranked = numbered(df, [], order, F.col(ts).cast("date")).withColumnRenamed("_rn", "rn")
    from_ = F.lit(True) if start is None else F.col(ts) >= F.lit(str(start)).cast("timestamp_ntz")
    first, rows = ranked.agg(F.min(F.when(from_, F.col("rn"))), F.count(F.lit(1))).first()
    if first is None:
        raise ValueError("the start is after all rows")
    if rows < lookback:
        raise ValueError(f"{rows} rows, {lookback} are needed")
    end = F.least(F.lit(rows), F.lit(max(first, lookback)) + F.col("tick"))
    wanted = ticks.select("tick", F.explode(F.sequence(F.greatest(F.lit(1), end - (take - 1)), end)).alias("rn"))
    return ranked.join(wanted, "rn")
