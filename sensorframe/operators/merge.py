"""Dedupe, merge and movement between layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """One row of each key, the last by ``seq`` (M01; M06 with the row number as ``seq``)."""
    return _one(df, keys, F.max_by, seq)


def keep_first(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """One row of each key, the first by ``seq``."""
    return _one(df, keys, F.min_by, seq)


def _one(df: DataFrame, keys: list[str], chosen: Callable[[Column, Column], Column], seq: list[str]) -> DataFrame:
    """An aggregation with partial results where the rows are, not a sort of all of them."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return df.groupBy(*keys).agg(chosen(row, F.struct(*seq)).alias("_row")).select("_row.*")


def insert_if_absent(table: DataFrame, batch: DataFrame, keys: list[str], seq: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The table with the batch's new rows, and those rows (M02): existing rows win; a null key never matches, so its rows always go in."""
    has_key = batch.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    no_key = batch.where(" OR ".join(f"`{k}` IS NULL" for k in keys))
    fresh = (keep_last(has_key, keys, seq) if seq else has_key.dropDuplicates(keys)).join(table.select(*keys), keys, "left_anti")
    new = fresh.select(*batch.columns).unionByName(no_key)
    return evolve(table, new), new


def evolve(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; a column that one side lacks is null there."""
    return table.unionByName(batch, allowMissingColumns=True)


def upsert(table: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The table with the batch's rows in place of those of equal keys."""
    for k in keys:
        if k not in batch.columns or k not in table.columns:
            raise ValueError(f"no key column {k}")
    return evolve(table.join(batch.select(*keys).distinct(), keys, "left_anti").select(*table.columns), batch)


def publish_keys(columns: list[str]) -> list[str]:
    """Keys under which model output moves to gold."""
    return ["timestamp", "model_run_id"] if "model_run_id" in columns else ["timestamp"]


def duplicate_probe(df: DataFrame, device: str = "device_id", ts: str = "timestamp") -> DataFrame:
    """Devices with repeated timestamps: rows, and groups of duplicates."""
    groups = df.groupBy(device, ts).agg(F.count(F.lit(1)).alias("n"))
    return groups.groupBy(device).agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("duplicate_groups")).where("duplicate_groups > 0")


def sparse_merge(parts: list[DataFrame], keys: list[str], seq: str) -> DataFrame:
    """One row of each key with the last present value of every column (M08); null and empty text are absent. Later parts go after earlier ones."""
    rows = None
    for i, p in enumerate(parts):
        p = p.withColumn("_order", F.struct(F.lit(i), F.col(seq)))
        rows = p if rows is None else rows.unionByName(p, allowMissingColumns=True)
    types = dict(rows.dtypes)
    present = lambda c: F.col(c).isNotNull() & (F.col(c) != "") if types[c] == "string" else F.col(c).isNotNull()
    values = [c for c in rows.columns if c not in (*keys, seq, "_order")]
    return rows.groupBy(*keys).agg(*(F.max_by(F.when(present(c), F.col(c)), F.when(present(c), F.col("_order"))).alias(c) for c in values))


def append_stats(table: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows existing and fetched, repeated ones too, and keys inserted, updated and in total after the merge, which leaves a row a key (M09). Null keys are a key."""
    both = table.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(batch.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    n = both.groupBy(*keys).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    has_a, has_b = F.col("_a") > 0, F.col("_b") > 0
    return n.agg(total("_a", "existing"), total("_b", "fetched"), F.count_if(has_b & ~has_a).alias("inserted"), F.count_if(has_a & has_b).alias("updated"), F.count(F.lit(1)).alias("total"))


def rolling_cache(old: DataFrame, new: DataFrame, keys: list[str], seq: list[str], most: int, order: list[str]) -> DataFrame:
    """Both frames with the last row of each key, the newest ``most`` of them."""
    return keep_last(evolve(old, new), keys, seq).orderBy(*(F.desc(c) for c in order)).limit(most)


def move_layer(source: DataFrame, target: DataFrame | None, device: str, transforms: dict[str, Callable[[DataFrame], DataFrame]], keys: list[str], seq: list[str]) -> DataFrame:
    """A layer's rows, through the device's transform, into the next layer where they are new."""
    if device not in transforms:
        raise KeyError(f"no transform for {device}")
    moved = source.transform(transforms[device])
    return keep_last(moved, keys, seq) if target is None else insert_if_absent(target, moved, keys, seq)[0]


def freshness(source: DataFrame, layers: dict[str, DataFrame], ts: str = "timestamp") -> DataFrame:
    """One row for each layer: its last time, that of the layer before, whether it is behind, and why, to the second."""
    out, before = None, source.agg(F.date_trunc("SECOND", F.max(ts)).alias("before_last"))
    for name, df in layers.items():
        last = df.agg(F.date_trunc("SECOND", F.max(ts)).alias("last"))
        row = before.crossJoin(last).select(  # a row on either side
            F.lit(name).alias("layer"), F.col("last").cast("timestamp_ntz").alias("last"), F.col("before_last").cast("timestamp_ntz").alias("before_last"),
            F.when(F.col("before_last").isNull(), "source is empty").when(F.col("last").isNull(), "layer is empty").when(F.col("before_last") > F.col("last"), "source is newer").otherwise("up to date").alias("reason"),
        )
        row = row.withColumn("needs_update", F.col("reason").isin("layer is empty", "source is newer"))
        out = row if out is None else out.unionByName(row)
        before = last.withColumnRenamed("last", "before_last")
    return out


def new_rows(source: DataFrame, target: DataFrame, start, ts: str = "timestamp") -> DataFrame:
    """Source rows from a second after the target's last time, or from ``start`` where the target is empty."""
    bound = target.agg(F.coalesce(F.max(ts) + F.expr("INTERVAL 1 SECOND"), F.lit(str(start)).cast("timestamp_ntz")).alias("_from"))
    return source.crossJoin(F.broadcast(bound)).where(F.col(ts) >= F.col("_from")).drop("_from")  # one row


def overlap_rows(source: DataFrame, target: DataFrame, horizon, end, overlap: int, ts: str = "timestamp") -> DataFrame:
    """Source rows from ``overlap`` seconds before the target's last time, not before the horizon, to before the end."""
    at = lambda x: F.lit(str(x)).cast("timestamp_ntz")
    bound = target.agg(F.coalesce(F.greatest(F.max(ts) - F.make_dt_interval(secs=F.lit(overlap)), at(horizon)), at(horizon)).alias("_from"))
    return source.crossJoin(F.broadcast(bound)).where((F.col(ts) >= F.col("_from")) & (F.col(ts) < at(end))).drop("_from")  # one row


def lag_text(seconds: Column) -> Column:
    """Seconds in words."""
    part = lambda n, unit: F.concat(F.floor(seconds / n).cast("string"), F.lit(f" {unit}"))
    return F.when(seconds.isNull(), "no data").when(seconds < 60, part(1, "s")).when(seconds < 3600, part(60, "min")).when(seconds < 86400, part(3600, "h")).otherwise(part(86400, "d"))


def source_lag(df: DataFrame, now, device: str = "device_id", ts: str = "timestamp") -> DataFrame:
    """How far each device is behind."""
    behind = F.timestamp_diff("SECOND", F.max(ts), F.lit(str(now)).cast("timestamp_ntz"))
    return df.groupBy(device).agg(behind.alias("lag_seconds")).withColumn("lag", lag_text(F.col("lag_seconds")))
