"""Messages into rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.merge import keep_first

#: Keys of an envelope that may hold its records, in order.
LISTS = ("data", "readings", "history", "results", "items")


def device_type(topic: Column, prefixes: list[str]) -> Column:
    """The longest known prefix of a topic (S09); null where none fits."""
    return F.coalesce(*(F.when(topic.startswith(p), F.lit(p)) for p in sorted(prefixes, key=lambda p: (-len(p), p))))


def parse_messages(messages: DataFrame, allowed: dict[str, list[str]], topic: str = "topic", payload: str = "payload") -> DataFrame:
    """Adds device_type, fields (a map of texts) and reason.

    reason is null for good messages, else unknown type, unparseable payload or unknown key: one key that the type's list lacks
    rejects the whole message.
    """
    kind = device_type(F.col(topic), list(allowed))
    fields = F.from_json(payload, "map<string,string>")
    known = F.coalesce(*(F.when(kind == t, F.array(*(F.lit(k) for k in keys))) for t, keys in allowed.items()))
    unknown = F.size(F.array_except(F.map_keys("fields"), "_known")) > 0
    out = messages.withColumns({"device_type": kind, "fields": fields, "_known": known})
    reason = F.when(F.col("device_type").isNull(), "unknown type").when(F.col("fields").isNull(), "unparseable payload").when(unknown, "unknown key")
    return out.withColumn("reason", reason).drop("_known")


def split_dead_letters(parsed: DataFrame, ts: str = "timestamp", device: str = "topic", payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Good messages, and (time, device, payload, reason) of the others."""
    return parsed.where("reason IS NULL").drop("reason"), parsed.where("reason IS NOT NULL").select(ts, F.col(device).alias("device"), payload, "reason")


def unwrap(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each record of an envelope (S11): a list, the first list among data, readings, history, results, items of an object, or the object itself."""
    text = "array<string>"
    whole = F.when(F.ltrim(payload).startswith("["), F.from_json(payload, text))
    inner = [F.when(F.ltrim(F.get_json_object(payload, f"$.{k}")).startswith("["), F.from_json(F.get_json_object(payload, f"$.{k}"), text)) for k in LISTS]
    return messages.withColumn("record", F.explode(F.coalesce(whole, *inner, F.array(payload))))


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Structs as columns with dotted names (S12); arrays and maps stay."""
    while any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        columns = []
        for f in df.schema.fields:
            if isinstance(f.dataType, T.StructType):
                columns += [F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}{separator}{g.name}") for g in f.dataType.fields]
            else:
                columns.append(F.col(f"`{f.name}`"))
        df = df.select(*columns)
    return df


def due_buffers(staged: DataFrame, now: Column, most_rows: int = 500, most_seconds: int = 300, keys: list[str] | None = None, ts: str = "staged_at", force: bool = False) -> DataFrame:
    """Which buffers of small batches to flush (S13): enough rows, or the oldest old enough, or forced."""
    g = staged.groupBy(*(keys or ["table"])).agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("oldest"))
    return g.withColumn("flush", (F.col("rows") >= most_rows) | (F.timestamp_diff("SECOND", F.col("oldest"), now) >= most_seconds) | F.lit(force))


def flush_due(staged: DataFrame, now: Column, keys: list[str], seq: list[str], most_rows: int = 500, most_seconds: int = 300, by: str = "table", ts: str = "staged_at", force: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows to insert from the buffers that are due, the first of each key, and the staged rows that stay.

    Write the former with :func:`sensorframe.operators.merge.insert_if_absent`, then put the latter in place of the staged rows.
    """
    due = due_buffers(staged, now, most_rows, most_seconds, [by], ts, force).where("flush").select(F.col(by).alias("_due"))
    due = staged.join(due, F.col(by) == F.col("_due"), "left")  # a row a buffer
    return keep_first(due.where("_due IS NOT NULL").drop("_due"), [by, *keys], seq), due.where("_due IS NULL").drop("_due")


def backfill_plan(spark: SparkSession, devices: DataFrame, start: datetime, end: datetime, days: int = 5, lookback_seconds: Column | None = None) -> DataFrame:
    """Jobs of device x chunk (S19): half-open chunks clipped to the end; a source's first chunk may start earlier; sources take turns.

    ``devices`` has source, device_id. Returns source, device_id, chunk, chunk_start, chunk_end, turn.
    """
    at = lambda x: F.lit(str(x)).cast("timestamp_ntz")
    if end <= start:
        raise ValueError("the end is not after the start")
    step = timedelta(days=days)
    chunks = int(-(-(end - start) // step))
    plan = devices.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    begin = F.timestamp_add("SECOND", F.col("chunk") * int(step.total_seconds()), at(start))
    finish = F.least(at(end), F.timestamp_add("SECOND", (F.col("chunk") + 1) * int(step.total_seconds()), at(start)))
    early = begin if lookback_seconds is None else F.when(F.col("chunk") == 0, F.timestamp_add("SECOND", -lookback_seconds, begin)).otherwise(begin)
    turn = F.row_number().over(Window.partitionBy("source").orderBy("chunk", "device_id"))
    return plan.select("source", "device_id", "chunk", early.alias("chunk_start"), finish.alias("chunk_end")).withColumn("turn", turn)
