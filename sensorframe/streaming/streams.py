"""Structured Streaming forms (X01-X10). Buckets close by event time; each function takes a streaming or a batch frame alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.joins import as_of
from ..operators.merge import insert_if_absent, keep_first, sparse_merge
from ..operators.reports import live_gate
from ..operators.windows import cadence, latest_rows
from ..sources.ingest import split_dead_letters
from ..sources.versions import VersionedTable
from .ordered import carry_forward_stream, live_tail, room_buckets_in_order, staged_rows  # noqa: F401  forms with their own state


def event_time(payload_time: Column, received: Column, use_payload: bool = True) -> Column:
    """The time that a message counts at (X08): its own, else when it was received; or always the latter."""
    return F.coalesce(payload_time, received) if use_payload else received


def count_buckets(messages: DataFrame, seconds: int = 10, grace: int = 5, keys: list[str] | None = None, cameras: str | None = None, count: str = "occupancy_count", ts: str = "event_time", threshold: float = 1.0) -> DataFrame:
    """Tumbling statistics of counts (X01), per zone and with cameras merged where asked.

    A bucket closes ``grace`` seconds of event time after its end; messages for a closed bucket are dropped. ``ts`` is a TIMESTAMP.
    """
    c = F.col(count)
    texts = [F.array_join(F.array_sort(F.collect_set(cameras)), "|").alias(cameras)] if cameras else []
    stats = messages.withWatermark(ts, f"{grace} seconds").groupBy(F.window(ts, f"{seconds} seconds"), *(keys or [])).agg(
        F.count(c).alias("sample_count"), F.min(c).alias("min_count"), F.max(c).alias("max_count"), F.round(F.avg(c), 3).alias("mean_count"), F.median(c).alias("median_count"), F.max_by(c, ts).alias("last_count"), *texts
    )
    return stats.select(F.col("window.start").alias("bucket"), *[x for x in stats.columns if x != "window"], (F.col("median_count") >= threshold).cast("int").alias("occupied"))


def zone_messages(messages: DataFrame, zones: str = "zones") -> DataFrame:
    """One row for each zone of a map of zone to nullable count."""
    return messages.select("*", F.explode_outer(zones).alias("zone_id", "occupancy_count"))


def room_buckets(samples: DataFrame, numbers: list[str], seconds: int = 10, ts: str = "event_time") -> DataFrame:
    """Means of air-quality samples whose buckets close without grace (X03): a later bucket closes those before. Which rows are late depends on the batches."""
    stats = samples.withWatermark(ts, "0 seconds").groupBy(F.window(ts, f"{seconds} seconds")).agg(*(F.avg(c).alias(c) for c in numbers), F.count(F.lit(1)).alias("samples"))
    return stats.select(F.col("window.start").alias("bucket"), *numbers, "samples")


def once(messages: DataFrame, keys: list[str], within: str = "10 minutes", ts: str = "event_time") -> DataFrame:
    """The first of messages with equal keys within a time."""
    return messages.withWatermark(ts, within).dropDuplicatesWithinWatermark(keys)


def sessions(positive: DataFrame, gap: int = 11, keys: list[str] | None = None, grace: int = 5, ts: str = "event_time") -> DataFrame:
    """Occupancy sessions over positive rows (X09). A row exactly one gap later opens a new session, so the gap is a second more than the grid's step."""
    s = positive.withWatermark(ts, f"{grace} seconds").groupBy(F.session_window(ts, f"{gap} seconds"), *(keys or [])).agg(F.count(F.lit(1)).alias("rows"))
    return s.select(*(keys or []), F.col("session_window.start").alias("session_start"), F.timestamp_add("SECOND", F.lit(-gap), F.col("session_window.end")).alias("last_row"), "rows")


def append_new(read: Callable[[], DataFrame | None], write: Callable[[DataFrame], None], keys: list[str], seq: list[str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds only rows whose keys the table lacks, so a restart writes no bucket twice."""

    def run(batch: DataFrame, _: int) -> None:
        table = read()
        empty = batch.limit(0)
        write(insert_if_absent(empty if table is None else table, batch, keys, seq)[1])

    return run


def merge_sparse(read: Callable[[], DataFrame | None], replace: Callable[[DataFrame], None], keys: list[str], seq: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges partial rows column by column (X05); ``replace`` must write elsewhere before it swaps."""

    def run(batch: DataFrame, _: int) -> None:
        table = read()
        if table is None:
            return replace(sparse_merge([batch], keys, seq))
        replace(sparse_merge([table.withColumn(seq, F.lit(0).cast(batch.schema[seq].dataType)), batch], keys, seq))

    return run


def merge_days(table: VersionedTable, keys: list[str], seq: str, stream: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges partial rows column by column into the days that they are of (X05); files of other days stay, and a batch that is played again changes nothing.

    The table's part is the day of a row, which its keys decide. ``seq`` orders the rows of a batch and is not stored; all of them come after the table's.
    """

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        return sparse_merge([old.withColumn(seq, F.lit(0).cast(new.schema[seq].dataType)), new], keys, seq)

    return lambda batch, number: table.merge(batch, combine, stream, number) and None


def append_once(table: VersionedTable, keys: list[str], seq: list[str], stream: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds rows whose keys the table lacks (X07): a batch that was committed is left out by its number, and rows that another run or checkpoint has written by their keys.

    Only the parts that the batch has rows of are read.
    """

    def run(batch: DataFrame, number: int) -> None:
        if not table.done(stream, number):
            parts = [r[0] for r in batch.select(table.part).distinct().collect()]  # days of a batch
            table.append(insert_if_absent(table.read(parts), batch, keys, seq)[1], stream, number)

    return run


def two_sinks(good: VersionedTable, bad: VersionedTable, parse: Callable[[DataFrame], DataFrame], stream: str, ts: str = "timestamp", device: str = "topic", payload: str = "payload") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes good messages to one table and dead letters to another (S10). Each knows the batches it has, so one that is played again after a crash between the two completes what is missing.

    ``parse`` adds reason (:func:`sensorframe.sources.ingest.parse_messages`). The batch is kept while both are written.
    """

    def run(batch: DataFrame, number: int) -> None:
        if good.done(stream, number) and bad.done(stream, number):
            return
        parsed = parse(batch).persist()
        try:
            rows, letters = split_dead_letters(parsed, ts, device, payload)
            good.append(rows, stream, number)
            bad.append(letters, stream, number)
        finally:
            parsed.unpersist()

    return run


def flush_to(table: VersionedTable, keys: list[str], seq: list[str], stream: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for the rows that :func:`staged_rows` hands over (S13): the first of each key goes in where the table lacks it. Ticks without rows write nothing."""

    def run(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty() and not table.done(stream, number):
            parts = [r[0] for r in batch.select(table.part).distinct().collect()]  # days or tables of a batch
            fresh = keep_first(batch, keys, seq)
            table.append(insert_if_absent(table.read(parts), fresh, keys, seq)[1], stream, number)

    return run


def live_scores(batch: DataFrame, score: Callable[[DataFrame], DataFrame], labels: DataFrame, required: dict[str, float], now, keys: list[str], ts: str = "timestamp") -> DataFrame:
    """One event for each key from the newest rows (X10): gate, cadence, probability and the label as of then."""
    gate = live_gate(batch, required).agg(F.every("passes").alias("gate_ok"))
    newest = score(latest_rows(batch, keys[0], [ts]))
    joined = newest.join(cadence(batch, keys, now, ts=ts).select(*keys, "in_order"), keys).crossJoin(F.broadcast(gate))  # one row
    return as_of(joined, labels, keys, ts, "label_time", "label")


def to_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run a stream over what is there now into an in-memory table; for tests and small results."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
