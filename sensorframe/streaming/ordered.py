"""State of a key whose rows are taken in order (X03, X06, X10), and of buffers that wait to be flushed.

Spark hands the rows of a key over in chunks that keep no order. They are sorted here: within a micro-batch, or, where rows may wait,
through a buffer in state that is taken slot by slot as the watermark passes, so that the result does not depend on batches or chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def packed(pdf: pd.DataFrame) -> bytes:
    """Rows as one value of a state."""
    batch = pa.RecordBatch.from_pandas(pdf, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(rows: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.py_buffer(bytes(rows))).read_pandas()


def seconds_of(times: pd.Series) -> np.ndarray:
    """Whole seconds since 1970."""
    return times.astype("datetime64[us]").astype("int64").to_numpy() // 1_000_000


class InOrder(StatefulProcessor):
    """Gives the rows of a key to :meth:`take` in ``order``.

    Without ``clock`` the rows of a micro-batch are sorted together; so many as a batch has of one key are in memory. With it they wait in a map in state, in slots of
    ``step`` seconds of that column, and an event-time timer takes a slot when the watermark has passed its end; only a slot is in memory.
    """

    def __init__(self, names: list[str], order: list[str], clock: str | None = None, step: int = 10):
        self.names, self.order, self.clock, self.step = names, order, clock, step

    def begin(self, handle: StatefulProcessorHandle) -> None:
        """Make the states of the operator."""

    def load(self) -> None:
        """Read the states, before the first rows of a call."""

    def take(self, key: tuple, rows: pd.DataFrame, now: int | None) -> Iterator[pd.DataFrame]:
        """Rows in order; ``now`` is the end of their slot in seconds."""
        raise NotImplementedError

    def store(self) -> None:
        """Write the states, after the last rows of a call."""

    def passed(self, key: tuple, now: int) -> Iterator[pd.DataFrame]:
        """The watermark has passed ``now``, the end of a slot, and all rows before it have been taken."""
        return iter(())

    def wants(self) -> int | None:
        """When :meth:`passed` is to be called if no rows come, in seconds."""
        return None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.clock:
            self.waiting = handle.getMapState("waiting", "slot long, piece long", "held binary")
            self.next = handle.getValueState("next", "piece long, timer long")
        self.begin(handle)

    def _plan(self, piece: int, timer: int, due: list[int]) -> None:
        """Keep one timer, the first of those that are due."""
        first = min(due, default=0)
        if first != timer:
            if timer:
                self.handle.deleteTimer(timer * 1000)
            if first:
                self.handle.registerTimer(first * 1000)
        self.next.update((piece, first))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # a timer's call may bring a frame without rows or columns; names that begin with an underscore do not arrive as they are
        rows = (pdf.set_axis(self.names, axis=1) for pdf in rows if len(pdf))
        if not self.clock:
            if all_rows := list(rows):
                self.load()
                yield from self.take(key, pd.concat(all_rows, ignore_index=True).sort_values(self.order, kind="stable", ignore_index=True), None)
                self.store()
            return
        piece, timer = self.next.get() if self.next.exists() else (0, 0)
        due = [timer] if timer else []
        for pdf in rows:
            for slot, part in pdf.groupby(seconds_of(pdf[self.clock]) // self.step):
                self.waiting.updateValue((int(slot), piece), (packed(part),))
                due.append((int(slot) + 1) * self.step)
                piece += 1
        self._plan(piece, timer, due)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if not self.clock:
            return
        now = timerValues.getCurrentWatermarkInMs() // 1000
        piece, _ = self.next.get()
        held = sorted(tuple(k) for k in self.waiting.keys())
        ready = [k for k in held if (k[0] + 1) * self.step <= now]
        self.load()
        for slot in sorted({k[0] for k in ready}):
            own = [k for k in ready if k[0] == slot]
            pdf = pd.concat([unpacked(self.waiting.getValue(k)[0]) for k in own], ignore_index=True)
            yield from self.take(key, pdf.sort_values(self.order, kind="stable", ignore_index=True), (slot + 1) * self.step)
            for k in own:
                self.waiting.removeKey(k)
        yield from self.passed(key, now // self.step * self.step)  # later slots may still wait
        wanted = self.wants()
        self.store()
        later = [] if wanted is None else [max(-(-wanted // self.step), now // self.step + 1) * self.step]
        self._plan(piece, 0, [(k[0] + 1) * self.step for k in held[len(ready) :]] + later)

    def close(self) -> None:
        pass


class RoomBuckets(InOrder):
    """Open buckets and the last closed one of a room, with the number of late payloads."""

    def __init__(self, names: list[str], numbers: list[str], seconds: int, order: list[str], clock: str | None = None, idle: int | None = None, step: int | None = None):
        super().__init__(names, order, clock, step or seconds)
        self.numbers, self.seconds, self.idle = numbers, seconds, idle

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", "bucket long", "n long, " + ", ".join(f"`{c}` double, `n_{c}` long" for c in self.numbers))
        self.state = handle.getValueState("state", "closed long, late long, told long")

    def load(self) -> None:
        self.closed, self.late, self.told = self.state.get() if self.state.exists() else (None, 0, 0)
        self.held = {b[0]: list(v) for b, v in self.open.iterator()}
        self.before = {b: list(v) for b, v in self.held.items()}
        self.out: list[tuple[int | None, list | None, int]] = []

    def store(self) -> None:
        for b in self.before.keys() - self.held.keys():
            self.open.removeKey((b,))
        for b, v in self.held.items():
            if v != self.before.get(b):
                self.open.updateValue((b,), tuple(v))
        self.state.update((self.closed, self.late, self.told))

    def _close(self, before: int) -> None:
        """The open buckets before one are closed."""
        for b in sorted(x for x in self.held if x < before):
            self.out.append((b, self.held.pop(b), self.late))
            self.closed, self.told = b, self.late

    def _told(self, key: tuple) -> Iterator[pd.DataFrame]:
        if self.late > self.told:  # late payloads come out though no bucket closes
            self.out.append((None, None, self.late))
            self.told = self.late
        none = [0] + [0.0, 0] * len(self.numbers)
        found, self.out = [(b, v or none, n) for b, v, n in self.out], []
        columns = {"room": [key[0]] * len(found), "bucket": pd.to_datetime([b for b, _, _ in found], unit="s", utc=True)}
        columns |= {c: [v[1 + 2 * i] / v[2 + 2 * i] if v[2 + 2 * i] else None for _, v, _ in found] for i, c in enumerate(self.numbers)}
        yield pd.DataFrame(columns | {"samples": [v[0] for _, v, _ in found], "late": [n for _, _, n in found]})

    def take(self, key: tuple, rows: pd.DataFrame, now: int | None) -> Iterator[pd.DataFrame]:
        if now is not None and self.idle is not None:
            self._close(now - self.step - self.idle - self.seconds + 1)  # what the clock had closed before this slot began
        slots = (seconds_of(rows["event_time"]) // self.seconds * self.seconds).tolist()
        for slot, *values in zip(slots, *(rows[c].tolist() for c in self.numbers), strict=True):
            self._close(slot)  # a later bucket closes those before
            if self.closed is not None and slot <= self.closed:
                self.late += 1
                continue
            sums = self.held.setdefault(slot, [0] + [0.0, 0] * len(self.numbers))
            sums[0] += 1
            for i, x in enumerate(values):
                if x == x and x is not None:
                    sums[1 + 2 * i] += x
                    sums[2 + 2 * i] += 1
        yield from self._told(key)

    def passed(self, key: tuple, now: int) -> Iterator[pd.DataFrame]:
        if self.idle is not None:
            self._close(now - self.idle - self.seconds + 1)
            yield from self._told(key)

    def wants(self) -> int | None:
        first = min(self.held, default=None) if self.idle is not None else None
        return None if first is None else first + self.seconds + self.idle


def room_buckets_in_order(samples: DataFrame, numbers: list[str], seconds: int = 10, room: str = "room", clock: str | None = None, wait: str = "0 seconds", idle: int | None = None, step: int | None = None) -> DataFrame:
    """Means of air-quality samples in the order in which they arrive (X03): a later bucket closes those before, and a payload for a closed bucket is late.

    ``samples`` has room, event_time, seq and the numbers. Without ``clock`` rows are taken in the order of ``seq`` within each micro-batch. ``clock`` names the time at which a sample arrived: rows are then taken by it and
    ``seq`` once the watermark, ``wait`` behind the latest arrival, has passed, whatever the batches; Spark leaves out what arrives later than that, and the last slot waits for the next rows. With ``idle`` a bucket also closes so
    many seconds after its end, by that clock, though no later one comes; that is seen to when a slot of ``step`` seconds of arrivals (as long as a bucket unless told otherwise) begins, and when the watermark moves on.

    ``late`` is how many payloads of the room were late so far. A row without a bucket and with 0 samples brings the number where no bucket has closed since. It needs the RocksDB state store; each room is a key.
    """
    if idle is not None and not clock:
        raise ValueError("buckets close by a clock only where there is one")
    kind = samples.schema[room].dataType.simpleString()
    schema = f"room {kind}, bucket timestamp, " + ", ".join(f"`{c}` double" for c in numbers) + ", samples long, late long"
    rows = samples.select(F.col(room).alias("room"), "event_time", "seq", *([F.col(clock).alias("_arrived")] if clock else []), *(F.col(c).cast("double").alias(c) for c in numbers))
    if clock:
        rows = rows.withWatermark("_arrived", wait)
    keeper = RoomBuckets(rows.columns, numbers, seconds, ["_arrived", "seq"] if clock else ["seq"], "_arrived" if clock else None, idle, step)
    return rows.groupBy("room").transformWithStateInPandas(keeper, outputStructType=schema, outputMode="Append", timeMode="EventTime" if clock else "None")


class CarryForward(InOrder):
    """Last known text of each field of a device."""

    def __init__(self, names: list[str], columns: list[str], order: list[str], clock: str | None = None, step: int = 10):
        super().__init__(names, order, clock, step)
        self.columns = columns

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("known", ", ".join(f"`{c}` string" for c in self.columns))

    def load(self) -> None:
        self.known = list(self.state.get()) if self.state.exists() else [None] * len(self.columns)

    def take(self, key: tuple, rows: pd.DataFrame, now: int | None) -> Iterator[pd.DataFrame]:
        for i, c in enumerate(self.columns):
            filled = rows[c].astype(object).where(rows[c].notna(), None).ffill()
            rows[c] = filled.where(filled.notna(), self.known[i])
            self.known[i] = filled.iloc[-1] if len(filled) and pd.notna(filled.iloc[-1]) else self.known[i]
        yield rows

    def store(self) -> None:
        self.state.update(tuple(self.known))


def carry_forward_stream(updates: DataFrame, columns: list[str], key: str = "device_id", ts: str = "event_time", wait: str | None = None, step: int = 10) -> DataFrame:
    """Partial updates filled with the last known values of the device, across batches (X06); it needs the RocksDB state store. The fields are texts.

    Updates are taken by ``ts`` and ``seq``: within each micro-batch, or, with ``wait``, across batches: an update then comes out when the watermark has passed its slot of ``step`` seconds, and one that
    is later than ``wait`` is left out by Spark.
    """
    rows = updates.withWatermark(ts, wait) if wait else updates
    keeper = CarryForward(updates.columns, columns, [ts, "seq"], ts if wait else None, step)
    return rows.groupBy(key).transformWithStateInPandas(keeper, outputStructType=updates.schema, outputMode="Append", timeMode="EventTime" if wait else "None")


class LiveTail(InOrder):
    """The last rows and the last label of a zone; each tick with new rows gives its newest window."""

    def __init__(self, names: list[str], features: list[str], lookback: int, required: dict[str, float], step: int, grid: int, most_gap: int, most_age: int):
        super().__init__(names, ["_at", "seq"], "_at", step)
        self.features, self.lookback, self.required = features, lookback, required
        self.grid, self.most_gap, self.most_age = grid, most_gap, most_age

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.tail = handle.getListState("tail", "held binary")  # one value: the last rows, as many as a window has
        self.label = handle.getValueState("label", "label string, at timestamp")

    def load(self) -> None:
        held = [unpacked(v[0]) for v in self.tail.get()] if self.tail.exists() else []
        self.window = held[0] if held else None
        self.known = self.label.get() if self.label.exists() else (None, None)

    def store(self) -> None:
        if self.window is not None:
            self.tail.put([(packed(self.window),)])
        if self.known[0] is not None:
            self.label.update(tuple(self.known))

    def take(self, key: tuple, rows: pd.DataFrame, now: int | None) -> Iterator[pd.DataFrame]:
        is_label = rows["_is_label"].astype(bool)
        new, labels = rows[~is_label], rows[is_label]
        if len(labels):
            self.known = (labels["label"].iloc[-1], labels["_at"].iloc[-1].to_pydatetime())
        if not len(new):
            return
        self.window = window = (new if self.window is None else pd.concat([self.window, new], ignore_index=True)).tail(self.lookback)
        latest, label = window["_at"].iloc[-1], self.known
        at = window["_at"].astype("datetime64[us]").astype("int64").to_numpy() / 1e6
        gaps = np.diff(at)
        out: dict[str, Any] = {"zone": key[0], "timestamp": latest, "rows": len(window)}
        gate = True
        for c in self.features:
            v = window[c].astype("float64").to_numpy()
            some = v[~np.isnan(v)]
            avg = float(some.mean()) if len(some) else 0.0
            sd = float(some.std()) if len(some) else 0.0
            out |= {f"{c}_avg": avg, f"{c}_sd": sd, f"{c}_min": float(some.min()) if len(some) else 0.0, f"{c}_max": float(some.max()) if len(some) else 0.0, f"{c}_now": avg if np.isnan(v[-1]) else float(v[-1])}
            if c in self.required:
                gate &= bool(len(some) / len(v) >= self.required[c])
        age = now - at[-1]
        order = bool((not len(gaps) or (gaps.max() <= self.most_gap and gaps.min() >= self.grid / 2)) and age <= self.most_age)
        yield pd.DataFrame([out | {"full": len(window) == self.lookback, "gate_ok": gate, "in_order": order, "age": float(age), "label": label[0], "label_time": label[1]}])


def live_tail(readings: DataFrame, labels: DataFrame, features: list[str], lookback: int, required: dict[str, float], zone: str = "zone_id", ts: str = "timestamp", wait: str = "10 seconds", tick: int = 10, grid: int = 10, most_gap: int = 300, most_age: int = 900) -> DataFrame:
    """The newest window of each zone at each tick with new rows, as a stream.

    ``readings`` has zone, ``ts`` (a TIMESTAMP), seq and features; ``labels`` zone, label_time and label. The last ``lookback`` rows of a zone and its last label are kept in state, so no batch reads a table again. A tick of
    ``tick`` seconds is taken when the watermark, ``wait`` behind the latest row of either, has passed its end, whatever the batches.

    Returns zone, timestamp (the newest row), rows, full (as many as a window has), the statistics that :func:`sensorframe.operators.models.model_columns` names (missing and NaN values left out), gate_ok (share of present values, A26), in_order
    (gaps within the window and age at the end of the tick, W05), age, and the label as of the newest row (A24) with its time. A fitted model scores it as it stands: ``model.transform``. It needs the RocksDB state store.
    """
    both = [c for c in ("_zone", "_at", "seq", "_is_label", "label", *features)]
    r = readings.select(F.col(zone).alias("_zone"), F.col(ts).alias("_at"), F.col("seq").cast("long"), F.lit(False).alias("_is_label"), F.lit(None).cast("string").alias("label"), *(F.col(c).cast("double").alias(c) for c in features))
    n = labels.select(F.col(zone).alias("_zone"), F.col("label_time").alias("_at"), F.lit(-1).cast("long").alias("seq"), F.lit(True).alias("_is_label"), F.col("label").cast("string").alias("label"), *(F.lit(None).cast("double").alias(c) for c in features))
    kind = readings.schema[zone].dataType.simpleString()
    stats = ", ".join(f"`{c}_{s}` double" for c in features for s in ("avg", "sd", "min", "max", "now"))
    schema = f"zone {kind}, timestamp timestamp, rows long, {stats}, full boolean, gate_ok boolean, in_order boolean, age double, label string, label_time timestamp"
    keeper = LiveTail(both, features, lookback, required, tick, grid, most_gap, most_age)
    rows = r.select(*both).unionByName(n.select(*both)).withWatermark("_at", wait)
    return rows.groupBy("_zone").transformWithStateInPandas(keeper, outputStructType=schema, outputMode="Append", timeMode="EventTime").withColumnRenamed("zone", zone)


class Staged(StatefulProcessor):
    """Rows of a table that wait until there are enough of them or the first has waited long enough."""

    def __init__(self, most_rows: int, most_seconds: float, columns: list[str]):
        self.most_rows, self.most_seconds, self.columns = most_rows, most_seconds, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "rows binary")
        self.state = handle.getValueState("state", "n long, timer long")

    def _flush(self) -> Iterator[pd.DataFrame]:
        """Hand everything over and forget it: both become so with the batch, or neither."""
        for v in self.held.get():
            yield unpacked(v[0])
        self.held.clear()
        self.state.clear()

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        n, timer = self.state.get() if self.state.exists() else (0, 0)
        for pdf in rows:
            if len(pdf):
                self.held.appendValue((packed(pdf.set_axis(self.columns, axis=1)),))
                n += len(pdf)
        if not n:
            return
        if n >= self.most_rows:
            if timer:
                self.handle.deleteTimer(timer)
            yield from self._flush()
            return
        if not timer:  # the first row that waits sets the time
            timer = timerValues.getCurrentProcessingTimeInMs() + int(self.most_seconds * 1000)
            self.handle.registerTimer(timer)
        self.state.update((n, timer))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if self.state.exists() and self.state.get()[1] <= timerValues.getCurrentProcessingTimeInMs():
            yield from self._flush()

    def close(self) -> None:
        pass


def staged_rows(rows: DataFrame, by: str = "table", most_rows: int = 500, most_seconds: float = 300) -> DataFrame:
    """Small batches of rows held in state by table and handed over together (S13): when ``most_rows`` wait, or ``most_seconds`` after the first of them came, by the clock of the trigger.

    What is handed over leaves the state in the same batch, so a restart neither loses nor repeats rows where the sink knows batches by number (:class:`sensorframe.sources.versions.VersionedTable`).
    """
    keeper = Staged(most_rows, most_seconds, rows.columns)
    return rows.groupBy(by).transformWithStateInPandas(keeper, outputStructType=T.StructType(rows.schema.fields), outputMode="Append", timeMode="ProcessingTime")
