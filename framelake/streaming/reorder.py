"""Putting a camera's frames in order and marking key frames on a stream."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framelake.functions import messages
from framelake.session import use_rocksdb


class BoundedOrder(StatefulProcessor):
    """Holds up to `capacity` - 1 frames of a camera and lets the lowest go when another arrives.

    A row without a frame number ends the camera's stream and empties the buffer, as does `idle_ms` without
    arrivals. A frame that leaves after a higher one is marked `late`; none is dropped.
    """

    def __init__(self, schema: T.StructType, keys: Sequence[str], capacity: int, idle_ms: int, compare: str | None):
        self.schema, self.keys, self.capacity, self.idle_ms, self.compare = schema, list(keys), capacity, idle_ms, compare
        self.names = schema.names
        self.whole = [isinstance(f.dataType, (T.LongType, T.IntegerType)) for f in schema]
        self.number, self.arrival = schema.names.index("frame_num"), schema.names.index("arrival")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", self.schema)
        last = [T.StructField("frame_num", T.LongType())]
        if self.compare:
            last.append(T.StructField("value", self.schema[self.compare].dataType))
        self.last = handle.getValueState("last", T.StructType(last))

    def _rows(self, parts: Iterator[pd.DataFrame]) -> list[tuple]:
        rows = []
        for part in parts:
            part = part[self.names].astype(object).where(part[self.names].notna(), None)
            rows.extend(tuple(_plain(v, whole) for v, whole in zip(row, self.whole)) for row in part.itertuples(index=False, name=None))
        # a micro-batch comes in no order; the place in the source decides
        return sorted(rows, key=lambda r: r[self.arrival])

    def _emit(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if not rows:
            return
        last = self.last.get() if self.last.exists() else None
        seen, value = (last[0], last[1] if self.compare else None) if last else (None, None)
        late, keyframe = [], []
        for row in rows:
            late.append(seen is not None and row[self.number] < seen)
            if self.compare:
                new = list(row[self.names.index(self.compare)] or [])
                keyframe.append(seen is None or list(value or []) != new)
                value = new
            seen = row[self.number] if seen is None else max(seen, row[self.number])
        self.last.update((seen, value) if self.compare else (seen,))
        out = pd.DataFrame(rows, columns=self.names)
        out["late"] = late
        if self.compare:
            out["is_keyframe"] = keyframe
        yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.buffer.get()] if self.buffer.exists() else []
        heap = [(r[self.number], r[self.arrival], i, r) for i, r in enumerate(held)]
        heapq.heapify(heap)
        out, count = [], len(heap)
        for row in self._rows(rows):
            if row[self.number] is None:
                out.extend(heapq.heappop(heap)[3] for _ in range(len(heap)))
                continue
            heapq.heappush(heap, (row[self.number], row[self.arrival], count, row))
            count += 1
            if len(heap) >= self.capacity:
                out.append(heapq.heappop(heap)[3])
        if heap:
            self.buffer.put([item[3] for item in heap])
        else:
            self.buffer.clear()
        if self.idle_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if heap:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield from self._emit(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.buffer.get()] if self.buffer.exists() else []
        self.buffer.clear()
        yield from self._emit(sorted(held, key=lambda r: (r[self.number], r[self.arrival])))

    def close(self) -> None:
        pass


class ForwardPairs(BoundedOrder):
    """Holds the newest frame back until its successor comes; a new batch of the clock, or the end, lets it go without a row."""

    def __init__(self, schema: T.StructType, keys: Sequence[str], capacity: int, idle_ms: int, batch_ms: int | None):
        super().__init__(schema, keys, capacity, idle_ms, None)
        self.batch_ms = batch_ms
        self.time, self.value = schema.names.index("timestamp"), schema.names.index("signature")

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.newest = handle.getValueState("newest", self.schema)

    def _emit(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if not rows:
            return
        before = tuple(self.newest.get()) if self.newest.exists() else None
        out = []
        for row in rows:
            same = before is not None and (not self.batch_ms or before[self.time] // self.batch_ms == row[self.time] // self.batch_ms)
            if same:
                out.append((*before, before[self.value] != row[self.value]))
            before = row
        self.newest.update(before)
        if out:
            yield pd.DataFrame(out, columns=[*self.names, "is_keyframe"])


def _plain(value, whole: bool):
    """Arrow values as the plain lists and numbers the state takes; whole numbers beside nulls arrive as floats."""
    if value is None:
        return None
    if hasattr(value, "tolist"):
        value = value.tolist()
    return int(value) if whole else value


def _ordered(stream: DataFrame, keys: Sequence[str], capacity: int, idle_ms: int, compare: str | None) -> DataFrame:
    use_rocksdb(stream.sparkSession)
    schema = stream.schema
    out = T.StructType([*schema.fields, T.StructField("late", T.BooleanType())]
                       + ([T.StructField("is_keyframe", T.BooleanType())] if compare else []))
    processor = BoundedOrder(schema, keys, capacity, idle_ms, compare)
    return stream.groupBy(*keys).transformWithStateInPandas(processor, out, "Append", "ProcessingTime" if idle_ms else "None")


def reorder(stream: DataFrame, keys: Sequence[str] = ("camera",), capacity: int = 128, idle_ms: int = 30_000) -> DataFrame:
    """Frames in the order a bounded buffer restores, with `late`.

    A stream with timers never ends by itself: pass `idle_ms=0` for a run over what is available now. Such a run keeps up to
    `capacity` - 1 frames of each camera in its state unless an end mark (a row without frame number) follows them.
    `stream` has `frame_num` and `arrival`, the place of a row in its source; integers, text and arrays may follow.
    """
    return _ordered(stream, keys, capacity, idle_ms, None)


def stream_keyframes(stream: DataFrame, keys: Sequence[str] = ("camera",), capacity: int = 128,
                     idle_ms: int = 30_000) -> DataFrame:
    """Reordered frames with `is_keyframe`, in one state and one shuffle; `classes` or `objs` holds the objects."""
    if "classes" not in stream.columns:
        stream = stream.withColumn("classes", messages.class_list(F.col("objs"))).drop("objs")
    return _ordered(stream, keys, capacity, idle_ms, "classes")


def stream_pair_diff(stream: DataFrame, keys: Sequence[str] = ("camera",), batch_seconds: int | None = 60, capacity: int = 128,
                     idle_ms: int = 30_000) -> DataFrame:
    """`keyframes.pair_diff_keyframes` on a stream: the earlier frame of every adjacent pair of a batch, once the later one is in order.

    `stream` has `frame_num`, `timestamp`, `arrival` and `objs`; the state holds the objects as text. For `capacity` and `idle_ms` see `reorder`.
    """
    use_rocksdb(stream.sparkSession)
    rows = stream.withColumn("signature", F.coalesce(F.to_json("objs"), F.lit(""))).drop("objs")
    out = T.StructType([*rows.schema.fields, T.StructField("is_keyframe", T.BooleanType())])
    processor = ForwardPairs(rows.schema, keys, capacity, idle_ms, batch_seconds and batch_seconds * 1000)
    paired = rows.groupBy(*keys).transformWithStateInPandas(processor, out, "Append", "ProcessingTime" if idle_ms else "None")
    return paired.drop("signature")
