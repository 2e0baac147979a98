"""Windowed counts that run on tables and on streams alike."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from framelake.functions import keys
from framelake.operators import statistic
from framelake.session import use_rocksdb
from framelake.streaming import buckets


def _timed(df: DataFrame, delay: str) -> DataFrame:
    timed = df.withColumn("event_time", F.timestamp_millis(F.col("timestamp")))
    return timed.withWatermark("event_time", delay) if df.isStreaming else timed


def throughput(stream: DataFrame, period: str = "60 seconds", delay: str = "2 minutes") -> DataFrame:
    """Frames sent per camera and period."""
    sent = _timed(stream, delay).groupBy("camera", F.window("event_time", period).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return sent.select(keys.dashcam_id(F.col("camera")).alias("dashcam_id"), F.col("w.start").alias("record_time"),
                       F.col("n").cast("float").alias("size"))


def rolling_statistic(stream: DataFrame, period: str = "10 seconds", delay: str = "2 minutes",
                      attribution: str = "frame") -> DataFrame:
    """Statistic counters per camera and period.

    `attribution="frame"` counts every frame for its own day and place; `"flush"` counts the whole period for
    the day and place of the camera's last frame in it.
    """
    timed = _timed(stream, delay).withColumn("store_date", keys.store_date(F.col("timestamp")))
    span = F.window("event_time", period).alias("w")
    if attribution == "flush":
        last = F.max_by(F.struct("store_date", "location"), F.struct("timestamp", "frame_num")).alias("at")
        counted = timed.groupBy("camera", span).agg(last, *statistic.counter_columns()).select("*", "at.*")
    elif attribution == "frame":
        counted = timed.groupBy("camera", "store_date", "location", span).agg(*statistic.counter_columns())
    else:
        raise ValueError(f"unknown attribution {attribution}")
    return counted.select(keys.dashcam_id(F.col("camera")).alias("dashcam_id"), "store_date", "location",
                          F.col("w.start").alias("period_start"), *statistic.COUNTERS)


_OPEN = T.StructType([T.StructField("period_ms", T.LongType()), T.StructField("store_date", T.StringType()), T.StructField("location", T.StringType()),
                      T.StructField("counts", T.ArrayType(T.LongType()))])
_CAMERA = T.StructType([T.StructField("newest", T.LongType()), T.StructField("open", T.ArrayType(_OPEN))])


class OpenPeriods(StatefulProcessor):
    """Counters of the open periods of cameras. A period closes when its camera's newest frame is `delay_ms` past its end, or at the end mark.

    A state key is a bucket of cameras, so that what a key costs is shared; a batch reads and writes the state of its cameras only.
    """

    def __init__(self, names: Sequence[str], key: T.StructType, period_ms: int, delay_ms: int):
        self.names, self.key, self.keys = list(names), key, key.names
        self.period_ms, self.delay_ms = period_ms, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cameras = handle.getMapState("cameras", self.key, _CAMERA)

    def _arrived(self, rows: Iterator[pd.DataFrame]) -> tuple[dict[tuple, dict], dict[tuple, int], set[tuple]]:
        """Counters of each camera's periods in this batch, its newest frame, and the cameras that end."""
        counted: dict[tuple, dict] = {}
        newest: dict[tuple, int] = {}
        ended: set[tuple] = set()
        for part in rows:
            part = part.set_axis(self.names, axis=1)
            mark = part["timestamp"].isna()
            ended.update(buckets.keys_of(part[mark], self.keys))
            part = part[~mark]
            places = ([None if pd.isna(v) else v for v in part[c].tolist()] for c in ("store_date", "location"))
            columns = [part["timestamp"].astype("int64").tolist(), *places, part["counts"].tolist()]
            for camera, ms, date, place, counts in zip(buckets.keys_of(part, self.keys), *columns):
                newest[camera] = max(ms, newest.get(camera, ms))
                _add(counted.setdefault(camera, {}), (ms // self.period_ms * self.period_ms, date, place), counts.tolist())
        return counted, newest, ended

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        counted, arrived, ended = self._arrived(rows)
        out: list[tuple] = []
        for camera in dict.fromkeys([*counted, *ended]):
            state = self.cameras.getValue(camera)
            newest, held = (state[0], {tuple(r)[:3]: list(r[3]) for r in state[1]}) if state else (None, {})
            for place, counts in counted.get(camera, {}).items():
                _add(held, place, counts)
            if camera in arrived:
                newest = arrived[camera] if newest is None else max(newest, arrived[camera])
            done = [p for p in held if camera in ended or p[0] + self.period_ms + self.delay_ms <= newest]
            out.extend((*camera, *p, held.pop(p)) for p in done)
            if newest is not None:
                self.cameras.updateValue(camera, (newest, [(*p, c) for p, c in held.items()]))
            if len(out) >= buckets.CHUNK:
                yield self._frame(out)
                out = []
        if out:
            yield self._frame(out)

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        rows = pd.DataFrame(out, columns=[*self.keys, "period_ms", "store_date", "location", "counts"])
        return buckets.exact(rows, self.key, out)

    def close(self) -> None:
        pass


def _add(held: dict, place: tuple, counts: list[int]) -> None:
    old = held.get(place)
    held[place] = [a + b for a, b in zip(old, counts)] if old else counts


def flushed_statistic(stream: DataFrame, period_seconds: int = 10, delay_seconds: int = 120, bucket_count: int = 1024) -> DataFrame:
    """`rolling_statistic` of a stream, with a final flush: a row without a timestamp ends its camera and closes all its periods.

    Time is that of the camera, so one that lags behind closes nothing early. A frame more than the delay late opens its
    period again: its row adds to the one before. A task holds one of `bucket_count` parts of a batch; the number stays with a checkpoint.
    """
    use_rocksdb(stream.sparkSession)
    scenes = F.coalesce("scenes", F.expr("cast(array() as array<string>)"))
    flags = {t: F.array_contains(scenes, t).cast("long") for t in statistic.COUNTERS if t not in ("total", "keyframes", "frames")}
    counts = {**flags, "total": F.size(scenes).cast("long"), "keyframes": F.coalesce(F.col("is_keyframe").cast("long"), F.lit(0).cast("long")),
              "frames": F.lit(1).cast("long")}
    # one column for all counters: what a column costs in pandas is then paid once
    rows = stream.select("camera", "timestamp", keys.store_date(F.col("timestamp")).alias("store_date"), "location",
                         F.array(*[counts[c] for c in statistic.COUNTERS]).alias("counts"))
    out = T.StructType([rows.schema["camera"], *_OPEN])
    dealt = buckets.in_buckets(rows, ["camera"], bucket_count)
    processor = OpenPeriods(dealt.columns, buckets.key_schema(rows, ["camera"]), period_seconds * 1000, delay_seconds * 1000)
    closed = dealt.groupBy("_bucket").transformWithStateInPandas(processor, out, "Append", "None")
    return closed.select(keys.dashcam_id(F.col("camera")).alias("dashcam_id"), "store_date", "location",
                         F.timestamp_millis("period_ms").alias("period_start"), *[F.get("counts", F.lit(i)).alias(c) for i, c in enumerate(statistic.COUNTERS)])


def microbatch_counts(stream: DataFrame, name: str = "frames") -> DataFrame:
    """The stream with its number of frames per micro-batch observed under `name`."""
    return stream.observe(name, F.count(F.lit(1)).alias("n"))


class CountListener(StreamingQueryListener):
    """Keeps the observed number of frames of each micro-batch, or of the last `keep` ones."""

    def __init__(self, name: str = "frames", keep: int | None = None):
        self.name, self.keep, self.counts = name, keep, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            self.counts.append((event.progress.batchId, seen["n"]))
            if self.keep:
                del self.counts[:-self.keep]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
