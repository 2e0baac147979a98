"""Following boxes on a stream: the tracker of a sequence as state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framelake.operators.tracking import BOX, Track, Tracker
from framelake.session import use_rocksdb
from framelake.streaming import buckets

_NUMBERS = T.ArrayType(T.DoubleType())
TRACKS = T.StructType([*[T.StructField(c, _NUMBERS) for c in ("pos", "vel", "var", "cov", "vvar")],
                       *[T.StructField(c, T.LongType()) for c in ("missed", "streak", "id", "kind")]])
CLOCK = T.StructType([T.StructField(c, T.LongType()) for c in ("newest", "done", "frame_count", "created")])
WAITING = T.StructType([T.StructField("frame_num", T.LongType()), T.StructField("tie", T.LongType()), T.StructField("class_id", T.IntegerType()),
                        *[T.StructField(c, T.DoubleType()) for c in BOX]])
SEQUENCE = T.StructType([*CLOCK, T.StructField("due", T.LongType()), T.StructField("waiting", T.ArrayType(WAITING)), T.StructField("tracks", T.ArrayType(TRACKS))])


class TrackState(StatefulProcessor):
    """Boxes wait until their sequence is `lag` frames further; then their frame is complete and the tracker takes its step.

    A state key is a bucket of sequences, so that what a key costs is shared; a batch reads and writes those of its sequences only.
    State of a sequence: the waiting boxes, the filters of its living tracks, the newest frame seen, the last one done and the counts of frames and tracks.
    A row without a frame number ends the sequence; without arrivals for `idle_ms` a timer works off what waits and lets the
    tracks go as lost, keeping the counts. A box of a frame that is done comes out `late`, without a track.
    """

    def __init__(self, names: Sequence[str], key: T.StructType, lag: int, idle_ms: int, max_age: int, min_hits: int, iou: float, skip_empty: bool):
        self.names, self.key, self.keys = list(names), key, key.names
        self.lag, self.idle_ms, self.skip_empty = lag, idle_ms, skip_empty
        self.options = (max_age, min_hits, iou)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sequences = handle.getMapState("sequences", self.key, SEQUENCE)
        if self.idle_ms:
            self.due = handle.getMapState("due", "ms long", T.StructType([T.StructField("keys", T.ArrayType(self.key))]))

    def _tracker(self, state: tuple | None) -> tuple[Tracker, int | None, int | None, list[tuple]]:
        tracker = Tracker(*self.options)
        if state is None:
            return tracker, None, None, []
        newest, done, tracker.frame_count, tracker.created, _, waiting, tracks = state
        for row in tracks:
            track = Track([0.0] * 4, row[7], row[8])
            track.pos, track.vel, track.var, track.cov, track.vvar = (list(x) for x in row[:5])
            track.missed, track.streak = row[5], row[6]
            tracker.tracks.append(track)
        return tracker, newest, done, [tuple(r) for r in waiting]

    def _keep(self, key: tuple, tracker: Tracker, newest: int | None, done: int | None, due: int | None, held: list[tuple]) -> None:
        self.sequences.updateValue(key, (newest, done, tracker.frame_count, tracker.created, due, held, [
            (t.pos, t.vel, t.var, t.cov, t.vvar, t.missed, t.streak, t.id, t.kind) for t in tracker.tracks]))

    def _advance(self, tracker: Tracker, done: int | None, boxes: list[tuple], out: list[tuple]) -> int | None:
        """Steps through the frames of `boxes`, and through the empty ones between; returns the last."""
        max_age = self.options[0]
        boxes.sort(key=lambda b: b[:2])
        at = 0
        while at < len(boxes):
            frame, end = boxes[at][0], at
            while end < len(boxes) and boxes[end][0] == frame:
                end += 1
            empty = 0 if done is None or self.skip_empty else frame - done - 1
            for _ in range(min(empty, max_age + 1)):
                tracker.step([], [])
            tracker.frame_count += max(0, empty - max_age - 1)  # a gap longer than any track lives only moves the count on
            shown = tracker.step([b[3:] for b in boxes[at:end]], [b[2] for b in boxes[at:end]])
            out.extend((frame, *row, False) for row in shown)
            done, at = frame, end
        return done

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        rows = pd.DataFrame(out, columns=[*self.keys, "frame_num", *BOX, "track_id", "class_id", "late"])
        rows["track_id"] = rows["track_id"].astype("Int64")
        return buckets.exact(rows, self.key, out)

    def _arrived(self, rows: Iterator[pd.DataFrame]) -> tuple[dict[tuple, list[tuple]], set[tuple]]:
        """Boxes of each sequence of the bucket, and the sequences that end."""
        boxes: dict[tuple, list[tuple]] = {}
        ended: set[tuple] = set()
        for part in rows:
            part = part.set_axis(self.names, axis=1)
            mark = part["frame_num"].isna()
            for key in buckets.keys_of(part[mark], self.keys):
                ended.add(key)
                boxes.setdefault(key, [])
            part = part[~mark]
            columns = [part[c].astype("int64").tolist() for c in ("frame_num", "tie", "class_id")] + [part[c].astype(float).tolist() for c in BOX]
            for key, box in zip(buckets.keys_of(part, self.keys), zip(*columns)):
                boxes.setdefault(key, []).append(box)
        return boxes, ended

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        due = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms if self.idle_ms else None
        arrived, ends = self._arrived(rows)
        out: list[tuple] = []
        for at, boxes in arrived.items():
            state, ended = self.sequences.getValue(at), at in ends
            tracker, newest, done, held = self._tracker(state)
            shown = []
            for box in boxes:
                if done is not None and box[0] <= done:
                    shown.append((box[0], *box[3:], None, box[2], True))
                else:
                    held.append(box)
                    newest = box[0] if newest is None else max(newest, box[0])
            ripe = [b for b in held if ended or b[0] <= newest - self.lag]
            held = [] if ended else [b for b in held if b[0] > newest - self.lag]
            done = self._advance(tracker, done, ripe, shown)
            if not ended:
                self._keep(at, tracker, newest, done, due, held)
            elif state is not None:
                self.sequences.removeKey(at)
            out.extend((*at, *row) for row in shown)
            if len(out) >= buckets.CHUNK:
                yield self._frame(out)
                out = []
        waiting = [at for at in arrived if at not in ends]
        if self.idle_ms and waiting:
            before = self.due.getValue((due,))
            self.due.updateValue((due,), ([*(tuple(k) for k in before[0]), *waiting] if before else waiting,))
            self.handle.registerTimer(due)
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        named = self.due.getValue((due,))
        self.due.removeKey((due,))
        out: list[tuple] = []
        for at in {tuple(k) for k in named[0]} if named else ():
            state = self.sequences.getValue(at)
            if state is None or state[4] != due:  # ended, or seen again since
                continue
            tracker, newest, done, held = self._tracker(state)
            shown: list[tuple] = []
            done = self._advance(tracker, done, held, shown)
            tracker.tracks = []
            self._keep(at, tracker, newest, done, None, [])
            out.extend((*at, *row) for row in shown)
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass


def stream_tracks(dets: DataFrame, keys: Sequence[str] = ("camera", "video_id"), tie: str = "det_id", lag: int = 8, idle_ms: int = 30_000,
                  max_age: int = 1, min_hits: int = 3, iou: float = 0.3, skip_empty: bool = False,
                  bucket_count: int = 1024) -> DataFrame:
    """The rows of `tracking.track` on a stream of boxes whose frames arrive up to `lag` - 1 frames late, and `late` for others.

    A stream with timers never ends by itself: pass `idle_ms=0` for a run over what is available now. A row with the keys but without a frame number
    ends a sequence. State holds the boxes of `lag` frames and the living tracks of each sequence, however long it runs.
    `keys` are integers or text. A task holds one of `bucket_count` parts of a batch; the number stays with a checkpoint.
    """
    use_rocksdb(dets.sparkSession)
    rows = dets.selectExpr(*keys, "cast(frame_num as long) as frame_num", f"cast({tie} as long) as tie", "cast(class_id as int) as class_id",
                           *[f"cast({c} as double) as {c}" for c in BOX])
    key = buckets.key_schema(rows, keys)
    out = T.StructType([*key, T.StructField("frame_num", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in BOX],
                        T.StructField("track_id", T.LongType()), T.StructField("class_id", T.IntegerType()), T.StructField("late", T.BooleanType())])
    dealt = buckets.in_buckets(rows, keys, bucket_count)
    processor = TrackState(dealt.columns, key, lag, idle_ms, max_age, min_hits, iou, skip_empty)
    return dealt.groupBy("_bucket").transformWithStateInPandas(processor, out, "Append", "ProcessingTime" if idle_ms else "None")
