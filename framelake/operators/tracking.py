"""Multi-object tracking: constant-velocity Kalman boxes joined by optimal IoU (arXiv 1602.00763)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.operators import ordered

BOX = ["x1", "y1", "x2", "y2"]


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Minimum-cost one-to-one assignment of rows and columns, by shortest augmenting paths."""
    if cost.size == 0:
        return []
    if cost.shape[0] > cost.shape[1]:
        return sorted((r, c) for c, r in assign(cost.T))
    n, m = cost.shape
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    owner = np.zeros(m + 1, dtype=int)
    for row in range(1, n + 1):
        owner[0], col = row, 0
        reach, via, done = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=bool)
        while True:
            done[col] = True
            slack = cost[owner[col] - 1] - u[owner[col]] - v[1:]
            closer = ~done[1:] & (slack < reach[1:])
            reach[1:][closer], via[1:][closer] = slack[closer], col
            nearest = int(np.argmin(np.where(done[1:], np.inf, reach[1:]))) + 1
            gap = reach[nearest]
            u[owner[done]] += gap
            v[done] -= gap
            reach[1:][~done[1:]] -= gap
            col = nearest
            if owner[col] == 0:
                break
        while col:
            owner[col] = owner[via[col]]
            col = via[col]
    return sorted((int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j])


def _overlap(a: Sequence[float], b: Sequence[float]) -> float:
    """Plain IoU of two boxes; 0 when both are empty."""
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    inter = w * h
    return inter / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter)


def associate(dets: list[Sequence[float]], tracks: list[Sequence[float]], threshold: float) -> list[tuple[int, int]]:
    """Pairs (detection, track) of the assignment with the largest total IoU, those below the threshold left out."""
    overlap = [[_overlap(d, t) for t in tracks] for d in dets]
    touching = [(d, t) for d, row in enumerate(overlap) for t, v in enumerate(row) if v > 0]
    if len({d for d, _ in touching}) < len(touching) or len({t for _, t in touching}) < len(touching):
        touching = assign(-np.array(overlap))
    return [(d, t) for d, t in touching if overlap[d][t] >= threshold]


# Measurement noise of centre, area and aspect, motion noise of the three velocities, first variance
# of a value and of a velocity.
_R = (1.0, 1.0, 10.0, 10.0)
_Q_VEL = (0.01, 0.01, 0.0001)
_P_POS, _P_VEL = 10.0, 10000.0


def _measure(b: Sequence[float]) -> list[float]:
    """Corner box as centre, area and aspect."""
    w, h = b[2] - b[0], b[3] - b[1]
    return [b[0] + w / 2, b[1] + h / 2, w * h, w / h if h else 0.0]


class Track:
    """One followed box.

    All noise is independent, so its filter falls apart into three filters of a value with its velocity (centre x,
    centre y, area) and one of the aspect alone: `var`, `cov` and `vvar` are the variances of the values, their
    covariances with the velocities and the variances of the velocities.
    """

    __slots__ = ("pos", "vel", "var", "cov", "vvar", "missed", "streak", "id", "kind")

    def __init__(self, box: Sequence[float], number: int, kind: int):
        self.pos, self.vel = _measure(box), [0.0] * 3
        self.var, self.cov, self.vvar = [_P_POS] * 4, [0.0] * 3, [_P_VEL] * 3
        self.missed = self.streak = 0
        self.id, self.kind = number, kind

    def predict(self) -> None:
        if self.vel[2] + self.pos[2] <= 0:
            self.vel[2] = 0.0
        for i in range(3):
            self.pos[i] += self.vel[i]
            self.var[i] += 2 * self.cov[i] + self.vvar[i] + 1.0
            self.cov[i] += self.vvar[i]
            self.vvar[i] += _Q_VEL[i]
        self.var[3] += 1.0
        if self.missed:
            self.streak = 0
        self.missed += 1

    def update(self, box: Sequence[float]) -> None:
        for i, z in enumerate(_measure(box)):
            off, total = z - self.pos[i], self.var[i] + _R[i]
            gain = self.var[i] / total
            self.pos[i] += gain * off
            self.var[i] *= 1 - gain
            if i < 3:
                follow = self.cov[i] / total
                self.vel[i] += follow * off
                self.vvar[i] -= follow * self.cov[i]
                self.cov[i] *= 1 - gain
        self.missed = 0
        self.streak += 1

    def corners(self) -> tuple[float, float, float, float] | None:
        """The box now; none when its area or aspect is no longer positive."""
        x, y, s, r = self.pos
        if s * r <= 0:
            return None
        w = math.sqrt(s * r)
        h = s / w
        return x - w / 2, y - h / 2, x + w / 2, y + h / 2


class Tracker:
    """Tracks of one sequence; `step` is called once per frame, also for frames without detections."""

    def __init__(self, max_age: int, min_hits: int, threshold: float):
        self.max_age, self.min_hits, self.threshold = max_age, min_hits, threshold
        self.tracks: list[Track] = []
        self.frame_count = self.created = 0

    def step(self, dets: list[Sequence[float]], classes: list[int]) -> list[tuple]:
        """Rows (x1, y1, x2, y2, track id, class) of the tracks shown in this frame."""
        self.frame_count += 1
        for t in self.tracks:
            t.predict()
        places = [(t, t.corners()) for t in self.tracks]
        self.tracks = [t for t, place in places if place]
        pairs = associate(dets, [place for _, place in places if place], self.threshold)
        for d, t in pairs:
            self.tracks[t].update(dets[d])
        taken = {d for d, _ in pairs}
        for d, (box, kind) in enumerate(zip(dets, classes)):
            if d not in taken:
                self.created += 1
                self.tracks.append(Track(box, self.created, kind))
        shown = [(t.corners(), t) for t in self.tracks
                 if not t.missed and (t.streak >= self.min_hits or self.frame_count <= self.min_hits)]
        self.tracks = [t for t in self.tracks if t.missed <= self.max_age]
        return [(*box, t.id, t.kind) for box, t in shown if box]


def split_at_gaps(dets: DataFrame, keys: Sequence[str] = ("camera",), max_age: int = 1, frame: str = "frame_num",
                  limit: int = ordered.LIMIT) -> DataFrame:
    """Add `sequence` (numbers the stretches of a camera between gaps no track survives) and `frame_index`.

    A track not seen for more than `max_age` frames ends, so a stretch after more than `max_age` empty frames and
    one more starts without tracks: stretches are tracked by different tasks with the same outcome. `frame_index`
    counts a camera's frames from 1 for the rule about its first frames.
    """
    present = dets.select(*keys, frame).distinct()
    before = ordered.previous(present, keys, [frame], F.col(frame), "_prev", limit)
    new = F.col("_prev").isNull() | (F.col(frame) - F.col("_prev.v") > max_age + 1)
    numbered = ordered.running(before.withColumn("_new", new), keys, [frame],
                               {"sequence": ("sum", F.col("_new").cast("long"))}, limit=limit)
    first = present.groupBy(*keys).agg(F.min(frame).alias("_first"))
    placed = (numbered.join(first, list(keys))
              .select(*keys, frame, "sequence", (F.col(frame) - F.col("_first") + 1).alias("frame_index")))
    return dets.join(placed, [*keys, frame])


def track(dets: DataFrame, keys: Sequence[str] = ("camera", "video_id"), frame: str = "frame_num",
          tie: str = "det_id", max_age: int = 1, min_hits: int = 3, iou: float = 0.3, skip_empty: bool = False,
          frame_index: str | None = None, partitions: int | None = None) -> DataFrame:
    """Follow boxes through each sequence; track numbers start at 1 in every sequence.

    A sequence is one task's work, frame by frame with the state of its living tracks only, so `keys` should
    name one video, or one stretch of `split_at_gaps` (pass its `frame_index`). Frames without detections count
    unless `skip_empty`.
    """
    keys = list(keys)
    index = frame_index or frame
    wanted = dets.select(*dict.fromkeys([*keys, frame, index]), tie, "class_id", *[F.col(c).cast("double").alias(c) for c in BOX])
    # a number keeps the adaptive planner from merging what looks small into one slow task
    partitions = partitions or int(dets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = wanted.repartition(partitions, *keys)
    names = {f.name: f.dataType.simpleString() for f in wanted.schema}
    schema = ", ".join([f"{k} {names[k]}" for k in keys] + [f"{frame} {names[frame]}"]
                       + [f"{c} double" for c in BOX] + ["track_id long", "class_id int"])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, at, tracker, waiting = None, None, None, []

        def finish(out: list) -> None:
            if not waiting:
                return
            out.extend((*key, at, *row) for row in tracker.step([w[0] for w in waiting], [w[1] for w in waiting]))
            waiting.clear()

        for part in parts:
            out: list[tuple] = []
            cols = [part[c].tolist() for c in keys]
            for k, f, i, box, cls in zip(zip(*cols), part[frame].tolist(), part[index].tolist(),
                                         part[BOX].to_numpy(float).tolist(), part["class_id"].tolist()):
                if k != key:
                    finish(out)
                    key, at, tracker = k, None, Tracker(max_age, min_hits, iou)
                    if frame_index:
                        tracker.frame_count = i - 1
                if at is not None and f != at:
                    finish(out)
                    # a gap longer than any track lives only moves the frame count on
                    empty = 0 if skip_empty else f - at - 1
                    for _ in range(min(empty, max_age + 1)):
                        tracker.step([], [])
                    tracker.frame_count += max(0, empty - max_age - 1)
                at = f
                waiting.append((box, cls))
            yield pd.DataFrame(out, columns=[*keys, frame, *BOX, "track_id", "class_id"])
        out = []
        finish(out)
        yield pd.DataFrame(out, columns=[*keys, frame, *BOX, "track_id", "class_id"])

    return spread.sortWithinPartitions(*keys, frame, tie).mapInPandas(run, schema)


def track_summary(tracks: DataFrame, keys: Sequence[str] = ("camera",), unit: Sequence[str] = ("video_id",)) -> DataFrame:
    """Frames with tracks, tracks and mean track length per camera."""
    per_track = tracks.groupBy(*keys, *unit, "track_id").agg(F.count(F.lit(1)).alias("n"))
    frames = tracks.select(*keys, *unit, "frame_num").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("frames"))
    lengths = per_track.groupBy(*keys).agg(F.count(F.lit(1)).alias("tracks"), F.avg("n").alias("mean_length"))
    return frames.join(lengths, list(keys))


def mot_lines(tracks: DataFrame, frame: str = "frame_num", track_id: str = "track_id") -> DataFrame:
    """Tracks as benchmark text lines: frame, id, left, top, width, height with two decimals, and fixed fields."""
    x1, y1, x2, y2 = (F.col(c) for c in BOX)
    place = [F.bround(v, 2) for v in (x1, y1, x2 - x1, y2 - y1)]
    return tracks.select(F.format_string("%d,%d,%.2f,%.2f,%.2f,%.2f,1,-1,-1,-1", F.col(frame), F.col(track_id), *place).alias("value"))


def write_mot(tracks: DataFrame, path: str, mode: str = "overwrite") -> None:
    mot_lines(tracks).write.mode(mode).text(path)
