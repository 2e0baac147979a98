"""Diverse frames while they arrive."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framelake.session import use_rocksdb


class BestFrames(StatefulProcessor):
    """The first `cap` distinct rows of a group so far. Rows that enter come out, and with `retract` those that leave as well."""

    def __init__(self, schema: T.StructType, keys: Sequence[str], cap: int, retract: bool):
        self.names = schema.names
        self.held = T.StructType([f for f in schema.fields if f.name not in keys])
        self.keys, self.cap, self.retract = list(keys), cap, retract
        self.whole = [isinstance(f.dataType, T.IntegralType) for f in self.held]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getListState("best", self.held)

    def _rows(self, rows: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for part in rows:
            part = part.set_axis(self.names, axis=1)  # computed columns arrive without their names
            columns = [[None if pd.isna(v) else int(v) if whole else v for v in part[name].tolist()] for name, whole in zip(self.held.names, self.whole)]
            yield from zip(*columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old = {tuple(r) for r in self.best.get()} if self.best.exists() else set()
        now = set(old)
        for row in self._rows(rows):
            now.add(row)
            if len(now) > 4 * self.cap:
                now = self._first(now)
        now = self._first(now)
        self.best.put(list(now))
        out = [(*key, *r, True) for r in now - old] + [(*key, *r, False) for r in old - now if self.retract]
        if out:
            yield pd.DataFrame(out, columns=[*self.keys, *self.held.names, "nominated"])

    def _first(self, rows: set[tuple]) -> set[tuple]:
        return set(heapq.nsmallest(self.cap, rows, key=lambda r: tuple((v is not None, v) for v in r)))

    def close(self) -> None:
        pass


def stream_diversity(stream: DataFrame, cap: int, frame: Sequence[str] = ("camera", "frame_num"), pick: Sequence[Column] | None = None,
                     by_location: bool = False, salts: int = 16) -> DataFrame:
    """`selection.diversity_select` on a stream: changes of what each scene type (in each place) nominates.

    A row says that a frame is now among the first `cap` of its type (`nominated`) or has left them; one that has left never comes back,
    as the first ones only get better. `valuable_frames` folds the changes. Frames that arrive again count once; null keys are keys. State is at most
    `cap` rows for each type and salt: a frequent type is first narrowed in `salts` parts, and only what enters a part's
    first `cap` meets in one state. `pick` and `frame` are integers or text.
    """
    use_rocksdb(stream.sparkSession)
    frame, bucket = list(frame), ["scene_type"] + (["location"] if by_location else [])
    pick = list(pick) if pick else [F.xxhash64(*frame)]
    order = [f"_o{i}" for i in range(len(pick))]
    tags = stream.select(*[p.alias(o) for p, o in zip(pick, order)], *frame, *(["location"] if by_location else []), F.explode("scenes").alias("scene_type"))
    tags = tags.withColumn("_salt", F.pmod(F.xxhash64(*frame), F.lit(salts)))

    def narrowed(rows: DataFrame, keys: list[str], retract: bool) -> DataFrame:
        held = [f for f in rows.schema if f.name not in keys]
        out = T.StructType([*[rows.schema[k] for k in keys], *held, T.StructField("nominated", T.BooleanType())])
        processor = BestFrames(rows.schema, keys, cap, retract)
        return rows.groupBy(*keys).transformWithStateInPandas(processor, out, "Append", "None")

    parts = narrowed(tags, [*bucket, "_salt"], False).drop("_salt", "nominated")
    return narrowed(parts, bucket, True).select(*bucket, *frame, "nominated")


def valuable_frames(changes: DataFrame, frame: Sequence[str] = ("camera", "frame_num")) -> DataFrame:
    """Keys of the frames that some type nominates after all changes."""
    bucket = [c for c in ("scene_type", "location") if c in changes.columns and c not in frame]
    net = changes.groupBy(*bucket, *frame).agg(F.sum(F.when(F.col("nominated"), 1).otherwise(-1)).alias("_net"))
    return net.filter("_net > 0").select(*frame).distinct()
