"""The statistic table: scene, key frame and frame counters per camera, day and place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake import fixed
from framelake.functions import keys

KEY = ["dashcam_id", "store_date", "location"]
COUNTERS = [*fixed.SCENE_TYPES, "total", "keyframes", "frames"]


def counter_columns(scenes: Column | str = "scenes", is_keyframe: str = "is_keyframe") -> list[Column]:
    """Aggregates of one pass over frames with coarse scenes; `total` counts scene tags."""
    scenes = F.col(scenes) if isinstance(scenes, str) else scenes
    flag = lambda cond: F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    return [
        *[flag(F.array_contains(scenes, t)).alias(t) for t in fixed.SCENE_TYPES],
        F.sum(F.coalesce(F.size(scenes), F.lit(0)).cast("long")).alias("total"),
        flag(F.col(is_keyframe)).alias("keyframes"),
        F.count(F.lit(1)).alias("frames"),
    ]


def scene_statistic(frames: DataFrame) -> DataFrame:
    """Counters per camera, day and place of value rows; every frame counts for its own key."""
    keyed = frames.withColumns({"dashcam_id": keys.dashcam_id(F.col("camera")),
                                "store_date": keys.store_date(F.col("timestamp"))})
    return keyed.groupBy(*KEY).agg(*counter_columns())


def merge_statistic(existing: DataFrame, delta: DataFrame) -> DataFrame:
    """Add counters by key; absent keys are inserted."""
    both = existing.select(*KEY, *COUNTERS).unionByName(delta.select(*KEY, *COUNTERS))
    return both.groupBy(*KEY).agg(*[F.sum(F.coalesce(c, F.lit(0).cast("long"))).alias(c) for c in COUNTERS])
