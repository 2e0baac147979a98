"""Key frames, frame values and per-camera counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake import fixed
from framelake.functions import messages
from framelake.operators import ordered

VALUE_COLUMNS = ["objs", "counts", "classes", "scenes", "valuable", "is_keyframe"]


def prepare_value(df: DataFrame, scene_num: int = 5, taxonomy: dict[str, str] | None = None,
                  box_order: str = "xyxy") -> DataFrame:
    """Detected frames as value rows: tags, class counts, coarse scenes and initial flags."""
    objs, scenes = df["objs"], df["scenes"]
    return df.select(
        *[c for c in df.columns if c not in VALUE_COLUMNS],
        messages.parse_objects(objs, box_order).alias("objs"),
        messages.object_counts(objs).alias("counts"),
        messages.class_list(objs).alias("classes"),
        messages.coarse_scenes(messages.top_scenes(scenes, scene_num), taxonomy).alias("scenes"),
        F.lit(True).alias("valuable"),
        F.lit(True).alias("is_keyframe"))


def coarse_scenes_by_table(df: DataFrame, taxonomy: DataFrame, frame: Sequence[str] = ("camera", "frame_num"),
                           raw: str = "scenes") -> DataFrame:
    """Coarse scenes through a taxonomy table `(raw_scene, scene_type)` of any size."""
    long = df.select(*frame, F.explode_outer(raw).alias("raw_scene"))
    types = (long.join(taxonomy, "raw_scene", "left").groupBy(*frame)
             .agg(F.sort_array(F.collect_set("scene_type")).alias("scenes")))
    return types.withColumn("scenes", F.when(F.size("scenes") > 0, F.col("scenes"))
                            .otherwise(F.array(F.lit(fixed.FALLBACK_SCENE))))


def mark_keyframes(df: DataFrame, keys: Sequence[str] = ("camera",), order: Sequence[str] = ("frame_num",),
                   classes: Column | None = None, limit: int = ordered.LIMIT) -> DataFrame:
    """Set `is_keyframe`: first frame, or other object classes (with their numbers) than the frame before."""
    classes = messages.class_list(F.col("objs")) if classes is None else classes
    here = df.withColumn("_classes", classes)
    return (ordered.previous(here, keys, order, F.col("_classes"), "_prev", limit)
            .withColumn("is_keyframe", F.col("_prev").isNull() | ~F.col("_classes").eqNullSafe(F.col("_prev.v")))
            .drop("_classes", "_prev"))


def pair_diff_keyframes(df: DataFrame, keys: Sequence[str] = ("camera",), time: str = "timestamp",
                        tie: str = "frame_num", batch_seconds: int | None = 60,
                        limit: int = ordered.LIMIT) -> DataFrame:
    """The earlier frame of every adjacent pair; `is_keyframe` when its objects (boxes too) differ from the later's.

    Pairs are formed inside batches of `batch_seconds`, or over the whole camera when it is None.
    """
    groups = list(keys)
    if batch_seconds:
        df = df.withColumn("batch", F.floor(F.col(time) / (batch_seconds * 1000)).cast("long"))
        groups.append("batch")
    pairs = ordered.following(df, groups, [time, tie], F.col("objs"), "_next", limit)
    return (pairs.filter(F.col("_next").isNotNull())
            .withColumn("is_keyframe", ~F.col("objs").eqNullSafe(F.col("_next.v"))).drop("_next"))


def running_counters(df: DataFrame, keys: Sequence[str] = ("camera",), order: Sequence[str] = ("frame_num",),
                     limit: int = ordered.LIMIT) -> DataFrame:
    """Frames, key frames and scene tags seen so far by each camera."""
    one = F.lit(1).cast("long")
    return ordered.running(df, keys, order, {
        "frame_cnt": ("sum", one),
        "keyframe_cnt": ("sum", F.when(F.col("is_keyframe"), one).otherwise(one * 0)),
        "scene_cnt": ("sum", F.coalesce(F.size("scenes"), F.lit(0)).cast("long")),
    }, limit=limit)
