"""Rows of the frames table and where frames go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions import keys

FRAME_KEY = ["dashcam_id", "store_date", "store_time"]


def frame_rows(df: DataFrame, store_prefix: str, url_prefix: str, *extra: str) -> DataFrame:
    """Value rows as rows of the frames table; `checked` is unknown until someone reviews the frame."""
    ms, cam = F.col("timestamp"), F.col("camera")
    return df.select(
        keys.dashcam_id(cam).alias("dashcam_id"), keys.store_date(ms).alias("store_date"),
        F.timestamp_millis(ms).alias("store_time"), "is_keyframe",
        keys.storage_link(url_prefix, keys.store_key(store_prefix, ms, cam)).alias("storage_link"),
        F.col("objs").alias("obj_tags"), "scenes", F.lit(None).cast("boolean").alias("checked"), "location", *extra)


def latest_rows(df: DataFrame, arrival: str = "arrival", key: Sequence[str] = FRAME_KEY) -> DataFrame:
    """The latest arrival per key; copies of a key shrink to one row per map task before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    return (df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(arrival)).alias("_row"))
            .select(*key, "_row.*"))


def upsert_frames(existing: DataFrame, new: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Insert or overwrite by key: the row that arrived last stays."""
    return latest_rows(existing.unionByName(new), arrival)


def route(df: DataFrame, prefix: str = "obj_", key: str = "camera") -> DataFrame:
    """Add the `topic` of each row's camera."""
    return df.withColumn("topic", F.concat(F.lit(prefix), F.col(key).cast("string")))


def topic_rows(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Messages as rows of a topic sink: `topic` (given, or the column), key `camera_frame` and JSON value."""
    body = [c for c in df.columns if c != "topic"]
    return df.select(F.lit(topic).alias("topic") if topic else F.col("topic"),
                     keys.message_key(F.col("camera"), F.col("frame_num")).alias("key"),
                     F.to_json(F.struct(*body)).alias("value"))


def write_routed(df: DataFrame, path: str, mode: str = "append") -> None:
    """Files per topic; the rows of one topic stay spread over the tasks that hold them."""
    df.write.mode(mode).partitionBy("topic").parquet(path)


def librarian(df: DataFrame, store_prefix: str, tmp_prefix: str) -> DataFrame:
    """Add `action` and `key`: archive valuable frames under their store key, delete others by their temp key."""
    ms, cam = F.col("timestamp"), F.col("camera")
    valuable = F.coalesce("valuable", F.lit(False))
    return df.withColumns({
        "action": F.when(valuable, "archive").otherwise("delete"),
        "key": F.when(valuable, keys.store_key(store_prefix, ms, cam)).otherwise(keys.tmp_key(tmp_prefix, ms, cam))})


def archive_manifest(df: DataFrame, store_prefix: str, tmp_prefix: str) -> DataFrame:
    return librarian(df, store_prefix, tmp_prefix).filter(F.col("action") == "archive").select("key")


def delete_manifest(df: DataFrame, store_prefix: str, tmp_prefix: str) -> DataFrame:
    return librarian(df, store_prefix, tmp_prefix).filter(F.col("action") == "delete").select("key")


def partition_by_key(df: DataFrame, n: int, mode: str = "camera") -> DataFrame:
    """Spread rows over n partitions: by camera, by message key (camera and frame), or evenly (`round_robin`)."""
    by = {"camera": ["camera"], "frame": ["camera", "frame_num"], "round_robin": []}[mode]
    return df.repartition(n, *by)
