"""Detected frames of live cameras to the frames and statistic tables, as one streaming query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from framelake.functions import messages as fields
from framelake.operators import keyframes
from framelake.operators.selection import mark_valuable
from framelake.sinks import stream as sink
from framelake.sources import messages
from framelake.streaming import reorder


#: A message that can be put in its place: readable, of a known camera, with a number of arrival.
def usable() -> Column:
    return F.col(messages.REJECT).isNull() & F.col("camera").isNotNull() & F.col("arrival").isNotNull()


def live_values(wire: DataFrame, capacity: int = 128, idle_ms: int = 30_000, scene_num: int = 5) -> DataFrame:
    """Value rows in camera order with their key frame flags, from `arrival` and JSON `value` columns.

    While frames wait for their turn the state holds their message text and their object classes only. A message
    without a frame number ends its camera's stream.
    """
    typed = messages.parse_messages(wire.withColumn("text", F.col("value"))).filter(usable())
    waiting = typed.select(
        "camera", "frame_num", "arrival", fields.class_list(F.col("objs")).alias("classes"), F.col("text").alias("value"))
    marked = reorder.stream_keyframes(waiting, capacity=capacity, idle_ms=idle_ms)
    frames = messages.accepted(messages.parse_messages(
        marked.select(F.col("is_keyframe").alias("changed"), "late", "value")))
    return keyframes.prepare_value(frames, scene_num).withColumn("is_keyframe", F.col("changed")).drop("changed")


def start_live(wire: DataFrame, root: str, checkpoint: str, store_prefix: str, url_prefix: str, capacity: int = 128,
               idle_ms: int = 30_000, trigger: dict | None = None, tmp_prefix: str | None = None,
               valuable: Column | None = None) -> StreamingQuery:
    """Start the query: two shuffles per batch, one by camera and one by statistic key.

    `valuable` says which frames are worth storing (all, if not given); with `tmp_prefix` a manifest of pictures is written too.
    """
    values = live_values(wire, capacity, idle_ms)
    values = values if valuable is None else mark_valuable(values, valuable)
    return sink.sink_stream(values, root, checkpoint, store_prefix, url_prefix, trigger, tmp_prefix)


def start_rejects(wire: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the text of all messages that the tables leave out: unreadable, without a camera or a number of arrival."""
    typed = messages.parse_messages(wire.withColumn("text", F.col("value")))
    rejected = typed.filter(~usable()).select("arrival", F.col("text").alias(messages.REJECT))
    return (rejected.writeStream.format("json").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start(path))
