"""Queries whose rows come out of a stream over the given tables."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions import messages
from framelake.operators import keyframes, statistic
from framelake.plans import box_queries, inputs, live
from framelake.plans.catalog import query
from framelake.plans.views import TYPES
from framelake.session import scratch_dir, stored
from framelake.sinks import stream as stream_sink
from framelake.sources import messages as source
from framelake.streaming import diversity, reorder, tracks, windows


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = inputs.table(spark, sf, "events").schema
    return inputs.frame_columns(spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet"))


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the shared scratch folder; Spark makes it when it writes there."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def finished(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there and return the table it wrote."""
    spark = stream.sparkSession
    running = (stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint")
               .trigger(availableNow=True).start(f"{folder}/table"))
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


#: Frames come up to 63 numbers late; the last bits keep arrivals apart.
_ARRIVAL = "(event_id + event_id * 7919 % 64) * 4096 + event_id % 4096"
#: Frames come in an order that has nothing to do with their numbers: a camera's first may be its last to arrive.
_SCRAMBLED = "event_id * 1327217885 % 2147483648"


def whole_camera(spark: SparkSession, sf: str) -> int:
    """The capacity of a buffer that holds all frames of any one camera of the table."""
    longest = inputs.frames(spark, sf).groupBy("camera").count().agg(F.max("count")).first()[0]
    return (longest or 0) + 1


def _arrivals(spark: SparkSession, sf: str, folder: str, *more, order: str = _SCRAMBLED) -> DataFrame:
    """Frames that arrive in scrambled order, and after them an end mark for every camera."""
    frames = event_stream(spark, sf).select("camera", "frame_num", F.expr(order).alias("arrival"), *more)
    marks = inputs.frames(spark, sf).select("camera").distinct().select(
        "camera", *[F.lit(None).cast(f.dataType).alias(f.name) for f in frames.schema if f.name != "camera"])
    marks.withColumn("arrival", F.lit(1 << 60)).write.parquet(f"{folder}/marks")
    return frames.unionByName(spark.readStream.schema(frames.schema).parquet(f"{folder}/marks"))


@query("st1_reorder", f"SELECT camera, frame_num, {_SCRAMBLED} AS arrival, false AS late FROM frames_v")
def st1_reorder(spark, sf):
    """A buffer that holds all frames of a camera restores their order: none is late."""
    folder = run_folder(spark, "reorder")
    return finished(reorder.reorder(_arrivals(spark, sf, folder), capacity=whole_camera(spark, sf), idle_ms=0), folder)


@query("st9_late", f"""
WITH a AS (SELECT camera, frame_num, {_ARRIVAL} AS arrival FROM frames_v),
held AS (SELECT camera, arrival, frame_num, max(frame_num) OVER (PARTITION BY camera ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
  max(frame_num) OVER (PARTITION BY camera) AS last FROM a),
gone AS (SELECT camera, arrival, least(frame_num, before) AS frame_num FROM held WHERE before IS NOT NULL UNION ALL SELECT DISTINCT camera, 1152921504606846976, last FROM held)
SELECT camera, frame_num, coalesce(frame_num < max(frame_num) OVER (PARTITION BY camera ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late FROM gone""")
def st9_late(spark, sf):
    """A buffer that holds one frame lets the lower of two go; what goes after a higher one is late."""
    folder = run_folder(spark, "late")
    return finished(reorder.reorder(_arrivals(spark, sf, folder, order=_ARRIVAL), capacity=2, idle_ms=0), folder).select("camera", "frame_num", "late")


@query("st2_stream_keyframes", "SELECT camera, frame_num, is_keyframe FROM keyframes_v")
def st2_stream_keyframes(spark, sf):
    """Key frames of cameras whose frames arrive in scrambled order."""
    folder = run_folder(spark, "keyframes")
    rows = _arrivals(spark, sf, folder, messages.class_list(F.col("objs")).alias("classes"))
    return finished(reorder.stream_keyframes(rows, capacity=whole_camera(spark, sf), idle_ms=0), folder).select("camera", "frame_num", "is_keyframe")


@query("w2_stream", """
WITH s AS (SELECT f.camera, f.event_id, f.ts_ms, f.ts_ms // 3600000 AS batch,
    coalesce(string_agg(concat_ws(':', o.class_id, o.score, o.x1, o.y1, o.x2, o.y2), ',' ORDER BY o.pos), '') AS sig
  FROM frames_v f LEFT JOIN objects_v o ON o.event_id = f.event_id GROUP BY ALL),
p AS (SELECT *, lead(sig) OVER (PARTITION BY camera ORDER BY event_id) AS nxt, lead(batch) OVER (PARTITION BY camera ORDER BY event_id) AS next_batch FROM s)
SELECT camera, event_id AS frame_num, sig <> nxt AS is_keyframe FROM p WHERE batch = next_batch""")
def w2_stream(spark, sf):
    """Pair differences of cameras whose frames arrive in scrambled order."""
    folder = run_folder(spark, "pairs")
    rows = _arrivals(spark, sf, folder, "timestamp", "objs")
    return finished(reorder.stream_pair_diff(rows, batch_seconds=3600, capacity=whole_camera(spark, sf), idle_ms=0), folder).select("camera", "frame_num", "is_keyframe")


@query("d9_stream", box_queries._ISLANDS + "SELECT *, false AS late FROM shown")
def d9_stream(spark, sf):
    """Tracks of boxes that arrive scrambled, by a stream that is stopped half-way and started again."""
    folder = run_folder(spark, "tracks")
    dets = stored(box_queries._followed(spark, sf), "boxes").withColumn(
        "arrival", F.col("frame_num") % 20 + F.pmod(F.xxhash64("camera", "frame_num", "det_id"), F.lit(6)))
    marks = dets.select("camera", "video_id").distinct()
    for half in range(2):
        part = dets.filter((F.col("arrival") >= 11) == bool(half)).drop("arrival")
        part = part if half == 0 else part.unionByName(marks, allowMissingColumns=True)
        part.write.mode("append").parquet(f"{folder}/boxes")
        stream = tracks.stream_tracks(spark.readStream.schema(part.schema).parquet(f"{folder}/boxes"), idle_ms=0)
        out = finished(stream, folder)
    return out.select("camera", "video_id", "frame_num", "track_id", "class_id", "late")


def _diverse(spark, sf, cap, by_location):
    """Frames in two parts, of which a stream takes the second after it was stopped and started again."""
    folder = run_folder(spark, "diverse")
    values = keyframes.prepare_value(inputs.frames(spark, sf)).select("event_id", "camera", "location", "scenes")
    pick = [F.pmod(F.col("event_id") * 7919, F.lit(10007))]
    for part in (1, 0):
        values.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part).write.mode("append").parquet(f"{folder}/in")
        rows = spark.readStream.schema(values.schema).parquet(f"{folder}/in")
        changes = finished(diversity.stream_diversity(rows, cap, ["event_id"], pick, by_location), folder)
    chosen = diversity.valuable_frames(changes, ["event_id"]).withColumn("_valuable", F.lit(True))
    return values.join(chosen, "event_id", "left").select("event_id", "camera", F.coalesce("_valuable", F.lit(False)).alias("valuable"))


@query("f3_stream", """
WITH r AS (SELECT event_id, row_number() OVER (PARTITION BY scene_type ORDER BY event_id * 7919 % 10007, event_id) AS rk FROM coarse_v)
SELECT f.event_id, f.camera, f.event_id IN (SELECT event_id FROM r WHERE rk <= 100) AS valuable FROM frames_v f""")
def f3_stream(spark, sf):
    return _diverse(spark, sf, 100, False)


@query("f3_stream_by_location", """
WITH r AS (SELECT c.event_id, row_number() OVER (PARTITION BY scene_type, location ORDER BY c.event_id * 7919 % 10007, c.event_id) AS rk
  FROM coarse_v c JOIN frames_v f ON f.event_id = c.event_id)
SELECT f.event_id, f.camera, f.event_id IN (SELECT event_id FROM r WHERE rk <= 20) AS valuable FROM frames_v f""")
def f3_stream_by_location(spark, sf):
    return _diverse(spark, sf, 20, True)


def _message_files(spark: SparkSession, sf: str, folder: str, order: str = _SCRAMBLED) -> str:
    """Frames as lines of JSON in scrambled order with their numbers of arrival, and an end mark for every camera."""
    frames = inputs.frames(spark, sf)
    body = ["camera", "frame_num", "timestamp", "location", "objs", "scenes", F.expr(order).alias("arrival")]
    lines = frames.select(F.to_json(F.struct(*body)).alias("value"))
    marks = frames.select("camera").distinct().select(F.to_json(F.struct("camera", F.lit(1 << 60).alias("arrival"))).alias("value"))
    lines.unionByName(marks).write.text(f"{folder}/wire")
    return f"{folder}/wire"


@query("s2_stream_messages", f"SELECT camera, frame_num, {_ARRIVAL} AS arrival, n_obj FROM frames_v")
def s2_stream_messages(spark, sf):
    folder = run_folder(spark, "messages")
    typed = source.accepted(source.stream_messages(spark, _message_files(spark, sf, folder, _ARRIVAL)))
    frames = typed.filter("frame_num is not null").select(
        "camera", "frame_num", "arrival", F.coalesce(F.array_size("objs"), F.lit(0)).cast("long").alias("n_obj"))
    return finished(frames, folder)


@query("e1_live_statistic", f"SELECT dashcam_id, store_date, location, frames, keyframes, total, {', '.join(TYPES)} FROM statistic_v")
def e1_live_statistic(spark, sf):
    """Messages of scrambled cameras through the live query to all counters of the statistic table."""
    folder = run_folder(spark, "live")
    wire = source.stream_wire(spark, _message_files(spark, sf, folder))
    live.start_live(wire, folder, f"{folder}/checkpoint", inputs.STORE_PREFIX, inputs.URL_PREFIX, whole_camera(spark, sf), 0, {"availableNow": True}).awaitTermination()
    return stream_sink.read_statistic(spark, folder).select("dashcam_id", "store_date", "location", "frames", "keyframes", "total", *TYPES)


@query("sk6_live", """
SELECT CASE WHEN n1 + n2 > 0 THEN 'archive' ELSE 'delete' END AS action,
  CASE WHEN n1 + n2 > 0 THEN 'store/' || store_date || '/' || camera || '/' || ts_ms || '.jpg' ELSE 'tmp/' || camera || '/' || ts_ms || '.jpg' END AS key
FROM signatures_v""")
def sk6_live(spark, sf):
    """The manifest that the live query writes, with frames without objects not worth storing."""
    folder = run_folder(spark, "live")
    wire = source.stream_wire(spark, _message_files(spark, sf, folder))
    live.start_live(wire, folder, f"{folder}/checkpoint", inputs.STORE_PREFIX, inputs.URL_PREFIX, whole_camera(spark, sf), 0, {"availableNow": True},
                    inputs.TMP_PREFIX, F.size("objs") > 0).awaitTermination()
    return stream_sink.read_manifest(spark, folder).select("action", "key")


_PERIODS = ", ".join(f"CAST(sum(CASE WHEN scene_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS {t}" for t in TYPES)
_ROLLING = f"""
WITH f AS (SELECT k.*, ts_ms // 10000 * 10000 AS period_ms FROM keyframes_v k),
s AS (SELECT camera, {{by}}, period_ms, {_PERIODS}, count(*) AS total FROM {{f}} JOIN coarse_v c USING (camera, event_id) GROUP BY ALL),
n AS (SELECT camera, {{by}}, period_ms, count(*) AS frames, CAST(sum(is_keyframe::INT) AS BIGINT) AS keyframes FROM {{f}} GROUP BY ALL)
SELECT 'dashcam_' || camera AS dashcam_id, store_date, location, period_ms, frames, keyframes, total, {", ".join(TYPES)} FROM s JOIN n USING (camera, {{by}}, period_ms)"""


def _marked(spark, sf):
    return keyframes.mark_keyframes(keyframes.prepare_value(inputs.frames(spark, sf)), classes=F.col("classes"))


def _with_millis(df):
    return df.withColumn("period_ms", F.unix_millis("period_start")).drop("period_start")


@query("st4_rolling_statistic", _ROLLING.format(by="store_date, location", f="f"))
def st4_rolling_statistic(spark, sf):
    return _with_millis(windows.rolling_statistic(_marked(spark, sf)))


@query("st4_stream", _ROLLING.format(by="store_date, location", f="f"))
def st4_stream(spark, sf):
    """All periods of a stream, those open at its end by the final flush."""
    folder = run_folder(spark, "periods")
    stored(_marked(spark, sf).select("camera", "timestamp", "location", "scenes", "is_keyframe"), "marked").write.parquet(f"{folder}/in")
    schema = spark.read.parquet(f"{folder}/in").schema
    marks = inputs.frames(spark, sf).select("camera").distinct()
    marks.select("camera", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name != "camera"]).write.mode("append").parquet(f"{folder}/in")
    return _with_millis(finished(windows.flushed_statistic(spark.readStream.schema(schema).parquet(f"{folder}/in")), folder))


@query("st4_rolling_statistic_flush", _ROLLING.replace("ts_ms // 10000 * 10000 AS period_ms FROM keyframes_v k)", """period_ms FROM
  (SELECT k.* EXCLUDE (store_date, location), ts_ms // 86400000 * 86400000 AS period_ms,
     last_value(store_date) OVER w AS store_date, last_value(location) OVER w AS location FROM keyframes_v k
   WINDOW w AS (PARTITION BY camera, ts_ms // 86400000 ORDER BY ts_ms, frame_num ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) k)""")
       .format(by="store_date, location", f="f"))
def st4_rolling_statistic_flush(spark, sf):
    return _with_millis(windows.rolling_statistic(_marked(spark, sf), "1 day", attribution="flush"))


@query("st3_throughput_stream", """
SELECT 'dashcam_' || camera AS dashcam_id, ts_ms // 60000 * 60000 AS record_ms, CAST(count(*) AS DOUBLE) AS size FROM frames_v GROUP BY 1, 2""")
def st3_throughput_stream(spark, sf):
    counted = windows.throughput(event_stream(spark, sf))
    folder = run_folder(spark, "throughput")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/table/batch_id={batch_id}")

    # update mode sends every window that changed; the last version of a window is its final count
    (counted.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{folder}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    log = spark.read.parquet(f"{folder}/table")
    final = log.groupBy("dashcam_id", "record_time").agg(F.max_by("size", "batch_id").alias("size"))
    return final.select("dashcam_id", F.unix_millis("record_time").alias("record_ms"), F.col("size").cast("double").alias("size"))


@query("sk3_sink_stream", """
SELECT dashcam_id, store_date, location, frames, total, street, downtown FROM statistic_v""")
def sk3_sink_stream(spark, sf):
    values = keyframes.prepare_value(event_stream(spark, sf))
    folder = run_folder(spark, "sink")
    stream_sink.sink_stream(values, folder, f"{folder}/checkpoint", inputs.STORE_PREFIX, inputs.URL_PREFIX,
                            {"availableNow": True}).awaitTermination()
    return stream_sink.read_statistic(spark, folder).select("dashcam_id", "store_date", "location", "frames", "total", "street", "downtown")


@query("sk3_sink_stream_frames", """
SELECT 'dashcam_' || camera AS dashcam_id, store_date, ts_ms AS store_ms, location FROM frames_v
QUALIFY row_number() OVER (PARTITION BY camera, ts_ms ORDER BY event_id DESC) = 1""")
def sk3_sink_stream_frames(spark, sf):
    values = keyframes.prepare_value(event_stream(spark, sf))
    folder = run_folder(spark, "sink")
    stream_sink.sink_stream(values, folder, f"{folder}/checkpoint", inputs.STORE_PREFIX, inputs.URL_PREFIX,
                            {"availableNow": True}).awaitTermination()
    return stream_sink.read_frames(spark, folder).select("dashcam_id", "store_date", F.unix_millis("store_time").alias("store_ms"), "location")


@query("sk3_snapshot", """
SELECT 'dashcam_' || camera AS dashcam_id, store_date, location, count(*) AS frames, false AS shows_failed FROM frames_v WHERE event_id % 3 < 2 GROUP BY ALL""")
def sk3_snapshot(spark, sf):
    """The tables as of the second of three batches, and after a batch that failed between two tables."""
    values = keyframes.prepare_value(inputs.frames(spark, sf))
    folder = run_folder(spark, "sink")
    writer = stream_sink.write_batch(folder, inputs.STORE_PREFIX, inputs.URL_PREFIX)
    for batch in range(3):
        writer(values.filter(F.pmod("event_id", F.lit(3)) == batch), batch)
    lost = statistic.scene_statistic(values).withColumn("dashcam_id", F.lit("dashcam_x"))
    lost.write.parquet(f"{folder}/statistic/batch_id=9")  # as a batch that failed after this table leaves it
    failed = not stream_sink.read_statistic(spark, folder).filter("dashcam_id = 'dashcam_x'").isEmpty()
    rows = stream_sink.read_statistic(spark, folder, upto=1)
    return rows.select("dashcam_id", "store_date", "location", "frames", F.lit(failed).alias("shows_failed"))


@query("st5_microbatch_counts", "SELECT count(*) AS n FROM events")
def st5_microbatch_counts(spark, sf):
    """Frames of all micro-batches, as a listener has counted them."""
    listener = windows.CountListener("st5")
    spark.streams.addListener(listener)
    try:
        finished(windows.microbatch_counts(event_stream(spark, sf).select("camera", "frame_num"), "st5"), run_folder(spark, "counted"))
        waited = 0
        while not listener.counts and waited < 100:  # events reach listeners a little later
            time.sleep(0.1)
            waited += 1
    finally:
        spark.streams.removeListener(listener)
    return spark.createDataFrame(listener.counts, "batch long, n long").agg(F.sum("n").alias("n"))
