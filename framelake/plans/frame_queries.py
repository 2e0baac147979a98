"""Queries over frame messages: scalar columns, key frames, statistics and selection."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake import fixed
from framelake.functions import keys, messages, text
from framelake.operators import keyframes, ordered, selection, statistic
from framelake.plans import inputs
from framelake.plans.catalog import query
from framelake.plans.views import TYPES
from framelake.session import scratch_dir
from framelake.sinks import frames as frame_sink
from framelake.sources import messages as message_source
from framelake.sources import tables


def values(spark: SparkSession, sf: str) -> DataFrame:
    return keyframes.prepare_value(inputs.frames(spark, sf))


def marked(spark: SparkSession, sf: str) -> DataFrame:
    return keyframes.mark_keyframes(values(spark, sf), classes=F.col("classes"))


@query("w1_keyframes", "SELECT camera, frame_num, is_keyframe FROM keyframes_v")
def w1_keyframes(spark, sf):
    frames = inputs.frames(spark, sf).select("camera", "frame_num", messages.class_list(F.col("objs")).alias("classes"))
    return keyframes.mark_keyframes(frames, classes=F.col("classes")).select("camera", "frame_num", "is_keyframe")


@query("w2_pair_diff", """
WITH s AS (SELECT f.camera, f.event_id, f.ts_ms, f.ts_ms // 3600000 AS batch,
    coalesce(string_agg(concat_ws(':', o.class_id, o.score, o.x1, o.y1, o.x2, o.y2), ',' ORDER BY o.pos), '') AS sig
  FROM frames_v f LEFT JOIN objects_v o ON o.event_id = f.event_id GROUP BY ALL),
p AS (SELECT *, lead(sig) OVER (PARTITION BY camera, batch ORDER BY ts_ms, event_id) AS nxt FROM s)
SELECT camera, event_id AS frame_num, sig <> nxt AS is_keyframe FROM p WHERE nxt IS NOT NULL""")
def w2_pair_diff(spark, sf):
    frames = inputs.frames(spark, sf).select("camera", "frame_num", "timestamp", "objs")
    return (keyframes.pair_diff_keyframes(frames, batch_seconds=3600)
            .select("camera", "frame_num", "is_keyframe"))


@query("w3_order_frames", """
SELECT camera, frame_num, ts_ms, row_number() OVER (PARTITION BY camera ORDER BY frame_num) - 1 AS pos FROM frames_v""")
def w3_order_frames(spark, sf):
    frames = inputs.frames(spark, sf).select("camera", "frame_num", F.col("timestamp").alias("ts_ms"))
    return ordered.order_frames(ordered.number_rows(frames, ["camera"], ["frame_num"], "pos"))


@query("w4_running_counters", """
WITH c AS (SELECT event_id, count(*) AS n FROM coarse_v GROUP BY event_id)
SELECT k.camera, k.frame_num, count(*) OVER w AS frame_cnt,
  CAST(sum(CASE WHEN k.is_keyframe THEN 1 ELSE 0 END) OVER w AS BIGINT) AS keyframe_cnt,
  CAST(sum(c.n) OVER w AS BIGINT) AS scene_cnt
FROM keyframes_v k JOIN c ON c.event_id = k.event_id WINDOW w AS (PARTITION BY k.camera ORDER BY k.frame_num)""")
def w4_running_counters(spark, sf):
    frames = marked(spark, sf).select("camera", "frame_num", "is_keyframe", "scenes")
    return (keyframes.running_counters(frames)
            .select("camera", "frame_num", "frame_cnt", "keyframe_cnt", "scene_cnt"))


@query("p1_millis_seconds", """
SELECT event_id, epoch_us(ts) // 1000 AS ms, round(epoch_us(ts) / 1e6, 6) AS s FROM events""")
def p1_millis_seconds(spark, sf):
    return inputs.table(spark, sf, "events").select(
        "event_id", keys.millis(F.col("ts")).alias("ms"), F.round(keys.seconds(F.col("ts")), 6).alias("s"))


@query("p2_store_date", "SELECT event_id, store_date FROM frames_v")
def p2_store_date(spark, sf):
    return inputs.frames(spark, sf).select("event_id", keys.store_date(F.col("timestamp")).alias("store_date"))


@query("p3_storage_link", """
SELECT event_id, 'dashcam_' || camera AS dashcam_id, 'store/' || store_date || '/' || camera || '/' || ts_ms || '.jpg' AS store_key,
  'tmp/' || camera || '/' || ts_ms || '.jpg' AS tmp_key,
  'http://store.example.com/bucket/store/' || store_date || '/' || camera || '/' || ts_ms || '.jpg' AS storage_link FROM frames_v""")
def p3_storage_link(spark, sf):
    ms, cam = F.col("timestamp"), F.col("camera")
    key = keys.store_key(inputs.STORE_PREFIX, ms, cam)
    return inputs.frames(spark, sf).select(
        "event_id", keys.dashcam_id(cam).alias("dashcam_id"), key.alias("store_key"),
        keys.tmp_key(inputs.TMP_PREFIX, ms, cam).alias("tmp_key"),
        keys.storage_link(inputs.URL_PREFIX, key).alias("storage_link"))


@query("p4_message_key", "SELECT event_id, camera || '_' || frame_num AS message_key FROM frames_v")
def p4_message_key(spark, sf):
    return inputs.frames(spark, sf).select("event_id", keys.message_key(F.col("camera"), F.col("frame_num")).alias("message_key"))


@query("p5_link_parts", """
SELECT page_id, split_part(url, '/', -1) AS file_name, array_to_string(string_split(url, '/')[5:], '/') AS object_key FROM listing_v""")
def p5_link_parts(spark, sf):
    url = F.col("url")
    return inputs.listing(spark, sf).select("page_id", keys.file_name(url).alias("file_name"),
                                            keys.object_key(url).alias("object_key"))


@query("p6_objects_map", """
SELECT event_id, CAST(pos AS INTEGER) AS tag, name AS class_name, round(x1, 4) AS x1, round(y1, 4) AS y1, round(x2, 4) AS x2, round(y2, 4) AS y2
FROM objects_v""")
def p6_objects_map(spark, sf):
    tags = inputs.frames(spark, sf).select("event_id", F.explode(messages.parse_objects(F.col("objs"))).alias("tag", "o"))
    corner = [F.round(F.col(f"o.{c}").cast("double"), 4).alias(c) for c in ("x1", "y1", "x2", "y2")]
    return tags.select("event_id", "tag", F.col("o.class_name").alias("class_name"), *corner)


@query("p7_object_signature", """
SELECT event_id, concat_ws(',', CASE WHEN n1 > 0 THEN '1:' || n1 END, CASE WHEN n2 > 0 THEN '2:' || n2 END) AS signature,
  CAST(n1 AS INTEGER) AS persons, CAST(n2 AS INTEGER) AS bicycles FROM signatures_v""")
def p7_object_signature(spark, sf):
    counts = messages.object_counts(F.col("objs"))
    return inputs.frames(spark, sf).select(
        "event_id", messages.object_signature(F.col("objs")).alias("signature"),
        F.coalesce(F.try_element_at(counts, F.lit("1")), F.lit(0)).alias("persons"),
        F.coalesce(F.try_element_at(counts, F.lit("2")), F.lit(0)).alias("bicycles"))


@query("p8_top_scenes", """
SELECT f.event_id, string_agg(s.raw_scene, ',' ORDER BY s.pos) AS scenes
FROM frames_v f LEFT JOIN scenes_v s ON s.event_id = f.event_id AND s.pos <= 2 GROUP BY f.event_id""")
def p8_top_scenes(spark, sf):
    return inputs.frames(spark, sf).select(
        "event_id", F.array_join(messages.top_scenes(F.col("scenes"), 2), ",").alias("scenes"))


@query("p8_top_scenes_default", """
SELECT f.event_id, string_agg(s.raw_scene, ',' ORDER BY s.pos) AS scenes
FROM frames_v f LEFT JOIN scenes_v s ON s.event_id = f.event_id AND s.pos <= 5 GROUP BY f.event_id""")
def p8_top_scenes_default(spark, sf):
    return inputs.frames(spark, sf).select("event_id", F.array_join(messages.top_scenes(F.col("scenes")), ",").alias("scenes"))


@query("p9_coarse_scenes", """
SELECT event_id, string_agg(scene_type, ',' ORDER BY scene_type) AS scenes FROM coarse_v GROUP BY event_id""")
def p9_coarse_scenes(spark, sf):
    return inputs.frames(spark, sf).select(
        "event_id", F.array_join(messages.coarse_scenes(messages.top_scenes(F.col("scenes"))), ",").alias("scenes"))


@query("j3_coarse_scenes_table", """
SELECT event_id, string_agg(scene_type, ',' ORDER BY scene_type) AS scenes FROM coarse_v GROUP BY event_id""")
def j3_coarse_scenes_table(spark, sf):
    frames = inputs.frames(spark, sf).select("event_id", messages.top_scenes(F.col("scenes")).alias("scenes"))
    rows = [(raw, kind) for raw, kind in fixed.scene_type_of().items()]
    taxonomy = spark.createDataFrame(rows, "raw_scene string, scene_type string")
    return keyframes.coarse_scenes_by_table(frames, taxonomy, ["event_id"]).select(
        "event_id", F.array_join("scenes", ",").alias("scenes"))


@query("p10_prepare_value", """
SELECT s.event_id, s.n1 + s.n2 AS n_tags, CAST((s.n1 > 0)::INT + (s.n2 > 0)::INT AS INTEGER) AS n_classes, c.scenes, true AS valuable, true AS is_keyframe
FROM signatures_v s JOIN (SELECT event_id, string_agg(scene_type, ',' ORDER BY scene_type) AS scenes FROM coarse_v GROUP BY event_id) c
  ON c.event_id = s.event_id""")
def p10_prepare_value(spark, sf):
    return values(spark, sf).select(
        "event_id", F.coalesce(F.size("objs"), F.lit(0)).cast("long").alias("n_tags"),
        F.size("counts").alias("n_classes"), F.array_join("scenes", ",").alias("scenes"), "valuable", "is_keyframe")


@query("p11_detector_response", """
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE n_obj END AS n_objects, CAST(event_id % 4 AS BIGINT) AS n_scenes FROM frames_v""")
def p11_detector_response(spark, sf):
    frames = inputs.frames(spark, sf)
    link = F.concat(F.lit(inputs.URL_PREFIX), F.col("event_id").cast("string"))
    answered = F.when(F.pmod("event_id", F.lit(10)) == 0, F.lit("{}")).otherwise(
        F.to_json(F.struct(F.map_from_arrays(F.array(link), F.array("objs")).alias("entries"))))
    wire = frames.select("event_id", link.alias("url"), answered.alias("objs"),
                         F.to_json(F.struct(F.col("scenes").alias("predictions"))).alias("scenes"))
    return wire.select("event_id",
                       F.size(messages.object_response(F.col("objs"), F.col("url"))).cast("long").alias("n_objects"),
                       F.size(messages.scene_response(F.col("scenes"))).cast("long").alias("n_scenes"))


@query("s1_read_frame_messages", """
SELECT f.event_id, CASE WHEN f.event_id % 50 = 0 THEN NULL ELSE f.camera END AS camera,
  CASE WHEN f.event_id % 50 = 0 THEN NULL ELSE f.frame_num END AS frame_num,
  CASE WHEN f.event_id % 50 = 0 THEN NULL ELSE f.ts_ms END AS ts_ms,
  CASE WHEN f.event_id % 50 = 0 THEN NULL ELSE f.n_obj END AS n_objects, f.event_id % 50 = 0 AS rejected FROM frames_v f""")
def s1_read_frame_messages(spark, sf):
    frames = inputs.frames(spark, sf)
    body = F.to_json(F.struct("camera", "frame_num", "timestamp", "location", "objs", "scenes"))
    wire = frames.select("event_id", F.when(F.pmod("event_id", F.lit(50)) == 0, F.substring(body, 1, 20)).otherwise(body).alias("value"))
    parsed = message_source.parse_messages(wire)
    return parsed.select("event_id", "camera", "frame_num", F.col("timestamp").alias("ts_ms"),
                         F.size("objs").cast("long").alias("n_objects"), F.col("rejected").isNotNull().alias("rejected"))


@query("p22_millify", """
SELECT o_orderkey, CASE WHEN v = 0 THEN '0' ELSE format('{:.0f}', v / 10.0 ** (3 * i)) || [ '', ' K', ' M', ' B', ' T' ][i + 1] END AS shown
FROM (SELECT *, greatest(0, least(4, CAST(floor(log10(abs(v)) / 3) AS INTEGER))) AS i
  FROM (SELECT o_orderkey, o_totalprice * power(10, o_custkey % 9) / 1000 AS v FROM orders))""")
def p22_millify(spark, sf):
    v = F.col("o_totalprice") * F.pow(F.lit(10.0), F.pmod("o_custkey", F.lit(9))) / 1000
    return inputs.table(spark, sf, "orders").select("o_orderkey", text.millify(v).alias("shown"))


_STATES = ["Alabama", "California", "New York", "Texas", "Washington", "Ontario"]


@query("p23_state_abbrev", """
SELECT c_custkey, CASE c_nationkey % 6 WHEN 0 THEN 'AL' WHEN 1 THEN 'CA' WHEN 2 THEN 'NY' WHEN 3 THEN 'TX' WHEN 4 THEN 'WA' END AS code FROM customer""")
def p23_state_abbrev(spark, sf):
    name = F.get(F.array(*[F.lit(s) for s in _STATES]), F.pmod("c_nationkey", F.lit(6)))
    return inputs.table(spark, sf, "customer").select("c_custkey", text.state_abbrev(name).alias("code"))


_STAT = ["dashcam_id", "store_date", "location", *statistic.COUNTERS]


@query("a1_scene_statistic", f"SELECT {', '.join(_STAT)} FROM statistic_v")
def a1_scene_statistic(spark, sf):
    frames = marked(spark, sf).select("camera", "timestamp", "location", "scenes", "is_keyframe")
    return statistic.scene_statistic(frames)


@query("a2_merge_statistic", f"""
SELECT dashcam_id, store_date, location, {', '.join(f'CAST({c} * CASE WHEN camera % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS {c}' for c in statistic.COUNTERS)} FROM statistic_v""")
def a2_merge_statistic(spark, sf):
    stat = a1_scene_statistic(spark, sf)
    again = stat.filter(F.pmod(F.substring("dashcam_id", 9, 20).cast("long"), F.lit(2)) == 0)
    return statistic.merge_statistic(stat, again)


@query("s4_read_statistic", "SELECT dashcam_id, store_date, location, total, frames FROM statistic_v")
def s4_read_statistic(spark, sf):
    """The statistic table from the catalog, its rows as JSON and back."""
    name = f"statistic_{uuid.uuid4().hex}"
    a1_scene_statistic(spark, sf).write.option("path", f"{scratch_dir(spark)}/{name}").saveAsTable(name)
    rows = tables.rows_as_json(tables.read_statistic(spark, name))
    return tables.rows_from_json(rows, statistic_schema(spark)).select("dashcam_id", "store_date", "location", "total", "frames")


def statistic_schema(spark):
    return ", ".join([f"{k} string" for k in statistic.KEY] + [f"{c} long" for c in statistic.COUNTERS])


@query("f1_valuable_only", "SELECT event_id FROM signatures_v WHERE n1 + n2 > 0")
def f1_valuable_only(spark, sf):
    marked_rows = selection.mark_valuable(values(spark, sf), F.size("objs") > 0)
    return selection.valuable_only(marked_rows).select("event_id")


@query("f2_mark_valuable", "SELECT event_id, n1 + n2 > 0 AS valuable FROM signatures_v")
def f2_mark_valuable(spark, sf):
    return selection.mark_valuable(values(spark, sf), F.size("objs") > 0).select("event_id", "valuable")


@query("f3_diversity_select", """
WITH r AS (SELECT event_id, row_number() OVER (PARTITION BY scene_type ORDER BY event_id * 7919 % 10007, event_id) AS rk FROM coarse_v)
SELECT f.event_id, f.camera, f.event_id IN (SELECT event_id FROM r WHERE rk <= 100) AS valuable FROM frames_v f""")
def f3_diversity_select(spark, sf):
    frames = values(spark, sf).select("event_id", "camera", "scenes")
    pick = [F.pmod(F.col("event_id") * 7919, F.lit(10007)), F.col("event_id")]
    return selection.diversity_select(frames, 100, ["event_id"], pick).select("event_id", "camera", "valuable")


@query("f3_diversity_by_location", """
WITH r AS (SELECT c.event_id, row_number() OVER (PARTITION BY scene_type, location ORDER BY c.event_id * 7919 % 10007, c.event_id) AS rk
  FROM coarse_v c JOIN frames_v f ON f.event_id = c.event_id)
SELECT f.event_id, f.camera, f.event_id IN (SELECT event_id FROM r WHERE rk <= 20) AS valuable FROM frames_v f""")
def f3_diversity_by_location(spark, sf):
    frames = values(spark, sf).select("event_id", "camera", "scenes", "location")
    pick = [F.pmod(F.col("event_id") * 7919, F.lit(10007)), F.col("event_id")]
    return selection.diversity_select(frames, 20, ["event_id"], pick, True).select("event_id", "camera", "valuable")


@query("t2_first_scene", """
SELECT event_id, min_by(raw_scene, pos) AS first_scene FROM scenes_v GROUP BY event_id""")
def t2_first_scene(spark, sf):
    first = F.get(messages.top_scenes(F.col("scenes"), 1), F.lit(0))
    return inputs.frames(spark, sf).select("event_id", first.alias("first_scene")).filter(F.col("first_scene").isNotNull())


@query("t4_distinct_scenes", """
SELECT DISTINCT camera, raw_scene FROM scenes_v""")
def t4_distinct_scenes(spark, sf):
    names = F.array_distinct(F.transform("scenes", lambda s: s["class"]))
    return inputs.frames(spark, sf).select("camera", F.explode(names).alias("raw_scene")).distinct()


@query("sk1_frame_rows", """
SELECT 'dashcam_' || k.camera AS dashcam_id, k.store_date, k.ts_ms AS store_ms, k.is_keyframe,
  'http://store.example.com/bucket/store/' || k.store_date || '/' || k.camera || '/' || k.ts_ms || '.jpg' AS storage_link,
  n1 + n2 AS n_tags, c.scenes, CAST(NULL AS BOOLEAN) AS checked, k.location
FROM keyframes_v k JOIN (SELECT event_id, string_agg(scene_type, ',' ORDER BY scene_type) AS scenes FROM coarse_v GROUP BY event_id) c
  ON c.event_id = k.event_id""")
def sk1_frame_rows(spark, sf):
    rows = frame_sink.frame_rows(marked(spark, sf), inputs.STORE_PREFIX, inputs.URL_PREFIX)
    return rows.select("dashcam_id", "store_date", F.unix_millis("store_time").alias("store_ms"), "is_keyframe", "storage_link",
                       F.coalesce(F.size("obj_tags"), F.lit(0)).cast("long").alias("n_tags"),
                       F.array_join("scenes", ",").alias("scenes"), "checked", "location")


@query("sk2_upsert_frames", """
WITH a AS (SELECT 'dashcam_' || camera AS dashcam_id, store_date, ts_ms AS store_ms, location, 0 AS arrival FROM frames_v
  UNION ALL SELECT 'dashcam_' || camera, store_date, ts_ms, 'moved', event_id + 1 FROM frames_v WHERE event_id % 3 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY dashcam_id, store_date, store_ms ORDER BY arrival DESC) AS rk FROM a)
SELECT dashcam_id, store_date, store_ms, location FROM r WHERE rk = 1""")
def sk2_upsert_frames(spark, sf):
    rows = frame_sink.frame_rows(values(spark, sf), inputs.STORE_PREFIX, inputs.URL_PREFIX, "event_id").select(
        "dashcam_id", "store_date", "store_time", "location", "event_id")
    old = rows.drop("event_id").withColumn("arrival", F.lit(0).cast("long"))
    new = (rows.filter(F.pmod("event_id", F.lit(3)) == 0).withColumn("location", F.lit("moved"))
           .withColumn("arrival", F.col("event_id") + 1).drop("event_id"))
    return frame_sink.upsert_frames(old, new).select("dashcam_id", "store_date", F.unix_millis("store_time").alias("store_ms"), "location")


@query("sk5_route", """
SELECT 'obj_' || camera AS topic, count(*) AS n FROM frames_v GROUP BY camera""")
def sk5_route(spark, sf):
    return frame_sink.route(inputs.frames(spark, sf)).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("sk5_topic_rows", """
SELECT 'obj_' || camera AS topic, camera || '_' || frame_num AS key, '{"camera":' || camera || ',"frame_num":' || frame_num || '}' AS value FROM frames_v""")
def sk5_topic_rows(spark, sf):
    return frame_sink.topic_rows(frame_sink.route(inputs.frames(spark, sf).select("camera", "frame_num")))


@query("sk6_librarian", """
SELECT f.event_id, CASE WHEN n1 + n2 > 0 THEN 'archive' ELSE 'delete' END AS action,
  CASE WHEN n1 + n2 > 0 THEN 'store/' || store_date || '/' || camera || '/' || ts_ms || '.jpg' ELSE 'tmp/' || camera || '/' || ts_ms || '.jpg' END AS key
FROM signatures_v f""")
def sk6_librarian(spark, sf):
    rows = selection.mark_valuable(values(spark, sf), F.size("objs") > 0)
    return frame_sink.librarian(rows, inputs.STORE_PREFIX, inputs.TMP_PREFIX).select("event_id", "action", "key")


@query("sk7_partition_by_key", """
SELECT camera, count(*) AS n, 1::BIGINT AS n_partitions, true AS keys_are_whole FROM frames_v GROUP BY camera""")
def sk7_partition_by_key(spark, sf):
    """Where the rows of a camera, and of a message key, have gone."""
    rows = inputs.frames(spark, sf).select("camera", "frame_num")
    at = F.spark_partition_id().alias("at")
    cameras = (frame_sink.partition_by_key(rows, 16, "camera").select("camera", at).groupBy("camera")
               .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("at").alias("n_partitions")))
    keys = (frame_sink.partition_by_key(rows, 16, "frame").select("camera", "frame_num", at).groupBy("camera", "frame_num")
            .agg(F.count_distinct("at").alias("parts")).groupBy("camera").agg((F.max("parts") == 1).alias("keys_are_whole")))
    return cameras.join(keys, "camera")


@query("d7_merge_tags", """
WITH old AS (SELECT event_id, CAST(pos AS INTEGER) AS tag, name FROM objects_v),
new AS (SELECT event_id, CAST(t.tag AS INTEGER) AS tag, 'reviewed' AS name FROM frames_v, (SELECT 2 AS tag UNION ALL SELECT 3) t WHERE event_id % 4 = 0)
SELECT coalesce(o.event_id, n.event_id) AS event_id, coalesce(o.tag, n.tag) AS tag, coalesce(n.name, o.name) AS class_name
FROM old o FULL JOIN new n ON n.event_id = o.event_id AND n.tag = o.tag""")
def d7_merge_tags(spark, sf):
    from framelake.operators import detections
    old = values(spark, sf).select("event_id", F.col("objs").alias("obj_tags"))
    tag = lambda i: F.struct(F.lit(i).alias("key"), F.struct(
        F.lit("reviewed").alias("class_name"), *[F.lit(0.0).cast("float").alias(c) for c in ("x1", "y1", "x2", "y2")]).alias("value"))
    new = inputs.frames(spark, sf).filter(F.pmod("event_id", F.lit(4)) == 0).select(
        "event_id", F.map_from_entries(F.array(tag(2), tag(3))).alias("obj_tags"))
    merged = detections.merge_obj_tags(old, new, ["event_id"])
    return merged.select("event_id", F.explode("obj_tags").alias("tag", "o")).select(
        "event_id", "tag", F.col("o.class_name").alias("class_name"))


@query("d8_mark_checked", """
SELECT f.event_id, CASE WHEN f.event_id % 5 = 0 THEN f.event_id % 10 = 0 END AS checked FROM frames_v f""")
def d8_mark_checked(spark, sf):
    from framelake.operators import detections
    frames = inputs.frames(spark, sf).select("event_id").withColumn("checked", F.lit(None).cast("boolean"))
    reviewed = inputs.frames(spark, sf).filter(F.pmod("event_id", F.lit(5)) == 0).select(
        "event_id", (F.pmod("event_id", F.lit(10)) == 0).alias("checked"))
    return detections.mark_checked(frames, reviewed, ["event_id"]).select("event_id", "checked")
