"""Queries over listings, places, the statistic table and monitoring counters."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from framelake.functions import keys
from framelake.operators import dashboards, locate, monitoring, ordered, sampling, selection
from framelake.plans import inputs
from framelake.plans.catalog import query
from framelake.plans.frame_queries import a1_scene_statistic
from framelake.plans.views import TYPES
from framelake.session import scratch_dir, stored
from framelake.sources import files


def _r(col, name, digits=6):
    return F.round(col, digits).alias(name)


@query("s6_pending", "SELECT url FROM listing_v WHERE url NOT LIKE '%txt' AND url NOT IN (SELECT url FROM ledger_v)")
def s6_pending(spark, sf):
    return sampling.pending_videos(inputs.listing(spark, sf).select("url"), inputs.ledger(spark, sf))


@query("sk8_advance_ledger", "SELECT url FROM ledger_v UNION SELECT url FROM listing_v WHERE page_id % 2 = 0")
def sk8_advance_ledger(spark, sf):
    return sampling.advance_ledger(inputs.ledger(spark, sf), inputs.listing(spark, sf).filter(F.pmod("page_id", F.lit(2)) == 0))


@query("p14_round_robin", """
WITH p AS (SELECT url, row_number() OVER (ORDER BY url) - 1 AS position FROM listing_v)
SELECT position, position % 100 AS user_id, url AS video_key,
  'dataset/cars/user_' || position % 100 || '/videos/' || split_part(url, '/', -1) AS target_video_key,
  'dataset/info/' || split_part(split_part(url, '/', -1), '.', 1) || '.json' AS info_key,
  'dataset/cars/user_' || position % 100 || '/info/' || split_part(split_part(url, '/', -1), '.', 1) || '.json' AS target_info_key,
  'dataset/frame-10s/' || split_part(split_part(url, '/', -1), '.', 1) || '.jpg' AS thumb_key,
  'dataset/cars/user_' || position % 100 || '/frame-10s/' || split_part(split_part(url, '/', -1), '.', 1) || '.jpg' AS target_thumb_key
FROM p""")
def p14_round_robin(spark, sf):
    return sampling.assign_round_robin(inputs.listing(spark, sf), "dataset/", "dataset/cars/", 100, "url")


@query("t3_global_sort", "SELECT page_id, url FROM listing_v ORDER BY url, page_id")
def t3_global_sort(spark, sf):
    return inputs.listing(spark, sf).orderBy("url", "page_id")


def _video_frames(spark, sf):
    """Frames of each camera in videos of twenty frames."""
    frames = inputs.frames(spark, sf).select("camera", "event_id")
    dense = ordered.number_rows(frames, ["camera"], ["event_id"], "pos")
    return dense.select("camera", "event_id", F.floor(F.col("pos") / 20).cast("long").alias("video_id"),
                        F.pmod("pos", F.lit(20)).alias("frame_idx"))


_VIDEO_FRAMES = """
WITH vf AS (SELECT camera, event_id, pos // 20 AS video_id, pos % 20 AS frame_idx
  FROM (SELECT camera, event_id, row_number() OVER (PARTITION BY camera ORDER BY event_id) - 1 AS pos FROM frames_v))"""


@query("p13_sample_per_video", _VIDEO_FRAMES + """
SELECT camera, event_id, video_id, frame_idx FROM vf WHERE frame_idx % 4 = 3""")
def p13_sample_per_video(spark, sf):
    return sampling.sample_frames(_video_frames(spark, sf), 3)


@query("p13_sample", _VIDEO_FRAMES + """,
v AS (SELECT camera, video_id, count(*) AS n FROM vf GROUP BY camera, video_id),
ph AS (SELECT camera, video_id, n, CAST(0 AS BIGINT) AS c FROM v WHERE video_id = 0
  UNION ALL SELECT v.camera, v.video_id, v.n, CASE WHEN (ph.c + ph.n) % 6 = 5 THEN 5 ELSE (ph.c + ph.n + 1) % 6 END
  FROM ph JOIN v ON v.camera = ph.camera AND v.video_id = ph.video_id + 1)
SELECT vf.camera, vf.event_id, vf.video_id, vf.frame_idx FROM vf JOIN ph ON ph.camera = vf.camera AND ph.video_id = vf.video_id
WHERE (ph.c + vf.frame_idx) % 6 = 5""", recursive=True)
def p13_sample(spark, sf):
    frames = _video_frames(spark, sf)
    videos = frames.groupBy("camera", "video_id").agg(F.count(F.lit(1)).alias("n_frames"))
    return sampling.sample_frames(frames, 5, videos).select("camera", "event_id", "video_id", "frame_idx")


@query("p13_sample_empty", _VIDEO_FRAMES + """,
w AS (SELECT * FROM vf WHERE video_id % 3 <> 1),
v AS (SELECT camera, video_id, count(*) FILTER (video_id % 3 <> 1) AS n FROM vf GROUP BY camera, video_id),
ph AS (SELECT camera, video_id, n, CAST(0 AS BIGINT) AS c FROM v WHERE video_id = 0
  UNION ALL SELECT v.camera, v.video_id, v.n, CASE WHEN (ph.c + ph.n) % 6 = 5 THEN 5 ELSE (ph.c + ph.n + 1) % 6 END
  FROM ph JOIN v ON v.camera = ph.camera AND v.video_id = ph.video_id + 1)
SELECT camera, video_id, n AS n_frames, ph.c AS phase, count(w.event_id) FILTER ((ph.c + w.frame_idx) % 6 = 5) AS n_kept
FROM ph LEFT JOIN w USING (camera, video_id) GROUP BY ALL""", recursive=True)
def p13_sample_empty(spark, sf):
    """Every third video has lost its frames; it still costs a read."""
    every = _video_frames(spark, sf)
    frames = every.filter(F.pmod("video_id", F.lit(3)) != 1)
    videos = every.groupBy("camera", "video_id").agg(F.count_if(F.pmod("video_id", F.lit(3)) != 1).alias("n_frames"))
    kept = sampling.sample_frames(frames, 5, videos).groupBy("camera", "video_id").agg(F.count(F.lit(1)).alias("n_kept"))
    phases = sampling.video_phases(videos, 5)
    return (phases.join(kept, ["camera", "video_id"], "left")
            .select("camera", "video_id", "n_frames", "phase", F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept")))


_LOCATED = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY area, region) AS rk FROM (
  SELECT p.event_id, p.lat, p.lon, r.region, (lat_hi - lat_lo) * (lon_hi - lon_lo) AS area
  FROM points_v p LEFT JOIN regions_v r ON p.lat >= r.lat_lo AND p.lat < r.lat_hi AND p.lon >= r.lon_lo AND p.lon < r.lon_hi))
SELECT event_id, CASE WHEN lat IS NULL OR lon IS NULL THEN 'Unknown' ELSE coalesce(region, 'Oversea') END AS location FROM r WHERE rk = 1"""


@query("j2_locate", _LOCATED)
def j2_locate(spark, sf):
    return locate.locate(inputs.points(spark, sf), inputs.regions(spark, sf)).select("event_id", "location")


@query("j2_attach_location", _LOCATED)
def j2_attach_location(spark, sf):
    name = F.concat(F.lit("video"), F.col("event_id").cast("string"))
    videos = inputs.points(spark, sf).select("event_id", F.concat(F.lit("http://h/b/v/"), name, F.lit(".mov")).alias("url"))
    info = inputs.points(spark, sf).filter(F.col("lat").isNotNull()).select(
        name.alias("stem"), F.to_json(F.struct(F.array(F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))).alias("locations"))).alias("value"))
    return locate.attach_location(videos, files.sidecar_positions(info, "stem"), inputs.regions(spark, sf)).select("event_id", "location")


@query("j2_locate_mixed", """
WITH m AS (SELECT region, lat_lo, lat_hi, lon_lo, lon_hi FROM regions_v UNION ALL
  SELECT 'w' || n_nationkey, -90 + n_nationkey, n_nationkey, -180 + 2 * n_nationkey, -90 + 2 * n_nationkey FROM nation UNION ALL
  SELECT 's' || event_id, lat - 0.005, lat + 0.005, lon - 0.005, lon + 0.005 FROM points_v WHERE event_id % 97 = 1)
SELECT event_id, CASE WHEN lat IS NULL THEN 'Unknown' ELSE coalesce(arg_min(region, (area, region)), 'Oversea') END AS location
FROM points_v p LEFT JOIN (SELECT *, CAST((lat_hi - lat_lo) * (lon_hi - lon_lo) AS DOUBLE) AS area FROM m) m
  ON p.lat >= m.lat_lo AND p.lat < m.lat_hi AND p.lon >= m.lon_lo AND p.lon < m.lon_hi GROUP BY event_id, lat""")
def j2_locate_mixed(spark, sf):
    """Regions from 0.01 to 90 degrees together."""
    n, edges = F.col("n_nationkey"), ("lat_lo", "lat_hi", "lon_lo", "lon_hi")
    wide = inputs.table(spark, sf, "nation").select(F.concat(F.lit("w"), n.cast("string")).alias("region"), *[
        v.cast("double").alias(c) for c, v in zip(edges, (n - 90, n, 2 * n - 180, 2 * n - 90))])
    spots = inputs.points(spark, sf).filter("event_id % 97 = 1").select(F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("region"), *[
        v.alias(c) for c, v in zip(edges, (F.col("lat") - 0.005, F.col("lat") + 0.005, F.col("lon") - 0.005, F.col("lon") + 0.005))])
    regions = inputs.regions(spark, sf).unionByName(wide).unionByName(spots.filter("lat_lo is not null"))
    return locate.locate(inputs.points(spark, sf), regions).select("event_id", "location")


@query("s7_sidecar", "SELECT event_id, lat, lon FROM points_v")
def s7_sidecar(spark, sf):
    place = F.when(F.col("lat").isNotNull(), F.array(F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))))
    info = inputs.points(spark, sf).select("event_id", F.to_json(F.struct(place.alias("locations"))).alias("value"))
    return files.sidecar_positions(info, "event_id")


@query("a3_coverage", """
SELECT count(DISTINCT location) AS locations, count(DISTINCT dashcam_id) AS cameras, count(DISTINCT store_date) AS dates FROM statistic_v""")
def a3_coverage(spark, sf):
    return dashboards.coverage(a1_scene_statistic(spark, sf))


@query("a3_coverage_sketches", """
WITH d AS (SELECT store_date[1:6] AS month, count(DISTINCT camera) AS cameras, count(DISTINCT location) AS locations FROM frames_v GROUP BY 1)
SELECT month, cameras // 10 AS cameras_tens, locations, true AS cameras_close FROM d""")
def a3_coverage_sketches(spark, sf):
    """Monthly coverage rolled up from stored daily sketches, beside the exact one: within two per cent."""
    frames = inputs.frames(spark, sf).withColumn("store_date", keys.store_date(F.col("timestamp")))
    days = stored(dashboards.daily_sketches(frames, "camera", "location"), "sketches")
    month = F.substring("store_date", 1, 6)
    about = dashboards.merged_coverage(days.withColumn("month", month), "camera", "location", by="month")
    exact = frames.groupBy(month.alias("month")).agg(F.count_distinct("camera").alias("cameras"))
    close = F.abs(F.col("camera") - F.col("cameras")) <= F.ceil(0.02 * F.col("cameras"))
    return about.join(exact, "month").select("month", F.floor(F.col("cameras") / 10).cast("long").alias("cameras_tens"),
                                             F.col("location").cast("long").alias("locations"), close.alias("cameras_close"))


@query("a4_cameras_by_location", "SELECT location, count(dashcam_id) AS cameras FROM statistic_v GROUP BY location")
def a4_cameras_by_location(spark, sf):
    return dashboards.cameras_by_location(a1_scene_statistic(spark, sf))


@query("a5_scene_share", "SELECT scene_type, round(100.0 * n / total, 6) AS percent FROM (SELECT "
       + ", ".join(f"CAST(sum({t}) AS DOUBLE) AS {t}" for t in TYPES)
       + ", CAST(sum(total) AS DOUBLE) AS total FROM statistic_v) UNPIVOT (n FOR scene_type IN (" + ", ".join(TYPES) + "))")
def a5_scene_share(spark, sf):
    return dashboards.scene_share(a1_scene_statistic(spark, sf)).select("scene_type", _r(F.col("percent"), "percent"))


@query("a6_keyframe_ratio", """
SELECT dashcam_id, store_date, location, frames, keyframes, round(100.0 * keyframes / frames, 6) AS keyframe_percent FROM statistic_v""")
def a6_keyframe_ratio(spark, sf):
    out = dashboards.keyframe_ratio(a1_scene_statistic(spark, sf))
    return out.withColumn("keyframe_percent", F.round("keyframe_percent", 6))


@query("f5_day_filter", "SELECT dashcam_id, location, frames, keyframes FROM statistic_v WHERE store_date = '20240110'")
def f5_day_filter(spark, sf):
    return selection.day_filter(a1_scene_statistic(spark, sf), "2024-01-15", 5).select("dashcam_id", "location", "frames", "keyframes")


def _bucket_sql(label, step, first):
    return f"""
WITH c AS (SELECT {label} AS bucket, count(*) AS n FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'F') GROUP BY 1),
s AS (SELECT unnest(generate_series({first}, max(bucket), INTERVAL {step})) AS g FROM c),
b AS (SELECT {'last_day(CAST(g AS DATE))' if 'MONTH' in step else 'CAST(g AS DATE)'} AS bucket FROM s)
SELECT b.bucket, coalesce(c.n, 0) AS n FROM b LEFT JOIN c ON c.bucket = b.bucket"""


def _converted(spark, sf, freq):
    return dashboards.bucketed_count(inputs.table(spark, sf, "orders"), "o_orderdate", freq, F.col("o_orderstatus") == "F")


@query("a7_bucketed_count_day", _bucket_sql("d", "1 DAY", "min(bucket)"))
def a7_bucketed_count_day(spark, sf):
    return _converted(spark, sf, "D")


@query("a7_bucketed_count_week", _bucket_sql("CAST(date_trunc('week', d + 6) AS DATE)", "7 DAY", "min(bucket)"))
def a7_bucketed_count_week(spark, sf):
    return _converted(spark, sf, "W-MON")


@query("a7_bucketed_count_month", _bucket_sql("last_day(d)", "1 MONTH", "date_trunc('month', min(bucket))"))
def a7_bucketed_count_month(spark, sf):
    return _converted(spark, sf, "M")


@query("f4_lead_status", """
SELECT CAST(o_orderdate AS DATE) AS CreatedDate, CASE o_orderstatus WHEN 'O' THEN 'Open - Not Contacted' ELSE 'Working - Contacted' END AS Status,
  'Customer ' || o_custkey AS Company, 'S' || o_custkey % 50 AS State, o_orderpriority AS LeadSource FROM orders WHERE o_orderstatus IN ('O', 'P')""")
def f4_lead_status(spark, sf):
    names = F.create_map(*[F.lit(v) for v in ("O", "Open - Not Contacted", "P", "Working - Contacted", "F", "Closed - Converted")])
    leads = inputs.table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("CreatedDate"), F.try_element_at(names, F.col("o_orderstatus")).alias("Status"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("Company"),
        F.concat(F.lit("S"), F.pmod("o_custkey", F.lit(50)).cast("string")).alias("State"), F.col("o_orderpriority").alias("LeadSource"))
    return selection.lead_status_filter(leads, "open")


@query("w6_date_spine", """
SELECT s.store_date, count(f.event_id) AS frames FROM (SELECT strftime(unnest(generate_series(DATE '2024-01-08', DATE '2024-01-15', INTERVAL 1 DAY)), '%Y%m%d') AS store_date) s
LEFT JOIN frames_v f ON f.store_date = s.store_date GROUP BY s.store_date""")
def w6_date_spine(spark, sf):
    days = inputs.frames(spark, sf).groupBy(keys.store_date(F.col("timestamp")).alias("store_date")).agg(F.count(F.lit(1)).alias("frames"))
    return (dashboards.date_spine(spark, "2024-01-15").join(days, "store_date", "left")
            .select("store_date", F.coalesce("frames", F.lit(0).cast("long")).alias("frames")))


@query("a9_latency_summary", """
SELECT size, CASE WHEN bool_and(seconds > 0) THEN round(avg(seconds), 6) END AS mean_latency,
  CASE WHEN bool_and(seconds > 0) THEN round(avg(seconds / size), 6) END AS latency_per_image, bool_and(seconds > 0) AS valid
FROM (SELECT CAST([1, 2, 4, 8][user_id % 4 + 1] AS INTEGER) AS size, CASE WHEN user_id % 4 = 3 AND event_id % 100 = 0 THEN 0 ELSE abs(value) + 1 END AS seconds FROM events)
GROUP BY size""")
def a9_latency_summary(spark, sf):
    size = F.get(F.array(*[F.lit(v) for v in (1, 2, 4, 8)]), F.pmod("user_id", F.lit(4)).cast("int"))
    lost = (F.pmod("user_id", F.lit(4)) == 3) & (F.pmod("event_id", F.lit(100)) == 0)
    samples = inputs.table(spark, sf, "events").select(size.alias("size"), F.when(lost, 0.0).otherwise(F.abs("value") + 1).alias("seconds"))
    out = monitoring.latency_summary(samples)
    return out.select("size", _r(F.col("mean_latency"), "mean_latency"), _r(F.col("latency_per_image"), "latency_per_image"), "valid")


@query("w5_count_window", """
WITH p AS (SELECT camera, ts_ms, (row_number() OVER (PARTITION BY camera ORDER BY ts_ms, event_id) - 1) // 10 AS group_no FROM frames_v),
g AS (SELECT camera, group_no, min(ts_ms) AS a, max(ts_ms) AS b FROM p GROUP BY camera, group_no HAVING count(*) = 10)
SELECT camera, group_no, round((b - coalesce(lag(b) OVER (PARTITION BY camera ORDER BY group_no), a)) / 10000.0, 6) AS latency FROM g""")
def w5_count_window(spark, sf):
    arrivals = inputs.frames(spark, sf).select("camera", "event_id", F.col("timestamp").alias("ts_ms"))
    out = monitoring.count_window_latency(arrivals, ["camera"])
    return out.select("camera", "group_no", _r(F.col("latency"), "latency"))


@query("st3_throughput", """
WITH s AS (SELECT camera, ts_ms // 60000 AS slot, count(*) AS n FROM frames_v GROUP BY 1, 2)
SELECT 'dashcam_' || camera AS dashcam_id, slot * 60000 AS record_ms, slot - min(slot) OVER (PARTITION BY camera) AS minute, CAST(n AS DOUBLE) AS size FROM s""")
def st3_throughput(spark, sf):
    out = monitoring.throughput(inputs.frames(spark, sf).select("camera", "timestamp"))
    return out.select("dashcam_id", F.unix_millis("record_time").alias("record_ms"), "minute", F.col("size").cast("double").alias("size"))


_RATE = """
WITH d AS (SELECT topic, part, ts_ms, CASE WHEN p IS NULL THEN 0 WHEN value < p THEN value ELSE value - p END AS inc
  FROM (SELECT *, lag(value) OVER (PARTITION BY topic, part ORDER BY ts_ms, event_id) AS p FROM counters_v))"""


@query("st6_counter_rate", _RATE + """
SELECT topic, (ts_ms // 300000 + 1) * 300000 AS end_ms, round(sum(inc) / 300, 6) AS rate FROM d GROUP BY 1, 2""")
def st6_counter_rate(spark, sf):
    out = monitoring.counter_rate(inputs.counters(spark, sf), ["topic", "part"], ["topic"])
    return out.select("topic", F.unix_millis("window_end").alias("end_ms"), _r(F.col("rate"), "rate"))


@query("st6_counter_rate_sliding", _RATE + """
SELECT part, (ts_ms // 60000 + 1 + k) * 60000 AS end_ms, round(sum(inc) / 300, 6) AS rate FROM d, (SELECT unnest(range(5)) AS k) GROUP BY 1, 2""")
def st6_counter_rate_sliding(spark, sf):
    out = monitoring.counter_rate(inputs.counters(spark, sf), ["topic", "part"], ["part"], "5 minutes", "1 minute")
    return out.select("part", F.unix_millis("window_end").alias("end_ms"), _r(F.col("rate"), "rate"))


_LAG = """
WITH p AS (SELECT topic, part, ts_ms // 3600000 AS bucket, value, event_id FROM counters_v),
l AS (SELECT topic, part, bucket, arg_max(value, event_id) AS v FROM p GROUP BY 1, 2, 3),
g AS (SELECT topic, part, bucket, arg_max(floor(value / 2), event_id) AS w FROM p WHERE {heard} GROUP BY 1, 2, 3),
times AS (SELECT DISTINCT topic, bucket FROM l),
series AS (SELECT DISTINCT topic, part FROM l),
every AS (SELECT topic, part, bucket, last_value(v IGNORE NULLS) OVER w AS v, last_value(w IGNORE NULLS) OVER w AS w
  FROM times JOIN series USING (topic) LEFT JOIN l USING (topic, part, bucket) LEFT JOIN g USING (topic, part, bucket)
  WINDOW w AS (PARTITION BY topic, part ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT topic, bucket, CAST(sum(coalesce(v, 0)) AS DOUBLE) AS topic_offset, CAST(sum(coalesce(w, 0)) AS DOUBLE) AS group_offset,
  CAST(sum(coalesce(v, 0)) - sum(coalesce(w, 0)) AS DOUBLE) AS lag FROM every GROUP BY 1, 2"""


@query("st7_lag", _LAG.format(heard="true"))
def st7_lag(spark, sf):
    produced = inputs.counters(spark, sf)
    consumed = produced.withColumn("value", F.floor(F.col("value") / 2).cast("double"))
    return monitoring.consumer_lag(produced, consumed, ["topic", "part"], ["topic"], 3600)


@query("st7_lag_stalled", _LAG.format(heard="bucket % 3 <> 1 AND (topic <> 'click' OR part <> 2)"))
def st7_lag_stalled(spark, sf):
    """Groups that report nothing in every third hour, one of them never."""
    produced = inputs.counters(spark, sf)
    bucket = F.floor(F.col("ts_ms") / 3_600_000)
    heard = (F.pmod(bucket, F.lit(3)) != 1) & ((F.col("topic") != "click") | (F.col("part") != 2))
    consumed = produced.filter(heard).withColumn("value", F.floor(F.col("value") / 2).cast("double"))
    return monitoring.consumer_lag(produced, consumed, ["topic", "part"], ["topic"], 3600)


@query("st8_gauge_sum", """
WITH l AS (SELECT topic, part, ts_ms // 3600000 AS bucket, arg_max(value, event_id) AS v FROM counters_v GROUP BY 1, 2, 3)
SELECT part, bucket, sum(v) AS total, count(*) AS n_series FROM l GROUP BY 1, 2""")
def st8_gauge_sum(spark, sf):
    return monitoring.gauge_sum(inputs.counters(spark, sf), ["topic", "part"], ["part"], 3600)


@query("st8_label_values", "SELECT DISTINCT part FROM counters_v WHERE topic = 'click'")
def st8_label_values(spark, sf):
    return monitoring.label_values(inputs.counters(spark, sf), "part", topic="click")


@query("s3_list_objects", """
SELECT CAST(page_id % 12 AS VARCHAR) AS folder, CAST(sum(octet_length(encode(url)) + 1) AS BIGINT) AS n_bytes, true AS linked FROM pages GROUP BY 1""")
def s3_list_objects(spark, sf):
    """Bytes below each folder of a tree of two levels that the pages were written to."""
    path = f"{scratch_dir(spark)}/tree-{uuid.uuid4().hex}"
    n = F.col("page_id")
    pages = inputs.table(spark, sf, "pages").select("url", F.pmod(n, F.lit(3)).alias("a"), F.pmod(n, F.lit(12)).alias("b"))
    pages.write.partitionBy("a", "b").text(path)
    listed = files.list_tree(spark, path, inputs.URL_PREFIX)
    folder = F.regexp_extract("key", "^a=[0-9]+/b=([0-9]+)/[^/]+$", 1).alias("folder")
    linked = F.bool_and(F.col("url") == F.concat(F.lit(inputs.URL_PREFIX), F.col("key"))).alias("linked")
    return listed.groupBy(folder).agg(F.sum("size").alias("n_bytes"), linked)
