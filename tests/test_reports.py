"""Dashboard figures, filters and counters on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from framelake.operators import dashboards, monitoring, selection
from framelake.operators.statistic import COUNTERS


def test_coverage_counts_null_once(spark):
    df = spark.createDataFrame([("a", "1", None), ("a", "2", "CA"), ("b", "1", None)], "dashcam_id string, store_date string, location string")
    assert tuple(dashboards.coverage(df).first()) == (2, 2, 2)
    assert [tuple(r) for r in dashboards.cameras_by_location(df).collect()] == [("CA", 1)]


def test_buckets(spark):
    days = [dt.date(2019, 1, d) for d in (1, 7, 8, 21)] + [dt.date(2019, 3, 4)]
    df = spark.createDataFrame([(d, True) for d in days] + [(dt.date(2020, 1, 1), False)], "d date, won boolean")
    week = dashboards.bucketed_count(df, "d", "W-MON", F.col("won")).collect()
    assert [(r.bucket.isoformat(), r.n) for r in week if r.n] == [("2019-01-07", 2), ("2019-01-14", 1), ("2019-01-21", 1), ("2019-03-04", 1)]
    assert len(week) == 9
    month = dashboards.bucketed_count(df, "d", "M", F.col("won")).collect()
    assert [(r.bucket.isoformat(), r.n) for r in month] == [("2019-01-31", 4), ("2019-02-28", 0), ("2019-03-31", 1)]
    assert len(dashboards.bucketed_count(df, "d", "D", F.col("won")).collect()) == 63
    assert dashboards.bucketed_count(df.limit(0), "d", "D").collect() == []


def test_scene_share_of_nothing(spark):
    empty = spark.createDataFrame([], ", ".join(f"{c} long" for c in COUNTERS))
    assert {r.percent for r in dashboards.scene_share(empty).collect()} == {None}


def test_filters(spark):
    rows = [("2019-01-01", s, "c", "CA", "web") for s in ("Open - Not Contacted", "Working - Contacted", "Closed - Converted", "Closed - Not Converted")]
    df = spark.createDataFrame(rows, "CreatedDate string, Status string, Company string, State string, LeadSource string")
    assert [selection.lead_status_filter(df, s).count() for s in ("open", "converted", "lost", "all")] == [2, 1, 1, 4]
    days = spark.createDataFrame([("20190301",), ("20190228",)], "store_date string")
    assert selection.day_filter(days, "2019-03-02", 2).first().store_date == "20190228"


def test_diversity_never_exceeds_cap_per_only_type(spark):
    df = spark.createDataFrame([(i, 0, ["street"] if i % 10 else ["street", "ruin"], "CA" if i % 2 else None) for i in range(300)],
                               "camera int, frame_num int, scenes array<string>, location string")
    out = selection.diversity_select(df, 15)
    assert out.count() == 300
    assert out.filter("valuable and array_contains(scenes, 'ruin')").count() >= 15
    assert 15 <= out.filter("valuable").count() <= 30
    assert out.filter("valuable").count() == selection.diversity_select(df, 15, pick=None).filter("valuable").count()
    few = {(r.camera, r.valuable) for r in out.select("camera", "valuable").collect()}
    selection.TOP_K, kept = 0, selection.TOP_K
    try:
        pieces = selection.diversity_select(df, 15, limit=20)
        assert {(r.camera, r.valuable) for r in pieces.select("camera", "valuable").collect()} == few
    finally:
        selection.TOP_K = kept
    assert selection.diversity_select(df, 5, by_location=True).filter("valuable").count() <= 20


def test_counter_rate_resets(spark):
    rows = [("a", 0, t * 60_000, i, v) for i, (t, v) in enumerate([(0, 10.0), (1, 20.0), (2, 5.0), (6, 8.0)])]
    df = spark.createDataFrame(rows, "topic string, part int, ts_ms long, event_id int, value double")
    got = {r.window_end.minute: r.rate for r in monitoring.counter_rate(df, ["topic", "part"], ["topic"]).collect()}
    assert got == {5: 15 / 300, 10: 3 / 300}
    for limit in (1, 100):
        grown = monitoring.counter_increase(df, ["topic", "part"], limit=limit).orderBy("ts_ms").collect()
        assert [r.increase for r in grown] == [0.0, 10.0, 5.0, 3.0]


def test_latencies(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 3.0), (2, 0.0)], "size int, seconds double")
    assert [tuple(r) for r in monitoring.latency_summary(df).orderBy("size").collect()] == [(1, 3.0, 3.0, True), (2, None, None, False)]
    arrivals = spark.createDataFrame([("c", t * 1000, t) for t in (0, 1, 2, 3, 10, 11, 12)], "consumer string, ts_ms long, event_id int")
    got = monitoring.count_window_latency(arrivals, ["consumer"], 3, limit=2).orderBy("group_no").collect()
    assert [(r.group_no, pytest.approx(r.latency)) for r in got] == [(0, 2 / 3), (1, 3.0)]


def test_date_spine(spark):
    got = [r.store_date for r in dashboards.date_spine(spark, "2019-03-02").collect()]
    assert got[0] == "20190223" and got[-1] == "20190302" and len(got) == 8


def test_sketches_of_days_merge_to_the_sketch_of_all(spark):
    rows = spark.range(30_000).selectExpr("id % 9000 as camera", "if(id % 100 = 0, null, cast(id % 37 as string)) as location",
                                          "cast(20240101 + id % 10 as string) as store_date")
    days = dashboards.daily_sketches(rows, "camera", "location")
    merged = dashboards.merged_coverage(days, "camera", "location").first()
    whole = dashboards.merged_coverage(dashboards.daily_sketches(rows.withColumn("store_date", F.lit("x")), "camera", "location"), "camera", "location").first()
    assert all(abs(x.camera - 9000) < 180 and x.location == 38 for x in (merged, whole))
