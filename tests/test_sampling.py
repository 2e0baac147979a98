"""Sampling phases, dealing out videos, ledgers and places."""

import random

import pytest
from pyspark.sql import functions as F

from framelake.operators import locate, sampling


def reader(lengths, step):
    """Frames a reader keeps that takes one frame, skips `step`, and runs on into the next video."""
    kept, video, at = [], 0, 0

    def read():
        nonlocal at
        if at < lengths[video]:
            at += 1
            return (video, at - 1)
        return None

    while True:
        got = read()
        for _ in range(step):
            if got is None:
                if video + 1 == len(lengths):
                    return kept
                video, at = video + 1, 0
            got = read()
        if got is None:
            if video + 1 == len(lengths):
                return kept
            video, at = video + 1, 0
            got = read()
        kept.append(got)


def keep(spark, cameras, step, piece=None):
    videos = spark.createDataFrame([(c, v, n) for c, ls in cameras.items() for v, n in enumerate(ls)], "camera int, video_id long, n_frames long")
    frames = videos.select("camera", "video_id", F.explode(F.sequence(F.lit(0), (F.col("n_frames") - 1).cast("int"))).alias("frame_idx"))
    got = sampling.sample_frames(frames, step, videos).collect()
    return {c: sorted((r.video_id, r.frame_idx) for r in got if r.camera == c) for c in cameras}


def test_worked_example(spark):
    assert keep(spark, {0: [4, 2, 5]}, 2)[0] == [(0, 2), (1, 0), (2, 0), (2, 3)]


@pytest.mark.parametrize("step", [0, 1, 2, 5])
def test_phases_equal_a_reader(spark, step, monkeypatch):
    monkeypatch.setattr(sampling, "PIECE", 3)
    rng = random.Random(step)
    cameras = {c: [rng.randint(1, 12) for _ in range(rng.randint(1, 60))] for c in range(12)}
    assert keep(spark, cameras, step) == {c: reader(ls, step) for c, ls in cameras.items()}


def test_without_videos_each_starts_anew(spark):
    frames = spark.createDataFrame([(0, v, i) for v in range(2) for i in range(5)], "camera int, video_id int, frame_idx int")
    assert sorted((r.video_id, r.frame_idx) for r in sampling.sample_frames(frames, 2).collect()) == [(0, 2), (1, 2)]


def test_key_positions(spark):
    rng = random.Random(1)
    urls = sorted({f"a/{'hot/' * 5 if rng.random() < .8 else ''}{rng.randint(0, 10**6)}.mov" for _ in range(3000)})
    df = spark.createDataFrame([(u,) for u in rng.sample(urls, len(urls)) + urls[:50]], "key string").repartition(6)
    got = {r.key: r.position for r in sampling.key_positions(df, "key", pieces=16).collect()}
    assert got == {u: i for i, u in enumerate(urls)}


def test_round_robin_keys(spark):
    df = spark.createDataFrame([(f"data/videos/{c}.x.mov",) for c in "cab"], "key string")
    rows = sampling.assign_round_robin(df, "data/", "out/", 2).orderBy("position").collect()
    assert [(r.user_id, r.target_video_key, r.info_key, r.target_thumb_key) for r in rows] == [
        (0, "out/user_0/videos/a.x.mov", "data/info/a.json", "out/user_0/frame-10s/a.jpg"),
        (1, "out/user_1/videos/b.x.mov", "data/info/b.json", "out/user_1/frame-10s/b.jpg"),
        (0, "out/user_0/videos/c.x.mov", "data/info/c.json", "out/user_0/frame-10s/c.jpg")]


def test_ledger(spark):
    listing = spark.createDataFrame([("a.mov",), ("b.mov",), ("record.txt",)], "url string")
    ledger = spark.createDataFrame([("a.mov",)], "url string")
    todo = sampling.pending_videos(listing, ledger)
    assert [r.url for r in todo.collect()] == ["b.mov"]
    after = sampling.advance_ledger(ledger, todo.union(todo))
    assert sorted(r.url for r in after.collect()) == ["a.mov", "b.mov"]
    assert sampling.pending_videos(listing, after).count() == 0


REGIONS = [("big", 0.0, 10.0, 0.0, 10.0), ("small", 2.0, 4.0, 2.0, 4.0), ("far", -5.0, -1.0, 20.0, 21.5)]


def test_locate(spark):
    regions = spark.createDataFrame(REGIONS, "region string, lat_lo double, lat_hi double, lon_lo double, lon_hi double")
    pts = [(3.0, 3.0), (2.0, 2.0), (4.0, 4.0), (10.0, 5.0), (0.0, 0.0), (-1.0, 20.0), (-5.0, 20.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "i int, lat double, lon double")
    got = [r.location for r in locate.locate(df, regions).orderBy("i").collect()]
    assert got == ["small", "small", "big", "Oversea", "big", "Oversea", "far", "Unknown", "Unknown"]


def test_attach_location(spark):
    regions = spark.createDataFrame(REGIONS, "region string, lat_lo double, lat_hi double, lon_lo double, lon_hi double")
    videos = spark.createDataFrame([("http://h/b/videos/x.y.mov",), ("http://h/b/videos/z.mov",)], "url string")
    side = spark.createDataFrame([("x", 3.0, 3.0)], "stem string, lat double, lon double")
    got = {r.url[-5:]: r.location for r in locate.attach_location(videos, side, regions).collect()}
    assert got == {"y.mov": "small", "z.mov": "Unknown"}


def test_regions_have_few_cells(spark):
    rng, rows = random.Random(3), []
    for i in range(300):
        lat, lon, w, h = rng.uniform(-90, 80), rng.uniform(-180, 170), 10 ** rng.uniform(-4, 2), 10 ** rng.uniform(-4, 2)
        rows.append((f"r{i:03d}", lat, lat + h, lon, lon + w))
    rows += [("all", -90.0, 90.0, -180.0, 180.0), ("none", 5.0, 5.0, 5.0, 5.0), ("turned", 9.0, 8.0, 9.0, 8.0)]
    regions = spark.createDataFrame(rows, "region string, lat_lo double, lat_hi double, lon_lo double, lon_hi double")
    cells = locate.region_cells(regions).selectExpr("explode(_regions.region) as region").groupBy("region").count()
    assert all(r["count"] <= (9 if r.region == "all" else 4) for r in cells.collect())
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(500)] + [(1000 + i, r[1], r[3]) for i, r in enumerate(rows)]
    got = {r.i: r.location for r in locate.locate(spark.createDataFrame(points, "i long, lat double, lon double"), regions).collect()}
    for i, lat, lon in points:
        around = [((r[2] - r[1]) * (r[4] - r[3]), r[0]) for r in rows if r[1] <= lat < r[2] and r[3] <= lon < r[4]]
        assert got[i] == (min(around)[1] if around else "Oversea")
