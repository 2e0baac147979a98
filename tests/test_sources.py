"""Files in, files out."""

import json

from pyspark.sql import functions as F

from framelake import schemas
from framelake.operators import payload, tracking
from framelake.sinks import frames as frame_sink
from framelake.sources import files, messages, tables


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_list_objects(spark, tmp_path):
    put(tmp_path, "v+(1)/a.mov", "abc")
    put(tmp_path, "v+(1)/sub/b.txt", "x")
    df = files.list_objects(spark, f"file://{tmp_path}/v+(1)", "http://h/")
    assert {(r.key, r.size, r.url) for r in df.select("key", "size", "url").collect()} == {("a.mov", 3, "http://h/a.mov"), ("sub/b.txt", 1, "http://h/sub/b.txt")}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_taxonomy_later_line_wins(spark, tmp_path):
    path = put(tmp_path, "t.txt", "park park golf\nwild golf field/wild\n\nsolo\n")
    assert {(r.raw_scene, r.scene_type) for r in files.load_scene_taxonomy(spark, path).collect()} == {
        ("park", "park"), ("golf", "wild"), ("field/wild", "wild")}


def test_class_names(spark, tmp_path):
    path = put(tmp_path, "n.names", "person\nbicycle\ncar\n")
    assert [tuple(r) for r in files.load_class_names(spark, path).collect()] == [(0, "person"), (1, "bicycle"), (2, "car")]


def test_sidecars(spark, tmp_path):
    put(tmp_path, "info/0009-2b.json", json.dumps({"locations": [{"latitude": 0.0, "longitude": -74.5}, {"latitude": 1, "longitude": 1}]}))
    put(tmp_path, "info/none.json", json.dumps({"locations": []}))
    got = {r.stem: (r.lat, r.lon) for r in files.load_sidecar(spark, str(tmp_path / "info")).collect()}
    assert got == {"0009-2b": (0.0, -74.5), "none": (None, None)}


def test_mot_round_trip(spark, tmp_path):
    path = put(tmp_path, "det.txt", "1,-1,10.5,20,30,40,0.9\n2,-1,1,2,3,4,0.5\n")
    rows = files.read_mot(spark, path).collect()
    assert tuple(rows[0])[:6] == (1, -1, 10.5, 20.0, 40.5, 60.0)
    tracks = spark.createDataFrame([(1, 7, 10.125, 20.0, 40.5, 60.0)], "frame_num int, track_id int, x1 double, y1 double, x2 double, y2 double")
    tracking.write_mot(tracks, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first().value == "1,7,10.12,20.00,30.38,40.00,1,-1,-1,-1"


def test_label_files(spark, tmp_path):
    put(tmp_path, "labels/a.txt", "\n".join(f"{i} 0.5 0.25 0.1 0.2" for i in range(60)))
    rows = files.read_label_files(spark, str(tmp_path / "labels")).collect()
    assert sorted(r.class_id for r in rows) == list(range(50))
    df = spark.createDataFrame([("/d/images/a.png",), ("/d/images/b.jpg",)], "p string")
    assert [r.l for r in df.select(files.label_path(F.col("p")).alias("l")).collect()] == ["/d/labels/a.txt", "/d/labels/b.txt"]


def test_read_frame_messages(spark, tmp_path):
    put(tmp_path, "m/a.json", json.dumps({"camera": 1, "frame_num": 2}) + "\nbroken\n")
    df = messages.read_frame_messages(spark, str(tmp_path / "m"), schemas.RAW_FRAME)
    assert messages.accepted(df).first().frame_num == 2 and messages.rejects(df).count() == 1


def test_options():
    options = messages.topic_options("h:1", "value", max_per_trigger=5)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "5"
    assert tables.federated_catalog("store", "x.Y", host="h") == {"spark.sql.catalog.store": "x.Y", "spark.sql.catalog.store.host": "h"}


def test_statistic_table(spark):
    spark.range(3).createOrReplaceTempView("stat_rows")
    df = tables.read_statistic(spark, "stat_rows")
    assert sorted(r.id for r in tables.rows_from_json(tables.rows_as_json(df), "id long").collect()) == [0, 1, 2]


def test_payload_round_trip(spark, tmp_path):
    import numpy as np
    img = np.arange(24 * 16 * 3, dtype=np.uint8).reshape(24, 16, 3)
    df = spark.createDataFrame([(1, bytearray(img.tobytes()), [24, 16, 3]), (2, bytearray(b"abc"), [2, 2])], "frame_num long, raw binary, shape array<int>")
    wire = df.select("frame_num", F.lit(5).cast("long").alias("camera"), F.lit(1549015332929).alias("timestamp"), F.lit("CA").alias("location"),
                     *payload.encode_tensor(F.col("raw"), "|u1", F.col("shape")))
    decoded = payload.decode_tensor(wire)
    assert {r.frame_num: (bytes(r.data), r.intact) for r in decoded.collect()} == {1: (img.tobytes(), True), 2: (b"abc", False)}
    broken = payload.decode_tensor(wire.withColumn("original_frame", F.lit("***")))
    assert broken.filter("intact").count() == 0
    urls = payload.store_payload(wire, str(tmp_path / "store"), "store/")
    assert "original_frame" not in urls.columns
    stored = spark.read.parquet(str(tmp_path / "store"))
    assert stored.join(urls, "s3_key").count() == 4 and stored.first().s3_key == "store/20190201/5/1549015332929.jpg"

    row = payload.frame_profile(decoded, "frame_num").collect()
    turned = np.rot90(img)
    grey = np.floor(turned[..., 0] * 0.299 + turned[..., 1] * 0.587 + turned[..., 2] * 0.114 + 0.5)
    assert len(row) == 1 and abs(row[0].grey_mean - grey.mean()) < 1e-9
    assert row[0].turn == (90 if grey[:10].sum() > grey[-10:].sum() else 270)


def test_upsert_latest_wins(spark):
    cols = "dashcam_id string, store_date string, store_time long, location string, arrival long"
    old = spark.createDataFrame([("a", "d", 1, "x", 0), ("a", "d", 2, "x", 0)], cols)
    new = spark.createDataFrame([("a", "d", 2, "y", 1), ("a", "d", 2, "z", 3), ("a", "d", 2, "w", 2), ("b", "d", 1, "q", 1)], cols)
    got = {(r.dashcam_id, r.store_time): r.location for r in frame_sink.upsert_frames(old, new).collect()}
    assert got == {("a", 1): "x", ("a", 2): "z", ("b", 1): "q"}


def test_routes_and_manifests(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, 1549015332929, True), (2, 1, 1549015332929, False), (3, 2, 1549015332929, None)],
                               "camera long, frame_num long, timestamp long, valuable boolean")
    frame_sink.write_routed(frame_sink.route(df), str(tmp_path / "r"))
    assert (tmp_path / "r" / "topic=obj_1").is_dir()
    assert [r.key for r in frame_sink.archive_manifest(df, "store/", "tmp/").collect()] == ["store/20190201/1/1549015332929.jpg"]
    assert sorted(r.key for r in frame_sink.delete_manifest(df, "store/", "tmp/").collect()) == ["tmp/2/1549015332929.jpg", "tmp/3/1549015332929.jpg"]
    for mode in ("camera", "frame", "round_robin"):
        spread = frame_sink.partition_by_key(df, 3, mode)
        assert spread.rdd.getNumPartitions() == 3 and spread.count() == 3


def test_large_trees_are_listed_by_tasks(spark, tmp_path):
    for a in range(5):
        for b in range(4):
            (tmp_path / f"t/a{a}/b{b}").mkdir(parents=True)
            for c in range(50):
                (tmp_path / f"t/a{a}/b{b}/{c}.jpg").write_bytes(b"x" * c)
    (tmp_path / "t/top.txt").write_text("abc")
    (tmp_path / "t/_hidden").write_text("x")
    (tmp_path / "t/empty").mkdir()
    for prefix in (f"{tmp_path}/t", f"file://{tmp_path}/t/"):
        tree = files.list_tree(spark, prefix, "http://h/")
        assert tree.schema.simpleString() == files.list_objects(spark, prefix, "http://h/").schema.simpleString()
        got = {(r.key, r.size, r.url) for r in tree.collect()}
        assert len(got) == 1001  # Spark's readers leave out files without content
        assert {r for r in got if r[1]} == {(r.key, r.size, r.url) for r in files.list_objects(spark, prefix, "http://h/").collect()}
    assert ("a4/b3/49.jpg", 49, "http://h/a4/b3/49.jpg") in got
    assert files.list_tree(spark, f"{tmp_path}/none").count() == 0
