"""Decisions about message fields, on small hand-written messages."""

import json

from pyspark.sql import functions as F

from framelake import fixed
from framelake.functions import messages, text, vectors
from framelake.operators import keyframes, statistic
from framelake.sources import messages as source

SAMPLE = [{"name": "5: bus", "probability": 91.5, "box": [0.1, 0.2, 0.3, 0.5]},
          {"name": "9: traffic light", "probability": 72.25, "box": [0.6, 0.05, 0.65, 0.2]},
          {"name": "2: bicycle", "probability": 40.0, "box": [0.2, 0.5, 0.45, 0.9]},
          {"name": "0: kite", "probability": 12.75, "box": [0.7, 0.1, 0.8, 0.15]}]
SCENES = [{"class": c, "prob": p} for c, p in (("pier", .5), ("plaza", .25), ("street", .125), ("coast", .0625), ("arcade", .03))]


def message(camera=1, frame_num=0, objs=SAMPLE, scenes=SCENES, **more):
    return json.dumps({"camera": camera, "frame_num": frame_num, "timestamp": 1549015332929, "location": "CA",
                       "objs": objs, "scenes": scenes, **more})


def parse(spark, *texts):
    return source.parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"))


def test_sample_message(spark):
    row = keyframes.prepare_value(parse(spark, message())).first()
    assert {k: v.class_name for k, v in row.objs.items()} == {1: "bus", 2: "traffic light", 3: "bicycle", 4: "kite"}
    assert row.counts == {"5": 1, "9": 1, "2": 1, "0": 1}
    assert row.scenes == ["downtown", "harbor"]
    assert row.is_keyframe and row.valuable


def test_box_order(spark):
    df = parse(spark, message())
    a = df.select(messages.parse_objects(F.col("objs"))[1].alias("t")).first().t
    b = df.select(messages.parse_objects(F.col("objs"), "yxyx")[1].alias("t")).first().t
    assert (a.x1, a.y1, a.x2, a.y2) == (b.y1, b.x1, b.y2, b.x2)


def test_empty_and_missing(spark):
    for row in keyframes.prepare_value(parse(spark, message(objs=[], scenes=[]), message(objs=None, scenes=None))).collect():
        assert row.objs is None and row.counts == {} and row.scenes == ["street"]


def test_class_from_field_or_name(spark):
    objs = [{"class": 7, "name": "3: car", "box": [0, 0, 1, 1]}, {"name": "3: car", "box": [0, 0, 1, 1]},
            {"name": "no colon ", "box": [0, 0, 1, 1]}, {"name": "x: y: z", "box": [0, 0, 1, 1]}]
    row = parse(spark, message(objs=objs)).select(
        F.transform("objs", messages.object_class).alias("c"), F.transform("objs", messages.object_name).alias("n")).first()
    assert row.c == [7, 3, None, None]
    assert row.n == ["car", "car", "no colon", "y"]


def test_rejects(spark):
    df = parse(spark, message(), "{broken", "not json")
    assert source.accepted(df).count() == 1
    assert {r.rejected for r in source.rejects(df).collect()} == {"{broken", "not json"}
    assert source.rejects(df).filter("camera is not null").count() == 0


def test_scene_number(spark):
    df = parse(spark, message())
    assert keyframes.prepare_value(df, scene_num=1).first().scenes == ["harbor"]
    assert df.select(messages.top_scenes(F.col("scenes"), 2).alias("s")).first().s == ["pier", "plaza"]


def test_responses(spark):
    body = json.dumps({"entries": {"u1": SAMPLE}})
    df = spark.createDataFrame([(body, "u1"), (body, "u2"), ("{}", "u1"), (None, "u1")], "b string, u string")
    found = [r.o for r in df.select(messages.object_response(F.col("b"), F.col("u")).alias("o")).collect()]
    assert len(found[0]) == 4 and found[1:] == [None, None, None]
    scenes = spark.createDataFrame([(json.dumps({"predictions": SCENES}),), ("{}",)], "b string")
    got = [r.s for r in scenes.select(messages.scene_response(F.col("b")).alias("s")).collect()]
    assert len(got[0]) == 5 and got[1] is None


def test_keyframes_by_class_counts(spark):
    def objs(*classes):
        return [{"class": c, "name": f"{c}: n", "box": [i, i, i + 1, i + 1]} for i, c in enumerate(classes)]
    frames = [objs(1, 2), objs(2, 1), objs(1, 1), objs(1), objs(), objs(), None, objs(3)]
    want = [True, False, True, True, True, False, False, True]
    df = parse(spark, *[message(frame_num=i, objs=o) for i, o in enumerate(frames)])
    for limit in (2, 100):
        got = keyframes.mark_keyframes(df, limit=limit).orderBy("frame_num").collect()
        assert [r.is_keyframe for r in got] == want


def test_pair_diff_sees_boxes_and_looks_ahead(spark):
    a = [{"class": 1, "name": "1: n", "box": [0, 0, 1, 1]}]
    b = [{"class": 1, "name": "1: n", "box": [0, 0, 1, 2]}]
    times = [0, 1000, 2000, 61_000, 62_000]
    rows = [json.dumps({**json.loads(message(frame_num=i, objs=o)), "timestamp": t}) for i, (o, t) in enumerate(zip([a, a, b, a, b], times))]
    df = parse(spark, *rows)
    got = keyframes.pair_diff_keyframes(df).orderBy("frame_num").collect()
    assert [(r.frame_num, r.is_keyframe) for r in got] == [(0, False), (1, True), (3, True)]
    whole = keyframes.pair_diff_keyframes(df, batch_seconds=None).orderBy("frame_num").collect()
    assert [(r.frame_num, r.is_keyframe) for r in whole] == [(0, False), (1, True), (2, True), (3, True)]


def test_statistic_merge_equals_union(spark):
    df = keyframes.prepare_value(parse(spark, *[message(camera=i % 2, frame_num=i, scenes=SCENES[: i % 4]) for i in range(20)]))
    a, b = df.filter("frame_num % 3 = 0"), df.filter("frame_num % 3 <> 0")
    merged = statistic.merge_statistic(statistic.scene_statistic(a), statistic.scene_statistic(b))
    assert sorted(merged.collect()) == sorted(statistic.scene_statistic(df).collect())
    one = statistic.scene_statistic(df).filter("dashcam_id = 'dashcam_0'").first()
    assert one.frames == 10 and one.total == one.street + one.harbor + one.downtown


def test_fixed_tables():
    assert len(fixed.STATE_CODES) == 51 and fixed.STATE_CODES["District of Columbia"] == "DC"
    assert fixed.scene_type_of()["plaza"] == "downtown" and "street" not in fixed.scene_type_of()
    assert set(fixed.scene_type_of().values()) | {"street"} == set(fixed.SCENE_TYPES)
    assert len(fixed.BOX_COLOURS) == 126


def test_millify(spark):
    cases = {0.0: "0", 999.0: "999", 1000.0: "1 K", 1500000.0: "2 M", 2500000.0: "2 M", -2500.0: "-2 K", 7e9: "7 B", 3e15: "3000 T", 0.4: "0", -0.4: "-0"}
    df = spark.createDataFrame([(k,) for k in cases], "n double")
    assert {r.n: r.s for r in df.select("n", text.millify(F.col("n")).alias("s")).collect()} == cases


def test_topk_ties_and_labels(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 0.0],)], "v array<double>")
    labels = F.array(*[F.lit(x) for x in "abcd"])
    got = df.select(vectors.topk_softmax(F.col("v"), 2, labels).alias("t"), vectors.best_class(F.col("v")).alias("b")).first()
    assert [x["class"] for x in got.t] == ["b", "c"] and got.b == 1


def test_box_label(spark):
    df = spark.createDataFrame([("car", 0.879), (None, 0.5)], "n string, s double")
    n, s = F.col("n"), F.col("s")
    rows = df.select(text.box_label(n, s).alias("a"), text.box_label(n, s, skip_scores=True).alias("b"),
                     text.box_label(n, s, skip_labels=True).alias("c")).collect()
    assert tuple(rows[0]) == ("car: 87%", "car", "87%") and tuple(rows[1]) == ("N/A: 50%", "N/A", "50%")
