"""Streams give the rows of the batch operators, also when they are stopped half-way."""

import heapq
import json
import random

import pytest
from pyspark.sql import functions as F

from framelake.operators import keyframes, selection, statistic
from framelake.sinks import stream as sink
from framelake.sources import messages
from framelake.streaming import diversity, reorder, windows

SCHEMA = "camera long, frame_num long, arrival long, classes array<int>"


def disordered(seed, cameras=4, n=120, spread=20):
    rng, rows = random.Random(seed), []
    for cam in range(cameras):
        frames = [(cam, f, sorted(rng.choices([1, 2], k=rng.randint(0, 2)))) for f in range(n)]
        frames.sort(key=lambda r: r[1] + rng.random() * spread)
        rows += [(c, f, i, k) for i, (c, f, k) in enumerate(frames)]
    return rows


def write(spark, rows, folder, files=2, end=True):
    """Arrival order is cut into `files` files; a last one ends every camera."""
    longest = max(r[2] for r in rows) + 1
    for i in range(files):
        part = [r for r in rows if r[2] * files // longest == i]
        random.Random(i).shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    if end:
        marks = [(c, None, longest + 1, None) for c in sorted({r[0] for r in rows})]
        spark.createDataFrame(marks, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(stream, folder, name="out"):
    query = (stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp-{name}")
             .trigger(availableNow=True).start(f"{folder}/{name}"))
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{folder}/{name}")


def source(spark, folder, per_batch=1):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_batch).parquet(f"{folder}/in")


def heap_run(rows, capacity):
    """Rows a bounded heap lets out, with late marks, per camera."""
    out = {}
    for cam in sorted({r[0] for r in rows}):
        heap, got = [], []
        for r in sorted((r for r in rows if r[0] == cam), key=lambda r: r[2]):
            heapq.heappush(heap, r[1])
            if len(heap) >= capacity:
                got.append(heapq.heappop(heap))
        got += sorted(heap)
        top, marked = -1, []
        for f in got:
            marked.append((f, f < top))
            top = max(top, f)
        out[cam] = sorted(marked)
    return out


def test_keyframes_equal_batch_when_disorder_fits(spark, tmp_path):
    rows = disordered(1)
    write(spark, rows, tmp_path)
    got = run(reorder.stream_keyframes(source(spark, tmp_path), capacity=64, idle_ms=0), tmp_path)
    batch = keyframes.mark_keyframes(spark.createDataFrame(rows, SCHEMA), classes=F.col("classes"))
    want = sorted((r.camera, r.frame_num, r.is_keyframe) for r in batch.collect())
    assert sorted((r.camera, r.frame_num, r.is_keyframe) for r in got.collect()) == want
    assert got.filter("late").count() == 0


def test_small_buffer_marks_late_frames(spark, tmp_path):
    rows = disordered(2, cameras=2, spread=30)
    write(spark, rows, tmp_path)
    got = run(reorder.reorder(source(spark, tmp_path), capacity=4, idle_ms=0), tmp_path)
    want = heap_run(rows, 4)
    assert {c: sorted((r.frame_num, r.late) for r in got.collect() if r.camera == c) for c in want} == want
    assert any(late for marks in want.values() for _, late in marks)


def test_restart_loses_and_doubles_nothing(spark, tmp_path):
    rows = disordered(3, cameras=2)
    longest = max(r[2] for r in rows) + 1
    write(spark, [r for r in rows if r[2] < longest // 2], tmp_path, files=1, end=False)
    stream = lambda: reorder.stream_keyframes(source(spark, tmp_path), capacity=32, idle_ms=0)
    first = run(stream(), tmp_path).count()
    assert 0 < first < len(rows) // 2
    later = [r for r in rows if r[2] >= longest // 2]
    spark.createDataFrame(later, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run(stream(), tmp_path)
    spark.createDataFrame([(c, None, 10**6, None) for c in (0, 1)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    got = run(stream(), tmp_path)
    batch = keyframes.mark_keyframes(spark.createDataFrame(rows, SCHEMA), classes=F.col("classes"))
    assert sorted((r.camera, r.frame_num, r.is_keyframe) for r in got.collect()) == sorted((r.camera, r.frame_num, r.is_keyframe) for r in batch.collect())


def message(i):
    objs = [{"class": 1 + i % 2, "name": f"{1 + i % 2}: n", "probability": 1.0, "box": [0, 0, 1, 1]}] * (i % 3)
    scenes = [{"class": c, "prob": 0.5} for c in ("plaza", "office", "highway")[: i % 4]]
    return json.dumps({"camera": i % 3, "frame_num": i, "timestamp": 1549015332929 + i * 1000, "location": "CA", "objs": objs, "scenes": scenes})


def test_sink_is_replay_safe(spark, tmp_path):
    (tmp_path / "m").mkdir()
    for part in range(3):
        (tmp_path / "m" / f"{part}.json").write_text("\n".join(message(i) for i in range(part * 20, part * 20 + 20)) + "\nbroken\n")
    wire = messages.stream_messages(spark, str(tmp_path / "m"), max_per_trigger=1)
    values = keyframes.prepare_value(messages.accepted(wire))
    sink.sink_stream(values, str(tmp_path / "db"), str(tmp_path / "cp"), "store/", "http://h/", {"availableNow": True}).awaitTermination()
    batch = keyframes.prepare_value(messages.accepted(messages.read_frame_messages(spark, str(tmp_path / "m"))))
    want = sorted(statistic.scene_statistic(batch).collect())
    assert sorted(sink.read_statistic(spark, str(tmp_path / "db")).collect()) == want
    assert sink.read_frames(spark, str(tmp_path / "db")).count() == 60

    again = batch.filter("frame_num < 20")
    writer = sink.write_batch(str(tmp_path / "db"), "store/", "http://h/")
    for _ in range(2):
        writer(again, 7)
    twice = {r.dashcam_id: r.frames for r in sink.read_statistic(spark, str(tmp_path / "db")).collect()}
    assert sum(twice.values()) == 80
    assert sink.read_frames(spark, str(tmp_path / "db")).count() == 60
    sink.compact(spark, str(tmp_path / "db"), str(tmp_path / "small"))
    assert sink.read_frames(spark, str(tmp_path / "small")).count() == 60
    assert {r.dashcam_id: r.frames for r in sink.read_statistic(spark, str(tmp_path / "small")).collect()} == twice
    sink.write_batch(str(tmp_path / "small"), "store/", "http://h/")(again, 0)  # the first batch of a new stream
    assert sum(r.frames for r in sink.read_statistic(spark, str(tmp_path / "small")).collect()) == 100
    assert sink.read_frames(spark, str(tmp_path / "small")).count() == 60


def test_windows_on_stream_equal_batch(spark, tmp_path):
    rows = [(i % 3, i, 1549015332929 + i * 700, "CA" if i % 2 else "NY", ["street"] if i % 4 else ["gas", "park"], i % 5 == 0) for i in range(300)]
    # a frame long after the others closes their windows
    rows.append((0, 10_000, 1549015332929 + 10**8, "CA", ["street"], False))
    schema = "camera long, frame_num long, timestamp long, location string, scenes array<string>, is_keyframe boolean"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    batch = spark.createDataFrame(rows[:-1], schema)
    for i, make in enumerate((windows.throughput, windows.rolling_statistic, lambda d: windows.rolling_statistic(d, attribution="flush"))):
        assert sorted(run(make(stream), tmp_path, f"w{i}").collect()) == sorted(make(batch).collect())
    with pytest.raises(ValueError):
        windows.rolling_statistic(batch, attribution="other")


def test_batch_counts(spark, tmp_path):
    import time
    spark.range(50).write.parquet(f"{tmp_path}/in")
    listener = windows.CountListener("seen")
    spark.streams.addListener(listener)
    try:
        run(windows.microbatch_counts(spark.readStream.schema("id long").parquet(f"{tmp_path}/in"), "seen"), tmp_path)
        for _ in range(50):
            if listener.counts:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(n for _, n in listener.counts) == 50


def test_live_cameras(spark, tmp_path):
    from framelake.plans import live
    (tmp_path / "m").mkdir()
    order = sorted(range(90), key=lambda i: i + random.Random(i).random() * 12)
    sent = [json.dumps({**json.loads(message(i)), "arrival": k}) for k, i in enumerate(order)]
    lost = [json.dumps({"frame_num": 5, "arrival": 1}), json.dumps({"camera": 1, "frame_num": 5})]
    (tmp_path / "m" / "a.json").write_text("\n".join([*sent[::-1], "broken", *lost]))  # lines have no order of their own
    import time
    time.sleep(1.1)
    (tmp_path / "m" / "b.json").write_text("\n".join(json.dumps({"camera": c, "arrival": 1000}) for c in range(3)))
    wire = messages.stream_wire(spark, str(tmp_path / "m"), max_per_trigger=1)
    live.start_live(wire, str(tmp_path / "db"), str(tmp_path / "cp"), "store/", "http://h/", 64, 0, {"availableNow": True}).awaitTermination()
    text = spark.createDataFrame([(message(i),) for i in range(90)], "value string")
    batch = keyframes.prepare_value(messages.accepted(messages.parse_messages(text)))
    batch = keyframes.mark_keyframes(batch, classes=F.col("classes"))
    assert sorted(sink.read_statistic(spark, str(tmp_path / "db")).collect()) == sorted(statistic.scene_statistic(batch).collect())
    got = sink.read_frames(spark, str(tmp_path / "db"))
    assert got.count() == 90 and got.filter("is_keyframe").count() == batch.filter("is_keyframe").count()
    live.start_rejects(wire, str(tmp_path / "rejects"), str(tmp_path / "cp2"), {"availableNow": True}).awaitTermination()
    assert sorted(r.rejected for r in spark.read.json(str(tmp_path / "rejects")).collect()) == sorted(["broken", *lost])


def test_idle_camera_is_flushed(spark, tmp_path):
    import time
    rows = disordered(9, cameras=2, n=20, spread=5)
    write(spark, rows, tmp_path, files=1, end=False)
    stream = reorder.reorder(source(spark, tmp_path), capacity=64, idle_ms=2000)
    query = (stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp")
             .trigger(processingTime="1 second").start(f"{tmp_path}/out"))
    try:
        got = []
        for _ in range(60):
            time.sleep(1)
            got = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").collect() if (tmp_path / "out").exists() else []
            if len(got) == len(rows) or not query.isActive:
                break
    finally:
        query.stop()
    assert query.exception() is None
    assert sorted((r.camera, r.frame_num) for r in got) == sorted(r[:2] for r in rows)


BOXES = "camera long, video_id long, frame_num long, det_id long, class_id int, x1 double, y1 double, x2 double, y2 double"


def walking(seed, videos=3, n=60):
    """Boxes that walk, cross, vanish for a while and end."""
    rng, rows = random.Random(seed), []
    for v in range(videos):
        for o in range(6):
            x, y, dx, dy = rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(-2, 2), rng.uniform(-2, 2)
            born, gone = rng.randrange(n // 2), rng.randrange(n // 2, n)
            for f in range(born, gone):
                if rng.random() > 0.15 and not 20 <= f < 26:
                    px, py = x + dx * f + rng.gauss(0, .3), y + dy * f + rng.gauss(0, .3)
                    rows.append((1, v, f, o, o % 2, px, py, px + 20, py + 25))
    return rows


def test_tracks_on_a_stream_equal_batch_over_restarts(spark, tmp_path):
    from framelake.operators import tracking
    from framelake.streaming import tracks
    rows, rng = walking(5), random.Random(6)
    want = sorted(map(tuple, tracking.track(spark.createDataFrame(rows, BOXES)).collect()))
    sent = sorted(rows, key=lambda r: r[2] + rng.random() * 6)
    third = -(-len(sent) // 3)
    for i in range(3):
        part = sent[i * third:(i + 1) * third] + [(1, v, *[None] * 7) for v in range(3)] * (i == 2)
        spark.createDataFrame(part, BOXES).write.mode("append").parquet(f"{tmp_path}/in")
        out = run(tracks.stream_tracks(spark.readStream.schema(BOXES).parquet(f"{tmp_path}/in"), idle_ms=0), tmp_path)
        assert i == 2 or out.count() < len(want)
    assert not out.filter("late").count() and len(want) > 200
    assert sorted(map(tuple, out.drop("late").collect())) == want


def test_boxes_of_frames_that_are_done_come_out_late(spark, tmp_path):
    from framelake.streaming import tracks
    box = (0, 1, 0.0, 0.0, 9.0, 9.0)
    for part in ([(1, 1, f, *box) for f in range(10)], [(1, 1, 3, *box), (1, 1, 12, *box)]):
        spark.createDataFrame(part, BOXES).write.mode("append").parquet(f"{tmp_path}/in")
        out = run(tracks.stream_tracks(spark.readStream.schema(BOXES).parquet(f"{tmp_path}/in"), lag=2, idle_ms=0), tmp_path)
    assert [(r.frame_num, r.track_id) for r in out.filter("late").collect()] == [(3, None)]
    assert sorted(r.frame_num for r in out.filter("not late").collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]


def test_a_batch_that_fails_between_two_tables_shows_nothing(spark, tmp_path, monkeypatch):
    batch = keyframes.prepare_value(messages.accepted(messages.parse_messages(spark.createDataFrame([(message(i),) for i in range(60)], "value string"))))
    root = str(tmp_path / "db")
    writer = sink.write_batch(root, "store/", "http://h/", "tmp/")
    writer(batch.filter("frame_num < 20"), 0)
    writer(batch.filter("frame_num between 20 and 39"), 1)
    seen = [sorted(map(str, f(spark, root).collect())) for f in (sink.read_frames, sink.read_statistic, sink.read_manifest)]

    def fails(*args):
        raise OSError("disk full")
    with monkeypatch.context() as m:
        m.setattr(sink.statistic, "scene_statistic", fails)
        with pytest.raises(OSError):
            writer(batch.filter("frame_num >= 40"), 2)
    with monkeypatch.context() as m:
        m.setattr(sink, "commit", fails)
        with pytest.raises(OSError):
            writer(batch.filter("frame_num >= 40"), 2)
    assert seen == [sorted(map(str, f(spark, root).collect())) for f in (sink.read_frames, sink.read_statistic, sink.read_manifest)]
    writer(batch.filter("frame_num >= 40"), 2)
    assert [sink.read_frames(spark, root, upto=n).count() for n in (0, 1, 2, None)] == [20, 40, 60, 60]
    assert [sum(r.frames for r in sink.read_statistic(spark, root, upto=n).collect()) for n in (-1, 0, 1, 2)] == [0, 20, 40, 60]
    named = {r.batch_id: r.files for r in sink.commits(spark, root).collect()}
    assert set(named) == {0, 1, 2} and all({f.split("/batch_id=")[0].rsplit("/", 1)[1] for f in files} == set(sink.TABLES) for files in named.values())


def test_pair_differences_over_restarts(spark, tmp_path):
    rng, rows = random.Random(8), []
    for cam in range(3):
        for f in range(100):
            rows.append((cam, f, f * 900, [{"class": rng.randrange(2), "name": "n", "probability": 0.5, "box": [0.0, 1.0]}] * rng.randrange(2)))
    schema = "camera long, frame_num long, timestamp long, objs array<struct<class:int,name:string,probability:double,box:array<double>>>"
    want = keyframes.pair_diff_keyframes(spark.createDataFrame(rows, schema), batch_seconds=20).select("camera", "frame_num", "is_keyframe").collect()
    sent = [(*r, i) for i, r in enumerate(sorted(rows, key=lambda r: r[1] + rng.random() * 20))]
    for half in range(2):
        part = sent[half * 150:half * 150 + 150] + [(c, None, None, None, 10 ** 6) for c in range(3)] * half
        df = spark.createDataFrame(part, schema + ", arrival long")
        df.write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        out = run(reorder.stream_pair_diff(stream, batch_seconds=20, capacity=64, idle_ms=0), tmp_path)
    assert sorted(map(tuple, out.select("camera", "frame_num", "is_keyframe").collect())) == sorted(map(tuple, want))


def test_periods_close_by_time_or_by_the_end_mark(spark, tmp_path):
    schema = "camera long, frame_num long, timestamp long, location string, scenes array<string>, is_keyframe boolean"
    rows = [(i % 2, i, i * 1000, None if i % 5 == 0 else "CA", ["gas"] if i % 3 else ["park", "gas"], i % 4 == 0) for i in range(100)]
    want = windows.rolling_statistic(spark.createDataFrame(rows, schema)).collect()
    counts = []
    for part in (rows[:60], [*rows[60:], (0, *[None] * 5), (1, *[None] * 5)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{tmp_path}/in")
        out = run(windows.flushed_statistic(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), delay_seconds=20), tmp_path)
        counts.append(out.count())
    assert 0 < counts[0] < counts[1]
    assert sorted(map(str, out.collect())) == sorted(map(str, want))


def test_diverse_frames_of_a_stream(spark, tmp_path):
    """Whatever the batches, what is nominated in the end is what the table nominates; state and changes stay small."""
    rng = random.Random(9)
    rows = [(rng.choice([0, 1, None]), i, rng.choice(["a", "b", None]), ["often"] * (rng.random() < .9) + rng.sample(["x", "y"], rng.randrange(3))) for i in range(2000)]
    kind = "camera long, frame_num long, location string, scenes array<string>"
    for i in range(3):
        part = rows[i::3] + rows[:5]  # some frames arrive again
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    pick = [F.col("frame_num") * 37 % 101]
    for name, by_location, salts in (("types", False, 4), ("places", True, 1)):
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        changes = run(diversity.stream_diversity(stream, 7, pick=pick, by_location=by_location, salts=salts), tmp_path, name)
        got = {tuple(r) for r in diversity.valuable_frames(changes).collect()}
        table = spark.createDataFrame(rows, kind)
        want = selection.diversity_select(table, 7, pick=[*pick, F.col("camera"), F.col("frame_num")], by_location=by_location).filter("valuable")
        whole = {(r.camera, r.frame_num) for r in want.collect()}
        assert whole <= got and {g for g in got if g[0] is not None} == {w for w in whole if w[0] is not None}
        assert changes.count() < 7 * 3 * 2 * 12


def events(folder, n, camera):
    import duckdb
    duckdb.sql(f"""COPY (SELECT range AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (range * 7) SECOND AS ts, {camera} AS user_id, 'view' AS event_type,
      1.0 AS value, '{{"k": ' || range % 97 || '}}' AS props FROM range({n})) TO '{folder}/events.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.mark.parametrize("name", ["st1_reorder", "st2_stream_keyframes"])
def test_cameras_in_any_order_of_arrival(spark, tmp_path, name):
    """One camera has most frames; its frames come in an order that has nothing to do with their numbers, and none is late."""
    import compare
    import duckdb
    from framelake.plans import registry
    sf = events(tmp_path, 900, "CASE WHEN range % 5 = 0 THEN range % 3 ELSE 7 END")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    assert compare.compare(spark, con, sf, name, registry.QUERIES[name], registry.SQL[name]) is None
    sent = registry.QUERIES["st1_reorder"](spark, sf).filter("camera = 7").orderBy("arrival").collect()
    assert sum(a.frame_num > b.frame_num for a, b in zip(sent, sent[1:])) > 200 and not any(r.late for r in sent)
    assert max(abs(r.frame_num - s.frame_num) for r, s in zip(sent, sorted(sent, key=lambda r: r.frame_num))) > 500


class KeptMap:
    """A map state as a processor sees it."""

    def __init__(self):
        self.rows, self.reads = {}, 0

    def getValue(self, key):
        self.reads += 1
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        self.rows.pop(key, None)


class Handle:
    def __init__(self):
        self.maps, self.timers = {}, set()

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, KeptMap())

    def registerTimer(self, ms):
        self.timers.add(ms)


def test_a_bucket_steps_its_sequences_in_one_call(spark):
    """One call takes many sequences and touches the state of theirs only; a timer ends those that were not seen since."""
    import pandas as pd
    from pyspark.sql import types as T
    from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

    from framelake.operators import tracking
    from framelake.streaming import tracks
    rows = walking(11, videos=40, n=30)
    want = sorted(map(tuple, tracking.track(spark.createDataFrame(rows, BOXES)).collect()))
    names = ["camera", "video_id", "frame_num", "tie", "class_id", *tracking.BOX, "_bucket", "_null"]
    key, handle = T.StructType([T.StructField(c, T.LongType()) for c in ("camera", "video_id")]), Handle()
    processor = tracks.TrackState(names, key, 4, 500, 1, 3, 0.3, False)
    processor.init(handle)
    out = []
    for ms, part in ((0, [r for r in rows if r[2] < 15]), (100, [r for r in rows if r[2] >= 15 and r[1] < 20])):
        parts = iter([pd.DataFrame([(*r, 0, 0) for r in part], columns=names)])
        out += [tuple(r) for df in processor.handleInputRows((0,), parts, TimerValues(ms, -1)) for r in df.itertuples(index=False)]
    state = handle.maps["sequences"]
    assert len(state.rows) == 40 and state.reads == 60 and handle.timers == {500, 600}
    for due, videos in ((500, range(20, 40)), (600, range(20))):
        got = [tuple(r) for df in processor.handleExpiredTimer((0,), TimerValues(due, -1), ExpiredTimerInfo(due)) for r in df.itertuples(index=False)]
        assert got and {r[1] for r in got} <= set(videos)
        out += got
    assert not any(state.rows[k][5] or state.rows[k][6] for k in state.rows) and not handle.maps["due"].rows
    first = [(1, v, *r) for v in range(40) for r in tracking_rows(rows, v, v < 20)]
    assert sorted(r[:-1] for r in out) == sorted(first) and len({r[1] for r in want}) == 40


def tracking_rows(rows, video, whole):
    from framelake.operators.tracking import Tracker
    tracker, out = Tracker(1, 3, 0.3), []
    mine = [r for r in rows if r[1] == video and (whole or r[2] < 15)]
    for f in range(min(r[2] for r in mine), max(r[2] for r in mine) + 1):
        now = sorted(r for r in mine if r[2] == f)
        out += [(f, *row) for row in tracker.step([r[5:] for r in now], [r[4] for r in now])]
    return out


def test_keys_of_sequences_may_be_null_text_or_large(spark, tmp_path):
    from framelake.streaming import tracks
    kind = BOXES.replace("camera long", "camera string")
    box = (0, 1, 0.0, 0.0, 9.0, 9.0)
    keys = [("a", 2 ** 53 + 1), ("a", 2 ** 53), ("a", 0), ("a", None), (None, 0), (None, None)]
    rows = [(*k, f, *box) for i, k in enumerate(keys) for f in range(3 + i)]
    spark.createDataFrame([*rows, *[(*k, *[None] * 7) for k in keys]], kind).write.parquet(f"{tmp_path}/in")
    out = run(tracks.stream_tracks(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), idle_ms=0, bucket_count=1), tmp_path)
    assert {tuple(r) for r in out.groupBy("camera", "video_id").count().collect()} == {(*k, 3 + i) for i, k in enumerate(keys)}
    assert not out.filter("track_id <> 1 or late").count()


def test_a_bucket_counts_its_cameras_in_one_call():
    """One call takes many cameras, null among them, and touches the state of theirs only; each camera closes by its own time or end mark."""
    import numpy as np
    import pandas as pd
    from pyspark.sql import types as T

    from framelake.operators import statistic
    key, handle, one = T.StructType([T.StructField("camera", T.LongType())]), Handle(), np.ones(len(statistic.COUNTERS), dtype="int64")
    processor = windows.OpenPeriods(["camera", "timestamp", "store_date", "location", "counts", "_bucket", "_null"], key, 1000, 2000)
    processor.init(handle)

    def call(rows):
        part = pd.DataFrame([(c or 0, ms, None if ms is None else "d", place, one, 0, int(c is None)) for c, ms, place in rows], columns=processor.names)
        frames = processor.handleInputRows((0,), iter([part]), None)
        return sorted(((None if pd.isna(r[0]) else int(r[0]), r[1], r[3], r[4]) for df in frames for r in df.itertuples(index=False)), key=str)

    cameras = [None, *range(30)]
    assert call([(c, ms, None) for c in cameras for ms in (0, 10, 1500)]) == []
    assert handle.maps["cameras"].reads == 31
    assert call([(c, 4000, "x") for c in cameras[:2]]) == sorted(((c, p, None, [n] * len(one)) for c in cameras[:2] for p, n in ((0, 2), (1000, 1))), key=str)
    assert handle.maps["cameras"].reads == 33
    assert call([(c, None, None) for c in cameras[1:4]]) == sorted(
        [(0, 4000, "x", [1] * len(one)), *((c, p, None, [n] * len(one)) for c in (1, 2) for p, n in ((0, 2), (1000, 1)))], key=str)
