"""Suppression, matching, scoring and tracking against brute force."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions import boxes as B
from framelake.operators import detections, evaluation, tracking

SCHEMA = "image_id long, box_id long, class_id int, score double, x1 double, y1 double, x2 double, y2 double"


def pixel_iou(a, b):
    w = max(min(a[2], b[2]) - max(a[0], b[0]) + 1, 0)
    h = max(min(a[3], b[3]) - max(a[1], b[1]) + 1, 0)
    area = lambda r: (r[2] - r[0] + 1) * (r[3] - r[1] + 1)
    return w * h / (area(a) + area(b) - w * h + 1e-16)


def random_boxes(seed, images=4, n=80, size=200):
    rng, rows = random.Random(seed), []
    for image in range(images):
        for i in range(n * (6 if image == 0 else 1)):
            x, y = rng.uniform(0, size), rng.uniform(0, size)
            rows.append((image, i, rng.randint(0, 1), round(rng.random(), 2), x, y, x + rng.uniform(5, 120), y + rng.uniform(5, 120)))
        rows += [(image, 10_000 + i, 0, 0.9, 10.0, 10.0, 60.0, 60.0) for i in range(30)]
    return rows


def brute_nms(rows, conf, threshold):
    kept = set()
    groups = itertools.groupby(sorted(rows, key=lambda r: (r[0], r[2], -r[3], r[1])), key=lambda r: (r[0], r[2]))
    for _, group in groups:
        chosen = []
        for r in group:
            if r[3] >= conf and all(pixel_iou(r[4:], k[4:]) < threshold for k in chosen):
                chosen.append(r)
        kept |= {(r[0], r[1]) for r in chosen}
    return kept


def test_nms(spark):
    rows = random_boxes(1)
    df = spark.createDataFrame(rows, SCHEMA)
    once = detections.nms(df, 0.3, 0.4)
    got = {(r.image_id, r.box_id) for r in once.collect()}
    assert got == brute_nms(rows, 0.3, 0.4)
    again = {(r.image_id, r.box_id) for r in detections.nms(once, 0.3, 0.4).collect()}
    assert again == got


def test_crowded_groups_stream(spark):
    rows = random_boxes(8, images=3, n=150, size=300)
    df = spark.createDataFrame(rows, SCHEMA)
    for crowd in (0, 200, None):
        got = {(r.image_id, r.box_id) for r in detections.nms(df, 0.3, 0.4, crowd=crowd).collect()}
        assert got == brute_nms(rows, 0.3, 0.4)


def test_odd_boxes_are_the_same_on_both_paths(spark):
    corner = "image_id int, box_id int, class_id int, score double, x1 double, y1 double, x2 double, y2 double, more map<string,int>"
    nan = float("nan")
    rows = [(1, 0, 0, 0.9, 0.0, 0.0, 10.0, 10.0, {"a": 1}), (1, 1, 0, 0.8, 1.0, 1.0, 10.0, 10.0, None), (1, 2, 0, 0.7, None, 0.0, 10.0, 10.0, None),
            (1, 3, 0, 0.6, 20.0, 20.0, 5.0, 5.0, None), (1, 4, 0, 0.6, 20.0, 20.0, 5.0, 5.0, None), (1, 5, 0, 0.55, 50.0, 50.0, 60.0, 60.0, None),
            (1, 6, 0, 0.55, 51.0, 50.0, 60.0, 60.0, None), (1, 7, 0, 0.5, 80.0, 80.0, nan, 90.0, None), (1, 8, 0, None, 0.0, 0.0, 1.0, 1.0, None),
            (None, 9, None, 0.9, 0.0, 0.0, 1.0, 1.0, None), (None, 10, None, 0.8, 0.0, 0.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, corner)
    plain = sorted(r.box_id for r in detections.nms(df, 0.5, 0.4, crowd=None).collect())
    for crowd in (0, 1, 3):
        assert sorted(r.box_id for r in detections.nms(df, 0.5, 0.4, crowd=crowd).collect()) == plain
    assert {0, 2, 3, 5} <= set(plain) and not {1, 4, 6, 8, 10} & set(plain)


def test_iou_modes(spark):
    df = spark.createDataFrame([(0.0, 0.0, 9.0, 9.0, 0.0, 0.0, 9.0, 9.0), (0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0), (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)],
                               "x1 double, y1 double, x2 double, y2 double, g_x1 double, g_y1 double, g_x2 double, g_y2 double")
    rows = df.select(*[B.iou(B.box(), B.box("g_"), m).alias(m) for m in ("plain", "pixel", "eps")]).collect()
    assert tuple(rows[0]) == (1.0, 1.0, 1.0) and rows[1].plain == 0.0 and rows[1].pixel == 0.0
    assert rows[2].plain is None and rows[2].pixel == pytest.approx(1.0) and rows[2].eps == 0.0


def brute_match(pred, truth, score):
    out = {}
    for g in truth:
        best = [(-pixel_iou(p[4:], g[3:]), -p[3], p[1]) for p in pred
                if p[0] == g[0] and p[2] == g[2] and p[3] > score and pixel_iou(p[4:], g[3:]) > 0.5]
        if best:
            out[(g[0], g[1])] = min(best)[2]
    return out


def test_match(spark):
    pred = random_boxes(2, n=120, size=150)
    truth = [(r[0], r[1], r[2], r[4] + 2, r[5] + 1, r[6] + 1, r[7] + 3) for r in pred if r[1] % 5 == 0]
    p = spark.createDataFrame(pred, SCHEMA)
    g = spark.createDataFrame(truth, "image_id long, gt_id long, class_id int, x1 double, y1 double, x2 double, y2 double")
    for cell in (16.0, 64.0, 1000.0):
        got = {(r.image_id, r.gt_id): r.box_id for r in evaluation.match_detections(p, g, cell=cell).collect()}
        assert got == brute_match(pred, truth, 0.5)
    with pytest.raises(ValueError):
        evaluation.match_detections(p, g, 0.3)


def brute_ap(scored, n_truth):
    points = sorted({s for s, _ in scored}, reverse=True)
    recall, precision = [], []
    for s in points:
        above = [tp for x, tp in scored if x >= s]
        recall.append(sum(above) / n_truth)
        precision.append(sum(above) / len(above))
    r, p = np.array([0.0, *recall, 1.0]), np.array([0.0, *precision, 0.0])
    p = np.maximum.accumulate(p[::-1])[::-1]
    return float(np.sum((r[1:] - r[:-1]) * p[1:]))


def test_average_precision(spark):
    rng = random.Random(3)
    scored = [(c, rng.choice([0.5, round(rng.random(), 3)]), rng.random() < 0.4) for c in range(3) for _ in range(400)]
    truths = [(0, 200), (1, 300), (2, 1000), (3, 5)]
    points = spark.createDataFrame(scored, "class_id int, score double, tp boolean").groupBy("class_id", "score").agg(
        F.sum(F.col("tp").cast("long")).alias("tp"), F.count("*").alias("n"))
    got = {r.class_id: r.ap for r in evaluation.average_precision(
        points, spark.createDataFrame(truths, "class_id int, n_truth long"), 64).collect()}
    for c, n in truths[:3]:
        assert got[c] == pytest.approx(brute_ap([(s, t) for k, s, t in scored if k == c], n))
    assert got[3] == 0.0


def test_merge_tags_and_review(spark):
    tag = "map<int,struct<class_name:string,x1:float,y1:float,x2:float,y2:float>>"
    t = lambda name: (name, 0.0, 0.0, 1.0, 1.0)
    old = spark.createDataFrame([(1, {1: t("car"), 2: t("bus")}), (2, None)], f"id int, obj_tags {tag}")
    new = spark.createDataFrame([(1, {2: t("person")}), (3, {1: t("dog")})], f"id int, obj_tags {tag}")
    got = {r.id: r.obj_tags and {k: v.class_name for k, v in r.obj_tags.items()} for r in detections.merge_obj_tags(old, new, ["id"]).collect()}
    assert got == {1: {1: "car", 2: "person"}, 2: None, 3: {1: "dog"}}


def test_annotation_rules(spark):
    rows = [(1, 1, 1, "car", 0.9, 0.0, True), (1, 2, 2, "bus", 0.8, 0.0, True), (1, 3, 1, "car", 0.5, 5.0, True), (2, 1, 127, None, 0.6, 0.0, False)]
    rows += [(3, i, 1, "car", 0.9, float(i), False) for i in range(1, 31)]
    df = spark.createDataFrame(rows, "f int, pos int, class_id int, class_name string, score double, x1 double, is_keyframe boolean")
    df = df.withColumns({c: F.col("x1") + 1 for c in ("y1", "x2", "y2")})
    got = detections.annotation_labels(df, ["f"]).collect()
    one = [r for r in got if r.f == 1]
    assert len(one) == 1 and one[0].labels == ["car: 90%", "bus: 80%"] and one[0].colour == "Red" and one[0].line_width == 6
    two = [r for r in got if r.f == 2][0]
    assert two.labels == ["N/A: 60%"] and two.colour == "Chartreuse" and two.line_width == 4
    assert sorted(r.x1 for r in got if r.f == 3) == [float(i) for i in range(1, 21)]


_CALLS = []


def test_enrich_retries(spark):
    seen = {}

    def flaky(links):
        out = []
        for link in links:
            seen[link] = seen.get(link, 0) + 1
            out.append(None if link == "never" or seen[link] < 3 and link == "late" else f"{link}!{seen[link]}")
        return out

    df = spark.createDataFrame([("a",), ("late",), ("never",)], "url string").coalesce(1)
    got = {r.url: r.o for r in detections.enrich(df, flaky, T.StringType(), "o", batch=2, tries=4, backoff=0.0).collect()}
    assert got == {"a": "a!1", "late": "late!3", "never": None}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.randoms(use_true_random=False))
def test_assignment_is_optimal(n, m, rng):
    cost = np.array([[rng.choice([0.0, rng.random()]) for _ in range(m)] for _ in range(n)])
    pairs = tracking.assign(cost)
    small, big = min(n, m), max(n, m)
    tall = cost if n <= m else cost.T
    best = min(sum(tall[i, p[i]] for i in range(small)) for p in itertools.permutations(range(big), small))
    assert len(pairs) == small and sum(cost[r, c] for r, c in pairs) == pytest.approx(best)


class MatrixTrack:
    """The same motion model written with full matrices."""

    def __init__(self, box):
        self.x = np.concatenate([tracking._measure(box), np.zeros(3)])
        self.p = np.diag([10.0] * 4 + [10000.0] * 3)

    def predict(self):
        f = np.eye(7) + np.eye(7, k=4)
        if self.x[6] + self.x[2] <= 0:
            self.x[6] = 0
        self.x, self.p = f @ self.x, f @ self.p @ f.T + np.diag([1, 1, 1, 1, .01, .01, .0001])

    def update(self, box):
        h = np.eye(4, 7)
        gain = self.p @ h.T @ np.linalg.inv(h @ self.p @ h.T + np.diag([1, 1, 10, 10]))
        self.x = self.x + gain @ (np.array(tracking._measure(box)) - h @ self.x)
        self.p = (np.eye(7) - gain @ h) @ self.p


def test_scalar_filter_equals_matrix_filter():
    rng = random.Random(5)
    box = [10.0, 20.0, 50.0, 80.0]
    a, b = tracking.Track(box, 1, 0), MatrixTrack(box)
    for _ in range(40):
        a.predict(), b.predict()
        if rng.random() < 0.7:
            box = [v + rng.uniform(-3, 6) for v in box[:2]] + [v + rng.uniform(-2, 6) for v in box[2:]]
            a.update(box), b.update(box)
        assert np.allclose(a.pos, b.x[:4]) and np.allclose(a.vel, b.x[4:])


def moving(seed, cameras=3, frames=60, gap=0.25):
    rng, rows = random.Random(seed), []
    for cam in range(cameras):
        for f in range(frames):
            if rng.random() < gap or 25 <= f <= 29:
                continue
            for d in range(3):
                if rng.random() < 0.9:
                    x, y = 60.0 * d + 2 * f + rng.uniform(-2, 2), 10.0 + f
                    rows.append((cam, 0, f, d, d, x, y, x + 40, y + 30))
    return rows


DETS = "camera int, video_id int, frame_num int, det_id int, class_id int, x1 double, y1 double, x2 double, y2 double"


def plain_tracks(rows, skip_empty=False):
    out = []
    for cam in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == cam]
        first, last = min(r[2] for r in mine), max(r[2] for r in mine)
        tracker = tracking.Tracker(1, 3, 0.3)
        for f in range(first, last + 1):
            now = sorted([r for r in mine if r[2] == f], key=lambda r: r[3])
            if now or not skip_empty:
                out += [(cam, f, *map(lambda v: round(v, 6), t[:4]), *t[4:]) for t in tracker.step([r[5:] for r in now], [r[4] for r in now])]
    return sorted(out)


@pytest.mark.parametrize("skip_empty", [False, True])
def test_track_equals_plain_loop(spark, skip_empty):
    rows = moving(6)
    got = tracking.track(spark.createDataFrame(rows, DETS).repartition(7), skip_empty=skip_empty).collect()
    assert sorted((r.camera, r.frame_num, *[round(r[c], 6) for c in tracking.BOX], r.track_id, r.class_id) for r in got) == plain_tracks(rows, skip_empty)


def test_stretches_are_tracked_alike(spark):
    rows = moving(7)
    split = tracking.split_at_gaps(spark.createDataFrame(rows, DETS), limit=10)
    assert split.select("camera", "sequence").distinct().count() > 3
    got = tracking.track(split, ["camera", "sequence"], frame_index="frame_index").collect()
    want = plain_tracks(rows)
    assert sorted((r.camera, r.frame_num, *[round(r[c], 6) for c in tracking.BOX], r.class_id) for r in got) == sorted(w[:6] + w[7:] for w in want)
    ids = lambda keyed: {i: n for n, i in enumerate(dict.fromkeys(keyed))}
    a = ids((r.camera, r.sequence, r.track_id) for r in sorted(got, key=lambda r: (r.camera, r.frame_num, r.track_id)))
    b = ids((w[0], w[6]) for w in sorted(want, key=lambda w: (w[0], w[1], w[6])))
    assert len(a) == len(b)


def plain_nms(rows, threshold):
    """Kept box ids of each group, one box after the other. rows: (image, class, box id, score, x1, y1, x2, y2)."""
    kept = {}
    for r in sorted(rows, key=lambda r: (-r[3], r[2])):
        own = kept.setdefault(r[:2], [])
        if None in r[4:]:
            own.append(r)
            continue

        def iou(k):
            if None in k[4:]:
                return 0.0
            w, h = max(min(k[6], r[6]) - max(k[4], r[4]) + 1, 0), max(min(k[7], r[7]) - max(k[5], r[5]) + 1, 0)
            area = sum((b[6] - b[4] + 1) * (b[7] - b[5] + 1) for b in (k, r))
            return w * h / (area - w * h + 1e-16)
        if all(iou(k) < threshold for k in own):
            own.append(r)
    return sorted((*g, r[2]) for g, rs in kept.items() for r in rs)


@pytest.mark.parametrize("threshold", [0.2, 0.4, 0.7])
def test_crowds_are_settled_in_rounds(spark, threshold):
    rng, rows = random.Random(int(threshold * 10)), []
    for i in range(1500):
        image = 0 if i % 3 else i % 7  # one group with most of the boxes
        x, y, size = rng.uniform(-200, 300), rng.uniform(0, 200), rng.choice([0.2, 3, 20, 90])
        w, h = size * rng.uniform(0.7, 1.4), size * rng.uniform(0.7, 1.4)
        x1 = None if i % 50 == 0 else x
        rows.append((image, i % 2, i, rng.randrange(60) / 60, x1, y, x - 5.0 if i % 40 == 1 else x + w, y + h))
    schema = "image_id long, class_id int, box_id long, score double, x1 double, y1 double, x2 double, y2 double"
    df = spark.createDataFrame(rows, schema)
    want = plain_nms(rows, threshold)
    for crowd in (0, 30, None):
        got = detections.nms(df, 0.0, threshold, crowd=crowd).select("image_id", "class_id", "box_id")
        assert sorted(map(tuple, got.collect())) == want


def test_rounds_follow_chains_not_boxes(spark):
    # a row of boxes, each overlapping the next; scores fall from the left, so the second round needs the first
    def edges(scores):
        rows = [(i, 0, (-s, i), 10.0 * i, 0.0, 10.0 * i + 18, 9.0) for i, s in enumerate(scores)]
        df = spark.createDataFrame(rows, "id long, g int, place struct<o1:double,o2:long>, x1 double, y1 double, x2 double, y2 double")
        return detections.overlapping(df, ["g"], 0.25)
    rng = random.Random(1)
    lost, rounds = detections._suppressed(edges([rng.random() for _ in range(400)]))
    assert 0 < lost.count() < 400 and rounds < 12
    lost, rounds = detections._suppressed(edges([1 - i / 20 for i in range(20)]))
    assert sorted(r.id for r in lost.collect()) == list(range(1, 20, 2)) and rounds == 10
    assert edges([1.0] * 50).count() == 49


def test_crowded_groups_are_no_single_task(spark):
    rows = spark.range(3000).selectExpr("0L as image_id", "cast(0 as int) as class_id", "id as box_id", "0.5 + id % 50 / 100 as score",
                                        "cast(id * 3 % 1999 as double) as x1", "cast(id * 7 % 1999 as double) as y1",
                                        "cast(id * 3 % 1999 + 12 as double) as x2", "cast(id * 7 % 1999 + 12 as double) as y2")
    plan = detections.nms(rows)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Window" not in plan
