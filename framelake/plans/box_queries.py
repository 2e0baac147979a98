"""Queries over boxes, scores, tracks and payloads."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions import boxes, text, vectors
from framelake.operators import dashboards, detections, evaluation, keyframes, ordered, payload, tracking
from framelake.plans import inputs
from framelake.plans.catalog import query
from framelake.sources import files

IMAGE_W, IMAGE_H = 1280, 720
ANCHORS = [(10.0, 13.0), (30.0, 25.0), (62.0, 45.0)]


def _r(col, name, digits=6):
    return F.round(col, digits).alias(name)


@query("p12_topk_softmax", """
WITH l AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
e AS (SELECT *, exp(CAST(x AS DOUBLE) - max(CAST(x AS DOUBLE)) OVER (PARTITION BY vec_id)) AS w FROM l),
p AS (SELECT vec_id, i, w / sum(w) OVER (PARTITION BY vec_id) AS p FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, i) AS rk FROM p)
SELECT vec_id, CAST(rk AS INTEGER) AS rk, CAST(i AS INTEGER) AS class_id, round(p, 6) AS prob FROM r WHERE rk <= 3""")
def p12_topk_softmax(spark, sf):
    top = inputs.table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode(vectors.topk_softmax(F.col("embedding"), 3)).alias("p", "c"))
    return top.select("vec_id", (F.col("p") + 1).alias("rk"), "c.class_id", _r(F.col("c.prob"), "prob"))


@query("t1_top_prediction", """
WITH l AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT vec_id, CAST(arg_max(i, x) AS INTEGER) AS class_id FROM l GROUP BY vec_id""")
def t1_top_prediction(spark, sf):
    best = F.get(vectors.topk_softmax(F.col("embedding"), 1), F.lit(0))
    return inputs.table(spark, sf, "embeddings").select("vec_id", best["class_id"].alias("class_id"))


@query("p21_one_hot", """
SELECT vec_id, array_to_string(list_transform(range(10), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END), '') AS hot FROM embeddings""")
def p21_one_hot(spark, sf):
    hot = vectors.one_hot(F.col("label"), 10)
    return inputs.table(spark, sf, "embeddings").select("vec_id", F.array_join(hot.cast("array<string>"), "").alias("hot"))


@query("d1_best_class", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS class_id,
  round(CAST(list_max(embedding) AS DOUBLE), 6) AS class_conf FROM embeddings""")
def d1_best_class(spark, sf):
    found = detections.best_class(inputs.table(spark, sf, "embeddings"), "embedding")
    return found.select("vec_id", "class_id", _r(F.col("class_conf").cast("double"), "class_conf"))


@query("d3_decode_grid", """
WITH c AS (SELECT vec_id, i % 3 AS anchor, i // 3 AS r, i % 2 AS c, embedding[7 * i + 1 : 7 * i + 7] AS raw
  FROM embeddings, (SELECT unnest(range(9)) AS i)),
a AS (SELECT * FROM (VALUES (0, 10.0, 13.0), (1, 30.0, 25.0), (2, 62.0, 45.0)) AS t(anchor, w, h))
SELECT vec_id, CAST((c.anchor * 3 + r) * 3 + c AS BIGINT) AS box_id, round((1 / (1 + exp(-CAST(raw[1] AS DOUBLE))) + c) * 32, 6) AS cx,
  round((1 / (1 + exp(-CAST(raw[2] AS DOUBLE))) + r) * 32, 6) AS cy, round(exp(CAST(raw[3] AS DOUBLE)) * a.w, 6) AS w,
  round(exp(CAST(raw[4] AS DOUBLE)) * a.h, 6) AS h, round(1 / (1 + exp(-CAST(raw[5] AS DOUBLE))), 6) AS obj_conf,
  round(1 / (1 + exp(-CAST(raw[7] AS DOUBLE))), 6) AS p2
FROM c JOIN a ON a.anchor = c.anchor""")
def d3_decode_grid(spark, sf):
    cells = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda i: F.struct(
        i.alias("i"), F.slice("embedding", 7 * i + 1, F.lit(7)).alias("raw")))
    raw = inputs.table(spark, sf, "embeddings").select("vec_id", F.explode(cells).alias("c")).select(
        "vec_id", F.pmod("c.i", F.lit(3)).alias("anchor"), F.floor(F.col("c.i") / 3).alias("row"),
        F.pmod("c.i", F.lit(2)).alias("col"), "c.raw")
    out = detections.decode_grid(raw, ANCHORS, 3, 32.0)
    return out.select("vec_id", F.col("box_id").cast("long").alias("box_id"), *[_r(F.col(c), c) for c in ("cx", "cy", "w", "h", "obj_conf")],
                      _r(F.get("class_probs", F.lit(1)), "p2"))


@query("p17_boxes", """
SELECT image_id, box_id, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, x2 - x1 AS w, y2 - y1 AS h, (x2 - x1) * (y2 - y1) AS s,
  round((x2 - x1) / (y2 - y1), 6) AS r, round(x1, 6) AS bx1, round(y2, 6) AS by2 FROM boxes_v""")
def p17_boxes(spark, sf):
    corner = boxes.box()
    center, z = boxes.corner_to_center(corner), boxes.box_to_z(corner)
    back = boxes.z_to_box(z)
    again = boxes.center_to_corner(center)
    return inputs.boxes(spark, sf).select(
        "image_id", "box_id", *[c.alias(n) for c, n in zip(center, ("cx", "cy", "w", "h"))], z[2].alias("s"), _r(z[3], "r"),
        _r(back[0], "bx1"), _r(again[3], "by2"))


_IOU = """
WITH p AS (SELECT b.image_id, b.box_id, t.gt_id, b.x1, b.y1, b.x2, b.y2, t.x1 AS g1, t.y1 AS h1, t.x2 AS g2, t.y2 AS h2
  FROM boxes_v b JOIN truth_v t ON t.image_id = b.image_id AND t.gt_id = b.box_id),
q AS (SELECT *, greatest(least(x2, g2) - greatest(x1, g1), 0) * greatest(least(y2, h2) - greatest(y1, h1), 0) AS i,
  greatest(least(x2, g2) - greatest(x1, g1) + 1, 0) * greatest(least(y2, h2) - greatest(y1, h1) + 1, 0) AS ip FROM p)
SELECT image_id, box_id, round(i / ((x2 - x1) * (y2 - y1) + (g2 - g1) * (h2 - h1) - i), 6) AS plain,
  round(ip / ((x2 - x1 + 1) * (y2 - y1 + 1) + (g2 - g1 + 1) * (h2 - h1 + 1) - ip + 1e-16), 6) AS pixel,
  round(i / greatest((x2 - x1) * (y2 - y1) + (g2 - g1) * (h2 - h1) - i, 2.220446049250313e-16), 6) AS eps FROM q"""


@query("p18_iou", _IOU)
def p18_iou(spark, sf):
    t = inputs.truths(spark, sf).select("image_id", F.col("gt_id").alias("box_id"), *[F.col(c).alias("g_" + c) for c in detections.CORNERS])
    pairs = inputs.boxes(spark, sf).join(t, ["image_id", "box_id"])
    return pairs.select("image_id", "box_id", *[_r(boxes.iou(boxes.box(), boxes.box("g_"), m), m) for m in ("plain", "pixel", "eps")])


@query("p19_unletterbox", """
WITH s AS (SELECT *, CASE WHEN box_id % 2 = 0 THEN 1280 ELSE 720 END AS w, CASE WHEN box_id % 2 = 0 THEN 720 ELSE 1280 END AS h FROM boxes_v),
u AS (SELECT *, greatest(h - w, 0) * (416.0::DOUBLE / greatest(h, w)) AS px, greatest(w - h, 0) * (416.0::DOUBLE / greatest(h, w)) AS py FROM s)
SELECT image_id, box_id, CAST(trunc((x1 - floor(px / 2)) / (416 - px) * w) AS INTEGER) AS px, CAST(trunc((y1 - floor(py / 2)) / (416 - py) * h) AS INTEGER) AS py,
  CAST(trunc((x2 - x1) / (416 - px) * w) AS INTEGER) AS pw, CAST(trunc((y2 - y1) / (416 - py) * h) AS INTEGER) AS ph,
  CAST(round_even(w * least(416.0::DOUBLE / w, 416.0::DOUBLE / h), 0) AS INTEGER) AS resized_w,
  CAST(trunc(greatest((round_even(w * least(416.0::DOUBLE / w, 416.0::DOUBLE / h), 0) - round_even(h * least(416.0::DOUBLE / w, 416.0::DOUBLE / h), 0)) / 2, 0)) AS INTEGER) AS pad_y
FROM u""")
def p19_unletterbox(spark, sf):
    even = F.pmod("box_id", F.lit(2)) == 0
    w = F.when(even, F.lit(IMAGE_W)).otherwise(F.lit(IMAGE_H))
    h = F.when(even, F.lit(IMAGE_H)).otherwise(F.lit(IMAGE_W))
    letter = boxes.letterbox(w, h)
    return inputs.boxes(spark, sf).select(
        "image_id", "box_id", *[c.alias(n) for n, c in boxes.unletterbox(boxes.box(), w, h).items()],
        letter["resized_w"].alias("resized_w"), letter["pad_y"].alias("pad_y"))


@query("p20_padded_labels", """
SELECT image_id, box_id, round((((x1 + x2) / 2) / w * w + floor(greatest(h - w, 0) / 2)) / greatest(h, w), 6) AS cx,
  round((((y1 + y2) / 2) / h * h + floor(greatest(w - h, 0) / 2)) / greatest(h, w), 6) AS cy,
  round((x2 - x1) / w * w / greatest(h, w), 6) AS w, round((y2 - y1) / h * h / greatest(h, w), 6) AS h
FROM (SELECT *, 100 + image_id % 57 AS w, 100 + box_id % 43 AS h FROM boxes_v)""")
def p20_padded_labels(spark, sf):
    w, h = 100 + F.pmod("image_id", F.lit(57)), 100 + F.pmod("box_id", F.lit(43))
    cx, cy, bw, bh = boxes.corner_to_center(boxes.box())
    out = boxes.pad_adjust_label((cx / w, cy / h, bw / w, bh / h), w, h)
    return inputs.boxes(spark, sf).select("image_id", "box_id", *[_r(c, n) for n, c in out.items()])


_CLASSES = "(SELECT 0 AS class_id, 'person' AS class_name UNION ALL SELECT 1, 'bicycle')"


@query("p24_class_name", f"""
SELECT b.image_id, b.box_id, coalesce(c.class_name, 'N/A') AS class_name FROM boxes_v b LEFT JOIN {_CLASSES} c ON c.class_id = b.class_id""")
def p24_class_name(spark, sf):
    names = spark.createDataFrame([(0, "person"), (1, "bicycle")], "class_id int, name string")
    return detections.name_classes(inputs.boxes(spark, sf), names).select("image_id", "box_id", "class_name")


_ANNOTATED = """
WITH r AS (SELECT image_id, class_id, score, x1, y1, x2, y2, box_id, row_number() OVER (PARTITION BY image_id ORDER BY box_id) AS rk FROM boxes_v),
s AS (SELECT *, CASE class_id WHEN 0 THEN 'person' WHEN 1 THEN 'bicycle' ELSE 'N/A' END || ': ' || CAST(trunc(score * 100) AS INTEGER) || '%' AS label
  FROM r WHERE rk <= {n} AND score > 0.5)
SELECT image_id, x1, y1, x2, y2, string_agg(label, '|' ORDER BY box_id) AS labels,
  CASE WHEN image_id % 2 = 0 THEN 'Red' ELSE (['AliceBlue', 'Chartreuse', 'Aqua'])[arg_max(class_id, box_id) + 1] END AS colour,
  CASE WHEN image_id % 2 = 0 THEN 6 ELSE 4 END AS line_width
FROM s GROUP BY image_id, x1, y1, x2, y2"""


def _annotated(spark, sf, *limit):
    name = F.get(F.array(F.lit("person"), F.lit("bicycle")), F.col("class_id"))
    rows = inputs.boxes(spark, sf).withColumns({"pos": F.col("box_id"), "class_name": name,
                                                "is_keyframe": F.pmod("image_id", F.lit(2)) == 0})
    out = detections.annotation_labels(rows, ["image_id"], *limit)
    return out.select("image_id", *detections.CORNERS, F.array_join("labels", "|").alias("labels"), "colour", "line_width")


@query("p25_annotation_labels", _ANNOTATED.format(n=3))
def p25_annotation_labels(spark, sf):
    return _annotated(spark, sf, 3)


@query("p25_annotation_labels_default", _ANNOTATED.format(n=20))
def p25_annotation_labels_default(spark, sf):
    return _annotated(spark, sf)


_NMS = """
once AS (SELECT * FROM {boxes} WHERE score >= 0.5
  QUALIFY row_number() OVER (PARTITION BY image_id, class_id, x1, y1, x2, y2 ORDER BY score DESC, box_id) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY image_id, class_id ORDER BY score DESC, box_id) AS rn FROM once),
rec AS (
  SELECT image_id, class_id, rn, [{{'b': box_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}] AS kept FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.image_id, r.class_id, r.rn, CASE WHEN len(list_filter(k.kept, lambda a:
      greatest(least(a.x2, r.x2) - greatest(a.x1, r.x1) + 1, 0) * greatest(least(a.y2, r.y2) - greatest(a.y1, r.y1) + 1, 0) /
      ((a.x2 - a.x1 + 1) * (a.y2 - a.y1 + 1) + (r.x2 - r.x1 + 1) * (r.y2 - r.y1 + 1) -
        greatest(least(a.x2, r.x2) - greatest(a.x1, r.x1) + 1, 0) * greatest(least(a.y2, r.y2) - greatest(a.y1, r.y1) + 1, 0) + 1e-16) >= 0.4)) > 0
    THEN k.kept ELSE list_append(k.kept, {{'b': r.box_id, 'x1': r.x1, 'y1': r.y1, 'x2': r.x2, 'y2': r.y2}}) END
  FROM rec k JOIN ranked r ON r.image_id = k.image_id AND r.class_id = k.class_id AND r.rn = k.rn + 1),
last AS (SELECT image_id, class_id, arg_max(kept, rn) AS kept FROM rec GROUP BY image_id, class_id)
SELECT image_id, class_id, unnest(list_transform(kept, lambda a: a.b)) AS box_id FROM last"""


@query("d2_nms", "WITH " + _NMS.format(boxes="boxes_v").lstrip(), recursive=True)
def d2_nms(spark, sf):
    return detections.nms(inputs.boxes(spark, sf)).select("image_id", "class_id", "box_id")


@query("d2_nms_crowded", """WITH odd AS (
  SELECT image_id, box_id, class_id, score, CASE WHEN box_id % 11 = 0 THEN NULL ELSE x1 END AS x1, y1, CASE WHEN box_id % 13 = 0 THEN x1 - 5 ELSE x2 END AS x2, y2
  FROM (SELECT image_id // 16 AS image_id, box_id * 2 + c AS box_id, class_id, score, x1, y1, x2, y2 FROM boxes_v, (SELECT 0 AS c UNION ALL SELECT 1))),""" + _NMS.format(boxes="odd"), recursive=True)
def d2_nms_crowded(spark, sf):
    """Groups above the limit, with copies, boxes that lack a corner and boxes turned inside out."""
    twice = inputs.boxes(spark, sf).withColumns({"image_id": F.floor(F.col("image_id") / 16).cast("long"), "c": F.explode(F.array(F.lit(0), F.lit(1)))})
    twice = twice.withColumn("box_id", F.col("box_id") * 2 + F.col("c")).drop("c")
    odd = twice.withColumns({"x1": F.when(F.pmod("box_id", F.lit(11)) != 0, F.col("x1")),
                             "x2": F.when(F.pmod("box_id", F.lit(13)) == 0, F.col("x1") - 5).otherwise(F.col("x2"))})
    return detections.nms(odd, crowd=5).select("image_id", "class_id", "box_id")


@query("f6_confidence_filter", "SELECT image_id, box_id, score FROM boxes_v WHERE score >= 0.8")
def f6_confidence_filter(spark, sf):
    from framelake.operators.selection import confidence_filter
    return confidence_filter(inputs.boxes(spark, sf), 0.8, "score").select("image_id", "box_id", "score")


@query("d5_detections_long", """
SELECT event_id, pos, CAST(class_id AS INTEGER) AS class_id, name AS class_name, round(score, 6) AS score, round(x1, 6) AS x1, round(y2, 6) AS y2 FROM objects_v""")
def d5_detections_long(spark, sf):
    long = detections.detections_long(inputs.frames(spark, sf), "event_id")
    return long.select("event_id", "pos", "class_id", "class_name", _r(F.col("score"), "score"), _r(F.col("x1"), "x1"), _r(F.col("y2"), "y2"))


_ENRICHED = T.ArrayType(T.StringType())


def _stand_in_detector(links):
    """Answers from the link alone: nothing for every tenth image, else its last three digits."""
    number = [int(link.rsplit("/", 1)[1]) for link in links]
    return [None if n % 10 == 0 else list(str(n % 1000)) for n in number]


@query("d4_enrich", """
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE length(CAST(event_id % 1000 AS VARCHAR)) END AS n_objects FROM frames_v""")
def d4_enrich(spark, sf):
    links = inputs.frames(spark, sf).select("event_id", F.concat(F.lit(inputs.URL_PREFIX), F.col("event_id").cast("string")).alias("url"))
    asked = detections.enrich(links, _stand_in_detector, _ENRICHED, batch=64, backoff=0.0)
    return asked.select("event_id", F.size("objs").cast("long").alias("n_objects"))


_MATCH = """
pairs AS (SELECT t.image_id, t.class_id, t.gt_id, b.box_id, b.score,
    greatest(least(b.x2, t.x2) - greatest(b.x1, t.x1) + 1, 0) * greatest(least(b.y2, t.y2) - greatest(b.y1, t.y1) + 1, 0) AS i,
    (b.x2 - b.x1 + 1) * (b.y2 - b.y1 + 1) + (t.x2 - t.x1 + 1) * (t.y2 - t.y1 + 1) AS a
  FROM truth_v t JOIN boxes_v b ON b.image_id = t.image_id AND b.class_id = t.class_id WHERE b.score > {score}),
best AS (SELECT *, i / (a - i + 1e-16) AS iou FROM pairs WHERE i / (a - i + 1e-16) > 0.5),
matched AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, gt_id ORDER BY iou DESC, score DESC, box_id) AS rk FROM best) WHERE rk = 1)"""


@query("j4_match", "WITH " + _MATCH.format(score=0.5).strip() + """
SELECT image_id, class_id, gt_id, box_id, round(iou, 6) AS iou FROM matched""")
def j4_match(spark, sf):
    found = evaluation.match_detections(inputs.boxes(spark, sf), inputs.truths(spark, sf))
    return found.select("image_id", "class_id", "gt_id", "box_id", _r(F.col("iou"), "iou"))


@query("j4_detection_counts", "WITH " + _MATCH.format(score=0.5).strip() + """
SELECT t.class_id, n_truth, n_proposals, n_correct, round(n_correct / n_truth, 6) AS recall, round(n_correct / n_proposals, 6) AS precision
FROM (SELECT class_id, count(*) AS n_truth FROM truth_v GROUP BY class_id) t
JOIN (SELECT class_id, count(*) AS n_proposals FROM boxes_v WHERE score > 0.5 GROUP BY class_id) p ON p.class_id = t.class_id
JOIN (SELECT class_id, count(*) AS n_correct FROM matched GROUP BY class_id) m ON m.class_id = t.class_id""")
def j4_detection_counts(spark, sf):
    pred, truth = inputs.boxes(spark, sf), inputs.truths(spark, sf)
    out = evaluation.detection_counts(pred, truth, evaluation.match_detections(pred, truth))
    return out.select("class_id", "n_truth", "n_proposals", "n_correct", _r(F.col("recall"), "recall"), _r(F.col("precision"), "precision"))


_AP = "WITH " + _MATCH.format(score=-1).strip() + """,
pts AS (SELECT b.class_id, b.score, CAST(sum(CASE WHEN m.box_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS tp, count(*) AS n
  FROM boxes_v b LEFT JOIN (SELECT DISTINCT image_id, box_id FROM matched) m ON m.image_id = b.image_id AND m.box_id = b.box_id GROUP BY b.class_id, b.score),
curve AS (SELECT *, sum(tp) OVER w / sum(n) OVER w AS prec FROM pts WINDOW w AS (PARTITION BY class_id ORDER BY score DESC)),
env AS (SELECT *, max(prec) OVER (PARTITION BY class_id ORDER BY score) AS e FROM curve),
gt AS (SELECT class_id, count(*) AS n_truth FROM truth_v GROUP BY class_id),
ap AS (SELECT env.class_id, n_truth, sum(tp * e) / n_truth AS ap FROM env JOIN gt ON gt.class_id = env.class_id GROUP BY env.class_id, n_truth)
"""


def _precision_by_class(spark, sf):
    pred, truth = inputs.boxes(spark, sf), inputs.truths(spark, sf)
    points = evaluation.precision_points(pred, evaluation.match_detections(pred, truth, 0.5, -1.0))
    return evaluation.average_precision(points, truth.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_truth")))


@query("a10_average_precision", _AP + "SELECT class_id, n_truth, round(ap, 6) AS ap FROM ap")
def a10_average_precision(spark, sf):
    return _precision_by_class(spark, sf).select("class_id", "n_truth", _r(F.col("ap"), "ap"))


@query("a10_mean_average_precision", _AP + "SELECT round(avg(ap), 6) AS map FROM ap")
def a10_mean_average_precision(spark, sf):
    return evaluation.mean_average_precision(_precision_by_class(spark, sf)).select(_r(F.col("map"), "map"))


@query("d6_evaluate", _AP + """, m5 AS (SELECT class_id, count(*) AS n_correct FROM (SELECT class_id, image_id, gt_id, row_number() OVER (PARTITION BY image_id, gt_id ORDER BY iou DESC) AS rk FROM best WHERE score > 0.5) WHERE rk = 1 GROUP BY class_id),
pr AS (SELECT class_id, count(*) AS n_proposals FROM boxes_v WHERE score > 0.5 GROUP BY class_id)
SELECT ap.class_id, n_truth, n_proposals, n_correct, round(n_correct / n_truth, 6) AS recall, round(n_correct / n_proposals, 6) AS precision, round(ap, 6) AS ap
FROM ap JOIN m5 ON m5.class_id = ap.class_id JOIN pr ON pr.class_id = ap.class_id""")
def d6_evaluate(spark, sf):
    out = evaluation.evaluate(inputs.boxes(spark, sf), inputs.truths(spark, sf))
    return out.select("class_id", "n_truth", "n_proposals", "n_correct", *[_r(F.col(c), c) for c in ("recall", "precision", "ap")])


@query("j5_anchor", """
WITH g AS (SELECT image_id, box_id, (x1 + x2) / 2 / 128 * 13 AS gx, (y1 + y2) / 2 / 128 * 13 AS gy, (x2 - x1) / 128 * 13 AS gw, (y2 - y1) / 128 * 13 AS gh FROM boxes_v),
f AS (SELECT g.*, a.k, a.aw, a.ah, (least(gw, aw) + 1) * (least(gh, ah) + 1) / ((gw + 1) * (gh + 1) + (aw + 1) * (ah + 1) - (least(gw, aw) + 1) * (least(gh, ah) + 1) + 1e-16) AS iou
  FROM g, (VALUES (0, 1.25::DOUBLE, 1.625::DOUBLE), (1, 2.5::DOUBLE, 2.0::DOUBLE), (2, 4.0::DOUBLE, 3.0::DOUBLE)) AS a(k, aw, ah)),
r AS (SELECT *, row_number() OVER (PARTITION BY image_id, box_id ORDER BY iou DESC, k) AS rk FROM f)
SELECT image_id, box_id, CAST(max(CASE WHEN rk = 1 THEN k END) AS INTEGER) AS anchor, CAST(floor(max(gx)) AS INTEGER) AS gi, CAST(floor(max(gy)) AS INTEGER) AS gj,
  round(max(gx) - floor(max(gx)), 6) AS tx, round(max(CASE WHEN rk = 1 THEN ln(gw / aw + 1e-16) END), 6) AS tw,
  coalesce(string_agg(CASE WHEN rk > 1 AND iou > 0.5 THEN CAST(k AS VARCHAR) END, ',' ORDER BY k), '') AS ignored
FROM r GROUP BY image_id, box_id""")
def j5_anchor(spark, sf):
    cx, cy, w, h = boxes.corner_to_center(boxes.box())
    truth = inputs.boxes(spark, sf).select("image_id", "box_id", (cx / 128).alias("cx"), (cy / 128).alias("cy"), (w / 128).alias("w"), (h / 128).alias("h"))
    out = evaluation.assign_anchor(truth, [(1.25, 1.625), (2.5, 2.0), (4.0, 3.0)], 13)
    return out.select("image_id", "box_id", "anchor", "gi", "gj", _r(F.col("tx"), "tx"), _r(F.col("tw"), "tw"),
                      F.array_join(F.col("ignored").cast("array<string>"), ",").alias("ignored"))


@query("a8_object_histogram", """
SELECT CAST(class_id AS INTEGER) AS class_id, count(*) AS objects, count(DISTINCT event_id) AS frames FROM objects_v GROUP BY class_id""")
def a8_object_histogram(spark, sf):
    return dashboards.object_histogram(keyframes.prepare_value(inputs.frames(spark, sf)))


@query("a8_frame_object_counts", """
SELECT event_id, CAST(class_id AS INTEGER) AS class_id, count(*) AS n FROM objects_v GROUP BY event_id, class_id""")
def a8_frame_object_counts(spark, sf):
    return dashboards.object_counts_long(keyframes.prepare_value(inputs.frames(spark, sf)), "event_id")


def _followed(spark, sf):
    """Each camera's frames in dense order; a video is twenty frames, its boxes move with the frame number."""
    frames = inputs.frames(spark, sf).select("camera", "event_id", "objs")
    dense = ordered.number_rows(frames, ["camera"], ["event_id"], "frame_num")
    dets = detections.detections_long(dense, "camera", "frame_num")
    drift = F.pmod("frame_num", F.lit(20)) * 2
    place = {"x1": 40 * F.col("class_id") + drift, "y1": 30.0 * F.col("pos"), "x2": 40 * F.col("class_id") + drift + 30, "y2": 30.0 * F.col("pos") + 25}
    return dets.withColumns({"video_id": F.floor(F.col("frame_num") / 20).cast("long"), "det_id": F.col("pos"), **{k: v.cast("double") for k, v in place.items()}})


def _tracks(spark, sf):
    return tracking.track(_followed(spark, sf))


#: Boxes of one place and class are one object, far from the others; it is lost after two frames without it, and shown when seen in three
#: frames running after its first (or in the first three frames).
_ISLANDS = """
WITH dense AS (SELECT * EXCLUDE (frame_num), row_number() OVER (PARTITION BY camera ORDER BY event_id) - 1 AS frame_num FROM frames_v),
dets AS (SELECT d.camera, d.frame_num // 20 AS video_id, d.frame_num, o.pos, o.class_id FROM dense d JOIN objects_v o USING (event_id)),
seen AS (SELECT *, frame_num - lag(frame_num) OVER o AS gap, frame_num - min(frame_num) OVER (PARTITION BY camera, video_id) + 1 AS frame_count
  FROM dets WINDOW o AS (PARTITION BY camera, video_id, pos, class_id ORDER BY frame_num)),
islands AS (SELECT *, sum((gap IS NULL OR gap > 2)::INT) OVER o AS island, sum((gap IS NULL OR gap > 1)::INT) OVER o AS run FROM seen
  WINDOW o AS (PARTITION BY camera, video_id, pos, class_id ORDER BY frame_num)),
streaks AS (SELECT *, row_number() OVER (PARTITION BY camera, video_id, pos, class_id, run ORDER BY frame_num)
    - (min(frame_num) OVER (PARTITION BY camera, video_id, pos, class_id, run) = min(frame_num) OVER (PARTITION BY camera, video_id, pos, class_id, island))::INT AS streak,
  min(frame_num) OVER (PARTITION BY camera, video_id, pos, class_id, island) AS born FROM islands),
tracks AS (SELECT *, dense_rank() OVER (PARTITION BY camera, video_id ORDER BY born, pos, class_id) AS track_id FROM streaks),
shown AS (SELECT camera, video_id, frame_num, track_id, CAST(class_id AS INTEGER) AS class_id FROM tracks WHERE streak >= 3 OR frame_count <= 3)
"""


@query("d9_track")
def d9_track(spark, sf):
    return _tracks(spark, sf).select("camera", "video_id", "frame_num", "track_id", "class_id", *[_r(F.col(c), c, 4) for c in detections.CORNERS])


@query("d9_track_numbers", _ISLANDS + "SELECT * FROM shown")
def d9_track_numbers(spark, sf):
    """Which object has which track in which frame."""
    return _tracks(spark, sf).select("camera", "video_id", "frame_num", "track_id", "class_id")


@query("a11_track_summary", _ISLANDS + """
SELECT camera, count(DISTINCT (video_id, frame_num)) AS frames, count(DISTINCT (video_id, track_id)) AS tracks,
  count(*) / count(DISTINCT (video_id, track_id)) AS mean_length FROM shown GROUP BY camera""")
def a11_track_summary(spark, sf):
    return tracking.track_summary(_tracks(spark, sf))


@query("d10_mot_lines", """
SELECT format('{},{},{:.2f},{:.2f},{:.2f},{:.2f},1,-1,-1,-1', image_id, box_id, x1, y1, x2 - x1, y2 - y1) AS value FROM boxes_v""")
def d10_mot_lines(spark, sf):
    return tracking.mot_lines(inputs.boxes(spark, sf), "image_id", "box_id")


@query("s9_read_mot", "SELECT image_id AS frame, box_id AS id, x1, y1, x2, y2, score FROM boxes_v")
def s9_read_mot(spark, sf):
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    lines = inputs.boxes(spark, sf).select(F.concat_ws(",", "image_id", "box_id", "x1", "y1", w, h, "score").alias("value"))
    return files.mot_boxes(lines)


_LABELS = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY box_id) AS rk FROM boxes_v)
SELECT image_id, CAST(rk - 1 AS INTEGER) AS pos, class_id, x1 / 100 AS cx, y1 / 100 AS cy, x2 / 100 AS w, y2 / 100 AS h,
  'labels/' || image_id || '.txt' AS label_path FROM r WHERE rk <= {n}"""


def _labels(spark, sf, **limit):
    line = F.concat_ws(" ", "class_id", F.col("x1") / 100, F.col("y1") / 100, F.col("x2") / 100, F.col("y2") / 100)
    texts = inputs.boxes(spark, sf).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("box_id", line.alias("l")))).alias("r"))
    path = files.label_path(F.concat(F.lit("images/"), F.col("image_id").cast("string"), F.lit(".jpg")))
    value = F.array_join(F.transform("r", lambda s: s["l"]), "\n")
    return files.label_rows(texts.select("image_id", path.alias("label_path"), value.alias("value")), "image_id", "label_path", **limit)


@query("s10_read_label_files", _LABELS.format(n=2))
def s10_read_label_files(spark, sf):
    return _labels(spark, sf, max_objects=2)


@query("s10_read_label_files_default", _LABELS.format(n=50))
def s10_read_label_files_default(spark, sf):
    return _labels(spark, sf)


@query("s11_class_names", """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS class_id, parts[i] AS name
FROM (SELECT doc_id, parts, unnest(range(1, len(parts))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))""")
def s11_class_names(spark, sf):
    return files.class_names(inputs.table(spark, sf, "documents").select("doc_id", F.col("text").alias("value")), "doc_id")


@query("s5_scene_taxonomy", """
WITH w AS (SELECT p_partkey, p_type, unnest(string_split(p_name, ' ')) AS raw_scene FROM part)
SELECT raw_scene, arg_max(p_type, p_partkey) AS scene_type FROM w GROUP BY raw_scene""")
def s5_scene_taxonomy(spark, sf):
    lines = inputs.table(spark, sf, "part").select(F.col("p_partkey").alias("line_no"), F.concat_ws(" ", "p_type", "p_name").alias("value"))
    return files.taxonomy_lines(lines)


@query("p15_tensor_check", """
SELECT page_id, octet_length(encode(html)) AS n_bytes, page_id % 5 <> 0 AS intact FROM pages""")
def p15_tensor_check(spark, sf):
    return payload.decode_tensor(_page_messages(spark, sf)).select(
        "page_id", F.octet_length("data").cast("long").alias("n_bytes"), "intact")


def _page_messages(spark, sf):
    """Page texts as one-channel frames; the shape of every fifth one is wrong."""
    raw = F.encode("html", "UTF-8")
    rows = F.octet_length(raw) + F.when(F.pmod("page_id", F.lit(5)) == 0, 1).otherwise(0)
    return inputs.table(spark, sf, "pages").select(
        "page_id", *payload.encode_tensor(raw, "|u1", F.array(rows, F.lit(1))),
        F.col("page_id").alias("frame_num"), F.pmod("page_id", F.lit(4)).alias("camera"),
        (F.lit(1704067200000) + F.col("page_id") * 1000).alias("timestamp"), F.lit("CA").alias("location"))


@query("p16_frame_profile", """
WITH t AS (SELECT doc_id, encode(text) AS b FROM documents WHERE octet_length(encode(text)) > 0),
d AS (SELECT doc_id, rpad(hex(b), CAST(ceil(octet_length(b) / 24) * 48 AS INTEGER), '20') AS h, CAST(ceil(octet_length(b) / 24) AS INTEGER) AS rows FROM t),
p AS (SELECT doc_id, rows, unnest(regexp_extract_all(h, '.{6}')) AS x FROM d),
g AS (SELECT doc_id, rows, (299 * ('0x' || x[1:2])::INT + 587 * ('0x' || x[3:4])::INT + 114 * ('0x' || x[5:6])::INT + 500) // 1000 AS grey FROM p)
SELECT doc_id, avg(grey) AS grey_mean, CAST(sum(grey) AS DOUBLE) AS top_sum, CAST(sum(grey) AS DOUBLE) AS bottom_sum,
  CASE WHEN any_value(rows) > 8 THEN 270 ELSE 180 END AS turn FROM g GROUP BY doc_id""")
def p16_frame_profile(spark, sf):
    """Texts of documents as three-channel frames eight pixels wide, padded to full rows."""
    size = F.octet_length("text")
    rows = F.ceil(size / 24).cast("int")
    data = F.rpad(F.encode("text", "UTF-8"), rows * 24, F.lit(b" "))
    frames = inputs.table(spark, sf, "documents").filter(size > 0).select(
        "doc_id", *payload.encode_tensor(data, "|u1", F.array(rows, F.lit(8), F.lit(3))))
    return payload.frame_profile(payload.decode_tensor(frames), "doc_id")


@query("sk4_store_payload", """
SELECT 'store/' || strftime(make_timestamp((1704067200000 + page_id * 1000) * 1000), '%Y%m%d') || '/' || page_id % 4 || '/' || (1704067200000 + page_id * 1000) || '.jpg' AS s3_key,
  page_id % 4 AS camera, 1704067200000 + page_id * 1000 AS timestamp, page_id AS frame_num, 'CA' AS location, octet_length(encode(html)) AS n_bytes FROM pages""")
def sk4_store_payload(spark, sf):
    wire = _page_messages(spark, sf)
    stored = payload.payload_rows(wire, inputs.STORE_PREFIX).select("s3_key", F.octet_length("data").cast("long").alias("n_bytes"))
    return payload.url_rows(wire, inputs.STORE_PREFIX).join(stored, "s3_key")
