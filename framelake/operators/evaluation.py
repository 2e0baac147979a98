"""Matching detections with ground truth and scoring them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions import boxes
from framelake.operators import ordered
from framelake.session import stored

CORNERS = ["x1", "y1", "x2", "y2"]


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("long")


def match_detections(pred: DataFrame, truth: DataFrame, iou_threshold: float = 0.5, min_score: float = 0.5,
                     image: str = "image_id", cell: float = 64.0) -> DataFrame:
    """Best prediction of every ground-truth box: same image and class, score and IoU above the thresholds.

    One row per matched box of `truth`, with `box_id`, `iou` and `score`; ties go to the higher score, then
    the lower `box_id`. Two boxes whose IoU exceeds one half contain each other's centre, so a prediction
    meets only the truths that cover the grid cell of its centre; the join key holds the cell, which also
    splits a crowded image. Copies of one predicted box shrink to the best of them before the join, and
    copies of one truth are matched once.
    """
    matched = _matched(pred, truth, iou_threshold, {"m": min_score}, image, cell).drop("copies")
    return truth.join(matched, [image, "class_id", *CORNERS]).select(image, "class_id", "gt_id", "m.*")


def _matched(pred: DataFrame, truth: DataFrame, iou_threshold: float, least: dict[str, float], image: str = "image_id", cell: float = 64.0) -> DataFrame:
    """One join for several score limits: per place of truths that has some match its number of copies and, for each name in `least`, the best
    prediction scored above that limit (null if none)."""
    if iou_threshold < 0.5:
        raise ValueError("the centre rule needs an IoU threshold of at least 0.5")
    # The best copy of a box passes every limit that any copy passes.
    best = F.min_by(F.struct("score", "box_id"), F.struct(-F.col("score"), F.col("box_id")))
    p = (pred.filter(F.col("score") > min(least.values())).groupBy(image, "class_id", *CORNERS).agg(best.alias("b"))
         .select(image, "class_id", *[F.col(c).alias("p_" + c) for c in CORNERS], "b.score", "b.box_id",
                 _cell((F.col("x1") + F.col("x2") + 1) / 2, cell).alias("cell_x"),
                 _cell((F.col("y1") + F.col("y2") + 1) / 2, cell).alias("cell_y")))
    covered = lambda lo, hi: F.explode(F.sequence(_cell(F.col(lo), cell), _cell(F.col(hi) + 1, cell)))
    place = [image, "class_id", *CORNERS]
    g = (truth.groupBy(*place).agg(F.count(F.lit(1)).alias("copies"))
         .withColumn("cell_x", covered("x1", "x2")).withColumn("cell_y", covered("y1", "y2")))
    overlap = boxes.iou(boxes.box(), boxes.box("p_"), "pixel")
    pairs = (g.join(p, [image, "class_id", "cell_x", "cell_y"]).withColumn("iou", overlap)
             .filter(F.col("iou") > iou_threshold))
    first = F.struct(-F.col("iou"), -F.col("score"), F.col("box_id"))
    match = F.struct("box_id", "iou", "score")
    return pairs.groupBy(*place, "copies").agg(*[F.min_by(match, F.when(F.col("score") > t, first)).alias(name) for name, t in least.items()])


def detection_counts(pred: DataFrame, truth: DataFrame, matched: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Ground truths, proposals, correct ones, recall and precision per class."""
    n = lambda df, name: df.groupBy("class_id").agg(F.count(F.lit(1)).alias(name))
    proposals = pred.filter(F.col("score") > min_score)
    return _ratios(n(truth, "n_truth").join(n(proposals, "n_proposals"), "class_id", "full")
                   .join(n(matched, "n_correct"), "class_id", "left").na.fill(0))


def _ratios(counts: DataFrame) -> DataFrame:
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(1.0 if b == "n_truth" else 0.0))
    return counts.withColumns({"recall": ratio("n_correct", "n_truth"), "precision": ratio("n_correct", "n_proposals")})


def precision_points(pred: DataFrame, matched: DataFrame, image: str = "image_id") -> DataFrame:
    """Predictions `n` and right ones `tp` per class and score; only these sums are shuffled.

    A box counts once, however many truths it is the best for.
    """
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    right = matched.select(image, "class_id", "box_id", "score").distinct()
    both = (pred.select("class_id", "score", zero.alias("tp"), one.alias("n"))
            .unionByName(right.select("class_id", "score", one.alias("tp"), zero.alias("n"))))
    return both.groupBy("class_id", "score").agg(F.sum("tp").alias("tp"), F.sum("n").alias("n"))


def average_precision(points: DataFrame, truths: DataFrame, pieces: int = 1024) -> DataFrame:
    """Area under the precision envelope per class.

    `points` has class_id, score in 0..1, tp and n, one row per class and score; `truths` has class_id and n_truth.
    The points are accumulated by descending score and the envelope by ascending score, both in `pieces` score
    ranges per class. Recall grows by tp / n_truth at each point.
    """
    piece = F.floor(F.col("score") * pieces)
    curve = ordered.running(points, ["class_id"], ["score"],
                            {"sum_tp": ("sum", F.col("tp")), "sum_n": ("sum", F.col("n"))}, True, piece=piece)
    curve = curve.select("class_id", "score", "tp", (F.col("sum_tp") / F.col("sum_n")).alias("precision"))
    envelope = ordered.running(curve, ["class_id"], ["score"], {"envelope": ("max", F.col("precision"))}, piece=piece)
    gained = envelope.groupBy("class_id").agg(F.sum(F.col("tp") * F.col("envelope")).alias("gained"))
    return (truths.join(gained, "class_id", "left")
            .select("class_id", "n_truth", F.coalesce(F.try_divide(F.col("gained"), F.col("n_truth")), F.lit(0.0)).alias("ap")))


def mean_average_precision(ap: DataFrame) -> DataFrame:
    return ap.agg(F.avg("ap").alias("map"))


def evaluate(pred: DataFrame, truth: DataFrame, iou_threshold: float = 0.5, min_score: float = 0.5) -> DataFrame:
    """Recall and precision above `min_score`, and average precision over all scores, per class."""
    matched = stored(_matched(pred, truth, iou_threshold, {"sure": min_score, "any": -1.0}), "matched")
    points = precision_points(pred, matched.select("image_id", "class_id", "any.*"))
    truths = truth.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_truth"))
    correct = matched.filter("sure is not null").groupBy("class_id").agg(F.sum("copies").alias("n_correct"))
    proposed = points.groupBy("class_id").agg(F.sum(F.when(F.col("score") > min_score, F.col("n")).otherwise(F.lit(0).cast("long"))).alias("n_proposals"))
    counts = _ratios(truths.join(proposed.filter("n_proposals > 0"), "class_id", "full").join(correct, "class_id", "left").na.fill(0))
    return counts.join(average_precision(points, truths).select("class_id", "ap"), "class_id", "left")


def assign_anchor(truth: DataFrame, anchors: Sequence[tuple[float, float]], grid: int, ignore: float = 0.5) -> DataFrame:
    """Training target of each normalised centre box: cell, best anchor by shape, offsets and ignored anchors.

    `anchors` are in grid units; shapes are compared at the origin with pixel IoU.
    """
    zero = F.lit(0.0)
    shapes = F.array(*[F.struct(F.lit(float(w)).alias("w"), F.lit(float(h)).alias("h")) for w, h in anchors])
    scaled = truth.withColumns({g: F.col(c) * grid for g, c in {"gx": "cx", "gy": "cy", "gw": "w", "gh": "h"}.items()})
    fit = F.transform(shapes, lambda a: boxes.iou((zero, zero, F.col("gw"), F.col("gh")), (zero, zero, a["w"], a["h"]), "pixel"))
    found = scaled.withColumn("_iou", fit).withColumn("anchor", (F.array_position("_iou", F.array_max("_iou")) - 1).cast("int"))
    chosen = F.get(shapes, F.col("anchor"))
    ignored = F.filter(F.transform("_iou", lambda v, i: F.when((v > ignore) & (i != F.col("anchor")), i)), lambda i: i.isNotNull())
    return found.withColumns({
        "gi": F.floor("gx").cast("int"), "gj": F.floor("gy").cast("int"),
        "tx": F.col("gx") - F.floor("gx"), "ty": F.col("gy") - F.floor("gy"),
        "tw": F.log(F.col("gw") / chosen["w"] + 1e-16), "th": F.log(F.col("gh") / chosen["h"] + 1e-16),
        "ignored": ignored,
    }).drop("_iou", "gx", "gy", "gw", "gh")
