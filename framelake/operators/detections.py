"""Tables of detected boxes."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions import boxes, text, vectors
from framelake.functions.messages import object_class, object_name
from framelake.session import stored

CORNERS = ["x1", "y1", "x2", "y2"]


def best_class(df: DataFrame, probs: str = "class_probs") -> DataFrame:
    """Add `class_id` and `class_conf` of the largest class probability."""
    return df.withColumns({"class_id": vectors.best_class(F.col(probs)), "class_conf": vectors.best_score(F.col(probs))})


def name_classes(df: DataFrame, names: DataFrame, unknown: str | None = "N/A") -> DataFrame:
    """Add `class_name` from a table (class_id, name) of any size; `unknown` for classes it lacks."""
    table = names.select("class_id", F.col("name").alias("class_name"))
    return df.join(table, "class_id", "left").withColumn("class_name", F.coalesce("class_name", F.lit(unknown)))


def detections_long(frames: DataFrame, *keep: str) -> DataFrame:
    """One row per object of a frame, `pos` from 1."""
    return frames.select(*keep, F.posexplode("objs").alias("_p", "o")).select(
        *keep, (F.col("_p") + 1).cast("long").alias("pos"), object_class(F.col("o")).alias("class_id"),
        object_name(F.col("o")).alias("class_name"), F.col("o.probability").alias("score"),
        *[F.get("o.box", F.lit(i)).alias(c) for i, c in enumerate(CORNERS)])


def _corners(b: Column) -> boxes.Box:
    return tuple(b[c] for c in CORNERS)


def _greedy(distinct: DataFrame, group: Sequence[str], threshold: float) -> DataFrame:
    """Kept boxes of each group, gathered and walked through by descending score."""
    entry = F.struct((-F.col("_b._score")).alias("o1"), F.col("_b._tie").alias("o2"), *CORNERS, F.col("_b").alias("row"))

    def keep(kept: Column, b: Column) -> Column:
        hit = F.exists(kept, lambda k: boxes.iou(_corners(k), _corners(b), "pixel") >= threshold)
        return F.when(hit, kept).otherwise(F.concat(kept, F.array(b)))

    gathered = distinct.groupBy(*group).agg(F.collect_list(entry).alias("_l"))
    # The rows stay outside the sorted entries: they may hold columns that have no order.
    order = F.array_sort(F.transform("_l", lambda b, i: F.struct(b["o1"].alias("o1"), b["o2"].alias("o2"), *[b[c].alias(c) for c in CORNERS], i.alias("at"))))
    walked = F.transform(F.array(order), lambda l: F.aggregate(l, F.slice(l, 1, 0), keep))[0]
    rows = F.transform(walked, lambda k: F.struct(*[k[c].alias(c) for c in CORNERS], F.get("_l", k["at"])["row"].alias("_b")))
    return gathered.select(*group, F.explode(rows).alias("k")).select(*group, "k.*")


def _kept_in_order(group: Sequence[str], threshold: float):
    """The same walk over rows that come sorted; nothing is held but the kept boxes of the group at hand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, kept = None, 0, np.empty((16, 5))
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in group]))
            whole = np.all([batch.column(c).is_valid().to_numpy(zero_copy_only=False) for c in CORNERS], axis=0)
            corners = np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in CORNERS], axis=1)
            areas = (corners[:, 2] - corners[:, 0] + 1) * (corners[:, 3] - corners[:, 1] + 1)
            out = []
            for i, key in enumerate(keys):
                if key != now:
                    now, n = key, 0
                if whole[i]:  # a box without a corner overlaps nothing
                    box, k = corners[i], kept[:n]
                    w = np.maximum(np.fmin(k[:, 2], box[2]) - np.maximum(k[:, 0], box[0]) + 1, 0)
                    h = np.maximum(np.fmin(k[:, 3], box[3]) - np.maximum(k[:, 1], box[1]) + 1, 0)
                    share = w * h / (k[:, 4] + areas[i] - w * h + 1e-16)
                    if not np.all(share < threshold):  # as in SQL, NaN is above any number
                        continue
                    if n == len(kept):
                        kept = np.concatenate((kept, np.empty_like(kept)))
                    kept[n] = [*box, areas[i]]
                    n += 1
                out.append(i)
            yield batch.take(pa.array(out, pa.int64()))
    return run


def _streamed(distinct: DataFrame, group: Sequence[str], threshold: float) -> DataFrame:
    """Kept boxes of crowded groups: sorted, which may spill, and walked through as they come."""
    columns = [*group, *CORNERS, "_b"]
    rows = distinct.repartition(*group).sortWithinPartitions(*group, -F.col("_b._score"), "_b._tie", *CORNERS).select(*columns)
    return rows.mapInArrow(_kept_in_order(group, threshold), rows.schema)


def _level(reach: Column) -> Column:
    """Power of two of the smallest cell that is no narrower."""
    return F.greatest(F.ceil(F.log2(reach)), F.lit(-30)).cast("int")


def _cells(rows: DataFrame, level: Column, *keep: str) -> DataFrame:
    """Cells (of the level, twice 2**level wide) that a box reaches into, four at most when it is no wider than the level."""
    rows = rows.withColumn("level", level)
    size = F.pow(F.lit(2.0), F.col("level") + 1)

    def span(lo: str, hi: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(lo) / size).cast("long"), F.floor((F.col(hi) + 1) / size).cast("long")))
    return rows.withColumn("cx", span("x1", "x2")).withColumn("cy", span("y1", "y2")).select("level", "cx", "cy", *keep)


def overlapping(rows: DataFrame, group: Sequence[str], threshold: float) -> DataFrame:
    """(a, b): pairs of a group whose pixel IoU reaches the threshold, a before b in `place`. Boxes with no area overlap none.

    IoU bounds the ratio of widths and heights, so a box meets boxes of its own size and of a few larger ones only, in the cells of these.
    A pair is looked at in the one cell that holds the lower corner of its intersection.
    """
    reach = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) + 1
    rows = rows.filter((F.col("x2") + 1 > F.col("x1")) & (F.col("y2") + 1 > F.col("y1"))).withColumn("own", _level(reach))
    keep = [*group, "id", "place", *CORNERS, "own"]
    up = math.ceil(math.log2(1 / threshold))
    large = _cells(rows, F.col("own"), *keep)
    small = _cells(rows.withColumn("up", F.explode(F.array(*[F.lit(i) for i in range(up + 1)]))), F.col("own") + F.col("up"), *keep)
    l, r = ({c: F.col(f"{side}.{c}") for c in keep} for side in ("l", "r"))
    pairs = large.alias("l").join(small.alias("r"), [*group, "level", "cx", "cy"])
    size = F.pow(F.lit(2.0), F.col("level") + 1)
    here = ((F.floor(F.greatest(l["x1"], r["x1"]) / size) == F.col("cx")) & (F.floor(F.greatest(l["y1"], r["y1"]) / size) == F.col("cy")))
    once = (l["own"] > r["own"]) | (l["place"] < r["place"])
    near = boxes.iou(tuple(l[c] for c in CORNERS), tuple(r[c] for c in CORNERS), "pixel") >= threshold
    first = l["place"] < r["place"]
    return pairs.filter(here & once & near).select(F.when(first, l["id"]).otherwise(r["id"]).alias("a"), F.when(first, r["id"]).otherwise(l["id"]).alias("b"))


def _suppressed(edges: DataFrame) -> tuple[DataFrame, int]:
    """Ids that greedy suppression drops, and the rounds it took. edges: (a, b), a is the better one of an overlapping pair.

    A box that no undecided better one overlaps is kept, in all places at once, and drops what it overlaps; each round settles the best of
    every neighbourhood, so their number follows the longest falling chain of overlaps, not the number of boxes.
    """
    out, rounds = None, 0
    edges = stored(edges, "overlaps")
    while not edges.isEmpty():
        kept = edges.select(F.col("a").alias("id")).distinct().join(edges.select(F.col("b").alias("id")).distinct(), "id", "left_anti")
        lost = stored(edges.join(kept.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct(), "lost")
        out = lost if out is None else out.unionByName(lost)
        for end in "ab":
            edges = edges.join(lost.withColumnRenamed("id", end), end, "left_anti")
        edges = stored(edges, "overlaps")
        rounds += 1
    return (edges.select(F.col("a").alias("id")) if out is None else out), rounds


def _settled(distinct: DataFrame, group: Sequence[str], threshold: float) -> DataFrame:
    """Kept boxes of crowded groups: all groups at once, in rounds over pairs of overlapping boxes."""
    place = F.struct((-F.col("_b._score")).alias("o1"), F.col("_b._tie").alias("o2"), *CORNERS)
    rows = stored(distinct.withColumns({"id": F.monotonically_increasing_id(), "place": place}), "crowded")
    lost, _ = _suppressed(overlapping(rows.select("id", "place", *group, *[F.col(c).cast("double").alias(c) for c in CORNERS]), group, threshold))
    return rows.join(lost, "id", "left_anti").select(*group, *CORNERS, "_b")


def nms(df: DataFrame, conf: float = 0.5, iou_threshold: float = 0.4, image: Sequence[str] = ("image_id",),
        score: str = "score", tie: str = "box_id", crowd: int | None = 1000) -> DataFrame:
    """Greedy suppression per image and class of corner boxes, highest score first, ties to the lower `tie`.

    A box is dropped when it overlaps a kept box by at least the threshold (pixel IoU, above 0); a box without a corner
    overlaps none. Copies of one box always lose to the best of them, so they shrink to one row before the
    shuffle. Groups of at most `crowd` boxes, copies counted, are gathered, larger ones are settled in rounds over their overlapping pairs, by many tasks; the
    rows are the same (but boxes with a corner that is no finite number go with a walk in one task). None gathers all, where the detector
    bounds the boxes of an image.
    """
    group = [*image, "class_id"]
    sure = df.filter(F.col(score) >= conf)
    rest = [c for c in df.columns if c not in (*group, *CORNERS)]
    row = F.struct(F.col(score).alias("_score"), F.col(tie).alias("_tie"), *rest)
    distinct = sure.groupBy(*group, *CORNERS).agg(F.min_by(row, F.struct(-F.col(score), F.col(tie))).alias("_b"))
    if crowd is None:
        kept = _greedy(distinct, group, iou_threshold)
    else:
        odd = reduce(lambda a, b: a | b, [F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf")) for c in CORNERS])
        sizes = sure.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.coalesce(F.bool_or(odd), F.lit(False)).alias("_odd"))
        many = stored(sizes.filter(F.col("_n") > crowd).drop("_n"), "crowds")
        kinds = {r._odd for r in many.select("_odd").distinct().collect()}
        few = distinct.join(many, group, "left_anti") if kinds else distinct
        kept = _greedy(few, group, iou_threshold)
        for is_odd, walk in ((True, _streamed), (False, _settled)):
            if is_odd in kinds:
                kept = kept.unionByName(walk(distinct.join(many.filter(F.col("_odd") == is_odd).drop("_odd"), group), group, iou_threshold))
    return kept.select(*group, *CORNERS, *[F.col("_b")[c].alias(c) for c in rest])


def decode_grid(df: DataFrame, anchors: Sequence[tuple[float, float]], grid: int, stride: float) -> DataFrame:
    """Head outputs `(anchor, row, col, raw)` as centre boxes in pixels with confidences.

    `raw` is tx, ty, tw, th, objectness and class logits of one cell and anchor.
    """
    raw = F.col("raw")
    at = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("anchor"))
    sig = vectors.sigmoid
    scaled = [(w / stride, h / stride) for w, h in anchors]
    return df.withColumns({
        "cx": (sig(F.get(raw, F.lit(0))) + F.col("col")) * stride,
        "cy": (sig(F.get(raw, F.lit(1))) + F.col("row")) * stride,
        "w": F.exp(F.get(raw, F.lit(2)).cast("double")) * at(w for w, _ in scaled) * stride,
        "h": F.exp(F.get(raw, F.lit(3)).cast("double")) * at(h for _, h in scaled) * stride,
        "obj_conf": sig(F.get(raw, F.lit(4))),
        "class_probs": F.transform(F.slice(raw, F.lit(6), F.greatest(F.size(raw) - 5, F.lit(0))), sig),
    }).withColumn("box_id", (F.col("anchor") * grid + F.col("row")) * grid + F.col("col"))


def merge_obj_tags(existing: DataFrame, added: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add tags by number to each frame's tag map; an added tag replaces one of the same number."""
    key = list(key)
    old, new = existing.select(*key, F.col("obj_tags").alias("_old")), added.select(*key, F.col("obj_tags").alias("_new"))
    kind = "map<int,struct<class_name:string,x1:float,y1:float,x2:float,y2:float>>"
    empty = F.create_map().cast(kind)
    merged = F.map_zip_with(F.coalesce("_old", empty), F.coalesce("_new", empty), lambda _, o, n: F.coalesce(n, o))
    return old.join(new, key, "full").select(*key, F.when(F.size(merged) > 0, merged).alias("obj_tags"))


def mark_checked(frames: DataFrame, reviewed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Set `checked` of reviewed frames, one review row per frame."""
    flags = reviewed.select(*key, F.col("checked").alias("_checked"))
    return (frames.join(flags, list(key), "left")
            .withColumn("checked", F.coalesce("_checked", "checked")).drop("_checked"))


def annotation_labels(df: DataFrame, frame: Sequence[str] = ("camera", "frame_num"), max_boxes: int = 20,
                      min_score: float = 0.5, line: int = 4, skip_scores: bool = False) -> DataFrame:
    """What to draw on a frame for a reviewer: each box once, with its labels, colour and line width.

    Of the first `max_boxes` boxes of a frame those above `min_score` are shown; boxes at the same place
    share their labels and take the last one's colour.
    """
    first = Window.partitionBy(*frame).orderBy("pos")
    shown = (df.withColumn("_rank", F.row_number().over(first))
             .filter(F.col("_rank") <= max_boxes).filter(F.col("score") > min_score))
    label = text.box_label(F.col("class_name"), F.col("score"), skip_scores=skip_scores)
    labelled = shown.withColumns({"_label": label, "_colour": text.box_colour(F.col("class_id"), F.col("is_keyframe"))})
    width = F.when(F.col("is_keyframe"), line + 2).otherwise(line)
    return (labelled.groupBy(*frame, *CORNERS, "is_keyframe")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "_label"))), lambda s: s["_label"]).alias("labels"),
                 F.max_by("_colour", "pos").alias("colour"))
            .withColumn("line_width", width))


def enrich(df: DataFrame, detect_fn: Callable[[list[str]], list[object]], result: T.DataType, out: str = "objs",
           link: str = "url", batch: int = 8, tries: int = 5, backoff: float = 0.1) -> DataFrame:
    """Ask an outside detector about each image link, `batch` links per call.

    `detect_fn` answers a list of links with a list of results, None where it has none yet; those links are
    asked again up to `tries` times with a linearly growing pause and are null after that.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, result)])

    def ask(links: list[str]) -> list[object]:
        answers: list[object] = [None] * len(links)
        open_ = list(range(len(links)))
        for turn in range(1, tries + 1):
            for i, answer in zip(open_, detect_fn([links[i] for i in open_])):
                answers[i] = answer
            open_ = [i for i in open_ if answers[i] is None]
            if not open_:
                break
            if turn < tries:
                time.sleep(turn * backoff)
        return answers

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            links = part[link].tolist()
            answers = [a for i in range(0, len(links), batch) for a in ask(links[i:i + batch])]
            yield part.assign(**{out: pd.Series(answers, index=part.index, dtype=object)})

    return df.mapInPandas(run, schema)
