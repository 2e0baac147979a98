"""Columns over detected objects and scenes of one frame message."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelake import fixed, schemas
from framelake.functions.vectors import bind

OBJECT_TAGS = "map<int,struct<class_name:string,x1:float,y1:float,x2:float,y2:float>>"


def object_class(obj: Column) -> Column:
    """Class number: the field itself, else the number before ':' in the name."""
    named = F.when(F.instr(obj["name"], ":") > 0,
                   F.trim(F.split(obj["name"], ":")[0]).try_cast("int"))
    return F.coalesce(obj["class"], named)


def object_name(obj: Column) -> Column:
    """Class name: the text after the first ':', or the whole name."""
    parts = F.split(obj["name"], ":")
    return F.trim(F.when(F.size(parts) > 1, parts[1]).otherwise(obj["name"]))


def parse_objects(objs: Column, box_order: str = "xyxy") -> Column:
    """Objects as a map 1..n to tags; null when there is none."""
    positions = {"xyxy": (0, 1, 2, 3), "yxyx": (1, 0, 3, 2)}[box_order]

    def tag(obj: Column, i: Column) -> Column:
        box = [F.get(obj["box"], F.lit(p)).cast("float") for p in positions]
        return F.struct(
            (i + 1).cast("int").alias("key"),
            F.struct(object_name(obj).alias("class_name"), box[0].alias("x1"), box[1].alias("y1"),
                     box[2].alias("x2"), box[3].alias("y2")).alias("value"))

    return F.when(F.size(objs) > 0, F.map_from_entries(F.transform(objs, tag)))


def class_list(objs: Column) -> Column:
    """Sorted classes of a frame: equal lists mean equal class counts."""
    return F.coalesce(F.array_sort(F.transform(objs, object_class)),
                      F.array().cast("array<int>"))


def _class_counts(objs: Column, entry: Callable[[Column, Column], Column]) -> Column:
    return bind(F.array_compact(class_list(objs)), lambda classes: F.transform(
        F.array_distinct(classes), lambda c: entry(c.cast("string"), F.size(F.filter(classes, lambda x: x == c)))))


def object_counts(objs: Column) -> Column:
    """Class to number of objects; empty map when there is none."""
    return F.map_from_entries(_class_counts(objs, lambda c, n: F.struct(c.alias("key"), n.alias("value"))))


def object_signature(objs: Column) -> Column:
    """Class counts as text, `class:n` ordered by class."""
    return F.array_join(_class_counts(objs, lambda c, n: F.concat(c, F.lit(":"), n.cast("string"))), ",")


def top_scenes(scenes: Column, n: int = 5) -> Column:
    """First n scene names in the order given; null when there is none."""
    return F.when(F.size(scenes) > 0, F.slice(F.transform(scenes, lambda s: s["class"]), 1, n))


def taxonomy_map(taxonomy: dict[str, str]) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(k) for k in taxonomy]), F.array(*[F.lit(v) for v in taxonomy.values()]))


def coarse_scenes(raw: Column, taxonomy: dict[str, str] | None = None) -> Column:
    """Scene types of raw scene names, sorted and distinct; the fallback type when none is known."""
    lookup = taxonomy_map(taxonomy or fixed.scene_type_of())
    known = F.array_compact(F.array_distinct(F.transform(raw, lambda s: F.try_element_at(lookup, s))))
    return bind(known, lambda types: F.when(F.size(types) > 0, F.array_sort(types))
                .otherwise(F.array(F.lit(fixed.FALLBACK_SCENE))))


def object_response(payload: Column, url: Column) -> Column:
    """Objects a detector answered for one image link; null when it is absent."""
    return F.try_element_at(F.from_json(payload, schemas.OBJECT_RESPONSE)["entries"], url)


def scene_response(payload: Column) -> Column:
    """Scenes a classifier answered; null when there is no prediction."""
    return F.from_json(payload, schemas.SCENE_RESPONSE)["predictions"]
