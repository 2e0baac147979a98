"""File listings, sidecars, label files and other small text formats."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake import schemas
from framelake.session import stored


def list_objects(spark: SparkSession, prefix: str, url_prefix: str = "") -> DataFrame:
    """Objects under a prefix: key below it, size, time and public link. Their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)
    root = F.lit(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", prefix).rstrip("/") + "/")
    key = F.substring("path", F.instr("path", root) + F.length(root), F.length("path"))
    return (files.select(key.alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
            .filter(F.length("key") > 0).withColumn("url", F.concat(F.lit(url_prefix), "key")))


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies directly in each folder."""
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            scheme = m[0] if (m := re.match("[A-Za-z][A-Za-z0-9+.-]*://", folder)) and m[0] != "file://" else ""
            store, place = fs.FileSystem.from_uri(folder) if scheme else (fs.LocalFileSystem(), re.sub("^file:(//)?", "", folder))
            found = [f for f in store.get_file_info(fs.FileSelector(place, allow_not_found=True)) if not f.base_name.startswith(("_", "."))]
            yield pa.RecordBatch.from_arrays([
                pa.array([scheme + f.path for f in found], pa.string()), pa.array([f.type == fs.FileType.Directory for f in found], pa.bool_()),
                pa.array([f.size or 0 for f in found], pa.int64()), pa.array([f.mtime for f in found], pa.timestamp("us", "UTC"))],
                ["path", "is_folder", "size", "modified"])


def list_tree(spark: SparkSession, prefix: str, url_prefix: str = "", partitions: int | None = None) -> DataFrame:
    """`list_objects` for large trees: folders are dealt to tasks level by level, so the driver lists nothing.

    For stores that Arrow's file systems reach from the executors. Names that begin with `_` or `.` are hidden, as in Spark's readers; a prefix that
    doesn't exist has no objects.
    """
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = re.sub("^file:(//)?", "", prefix).rstrip("/")
    folders, found = spark.createDataFrame([(prefix,)], "path string"), None
    while True:
        level = stored(folders.repartition(partitions).mapInArrow(_children, "path string, is_folder boolean, size long, modified timestamp"), "listing")
        files = level.filter("not is_folder")
        found = files if found is None else found.unionByName(files)
        folders = level.filter("is_folder").select("path")
        if folders.isEmpty():
            break
    key = F.substring("path", len(root) + 2, 1 << 30)
    return found.select(key.alias("key"), "size", "modified").withColumn("url", F.concat(F.lit(url_prefix), "key"))


def taxonomy_lines(lines: DataFrame, line_no: str = "line_no", value: str = "value") -> DataFrame:
    """Lines `type raw raw ...` as (raw_scene, scene_type); a later line wins."""
    words = F.split(F.trim(F.col(value)), " ")
    pairs = lines.select(F.col(line_no), words[0].alias("scene_type"),
                         F.explode(F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))).alias("raw_scene"))
    return pairs.groupBy("raw_scene").agg(F.max_by("scene_type", line_no).alias("scene_type"))


def load_scene_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.posexplode(F.split("value", "\n")).alias("line_no", "value")).filter(F.trim("value") != "")
    return taxonomy_lines(lines)


def class_names(df: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """Text of newline-ended names as (class_id, name), numbered from 0; what follows the last newline is dropped."""
    parts = F.split(F.col(value), "\n")
    return df.select(*keep, F.posexplode(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))).alias("class_id", "name"))


def load_class_names(spark: SparkSession, path: str) -> DataFrame:
    return class_names(spark.read.text(path, wholetext=True))


def sidecar_positions(df: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """Sidecar JSON as the first position of the video."""
    first = F.get(F.from_json(F.col(value), schemas.SIDECAR)["locations"], F.lit(0))
    return df.select(*keep, first["latitude"].alias("lat"), first["longitude"].alias("lon"))


def load_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """Info files of videos as (stem, lat, lon)."""
    files = spark.read.text(path, wholetext=True).select(
        F.regexp_extract("_metadata.file_name", r"^([^.]*)", 1).alias("stem"), "value")
    return sidecar_positions(files, "stem")


def mot_boxes(df: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """Lines `frame,id,x,y,w,h,score` as corner boxes."""
    typed = F.from_csv(F.col(value), schemas.MOT.simpleString()[7:-1].replace(":", " "))
    rows = df.select(*keep, typed.alias("r")).select(*keep, "r.*")
    return rows.select(*keep, "frame", "id", F.col("x").alias("x1"), F.col("y").alias("y1"),
                       (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"), "score")


def read_mot(spark: SparkSession, path: str) -> DataFrame:
    return mot_boxes(spark.read.text(path))


def label_path(image):
    """Path of an image's label file."""
    return F.regexp_replace(F.regexp_replace(F.replace(image, F.lit("images"), F.lit("labels")), r"\.png", ".txt"), r"\.jpg", ".txt")


def label_rows(df: DataFrame, *keep: str, value: str = "value", max_objects: int = 50) -> DataFrame:
    """Label text of an image as its first `max_objects` rows `class cx cy w h`."""
    lines = F.slice(F.filter(F.split(F.col(value), "\n"), lambda s: F.trim(s) != ""), 1, max_objects)
    row = F.split(F.trim(F.col("line")), r"\s+")
    number = lambda i: F.get(row, F.lit(i)).try_cast("double")
    return df.select(*keep, F.posexplode(lines).alias("pos", "line")).select(
        *keep, "pos", number(0).cast("int").alias("class_id"), number(1).alias("cx"), number(2).alias("cy"),
        number(3).alias("w"), number(4).alias("h"))


def read_label_files(spark: SparkSession, path: str, max_objects: int = 50) -> DataFrame:
    """Label files of a folder, one text per image."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("label_path"), "value")
    return label_rows(files, "label_path", max_objects=max_objects)
