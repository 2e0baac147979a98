"""Frame, box, counter and listing tables derived from the given tables.

Every derivation is a narrow projection of one table, so it adds no shuffle to the operator under test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions import keys

URL_PREFIX = "http://store.example.com/bucket/"
STORE_PREFIX, TMP_PREFIX = "store/", "tmp/"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _number(props: Column) -> Column:
    return F.regexp_extract(props, "([0-9]+)", 1).try_cast("long")


def frame_columns(events: DataFrame) -> DataFrame:
    """Events as frames: the user is the camera, the event id its running frame number."""
    e, k = F.col("event_id"), F.col("k")
    place = F.get(F.array(*[F.lit(p) for p in ("CA", "NY", "TX", "Oversea", "Unknown")]),
                  F.pmod("camera", F.lit(5)).cast("int"))
    base = events.select(
        "event_id", F.col("event_id").alias("frame_num"), F.col("user_id").alias("camera"),
        keys.millis(F.col("ts")).alias("timestamp"), _number(F.col("props")).alias("k"))

    def obj(pos: int) -> Column:
        bicycle = F.pmod(F.floor(k / 3) + pos, F.lit(2)) == 1
        x, y = F.pmod(e * 7 + pos * 13, F.lit(50)), F.pmod(e * 11 + pos * 5, F.lit(50))
        return F.struct(
            F.when(bicycle, 2).otherwise(1).alias("class"),
            F.when(bicycle, "2: bicycle").otherwise("1: person").alias("name"),
            (F.pmod(e * 31 + pos * 17, F.lit(100)) / 100).alias("probability"),
            F.array(x / 100, y / 100, (x + 10 + F.pmod(e, F.lit(10))) / 100, (y + 20) / 100).alias("box"))

    names = F.array(*[F.lit(s) for s in ("crosswalk", "downtown", "street", "plaza", "highway", "gas_station",
                                         "forest_road", "office", "residential_neighborhood", "parking_lot")])

    def scene(pos: int) -> Column:
        return F.struct(F.get(names, F.pmod(e * 3 + pos * 7, F.lit(10)).cast("int")).alias("class"),
                        F.lit(0.5 / pos).alias("prob"))

    return base.select(
        "*", place.alias("location"),
        F.slice(F.array(obj(1), obj(2)), F.lit(1), F.pmod(k, F.lit(3)).cast("int")).alias("objs"),
        F.slice(F.array(scene(1), scene(2), scene(3)), F.lit(1), F.pmod(e, F.lit(4)).cast("int")).alias("scenes"))


def frames(spark: SparkSession, sf: str) -> DataFrame:
    return frame_columns(table(spark, sf, "events"))


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as predicted boxes of one image per order, corners in pixels."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    top = F.pmod(supp, F.lit(20)).cast("double")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("image_id"),
        (((F.pmod(supp, F.lit(10007)) * 100003 + F.pmod(part, F.lit(100003))) * 8 + F.col("l_linenumber")) * 64
         + F.col("l_quantity").cast("long")).alias("box_id"),
        F.pmod(part, F.lit(3)).cast("int").alias("class_id"),
        (F.pmod(F.floor("l_extendedprice"), F.lit(1000)) / 1000).alias("score"),
        F.col("l_quantity").alias("x1"), top.alias("y1"),
        (F.col("l_quantity") + 20 + F.pmod(part, F.lit(10))).alias("x2"), (top + 25).alias("y2"))


def truths(spark: SparkSession, sf: str) -> DataFrame:
    """About every second box, moved by one or two pixels, as ground truth."""
    moved = boxes(spark, sf).filter(F.pmod("box_id", F.lit(2)) == 1)
    return moved.select("image_id", F.col("box_id").alias("gt_id"), "class_id", (F.col("x1") + 1).alias("x1"),
                        (F.col("y1") + 2).alias("y1"), (F.col("x2") + 1).alias("x2"), (F.col("y2") + 2).alias("y2"))


def counters(spark: SparkSession, sf: str) -> DataFrame:
    """Events as samples of counters that grow with the event id and reset every 4000 events."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("topic"), F.pmod("user_id", F.lit(4)).alias("part"), "event_id",
        keys.millis(F.col("ts")).alias("ts_ms"), F.pmod("event_id", F.lit(4000)).cast("double").alias("value"))


def listing(spark: SparkSession, sf: str) -> DataFrame:
    tail = F.when(F.pmod("page_id", F.lit(7)) == 0, ".txt").otherwise(".mov")
    return table(spark, sf, "pages").select("page_id", F.concat("url", tail).alias("url"))


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    return listing(spark, sf).filter(F.pmod("page_id", F.lit(3)) == 0).select("url")


def points(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    known = F.pmod(e, F.lit(10)) != 0
    return table(spark, sf, "events").select(
        "event_id", F.when(known, 25 + F.pmod(e * 37, F.lit(2500)) / 100).alias("lat"),
        F.when(known, -125 + F.pmod(e * 53, F.lit(6000)) / 100).alias("lon"))


def regions(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_nationkey")
    lat, lon = 25.0 + 5 * F.floor(n / 5), -125.0 + 10 * F.pmod(n, F.lit(5))
    return table(spark, sf, "nation").select(
        F.col("n_name").alias("region"), lat.alias("lat_lo"), (lat + 5).alias("lat_hi"),
        lon.alias("lon_lo"), (lon + 10).alias("lon_hi"))
