"""Figures of the statistics dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake import fixed
from framelake.operators.selection import day_filter


def coverage(statistic: DataFrame) -> DataFrame:
    """Distinct places, cameras and days; a null counts as one value."""
    def distinct(name: str) -> Column:
        return F.count_distinct(F.col(name)) + F.max(F.col(name).isNull().cast("int"))
    return statistic.agg(distinct("location").cast("long").alias("locations"),
                         distinct("dashcam_id").cast("long").alias("cameras"),
                         distinct("store_date").cast("long").alias("dates"))


def daily_sketches(frames: DataFrame, *columns: str, day: str = "store_date", lg_k: int = 14) -> DataFrame:
    """A sketch of the distinct values of each column, for every day. A null counts as one value."""
    def sketch(c: str) -> Column:
        return F.hll_sketch_agg(F.coalesce(F.col(c).cast("string"), F.lit("\0")), lg_k).alias(c)
    return frames.groupBy(day).agg(*[sketch(c) for c in columns])


def merged_coverage(sketches: DataFrame, *columns: str, by: str | None = None) -> DataFrame:
    """About how many distinct values the days have together, from their sketches alone; with `by`, for each of its values."""
    grouped = sketches.groupBy(by) if by else sketches
    return grouped.agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def cameras_by_location(statistic: DataFrame) -> DataFrame:
    """Statistic rows with a camera per known place."""
    return (statistic.filter(F.col("location").isNotNull()).groupBy("location")
            .agg(F.count("dashcam_id").alias("cameras")))


def scene_share(statistic: DataFrame) -> DataFrame:
    """Percentage of each scene type in all scene tags, one row per type."""
    sums = statistic.agg(*[F.sum(c).alias(c) for c in [*fixed.SCENE_TYPES, "total"]])
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("scene_type"),
                                        (F.try_divide(F.col(t), F.col("total")) * 100).alias("percent"))
                               for t in fixed.SCENE_TYPES]))
    return sums.select(rows.alias("r")).select("r.*")


def keyframe_ratio(statistic: DataFrame, as_of: str | None = None, days_back: int = 0) -> DataFrame:
    """Frames, key frames and their percentage per camera and place, of one day when `as_of` is given."""
    rows = statistic if as_of is None else day_filter(statistic, as_of, days_back)
    return rows.select("dashcam_id", "store_date", "location", "frames", "keyframes",
                       (F.try_divide(F.col("keyframes"), F.col("frames")) * 100).alias("keyframe_percent"))


def bucket_label(date: Column, freq: str) -> Column:
    """Label of a day's bucket: the day (D), the Monday that ends its week (W-MON), its month's last day (M)."""
    date = date.cast("date")
    if freq == "D":
        return date
    if freq == "W-MON":
        return F.next_day(F.date_sub(date, 1), "MON")
    if freq == "M":
        return F.last_day(date)
    raise ValueError(f"unknown frequency {freq}")


def bucketed_count(df: DataFrame, date: str, freq: str, predicate: Column | None = None) -> DataFrame:
    """Rows per bucket between the first and the last one, empty buckets with 0."""
    kept = df if predicate is None else df.filter(predicate)
    counts = kept.groupBy(bucket_label(F.col(date), freq).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    step = {"D": "interval 1 day", "W-MON": "interval 7 days", "M": "interval 1 month"}[freq]
    span = counts.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    first = F.trunc("lo", "month") if freq == "M" else F.col("lo")
    spine = (span.select(F.explode(F.sequence(first, F.col("hi"), F.expr(step))).alias("day"))
             .select(bucket_label(F.col("day"), freq).alias("bucket") if freq == "M" else F.col("day").alias("bucket")))
    return (spine.join(counts, "bucket", "left")
            .select("bucket", F.coalesce("n", F.lit(0).cast("long")).alias("n")).orderBy("bucket"))


def object_counts_long(frames: DataFrame, *keep: str) -> DataFrame:
    """One row per frame and class from the class counts of value rows."""
    return (frames.select(*keep, F.explode("counts").alias("_c", "n"))
            .select(*keep, F.col("_c").cast("int").alias("class_id"), F.col("n").cast("long").alias("n")))


def object_histogram(frames: DataFrame) -> DataFrame:
    """Objects and frames per class of value rows; only one row per class and map task is shuffled."""
    return object_counts_long(frames).groupBy("class_id").agg(F.sum("n").alias("objects"), F.count(F.lit(1)).alias("frames"))


def date_spine(spark: SparkSession, as_of: str, days: int = 8) -> DataFrame:
    """The last `days` days as yyyyMMdd, oldest first."""
    last = F.lit(as_of).cast("date")
    return (spark.range(1).select(F.explode(F.sequence(F.date_sub(last, days - 1), last)).alias("day"))
            .select(F.date_format("day", "yyyyMMdd").alias("store_date")))
