"""Frame and row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake import fixed
from framelake.operators import ordered

# Spark limits groups before the shuffle up to this many rows (spark.sql.optimizer.windowGroupLimitThreshold)
TOP_K = 1000


def valuable_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("valuable"))


def mark_valuable(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Set `valuable` by a Boolean column; null counts as false, no predicate as true."""
    return df.withColumn("valuable", F.lit(True) if predicate is None else F.coalesce(predicate, F.lit(False)))


def diversity_select(df: DataFrame, cap: int, frame: Sequence[str] = ("camera", "frame_num"),
                     pick: Sequence[Column] | None = None, by_location: bool = False,
                     limit: int = ordered.LIMIT) -> DataFrame:
    """Mark frames `valuable` so that no scene type fills the store.

    Each scene type (in each place) nominates its first `cap` frames in the order `pick` (its first column an
    integer), by default a hash of the frame key; a frame is valuable when any of its types nominates it. A small
    cap is a top-k per group, which Spark also applies before the shuffle, so a frequent type ships `cap` rows per
    map task; a larger one numbers the frames of a type in pieces. How the nominated frames are joined is left to the
    adaptive planner, as places and types may be of any number.
    """
    frame, bucket = list(frame), ["scene_type"] + (["location"] if by_location else [])
    pick = list(pick) if pick else [F.xxhash64(*frame), *[F.col(c) for c in frame]]
    order = [f"_o{i}" for i in range(len(pick))]
    tags = df.select(*frame, *(["location"] if by_location else []), *[p.alias(o) for p, o in zip(pick, order)],
                     F.explode("scenes").alias("scene_type"))
    if cap <= TOP_K:
        ranked = tags.withColumn("_rank", F.row_number().over(Window.partitionBy(*bucket).orderBy(*order)))
        first = ranked.filter(F.col("_rank") <= cap)
    else:
        first = ordered.number_rows(tags, bucket, order, "_rank", limit).filter(F.col("_rank") < cap)
    nominated = first.select(*frame).distinct().withColumn("_nominated", F.lit(True))
    return (df.join(nominated, frame, "left")
            .withColumn("valuable", F.coalesce("_nominated", F.lit(False))).drop("_nominated"))


def lead_status_filter(df: DataFrame, status: str,
                       columns: Sequence[str] = ("CreatedDate", "Status", "Company", "State", "LeadSource"),
                       ) -> DataFrame:
    """Rows of one status choice (`open`, `converted`, `lost`, anything else for all), projected."""
    wanted = fixed.LEAD_STATUSES.get(status)
    return (df if wanted is None else df.filter(F.col("Status").isin(wanted))).select(*columns)


def day_filter(df: DataFrame, as_of: str, days_back: int) -> DataFrame:
    """Rows stored `days_back` days before `as_of` (yyyy-mm-dd)."""
    day = F.date_format(F.date_sub(F.lit(as_of).cast("date"), days_back), "yyyyMMdd")
    return df.filter(F.col("store_date") == day)


def confidence_filter(df: DataFrame, threshold: float, column: str = "obj_conf") -> DataFrame:
    return df.filter(F.col(column) >= threshold)
