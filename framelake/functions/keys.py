"""Times, storage keys and link parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


DAY_MS = 86_400_000


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a wall-clock time in UTC (TIMESTAMP_NTZ), whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def millis(ts: Column) -> Column:
    """Milliseconds since the epoch of a UTC wall-clock time, truncated."""
    return F.floor(micros(ts) / 1000).cast("long")


def seconds(ts: Column) -> Column:
    """Seconds since the epoch of a UTC wall-clock time, fraction kept."""
    return micros(ts) / F.lit(1e6)


def store_date(ms: Column) -> Column:
    """UTC day of a millisecond time as yyyyMMdd."""
    return F.date_format(F.date_from_unix_date(F.floor(ms / DAY_MS).cast("int")), "yyyyMMdd")


def dashcam_id(camera: Column) -> Column:
    return F.concat(F.lit("dashcam_"), camera.cast("string"))


def message_key(camera: Column, frame_num: Column) -> Column:
    return F.concat_ws("_", camera.cast("string"), frame_num.cast("string"))


def store_key(prefix: str, ms: Column, camera: Column) -> Column:
    """Where a frame that is kept lives: prefix, day, camera, time."""
    return F.concat(F.lit(prefix), store_date(ms), F.lit("/"), camera.cast("string"), F.lit("/"),
                    ms.cast("string"), F.lit(".jpg"))


def tmp_key(prefix: str, ms: Column, camera: Column) -> Column:
    """Where a frame waits until it is judged: prefix, camera, time."""
    return F.concat(F.lit(prefix), camera.cast("string"), F.lit("/"), ms.cast("string"), F.lit(".jpg"))


def storage_link(url_prefix: str, key: Column) -> Column:
    return F.concat(F.lit(url_prefix), key)


def file_name(url: Column) -> Column:
    """Last path segment."""
    return F.element_at(F.split(url, "/"), -1)


def file_stem(url: Column) -> Column:
    """File name up to its first dot."""
    return F.split(file_name(url), r"\.")[0]


def object_key(url: Column) -> Column:
    """Object key of a path-style link: everything after scheme, host and bucket."""
    parts = F.split(url, "/")
    return F.array_join(F.slice(parts, 5, F.greatest(F.size(parts), F.lit(1))), "/")
