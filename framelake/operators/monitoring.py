"""Counter rates, lags, gauges and latencies."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.operators import ordered


def counter_increase(samples: DataFrame, series: Sequence[str], time: str = "ts_ms", tie: str = "event_id",
                     value: str = "value", limit: int = ordered.LIMIT) -> DataFrame:
    """Add `increase` since the sample before: the value itself after a reset, 0 for the first sample."""
    before = ordered.previous(samples, series, [time, tie], F.col(value), "_prev", limit)
    grown = F.col(value) - F.col("_prev.v")
    return before.withColumn("increase", F.when(F.col("_prev").isNull(), F.lit(0.0))
                             .when(grown < 0, F.col(value)).otherwise(grown)).drop("_prev")


def counter_rate(samples: DataFrame, series: Sequence[str], by: Sequence[str], window: str = "5 minutes",
                 slide: str | None = None, time: str = "ts_ms", tie: str = "event_id", value: str = "value",
                 limit: int = ordered.LIMIT) -> DataFrame:
    """Increase per second in time windows, summed over the series that share `by`.

    Windows tumble, or slide by `slide`. A sample counts once, in its pane (the common divisor of window and slide); what slides is
    the sums of panes, of which there are no more than time gives. `sum without(instance)` is `by` without that label.
    """
    grown = counter_increase(samples, series, time, tie, value, limit)
    length, step = _milliseconds(window), _milliseconds(slide or window)
    pane = math.gcd(length, step)
    panes = grown.groupBy(*by, F.floor(F.col(time) / pane).cast("long").alias("_pane")).agg(F.sum("increase").alias("_sum"))
    if step == length:
        total = panes.select(*by, ((F.col("_pane") + 1) * pane).alias("_end"), F.col("_sum").alias("_total"))
    else:
        # The windows' ends that a pane lies before, up to a window's length on; its own sum stands at its own end.
        first = (F.floor((F.col("_pane") * pane - length) / step) + 1) * step + length
        ends = F.transform(F.sequence(first, F.col("_pane") * pane + length, F.lit(step)),
                           lambda e: F.struct(e.alias("_end"), F.lit(0.0).alias("_sum"), F.lit(True).alias("_wanted")))
        own = F.struct(((F.col("_pane") + 1) * pane).alias("_end"), F.col("_sum").alias("_sum"), F.lit(False).alias("_wanted"))
        places = panes.select(*by, F.inline(F.concat(F.array(own), ends))).groupBy(*by, "_end").agg(
            F.sum("_sum").alias("_sum"), F.bool_or("_wanted").alias("_wanted"))
        past = Window.partitionBy(*by).orderBy("_end").rangeBetween(pane - length, 0)
        total = places.withColumn("_total", F.sum("_sum").over(past)).filter("_wanted")
    return total.select(*by, F.timestamp_millis("_end").alias("window_end"), (F.col("_total") / (length / 1000)).alias("rate"))


def _milliseconds(duration: str) -> int:
    """A duration such as `5 minutes`."""
    units = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    number, unit = duration.split()
    return int(number) * units[unit.lower().removesuffix("s")]


def last_per_bucket(samples: DataFrame, series: Sequence[str], bucket_seconds: int, time: str = "ts_ms",
                    tie: str = "event_id", value: str = "value") -> DataFrame:
    """Last value of each series in each time bucket."""
    bucket = F.floor(F.col(time) / (bucket_seconds * 1000)).cast("long")
    return samples.groupBy(*series, bucket.alias("bucket")).agg(F.max_by(value, F.struct(time, tie)).alias("last"))


def consumer_lag(produced: DataFrame, consumed: DataFrame, series: Sequence[str], by: Sequence[str],
                 bucket_seconds: int = 60, **columns: str) -> DataFrame:
    """Sum of topic offsets, of consumer-group offsets and their difference, per bucket.

    A series that is silent in a bucket keeps its last value, so the lag of a stalled group goes on growing; before
    its first one it counts 0. Buckets in which nobody reported are left out.
    """
    def total(df: DataFrame, name: str) -> DataFrame:
        last = last_per_bucket(df, series, bucket_seconds, **columns)
        # What a series adds to its total from a bucket on; the running sum of that is the sum of last values.
        since = F.lag("last", 1, 0.0).over(Window.partitionBy(*series).orderBy("bucket"))
        return last.withColumn("_more", F.col("last") - since).groupBy(*by, "bucket").agg(F.sum("_more").alias(name))

    both = total(produced, "topic_offset").join(total(consumed, "group_offset"), [*by, "bucket"], "full")
    so_far = Window.partitionBy(*by).orderBy("bucket")
    both = both.select(*by, "bucket", *[F.sum(F.coalesce(c, F.lit(0.0))).over(so_far).alias(c) for c in ("topic_offset", "group_offset")])
    return both.withColumn("lag", F.col("topic_offset") - F.col("group_offset"))


def gauge_sum(samples: DataFrame, series: Sequence[str], by: Sequence[str], bucket_seconds: int = 60,
              **columns: str) -> DataFrame:
    """Sum over series of their last value per bucket, by the labels `by`."""
    return (last_per_bucket(samples, series, bucket_seconds, **columns)
            .groupBy(*by, "bucket").agg(F.sum("last").alias("total"), F.count(F.lit(1)).alias("n_series")))


def label_values(samples: DataFrame, label: str, **where: str) -> DataFrame:
    """Distinct values of a label among the series with the given labels."""
    for name, wanted in where.items():
        samples = samples.filter(F.col(name) == wanted)
    return samples.select(label).distinct()


def count_window_latency(arrivals: DataFrame, keys: Sequence[str], n: int = 10, time: str = "ts_ms",
                         tie: str = "event_id", limit: int = ordered.LIMIT) -> DataFrame:
    """Mean time per message of every full group of n messages of a consumer, in seconds.

    A group lasts from the end of the one before; the first one from the first arrival.
    """
    placed = ordered.number_rows(arrivals, keys, [time, tie], "_pos", limit)
    groups = (placed.groupBy(*keys, F.floor(F.col("_pos") / n).cast("long").alias("group_no"))
              .agg(F.min(time).alias("_first"), F.max(time).alias("_end"), F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") == n))
    timed = ordered.previous(groups, keys, ["group_no"], F.col("_end"), "_prev", limit)
    began = F.coalesce(F.col("_prev.v"), F.col("_first"))
    return timed.select(*keys, "group_no", ((F.col("_end") - began) / (1000.0 * n)).alias("latency"))


def latency_summary(samples: DataFrame, size: str = "size", seconds: str = "seconds") -> DataFrame:
    """Mean latency per call and per image by batch size; null when any call failed (0 seconds)."""
    valid = F.every(F.col(seconds) > 0)
    return samples.groupBy(size).agg(
        F.when(valid, F.avg(seconds)).alias("mean_latency"),
        F.when(valid, F.avg(F.col(seconds) / F.col(size))).alias("latency_per_image"), valid.alias("valid"))


def throughput(frames: DataFrame, seconds: int = 60) -> DataFrame:
    """Frames sent per camera and interval, numbered from the camera's first one."""
    slot = F.floor(F.col("timestamp") / (seconds * 1000)).cast("long")
    sent = frames.groupBy("camera", slot.alias("slot")).agg(F.count(F.lit(1)).alias("size"))
    first = F.min("slot").over(Window.partitionBy("camera"))
    return sent.select(F.concat(F.lit("dashcam_"), F.col("camera").cast("string")).alias("dashcam_id"),
                       F.timestamp_millis(F.col("slot") * (seconds * 1000)).alias("record_time"),
                       (F.col("slot") - first).alias("minute"), F.col("size").cast("float").alias("size"))
