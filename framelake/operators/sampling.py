"""Choosing videos and the frames to read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.functions import keys

PIECE = 1024


def pending_videos(listing: DataFrame, ledger: DataFrame, url: str = "url") -> DataFrame:
    """Listed videos that are no text file and not in the ledger."""
    return listing.filter(~F.col(url).endswith("txt")).join(ledger.select(url), url, "left_anti")


def advance_ledger(ledger: DataFrame, done: DataFrame, url: str = "url") -> DataFrame:
    """The ledger with newly finished videos."""
    return ledger.select(url).union(done.select(url)).distinct()


def _next_phase(c: Column, n: Column, step: int) -> Column:
    """Phase after a video of n frames entered at phase c.

    When the sample slot falls on the end of the video, the first frame of the next one is kept. A video without
    frames costs one read.
    """
    return F.when(F.pmod(c + n, F.lit(step + 1)) == step, F.lit(step).cast("long")).otherwise(F.pmod(c + n + 1, F.lit(step + 1)))


def video_phases(videos: DataFrame, step: int, camera: Sequence[str] = ("camera",), video: str = "video_id",
                 frames: str = "n_frames") -> DataFrame:
    """Add `phase` at which each video of a camera is entered; `video` numbers a camera's videos from 0.

    A run of videos maps every entry phase to an exit phase, and such maps compose. So runs of 1024 videos
    are reduced to their maps first, then the few maps of a camera are chained, then each run starts from
    its own entry phase. No more than one run is gathered anywhere.
    """
    camera = list(camera)
    runs = (videos.withColumn(frames, F.coalesce(frames, F.lit(0)))
            .withColumn("_run", F.floor(F.col(video) / PIECE).cast("long"))
            .groupBy(*camera, "_run")
            .agg(F.array_sort(F.collect_list(F.struct(F.col(video).alias("v"), F.col(frames).cast("long").alias("n")))).alias("_videos")))
    start = F.sequence(F.lit(0).cast("long"), F.lit(step).cast("long"))
    through = F.aggregate("_videos", start, lambda m, v: F.transform(m, lambda c: _next_phase(c, v["n"], step)))
    maps = runs.select(*camera, "_run", through.alias("_map"), F.floor(F.col("_run") / PIECE).cast("long").alias("_block"))

    blocks = (maps.groupBy(*camera, "_block").agg(F.array_sort(F.collect_list(F.struct("_run", "_map"))).alias("_runs")))
    chained = F.aggregate("_runs", start, lambda m, r: F.transform(m, lambda c: F.get(r["_map"], c.cast("int"))))
    order = Window.partitionBy(*camera).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    entered = blocks.withColumn("_before", F.collect_list(chained).over(order))
    entry = F.aggregate("_before", F.lit(0).cast("long"), lambda c, m: F.get(m, c.cast("int")))
    steps = F.aggregate(
        "_runs", F.array(F.struct(F.lit(None).cast("long").alias("_run"), entry.alias("phase"), F.lit(0).cast("long").alias("after"))),
        lambda acc, r: F.concat(acc, F.array(F.struct(
            r["_run"].alias("_run"),
            F.when(F.size(acc) == 1, F.element_at(acc, -1)["phase"]).otherwise(F.element_at(acc, -1)["after"]).alias("phase"),
            F.get(r["_map"], F.when(F.size(acc) == 1, F.element_at(acc, -1)["phase"]).otherwise(F.element_at(acc, -1)["after"]).cast("int")).alias("after")))))
    run_entry = (entered.select(*camera, F.explode(F.slice(steps, 2, PIECE + 1)).alias("s"))
                 .select(*camera, "s._run", F.col("s.phase").alias("_entry")))

    walk = F.aggregate(
        "_videos", F.struct(F.col("_entry").alias("c"), F.array().cast("array<struct<v:bigint,phase:bigint>>").alias("out")),
        lambda acc, v: F.struct(_next_phase(acc["c"], v["n"], step).alias("c"),
                                F.concat(acc["out"], F.array(F.struct(v["v"].cast("long").alias("v"), acc["c"].alias("phase")))).alias("out")),
        lambda acc: acc["out"])
    phases = (runs.join(run_entry, [*camera, "_run"]).select(*camera, F.explode(walk).alias("p"))
              .select(*camera, F.col("p.v").alias(video), "p.phase"))
    return videos.join(phases, [*camera, video])


def sample_frames(frames: DataFrame, step: int, videos: DataFrame | None = None, camera: Sequence[str] = ("camera",),
                  video: str = "video_id", index: str = "frame_idx") -> DataFrame:
    """Keep every (step+1)-th frame; the count runs on from video to video of a camera when `videos` is given.

    `videos` has the number of frames of every video; without it each video starts anew.
    """
    if step == 0 or videos is None:
        return frames.filter(F.pmod(F.col(index), F.lit(step + 1)) == step)
    phases = video_phases(videos, step, camera, video).select(*camera, video, "phase")
    return (frames.join(phases, [*camera, video])
            .filter(F.pmod(F.col("phase") + F.col(index), F.lit(step + 1)) == step).drop("phase"))


def key_positions(df: DataFrame, key: str, out: str = "position", pieces: int = 256) -> DataFrame:
    """The distinct keys with their 0-based position in the order of all keys.

    Cut points are every 16th of the keys with the smallest hashes, so they follow the keys' distribution and
    every task that is run again finds the same ones; each range is numbered by itself and shifted by
    the sizes of the ranges before it. The distinct keys are shuffled once and used three times.
    """
    keyed = df.select(key).distinct()
    lowest = keyed.select(key, F.xxhash64(key).alias("_h")).orderBy("_h", key).limit(pieces * 16)
    sample = lowest.agg(F.sort_array(F.collect_list(key)).alias("s"))
    cuts = sample.select(F.filter("s", lambda x, i: i % 16 == 15).alias("cuts"))
    ranged = (keyed.withColumn("_cuts", cuts.scalar())
              .withColumn("_range", F.size(F.filter("_cuts", lambda c: c <= F.col(key)))).drop("_cuts"))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    every = sizes.agg(F.collect_list(F.struct("_range", "_n")).alias("sizes"))
    offsets = sizes.withColumn("_all", every.scalar()).select("_range", F.aggregate(
        F.filter("_all", lambda e: e["_range"] < F.col("_range")), F.lit(0).cast("long"), lambda a, e: a + e["_n"]).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return (ranged.withColumn("_inside", inside).join(F.broadcast(offsets), "_range")
            .select(key, (F.col("_before") + F.col("_inside") - 1).alias(out)))


def assign_round_robin(listing: DataFrame, folder: str, target: str, users: int = 100, key: str = "key") -> DataFrame:
    """Copy manifest that deals sorted videos out to users: video, info and thumbnail from and to."""
    dealt = key_positions(listing, key).withColumn("user_id", F.pmod("position", F.lit(users)))
    name, stem = keys.file_name(F.col(key)), keys.file_stem(F.col(key))
    home = F.concat(F.lit(target), F.lit("user_"), F.col("user_id").cast("string"))
    at = lambda root, part, leaf, ext="": F.concat(root, F.lit(part), leaf, F.lit(ext))
    source = F.lit(folder)
    return dealt.select(
        "position", "user_id", F.col(key).alias("video_key"),
        at(home, "/videos/", name).alias("target_video_key"),
        at(source, "info/", stem, ".json").alias("info_key"), at(home, "/info/", stem, ".json").alias("target_info_key"),
        at(source, "frame-10s/", stem, ".jpg").alias("thumb_key"), at(home, "/frame-10s/", stem, ".jpg").alias("target_thumb_key"))
